"""Corpus operators for training data: one module per operator, and
:mod:`sentrel.llm.registry` with their queries and SQL.

Functions of this subpackage that run inside tasks are sent by value, so
executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
