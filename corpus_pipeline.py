"""The corpus pipeline: five stages over ``documents``, each by one operator of
``sentrel.llm``. A stage takes what its predecessor kept, as a table; all but
the last return the columns of documents.

1. toxicity: documents with a score of 0.7 or more go;
2. exact deduplication: of equal texts the smallest id stays;
3. near deduplication: one document of each component of the Jaccard join stays;
4. mixing: documents appear as often as the mix over sources takes them (0, 1 or 2 times);
5. packing: the pieces of sequences of 4,096 ids.

The first stage is a trained model and the last uses a tokenizer, so no SQL
gives the pipeline's rows; a test holds the filtering stages against plain versions, and
the operators of the others have brute-force tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentrel.llm.exact_dedup import drop_copies
from sentrel.llm.jaccard_join import drop_near_duplicates
from sentrel.llm.mixing import mixed
from sentrel.llm.packing import packed
from sentrel.llm.shared import table, written
from sentrel.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("mix", mix_stage), ("pack", pack_stage)]

#: SQL cannot express the trained first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
