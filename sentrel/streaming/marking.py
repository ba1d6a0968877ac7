"""Structured Streaming: the row-wise operators (parse, mark, label ids) run
unchanged on a ``readStream`` of RAW CSV files; output is appended as Parquet
with a checkpoint, so a restarted query resumes where it stopped.

The reference has no streaming; nothing stateful is needed because every
operator used here is a per-row projection plus broadcast joins with the
fixed dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentrel.operators.spans import label_to_num, to_marked
from sentrel.schema import RAW_SCHEMA
from sentrel.sources.files import CORRUPT


def read_raw_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Stream of RAW rows from CSV files arriving in ``path``."""
    from pyspark.sql import types as T
    schema = T.StructType(list(RAW_SCHEMA.fields) + [T.StructField(CORRUPT, T.StringType())])
    return (spark.readStream.option("header", "true").option("multiLine", "true")
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("maxFilesPerTrigger", max_files)
            .schema(schema).csv(path).where(F.col(CORRUPT).isNull()).drop(CORRUPT))


def mark_stream(spark: SparkSession, src: str, sink: str, checkpoint: str,
                available_now: bool = False) -> StreamingQuery:
    """Start a query: RAW CSV files -> canonical marked table (+ label ids) ->
    Parquet files in ``sink``."""
    marked = label_to_num(to_marked(read_raw_stream(spark, src)))
    w = marked.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
