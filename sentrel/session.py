"""Session helpers: a local session for tests/bench, and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sentrel")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables: ``spark.checkpoint.dir`` of the
    session, or the folder its SparkContext was given. Without either, a local
    master gets a fresh local folder (tests, trials); a cluster gets an error,
    as its executors would not see the driver's folders."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[[^\]]*\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="sentrel-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared work folder."""
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and cut its lineage
    (reliable ``checkpoint``, survives executor loss); for an intermediate
    that several later branches of one plan read."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun in here delete their shuffle files at their end, instead of when the driver's memory is next collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, path: str | None = None, by: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """As :func:`materialize`, but as compressed Parquet under the shared work folder (``path``, with what was stored there before, or a new
    one): for tables that hold texts. The shuffle files it took are deleted. ``by`` keeps the rows in buckets of that column, each file in
    ``order``: plans that group by the column read the buckets where they are, without an exchange. Few files come of rows that were :func:`dealt`."""
    spark, path = df.sparkSession, path or scratch_path(df.sparkSession, "stored")
    with _freed_shuffles(spark):
        if by is None:
            df.write.mode("append").option("compression", "zstd").parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        name = f"spark_catalog.default.stored_{uuid.uuid4().hex}"
        df.write.format("parquet").option("compression", "zstd").option("path", path) \
          .bucketBy(buckets(spark), by).sortBy(*(order or [by])).saveAsTable(name)
        back = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # the name only: the files are not the catalog's
        return back


def buckets(spark: SparkSession) -> int:
    """Buckets that :func:`stored` and :func:`dealt` make."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, by: str) -> DataFrame:
    """``df`` with the rows of one value of ``by`` in one task, as buckets are dealt by :func:`stored`."""
    return df.repartition(buckets(df.sparkSession), by)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table that was :func:`stored` under ``path`` and that no later plan reads."""
    spark.range(0).write.mode("overwrite").parquet(path)
