"""S-operators: CSV sources and sinks, directory catalogs, time stamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.schema import RAW_SCHEMA

CORRUPT = "_corrupt_record"


#: Name of the table that a file belongs to: ``name.csv``, or the parts of a folder ``name.csv``.
DATASET = r"/([^/]+)\.csv(?:/[^/]*)?$"


def _scan(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, extra: Sequence[Column] = ()) -> DataFrame:
    """All rows of the files, columns found by the names in their header (types
    from ``schema``, others as text), with ``_corrupt_record``. Files whose
    headers differ from the first one's are refused, not misread."""
    reader = (spark.read.option("header", "true").option("multiLine", str(multi_line).lower())
              .option("quote", '"').option("escape", '"'))
    declared = {f.name: f.dataType for f in schema.fields}
    names = reader.csv(path).columns  # reads a header only
    found = T.StructType([T.StructField(n, declared.get(n, T.StringType())) for n in names] + [T.StructField(CORRUPT, T.StringType())])
    df = (reader.option("mode", "PERMISSIVE").option("enforceSchema", "false")
          .option("columnNameOfCorruptRecord", CORRUPT).schema(found).csv(path))
    # always true, and read from every column: a row is told corrupt by all of its cells, also where a query needs few of them
    whole = F.length(F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in names])) >= 0
    return df.where(whole).select(*[F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], CORRUPT, *extra)


def read_re_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
                keep_corrupt: bool = False, multi_line: bool = True) -> DataFrame:
    """S01/S02 CSV scan with a header row; columns go by name, whatever their
    order, and others (such as an unnamed index column) are left out. Quoted
    cells may span lines; files without such cells can be split between tasks
    with ``multi_line=False``. Rows that do not fit the schema are left out here
    and returned by :func:`corrupt_rows` (``keep_corrupt`` keeps them, with
    their text in ``_corrupt_record``)."""
    df = _scan(spark, path, schema, multi_line)
    return df if keep_corrupt else df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, multi_line: bool = True) -> DataFrame:
    """Quarantine of S01/S02: the text of each row that does not fit the schema."""
    return _scan(spark, path, schema, multi_line).where(F.col(CORRUPT).isNotNull())


def load_catalog(spark: SparkSession, path: str, schema: T.StructType,
                 name_from: str = "file") -> DataFrame:
    """S03 directory scan into one table with a ``dataset`` column.

    ``name_from='file'``: every ``*.csv`` file is one dataset named after the
    file (minus ``.csv``); ``'partition'``: Hive-style ``dataset=<name>``
    folders as written by :func:`write_csv` with ``partition_by``."""
    reader = (spark.read.option("header", "true").option("multiLine", "true")
              .option("quote", '"').option("escape", '"').schema(schema))
    if name_from == "file":
        df = reader.option("pathGlobFilter", "*.csv").csv(path)
        return df.withColumn("dataset", F.regexp_extract(F.col("_metadata.file_name"), r"(.*)\.csv$", 1))
    if name_from == "partition":
        full = T.StructType(list(schema.fields) + [T.StructField("dataset", T.StringType())])
        return reader.schema(full).csv(path)
    raise ValueError(name_from)


def put(spark: SparkSession, catalog: str, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """S03 adds the table at ``path`` (a CSV file, a folder ``name.csv`` as Spark writes it, or a folder or pattern of several)
    to the catalog: a Parquet table with one partition per dataset, named after the file. Columns go by
    their names in the header, as in S01. A dataset that the catalog has already is replaced as a whole, all others stay (dynamic
    partition overwrite). Rows that do not fit the schema are left out; they are returned, with their dataset."""
    name = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), DATASET, 1).alias("dataset")
    rows = _scan(spark, path, schema, multi_line, [name])
    rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("dataset").parquet(catalog)
    return rows.where(F.col(CORRUPT).isNotNull()).select("dataset", CORRUPT)


def read_catalog(spark: SparkSession, catalog: str, schema: T.StructType) -> DataFrame:
    """The catalog that :func:`put` fills, with a ``dataset`` column."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("dataset", T.StringType())])).parquet(catalog)


def csv_ready(df: DataFrame) -> DataFrame:
    """Serialise array/struct/map columns as JSON text so they survive CSV."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, partition_by: str | None = None,
              mode: str = "errorifexists") -> None:
    """S05 CSV sink with a header and no index column; arrays as JSON text."""
    w = csv_ready(df).write.mode(mode).option("header", "true").option("quote", '"') \
        .option("escape", '"')
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def stamp(ts: Column | str, tz: str = "Asia/Seoul") -> Column:
    """S06 ``yyMMdd-HH:mm:ss`` wall clock in ``tz`` of a UTC wall-clock
    timestamp (TIMESTAMP_NTZ); independent of the session time zone."""
    t = F.col(ts) if isinstance(ts, str) else ts
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), t.cast("timestamp_ntz"))
    return F.date_format(local, "yyMMdd-HH:mm:ss")
