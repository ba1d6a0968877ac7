"""Input views derived by Spark from the driver tables (see FIXTURES.md).

All views read whole tables: ``re_raw`` turns *every* line of *every*
document into one relation-extraction row, so the work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.functions.hashing import h
from sentrel.operators.rows import keep_rows
from sentrel.schema import label_dim

_TYPES = ["PER", "ORG", "DAT", "LOC", "POH", "NOH"]
LINE_ID_FACTOR = 1_000_000_000  # lines of a document
CLASSES = 30


# Hash key used to spread a table whose scan is coarser than the cluster.
_SPREAD_KEY = {"documents": "doc_id", "conversations": "conv_id", "events": "event_id",
               "embeddings": "vec_id", "pages": "page_id"}


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-repartition a scan that yields fewer partitions than the cluster has
    cores (e.g. one large row group); at scale the scan is already finer and
    this is a no-op, so no shuffle is added."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par, key)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = _SPREAD_KEY.get(name)
    return spread(df, key) if key else df


def _cell(word, start, end, etype):
    return F.concat(F.lit("{'word': '"), word, F.lit("', 'start_idx': "), start.cast("string"),
                    F.lit(", 'end_idx': "), end.cast("string"), F.lit(", 'type': '"), etype,
                    F.lit("'}"))


def re_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW relation table: one row per document line with at least 2 words.

    ``id = doc_id * 1e9 + line number``; subject and object are two different
    words of the line picked by hash; spans are 0-based, end inclusive.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    lines = docs.select("doc_id", "source",
                        F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # words with one space between: most lines need no change, and a single space splits without a pattern
    words = F.regexp_replace("line", "[@#*^'\":,{}\t\n\\x0B\f\r]", " ")
    words = F.trim(F.regexp_replace(words, "  +", " "))
    a = lines.select((F.col("doc_id") * LINE_ID_FACTOR + F.col("line_no")).alias("id"), "source", words.alias("line"))
    a = a.withColumn("w", F.split("line", " ")).withColumn("n", F.when(F.col("line") != "", F.size("w")).otherwise(F.lit(0)))
    a = keep_rows(a, F.col("n") >= 2)  # not pushed below the tokenisation (computed once)
    # nullif: the optimizer may evaluate these before the size filter
    n, n1 = F.nullif(F.col("n"), F.lit(0)), F.nullif(F.col("n") - 1, F.lit(0))
    a = a.withColumn("s0", (h("re-s", "id") % n).cast("int"))
    a = a.withColumn("o0", ((F.col("s0") + 1 + h("re-o", "id") % n1) % n).cast("int"))
    sw, ow = F.element_at("w", F.col("s0") + 1), F.element_at("w", F.col("o0") + 1)
    ss = F.length(F.array_join(F.slice("w", F.lit(1), F.col("s0") + 1), " ")) - F.length(sw)
    os_ = F.length(F.array_join(F.slice("w", F.lit(1), F.col("o0") + 1), " ")) - F.length(ow)
    ty = F.array(*[F.lit(t) for t in _TYPES])
    st = F.element_at(ty, (h("re-ts", "id") % 6 + 1).cast("int"))
    ot = F.element_at(ty, (h("re-to", "id") % 6 + 1).cast("int"))
    out = a.select(
        "id", F.col("line").alias("sentence"),
        _cell(sw, ss, ss + F.length(sw) - 1, st).alias("subject_entity"),
        _cell(ow, os_, os_ + F.length(ow) - 1, ot).alias("object_entity"),
        (h("re-l", "id") % 30).cast("int").alias("label_id"), "source")
    labels = F.broadcast(label_dim(spark))  # 30 rows, fixed
    return out.join(labels, "label_id").select(
        "id", "sentence", "subject_entity", "object_entity", "label", "label_id", "source")


def re_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW relation table of every document line as it is, quotes, markers and all: entities are 1 to 6 characters
    anywhere in the line (or reach beyond it), and by hash some rows have a cut or missing cell, an unknown
    type, an unknown label, or a span that ends before it begins."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    a = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "sentence"))
    a = a.select((F.col("doc_id") * LINE_ID_FACTOR + F.col("line_no")).alias("id"), "sentence")
    a = keep_rows(a.withColumn("n", F.length("sentence")), F.col("n") >= 1)
    a = a.withColumn("k", h("hard-k", "id") % 11)
    ty = F.array(*[F.lit(t) for t in _TYPES])
    for e in ("s", "o"):
        a = a.withColumn(f"{e}0", (h(f"hard-{e}", "id") % F.nullif("n", F.lit(0))).cast("int"))
        a = a.withColumn(f"{e}1", F.col(f"{e}0") + (h(f"hard-{e}1", "id") % 6).cast("int"))
        a = a.withColumn(f"{e}t", F.element_at(ty, (h(f"hard-{e}t", "id") % 6 + 1).cast("int")))
    k = F.col("k")
    cell = lambda e, t: _cell(F.substring("sentence", F.col(f"{e}0") + 1, F.lit(6)), F.col(f"{e}0"),
                              F.when((k == 4) & F.lit(e == "o"), F.col("o0") - 1).otherwise(F.col(f"{e}1")), t)
    subject = cell("s", F.when(k == 2, F.lit("XYZ")).otherwise(F.col("st")))
    label = F.when(k == 3, F.lit("per:unknown")).otherwise(F.col("label"))
    out = a.withColumn("label_id", (h("hard-l", "id") % 30).cast("int")).join(F.broadcast(label_dim(spark)), "label_id")
    return out.select("id", "sentence", F.when(k == 0, F.substring(subject, 1, 10)).otherwise(subject).alias("subject_entity"),
                      F.when(k != 1, cell("o", F.col("ot"))).alias("object_entity"), label.alias("label"))


def variants(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Rewritten sentences per id (stand-in for the translation model's output):
    a prefixed copy keeps both words, a reversed copy moves them, and a copy
    without its first two words may lose them."""
    raw = raw if raw is not None else re_raw(spark, sf_dir)
    toks = F.split("sentence", " ")
    new = (F.when(F.col("label_id") % 3 == 0, F.concat(F.lit("Zz "), F.col("sentence")))
           .when(F.col("label_id") % 3 == 1, F.array_join(F.reverse(toks), " "))
           .otherwise(F.array_join(F.slice(toks, 3, 1 << 30), " ")))
    return raw.select("id", new.alias("new_sentence"))


def re_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores per row: logits of 30 classes from the embedding; class 0 plays no_relation."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("label").alias("label_id"),
                    F.transform(F.slice("embedding", 1, CLASSES), lambda x: x.cast("double")).alias("z"))


def pred_catalog(spark: SparkSession, sf_dir: str, per_document: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Three prediction "datasets" (m0, m1, m2) over all documents; the sentence
    is the whole text, the scores are windows of 30 elements of the vector whose
    id is the document's modulo the number of vectors (together all 64 elements).
    ``per_document`` is applied to the documents (``sentence``, ``source``) before each becomes three rows."""
    e = table(spark, sf_dir, "embeddings")
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("sentence"), "source")
    d = per_document(d) if per_document else d
    kept = [c for c in d.columns if c != "doc_id"]
    d = d.withColumn("_vec", F.pmod("doc_id", e.agg(F.count(F.lit(1))).scalar()))
    j = d.join(e, F.col("_vec") == e.vec_id)
    j = j.select("doc_id", *kept, "label", "embedding",
                 F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    return j.select(
        F.concat(F.lit("m"), F.col("k").cast("string")).alias("dataset"),
        F.col("doc_id").alias("id"), *kept,
        F.col("label").alias("label_id"),
        F.transform(F.slice("embedding", F.col("k") * 17 + 1, F.lit(CLASSES)),
                    lambda x: x.cast("double")).alias("z"))


def eval_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation history: run = user, step = event, value = metric."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "value")


def span_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token vectors with entity locations: 10 tokens per id, loc in 0..2."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.floor(F.col("vec_id") / 10).cast("bigint").alias("id"),
                    (F.col("vec_id") % 10).alias("pos"), (F.col("label") % 3).alias("loc"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
