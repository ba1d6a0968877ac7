"""P-operators: parse entity cells, map types and labels, mark sentences.

Each function takes and returns a DataFrame (use with ``df.transform``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sentrel.functions import entity as E
from sentrel.functions.text import clean_text
from sentrel.operators.rows import keep_rows
from sentrel.schema import label_dim


def parse_entities(df: DataFrame) -> DataFrame:
    """P01 + P04 + P05: strict parse of both cells, marker type names and span
    words. Adds ``ss, se, os, oe`` (INT), ``s_code, o_code``,
    ``subject_type, object_type`` and ``subject_word, object_word``."""
    out = df.select("*", E.entity_start("subject_entity").alias("ss"),
                    E.entity_end("subject_entity").alias("se"),
                    E.entity_type("subject_entity").alias("s_code"),
                    E.entity_start("object_entity").alias("os"),
                    E.entity_end("object_entity").alias("oe"),
                    E.entity_type("object_entity").alias("o_code"))
    return out.select(
        "*", E.map_type("s_code").alias("subject_type"), E.map_type("o_code").alias("object_type"),
        E.span_text("sentence", "ss", "se").alias("subject_word"),
        E.span_text("sentence", "os", "oe").alias("object_word"))


def _entity_error() -> F.Column:
    return (F.when(F.col("ss").isNull() | F.col("se").isNull(), "subject offsets")
            .when(F.col("os").isNull() | F.col("oe").isNull(), "object offsets")
            .when(F.col("subject_type").isNull(), "subject type")
            .when(F.col("object_type").isNull(), "object type")
            .when((F.col("se") < F.col("ss")) | (F.col("oe") < F.col("os"))
                  | (F.col("se") >= F.length("sentence")) | (F.col("oe") >= F.length("sentence")),
                  "span out of sentence"))


def valid_entities(parsed: DataFrame) -> DataFrame:
    """Rows of :func:`parse_entities` whose spans and types are usable."""
    return keep_rows(parsed, _entity_error().isNull())


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows that cannot be marked, with the reason in ``error``."""
    return keep_rows(parsed.withColumn("error", _entity_error()), F.col("error").isNotNull())


#: Reasons of :func:`routed`, in the order in which they are looked for.
REASONS = ["subject offsets", "object offsets", "subject type", "object type", "span out of sentence", "loose cell", "label"]


def routed(raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """P01, P02 and P12 with a counted quarantine: one pass over a RAW table writes every row under ``path``, parsed, with
    the first ``reason`` why it cannot be used (null: none), and counts the rows by reason on the way. Returns the rows
    kept, those put apart, and the counts (``read``, ``kept`` and each of ``REASONS``): read = kept + all reasons."""
    loose = E.parse_entity_loose("subject_entity"), E.parse_entity_loose("object_entity")
    d = label_to_num(parse_entities(raw).withColumn("_s", loose[0]).withColumn("_o", loose[1]))
    unread = F.lit(False)
    for c in ("_s", "_o"):
        unread = unread | F.col(f"{c}.start_idx").isNull() | F.col(f"{c}.end_idx").isNull() | F.col(f"{c}.type").isNull()
    reason = F.coalesce(_entity_error(), F.when(unread, F.lit("loose cell")), F.when(F.col("label_id").isNull(), F.lit("label")))
    d = d.withColumn("reason", reason).drop("_s", "_o").withColumn("kept", F.col("reason").isNull())
    seen = Observation()
    d = d.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if("kept").alias("kept"), *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS])
    d.write.partitionBy("kept").parquet(path)
    back = raw.sparkSession.read.schema(d.schema).parquet(path)
    return back.where("kept").drop("kept", "reason"), back.where("not kept").drop("kept"), seen.get


def mark_typed_punct(parsed: DataFrame, out: str = "marked") -> DataFrame:
    """P06 typed punctuation markers on the original offsets."""
    return parsed.withColumn(out, E.mark_typed_punct("sentence", "ss", "se", "os", "oe",
                                                     "subject_type", "object_type"))


def parse_loose(df: DataFrame) -> DataFrame:
    """P02: ``ss, se, os, oe`` and type codes in ``subject_code, object_code``."""
    s, o = E.parse_entity_loose("subject_entity"), E.parse_entity_loose("object_entity")
    # the struct is built by one expression per cell (not inlined field by field)
    return df.withColumn("_s", s).withColumn("_o", o).select(
        "*", F.col("_s.type").alias("subject_code"), F.col("_o.type").alias("object_code"),
        F.col("_s.start_idx").alias("ss"), F.col("_s.end_idx").alias("se"),
        F.col("_o.start_idx").alias("os"), F.col("_o.end_idx").alias("oe")).drop("_s", "_o")


def mark_special(loose: DataFrame, mode: str | None = None, out: str = "marked") -> DataFrame:
    """P07 special-token markers ``[SUBJ-T]..[/SUBJ-T]``, ``[OBJ-T]..[/OBJ-T]``
    with the type codes. ``pre`` cleaning is length preserving and runs before
    marking (so the brackets survive); ``chinese`` runs after."""
    sent = clean_text("sentence", "pre") if mode == "pre" else F.col("sentence")
    marked = E.mark_special(sent, "ss", "se", "os", "oe", "subject_code", "object_code")
    if mode == "chinese":
        marked = clean_text(marked, "chinese")
    return loose.withColumn(out, marked)


def marker_vocab(loose: DataFrame) -> DataFrame:
    """P08 distinct marker tokens present in the data, sorted."""
    toks = E.special_tokens("subject_code", "object_code")
    return loose.select(F.explode(F.array(*toks)).alias("token")).distinct()


def question(parsed: DataFrame, out: str = "question") -> DataFrame:
    """P11 the question sentence used as a second segment."""
    q = F.concat(F.lit("@*"), F.col("subject_type"), F.lit("*"), F.col("subject_word"),
                 F.lit("@와 #^"), F.col("object_type"), F.lit("^"), F.col("object_word"),
                 F.lit("#의 관계는 무엇인가요?"))
    return parsed.withColumn(out, q)


def label_to_num(df: DataFrame, label: str = "label", out: str = "label_id") -> DataFrame:
    """P12 label name -> id by a broadcast join with the 30-row dimension;
    unknown labels keep a NULL id (see :func:`unknown_labels`)."""
    dim = F.broadcast(label_dim(df.sparkSession)
                      .withColumnRenamed("label", "_lname").withColumnRenamed("label_id", out))
    return df.join(dim, df[label] == dim["_lname"], "left").drop("_lname")


def unknown_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Quarantine of P12: rows whose label is not in the dimension."""
    dim = F.broadcast(label_dim(df.sparkSession).select(F.col("label").alias("_lname")))
    return df.join(dim, df[label] == dim["_lname"], "left_anti")


def num_to_label(df: DataFrame, num: str, out: str) -> DataFrame:
    """P13 id -> label name (broadcast join with the 30-row dimension)."""
    dim = F.broadcast(label_dim(df.sparkSession)
                      .withColumnRenamed("label_id", "_lid").withColumnRenamed("label", out))
    return df.join(dim, df[num] == dim["_lid"], "left").drop("_lid")


def marker_spans(marked: DataFrame, sentence: str = "sentence") -> DataFrame:
    """P14 spans of the marked entities in a marked sentence, start inclusive,
    end exclusive: ``subject_idx = [start of '@*', end of closing '@')``."""
    s = F.col(sentence)
    s0 = F.instr(s, F.concat(F.lit("@*"), F.col("subject_type"), F.lit("*"), F.col("subject_entity"), F.lit("@"))) - 1
    o0 = F.instr(s, F.concat(F.lit("#^"), F.col("object_type"), F.lit("^"), F.col("object_entity"), F.lit("#"))) - 1
    s_len = F.length("subject_type") + F.length("subject_entity") + 4
    o_len = F.length("object_type") + F.length("object_entity") + 4
    return marked.withColumn("subject_idx", F.when(s0 >= 0, F.array(s0, s0 + s_len))) \
                 .withColumn("object_idx", F.when(o0 >= 0, F.array(o0, o0 + o_len)))


def to_marked(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P15 canonical nine-column marked table from a RAW table (valid rows).

    ``subject_idx``/``object_idx`` are the true annotation spans (inclusive)."""
    p = valid_entities(parse_entities(raw))
    p = mark_typed_punct(p)
    return p.select(
        "id", F.col("marked").alias("sentence"),
        F.col("subject_word").alias("subject_entity"), F.col("object_word").alias("object_entity"),
        "subject_type", "object_type", "label",
        F.array("ss", "se").alias("subject_idx"), F.array("os", "oe").alias("object_idx"),
        *keep)
