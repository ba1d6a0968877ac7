"""Operator 3, exact deduplication by content-defined chunk recipes.

Texts count as equal when they are identical after every run of
``[\\x20\\x09-\\x0D]`` is replaced by one space. A text is cut where its own
content says so (:data:`CHUNK`), so a chunk that many documents share is cut
alike in all of them. Chunks get identifiers (64-bit hashes) that are verified:
each distinct chunk is moved once, to its hash, and a hash under which two
different chunks meet is refused as an identifier - such a chunk is then
identified by its own text. A document's ordered list of identifiers is its
recipe; documents are compared by recipe only, their texts do not move again.

Defined results: a null text is empty; all empty texts are equal (one has a
single space: that is another text). Of equal texts the row with the smallest
id stays; a null id comes after all others; of identical rows (same id, equal
text) one stays. An empty table gives an empty result. Only the two named
columns are read, so other columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import SPACE, text_of, without, written

#: At least 1,024 characters, then up to where one of seven letters and a space stand before a letter of a to h
#: (or at the end); at most 8,192 characters. A rest without such a place is cut by length.
CHUNK = r"(?s).{1024,8192}?(?:(?<=[adgknrt] )(?=[a-hA-H])|\z)|(?s).{1,8192}"

#: Refused hashes that are compared as literals; with more of them every chunk is identified by its text.
MAX_REFUSED = 10_000


def normalised(text: str) -> Column:
    return F.regexp_replace(text_of(text), SPACE, " ")


def chunks(text: str) -> Column:
    return F.regexp_extract_all(normalised(text), F.lit(CHUNK), F.lit(0))


def chunk_hash(chunk: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits)


def refused_hashes(df: DataFrame, text: str, bits: int = 64) -> DataFrame:
    """Hashes under which different chunks meet. Distinct chunks travel once
    (combined before the shuffle); after that only hashes and counts."""
    parts = df.select(F.explode(chunks(text)).alias("chunk")).select(chunk_hash(F.col("chunk"), bits).alias("h"), "chunk")
    return parts.distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")


def recipes(df: DataFrame, id_col: str, text: str, bits: int = 64) -> DataFrame:
    """One row per row of ``df``: ``doc_id, row, text_sha256, recipe``."""
    refused = written(refused_hashes(df, text, bits), "refused").limit(MAX_REFUSED + 1).collect()
    bad = [r["h"] for r in refused]

    def identifier(chunk: Column) -> Column:
        h = chunk_hash(chunk, bits)
        if not bad:
            return F.struct(h.alias("h"), F.lit("").alias("as_text"))
        own = F.lit(True) if len(bad) > MAX_REFUSED else h.isin(bad)
        return F.struct(h.alias("h"), F.when(own, chunk).otherwise("").alias("as_text"))

    return df.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                     F.sha2(normalised(text), 256).alias("text_sha256"),
                     F.transform(chunks(text), identifier).alias("recipe"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """One row per row of ``df``: ``doc_id, keep_id, group_size, kept,
    text_sha256, n_chunks`` (see the module text)."""
    docs = written(recipes(df, id_col, text_col, bits), "recipes")
    groups = docs.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"),
                                        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("keep"))
    groups = written(groups.where("group_size > 1"), "groups")  # a table, so that a hot recipe's rows can be split in the join
    return docs.join(groups, "recipe", "left").select(
        "doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256", F.size("recipe").cast("bigint").alias("n_chunks"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows that :func:`exact_dedup` drops, all columns kept."""
    marks = exact_dedup(df, id_col, text_col).select("doc_id", F.col("text_sha256").alias("mark"), "kept")
    return without(df, marks, id_col, F.sha2(normalised(text_col), 256))
