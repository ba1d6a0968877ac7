"""What the chain (C01) keeps on disk, and that its blocks of whole ids give the rows that the regroup by row key gives."""
import os

import pytest
from pyspark.sql import functions as F

from sentrel.operators import features as FT
from sentrel.operators.scan import beside_groups, join_groups
from sentrel.plans.queries import QUERIES
from sentrel.session import dealt, discard, scratch_path, stored, work_dir
from tests.conftest import SF_SMALL
from tests.test_plans import plan


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.toString()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


@pytest.fixture(scope="module")
def chain(spark):
    top = work_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    out = QUERIES["c01_chain"](spark, SF_SMALL)
    return out, [f"{top}/{d}" for d in set(os.listdir(top)) - before if not os.path.exists(f"{top}/{d}/rdd-0") and "-" in d]


def test_texts_lie_on_disk_once(spark, chain):
    _, folders = chain
    tables = [spark.read.parquet(f) for f in folders if any(x.endswith(".parquet") for x in os.listdir(f))]
    assert [t.count() > 0 for t in tables if "sentence" in t.columns] == [True]


def test_encoding_moves_tokens_only(chain):
    p = plan(chain[0])
    assert p.count("FileScan parquet spark_catalog.default.stored_") == 2  # the rows, for their tokens and for their ids
    assert "ObjectHashAggregate" not in p and p.count("Exchange hashpartitioning(id") == 0
    assert p.count("Exchange hashpartitioning(_t") + p.count("Exchange hashpartitioning(token") + p.count("Exchange hashpartitioning(_of") == p.count("Exchange hashpartitioning(")


def test_written_tables_keep_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffle_files(spark)
    path = scratch_path(spark, "stored")
    s = stored(df, path)
    assert shuffle_files(spark) <= before and s.count() == 7
    assert stored(df, path).count() == 14  # a further round
    discard(spark, path)
    assert spark.read.parquet(path).count() == 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def odd_rows(spark, copies=300):
    """Repeated and null row keys, a null and an empty text, tokens that are not in the vocabulary."""
    rows = [(i % 97, i % 2, f"word{i % 5} @ a^{i % 3} #w{i % 11} " + "x " * (i % 7)) for i in range(copies)]
    rows += [(None, 0, "no id at all"), (None, 0, "none here"), (None, None, "nothing"), (500, 0, None), (501, 0, ""), (502, 1, "y " * 400), (502, 1, "z w")]
    return spark.createDataFrame(rows, "id long, variant int, sentence string")


def same_rows(a, b):
    names = sorted(a.columns)
    return sorted(map(repr, a.select(names).collect())) == sorted(map(repr, b.select(names).collect()))


def test_blocks_of_whole_keys_encode_like_neighbouring_rows(spark):
    rows = stored(odd_rows(spark))
    vocab = stored(FT.build_vocab(FT.tokens(rows.where("id % 3 > 0"))))
    blocks = FT.key_blocks(rows)
    blocked = stored(dealt(FT.in_key_blocks(rows, blocks), FT.KEY_BLOCK), by=FT.KEY_BLOCK)
    assert blocked.count() == rows.count()
    a, b = FT.encode(rows, vocab), FT.encode(blocked, vocab)
    assert same_rows(a, b) and b.count() == rows.select("id", "variant").distinct().count()
    pairs = [d.withColumn("question", F.concat(F.lit("what is "), "sentence")) for d in (rows, blocked)]
    a, b = (FT.encode_pair(d, vocab) for d in pairs)
    assert same_rows(a, b)


def test_a_carried_column_is_of_the_row(spark):
    rows = odd_rows(spark).dropDuplicates(["id", "variant"])
    blocked = stored(dealt(FT.in_key_blocks(rows, 5), FT.KEY_BLOCK), by=FT.KEY_BLOCK)
    rows = stored(blocked.drop(FT.KEY_BLOCK))
    e = FT.encode(blocked, FT.build_vocab(FT.tokens(rows)), carry=("sentence",))
    assert same_rows(e.select("id", "variant", "sentence"), rows)


def test_beside_groups_is_a_left_join(spark):
    rows = odd_rows(spark)
    right = spark.createDataFrame([(None, 0, "n"), (None, None, "nn"), (3, 1, "a"), (5, 1, None), (9999, 0, "none")], "id long, variant int, part string")
    a = join_groups(rows, right, ["id", "variant"], "left")
    b = beside_groups(FT.in_key_blocks(rows, 3), FT.in_key_blocks(right, 3), ["id", "variant"], FT.KEY_BLOCK).drop(FT.KEY_BLOCK)
    assert same_rows(a, b)


def test_rounds_give_the_same_rows(spark, chain, monkeypatch):
    import sentrel.plans.queries as q
    monkeypatch.setattr(q, "ROUND_ROWS", 1000)
    assert same_rows(QUERIES["c01_chain"](spark, SF_SMALL), chain[0])
