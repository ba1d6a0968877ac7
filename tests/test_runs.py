"""The token functions that run in tasks, against plain Python and the same thing as Spark expressions."""

import re

from pyspark.sql import functions as F

from sentrel.functions.text import marker_tokens
from sentrel.operators import features as FT
from sentrel.plans.common import join_ints

TEXTS = [None, "", " ", "@*사람*Anna@ met\t#^조직^Big  Co#\x0bagain", "a@b", "**", "x y 　z", "one two", "@*사람*A@와 #^조직^B#의 " + "w " * 300 + "@*^#", "é^^#@"]


def plain(text):
    return None if text is None else re.findall(r"[@*#^]|[^@*#^ \t\n\x0b\f\r]+", text)


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, sentence string")


def test_tokens_equal_the_expression_and_plain_python(spark):
    d = FT.tokens(rows(spark, TEXTS * 3)).withColumn("own", marker_tokens("sentence"))
    for r in d.collect():
        assert r.tokens == r.own == plain(r.sentence)


def marked(tokens, length, spans):
    out = [0] * length
    for mark, end, n, v in spans:
        lo, hi = ([i for i, t in enumerate(tokens) if t == m] for m in (mark, end))
        lo, hi = (x[n - 1] if len(x) >= n and x else -1 for x in (lo, hi)) if n else (x[-1] if x else -1 for x in (lo, hi))
        for i in range(length):
            if lo < i < hi:
                out[i] = v
    return out


def test_entity_locations_equal_plain_python(spark):
    e = FT.entity_loc_ids(rows(spark, TEXTS), max_len=40)
    for r in e.collect():
        t = ["[CLS]", *(plain(r.sentence) or [])[:38], "[SEP]"] if r.sentence is not None else []
        assert r.entity_loc_ids == marked(t, 40, [("*", "@", 0, 1), ("^", "#", 0, 2)])
    pairs = [(a, b) for a in TEXTS for b in TEXTS]
    d = spark.createDataFrame(pairs, "sentence string, question string")
    for r in FT.entity_loc_ids_pair(d, max_len=64).collect():
        t = []
        if r.sentence is not None and r.question is not None:
            a, b = plain(r.sentence), plain(r.question)
            excess = max(0, len(a) + len(b) + 3 - 64)
            first = min(abs(len(a) - len(b)), excess)
            half, second = (excess - first) // 2, excess - first
            ca, cb = (first + half, second - half) if len(a) > len(b) else (half, first + second - half)
            t = ["[CLS]", *a[:len(a) - ca], "[SEP]", *b[:len(b) - cb], "[SEP]"]
        assert r.entity_loc_ids == marked(t, 64, [("*", "@", 2, 1), ("*", "@", 4, 1), ("^", "#", 2, 2), ("^", "#", 4, 2)])


def test_encoded_ids_equal_plain_python(spark):
    d = rows(spark, TEXTS)
    vocab = FT.build_vocab(FT.tokens(d)).where("token <> 'met'")
    ids = {r.token: r.token_id for r in vocab.collect()}
    for r in FT.encode(d, vocab, max_len=20, carry=("sentence",)).collect():
        own = [FT.CLS, *[ids.get(t, FT.UNK) for t in (plain(r.sentence) or [])[:18]], FT.SEP]
        assert r.input_ids == own + [FT.PAD] * (20 - len(own))


def test_masks_and_positions_of_nulls(spark):
    d = spark.createDataFrame([([5, None, 0, 7],), (None,), ([],)], "input_ids array<int>")
    got = [(r.attention_mask, r.p) for r in FT.masks(d).withColumn("p", FT.position_ids("input_ids")).collect()]
    assert got == [([1, None, 0, 1], [1, 0, 0, 2]), (None, None), ([], [])]


def test_joined_numbers_of_nulls(spark):
    d = spark.createDataFrame([([5, -1, 0],), ([5, None, 7],), ([None],), ([],), (None,)], "a array<int>")
    assert [r.t for r in d.select(join_ints("a").alias("t")).collect()] == ["5,-1,0", "5,7", "", "", None]


def test_token_work_needs_no_lambdas_and_no_exchange_of_every_token(spark):
    """F7, F8, F5: array lambdas run uncompiled, and the distinct tokens of a block need no exchange of their own."""
    def plan(df):
        return df._jdf.queryExecution().toString()

    d = rows(spark, TEXTS).withColumn("question", F.col("sentence"))
    for e in (FT.entity_loc_ids(d), FT.entity_loc_ids_pair(d)):
        assert "lambdafunction" not in plan(e)
    assert "explode" not in plan(FT.encode(d, FT.build_vocab(FT.tokens(d)).localCheckpoint()))
