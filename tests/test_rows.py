"""No operator loses, merges or multiplies rows; cells that are written can be read back."""
import pytest
from pyspark.sql import functions as F

from sentrel.functions import entity as E
from sentrel.functions.arrays import format_fixed
from sentrel.operators import augment as A
from sentrel.operators import features as FT
from sentrel.operators import split as D
from sentrel.operators import spans as P
from sentrel.schema import RAW_SCHEMA
from tests.conftest import SF_SMALL


def raw_rows():
    """Marker characters before the entity, two spaces inside an entity, apostrophes, quotes."""
    out = []
    for i, (before, s, mid, o, after) in enumerate([
            ("see #^ and @* first ", "Kim Lee", " works at ", "Acme", " now"), ("", "Ann  Marie", " met ", "Bob", " in town today"),
            ("mail me @* abcdefgh ", "Kim Lee", " works at ", "Acme", " now"), ("the ", "O'Neil", " of ", "New York", " said so"),
            ("a ", "Lee", " Lee Lee ", "Kim", " Kim"), ("", "X", " ", "Y", ""), ("one two three ", "Alpha", ", ", "Beta", "; four five")]):
        text = before + s + mid + o + after
        a = len(before)
        b = a + len(s) + len(mid)
        cell = lambda w, at: f"{{'word': '{w}', 'start_idx': {at}, 'end_idx': {at + len(w) - 1}, 'type': 'PER'}}"
        out.append((i, text, cell(s, a), cell(o, b), "no_relation", "wikitree"))
    return out


@pytest.fixture(scope="module")
def marked(spark):
    m = P.to_marked(spark.createDataFrame(raw_rows(), RAW_SCHEMA))
    assert m.count() == len(raw_rows())
    return m


def test_spans_of_the_marker_itself(marked):
    for r in P.marker_spans(marked).collect():
        s = r.sentence[r.subject_idx[0]:r.subject_idx[1]]
        assert s == f"@*{r.subject_type}*{r.subject_entity}@" and r.sentence[r.object_idx[0]:r.object_idx[1]].startswith("#^")


def test_augmentation_keeps_every_row_and_both_entities(marked):
    n = marked.count()
    a = A.aeda(marked, draws=3, keep_original=True)
    assert a.count() == 3 * n and A.unaugmentable(marked).count() == 0
    assert A.entity_intact(a).count() == 3 * n
    assert A.random_delete(marked, p=1.0).where(F.expr("instr(sentence, concat('@*', subject_type, '*', subject_entity, '@')) > 0")).count() == n
    for k in (2, 4):
        v = A.n_variants(marked, check_num=k)
        short = A.short_of_variants(marked, v, k).agg(F.coalesce(F.sum(k - 1 - F.col("n_variants")), F.lit(0))).first()[0]
        assert v.count() + short == n * (k - 1)
        assert v.select("id", "sentence").distinct().count() == v.count()


def test_rows_that_cannot_be_protected_stay_and_are_reported(marked):
    odd = marked.withColumn("sentence", F.when(F.col("id") < 2, F.lit("no marks here")).otherwise(F.col("sentence")))
    assert A.aeda(odd).count() == odd.count() and A.unaugmentable(odd).count() == 2
    assert {r.sentence for r in A.aeda(odd).where("id < 2").collect()} == {"no marks here"}


def test_variant_numbers_nest_and_nothing_is_merged_or_multiplied(marked):
    two = marked.withColumn("variant", F.lit(0)).unionByName(marked.withColumn("variant", F.lit(1)))
    rows = A.nest(two, 2).unionByName(A.n_variants(two, 2))
    n = rows.count()
    assert n == 4 * marked.count() and rows.select("id", "variant").distinct().count() == n
    vocab = FT.build_vocab(FT.tokens(rows), 500)
    e = FT.encode(rows, vocab)
    assert e.count() == n and all(len(r.input_ids) == 256 for r in e.collect())
    q = P.question(rows.withColumnRenamed("subject_entity", "subject_word").withColumnRenamed("object_entity", "object_word"))
    assert FT.encode_pair(q, vocab, second="question").count() == n


@pytest.mark.parametrize("safe", [False, True])
def test_holdout_keeps_the_number_of_rows_also_with_repeated_keys(spark, safe):
    rows = [(i % 50, 0 if i < 150 else 1, i % 50 % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, variant int, label_id int")
    out = D.holdout(df, rate=5, group_safe=safe)
    assert out.count() == 200 and out.where("part = 'valid'").count() > 0
    assert D.label_conflicts(df).count() == 0
    assert D.label_conflicts(df.union(spark.createDataFrame([(0, 9, 2)], df.schema))).collect()[0].id == 0


@pytest.mark.parametrize("word", ["O'Neil", 'the "big" one', """both ' and " here""", "back\\slash", "two\nlines", "{'word': 'x'}", "plain"])
def test_entity_cells_read_back(spark, word):
    df = spark.createDataFrame([(word, 3, 7, "PER")], "word string, start_idx int, end_idx int, type string")
    cell = df.select(E.encode_entity(F.struct(*df.columns)).alias("c")).withColumn("back", E.decode_entity("c"))
    r = cell.collect()[0]
    assert r.back is not None and (r.back.word, r.back.start_idx, r.back.end_idx, r.back.type) == (word, 3, 7, "PER")


def test_fixed_decimals_round_the_binary_value(spark):
    xs = [0.0125, 0.015, 2.675, 0.0005, 0.5, 1.5, 2.5, 0.125, 0.375, 1e-9, 0.0, -0.0, -0.0005, -2.675, 1234567.8915, 1e15 + 0.5, 1e17, 0.1 + 0.2, 0.9995, 0.99949999, 8.041 / 80]
    xs += [k / 1000 + 0.0005 for k in range(200)] + [k / 7 for k in range(50)]
    for digits in (0, 2, 3, 6):
        df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", format_fixed("x", digits).alias("t"))
        assert [(r.x, r.t) for r in df.collect() if r.t != f"%.{digits}f" % r.x] == []


def test_chain(spark):
    from sentrel.plans.queries import QUERIES, _augmented_raw
    out = QUERIES["c01_chain"](spark, SF_SMALL)
    n = out.count()
    assert out.select("id", "variant").distinct().count() == n
    source = P.valid_entities(P.parse_entities(_augmented_raw(spark, SF_SMALL))).count()
    train = out.where("part = 'train' and variant % 2 = 0").count()
    assert n == source + train
