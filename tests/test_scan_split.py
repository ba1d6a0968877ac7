import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sentrel.operators import scan as S
from sentrel.operators import split as D
from sentrel.plans import queries as Q
from tests.conftest import SF_MID


def skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = [(("hot" if rnd.random() < 0.4 else f"g{rnd.randint(0, 20)}"), i, rnd.random() * 100) for i in range(n)]
    return spark.createDataFrame(rows, "g string, o long, v double")


def test_running_equals_window(spark):
    df = skewed(spark)
    r = S.running(df, ["g"], [F.col("o")], [("s", "sum", F.col("v")), ("m", "max", F.col("v")),
                                             ("c", "sum", F.lit(1))])
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("g", "o", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"),
                    F.count(F.lit(1)).over(w).alias("c"))
    got = {(x.g, x.o): (round(x.s, 6), x.m, x.c) for x in r.collect()}
    exp = {(x.g, x.o): (round(x.s, 6), x.m, x.c) for x in ref.collect()}
    assert got == exp


def test_running_exclusive(spark):
    df = skewed(spark, 500)
    r = S.running(df, ["g"], [F.col("o")], [("p", "min", F.col("v"))], exclusive=True)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    ref = df.select("g", "o", F.min("v").over(w).alias("p"))
    assert {(x.g, x.o): x.p for x in r.collect()} == {(x.g, x.o): x.p for x in ref.collect()}


def test_quantiles_exact(spark):
    import numpy as np
    df = skewed(spark)
    q = {r.g: (r.a, r.b, r.c) for r in S.quantiles(df, ["g"], "v", [0.0, 0.25, 0.9], ["a", "b", "c"]).collect()}
    for g, vals in df.groupBy("g").agg(F.collect_list("v").alias("vs")).collect():
        exp = np.quantile(np.array(vals), [0.0, 0.25, 0.9])
        assert np.allclose(q[g], exp)


def sequential_holdout(rows, rate=10):
    """The reference's scan: rows in shuffle order; valid while the label has
    quota and the id is not yet in valid."""
    from collections import Counter
    cnt = Counter(r["label_id"] for r in rows)
    quota = {k: v // rate for k, v in cnt.items()}
    val_ids, part = set(), {}
    for r in sorted(rows, key=lambda r: r["key"]):
        if quota[r["label_id"]] > 0 and r["id"] not in val_ids:
            quota[r["label_id"]] -= 1
            val_ids.add(r["id"])
            part[(r["id"], r["variant"])] = "valid"
        else:
            part[(r["id"], r["variant"])] = "train"
    return part


def test_holdout_equals_sequential_scan(spark):
    aug = Q._augmented_raw(spark, SF_MID)
    keyed = D.shuffle_key(aug).select("id", "variant", "label_id", "key").collect()
    exp = sequential_holdout([r.asDict() for r in keyed])
    got = {(r.id, r.variant): r.part for r in D.holdout(aug).select("id", "variant", "part").collect()}
    assert got == exp
    safe = D.holdout(aug, group_safe=True).select("id", "part").collect()
    valid = {r.id for r in safe if r.part == "valid"}
    train = {r.id for r in safe if r.part == "train"}
    assert not (valid & train)


def test_partition_independence(spark):
    aug = Q._augmented_raw(spark, SF_MID)
    base = sorted(D.holdout(aug).select("id", "variant", "part").collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted(D.holdout(aug.repartition(5)).select("id", "variant", "part").collect()) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_hot_group_is_split_over_buckets(spark):
    """A group holding ~40% of the rows is processed in many (group, bucket)
    pieces: no piece holds more than a few percent of that group."""
    df = skewed(spark, 20000)
    nb = 64
    b = S.hash_bucket(F.conv(F.substring(F.md5(F.col("o").cast("string")), 1, 8), 16, 10).cast("bigint"), nb)
    sizes = df.where(F.col("g") == "hot").groupBy(b.alias("b")).count().collect()
    hot = sum(r["count"] for r in sizes)
    assert len(sizes) >= nb * 0.9
    assert max(r["count"] for r in sizes) < 0.05 * hot


def test_an_outlier_does_not_fill_a_bucket(spark):
    rnd = random.Random(3)
    rows = [("hot", i, rnd.random()) for i in range(20000)] + [("hot", 20001, 1e12), ("hot", 20002, -1e12)] + [(None, i, 0.5 * i) for i in range(50)]
    r = S.ranged(spark.createDataFrame(rows, "g string, o long, v double"), ["g"], [F.col("v")])
    sizes = [x["count"] for x in r.groupBy(S.BUCKET).count().collect()]
    assert max(sizes) < 0.05 * len(rows)
    assert r.groupBy("g", S.BUCKET).agg(F.min("v").alias("a"), F.max("v").alias("b")).count() <= len(sizes) + 1  # ranges of (g, v)


def test_quantiles_of_null_groups_outliers_and_ties(spark):
    import numpy as np
    vals = {None: [1.0, 2.0, 2.0, 10.0], "a": [5.0] * 1000 + [1e12], "b": [None, None], "c": [3.0, None, 4.0]}
    df = spark.createDataFrame([(g, v) for g, vs in vals.items() for v in vs], "g string, v double")
    got = {r.g: (r.lo, r.mid) for r in S.quantiles(df, ["g"], "v", [0.1, 0.5], ["lo", "mid"]).collect()}
    assert got == {g: tuple(np.quantile([v for v in vs if v is not None], [0.1, 0.5])) for g, vs in vals.items() if g != "b"}


def test_holdout_with_mixed_labels_equals_the_scan(spark):
    for seed, labels, ids, rate in ((1, 3, 40, 2), (2, 5, 300, 3), (3, 2, 25, 1), (4, 8, 120, 10)):
        rnd = random.Random(seed)
        # labels of very different size, so that quotas fill early for some
        rows = sorted({(rnd.randrange(ids), v): min(rnd.randrange(labels), rnd.randrange(labels)) for _ in range(4 * ids) for v in (rnd.randrange(6),)}.items())
        df = spark.createDataFrame([(i, v, lab) for (i, v), lab in rows], "id long, variant int, label_id int")
        keyed = [r.asDict() for r in D.shuffle_key(df).collect()]
        got = {(r.id, r.variant): r.part for r in D.holdout(df, rate=rate).collect()}
        assert got == sequential_holdout(keyed, rate), seed


def test_holdout_of_null_labels_and_empty_input(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, 2), (2, 0, 2), (3, 0, 2)], "id long, variant int, label_id int")
    got = {(r.id, r.variant): r.part for r in D.holdout(df, rate=1).collect()}
    assert got[1, 0] == "train" and sorted(got.values()) == ["train", "valid", "valid", "valid"]
    assert D.holdout(df.limit(0)).collect() == []
