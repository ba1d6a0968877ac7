import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.operators import analysis as EA
from sentrel.schema import RAW_SCHEMA
from sentrel.session import scratch_path
from sentrel.sources.files import corrupt_rows, load_catalog, put, read_catalog, read_re_csv, stamp, write_csv
from tests.test_spans import ROWS


def test_csv_roundtrip_with_quotes_and_newlines(spark):
    rows = [(1, 'he said "hi",\nthen left', "{'word': 'he', 'start_idx': 0, 'end_idx': 1, 'type': 'PER'}",
             "{'word': 'hi', 'start_idx': 9, 'end_idx': 10, 'type': 'POH'}", "no_relation", "s")]
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame(rows, RAW_SCHEMA), path)
    back = read_re_csv(spark, path).collect()
    assert [tuple(r) for r in back] == rows


def test_csv_columns_go_by_name_and_bad_rows_to_quarantine(spark, tmp_path):
    f = tmp_path / "mixed.csv"
    f.write_text("label,source,id,sentence,subject_entity,object_entity\nno_relation,s,7,text,a,b\nno_relation,s,x,text,a,b\n")
    assert [tuple(r) for r in read_re_csv(spark, str(f)).collect()] == [(7, "text", "a", "b", "no_relation", "s")]
    bad = corrupt_rows(spark, str(f)).collect()
    assert len(bad) == 1 and "x,text" in bad[0]["_corrupt_record"]
    assert read_re_csv(spark, str(f), multi_line=False).count() == 1


def test_csv_index_column_dropped(spark):
    path = scratch_path(spark, "csv-idx")
    df = spark.createDataFrame(ROWS, RAW_SCHEMA)
    write_csv(df.select(F.monotonically_increasing_id().alias("_index"), *df.columns), path)
    back = read_re_csv(spark, path)
    assert back.columns == [f.name for f in RAW_SCHEMA.fields]
    assert sorted(r.id for r in back.collect()) == sorted(r[0] for r in ROWS)


def test_catalog_from_file_names(spark):
    d = scratch_path(spark, "cat")
    os.makedirs(d)
    for name, n in (("model_a", 2), ("model_b", 3)):
        with open(os.path.join(d, f"{name}.csv"), "w") as f:
            f.write("id,score\n" + "".join(f"{i},{i / 10}\n" for i in range(n)))
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("not a table\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("score", T.DoubleType())])
    cat = load_catalog(spark, d, schema, name_from="file")
    got = {r.dataset: r.n for r in cat.groupBy("dataset").agg(F.count("*").alias("n")).collect()}
    assert got == {"model_a": 2, "model_b": 3}


def test_put_replaces_a_dataset_by_its_file_name(spark, tmp_path):
    catalog, schema = scratch_path(spark, "catalog"), T.StructType.fromDDL("id bigint, score double")
    for folder, name, text in (("a", "m 1", "id,score\n1,0.5\n2,0.25\n"), ("a", "7", "id,score\n3,1\n"), ("b", "m 1", "score,id,other\n9,10,x\nbad,11,x\n")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"{name}.csv").write_text(text)
    (tmp_path / "a" / "notes.txt").write_text("no table\n")
    assert put(spark, catalog, f"{tmp_path}/a/*.csv", schema).collect() == []
    assert sorted(map(tuple, read_catalog(spark, catalog, schema).select("dataset", "id", "score").collect())) == [("7", 3, 1.0), ("m 1", 1, 0.5), ("m 1", 2, 0.25)]
    bad = put(spark, catalog, f"{tmp_path}/b/m 1.csv", schema).collect()
    assert [r.dataset for r in bad] == ["m 1"] and "bad,11" in bad[0]["_corrupt_record"]
    assert sorted(map(tuple, read_catalog(spark, catalog, schema).select("dataset", "id", "score").collect())) == [("7", 3, 1.0), ("m 1", 10, 9.0)]


def test_stamp_is_kst(spark):
    df = spark.createDataFrame([("2024-01-31 20:15:30",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert df.select(stamp("t").alias("s")).collect()[0].s == "240201-05:15:30"


def test_bucketize_null_and_edges(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 0.0), ("a", 3, 1.0), ("a", 4, 2.0), ("a", 5, 5.0)],
                               "dataset string, id int, x double")
    th = EA.thresholds(df, "x", [1.0, 2.0])
    got = {r.id: r.bucket for r in EA.bucketize(df, "x", th).collect()}
    assert got == {1: None, 2: 0, 3: 1, 4: 2, 5: 2}
    labels = [r.label for r in EA.bucket_labels(th).orderBy("bucket").collect()]
    assert labels == ["~1.00", "1.00", "2.00"]


def test_group_stats_keeps_absent_classes(spark):
    df = spark.createDataFrame([("m", 1, 0.5), ("m", 1, 0.7), ("m", 3, 0.1)],
                               "dataset string, num_label int, label_confidence double")
    g = {r.class_id: (r["count"], r.class_name) for r in EA.group_stats(df).collect()}
    assert len(g) == 30 and g[1][0] == 2 and g[0] == (0, "no_relation") and g[29][1] == "per:religion"


def test_filter_by_reference(spark):
    df = spark.createDataFrame([("m0", 1, "per:title"), ("m1", 1, "org:members"), ("m0", 2, "org:x"),
                                ("m1", 2, "per:spouse")], "dataset string, id int, pred string")
    assert {(r.dataset, r.id) for r in EA.filter_contains(df, "pred", "^per:", ref="m1").collect()} == {
        ("m0", 2), ("m1", 2)}
    assert {(r.dataset, r.id) for r in EA.filter_contains(df, "pred", "^per:").collect()} == {("m0", 1), ("m1", 2)}
