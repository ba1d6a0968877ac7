import os

from sentrel.schema import RAW_SCHEMA
from sentrel.session import scratch_path
from sentrel.sources.files import write_csv
from sentrel.streaming.marking import mark_stream
from tests.test_spans import ROWS


def test_mark_stream_available_now(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("src", "sink", "ck"))
    write_csv(spark.createDataFrame(ROWS, RAW_SCHEMA), os.path.join(src, "batch1"))
    q = mark_stream(spark, os.path.join(src, "batch1"), sink, ck, available_now=True)
    q.awaitTermination(120)
    out = {r.id: r.sentence for r in spark.read.parquet(sink).collect()}
    assert out[1] == "@*사람*Kim@ met Lee in #^장소^Seoul#"
    assert set(out) == {1, 2, 3, 4}
