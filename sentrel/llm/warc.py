"""Operator 7, a deterministic sharded WARC writer, and its reader.

Records are sorted by id: a range sort gives running sums of payload bytes over
the whole table, and these (not Spark's sampled ranges) cut it into shards, so
shards are the same in every run. Each shard is written in id order into files
that roll over by compressed size; each record is a gzip member with freshly made
headers, block and payload digests. A file is written under a temporary name in
the target folder and moved to its final, deterministic name: a task that
runs twice leaves the same files. The run is committed by a manifest (a Parquet
table with each file's name, records, bytes and SHA-256); readers read what it lists.

Equal payloads (by SHA-256) of at least ``min_bytes``: the smallest id is written in full
(response), the others as revisits that refer to it and carry no payload.

Defined results: a null payload is empty. A null id is sorted last and refers
to, but is never referred to unless all ids of its payload are null (then all
are responses). Rows with the smallest id and the same payload are all responses.
Control characters and spaces in a URL are percent-encoded; a null URL has no header.
An empty table gives an empty manifest. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sentrel.llm.shared import small, spread, text_of, written
from sentrel.session import scratch_path

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard bigint, records bigint, bytes bigint, sha256 string"
RECORD = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
          "computed_digest string, payload binary")


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_url: str | None = None) -> bytes:
    """One WARC record; a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest32(payload)}", f"WARC-Block-Digest: sha1:{digest32(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(data: bytes):
    """Rows of ``RECORD`` of one archive file."""
    f = gzip.GzipFile(fileobj=io.BytesIO(data))
    while line := f.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := f.readline()).strip():
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
        block = f.read(int(head["content-length"]))
        if f.read(4) != b"\r\n\r\n" or "sha1:" + digest32(block) != head["warc-block-digest"]:
            raise ValueError(f"damaged record {head['warc-record-id']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
        full = head["warc-type"] == "response"
        ids = [re.fullmatch(r"<urn:page:(none|-?\d+)>", head[k])[1] if k in head else "none" for k in ("warc-record-id", "warc-refers-to")]
        page_id, refers_to = (None if x == "none" else int(x) for x in ids)
        yield (page_id, head.get("warc-target-uri"), head["warc-type"], refers_to, length, head["warc-payload-digest"].removeprefix("sha1:"),
               digest32(payload) if full else None, payload if full else None)


def shard_bounds(pages: DataFrame, shard_bytes: int) -> list[int]:
    """Smallest id of each shard but the first, from running sums over ``(page_id, bytes)`` in id order."""
    at = F.monotonically_increasing_id()
    order = written(pages.repartitionByRange("page_id").sortWithinPartitions("page_id").withColumn("at", at)
                    .withColumn("part", F.shiftright("at", 33)), "order")
    parts = order.groupBy("part").agg(F.sum("bytes").alias("n")).select(  # a row per partition
        "part", (F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    run = F.sum("bytes").over(W.partitionBy("part").orderBy("at").rowsBetween(W.unboundedPreceding, 0))
    placed = order.withColumn("run", run).join(parts, "part")
    shard = F.floor((F.col("before") + F.col("run") - F.col("bytes")) / shard_bytes)
    first = placed.groupBy(shard.alias("shard")).agg(F.min("page_id").alias("first")).orderBy("shard").collect()  # a row per shard
    return [r["first"] for r in first[1:]]


def _writer(folder: str, file_bytes: int, level: int):
    def run(key, t):
        shard = key[0].as_py()
        fs, root = filesystem(folder)
        order = pc.sort_indices(t, sort_keys=[("page_id", "ascending"), ("sha", "ascending"), ("url", "ascending")], null_placement="at_end")
        out, pending, records = [], [], 0

        def roll():
            nonlocal pending, records
            data = b"".join(pending)
            name = f"shard-{shard:08d}-{len(out):06d}.warc.gz"
            temporary = f"{root}/_temporary/{name}.{uuid.uuid4().hex}"
            fs.create_dir(f"{root}/_temporary", recursive=True)
            with fs.open_output_stream(temporary, compression=None) as f:
                f.write(data)
            fs.move(temporary, f"{root}/{name}")
            out.append((name, shard, records, len(data), hashlib.sha256(data).hexdigest()))
            pending, records = [], 0

        size = 0
        for i in order.to_pylist():
            row = {c: t.column(c)[i].as_py() for c in ("page_id", "url", "refers_to", "payload")}
            member = gzip.compress(make_record(row["page_id"], row["url"], row["payload"].encode(), row["refers_to"]), level, mtime=0)
            if pending and size + len(member) > file_bytes:
                roll()
                size = 0
            pending.append(member)
            records, size = records + 1, size + len(member)
        if pending:
            roll()
        return pa.table({n: pa.array([x[k] for x in out], pa.string() if n in ("file", "sha256") else pa.int64())
                         for k, n in enumerate(("file", "shard", "records", "bytes", "sha256"))})

    return run


def write_warc(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
               shard_bytes: int = 32_000_000, file_bytes: int = 8_000_000, level: int = 6, max_broadcast: int = 500_000) -> DataFrame:
    """Write the archive files and the manifest under ``folder`` (a URI that the
    driver and the executors share); returns the manifest."""
    spark = df.sparkSession
    pages = df.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(payload_col).alias("payload"))
    pages = pages.withColumn("sha", F.sha2("payload", 256))
    narrow = written(pages.select("page_id", "sha", F.octet_length("payload").cast("bigint").alias("bytes")), "payloads")
    groups = narrow.where(F.col("bytes") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = narrow.join(groups, "sha").where("page_id is null or page_id > refers_to").where("refers_to is not null")
    again = small(written(again.select(F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), "refers_to").distinct(), "revisits"), max_broadcast)

    total = narrow.agg(F.sum(F.col("bytes") + 500)).first()[0] or 0
    wanted = spread(spark, total, shard_bytes)
    bounds = np.array(shard_bounds(narrow.select("page_id", (F.col("bytes") + 500).alias("bytes")).where("page_id is not null"), max(1, -(-total // wanted))), np.int64)

    @F.pandas_udf(T.LongType())
    def shard_of(ids):
        import pandas as pd
        found = np.searchsorted(bounds, ids.fillna(0).astype(np.int64), side="right")
        return pd.Series(np.where(ids.isna(), len(bounds), found))

    rows = pages.join(again, pages["page_id"].eqNullSafe(F.col("_id")) & (pages["sha"] == F.col("_sha")), "left")
    rows = rows.select("page_id", "url", "payload", "sha", "refers_to").withColumn("shard", shard_of("page_id"))
    manifest = rows.repartition(wanted, "shard").groupBy("shard").applyInArrow(_writer(folder, file_bytes, level), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/_manifest")  # the commit
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _reader(with_payload: bool):
    def run(batches):
        for b in batches:
            for data, sha in zip(b.column("content").to_pylist(), b.column("sha256").to_pylist(), strict=True):
                if hashlib.sha256(data).hexdigest() != sha:
                    raise ValueError("an archive file differs from its manifest")
                names = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "computed_digest", "payload")
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
                rows = [r if with_payload else (*r[:-1], None) for r in read_records(data)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=list(names))
    return run


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of the files that the manifest under ``folder`` lists (columns of
    ``RECORD``); raises on damaged records, files that differ from the manifest, or listed files that are missing."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], RECORD)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))
    here = files.select("file").join(manifest.select("file"), "file").count()
    if here != manifest.count():
        raise ValueError("files of the manifest are missing")
    return files.join(F.broadcast(manifest.select("file", "sha256")) if here <= 100_000 else manifest.select("file", "sha256"), "file").mapInArrow(_reader(with_payload), RECORD)


def warc_round_trip(df: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write, read back, and check the payload digests that can be recomputed:
    one row per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_warc(df, folder, **options)
    ok = F.col("computed_digest").isNull() | (F.col("computed_digest") == F.col("payload_digest"))
    digest = F.when(ok, F.col("payload_digest")).otherwise(F.raise_error(F.lit("payload digest differs")).cast("string"))
    return read_warc(spark, folder).select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
