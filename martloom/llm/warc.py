"""A deterministic, sharded WARC writer and its reader.

Pages are sorted by (page_id, payload digest) and cut into shards by their running payload
bytes, so the shards depend on the pages alone. A shard is written by one task as files that
roll at a compressed size. Tasks write under temporary names of their own and report them; the
files of the attempts that counted are then renamed, and the manifest is written last. A
reader reads what the manifest lists.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import bytes_of, free_shuffles, join_by_size
from martloom.llm.files import join, opened
from martloom.session import stage

LEAST = 100  # bytes of a payload that others may refer to
SHARD_BYTES = 32 << 20  # payload bytes of a shard
SHARDS = 50_000  # at most: beyond SHARD_BYTES * SHARDS the shards grow
ROLL_BYTES = 16 << 20  # compressed bytes after which a file ends
SLICE = 8 << 10  # compressed bytes that a reader unpacks at once
DATE = "2000-01-01T00:00:00Z"  # of all records: the pages have none, and the output is to be the same each time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, seq int, temp string, name string, bytes long, records long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16], version=5)}>"


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A WARC record as a gzip member of its own; headers without a value are left out."""
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, html: bytes, sha: str, refers_to: int | None, is_revisit: bool, copy: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    block = http if is_revisit else http + html
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, sha, copy)),
        ("WARC-Date", DATE),
        # control characters would break the header
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Profile", PROFILE if is_revisit else None),
        ("WARC-Refers-To", record_id(refers_to, sha, 0) if is_revisit else None),
        ("X-Refers-To-Page", refers_to if is_revisit else None),
        ("X-Page", page_id),
        ("X-Payload-Length", len(html)),
        ("WARC-Payload-Digest", f"sha256:{sha}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(fields, block)


def digests(pages: DataFrame, id_col: str, text_col: str) -> DataFrame:
    html = bytes_of(text_col)
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha2(html, 256).alias("sha"), F.octet_length(html).cast("long").alias("n"))


def shard_starts(found: DataFrame, shard_bytes: int) -> tuple[list[tuple], int]:
    """The first (no id, page_id, sha) of every shard but the first, by running payload bytes.

    Spark's range sort gives parts of any extent; what counts is the running sum over all of
    them, so the shards are the same each time. The driver gets one row per part and per shard.
    """
    order = [F.col("page_id").isNull(), "page_id", "sha"]
    ranged = found.repartitionByRange(*[F.col(c) if isinstance(c, str) else c for c in order]).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "warc-ranges")
    sums = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    total, before = 0, []
    for part in sorted(sums):
        before.append((part, total))
        total += sums[part]
    size = max(shard_bytes, -(-total // SHARDS), 1)
    offsets = found.sparkSession.createDataFrame(before or [(0, 0)], "part int, before long")
    running = F.sum("n").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    placed = ranged.withColumn("running", running).join(F.broadcast(offsets), "part")
    placed = placed.withColumn("shard", F.floor((F.col("before") + F.col("running")) / F.lit(size)))
    key = F.struct(F.col("page_id").isNull().alias("no_id"), F.coalesce("page_id", F.lit(0)).alias("page_id"), "sha")
    starts = placed.groupBy("shard").agg(F.min(key).alias("key")).orderBy("shard").collect()
    return [tuple(r["key"]) for r in starts][1:], total


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write one record per page under ``folder`` and return the manifest, which is written there last.

    The payload is the html in UTF-8, null counting as empty. Of records with equal payloads of
    LEAST bytes at least, that with the smallest page_id (null last) is a response, the others are
    revisits of it; of repeated rows the first counts. Other columns are not read. An empty
    table gives an empty manifest.
    """
    spark = pages.sparkSession
    found = stage(digests(pages, id_col, text_col), "warc-digests")
    large = found.filter(F.col("n") >= LEAST)
    first = large.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    first = stage(first, "warc-first")
    # the pages that refer to another: one row per page and payload, however often repeated
    refs = join_by_size(large, first, "sha", "copies", found.count()).filter(F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    refs = refs.select("page_id", "sha", "first").distinct()
    starts, _ = shard_starts(found, shard_bytes)
    shared = spark.sparkContext.broadcast(starts)

    @F.pandas_udf("int")
    def shard_of(page: pd.Series, sha: pd.Series) -> pd.Series:
        keys = zip(page.isna(), page.fillna(0).astype("int64"), sha)
        return pd.Series([bisect.bisect_right(shared.value, (bool(a), int(b), c)) for a, b, c in keys], dtype="int32")

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.sha2(bytes_of(text_col), 256).alias("sha"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("first"),
        F.col(url_col).cast("string").alias("url"),
        bytes_of(text_col).alias("html"),
    )
    notes = refs.select("page_id", "sha", F.lit(0).alias("kind"), "first", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("html"))
    # ids above 2**53 would lose digits on their way through pandas as floats where some are null
    page = F.coalesce("page_id", F.lit(0).cast("long"))
    both = rows.unionByName(notes)
    both = both.withColumn("shard", F.when(F.col("page_id").isNull(), shard_of(F.lit(None).cast("double"), "sha")).otherwise(shard_of(page, "sha")))
    dealt = both.repartitionById(len(starts) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("page_id").isNull(), "page_id", "sha", "kind")
    manifest = stage(dealt.mapInArrow(shard_writer(folder, roll_bytes), MANIFEST), "warc-written")
    free_shuffles(spark)
    manifest.mapInArrow(renamer(folder), MANIFEST).write.parquet(join(folder, "manifest"))
    return spark.read.parquet(join(folder, "manifest"))


def shard_writer(folder: str, roll_bytes: int):
    """Writes the sorted rows of shards; a note (kind 0) comes right before the page that it is about."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        system.create_dir(join(root, "_temporary"), recursive=True)
        out, done, last, copy, note = None, [], None, 0, None

        def close() -> None:
            nonlocal out
            if out:
                out["stream"].close()
                done.append(out)
                out = None

        def add(shard: int, data: bytes) -> None:
            nonlocal out
            if out is None:
                seq = sum(d["shard"] == shard for d in done)
                name = f"part-{shard:06d}-{seq:04d}.warc.gz"
                temp = f"{name}.{uuid.uuid4().hex}"
                out = {"shard": shard, "seq": seq, "temp": temp, "name": name, "bytes": 0, "records": 0, "sha": hashlib.sha256()}
                out["stream"] = system.open_output_stream(join(root, "_temporary", temp))
                add(shard, record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name)), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n"))
                out["records"] = 0
            out["stream"].write(data)
            out["bytes"] += len(data)
            out["records"] += 1
            out["sha"].update(data)
            if out["bytes"] >= roll_bytes and out["records"] > 0 and data is not None:
                close()

        now = None
        for batch in batches:
            columns = [batch.column(k) for k in ("page_id", "sha", "kind", "first", "url", "html", "shard")]
            for i in range(batch.num_rows):
                page, sha, kind, first, url, html, shard = (c[i].as_py() for c in columns)
                if shard != now:
                    close()
                    now = shard
                key = (page, sha)
                if key != last:
                    last, copy, note = key, 0, None
                if kind == 0:
                    note = (first,)
                    continue
                revisit = len(html) >= LEAST and (note is not None or copy > 0)
                add(shard, page_record(page, url, html, sha, (note[0] if note else page) if revisit else None, revisit, copy))
                copy += 1
        close()
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for d in done:
            d["sha256"] = d["sha"].hexdigest()
        yield pa.RecordBatch.from_arrays([pa.array([d[n] for d in done], k) for n, k in zip(names, kinds)], names)

    return run


def renamer(folder: str):
    """Gives written files their names; a repeated task finds them renamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        system, root = opened(folder)
        for batch in batches:
            for temp, name in zip(batch.column("temp").to_pylist(), batch.column("name").to_pylist()):
                source = join(root, "_temporary", temp)
                if system.get_file_info(source).type != pafs.FileType.NotFound:
                    system.move(source, join(root, name))
            yield batch

    return run


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, fed in slices: what was fed past the end of a member is copied each time."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack, out = zlib.decompressobj(31), []
        while at < len(view) and not unpack.eof:
            piece = view[at : at + SLICE]
            out.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
        out.append(unpack.flush())
        if not unpack.eof:
            raise ValueError("a gzip member is cut off")
        yield b"".join(out)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the length of a block is wrong")
    return fields, rest[:size]


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The page records of the files that the manifest lists, their digests and the files' checked.

    Columns: page_id, url, payload_bytes and payload_digest (of the full payload, also for
    revisits), record_type, refers_to, payload (null for revisits).
    """
    manifest = spark.read.parquet(join(folder, "manifest"))
    files = manifest.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        for batch in batches:
            for name, sha in zip(batch.column("name").to_pylist(), batch.column("sha256").to_pylist()):
                with system.open_input_stream(join(root, name), compression=None) as stream:
                    data = stream.read()
                if hashlib.sha256(data).hexdigest() != sha:
                    raise ValueError(f"{name} is not the file that was written")
                rows: list[tuple] = []
                size = 0
                for raw in members(data):
                    fields, block = parse(raw)
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    if f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["WARC-Block-Digest"]:
                        raise ValueError(f"{name}: the block of {fields['WARC-Record-ID']} has another digest")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    payload = None
                    if fields["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: the payload of {fields['WARC-Record-ID']} has another digest")
                    number = lambda key: int(fields[key]) if key in fields else None
                    rows.append((number("X-Page"), fields.get("WARC-Target-URI"), number("X-Payload-Length"), digest, fields["WARC-Type"], number("X-Refers-To-Page"), payload))
                    size += len(payload or b"")
                    if size > 8 << 20:
                        yield record_batch(rows)
                        rows, size = [], 0
                yield record_batch(rows)

    return manifest.select("name", "sha256").repartition(max(1, files)).mapInArrow(run, RECORDS)


def record_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(7)], names)
