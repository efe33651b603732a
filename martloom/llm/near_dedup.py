"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature has POSITIONS numbers of BITS bits; two texts of shingle similarity s differ in
about (1 - s) of them. The positions are cut into chunks, more for a lower similarity. Signatures that differ in at
most chunks * (ERRORS + 1) - 1 positions have a chunk with at most ERRORS differing
positions (pigeonhole), so every signature enters one bucket for each chunk and each choice
of ERRORS positions left out of it, and all such pairs share a bucket.

What follows keeps all links of such pairs without listing the pairs of a bucket. Buckets
give candidate clusters: members are tied to the smallest of their bucket where the
signatures are within the distance; buckets that this leaves in several clusters are compared
signature by signature in blocks. Then each cluster is compared on full shingle sets, block
against block, and a task returns only links between parts that it has not yet joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bytes_of, free_shuffles, join_by_size, perhaps_in, row_key
from martloom.llm.components import components
from martloom.llm.shingles import SHINGLE, WordHashes, mix, shingle_set
from martloom.session import stage

POSITIONS = 96
BITS = 16
CHUNKS = {85: 16, 80: 20}  # by the least percent that they serve
ERRORS = 1
SIGNATURES = 1024  # signatures compared at once
BLOCK = 128  # texts compared at once
BLOCK_SHINGLES = 200_000  # and about so many shingles

_SEEDS = mix(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def chunks_of(percent: int) -> int:
    """Chunks for a similarity: at its least one, few pairs differ in more than the distance (5.9e-6 at 85, 1.1e-06 at 80)."""
    served = [least for least in CHUNKS if least <= percent]
    if not served:
        raise ValueError(f"percent below {min(CHUNKS)} needs longer signatures")
    return CHUNKS[max(served)]


def distance_of(chunks: int) -> int:
    """Signatures that differ in no more positions share a bucket: 31 for 16 chunks, 39 for 20."""
    return chunks * (ERRORS + 1) - 1


def kept_of(chunks: int) -> list[np.ndarray]:
    """For every bucket of a signature: the positions that its key reads."""
    return [np.setdiff1d(group, out) for group in np.array_split(np.arange(POSITIONS), chunks) for out in combinations(group, ERRORS)]


DISTANCE = distance_of(CHUNKS[85])
_KEPT = kept_of(CHUNKS[85])


def signature(shingles: np.ndarray) -> np.ndarray:
    """POSITIONS minima of the shingles under different hashes, BITS bits of each."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048, None] ^ _SEEDS[None]
        least = np.minimum(least, (part * np.uint64(0xD6E8FEB86659FD93)).min(0))
    return (mix(least) >> np.uint64(64 - BITS)).astype(np.uint16)


def bucket_keys(signatures: np.ndarray, positions: list[np.ndarray] = _KEPT) -> np.ndarray:
    """Bucket keys, one row for each signature."""
    wide = signatures.astype(np.uint64)
    keys = np.empty((len(wide), len(positions)), np.uint64)
    for k, kept in enumerate(positions):
        key = np.full(len(wide), k + 1, np.uint64)
        for position in kept:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, position])
        keys[:, k] = key
    return keys.view(np.int64)


def set_hash(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id, k1, k2, n (shingles), set_hash (of the sorted shingles) and sig of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            counts, hashes, sigs = [], [], []
            for data in batch.column("data").to_pylist():
                found = shingle_set(data, memo)
                counts.append(len(found))
                hashes.append(set_hash(found))
                sigs.append(signature(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("k1"), batch.column("k2"), pa.array(counts, pa.int64()), pa.array(hashes, pa.binary()), pa.array(sigs, pa.binary())],
                ["row", "id", "k1", "k2", "n", "set_hash", "sig"],
            )

    kind = dict(docs.dtypes)[id_col]
    row = F.monotonically_increasing_id()
    base = docs.select(row.alias("row"), F.col(id_col).alias("id"), *row_key(id_col, text_col), bytes_of(text_col).alias("data"))
    return base.mapInArrow(run, f"row long, id {kind}, k1 long, k2 int, n long, set_hash binary, sig binary")


def index_rows(classes: DataFrame, chunks: int) -> DataFrame:
    """key, c for every bucket of every class."""
    positions = kept_of(chunks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                sigs = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(-1, POSITIONS)
                keys = bucket_keys(sigs, positions)
                owner = np.repeat(part.column("c").to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(owner)], ["key", "c"])

    return classes.select("c", "sig").mapInArrow(run, "key long, c long")


def close_pairs(pairs: DataFrame, distance: int) -> DataFrame:
    """Of a, b, sig_a, sig_b the pairs within the distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = np.frombuffer(b"".join(batch.column("sig_a").to_pylist()), np.uint16).reshape(-1, POSITIONS)
            right = np.frombuffer(b"".join(batch.column("sig_b").to_pylist()), np.uint16).reshape(-1, POSITIONS)
            good = pa.array((left != right).sum(1) <= distance)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


class Parts:
    """Union-find over small integers."""

    def __init__(self, labels: np.ndarray):
        self.up = list(range(len(labels)))
        first: dict = {}
        for i, label in enumerate(labels.tolist()):
            if first.setdefault(label, i) != i:
                self.join(first[label], i)

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def runs_of(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``by`` columns as one table each, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in by]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            key = tuple(c[start] for c in columns)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def blocked(members: DataFrame, group: str, blocks: str) -> DataFrame:
    """Members once for every pair of blocks of their group that has theirs.

    Each member has ``blocks``, the number of blocks of its group; its block is a hash of
    ``c``. A pair of blocks meets in one task, so a large group spreads over many.
    """
    n = F.col(blocks)
    mine = F.pmod(F.xxhash64(F.lit("block"), "c"), n)
    other = F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    out = members.withColumn("_mine", mine).withColumn("_other", other)
    return out.withColumn("lo", F.least("_mine", "_other")).withColumn("hi", F.greatest("_mine", "_other")).drop("_other")


def crossing(table: pa.Table) -> np.ndarray:
    """Which pairs a block pair has to compare: different blocks, or all if it is one block."""
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    mine = table.column("_mine").to_numpy()
    return np.ones((len(mine), len(mine)), bool) if lo == hi else mine[:, None] != mine[None]


def mixed_bucket_edges(rows: DataFrame, distance: int) -> DataFrame:
    """Edges between clusters in buckets that have several: key, lo, hi, _mine, c, part, sig, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, ["key", "lo", "hi"]):
            if table.num_rows < 2:
                continue
            c = table.column("c").to_numpy()
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, POSITIONS)
            part = table.column("part").to_numpy()
            parts, compare = Parts(part), crossing(table)
            a, b = [], []
            for i in range(len(c) - 1):
                good = compare[i, i + 1 :] & (part[i + 1 :] != part[i])
                near = np.flatnonzero(good)
                if not len(near):
                    continue
                near = near[(sig[i + 1 + near] != sig[i]).sum(1) <= distance]
                for j in near.tolist():
                    if parts.join(i, i + 1 + j):
                        a.append(int(c[i]))
                        b.append(int(c[i + 1 + j]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def confirmed_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links on full sets within blocks: cluster, lo, hi, _mine, c, set_hash, data, sorted by the first three.

    A link joins texts with 100 * intersection >= percent * union. Of a block pair's links
    those are returned that join parts not joined by the others, which suffices for its components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for table in runs_of(batches, ["cluster", "lo", "hi"]):
            sets, at, seen = [], [], set()
            known = zip(table.column("c").to_pylist(), table.column("set_hash").to_pylist(), table.column("data"))
            for i, (name, expected, data) in enumerate(known):
                if name not in seen:  # repeated rows, and rows whose key only collides, drop out
                    found = shingle_set(data.as_py(), memo)
                    if set_hash(found) == expected:
                        seen.add(name)
                        sets.append(found)
                        at.append(i)
            table = table.take(at)
            if table.num_rows < 2:
                continue
            c = table.column("c").to_numpy()
            size = np.array([len(s) for s in sets])
            starts = np.concatenate(([0], np.cumsum(size)[:-1]))
            distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
            parts, compare = Parts(np.arange(len(c))), crossing(table)
            mark = np.zeros(len(distinct), np.int32)
            a, b = [], []
            for i in range(len(c) - 1):
                fits = compare[i] & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
                fits[: i + 1] = False
                if not fits.any():
                    continue
                mine = flat[starts[i] : starts[i] + size[i]]
                mark[mine] = 1
                common = np.add.reduceat(mark[flat], starts)
                mark[mine] = 0
                linked = fits & (100 * common >= percent * (size + size[i] - common))
                for j in np.flatnonzero(linked).tolist():
                    if parts.join(i, j):
                        a.append(int(c[i]))
                        b.append(int(c[j]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
) -> DataFrame:
    """One row per document: its group of documents linked by near-equal shingle sets.

    Sets are the distinct shingles of 5 words (see ``shingle_set``). Two documents are linked
    if 100 * intersection >= percent * union, confirmed on the full sets; percent must be 80 at
    least, for which the signatures are laid out. Documents without words have no links; their
    null or empty texts count 0 shingles. Repeated rows are linked with each other unless
    empty. An empty table gives no rows; other columns are not read; the ids must not be null
    for rows to be grouped by the smallest id, null ids come last. Columns: id_col, n_shingles,
    component_id, kept (the row is its group's first), and the row's key k1, k2.
    """
    chunks = chunks_of(percent)
    distance = distance_of(chunks)
    spark = docs.sparkSession
    base = stage(signatures(docs, id_col, text_col), "signatures")
    # texts of one set are one class, named by its smallest row number
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "k1")
    classes = stage(
        base.filter("n > 0")
        .groupBy("set_hash", "n")
        .agg(F.min("row").alias("c"), F.min(order).alias("first"), F.count("*").alias("members"), F.first("sig").alias("sig")),
        "classes",
    )
    keys = index_rows(classes, chunks)
    shared = keys.groupBy("key").agg(F.min("c").alias("least"), F.count("*").alias("size")).filter("size > 1")
    buckets = stage(keys.join(shared, "key"), "buckets")
    sig = classes.select("c", "sig")
    stars = buckets.filter("c <> least").select(F.col("least").alias("a"), F.col("c").alias("b")).distinct()
    pairs = stars.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
    tied = stage(close_pairs(pairs, distance), "tied")
    part = components(tied)
    named = buckets.join(part.toDF("c", "root"), "c", "left").withColumn("part", F.coalesce("root", "c")).drop("root")
    mixed = named.groupBy("key").agg(F.min("part").alias("p0"), F.max("part").alias("p1")).filter("p0 <> p1").select("key")
    rows = named.join(mixed, "key").select("key", "c", "part", F.ceil(F.col("size") / SIGNATURES).alias("blocks")).join(sig, "c")
    rows = blocked(rows, "key", "blocks").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    more = stage(mixed_bucket_edges(rows.select("key", "lo", "hi", "_mine", "c", "part", "sig"), distance), "mixed-edges")
    if not more.isEmpty():
        part = components(tied.union(more))
    free_shuffles(spark)

    sized = part.toDF("c", "cluster").join(classes.select("c", "n", "set_hash", F.col("first.k1").alias("k1")), "c")
    spans = sized.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    )
    members = stage(sized.join(spans, "cluster"), "members")
    texts = docs.select(row_key(id_col, text_col)[0], bytes_of(text_col).alias("data"))
    texts = perhaps_in(texts, members, "k1")
    rows = blocked(texts.join(members, "k1"), "cluster", "blocks")
    rows = rows.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi")
    links = stage(confirmed_links(rows.select("cluster", "lo", "hi", "_mine", "c", "set_hash", "data"), percent), "links")
    free_shuffles(spark)
    linked = components(links).toDF("c", "root")

    joined = classes.join(linked, "c", "left").withColumn("root", F.coalesce("root", "c"))
    groups = joined.groupBy("root").agg(F.min("first").alias("first"))
    found = stage(joined.drop("first").join(groups, "root").select("set_hash", "first", "members").filter("members > 0"), "class-groups")
    told = join_by_size(base.drop("sig"), found, "set_hash", "members", base.count())
    grouped = F.col("first").isNotNull() & (F.col("n") > 0)
    return told.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(grouped, F.col("first.id")).otherwise(F.col("id")).alias("component_id"),
        F.when(grouped, F.col("first.row") == F.col("row")).otherwise(True).alias("kept"),
        "k1",
        "k2",
    )
