"""Removal of long repeated byte strings, by maximal repeats of an enhanced suffix array.

A byte goes if a string of LENGTH bytes covers it that also starts earlier (in a document of a
smaller id, or further left in the same one). The strings of LENGTH bytes are dealt by
content: each has one anchor, the leftmost smallest hash of its GRAM-byte pieces, so equal
strings have equal anchors at equal offsets, and consecutive strings mostly share theirs. A
segment is a run of strings with one anchor. Equal segments are found by hashes alone, first
within a task, then by anchor: all but the first go. What is left are first occurrences of
different segments around one anchor, mostly where a repeat begins or ends. Their bytes are
fetched and put into suffix arrays, whose maximal repeats give the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bytes_of, free_shuffles
from martloom.llm.shingles import mix
from martloom.llm.suffix_repeats import maximal_repeats
from martloom.session import stage

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1  # anchors that a string can have
HALF = (LENGTH - GRAM) // 2  # a string reaches this far left of its anchor, or right
CHUNK = 1 << 20  # bytes hashed at once
FLUSH = 24 << 20  # bytes of documents whose segments are compared within a task
SUFFIXES = 1 << 18  # bytes in one suffix array, about
GROUP = 2_000  # segments that share an anchor and one side of it, in one suffix array; more are split by string

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_NO_ID = np.iinfo(np.int64).max  # ids that are null come last


class Powers:
    """Powers of a base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            steps = np.full(n, _BASE)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps = np.full(n, _BACK)
            steps[0] = 1
            self.down = np.cumprod(steps)


def segments(data: np.ndarray, ends: np.ndarray, powers: Powers) -> dict[str, np.ndarray]:
    """Segments of joined documents; ``ends`` are the documents' ends in ``data``.

    lo and hi bound the starts of the strings, anchor is the anchor's place, a its hash, g the
    hash of the whole segment, lh and rh of the anchor with HALF bytes to its left and right.
    """
    n = len(data)
    none = {k: np.zeros(0, np.int64) for k in ("lo", "hi", "anchor", "a", "g", "lh", "rh")}
    if n < LENGTH:
        return none
    powers.reach(n + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers.up[:n])))

    def hashed(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((total[stop] - total[start]) * powers.down[start])

    gram = mix((total[GRAM:] - total[:-GRAM]) * powers.down[: n - GRAM + 1])
    least, width = gram, 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    windows = n - LENGTH + 1
    least = np.minimum(least[:windows], least[SPAN - width : SPAN - width + windows])
    # strings that would leave their document
    delta = np.zeros(n + 1, np.int32)
    starts = np.concatenate(([0], ends[:-1]))
    np.add.at(delta, np.maximum(starts, ends - LENGTH + 1), 1)
    np.add.at(delta, ends, -1)
    good = np.cumsum(delta)[:windows] == 0
    if not good.any():
        return none
    change = np.ones(windows, bool)
    change[1:] = (least[1:] != least[:-1]) | (good[1:] != good[:-1])
    edge = np.flatnonzero(change)
    stop = np.append(edge[1:], windows)
    keep = good[edge]
    lo, stop = edge[keep], stop[keep]
    out_lo, out_hi, out_at = [], [], []
    for _ in range(6):
        if not len(lo):
            break
        at = lo + np.argmax(gram[lo[:, None] + np.arange(SPAN)] == least[lo][:, None], 1)
        out_lo.append(lo)
        out_hi.append(np.minimum(stop, at + 1))
        out_at.append(at)
        rest = at + 1 < stop
        lo, stop = at[rest] + 1, stop[rest]
    for first, last in zip(lo.tolist(), stop.tolist()):  # periodic text: one smallest hash again and again
        at = first + np.flatnonzero(gram[first : last - 1 + SPAN] == least[first])
        begin = np.concatenate(([first], at[:-1] + 1))
        fits = begin < last
        out_lo.append(begin[fits])
        out_hi.append(np.minimum(at + 1, last)[fits])
        out_at.append(at[fits])
    lo, hi, at = np.concatenate(out_lo), np.concatenate(out_hi), np.concatenate(out_at)
    order = np.argsort(lo)
    lo, hi, at = lo[order], hi[order], at[order]
    whole = hashed(lo, hi + LENGTH - 1)
    shape = (at - lo).astype(np.uint64) * np.uint64(256) + (hi - lo).astype(np.uint64)
    return {
        "lo": lo,
        "hi": hi,
        "anchor": at,
        "a": gram[at].view(np.int64),
        "g": mix(whole + shape * np.uint64(0x632BE59BD9B4E019)).view(np.int64),
        "lh": (hashed(np.maximum(at - HALF, 0), at + GRAM) >> np.uint64(36)).view(np.int64),
        "rh": (hashed(at, np.minimum(at + GRAM + HALF, n)) >> np.uint64(36)).view(np.int64),
    }


# Rows of the first exchange: a segment (a, g, document, place = lo * 128 + strings - 1, sides =
# lh, rh and the anchor's offset), or bytes known to go (sides -1, place their start, g their number).
ROWS = "a long, g long, doc long, tkey long, place long, sides long"


def flush(docs: list[tuple[int, int, bytes]], powers: Powers) -> pa.RecordBatch:
    """Rows of some documents; segments that came before among them are bytes known to go."""
    docs = sorted({d[:2]: d for d in docs}.values(), key=lambda d: d[:2])  # of repeated rows one
    pieces: list[dict] = []
    owners, places = [], []

    def hash_now(group: list[tuple[int, int, np.ndarray]]) -> None:
        lengths = np.array([len(x[2]) for x in group])
        ends = np.cumsum(lengths)
        found = segments(np.concatenate([x[2] for x in group]), ends, powers)
        which = np.searchsorted(ends, found["lo"], "right")
        pieces.append(found)
        owners.append(np.array([x[0] for x in group])[which])
        places.append(found["lo"] - (ends - lengths)[which] + np.array([x[1] for x in group])[which])

    group, held = [], 0
    for d, (_, _, data) in enumerate(docs):
        whole = np.frombuffer(data, np.uint8)
        for start in range(0, max(1, len(whole) - LENGTH + 1), CHUNK):
            part = whole[start : start + CHUNK + LENGTH - 1]
            if group and held + len(part) > CHUNK:
                hash_now(group)
                group, held = [], 0
            group.append((d, start, part))
            held += len(part)
    if group:
        hash_now(group)
    found = {k: np.concatenate([p[k] for p in pieces]) for k in pieces[0]}
    owner, place = np.concatenate(owners), np.concatenate(places)
    order = np.lexsort((np.arange(len(owner)), found["g"], found["a"]))
    a, g = found["a"][order], found["g"][order]
    again = np.zeros(len(order), bool)
    again[order[1:]] = (a[1:] == a[:-1]) & (g[1:] == g[:-1])
    ids = np.array([d[0] for d in docs], np.int64)
    keys = np.array([d[1] for d in docs], np.int64)
    strings = found["hi"] - found["lo"]
    sides = (found["lh"] << 35) | (found["rh"] << 7) | (found["anchor"] - found["lo"])
    new = ~again
    rows = [found["a"][new], found["g"][new], ids[owner[new]], keys[owner[new]], place[new] * 128 + strings[new] - 1, sides[new]]
    # consecutive repeated segments of a document as one run of bytes
    o, lo, hi = owner[again], place[again], place[again] + strings[again] + LENGTH - 1
    if len(o):
        cut = np.ones(len(o), bool)
        cut[1:] = (o[1:] != o[:-1]) | (lo[1:] > hi[:-1])
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(o)) - 1
        gone = [mix(np.arange(len(first)).astype(np.uint64) + keys[o[first]].view(np.uint64)).view(np.int64), hi[last] - lo[first], ids[o[first]], keys[o[first]], lo[first], np.full(len(first), -1)]
        rows = [np.concatenate(pair) for pair in zip(rows, gone)]
    return pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], ["a", "g", "doc", "tkey", "place", "sides"])


def segment_rows(docs: DataFrame) -> DataFrame:
    """Of doc, tkey, data the rows described at ROWS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(), [], 0
        for batch in batches:
            for doc, key, data in zip(batch.column("doc").to_pylist(), batch.column("tkey").to_pylist(), batch.column("data")):
                data = data.as_py()
                if len(data) < LENGTH:
                    continue
                held.append((_NO_ID if doc is None else doc, key, data))
                size += len(data)
                if size >= FLUSH:
                    yield flush(held, powers)
                    held, size = [], 0
        if held:
            yield flush(held, powers)

    return docs.mapInArrow(run, ROWS)


# What the first exchange finds: bytes to go (h null), or segments to compare byte by byte.
FOUND = "doc long, tkey long, start long, stop long, a long, sides long"


def known_repeats(rows: DataFrame) -> DataFrame:
    """Rows sorted by a, g, doc, tkey, place: later equal segments go, first ones are compared if their anchor has others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before
        held = None  # the first segment of an anchor, not returned yet
        for batch in batches:
            if not batch.num_rows:
                continue
            a, g, doc, key, place, sides = (batch.column(k).to_numpy() for k in range(6))
            gone = sides == -1
            before = [np.concatenate(([x[0] if last is None else last[k]], x[:-1])) for k, x in enumerate((a, g, doc, key, place))]
            same_a = a == before[0]
            if last is None:
                same_a[0] = False
            same_g = same_a & (g == before[1])
            itself = same_g & (doc == before[2]) & (key == before[3]) & (place == before[4])
            last = (a[-1], g[-1], doc[-1], key[-1], place[-1])
            lo, strings = place >> 7, (place & 127) + 1
            later = same_g & ~itself & ~gone
            first = np.flatnonzero(~same_g & ~gone)
            rows = [(doc[gone], key[gone], place[gone], place[gone] + g[gone], None), (doc[later], key[later], lo[later], lo[later] + strings[later] + LENGTH - 1, None)]
            # first segments: with others of the anchor before or after them
            mine = [(a[first], sides[first], doc[first], key[first], lo[first], lo[first] + strings[first] + LENGTH - 1)]
            if held is not None:
                mine = [tuple(np.concatenate(([h], m)) for h, m in zip(held, mine[0]))]
            fa, fs, fd, fk, flo, fhi = mine[0]
            if len(fa):
                shared = np.zeros(len(fa), bool)
                shared[1:] |= fa[1:] == fa[:-1]
                shared[:-1] |= fa[1:] == fa[:-1]
                if held is not None:
                    shared[0] |= held_shared
                rows.append((fd[:-1][shared[:-1]], fk[:-1][shared[:-1]], flo[:-1][shared[:-1]], fhi[:-1][shared[:-1]], (fa[:-1][shared[:-1]], fs[:-1][shared[:-1]])))
                held, held_shared = (fa[-1], fs[-1], fd[-1], fk[-1], flo[-1], fhi[-1]), bool(shared[-1])
            yield found_batch(rows)
        if held is not None and held_shared:
            one = [np.array([x]) for x in held]
            yield found_batch([(one[2], one[3], one[4], one[5], (one[0], one[1]))])

    return rows.mapInArrow(run, FOUND)


def found_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate([r[k] for r in rows]), pa.int64()) for k in range(4)]
    for k in range(2):
        parts = [pa.nulls(len(r[0]), pa.int64()) if r[4] is None else pa.array(r[4][k], pa.int64()) for r in rows]
        columns.append(pa.concat_arrays(parts))
    return pa.RecordBatch.from_arrays(columns, ["doc", "tkey", "start", "stop", "a", "sides"])


def by_document(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, int, list[tuple], pa.Scalar]]:
    """Rows sorted by tkey, doc, data first null: for every text its document, what was noted on it, and whether it repeats."""
    now, notes, texts = None, [], 0
    for batch in batches:
        keys, docs, data = batch.column("tkey").to_pylist(), batch.column("doc").to_pylist(), batch.column("data")
        known = list(zip(*(batch.column(name).to_pylist() for name in names)))
        for k, place in enumerate(zip(keys, docs)):
            if place != now:
                now, notes, texts = place, [], 0
            if data[k].is_valid:
                yield place[1], place[0], notes, data[k], texts > 0
                texts += 1
            else:
                notes.append(known[k])


def with_texts(notes: DataFrame, docs: DataFrame, names: list[str]) -> DataFrame:
    """Notes on documents and the documents, dealt by document, notes first."""
    empty = [F.lit(None).cast("long").alias(name) for name in names]
    lone = docs.select("doc", "tkey", *empty, "data")
    both = notes.select("doc", "tkey", *names, F.lit(None).cast("binary").alias("data")).unionByName(lone)
    return both.repartition("tkey").sortWithinPartitions("tkey", "doc", F.col("data").isNotNull())


CONTEXTS = "h long, many boolean, doc long, tkey long, start long, bytes binary"


def contexts(notes: DataFrame) -> DataFrame:
    """The bytes of each segment to compare, on one side of its anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for doc, key, found, data, again in by_document(batches, ["h", "many", "start", "stop"]):
            if again or not found:
                continue
            data = data.as_py()
            rows.extend((h, bool(many), doc, key, start, data[start:stop]) for h, many, start, stop in found)
            if len(rows) >= 20_000:
                yield context_batch(rows)
                rows = []
        if rows:
            yield context_batch(rows)

    return notes.mapInArrow(run, CONTEXTS)


def context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], ["h", "many", "doc", "tkey", "start", "bytes"])


def repeats_of(parts: list[tuple[int, int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (doc, tkey, start, bytes) the bytes to go: which part, start and length."""
    parts_at = np.cumsum([0, *(len(p[3]) + 1 for p in parts)])
    codes = np.empty(parts_at[-1], np.int64)
    for i, part in enumerate(parts):
        codes[parts_at[i] : parts_at[i + 1] - 1] = np.frombuffer(part[3], np.uint8)
        codes[parts_at[i + 1] - 1] = 256 + i
    doc, key, start = (np.array([p[k] for p in parts], np.int64) for k in range(3))
    which, begin, length = [], [], []
    for size, places in maximal_repeats(codes, LENGTH, max(len(p[3]) for p in parts)):
        part = np.searchsorted(parts_at, places, "right") - 1
        at = start[part] + places - parts_at[part]
        first = np.lexsort((at, key[part], doc[part]))[0]
        # contexts of one document may hold the same bytes: those are one occurrence
        later = (at != at[first]) | (part != part[first]) & ((doc[part] != doc[part[first]]) | (key[part] != key[part[first]]))
        which.append(part[later])
        begin.append(at[later])
        length.append(np.full(int(later.sum()), size))
    if not which:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(which), np.concatenate(begin), np.concatenate(length)


def compared(rows: DataFrame) -> DataFrame:
    """Bytes to go by the maximal repeats of contexts sorted by h; groups stay together in an array."""

    def finish(parts: list[tuple]) -> pa.RecordBatch:
        """The bytes to go of each context as its maximal runs: a few rows a context, whatever the group's size."""
        which, begin, length = repeats_of(parts)
        start = np.array([p[2] for p in parts], np.int64)
        # the layout of repeats_of: contexts one after another, one separator after each
        at = np.cumsum([0, *(len(p[3]) + 1 for p in parts)])
        low = at[which] + begin - start[which]
        cover = np.zeros(at[-1] + 1, np.int64)
        np.add.at(cover, low, 1)
        np.add.at(cover, low + length, -1)
        marked = np.concatenate(([0], (np.cumsum(cover)[:-1] > 0).astype(np.int8), [0]))
        edges = np.flatnonzero(np.diff(marked))
        run_low, run_high = edges[0::2], edges[1::2]
        part = np.searchsorted(at, run_low, "right") - 1
        first = start[part] + run_low - at[part]
        doc, key = (np.array([p[k] for p in parts], np.int64)[part] for k in range(2))
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (doc, key, first, first + (run_high - run_low))], ["doc", "tkey", "start", "stop"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, last = [], 0, None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("h", "doc", "tkey", "start", "bytes")]
            for h, doc, key, start, data in zip(*columns):
                if h != last and size >= SUFFIXES:
                    yield finish(parts)
                    parts, size = [], 0
                last = h
                parts.append((doc, key, start, data))
                size += len(data)
        if parts:
            yield finish(parts)

    return rows.mapInArrow(run, "doc long, tkey long, start long, stop long")


def split_by_string(rows: DataFrame) -> DataFrame:
    """Contexts of a crowded group as their strings, so that only equal ones meet."""
    starts = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - LENGTH))
    each = rows.withColumn("k", starts).select("doc", "tkey", (F.col("start") + F.col("k")).alias("start"), F.substring("bytes", F.col("k") + 1, F.lit(LENGTH)).alias("s"))
    each = each.select("doc", "tkey", "start", F.sha2("s", 256).alias("s"))
    first = each.groupBy("s").agg(F.min(F.struct("doc", "tkey", "start")).alias("f"), F.count("*").alias("n")).filter("n > 1")
    later = each.join(first.select("s", "f"), "s").filter(F.struct("doc", "tkey", "start") != F.col("f"))
    return later.select("doc", "tkey", "start", (F.col("start") + LENGTH).alias("stop"))


KEPT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removal(notes: DataFrame, kind: str, texts: bool) -> DataFrame:
    """Each document without the bytes to go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for doc, _, spans, data, again in by_document(batches, ["start", "stop"]):
            data = data.as_py()
            if again and len(data) >= LENGTH:  # a repeated row
                spans = [(0, len(data))]
            kept, runs, gone, end = [], 0, 0, 0
            for start, stop in sorted(spans):
                if start > end or not runs:
                    kept.append(data[end:start])
                    runs += 1
                    gone += stop - start
                    end = stop
                elif stop > end:
                    gone += stop - end
                    end = stop
            left = b"".join([*kept, data[end:]])
            rows.append((None if doc == _NO_ID else doc, len(data), gone, runs, hashlib.sha256(left).hexdigest(), left if texts else None))
            size += len(left) if texts else 0
            if len(rows) >= 5_000 or size > 8 << 20:
                yield removal_batch(rows)
                rows, size = [], 0
        if rows:
            yield removal_batch(rows)

    def removal_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], names)

    return notes.mapInArrow(run, f"doc long, {KEPT}, kept binary").withColumn("doc", F.col("doc").cast(kind))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """One row per document: what is left without bytes that a repeated string of LENGTH bytes covers.

    Strings are bytes of the UTF-8 texts, judged on the input, within documents. The first
    occurrence stays: that of the smallest id (an integer; null comes last), then, for
    documents of one id, by a hash of the text, then further left. A null text is empty. Of
    repeated rows one keeps its own bytes. Shorter texts lose nothing. An empty table gives no
    rows; other columns are not read. Columns: id_col, n_bytes, n_removed, n_spans (maximal
    runs of removed bytes), kept_sha256, and with ``texts`` kept (the bytes left).
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)[id_col]
    base = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.xxhash64(id_col, text_col).alias("tkey"),
        bytes_of(text_col).alias("data"),
    )
    rows = segment_rows(base).repartition("a").sortWithinPartitions("a", "g", "doc", "tkey", "place")
    found = stage(known_repeats(rows), "segments")
    del rows
    free_shuffles(spark)

    lo, hi = F.col("start"), F.col("stop") - (LENGTH - 1)
    anchor = lo + F.col("sides").bitwiseAND(127)
    left, right = F.shiftright("sides", 35), F.shiftright("sides", 7).bitwiseAND((1 << 28) - 1)
    open_ = found.filter("a IS NOT NULL")
    sides = F.explode(
        F.array(
            F.when(anchor - lo >= HALF, F.struct(F.xxhash64("a", F.lit("left"), left).alias("h"), lo.alias("lo"), F.least(hi, anchor - HALF + 1).alias("hi"))),
            F.when(anchor - hi < HALF, F.struct(F.xxhash64("a", F.lit("right"), right).alias("h"), F.greatest(lo, anchor - HALF).alias("lo"), hi.alias("hi"))),
        )
    )
    halves = open_.select("doc", "tkey", sides.alias("s")).filter("s IS NOT NULL").select(
        "doc", "tkey", "s.h", F.col("s.lo").alias("start"), (F.col("s.hi") + LENGTH - 1).alias("stop")
    )
    shared = halves.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h", (F.col("n") > GROUP).cast("long").alias("many"))
    notes = halves.join(shared, "h")
    pieces = stage(contexts(with_texts(notes, base, ["h", "many", "start", "stop"])), "contexts")
    del notes, halves
    free_shuffles(spark)

    near = pieces.filter(~F.col("many")).select("h", "doc", "tkey", "start", "bytes").repartition("h").sortWithinPartitions("h")
    spans = found.filter("a IS NULL").select("doc", "tkey", "start", "stop")
    spans = spans.union(compared(near)).union(split_by_string(pieces.filter("many")))
    spans = stage(spans, "spans")
    free_shuffles(spark)
    result = removal(with_texts(spans, base, ["start", "stop"]), kind, texts)
    result = result.withColumnRenamed("doc", id_col)
    return result if texts else result.drop("kept")
