"""Components of documents whose word 3-gram sets have a Jaccard similarity of at least 0.9.

A Jaccard metric-space join. d(x, y) = 1 - |x & y| / |x | y| is a metric, and two sets link
when d <= t (t = 1 - percent / 100). The join is exact:

* **Pivots and Voronoi regions.** A region too large for one join is split: pivots are drawn
  from its members (the smallest by a hash, a bounded number), and every member goes to the
  region of its nearest pivot, or to the region F of the far ones when no pivot is within 1 - t.
* **Windows.** By the triangle inequality a member y also goes, as a boundary copy, to every
  other region i with d(y, p_i) - d(y, p_own) <= 2t, d(y, p_i) < 1 and d(y, p_i) <= r_i + t,
  where r_i, the region's radius, is the largest distance of its cores to p_i; and to F when
  its nearest pivot is at least 1 - 2t away. F's members go to region i when they share
  anything with p_i and are within its radius and t. A set is a *core* of the one region it
  owns at every level; every linked pair then meets in the leaf region of each core.
* **Recursion.** Regions split again while they are larger than ``leaf`` and the split shrinks
  them; a region that does not shrink (sparse text: most sets are at distance 1 from every
  pivot) is a leaf.
* **Balls.** A core within t of one of its region's pivots links to that pivot at once and leaves
  the region join. It still meets, by a join keyed on the pivot, every set within 2t of that
  pivot: only these can link to it. A cluster of thousands of near copies around a pivot is so
  linked in linear work.
* **Leaf join.** Within a leaf region, core and member meet on a shared prefix token: the first
  ``n - ceil(percent * n / 100) + 1`` shingles of a set of n in one global order, which every
  pair of similarity percent or more shares. The order puts rare shingles first and common ones
  (in more than ``HOT`` sets, counted over all sets) last, so that a passage shared by many
  documents does not make them all candidates. The members of a token first meet its smallest
  core; pairs whose first shingles already differ too much are left out, the others are verified
  on the full sets.
* **Open sets.** Sets whose tokens then still lie in different components get prefixes anew, with
  counts over these sets only and a choice from more of their shingles; the members of a token
  meet the core with the fewest shingles of its own.
* **Blocks.** What a token has in different components after that is grouped: sets that share
  such tokens, directly or through others, at places that their sizes allow. A group is compared
  set against set in blocks within the tasks, so that its pairs are never rows, and a task returns
  only links between parts that it has not yet joined.

Full sets are larger than the text and are neither stored nor shuffled: one pass over the texts
keeps of each set its size, its key, its distances to the first pivots and its first shingles, and
the few sets that a split, a prefix or a pair needs whole are made again from their texts. Stored
tables that nothing reads any more are deleted on the way.

Identical sets are folded first; they link (similarity 1). Texts without words have an empty set
and link with nothing. Words are runs outside x20, x09-x0D, A-Z lower-cased; with fewer than
three words the whole sequence is one shingle. Null text counts as empty; a null doc_id takes part
and gets the smallest non-null doc_id of its component (null if there is none). Extra columns
are ignored. Empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import bytes_of, free_shuffles, join_by_size, perhaps_in, row_key, text_of
from martloom.llm.components import components
from martloom.llm.near_dedup import Parts, blocked, crossing, runs_of
from martloom.llm.shingles import shingle_set
from martloom.session import arrow_batches, discard, stage

SHINGLE = 3
PERCENT = 90
# Layout: members above which a region is split, pivots per region, largest set taken as a pivot,
# and the pivot bytes that one round takes to the driver (more regions wait for the next round).
LEAF = 4000
PIVOTS = 16
PIVOT_MAX = 2000
ROUND_BYTES = 16 << 20
DEPTH = 6
# Shingles go the later in the order of prefixes the more of these counts of sets they exceed; the map of a count has HOT_BITS bits.
HOT = 64
RARE = (1, 8)
# A split whose children hold more than GROWTH times the members is not made.
GROWTH = 2
HOT_BITS = 1 << 25
# The map of the lowest limit has a bit for SPREAD shingles, within these numbers of bits.
SPREAD = 4
MOST_BITS = 1 << 28
# Size classes within which the sizes of two linked sets can lie.
CLASSES = 4
EPS = 1e-9
ROOT = "r"
CHUNK = 1 << 20  # bytes of text whose sets a task holds at once
BATCH = 4 << 20  # bytes of rows that Spark and a Python task hand each other at once
BLOCK = 128  # sets of a group compared at once with as many others
BLOCK_SHINGLES = 200_000  # and about so many shingles


class Hashes:
    """Word hashes without a memo, which a large vocabulary makes slower than hashing, and large."""

    __getitem__ = staticmethod(xxhash.xxh64_intdigest)


def _chunks(texts: pa.Array):
    """Slices of texts of about CHUNK bytes, so that few sets are in memory at once."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size > CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _key(found: np.ndarray) -> int | None:
    """A 64-bit key of a set, null when empty."""
    return xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63) if len(found) else None


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)])
    flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n (set size), sid (a 64-bit key of the set, null when empty), shingles (sorted longs)."""

    def each(batches):
        memo = Hashes()
        for batch in batches:
            at = 0
            for texts in _chunks(batch.column("data")):
                found = [shingle_set(t, memo, size) for t in texts]
                ids = batch.column("doc_id").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(x) for x in found], pa.int64()), pa.array(map(_key, found), pa.int64()), _lists(found)],
                    ["doc_id", "n", "sid", "shingles"],
                )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of("text").alias("data"))
    return picked.mapInArrow(each, "doc_id long, n long, sid long, shingles array<long>")


class Pivots:
    """The pivots of a region, laid out so that many sets are measured against all of them at once."""

    def __init__(self, pivots: list[tuple[int, np.ndarray]]):
        self.sids = [sid for sid, _ in pivots]
        self.sizes = np.array([len(x) for _, x in pivots])
        self.shingles = np.unique(np.concatenate([x for _, x in pivots]))
        self.has = np.zeros((len(self.shingles), len(pivots)), bool)
        for i, (_, x) in enumerate(pivots):
            self.has[np.searchsorted(self.shingles, x), i] = True

    def measure(self, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of intersection and union, a row a set, a column a pivot."""
        sizes = np.array([len(x) for x in found])
        flat = np.concatenate(found)
        at = np.minimum(np.searchsorted(self.shingles, flat), len(self.shingles) - 1)
        hit = np.flatnonzero(self.shingles[at] == flat)
        row = np.repeat(np.arange(len(found)), sizes)[hit]
        has = self.has[at[hit]]
        common = np.stack([np.bincount(row[has[:, i]], minlength=len(found)) for i in range(len(self.sids))], 1)
        return common, sizes[:, None] + self.sizes[None] - common


def _measured(here: Pivots, path: str, sids: list[int], found: list[np.ndarray], core: list[bool], percent: int) -> list[tuple]:
    """Members of a region that is split -> their distances to the region's pivots.

    Returns sid, n, path, core, own (index of the nearest pivot, -1 for the far region F), m (its
    distance), d (distances to all pivots), ball (the pivot a core within t of its nearest pivot
    links to) and windows (pivots within 2t: their balls' members may link to this set).
    """
    t = 1 - percent / 100
    common, union = here.measure(found)
    d = 1 - common / union
    own = np.argmin(d, 1)
    at = np.arange(len(found))
    m = d[at, own]
    far = m >= 1 - t - EPS
    links = ~far & (100 * common[at, own] >= percent * union[at, own])
    near = 100 * common >= (2 * percent - 100) * union
    return [
        (sids[i], len(found[i]), path, core[i], -1 if far[i] else int(own[i]), float(m[i]), d[i].tolist(),
         here.sids[own[i]] if core[i] and links[i] else None, [here.sids[j] for j in np.flatnonzero(near[i])])
        for i in range(len(found))
    ]


def _children(path: str, core: bool, own: int, m: float, d: list[float], ball: int | None, radius: dict, t: float) -> list[tuple[str, bool]]:
    """(path, core) of the child regions that a measured member belongs to.

    A core goes to its own child; a ball's member goes nowhere (the ball join covers it). A copy
    goes to child i only if a core staying in i could link with it: d(y, p_i) < 1, within 2t of
    its own pivot's distance (or y far), and within t of i's radius, the farthest of i's staying
    cores from p_i. Far sets go to F; a near one goes to F as a copy when its nearest pivot is
    at least 1 - 2t away and F has staying cores.
    """
    if ball is not None:
        return []
    far = own == -1
    out = [(f"{path}.F" if far else f"{path}.{own}", core)]
    for i, di in enumerate(d):
        if i == own or di >= 1.0 or (path, i) not in radius:
            continue
        if (far or di - m <= 2 * t + EPS) and di <= radius[(path, i)] + t + EPS:
            out.append((f"{path}.{i}", False))
    if not far and m >= 1 - 2 * t - EPS and (path, -1) in radius:
        out.append((f"{path}.F", False))
    return out


def _walk(found: list[np.ndarray], sids: list[int], rounds: list[tuple[dict, dict]], percent: int) -> list[tuple]:
    """Sets led through the rounds of splits so far: the measured rows of the last round.

    A round is its regions' pivots and radii (none yet in the last one).
    """
    t = 1 - percent / 100
    places = {ROOT: [(i, True) for i in range(len(found))]}
    out = []
    for depth, (table, radius) in enumerate(rounds):
        for path in [p for p in places if p in table]:
            members = places.pop(path)
            rows = _measured(table[path], path, [sids[i] for i, _ in members], [found[i] for i, _ in members], [c for _, c in members], percent)
            if depth == len(rounds) - 1:
                out += rows
                continue
            for (i, _), (_, _, _, core, own, m, d, ball, _) in zip(members, rows):
                for child, inside in _children(path, core, own, m, d, ball, radius, t):
                    places.setdefault(child, []).append((i, inside))
    return out


MEASURED = "sid long, n long, path string, core boolean, own int, m double, d array<double>, ball long, windows array<long>"
_MEASURED = pa.schema(
    [("sid", pa.int64()), ("n", pa.int64()), ("path", pa.string()), ("core", pa.bool_()), ("own", pa.int32()), ("m", pa.float64())]
    + [("d", pa.list_(pa.float64())), ("ball", pa.int64()), ("windows", pa.list_(pa.int64()))]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _first_pass(docs: DataFrame, size: int, table: dict, percent: int) -> DataFrame:
    """Each document's doc_id, k1 (its key, to find the text again), n, sid, first shingles and distances to the first pivots."""

    def each(batches):
        memo = Hashes()
        for batch in batches:
            at = 0
            for texts in _chunks(batch.column("data")):
                found = [shingle_set(t, memo, size) for t in texts]
                sids = [_key(x) for x in found]
                some = [i for i, x in enumerate(found) if len(x)]
                rows: list[tuple] = [(None, len(x), None, None, None, None, None, None, None) for x in found]
                if table and some:
                    for i, r in zip(some, _walk([found[i] for i in some], [sids[i] for i in some], [(table, {})], percent)):
                        rows[i] = r
                measured = _batch([r[4:] for r in rows], pa.schema(list(_MEASURED)[4:]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(texts)) for c in ("doc_id", "k1")]
                    + [pa.array([len(x) for x in found], pa.int64()), pa.array(sids, pa.int64())]
                    + [_lists([_head(x, percent) for x in found]), *measured.columns],
                    ["doc_id", "k1", "n", "sid", "shingles", *measured.schema.names],
                )
                at += len(texts)

    made = "doc_id long, k1 long, n long, sid long, shingles array<long>, " + MEASURED[MEASURED.index("own") :]
    return _texts(docs).mapInArrow(each, made)


def _next_pass(docs: DataFrame, members: DataFrame, size: int, rounds: list[tuple[dict, dict]], percent: int) -> DataFrame:
    """The measured rows of the last round; ``members`` has the k1 of all sets in its regions."""

    def each(batches):
        memo = Hashes()
        for batch in batches:
            for texts in _chunks(batch.column("data")):
                found = [x for x in (shingle_set(t, memo, size) for t in texts) if len(x)]
                yield _batch(_walk(found, [_key(x) for x in found], rounds, percent) if found else [], _MEASURED)

    return perhaps_in(_texts(docs), members, "k1").mapInArrow(each, MEASURED).dropDuplicates(["sid", "path"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text")[0].alias("k1"), bytes_of("text").alias("data"))


def _whole(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """sid and shingles of the sets ``wanted`` (sid, k1), made again from their texts, one row each."""
    texts = perhaps_in(_texts(docs), wanted, "k1").select("doc_id", F.col("data").alias("text"))
    return sets(texts, size).select("sid", "shingles").join(wanted.select("sid").distinct(), "sid", "left_semi").dropDuplicates(["sid"])


def _place(radius: dict[tuple[str, int], float], percent: int):
    """mapInArrow: measured members -> (sid, n, path, core) of the child regions they belong to."""
    t = 1 - percent / 100

    def each(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                for path, core in _children(r["path"], r["core"], r["own"], r["m"], r["d"], r["ball"], radius, t):
                    out.append((r["sid"], r["n"], path, core))
            yield _batch(out, pa.schema(list(_MEASURED)[:4]))

    return each


def _prefix_length(n: np.ndarray | int, percent: int):
    return n - (percent * n + 99) // 100 + 1


def _hot_maps(heads: DataFrame, limits: list[int], bits: int = 0) -> list[np.ndarray]:
    """For each limit: bits set for every shingle in the first ones of more than ``limit`` sets.

    The lowest limit has ``bits`` bits (HOT_BITS at least), the others HOT_BITS. Counted over all
    sets; built on the executors as bitmaps of 32768 bits and collected whole, so that their size does
    not depend on the number of shingles. A shingle that shares a bit with a hot one counts as hot
    too: that only changes the order, and every order is exact.
    """
    widths = {limit: HOT_BITS for limit in limits} | {min(limits): max(bits, HOT_BITS)}
    counted = heads.select(F.explode("shingles").alias("tok")).groupBy("tok").count().where(F.col("count") > min(limits))
    over = F.array(*[F.struct(F.lit(x).alias("limit"), (F.pmod("tok", F.lit(width)) + 1).alias("at")) for x, width in widths.items()])
    places = counted.select(F.explode(F.filter(over, lambda x: F.col("count") > x["limit"])).alias("_o")).select("_o.*")
    maps = places.select("limit", F.bitmap_bucket_number("at").alias("b"), F.bitmap_bit_position("at").alias("p"))
    maps = maps.groupBy("limit", "b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    found = {limit: np.zeros(width // 8, np.uint8) for limit, width in widths.items()}
    for r in maps:
        chunk = np.frombuffer(r.m, np.uint8)
        at = (r.b - 1) * 4096
        found[r.limit][at : at + len(chunk)] |= chunk[: max(0, min(len(chunk), len(found[r.limit]) - at))]
    return [found[limit] for limit in limits]


def _bits(shingles: int) -> int:
    """Bits of the lowest limit's map for so many counted shingles: the more, the fewer take a bit of another one."""
    return min(MOST_BITS, max(HOT_BITS, 1 << (shingles // SPREAD).bit_length()))


def _inside(flat: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = np.mod(flat, len(bits) * 8)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1


def _hot_map(sets: DataFrame, percent: int, hot: int) -> np.ndarray:
    """The map of one limit, of the shingles kept of each set."""
    length = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1
    return _hot_maps(sets.select(F.slice("shingles", 1, length.cast("int")).alias("shingles")), [hot])[0]


def _early(percent: int) -> int:
    """Shingles below are early: twice the share of a set that its prefix is."""
    return min(1 << 63, (2 * (100 - percent) << 64) // 100)


def _head(found: np.ndarray, percent: int) -> np.ndarray:
    """First shingles kept of a set: its early ones, and no fewer than its prefix has."""
    early = int(np.searchsorted(found, np.uint64(_early(percent))))
    return found[: max(early, _prefix_length(len(found), percent))]


def _prefixes(classes: DataFrame, maps: list[np.ndarray], percent: int) -> DataFrame:
    """sid, n, prefix: the first shingles of each set in one order of all shingles.

    Early ones come first, those in fewer maps before the others, then late ones, and last those
    in the last map; equals by value. The prefix is null where ``shingles`` holds only the first
    ones of the set and too few of them are outside the last map.
    """
    early = np.uint64(_early(percent))

    def each(batches):
        for batch in batches:
            column = batch.column("shingles")
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
            rank = sum((_inside(flat, bits) for bits in maps[:-1]), np.zeros(len(flat), np.int8)).astype(np.int8)
            rank[flat.view(np.uint64) >= early] = len(maps)
            rank[_inside(flat, maps[-1]).astype(bool)] = len(maps) + 1
            out = []
            for n, start, stop in zip(batch.column("n").to_pylist(), ends, ends[1:]):
                mine, length = rank[start:stop], _prefix_length(n, percent)
                if stop - start < n and np.count_nonzero(mine <= len(maps)) < length:
                    out.append(None)
                else:
                    out.append(flat[start:stop][np.argsort(mine, kind="stable")[:length]])
            yield pa.RecordBatch.from_arrays([batch.column("sid"), batch.column("n"), pa.array(out, pa.list_(pa.int64()))], ["sid", "n", "prefix"])

    return classes.select("sid", "n", "shingles").mapInArrow(each, "sid long, n long, prefix array<long>")


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sids without those whose first shingles rule out the threshold.

    Up to the smaller of the two last kept shingles both sets are known. Where the sets differ by
    more than (na + nb) * (100 - percent) / (100 + percent) shingles there, they cannot link.
    """

    def each(batches):
        for batch in batches:
            sides = []
            for side in "ab":
                column = batch.column("h" + side)
                sides.append((batch.column("n" + side).to_numpy(), column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()))
            (na, fa, ea), (nb, fb, eb) = sides
            keep = []
            for i in range(batch.num_rows):
                x, y = fa[ea[i] : ea[i + 1]], fb[eb[i] : eb[i + 1]]
                if len(x) < na[i]:
                    y = y[: np.searchsorted(y, x[-1], "right")]
                if len(y) and len(y) < nb[i]:
                    x = x[: np.searchsorted(x, y[-1], "right")]
                differ = len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True))
                keep.append(differ * (100 + percent) <= (na[i] + nb[i]) * (100 - percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in "ab"], ["a", "b"])

    length = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1
    heads = classes.select("sid", "n", F.slice("shingles", 1, length.cast("int")).alias("head"))
    joined = pairs.join(heads.toDF("a", "na", "ha"), "a").join(heads.toDF("b", "nb", "hb"), "b")
    return joined.select("a", "b", "na", "nb", "ha", "hb").mapInArrow(each, "a long, b long")


def _hubs(tokens: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): the members of a token of ``_open_tokens`` with its core that has the fewest shingles of its own.

    Such a core is what the others were made from, or near it.
    """
    lead = tokens.groupBy("sid").agg(F.min("pos").alias("lead"))
    hub = F.min(F.when(F.col("core"), F.struct("lead", "sid", "n", "pos"))).over(Window.partitionBy("key"))
    met = tokens.join(lead, "sid").withColumn("hub", hub).filter((F.col("sid") != F.col("hub.sid")) & _fits("n", "pos", "hub.n", "hub.pos", percent))
    return met.select(F.least("sid", "hub.sid").alias("a"), F.greatest("sid", "hub.sid").alias("b")).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs (a, b) of sids whose full sets are within the threshold."""
    sids = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    shingles = stage(_whole(docs, stage(classes.select("sid", "k1").join(sids, "sid"), "jaccard-wanted"), size), "jaccard-whole")
    joined = pairs.join(shingles.toDF("a", "sa"), "a").join(shingles.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    linked = stage(joined.filter(100 * common >= percent * union).select("a", "b"), "jaccard-linked")
    discard(shingles)
    return linked


def _open_tokens(mixed: DataFrame, places: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """key, sid, n, pos, core, part: tokens in several components, of prefixes made anew for the sets of ``mixed``.

    The prefixes of all sets choose from early shingles, counted over all sets. Those of the sets left
    choose from all their shingles, counted over these sets only; where they are more than half of
    all, from so many that half of all shingles are counted. So an edited copy whose changes
    are its own has these first, and is no candidate of the copies of what it was made from.
    """
    few = stage(mixed.select("sid", "part").distinct().join(classes.select("sid", "n", "k1"), "sid"), "jaccard-open")
    left, full = (frame.agg(F.sum("n")).first()[0] for frame in (few, classes))
    early = min((1 << 64) - 1, (1 << 63) * full // left)

    def firsts(batches):
        memo = Hashes()
        for batch in batches:
            for texts in _chunks(batch.column("data")):
                found = [shingle_set(t, memo, size) for t in texts]
                yield pa.RecordBatch.from_arrays([_lists([x[: np.searchsorted(x, np.uint64(early))] for x in found])], ["shingles"])

    texts = perhaps_in(_texts(docs).select("k1", "data"), few, "k1").select("data")
    counted = texts.mapInArrow(firsts, "shingles array<long>")
    maps = _hot_maps(counted, sorted({x for x in RARE if x < HOT} | {HOT}), _bits(left * (early >> 32) >> 32))

    def each(batches):
        memo = Hashes()
        for batch in batches:
            for texts in _chunks(batch.column("data")):
                sids, out = [], []
                for found in (shingle_set(t, memo, size) for t in texts):
                    length = _prefix_length(len(found), percent)
                    within = int(np.searchsorted(found, np.uint64(early)))
                    mine = found[: max(within, length)]
                    rank = sum((_inside(mine.view(np.int64), bits) for bits in maps), np.zeros(len(mine), np.int8))
                    rank[within:] = len(maps) + 1
                    sids.append(_key(found))
                    out.append(mine[np.argsort(rank, kind="stable")[:length]])
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), _lists(out)], ["sid", "prefix"])

    prefixes = few.drop("k1").join(texts.mapInArrow(each, "sid long, prefix array<long>").dropDuplicates(["sid"]), "sid")
    tokens = places.join(prefixes, "sid").select("sid", "n", "part", "core", "place", F.posexplode("prefix").alias("pos", "tok"))
    tokens = tokens.select(F.xxhash64("place", "tok").alias("key"), "sid", "n", "pos", "core", "part")
    key = Window.partitionBy("key")
    spans = {"p0": F.min("part").over(key), "p1": F.max("part").over(key), "met": F.max("core").over(key)}
    return stage(tokens.withColumns(spans).filter("met AND p0 <> p1").drop(*spans), "jaccard-tokens")


def _grouped(mixed: DataFrame, percent: int) -> DataFrame:
    """group, c, side, part, blocks: the sets (c) of each group whose pairs may still link.

    ``mixed`` (key, sid, n, pos, core, part) has the members of tokens in several components. Sets that can
    link are at most CLASSES size classes apart. A set is in its own class with the others there (side 0)
    and, for each distance of classes, as the larger one of a pair in its own class (side 1), and as the
    smaller one in the larger one's (side 2). The first shingle that two linked sets share is at
    most as far back in either as the smallest partner of that class allows. Groups are the
    components of sets that share a token within a class and distance.
    """
    width = max(math.log(100 / percent), 1e-3) * (1 + EPS) / CLASSES
    mine = F.floor(F.log("n") / width)
    ways = [(0, 0), *[(up, side) for up in range(1, CLASSES + 1) for side in (1, 2)]]
    places = [F.struct((mine + (up if side == 2 else 0)).alias("class"), F.lit(up).alias("up"), F.lit(side).alias("side")) for up, side in ways]
    rows = mixed.select("key", "core", F.col("sid").alias("c"), F.col("n").cast("long").alias("n"), "pos", "part", F.explode(F.array(*places)).alias("_p"))
    rows = rows.select("*", "_p.*").drop("_p")
    partner = F.greatest(F.exp((F.col("class") - F.when(F.col("side") == 1, F.col("up")).otherwise(0)) * width) * (1 - EPS), F.col("n") * percent / 100)
    rows = rows.filter(F.col("pos") <= F.col("n") - percent * (F.col("n") + partner) / (100 + percent) + 1e-6)
    rows = rows.select(F.xxhash64("key", "class", "up").alias("key"), F.xxhash64("c", "class", "up").alias("node"), "c", "n", "core", "side", "part")
    spans = [F.min("part").alias("p0"), F.max("part").alias("p1"), F.min("side").alias("s0"), F.max("side").alias("s1")]
    both = "p0 <> p1 AND (s1 = 0 OR s0 <> s1)"
    keys = rows.groupBy("key").agg(F.min("node").alias("least"), F.max("core").alias("met"), *spans)
    rows = rows.join(keys.filter(f"met AND {both}").select("key", "least"), "key")
    rows = stage(rows.select("node", "c", "n", "side", "part", "least").distinct(), "jaccard-nodes")
    group = components(rows, "node", "least").toDF("node", "group")
    members = rows.drop("least").distinct().join(group, "node").drop("node")
    wide = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    spans = members.groupBy("group").agg(wide, *spans)
    return members.drop("n").join(spans.filter(both).select("group", "blocks"), "group")


def _block_links(groups: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """Links (a, b) on full sets within the groups of ``_grouped``, compared block against block.

    Of the links of a block pair those are returned that join parts not joined by others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Hashes()
        for table in runs_of(batches, ["group", "lo", "hi"]):
            table = table.sort_by("_mine")
            sets, at, seen = [], [], set()
            for i, (sid, data) in enumerate(zip(table.column("c").to_pylist(), table.column("data"))):
                if sid not in seen:  # repeated rows, and rows whose key only collides, drop out
                    found = shingle_set(data.as_py(), memo, size)
                    if _key(found) == sid:
                        seen.add(sid)
                        sets.append(found)
                        at.append(i)
            table = table.take(pa.array(at, pa.int64()))
            part, side = table.column("part").to_numpy(), table.column("side").to_numpy()
            if table.num_rows < 2 or (part == part[0]).all():
                continue
            c = table.column("c").to_numpy()
            n = np.array([len(x) for x in sets])
            ends = np.cumsum(n)
            distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
            # two larger or two smaller ones meet in their own class
            compare = crossing(table) & ((side == 0) | (side[:, None] != side[None])) & (part[:, None] != part[None])
            compare &= 100 * np.minimum(n[:, None], n[None]) >= percent * np.maximum(n[:, None], n[None])
            parts, mark = Parts(part), np.zeros(len(distinct), np.int32)
            a, b = [], []
            for i in range(len(c) - 1):
                if not compare[i, i + 1 :].any():
                    continue
                mine = flat[ends[i] - n[i] : ends[i]]
                mark[mine] = 1
                common = np.add.reduceat(mark[flat[ends[i] :]], ends[i:-1] - ends[i])
                mark[mine] = 0
                linked = compare[i, i + 1 :] & (100 * common >= percent * (n[i] + n[i + 1 :] - common))
                for j in (np.flatnonzero(linked) + i + 1).tolist():
                    if parts.join(i, j):
                        a.append(int(c[i]))
                        b.append(int(c[j]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    members = stage(groups.join(classes.select(F.col("sid").alias("c"), "k1"), "c"), "jaccard-groups")
    texts = perhaps_in(_texts(docs).select("k1", "data"), members, "k1")
    rows = blocked(texts.join(members, "k1"), "group", "blocks")
    rows = rows.repartition("group", "lo", "hi").sortWithinPartitions("group", "lo", "hi")
    return stage(rows.select("group", "lo", "hi", "_mine", "c", "side", "part", "data").mapInArrow(run, "a long, b long"), "jaccard-links")


def _fits(na: str, ia: str, nb: str, ib: str, percent: int) -> Column:
    """Whether sets of these sizes can link if the shingles at these places of the prefixes are the first they share."""
    na, ia, nb, ib = F.col(na), F.col(ia), F.col(nb), F.col(ib)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((ia + ib) * (100 + percent) <= (na + nb) * (100 - percent))


def jaccard_components(
    docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, leaf: int = LEAF, pivots: int = PIVOTS
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable, itself included).

    One row per row of ``docs``. See the module for the rules.
    """
    # rows hold a text or a long list: batches of 10000, Spark's measure, take hundreds of MB on either side
    with arrow_batches(docs.sparkSession, BATCH):
        return _components(docs, percent, size, leaf, pivots)


def _components(docs: DataFrame, percent: int, size: int, leaf: int, pivots: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.count()
    table: dict[str, Pivots] = {}
    if rows > leaf:
        # pivots of the root: sets of the texts smallest by a hash; about 8 * pivots texts are looked at
        text = text_of("text")
        drawn = docs.select(F.xxhash64(text).alias("doc_id"), text.alias("text")).filter(F.pmod("doc_id", F.lit(rows)) < 8 * pivots)
        drawn = sets(drawn.groupBy("doc_id").agg(F.first("text").alias("text")), size).filter(f"n > 0 AND n <= {PIVOT_MAX}")
        got = drawn.dropDuplicates(["sid"]).orderBy("doc_id", "sid").limit(pivots).collect()
        if got:
            table = {ROOT: Pivots([(r.sid, np.array(r.shingles, np.int64).view(np.uint64)) for r in got])}
    base = stage(_first_pass(docs, size, table, percent), "jaccard-sets")
    kept = ["k1", "n", "shingles", "own", "m", "d", "ball", "windows"]
    folded = base.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first(F.struct(*kept)).alias("_s"))
    classes = stage(folded.select("sid", "rep", "copies", "_s.*"), "jaccard-classes")
    known = stage(base.select("doc_id", "n", "sid"), "jaccard-known")
    discard(base)
    free_shuffles(spark)

    members = classes.select("sid", "n", F.lit(ROOT).alias("path"), F.lit(True).alias("core"))
    balls, windows = [], []
    rounds: list[tuple[dict, dict]] = []
    frozen: set[str] = set()
    sizes = {ROOT: classes.count()}
    for depth in range(DEPTH):
        big = sorted(p for p, c in sizes.items() if c > leaf and p not in frozen)
        if not big:
            break
        if depth:
            table = _draw(docs, classes, members, {p: sizes[p] for p in big}, depth, pivots, size)
        if not table:
            frozen.update(big)
            continue
        split_paths = sorted(table)
        if depth:
            wanted = members.filter(F.col("path").isin(split_paths)).select("sid").distinct().join(classes.select("sid", "k1"), "sid")
            measured = stage(_next_pass(docs, wanted, size, [*rounds, (table, {})], percent), "jaccard-measured")
        else:
            measured = classes.select("sid", "n", F.lit(ROOT).alias("path"), F.lit(True).alias("core"), "own", "m", "d", "ball", "windows")
        # radius of each child: the farthest of the cores that stay in it (the far region F: index -1)
        staying = measured.where("core AND ball IS NULL").groupBy("path", "own").agg(F.max("m").alias("r")).collect()
        radius = {(r.path, r.own): (1.0 if r.own == -1 else r.r) for r in staying}
        moved = stage(measured.mapInArrow(_place(radius, percent), "sid long, n long, path string, core boolean"), "jaccard-moved")
        grown = {r.path: r.c for r in moved.groupBy("path").agg(F.count(F.lit(1)).alias("c")).collect()}
        inside = {path: {p: c for p, c in grown.items() if p.rpartition(".")[0] == path} for path in split_paths}
        # a region whose children hold too many copies stays as it is
        undone = [path for path in split_paths if sum(inside[path].values()) > GROWTH * sizes[path]]
        frozen.update(undone)
        for path in undone:
            del table[path]
        rounds.append((table, radius))
        made = moved.filter(F.col("path").isin(sorted(p for path in table for p in inside[path])))
        members = stage(members.filter(~F.col("path").isin(sorted(table))).unionByName(made), "jaccard-members")
        balls.append(measured.filter("ball IS NOT NULL").select("sid", "ball"))
        windows.append(measured.filter(F.col("path").isin(sorted(table))).select("sid", F.explode("windows").alias("pivot")).distinct())
        for path in table:
            # a child that keeps four fifths of its parent is not split again
            frozen.update(p for p, c in inside[path].items() if c * 5 >= sizes[path] * 4)
            del sizes[path]
            sizes |= inside[path]

    # a core meets the members of its region, and a ball's members every set within 2t of its pivot
    # outside the ball, on prefix tokens
    places = members.select("sid", F.xxhash64("path").alias("place"), "core")
    tied = None
    for ball, window in zip(balls, windows):
        outside = window.join(ball.toDF("sid", "pivot"), ["sid", "pivot"], "left_anti")
        inner = ball.select("sid", F.xxhash64(F.lit("ball"), "ball").alias("place"), F.lit(True).alias("core"))
        places = places.unionByName(inner).unionByName(outside.select("sid", F.xxhash64(F.lit("ball"), "pivot").alias("place"), F.lit(False).alias("core")))
        link = ball.select(F.col("sid").alias("a"), F.col("ball").alias("b")).filter("a <> b")
        tied = link if tied is None else tied.unionByName(link)
    shingles = classes.agg(F.sum(F.size("shingles"))).first()[0] or 0
    maps = _hot_maps(classes, sorted({x for x in RARE if x < HOT} | {HOT}), _bits(shingles))
    prefixes = stage(_prefixes(classes, maps, percent), "jaccard-prefixes")
    short = prefixes.filter("prefix IS NULL").select("sid", "n").join(classes.select("sid", "k1"), "sid")
    if not short.isEmpty():
        again = _whole(docs, stage(short, "jaccard-short"), size).withColumn("n", F.size("shingles").cast("long"))
        prefixes = prefixes.filter("prefix IS NOT NULL").unionByName(stage(_prefixes(again, maps, percent), "jaccard-prefixes"))
    free_shuffles(spark)
    tokens = places.join(prefixes, "sid").select("sid", "n", "core", "place", F.posexplode("prefix").alias("pos", "tok"))
    # one key for place and token: where two collide there are more candidates, never fewer
    tokens = tokens.select(F.xxhash64("place", "tok").alias("key"), "sid", F.col("n").cast("int").alias("n"), "pos", "core")
    key = Window.partitionBy("key")
    first = F.min(F.when(F.col("core"), F.struct("sid", "n", "pos"))).over(key)
    shared = tokens.withColumn("first", first).withColumn("size", F.count(F.lit(1)).over(key))
    shared = stage(shared.filter("size > 1 AND first IS NOT NULL").select("key", "sid", "n", "pos", "core", "first"), "jaccard-shared")
    discard(prefixes)
    free_shuffles(spark)
    # the members of a token meet its smallest core; then, in blocks, all that this leaves in different components
    stars = shared.filter((F.col("sid") != F.col("first.sid")) & _fits("n", "pos", "first.n", "first.pos", percent))
    stars = stage(stars.select(F.least("sid", "first.sid").alias("a"), F.greatest("sid", "first.sid").alias("b")).distinct(), "jaccard-stars")
    found = _verified(stage(_possible(stars, classes, percent), "jaccard-possible"), docs, classes, percent, size)
    tied = stage(found if tied is None else found.unionByName(tied), "jaccard-edges")
    free_shuffles(spark)
    part = components(tied).toDF("sid", "part")
    parted = shared.drop("first").join(part, "sid", "left").withColumn("part", F.coalesce("part", "sid"))
    mixed = parted.groupBy("key").agg(F.min("part").alias("p0"), F.max("part").alias("p1")).filter("p0 <> p1").select("key")
    parted = stage(parted.join(mixed, "key"), "jaccard-mixed")
    free_shuffles(spark)
    edges = tied
    if not parted.isEmpty():
        parted = _open_tokens(parted, places, docs, classes, percent, size)
        free_shuffles(spark)
        hubs = stage(_hubs(parted, percent), "jaccard-stars")
        tied = stage(tied.unionByName(_verified(stage(_possible(hubs, classes, percent), "jaccard-possible"), docs, classes, percent, size)), "jaccard-edges")
        part = components(tied).toDF("sid", "part")
        parted = parted.drop("part").join(part, "sid", "left").withColumn("part", F.coalesce("part", "sid"))
        edges = tied.unionByName(_block_links(_grouped(parted, percent), docs, classes, percent, size))
        free_shuffles(spark)

    roots = components(stage(edges, "jaccard-edges")).withColumnRenamed("node", "sid")
    linked = roots.join(classes.select("sid", "rep"), "sid")
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = classes.select("sid", "rep", "copies").join(linked.join(least, "root").select("sid", "component_id"), "sid", "left")
    named = stage(named.select("sid", "copies", F.coalesce("component_id", "rep").alias("component_id")), "jaccard-named")
    told = join_by_size(known.filter("n > 0"), named, "sid", "copies", rows)
    alone = known.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return told.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def _draw(docs: DataFrame, classes: DataFrame, members: DataFrame, sizes: dict[str, int], depth: int, pivots: int, size: int) -> dict[str, Pivots]:
    """Pivots of the regions to split: the smallest sets by a hash among their cores, as far as a round holds."""
    # a hash below 8 * pivots of the region's size passes: about 8 * pivots candidates a region
    bounds = members.sparkSession.createDataFrame(list(sizes.items()), "path string, _size long")
    cand = members.filter(f"core AND n <= {PIVOT_MAX}").join(F.broadcast(bounds), "path")
    cand = cand.withColumn("_h", F.xxhash64("sid", F.lit(depth))).filter(F.pmod("_h", F.col("_size")) < 8 * pivots)
    ranked = cand.groupBy("path").agg(F.expr(f"slice(array_sort(collect_list(struct(_h, sid))), 1, {pivots})").alias("_p"))
    chosen = stage(ranked.select("path", F.explode("_p.sid").alias("sid")).join(classes.select("sid", "k1"), "sid"), "jaccard-chosen")
    got = chosen.join(_whole(docs, chosen, size), "sid").select("path", "sid", "shingles").collect()
    table: dict[str, list[tuple[int, np.ndarray]]] = {}
    used = 0
    for r in sorted(got, key=lambda r: (r.path, r.sid)):
        if used > ROUND_BYTES and r.path not in table:
            continue
        table.setdefault(r.path, []).append((r.sid, np.array(r.shingles, np.int64).view(np.uint64)))
        used += 8 * len(r.shingles)
    return {path: Pivots(found) for path, found in table.items()}
