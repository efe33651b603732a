"""Exact and near copies against brute force."""

import pyarrow.parquet as pq
import pytest

import llm_data as D
from martloom.llm import components, exact_dedup, near_dedup

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return D.hostile_documents()


def table_rows(n=None):
    t = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))[:n]


def test_exact_groups(spark, rows):
    expected = D.exact(rows)
    for fan, parts in ((2, 7), (16, 3)):
        got = exact_dedup.exact_groups(D.frame(spark, rows).repartition(parts), fan=fan).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.keep_id, r.group_size, r.text_sha256) == expected[r.doc_id]
        for sha in {r.text_sha256 for r in got}:  # one row stays, also of repeated rows
            assert sum(r.kept for r in got if r.text_sha256 == sha) == 1
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_null_ids_and_empty_table(spark):
    rows = [(None, "same", None, None, 4, 0, ""), (5, "same", None, None, 4, 0, ""), (None, None, None, None, None, 0, "")]
    got = {(r.doc_id, r.kept, r.keep_id) for r in exact_dedup.exact_groups(D.frame(spark, rows)).collect()}
    assert got == {(None, False, 5), (5, True, 5), (None, True, None)}
    assert exact_dedup.exact_groups(D.frame(spark, [])).count() == 0


def check_near(frame, rows):
    expected = D.near(rows)
    got = near_dedup.near_groups(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == expected[r.doc_id], r
    for group in {r.component_id for r in got if r.n_shingles}:
        assert sum(r.kept for r in got if r.component_id == group) == 1


def test_near_groups(spark, rows):
    check_near(D.frame(spark, rows).repartition(5), rows)


def test_near_groups_of_a_table(spark):
    rows = table_rows()
    check_near(spark.read.parquet(f"{FOLDER}/documents.parquet"), rows)


def test_near_large_group_in_blocks(spark, monkeypatch):
    """A block size below the group size: pairs of blocks meet in different tasks."""
    rows = [(i, t, *_) for i, (_, t, *_) in enumerate(D.hostile_documents(5)[:40] * 3)]
    rows = [(i, (t + " tail%d" % (i % 7)) if t else t, *rest) for i, t, *rest in rows]
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "SIGNATURES", 8)
    check_near(D.frame(spark, rows), rows)


def test_near_empty_table(spark):
    assert near_dedup.near_groups(D.frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        near_dedup.near_groups(D.frame(spark, []), percent=50)


def test_buckets_hold_every_pair_within_the_distance():
    """Pigeonhole: whatever DISTANCE positions differ, some bucket key agrees."""
    import numpy as np

    rng = np.random.default_rng(1)
    sig = rng.integers(0, 1 << 16, near_dedup.POSITIONS).astype(np.uint16)
    for _ in range(300):
        other = sig.copy()
        other[rng.choice(near_dedup.POSITIONS, near_dedup.DISTANCE, replace=False)] ^= 1
        keys = near_dedup.bucket_keys(np.array([sig, other]))
        assert (keys[0] == keys[1]).any()


def test_components(spark):
    import random

    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 180)] + [(200, 200), (7, 7)]
    pairs += [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_perhaps_in_keeps_every_key(spark):
    from martloom.llm.common import perhaps_in

    base = spark.range(20_000).selectExpr("xxhash64(id) AS k", "id")
    keys = base.filter("id % 97 = 0").select("k")
    for bits, most in ((1 << 26, 250), (1 << 15, 600)):
        got = {r.id for r in perhaps_in(base, keys, "k", bits).collect()}
        assert set(range(0, 20_000, 97)) <= got and len(got) < most
    assert perhaps_in(base, keys.limit(0), "k").count() == 0


def test_near_groups_from_four_fifths(spark):
    """With percent=80 a pair at 0.82 is linked and one at 0.78 is not; its buckets hold all pairs within the distance."""
    import numpy as np

    texts = []
    for pair, own in enumerate((9, 12)):
        same = ["p%dw%d" % (pair, i) for i in range(104 - own)]
        texts += [" ".join(same + ["p%dx%dy%d" % (pair, side, i) for i in range(own)]) for side in (0, 1)]
    rows = [(i, t, None, None, 0, 0, "") for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(D.frame(spark, rows), percent=80).collect()}
    assert got == {d: group for d, (_, group) in D.near(rows, 80).items()} == {0: 0, 1: 0, 2: 2, 3: 3}
    rng = np.random.default_rng(8)
    chunks = near_dedup.chunks_of(80)
    for _ in range(200):
        sig = rng.integers(0, 65536, near_dedup.POSITIONS).astype(np.uint16)
        other = sig.copy()
        other[rng.choice(near_dedup.POSITIONS, near_dedup.distance_of(chunks), replace=False)] ^= 1
        keys = near_dedup.bucket_keys(np.array([sig, other]), near_dedup.kept_of(chunks))
        assert (keys[0] == keys[1]).any()
