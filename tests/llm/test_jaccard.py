"""Jaccard components of 3-word shingle sets against all pairs."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F
import pytest

import llm_data as D
from martloom.llm import jaccard_join as J


def shingles(text, size=3):
    w = D.words(text)
    if not w:
        return set()
    k = min(size, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, percent=90):
    sets = {i: shingles(r[1]) for i, r in enumerate(rows)}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    items = list(sets)
    for a in items:
        for b in items:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * len(sets[a] | sets[b]):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    ids = {}
    for i in items:
        if sets[i]:
            ids.setdefault(top(i), []).append(rows[i][0])
    out = []
    for i in items:
        if not sets[i]:
            out.append((rows[i][0], 0, rows[i][0]))
        else:
            known = [d for d in ids[top(i)] if d is not None]
            out.append((rows[i][0], len(sets[i]), min(known) if known else None))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    got = J.jaccard_components(D.frame(spark, rows), **kw).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


@pytest.mark.parametrize("leaf,pivots", [(10_000, 16), (12, 3), (5, 2)])
def test_hostile_against_all_pairs(spark, leaf, pivots):
    rows = D.hostile_documents()
    rows.append((None, rows[0][1], None, None, None, 0, ""))  # a null id in a group
    assert run(spark, rows, leaf=leaf, pivots=pivots) == brute(rows)


def test_table_against_all_pairs(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    rows = [(d, x, la, so, n, 0, "") for d, x, la, so, n in zip(t["doc_id"], t["text"], t["lang"], t["source"], t["n_chars"])]
    assert run(spark, rows, leaf=40, pivots=4) == brute(rows)


def test_other_threshold_and_empty(spark):
    rows = D.hostile_documents()[:60]
    assert run(spark, rows, percent=80, leaf=8, pivots=3) == brute(rows, 80)
    assert run(spark, []) == []


def test_hot_prefix_order(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT", 1)  # most shingles count as hot: the order changes, the result does not
    rows = D.hostile_documents()
    assert run(spark, rows, leaf=12, pivots=3) == brute(rows)
    frame = D.frame(spark, rows)
    distinct = J.sets(frame).filter("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    bits = J._hot_map(distinct, 90, 1)
    assert bits.any()


def test_full_sets_are_not_stored(spark, monkeypatch):
    words = lambda i: [f"w{(i * 7919 + j * 31) % 100_003}" for j in range(300)]
    rows = [(i, " ".join(words(i // 2) + ["x"] * (i % 2)), None, None, None, 0, "") for i in range(80)]
    rows += [(100 + i, " ".join(f"u{i}_{j}" for j in range(300)), None, None, None, 0, "") for i in range(40)]
    stored, stage = [], J.stage

    def counted(frame, name):
        out = stage(frame, name)
        if "shingles" in out.columns:
            stored.append(out.agg(F.sum(F.size("shingles"))).first()[0] or 0)
        return out

    monkeypatch.setattr(J, "stage", counted)
    got = run(spark, rows[80:], leaf=30, pivots=3)
    assert got == brute(rows[80:])
    assert max(stored) < 0.5 * sum(n for _, n, _ in got)
    assert run(spark, rows, leaf=30, pivots=3) == brute(rows)


def test_near_copies_do_not_make_all_pairs(spark, monkeypatch):
    base = [f"w{j}" for j in range(120)]
    rows = []
    for i in range(60):  # one word changed: any two differ in up to six of 118 shingles
        text = list(base)
        text[i * 2] = f"x{i}"
        rows.append((i, " ".join(text), None, None, None, 0, ""))
    pairs, verified = [], J._verified

    def counted(found, *rest):
        pairs.append(found.count())
        return verified(found, *rest)

    monkeypatch.setattr(J, "_verified", counted)
    assert run(spark, rows) == brute(rows)
    assert sum(pairs) < 60 * 59 / 4


def candidates(count):
    """Texts of which any two share most of their prefixes; they link only next to each other."""
    rows = []
    for i in range(count):  # two words changed for each step: eight steps differ in every tenth shingle
        text = [f"w{j}" for j in range(200)]
        for k in range(i % 24):
            text[8 * k : 8 * k + 1] = [f"x{i // 24}_{k}"]
        rows.append((i, " ".join([*text, f"e{i}"]), None, None, None, 0, ""))
    return rows


@pytest.mark.parametrize("block", [128, 7])
def test_pairs_of_near_copies_are_no_rows(spark, monkeypatch, block):
    """A large group that the first components leave apart is compared in blocks."""
    rows = candidates(240)
    monkeypatch.setattr(J, "BLOCK", block, raising=False)
    stored, stage = {}, J.stage

    def counted(frame, name):
        out = stage(frame, name)
        stored[name] = max(stored.get(name, 0), out.count())
        return out

    monkeypatch.setattr(J, "stage", counted)
    assert run(spark, rows) == brute(rows)
    # all pairs left by the first components would be many times the rows
    assert max(stored.get(name, 0) for name in ("jaccard-pairs", "jaccard-groups", "jaccard-links")) <= 2 * len(rows), stored
    assert stored["jaccard-groups"] > 128


def test_rows_go_to_python_in_small_batches(spark, monkeypatch):
    """A task holds few texts at once, whatever Spark's batches are; the session's setting is put back."""
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(400)), None, None, None, 0, "") for i in range(60)]
    docs = D.frame(spark, rows).coalesce(1)
    seen = []

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["b"])

    stage = J.stage

    def noted(frame, name):
        if name == "jaccard-sets":
            seen.extend(r.b for r in J._texts(docs).select("data").mapInArrow(sizes, "b long").collect())
        return stage(frame, name)

    monkeypatch.setattr(J, "stage", noted)
    monkeypatch.setattr(J, "BATCH", 20_000, raising=False)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    assert run(spark, rows) == brute(rows)
    assert max(seen) < 30_000
    assert spark.conf.get(name) == before


def test_first_shingles_rule_out(spark):
    """Pairs left out by their first shingles are below the threshold; the order of values is unsigned."""
    import numpy as np

    made = np.random.default_rng(3)
    sets, kept = {}, []
    for i in range(40):
        x = np.unique(made.integers(0, 1 << 64, 100, dtype=np.uint64))
        y = np.unique(np.concatenate([x[made.permutation(len(x))[i:]], made.integers(0, 1 << 64, i // 2, dtype=np.uint64)]))
        sets[2 * i], sets[2 * i + 1] = x, y
    rows = [(sid, len(x), J._head(x, 90).view(np.int64).tolist()) for sid, x in sets.items()]
    classes = spark.createDataFrame(rows, "sid long, n long, shingles array<long>")
    pairs = [(a, b) for a in sets for b in sets if a < b]
    kept = {(r.a, r.b) for r in J._possible(spark.createDataFrame(pairs, "a long, b long"), classes, 90).collect()}
    for a, b in pairs:
        common = len(np.intersect1d(sets[a], sets[b]))
        if 100 * common >= 90 * (len(sets[a]) + len(sets[b]) - common):
            assert (a, b) in kept
    assert len(kept) < len(pairs) / 10


def test_edited_copies_are_no_candidates(spark, monkeypatch):
    """Copies with more changes of their own than a link allows are not compared with each other."""
    rows = []
    for i in range(150):
        text = [f"w{j}" for j in range(200)]
        for k in range(15 if i < 140 else 2):
            text[(13 * k + 7 * i) % 200] = f"x{i}_{k}"
        rows.append((i, " ".join(text), None, None, None, 0, ""))
    rows += [(200 + i, " ".join(f"u{i}_{j}" for j in range(200)), None, None, None, 0, "") for i in range(200)]
    stored, stage = {}, J.stage

    def counted(frame, name):
        out = stage(frame, name)
        stored[name] = max(stored.get(name, 0), out.count())
        return out

    monkeypatch.setattr(J, "stage", counted)
    assert run(spark, rows) == brute(rows)
    assert stored.get("jaccard-groups", 0) <= 20, stored


@pytest.mark.parametrize("percent", [80, 90, 97])
def test_sizes_across_classes(spark, percent):
    """Links between sets of every difference in size that the threshold allows."""
    rows = []
    for i in range(60):  # nested texts of two kinds, some with a change of their own
        text = [f"{'ab'[i % 2]}{j}" for j in range(20 + 2 * i)]
        if i % 5 == 0:
            text[i % len(text)] = f"x{i}"
        rows.append((i, " ".join(text), None, None, None, 0, ""))
    assert run(spark, rows, percent=percent) == brute(rows, percent)


def test_tables_go_when_read(spark, monkeypatch):
    """First shingles are stored once, and full sets only until their pairs are verified."""
    import os

    rows = D.hostile_documents()
    files, stage = {}, J.stage

    def noted(frame, name):
        out = stage(frame, name)
        files.setdefault(name, []).extend(f.removeprefix("file://") for f in out.inputFiles())
        return out

    monkeypatch.setattr(J, "stage", noted)
    got = J.jaccard_components(D.frame(spark, rows), leaf=12, pivots=3)
    for name in ("jaccard-sets", "jaccard-whole", "jaccard-prefixes"):
        assert files[name] and not any(map(os.path.exists, files[name])), name
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(rows)


def test_discard_keeps_other_files(spark, tmp_path):
    from martloom.session import discard, stage

    spark.range(5).write.parquet(str(tmp_path / "in.parquet"))
    given = spark.read.parquet(str(tmp_path / "in.parquet"))
    mine, other = stage(given, "mine"), stage(given, "other")
    discard(mine.unionByName(given))
    assert given.count() == other.count() == 5
    with pytest.raises(Exception):
        mine.count()
