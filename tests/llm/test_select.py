"""Decontamination, mixing and quality against brute force, bounds and held-out ratings."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

import llm_data as D
from martloom.llm import decontaminate, mixing, quality

FOLDER = "/root/testdata/sf0.001"
ITEMS = [
    (1, "w1 w2 w3"),
    (2, "One"),
    (3, None),
    (4, "..."),
    (None, "w5"),
    (5, "a b C d e, f g h i j k l"),
    (5, "日本 🙂"),
    (10, " ".join("w%d" % i for i in range(30))),
]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    out = D.hostile_documents()
    extra = ["x w1-W2.w3 y", "pre a b c d e f g h i j k l post", "w%d" % 3, "日本! 🙂 日本 🙂", " ".join("w%d" % i for i in range(5, 25))]
    return out + [(1000 + i, t, None, "hot", None, 0, "") for i, t in enumerate(extra + [rnd.choice(extra) + " one" for _ in range(20)])]


@pytest.mark.parametrize("block_bytes", [400_000, 30])
def test_contamination(spark, rows, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(D.frame(spark, rows), items, block_bytes=block_bytes, keep=["n_chars"]).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert (r.n_words, r.n_hit, r["items"]) == D.leaks(texts[r.doc_id], ITEMS), r
        assert r.contaminated == (r.n_hit > 0)
        hit = [texts[r.doc_id][s.start : s.stop] for s in r.spans]
        if block_bytes > 30:  # passages lie apart in one automaton
            assert sum(len(D.ITEM_WORD.findall(x)) for x in hit) == r.n_hit


def test_contamination_of_nothing(spark, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(D.frame(spark, rows), none).collect())
    assert decontaminate.contamination(D.frame(spark, []), none).count() == 0


def test_contamination_of_a_table(spark):
    from martloom.llm.queries import op5_benchmark_decontamination

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    got = op5_benchmark_decontamination(spark, FOLDER).collect()
    assert len(got) == len(docs)
    windows = {}
    for item, body in items:
        for w in decontaminate.item_windows(decontaminate.words_of(body.encode())):
            windows.setdefault(tuple(w), set()).add(str(item))
    for r in got:
        w = decontaminate.words_of(docs[r.doc_id].encode())
        hit, found = set(), set()
        for i in range(len(w)):
            own = windows.get(tuple(w[i : i + 10]))
            if own:
                hit.update(range(i, min(len(w), i + 10)))
                found |= own
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(found))


def test_targets():
    assert mixing.targets([100, 100, 100]) == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.targets([]) == [] and mixing.targets([0, 10]) == [0, 15]
    sizes = [5, 1000, 7, 300, 0, 90]
    got = mixing.targets(sizes)
    assert sum(got) == pytest.approx(1.5 * sum(sizes)) and all(t <= 2 * s for t, s in zip(got, sizes))


def test_fit_reaches_the_best_sum():
    rnd = random.Random(5)
    for _ in range(150):
        lengths = sorted(rnd.sample(range(1, 40), rnd.randrange(1, 8)))
        counts = [rnd.randrange(1, 5) for _ in lengths]
        total = sum(n * c for n, c in zip(lengths, counts))
        budget = rnd.randrange(0, total + 2)
        take = mixing.fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        got = sum(n * t for n, t in zip(lengths, take))
        assert abs(got - min(budget, total)) <= max(lengths) / 2
    many = mixing.fit(list(range(1, 3000)), [7] * 2999, 12_345_678)
    assert sum(n * t for n, t in zip(range(1, 3000), many)) == 12_345_678
    assert mixing.fit([0, 3], [5, 1], 1) == [0, 0]


def test_mix(spark, rows):
    frame = D.frame(spark, rows)
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    size, sources = {}, {}
    for doc_id, text, _, source, *_ in rows:
        size[doc_id] = len(D.words(text))
        sources[source] = sources.get(source, 0) + size[doc_id]
    order = sorted(sources, key=lambda s: (s is None, s))
    target = dict(zip(order, mixing.targets([sources[s] for s in order])))
    source = {r[0]: r[3] for r in rows}
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], sources[source[r.doc_id]])
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
    for s in order:
        # the documents without a source are one of 4 000 words and few short ones
        assert abs(taken[s] - target[s]) <= (450 if s is None else 40)
    again = mixing.mix(frame.repartition(9)).collect()
    assert sorted(r[:5] for r in got) == sorted(r[:5] for r in again)
    assert mixing.mix(D.frame(spark, [])).count() == 0


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    truth = rng.normal(size=40) * 2
    rows = [np.flatnonzero(rng.random(40) < 0.3) for _ in range(1500)]
    z = np.array([truth[r].sum() for r in rows]) + rng.logistic(size=1500)
    grades = np.digitize(z, [-1.5, 1.0])
    model = quality.fit_ordinal(rows[:1000], grades[:1000], 3, bits=6, rounds=400, sparse=1e-5)
    assert model.thresholds[0] < model.thresholds[1]
    tails = np.array([model.tails(r) for r in rows[1000:]])
    assert (tails[:, 0] >= tails[:, 1]).all()
    best = np.corrcoef(tails.sum(1), grades[1000:])[0, 1]
    assert best > 0.6
    assert np.corrcoef(model.weights[:40], truth)[0, 1] > 0.9


def test_quality_held_out(spark):
    """Ratings of every third labelled document are kept from the fit."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    ratings = quality.grades_of(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    model = quality.train(docs, ratings.filter("doc_id % 3 <> 0"))
    got = quality.score(docs.select("doc_id", "text"), model).join(ratings.filter("doc_id % 3 = 0"), "doc_id").collect()
    good = [r.kept for r in got if r.grade == 2]
    junk = [r.kept for r in got if r.grade == 0]
    assert len(good) > 800 and np.mean(good) > 0.97
    assert np.mean(junk) < 0.03
    mean = lambda g: np.mean([r.expected_grade for r in got if r.grade == g])
    assert mean(0) < mean(1) < mean(2)


def test_quality_hostile_rows(spark, rows):
    labels = spark.createDataFrame([(i, i % 2, None, 1) for i in range(60)] + [(None, 1, 0, 1), (3, None, None, 1)], "doc_id long, quality int, toxic int, text int")
    got = quality.classify(D.frame(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.p_ge_2 <= r.p_ge_1 <= 1 for r in got)
    none = quality.classify(D.frame(spark, rows), labels.limit(0)).collect()
    assert all(r.kept and r.expected_grade is None for r in none)
    assert quality.classify(D.frame(spark, []), labels).count() == 0
