"""The pipeline against brute-force versions of its stages, stage by stage."""

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
import llm_data as D
from martloom.llm import decontaminate, mixing
from martloom.session import stage

FOLDER = "/root/testdata/sf0.01"


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def without_leaks(docs):
    items = pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()
    windows = {tuple(w) for r in items for w in decontaminate.item_windows(decontaminate.words_of((r["text"] or "").encode()))}
    assert all(len(w) == 10 for w in windows)
    out = set()
    for d, t in docs.items():
        w = decontaminate.words_of((t or "").encode())
        if not any(tuple(w[i : i + 10]) in windows for i in range(len(w))):
            out.add(d)
    return out


def test_stages(spark):
    """Each stage's rows follow from its own input; the labelled good documents pass the first."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    before = texts(docs)
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        docs = stage(function(spark, docs, FOLDER), f"test-{name}")
        rows = docs.collect()
        now = {r.doc_id: r.text for r in rows}
        assert len(rows) == len(now) and all(before[d] == t for d, t in now.items())
        if number < 4:
            assert docs.columns == columns
        if number == 0:
            labels = {r["doc_id"]: r for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
            good = [d for d, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
            junk = [d for d, r in labels.items() if r["quality"] == 0]
            assert sum(d in now for d in good) > 0.97 * len(good) and sum(d in now for d in junk) < 0.05 * len(junk)
        elif number == 1:
            exact = D.exact(list(before.items()))
            assert set(now) == {d for d, (keep, *_) in exact.items() if keep == d}
        elif number == 2:
            near = D.near(list(before.items()), percent=80)
            assert set(now) == {d for d, (_, group) in near.items() if group == d}
        elif number == 3:
            assert set(now) == without_leaks(before)
        else:
            size = {d: len(D.words(t)) for d, t in before.items()}
            source = {r.doc_id: r.source for r in rows}
            assert all(r.mix_size == size[r.doc_id] and r.mix_taken in (r.mix_size, 2 * r.mix_size) for r in rows)
            for s in set(source.values()):
                own = [r for r in rows if r.source == s]
                assert abs(sum(r.mix_taken for r in own) - own[0].mix_target) <= 200
        before = now


def test_hostile_rows_keep_their_columns(spark):
    """Nulls, repeats and clashing names; of repeated rows one stays."""
    rows = D.hostile_documents() + [(None, "no id " * 9, None, None, 1, 1, "y"), (None, None, None, None, None, None, None)]
    docs = D.frame(spark, rows).withColumnRenamed("lang", "mix_taken").withColumnRenamed("n_chars", "_k1")
    exact = corpus_pipeline.exact_copies(spark, docs, FOLDER)
    assert exact.columns == docs.columns
    kept = stage(exact, "test-exact")
    assert kept.count() == len({D.WHITE.sub("", r[1] or "") for r in rows})
    near = stage(corpus_pipeline.near_copies(spark, docs, FOLDER), "test-near")
    groups = D.near([r for r in rows if r[0] is not None], percent=80)
    wordless = sum(not D.shingles(r[1]) for r in rows)
    assert near.count() == len({g for n, g in groups.values() if n}) + 1 + wordless
    clean = corpus_pipeline.benchmark_leaks(spark, docs, FOLDER)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    mixed = corpus_pipeline.target_weights(spark, docs, FOLDER)
    assert mixed.columns == [*docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_taken_"]
    assert mixed.filter("mix_taken_ is null").count() == 0
    scored = corpus_pipeline.quality_classifier(spark, docs, FOLDER)
    assert scored.columns == docs.columns


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, name):
    empty = D.frame(spark, [])
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, FOLDER).count() == 0


def test_mix_targets_of_no_source():
    assert mixing.targets([]) == []
