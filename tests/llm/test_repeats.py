"""Repeated strings against all windows in a dictionary, and maximal repeats against all substrings."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

import llm_data as D
from martloom.llm import repeat_dedup
from martloom.llm.suffix_repeats import maximal_repeats

FOLDER = "/root/testdata/sf0.001"


def brute(docs, length=100):
    """(doc_id, text) -> n_bytes, n_removed, n_spans, sha of the rest; ids null last, then any fixed order of one id."""
    seen, out = set(), []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, np.int64)
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(piece)
        mark = np.cumsum(gone)[:-1] > 0
        runs = int((np.diff(np.concatenate(([0], mark.astype(int)))) > 0).sum())
        left = np.frombuffer(data, np.uint8)[~mark].tobytes()
        out.append((doc_id, len(data), int(mark.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def key(row):
    return tuple(str(x) for x in row)


def check(frame, docs):
    got = [tuple(r) for r in repeat_dedup.remove_repeats(frame).collect()]
    assert sorted(got, key=key) == sorted(brute(sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))), key=key)


def test_hostile_documents(spark):
    rnd = random.Random(8)
    rows = D.hostile_documents()
    long = "".join(rnd.choice("abcdé") for _ in range(3000))
    texts = [long, long[500:1500] + "x" + long[1000:], "ab" * 700, "a" * 1000, "a" * 99, "a" * 100, long[:150] * 3, "z" + long[200:299] + "y" + long[300:401]]
    rows += [(500 + i, t, None, None, 0, 0, "") for i, t in enumerate(texts)]
    rows += [(None, long[:400], None, None, 0, 0, ""), rows[0]]
    check(D.frame(spark, rows).repartition(6), [(r[0], r[1]) for r in rows])


@pytest.mark.parametrize("small", [False, True])
def test_a_table(spark, monkeypatch, small):
    if small:  # crowded groups are split, chunks cut documents
        for name, value in (("GROUP", 3), ("CHUNK", 700), ("FLUSH", 5_000), ("SUFFIXES", 2_000)):
            monkeypatch.setattr(repeat_dedup, name, value)
    t = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    check(spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(3), list(zip(t["doc_id"], t["text"])))


def test_empty_table(spark):
    assert repeat_dedup.remove_repeats(D.frame(spark, [])).count() == 0


def test_texts_are_what_is_left(spark):
    rows = [(1, "k" * 10 + "".join(map(str, range(100))), None, None, 0, 0, ""), (2, "".join(map(str, range(100))) + "end", None, None, 0, 0, "")]
    got = {r.doc_id: bytes(r.kept) for r in repeat_dedup.remove_repeats(D.frame(spark, rows), texts=True).collect()}
    assert got == {1: rows[0][1].encode(), 2: b"end"}


def test_maximal_repeats():
    rnd = random.Random(1)
    for case in range(60):
        text = [rnd.choice([0, 1] if case % 2 else [0, 1, 2, 3]) for _ in range(rnd.randrange(2, 60))]
        text += text[: rnd.randrange(0, 30)]
        got = {(size, tuple(sorted(places.tolist()))) for size, places in maximal_repeats(np.array(text), 3)}
        at = {}
        for size in range(3, len(text)):
            for i in range(len(text) - size + 1):
                at.setdefault(tuple(text[i : i + size]), []).append(i)
        expected = set()
        for piece, places in at.items():
            lefts = {text[i - 1] if i else "start" for i in places}
            rights = {text[i + len(piece)] if i + len(piece) < len(text) else "end" for i in places}
            if len(places) > 1 and len(rights) > 1 and (len(lefts) > 1 or "start" in lefts):
                expected.add((len(piece), tuple(places)))
        assert got == expected
