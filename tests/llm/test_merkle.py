"""Merkle manifest against a direct computation in Python."""

import hashlib
import zlib

import pyarrow.parquet as pq

import llm_data as D
from martloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    if v is None:
        return "-"
    s = str(v)
    return f"{len(s.encode())}:{s}"


def leaf(doc_id, source, lang, n_chars, text):
    return h(*(field(v) for v in (doc_id, source, lang, n_chars, text)))


def build(nodes):
    """Levels bottom up of one tree."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        cur = levels[-1]
        levels.append([h(*cur[i : i + 2]) for i in range(0, len(cur), 2)])
    return levels


def path(levels, i):
    steps = []
    for level in levels[:-1]:
        j = i ^ 1
        steps.append((level[j] if j < len(level) else None, i % 2 == 0))
        i //= 2
    return steps


def fold(d, steps):
    for sib, left in steps:
        d = h(d) if sib is None else h(d, sib) if left else h(sib, d)
    return d


def brute(rows):
    """doc_id-ordered rows -> list of (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    by = {}
    for r in rows:
        doc_id, text, lang, source, n_chars = r[:5]
        by.setdefault(lang, []).append((doc_id, source, lang, n_chars, text))
    key = lambda lang: (lang is not None, (lang or "").encode())
    langs = sorted(by, key=key)
    trees = {}
    for lang in langs:
        items = sorted(by[lang], key=lambda t: (t[0] is not None, t[0] or 0, leaf(*t)))
        trees[lang] = (items, build([leaf(*t) for t in items]))
    upper = build([trees[lang][1][-1][0] for lang in langs])
    root = upper[-1][0]
    out = []
    for g, lang in enumerate(langs):
        items, levels = trees[lang]
        above = path(upper, g)
        for i, t in enumerate(items):
            steps = path(levels, i) + above
            tampered = t[3] + 1 if t[0] is not None and t[3] is not None and zlib.crc32(str(t[0]).encode()) % 7 == 0 else t[3]
            folded = fold(leaf(t[0], t[1], t[2], tampered, t[4]), steps)
            proof = h(*[s for s, _ in steps if s is not None])
            out.append((t[0], leaf(*t), levels[-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def spark_rows(frame):
    got = frame.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted((tuple(r) for r in got), key=str)


def test_manifest_hostile(spark):
    rows = D.hostile_documents()
    got = spark_rows(merkle.manifest(D.frame(spark, rows).repartition(3)))
    assert got == brute(rows)
    # extra columns with clashing names are ignored
    assert "leaf" not in D.frame(spark, rows).columns


def test_manifest_shapes(spark):
    for n in (1, 2, 3, 5, 8, 9):
        rows = [(i, "t%d" % i, "en" if i % 3 else None, "s", i) + (0, "") for i in range(n)]
        got = spark_rows(merkle.manifest(D.frame(spark, rows)))
        assert got == brute(rows), n
    one = [(7, "x", "en", "s", 1, 0, "")]
    (r,) = spark_rows(merkle.manifest(D.frame(spark, one)))
    assert r[1] == r[2] == r[3]  # a lone leaf is subroot and root


def test_manifest_table_and_tampering(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    rows = [(d, x, la, so, n, 0, "") for d, x, la, so, n in zip(t["doc_id"], t["text"], t["lang"], t["source"], t["n_chars"])]
    got = spark_rows(merkle.manifest(D.frame(spark, rows).repartition(5)))
    assert got == brute(rows)
    for r in got:
        assert r[6] == (not merkle.crc_tampered(r[0]))


def test_manifest_empty(spark):
    assert merkle.manifest(D.frame(spark, [])).count() == 0
