"""WARC and token files: round trips, sameness of repeated writes, licenses against all windows."""

import gzip
import hashlib
import pathlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import llm_data as D
from martloom.llm import licenses, queries, token_files, warc

FOLDER = "/root/testdata/sf0.001"


def hostile_pages():
    body = "<p>ä" + "same " * 40 + "</p>"
    rows = [(i, "http://h/%d" % (i % 3), body, "x", i) for i in range(40, 10, -1)]
    rows += [(50, None, None, "x", 0), (51, "http://h/\r\nWARC-Type: x", "", None, 0), (52, "u", "short", None, 0), (53, "u", "short", None, 0)]
    rows += [(60, "u", "z" * 3_000_000, None, 0), (61, "u", "\r\n\r\nWARC/1.1\r\n" * 50, None, 0), (2**60 + 1, "u", "big" * 50, None, 0), (2**60, "u", "big" * 50, None, 0)]
    rows += [(12, "again", body, None, 0), (70, "u", "twice " * 30, None, 0), (70, "u", "twice " * 30, None, 0), (None, "u", body, None, 0), (None, "u", None, None, 0)]
    return rows


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha string, shard int")


def expected(rows):
    first, seen, out = {}, set(), []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        if page is not None:
            first[data] = min(page, first.get(data, page))
    for page, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        revisit = len(data) >= 100 and ((data in first and first[data] != page) or (page, data) in seen)
        seen.add((page, data))
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first.get(data) if revisit else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark, tmp_path):
    rows = hostile_pages()
    files = {}
    for name, parts in (("a", 4), ("b", 7)):
        out = str(tmp_path / name)
        manifest = warc.write_warc(pages_frame(spark, rows).repartition(parts), out, shard_bytes=3_000, roll_bytes=700).collect()
        got = warc.read_warc(spark, out).collect()
        assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(rows)
        assert {bytes(r.payload) for r in got if r.record_type == "response"} == {(r[2] or "").encode() for r in rows}
        assert len({m.shard for m in manifest}) > 2 and any(m.seq for m in manifest)
        assert not list(pathlib.Path(out, "_temporary").iterdir())
        files[name] = {p.name: p.read_bytes() for p in pathlib.Path(out).glob("*.warc.gz")}
    assert files["a"] == files["b"] and len(files["a"]) == len(manifest)
    text = gzip.decompress(next(iter(files["a"].values())))
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_warc_damage_is_noticed(spark, tmp_path):
    out = str(tmp_path / "w")
    warc.write_warc(pages_frame(spark, hostile_pages()), out)
    path = next(pathlib.Path(out).glob("*.warc.gz"))
    path.write_bytes(path.read_bytes()[:-40] + b"x" * 40)
    with pytest.raises(Exception, match="not the file that was written"):
        warc.read_warc(spark, out).collect()


def test_warc_members_across_slices():
    rnd = random.Random(4)
    blocks = [rnd.randbytes(n) for n in (0, 1, warc.SLICE, 5 * warc.SLICE, 3)] + [b"z" * 3_000_000]
    # records that end right at, before and after the end of a slice
    blocks += [rnd.randbytes(n) for n in range(warc.SLICE - 140, warc.SLICE - 60)]
    records = [warc.record([("X-Page", i)], block) for i, block in enumerate(blocks)]
    assert {len(r) for r in records} >= {warc.SLICE - 1, warc.SLICE, warc.SLICE + 1}
    for packed in (b"".join(records), *records):
        got = [warc.parse(raw)[1] for raw in warc.members(packed)]
        assert got == (blocks if len(got) > 1 else [blocks[records.index(packed)]])
    whole = records[3] + records[4]
    for cut in (1, 9, 18, len(records[3]) - 1, len(records[3]) + 1, len(whole) - 1):
        with pytest.raises(ValueError, match="cut off"):
            list(warc.members(whole[:cut]))


def test_warc_members_do_not_copy_the_rest_of_the_file(monkeypatch):
    fed, real = [], zlib.decompressobj

    class Counting:
        def __init__(self, *args):
            self.inner = real(*args)

        def decompress(self, data):
            fed.append(len(data))
            return self.inner.decompress(data)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    data = b"".join(warc.record([("X-Page", i)], b"small") for i in range(5_000))
    assert sum(1 for _ in warc.members(data)) == 5_000
    assert sum(fed) <= len(data) + 5_000 * (16 << 10)


def test_warc_empty(spark, tmp_path):
    out = str(tmp_path / "w")
    assert warc.write_warc(pages_frame(spark, []), out).count() == 0
    assert warc.read_warc(spark, out).count() == 0


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_blocks_are_stitched(spark, tmp_path, block):
    rnd = random.Random(block)
    rows, truth = [], {}
    for f in range(5):
        lengths = [rnd.choice([0, 0, 1, 2, 5, 30]) for _ in range(rnd.randrange(0, 15))]
        tail = f % 2 * 4
        tokens = [t for n in lengths for t in [*([7] * n), 9]] + [7] * tail
        (tmp_path / f"f{f}").write_bytes(np.array(tokens, np.uint16).tobytes())
        rows.append((f"f{f}", len(tokens)))
        truth |= {(f"f{f}", k): n for k, n in enumerate(lengths + ([tail] if tail else []))}
    files = spark.createDataFrame(rows, "file string, size long")
    got = token_files.document_lengths(spark, files, str(tmp_path), 9, 2, block).collect()
    assert {(r.file, r.ordinal): r.n_tokens for r in got} == truth and len(got) == len(truth)


def test_token_counts(spark, tmp_path):
    from public_tokenizers import PATTERN

    rows = D.hostile_documents() + [(None, "no id", None, None, 0, 0, "")]
    encoder = token_files.load_tokenizer(open(queries.VOCABULARY, "rb").read(), PATTERN)
    got = token_files.token_counts(D.frame(spark, rows).repartition(3), str(tmp_path), queries.VOCABULARY, PATTERN, queries.SEPARATOR, block_tokens=500).collect()
    truth = sorted((str(r[0]), len(encoder.encode_ordinary(r[1] or ""))) for r in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == truth
    none = token_files.token_counts(D.frame(spark, []), str(tmp_path / "none"), queries.VOCABULARY, PATTERN, queries.SEPARATOR)
    assert none.count() == 0


def words_of(text):
    return (text or "").encode().translate(licenses.NORMAL).split()


def brute_licenses(text, templates, contained=0.8):
    """Every window of a template's scale, compared shingle by shingle."""
    words, out = words_of(text), {}
    for name, template in templates:
        t = words_of(template)
        if not t:
            continue
        size = min(5, len(t))
        want = {tuple(t[i : i + size]) for i in range(len(t) - size + 1)}
        have = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        scale = next(s for s in licenses.SCALES if s >= len(t) - size + 1)
        width, step = licenses.window_of(scale)
        places = list(range(0, max(1, len(have) - width + 1), step)) + [max(0, len(have) - width)]
        best = max(len(want & set(have[p : p + width])) / len(want) for p in places)
        if best >= contained:
            out[name] = best
    return out


def test_licenses(spark):
    rnd = random.Random(6)
    noise = lambda n: " ".join("w%d" % rnd.randrange(50) for _ in range(n))
    texts = [None, "", "x", "all rights", "ALL rights\nreserved", noise(3000)]
    for name, template in licenses.TEMPLATES:
        for before in (0, 1, 7, 40):
            texts.append(noise(before) + " " + template.upper() + "\n" + noise(rnd.randrange(50)))
        words = template.split()
        for _ in range(6):
            own = list(words)
            own[rnd.randrange(len(own))] = "changed"
            texts.append(noise(20) + " " + " ".join(own) + " " + noise(5))
    rows = [(i, t, None, None, 0, 0, "") for i, t in enumerate(texts)] + [(r[0] + 1000, *r[1:]) for r in D.hostile_documents()]
    got = {r.doc_id: {x.license: x.part for x in r.found} for r in licenses.license_scan(D.frame(spark, rows)).collect()}
    for doc_id, text, *_ in rows:
        assert got[doc_id] == pytest.approx(brute_licenses(text, licenses.TEMPLATES)), text
    assert licenses.license_scan(D.frame(spark, [])).count() == 0
    assert all(r.found == [] for r in licenses.license_scan(D.frame(spark, rows), templates=[("none", "...")]).collect())


def test_license_query_on_a_table(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    found = 0
    for r in queries.op7_license_scan(spark, FOLDER).collect():
        truth = brute_licenses(texts[r.doc_id], licenses.TEMPLATES)
        assert r.licenses == ",".join(sorted(truth)) and r.n_licenses == len(truth)
        found += len(truth)
    assert found


def test_bodies_and_versions(spark):
    """Whole license bodies are found, each under its own name, and a version is not taken for another."""
    gnu = "This work is licensed under the GNU General Public License, version %s."
    header = "This program is free software; you can redistribute it and/or modify it under the terms of the %s as published by the Free Software Foundation; either version %s of the License, or (at your option) any later version."
    cases = {"gpl-2.0": gnu % 2, "gpl-3.0": gnu % 3, "gpl-2.0 ": header % ("GNU General Public License", 2), "lgpl-2.1": header % ("GNU Lesser General Public License", "2.1")}
    cases |= {"agpl-3.0": header % ("GNU Affero General Public License", 3), "cc-by-4.0": "Licensed under CC BY 4.0.", "cc-by-sa-4.0": "http://creativecommons.org/licenses/by-sa/4.0/"}
    cases |= {name[:-5] + "  ": text for name, text in licenses.TEXTS}
    texts = list(cases.values()) + [dict(licenses.TEXTS)["bsd-2-clause-text"] + "\n" + "other words here " * 200 + dict(licenses.TEXTS)["bsd-3-clause-text"]]
    found = licenses.license_scan(D.frame(spark, [(i, t, None, None, 0, 0, "") for i, t in enumerate(texts)]), templates=licenses.ALL_TEMPLATES, families=licenses.FAMILIES).collect()
    names = {r.doc_id: {x.license for x in r.found} for r in found}
    bodies = lambda i: {n for n in names[i] if n.endswith("-text")}
    for i, case in enumerate(cases):
        if case.endswith("  "):
            assert bodies(i) == {case.strip() + "-text"}, (case, names[i])
        else:
            versions = {n.rsplit("-", 1)[0] for n in names[i]} - {"gpl"}
            assert versions == {case.strip()}, (case, names[i])
    assert bodies(len(cases)) == {"bsd-2-clause-text", "bsd-3-clause-text"}
