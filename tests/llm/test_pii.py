"""Base spans against Python's matching, and the trees on counted examples."""

import hashlib
import re

import pyarrow.parquet as pq

import llm_data as D
from martloom.llm import pii, queries

FOLDER = "/root/testdata/sf0.001"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


TEXTS = [
    "🙂 é a@b.c_d@e.f x@y a.b@c-d.e..f @ me@@x.y.z",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.003.4 1.2.3 999.1.2.3.4.5.6.7",
    "4465 7583 8288 9437 4465758382889437 4465-7583-8288-9438 4465  7583 44657583828894370",
    "+1 (743) 555-3824 +12 34 +1234567890123456 + 1 +49.30.1234567) (743) 555-3824 tel 743-555-3824",
    "mail joe (at) example (dot) com or joe[at]example.com, call 0049 (743) 555-3824",
    "a@" + ".".join(["b"] * 3000) + " " + "1" * 5000 + " " + "x" * 20000 + " " + "7 " * 3000,
    "",
    None,
]


def test_base_spans(spark):
    rows = [(i, t, None, None, 0, 0, "") for i, t in enumerate(TEXTS)] + D.hostile_documents() + [(None, TEXTS[2], None, None, 0, 0, "")] * 2
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    got = {r.doc_id: r for r in pii.personal_data(D.frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        found = [(pii.KINDS[s.kind - 1], s.start, s.stop) for s in r.base_spans]
        assert found == base(text), (text or "")[:80]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in found) for k in pii.KINDS]
        everything = [(pii.KINDS[s.kind - 1], s.start, s.stop) for s in r.all_spans]
        assert set(found) <= set(everything)
    assert pii.personal_data(D.frame(spark, [])).count() == 0


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    for r in queries.op8_pii(spark, FOLDER).collect():
        spelled = ",".join("%s:%d:%d" % s for s in base(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert set(filter(None, spelled.split(","))) <= set(r.spans.split(","))


def test_only_native_operators(spark):
    plan = pii.personal_data(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_boosting_and_threshold():
    """Positive only where a phone has enough digits and a word before it."""
    table = []
    for digits in range(8):
        for word in range(2):
            good = digits >= 4 and word
            table.append(dict.fromkeys(pii.FEATURES, 0) | {"f_digits": digits, "f_word": word, "n": 50, "positive": 49 if good else 1})
    start, trees = pii.boost(table)
    cut = pii.threshold(table, start, trees)
    for r in table:
        assert (pii.tree_score(start, trees, r.get) >= cut) == bool(r["f_digits"] >= 4 and r["f_word"])
    assert pii.boost([]) == (0.0, []) and pii.threshold([], 0.0, []) == float("inf")


def test_wide_candidates_are_added(spark):
    """Phones without a country code are redacted where like ones with it are common."""
    rows = [(i, "call phone: +1 743-555-%04d now" % i, None, None, 0, 0, "") for i in range(60)]
    rows += [(100, "call phone: 743-555-3824 now", None, None, 0, 0, ""), (101, "no data", None, None, 0, 0, "")]
    got = {r.doc_id: r for r in pii.personal_data(D.frame(spark, rows)).collect()}
    assert [(s.kind, s.start, s.stop) for s in got[100].all_spans] == [(4, 12, 24)] and not got[100].base_spans
    assert got[101].all_spans == []
