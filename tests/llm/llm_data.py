"""Small hostile documents and brute-force versions of the operators' rules."""

import hashlib
import random
import re

from pyspark.sql import types as T

WHITE = re.compile("[\x20\x09-\x0d]")
WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def hostile_documents(seed=3):
    """Rows (doc_id, text, lang, source, n_chars, _row, n_words): near and exact copies, nulls, repeats, a hot source."""
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["Ärger", "naïve", "日本", "🙂"]
    line = " ".join(rnd.choice(vocabulary) for _ in range(30))
    rows, n = [], 0

    def add(text, source="hot"):
        nonlocal n
        rows.append((n, text, None if n % 5 else "en", source, None if text is None else len(text), n % 3, "x"))
        n += 1

    base = [rnd.choice(vocabulary) for _ in range(120)]
    for k in range(40):  # a spectrum of near copies
        own = list(base)
        for _ in range(k % 12):
            own[rnd.randrange(120)] = rnd.choice(vocabulary)
        add(" ".join(own), None if k % 9 == 0 else "hot")
    for k in range(25):
        add(" ".join(base[:60]) + (" " * (k % 4)) + "\n", "b%d" % (k % 3))
    for k in range(40):
        add(" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 80))) + ("\n" + line if k % 3 == 0 else ""), "c")
    for text in (None, None, "", " \t\n", "one", "one", "One", "one two three", "a b c d e", "A b c d e", "x" * 5000, "ab " * 4000, "\x0b\x0c\r"):
        add(text, None)
    rows.append(rows[3])  # repeated rows
    rows.append(rows[3])
    return rows


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("_row", T.IntegerType()),
        T.StructField("n_words", T.StringType()),
    ]
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def exact(rows):
    """doc_id -> (keep_id, group_size, sha) by comparison of whole normalised texts."""
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(WHITE.sub("", text or ""), []).append((-len(text or ""), doc_id))
    return {
        doc_id: (min(groups[WHITE.sub("", text or "")])[1], len(groups[WHITE.sub("", text or "")]), hashlib.sha256(WHITE.sub("", text or "").encode()).hexdigest())
        for doc_id, text, *_ in rows
    }


def shingles(text):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def near(rows, percent=85):
    """doc_id -> (n_shingles, component_id) from all pairs."""
    sets = {}
    for doc_id, text, *_ in rows:
        sets[doc_id] = shingles(text)
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    tried = set()
    for members in by.values():
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                if (a, b) in tried:
                    continue
                tried.add((a, b))
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * len(sets[a] | sets[b]):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    return {d: (len(s), top(d)) for d, s in sets.items()}


ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def leaks(text, items, size=10):
    """n_words, n_hit, sorted items, by comparing every run of words."""
    w = ITEM_WORD.findall((text or "").translate(UPPER))
    hit, found = set(), set()
    for item, body in items:
        v = ITEM_WORD.findall((body or "").translate(UPPER))
        if not v:
            continue
        for i in range(max(1, len(v) - size + 1)):
            window = v[i : i + size]
            for j in range(len(w) - len(window) + 1):
                if w[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
                    if item is not None:  # an item without id hits, but is not listed
                        found.add(str(item))
    return len(w), len(hit), sorted(found)
