"""Ordinal cumulative-link regression on graded ratings over hashed text features.

P(grade >= k) = sigmoid(w.x - t_k) with one weight vector for all grades and ordered
thresholds t_1 < t_2 < ...; x holds presences of hashed words, of character counts by size and
of a few proportions, so a feature counts alike in short and in long texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bytes_of

BITS = 18
TRAIN_ROWS = 12_000  # labelled rows that the fit reads, about; chosen by a hash of the id
ROWS_AT_ONCE = 1_000  # of a step of the fit
KEEP_PROBABILITY = 0.7  # of the best grade; above one half, since few good documents score between

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_GRAPHIC = [b for b in range(33, 127) if not chr(b).isalnum()]


class WordIndex(dict):
    """Hashed feature numbers of a word and of its first bytes (inflected forms share them); a bounded memo."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 500_000:
            self.clear()
        parts = [word, *(b" start " + word[:n] for n in (4, 5) if len(word) > n and word[:1] != b" ")]
        self[word] = found = tuple(xxhash.xxh64_intdigest(part) & self.mask for part in parts)
        return found


def level(part: float) -> int:
    """A proportion as a number of halvings, 0 (one or more) to 12 (none)."""
    return 12 if part <= 0 else min(11, max(0, int(-np.log2(part))))


def features(data: bytes, index: WordIndex) -> np.ndarray:
    """Distinct feature numbers of a text, sorted."""
    words = data.translate(_WORDS).split()
    names = set(words)
    distinct = len(names)
    if words:
        count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        letters = max(1, int(count[65:91].sum() + count[97:123].sum() + count[128:].sum()))
        signs = [(b" sign %d %d" % (b, level(count[b] / len(words)))) for b in _GRAPHIC if count[b]]
        names.update(signs)
        names.add(b" upper %d" % level(count[65:91].sum() / letters))
        names.add(b" digit %d" % level(count[48:58].sum() / letters))
        names.add(b" other %d" % level(sum(int(count[b]) for b in _GRAPHIC) / len(words)))
        names.add(b" new words %d" % int(10 * distinct / len(words) / min(1.0, 3 / np.log10(len(words) + 9))))
        lines = [x for x in data.split(b"\n") if x]
        names.add(b" new lines %d" % int(10 * len(set(lines)) / max(1, len(lines))))
    names.add(b" size %d" % min(20, len(words).bit_length()))
    return np.sort(np.fromiter(set(chain.from_iterable(map(index.__getitem__, names))), np.int64))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def tails(self, found: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[found].sum(), -500, 500)))


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, levels: int, bits: int = BITS, rounds: int = 250, rate: float = 0.05, sparse: float = 1e-4
) -> Model:
    """Maximum likelihood with an L1 penalty by proximal steps of adaptive size.

    Features that fewer than three rows have are left out. The result does not depend on the
    order of equal rows.
    """
    n = max(1, len(rows))
    seen = np.zeros(1 << bits, np.int64)
    for row in rows:
        seen[row] += 1
    names = np.flatnonzero(seen >= 3)
    to = np.full(1 << bits, -1, np.int32)
    to[names] = np.arange(len(names), dtype=np.int32)
    # rows in blocks, so that a step needs little memory beside the feature numbers
    blocks = []
    for start in range(0, len(rows), ROWS_AT_ONCE):
        kept = [found[found >= 0] for found in (to[row] for row in rows[start : start + ROWS_AT_ONCE])]
        blocks.append((start, np.array([len(k) for k in kept]), np.concatenate(kept)))
    # ordered thresholds: the first and logarithms of the gaps
    share = np.clip([(grades >= k).mean() for k in range(1, levels)], 1e-3, 1 - 1e-3)
    t = np.log(1 / share - 1)
    shape = np.concatenate((t[:1], np.log(np.maximum(np.diff(t), 0.1))))
    w = np.zeros(len(names))
    m1, v1, m2, v2 = np.zeros_like(w), np.zeros_like(w), np.zeros_like(shape), np.zeros_like(shape)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for step in range(1, rounds + 1):
        gaps = np.exp(shape[1:])
        t = shape[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.zeros(len(rows))
        for start, size, flat in blocks:
            owner = np.repeat(np.arange(len(size)), size)
            score[start : start + len(size)] = np.bincount(owner, w[flat], minlength=len(size))
        tail = np.concatenate((np.ones((len(rows), 1)), sigmoid(score[:, None] - t[None]), np.zeros((len(rows), 1))), 1)
        at = np.arange(len(rows))
        high, low = tail[at, grades], tail[at, grades + 1]
        p = np.maximum(high - low, 1e-12)
        slope_high, slope_low = high * (1 - high), low * (1 - low)
        d_score = (slope_high - slope_low) / p / n
        d_t = np.zeros(levels + 1)
        np.add.at(d_t, grades, -slope_high / p / n)
        np.add.at(d_t, grades + 1, slope_low / p / n)
        d_t = d_t[1:levels]
        d_shape = np.concatenate(([d_t.sum()], [d_t[k:].sum() * gaps[k - 1] for k in range(1, levels - 1)]))
        g = np.zeros(len(names))
        for start, size, flat in blocks:
            g += np.bincount(flat, np.repeat(d_score[start : start + len(size)], size), minlength=len(names))
        pace = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        m1, v1 = 0.9 * m1 + 0.1 * g, 0.99 * v1 + 0.01 * g * g
        speed = pace / (np.sqrt(v1 / (1 - 0.99**step)) + 1e-4)
        w = w + speed * m1 / (1 - 0.9**step)
        w = np.sign(w) * np.maximum(np.abs(w) - speed * sparse, 0)
        m2, v2 = 0.9 * m2 + 0.1 * d_shape, 0.99 * v2 + 0.01 * d_shape * d_shape
        shape = shape + pace * (m2 / (1 - 0.9**step)) / (np.sqrt(v2 / (1 - 0.99**step)) + 1e-6)
    weights = np.zeros(1 << bits)
    weights[names] = w
    return Model(weights, shape[0] + np.concatenate(([0.0], np.cumsum(np.exp(shape[1:])))), bits)


def grades_of(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One rating per labelled id: 0 junk, 1 readable but toxic, 2 good; the worst of repeated labels."""
    good = F.col("quality") == 1
    grade = F.when(good & (F.coalesce("toxic", F.lit(0)) == 0), 2).when(good, 1).otherwise(0)
    return (
        labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
        .groupBy(id_col)
        .agg(F.min(grade).alias("grade"))
    )


def train(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = TRAIN_ROWS,
    bits: int = BITS,
    levels: int = 3,
) -> Model | None:
    """Fit on about ``rows`` rated documents chosen by a hash of the id; None without any."""
    rated = ratings.count()
    if not rated:
        return None
    share = min(1.0, rows / rated)
    picked = ratings.filter(F.pmod(F.xxhash64(F.lit("rating"), id_col), F.lit(1_000_000)) < int(share * 1_000_000))
    joined = docs.select(id_col, bytes_of(text_col).alias("data")).join(picked.select(id_col, "grade"), id_col)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = WordIndex(bits)
        for batch in batches:
            packed = [features(x, index).astype(np.int32).tobytes() for x in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("grade"), pa.array(packed, pa.binary())], ["id", "grade", "packed"]
            )

    kind = dict(docs.dtypes)[id_col]
    sample = joined.mapInArrow(found, f"id {kind}, grade int, packed binary").toArrow().sort_by([("id", "ascending"), ("packed", "ascending")])
    if not sample.num_rows:
        return None
    vectors = [np.frombuffer(x.as_buffer(), np.int32) for x in sample.column("packed")]
    return fit_ordinal(vectors, sample.column("grade").to_numpy().astype(np.int64), levels, bits)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", levels: int = 3, keep_probability: float = KEEP_PROBABILITY) -> DataFrame:
    """``docs`` with expected_grade, p_ge_1, p_ge_2, ... and kept.

    kept: the best grade has ``keep_probability`` at least. Without a model (no ratings)
    nothing is rejected and the scores are null. A null text is the empty text, which is scored
    like any other. The columns of ``docs`` pass but for the text.
    """
    rest = [name for name in docs.columns if name != text_col]
    base = docs.select(*rest, bytes_of(text_col).alias("_data"))
    tails = [f"p_ge_{k}" for k in range(1, levels)]
    if model is None:
        null = F.lit(None).cast("double")
        return base.select(*rest, null.alias("expected_grade"), *[null.alias(t) for t in tails], F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        index = WordIndex(fitted.bits)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.array([fitted.tails(features(x, index)) for x in batch.column("_data").to_pylist()])
            arrays = [pa.array(found.sum(1)), *[pa.array(found[:, k]) for k in range(levels - 1)]]
            arrays.append(pa.array(found[:, -1] >= keep_probability))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in rest], *arrays], [*rest, "expected_grade", *tails, "kept"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.select(*rest).schema)
    return base.mapInArrow(run, f"{schema}, expected_grade double, {', '.join(t + ' double' for t in tails)}, kept boolean")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Ratings of ``labels`` (quality, toxic) fitted, and every document of ``docs`` scored.

    Columns: those of ``docs`` without the text, expected_grade, p_ge_1, p_ge_2, kept. An empty
    table gives no rows; documents without an id are scored but not trained on.
    """
    model = train(docs, grades_of(labels, id_col), id_col, text_col, **options)
    return score(docs, model, text_col)
