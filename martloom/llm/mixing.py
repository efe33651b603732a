"""Mixing sources to target weights by fitting document lengths to a word budget."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import row_key, text_of
from martloom.session import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
MOST = 2  # times that a source, and a document, is taken at most
DP_WORDS = 16_384  # words of the budget that dynamic programming fits
RANKED = 1_000  # documents of one length that one group ranks


def word_count(text: Column) -> Column:
    """Runs of characters outside x20 and x09-x0D."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words of each source, in source order: ``share`` of all by repeating weights.

    A share stops at ``most`` times the source's size; the excess is shared again by weight
    among the others, until no share is above.
    """
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    budget, open_, got = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weight[i] for i in open_)
        part = {i: budget * weight[i] / total for i in open_}
        full = [i for i in open_ if part[i] > most * sizes[i]]
        if not full:
            for i in open_:
                got[i] = part[i]
            break
        for i in sorted(full):
            got[i] = most * float(sizes[i])
            budget -= got[i]
            open_.discard(i)
    return got


def fit(lengths: Sequence[int], counts: Sequence[int], budget: int, dp_words: int = DP_WORDS) -> list[int]:
    """How many documents of each length to take so that their words come nearest ``budget``.

    The nearer of two: the documents that fill the budget from below, and all but those that
    fill the rest of the words from below.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    words = lambda take: sum(n * t for n, t in zip(lengths, take))
    below = fill(lengths, counts, budget, dp_words)
    if budget >= total or words(below) >= budget:
        return below
    above = [c - t for c, t in zip(counts, fill(lengths, counts, total - budget, dp_words))]
    return above if words(above) - budget < budget - words(below) else below


def fill(lengths: Sequence[int], counts: Sequence[int], budget: int, dp_words: int = DP_WORDS) -> list[int]:
    """How many documents of each length to take so that their words fill ``budget`` from below.

    Every length first gives its share of the documents, rounded down. Longest first, lengths
    give more documents until ``dp_words`` of the budget are left at most; a bounded-knapsack
    subset sum over the documents left fills the rest exactly or as far as they allow.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget <= 0 or total == 0:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    take = [c * budget // total if n else 0 for n, c in zip(lengths, counts)]
    left = budget - sum(n * t for n, t in zip(lengths, take))
    order = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i])
    single = True
    while left > dp_words:
        before = left
        for i in order:
            if left <= dp_words:
                break
            more = min(counts[i] - take[i], left // lengths[i], 1 if single else counts[i])
            take[i] += more
            left -= more * lengths[i]
        if left == before:
            break
        single = False
    # pieces of 1, 2, 4, ... documents of one length; reached: bit s is set if s words can be had
    reached, made = 1, {}
    goal = min(left, dp_words)
    for i in order:
        n, spare = lengths[i], min(counts[i] - take[i], goal // lengths[i])
        piece = 1
        while spare > 0 and not reached >> goal & 1:
            piece = min(piece, spare)
            spare -= piece
            new = (reached << n * piece) & ((1 << goal + 1) - 1) & ~reached
            reached |= new
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(goal // 8 + 1, "little"), np.uint8), bitorder="little")
                for s in np.flatnonzero(bits).tolist():
                    made[s] = (i, piece)
            piece *= 2
    best = reached.bit_length() - 1
    while best:  # the piece that first reached a sum was added to a sum reached before it
        i, piece = made[best]
        take[i] += piece
        best -= piece * lengths[i]
    return take


def source_targets(per_source: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """skey, source, source_size -> also target. One row per source comes to the driver."""
    spark = per_source.sparkSession
    rows = per_source.orderBy(F.col("source").isNull(), "source").collect()
    got = targets([row["source_size"] for row in rows], weights, share, most)
    data = [(row["skey"], row["source_size"], target) for row, target in zip(rows, got)]
    return spark.createDataFrame(data, "skey string, source_size long, target double")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 7,
) -> DataFrame:
    """One row per document: how many of its words the mix takes.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` of
    all words; see ``targets``. A source is taken whole as often as its target allows; the
    rest of the target is fitted by document lengths (``fit``), and the documents of a length
    are chosen by a seeded hash of the id. A null or empty text has size 0 and is taken 0.
    Repeated rows count one by one. An empty table gives no rows. Other columns are not read.
    The driver sees one row per source, a task the distinct lengths of one source.
    Columns: id_col, size, source_size, target, taken, and the row's key k1, k2.
    """
    spark = docs.sparkSession
    sizes = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            *row_key(id_col, text_col),
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string"))).alias("skey"),
            word_count(text_of(text_col)).alias("size"),
            # 53 bits of a hash as a number in [0, 1)
            (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col), 11) / F.lit(float(1 << 53))).alias("u"),
        ),
        "sizes",
    )
    parts = max(1, sizes.count() // RANKED)
    placed = sizes.withColumn("part", (F.col("u") * parts).cast("long"))
    cells = stage(
        placed.groupBy("skey", "size", "part").agg(F.count("*").alias("n"), F.min("source").alias("source")), "length-cells"
    )
    histogram = cells.groupBy("skey", "size").agg(F.sum("n").alias("n"), F.min("source").alias("source"))
    per_source = histogram.groupBy("skey").agg(
        F.min("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size")
    )
    plan = source_targets(per_source, weights, share, most)

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        whole = min(most, int(target // size)) if size else 0
        budget = round(target) - whole * size if whole < most else 0
        group["take"] = fit(group["size"].tolist(), group["n"].tolist(), budget)
        group["whole"] = whole
        return group[["skey", "size", "take", "whole", "source_size", "target"]]

    taken = stage(
        histogram.select("skey", "size", "n")
        .join(plan, "skey")
        .groupBy("skey")
        .applyInPandas(fitted, "skey string, size long, take long, whole long, source_size long, target double"),
        "length-takes",
    )
    before = Window.partitionBy("skey", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        cells.select("skey", "size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        .join(taken, ["skey", "size"])
        .withColumn("quota", F.col("take") - F.col("before"))
        .drop("take", "before")
    )
    keys = ["skey", "size", "part"]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("u", "id", "row"))
    # dealt by all three keys: a source or a length alone may hold a third of the rows
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = placed.repartition(n, *keys).withColumn("rank", rank)
    picked = ranked.join(shares.repartition(n, *keys), keys)
    return picked.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("whole") + (F.col("rank") <= F.col("quota")).cast("long"))).alias("taken"),
        "k1",
        "k2",
    )
