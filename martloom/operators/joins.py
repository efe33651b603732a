"""Joins of a large frame with a lookup frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of stored, compressed columns; the hash table built from them is several times that.
BROADCAST_LIMIT = 32 * 1024 * 1024
SALTS = 16
# Layout by page: what a partition may come to, and how many times its stored bytes that is at most
# in hash tables and sorts (a row per page and word or theme). So a partition reads 4 MB of stored pages.
HELD_PER_PARTITION = 1024**3
UNFOLDED = 256
# A source without statistics counts as 2**63 - 1 bytes, and what is built on it as about so many.
UNKNOWN = 2**60


def plan_bytes(frame: DataFrame) -> int | None:
    """An upper bound of the stored bytes that a plan's rows come from, or None where there is none.

    Spark scales its estimate by default column widths (a string counts 20 bytes, a list as
    little), so a projection or an aggregate of long texts is put far too low. The stored
    size of all tables below is no lower than what filters, projections and aggregates leave
    of them; the larger of the two counts, which also covers joins. A generator (explode) may
    multiply rows without being counted, hence None.
    """
    try:
        plan = frame._jdf.queryExecution().optimizedPlan()
        if "Generate " in plan.toString():
            return None
        leaves = plan.collectLeaves()
        stored = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        size = max(int(str(plan.stats().sizeInBytes())), stored)
        return size if size < UNKNOWN else None
    except AttributeError:  # a remote session gives no plan access
        return None


def held_bytes(frame: DataFrame) -> int:
    """What the rows of all tables below a plan may unfold to, 0 where their size is not known."""
    try:
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        return size * UNFOLDED if size < UNKNOWN else 0
    except AttributeError:  # a remote session gives no plan access
        return 0


def by_page(frame: DataFrame, held: int) -> DataFrame:
    """Layout by ``page_id`` in a number of partitions that grows with what the tasks hold.

    The number is fixed: adaptive execution would merge partitions by their compressed
    size, and what a task holds of them (a row per page and token, or theme) is many times that.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(max(cores, -(-held // HELD_PER_PARTITION)), "page_id")


def is_small(frame: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether the bound of a plan's size is known and within ``limit``."""
    size = plan_bytes(frame)
    return size is not None and size <= limit


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    spread: Column | None = None,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join ``big`` with ``lookup`` on equal columns; ``how`` is inner, left or left_anti.

    A lookup whose size bound is within ``limit`` is broadcast. A larger one is shuffled;
    adaptive execution then splits hot keys of the big side, and where that is switched off
    the keys are salted by a hash of ``spread`` (a column that differs between the rows of
    one key, so that a repeated task gives the same salt).
    """
    if is_small(lookup, limit):
        return big.join(F.broadcast(lookup), on, how)
    conf = big.sparkSession.conf
    splits = all(
        conf.get(key, "true") == "true"
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )
    if splits or spread is None:
        return big.join(lookup, on, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    copies = lookup.withColumn(
        "_salt", F.explode(F.array(*[F.lit(salt).cast("bigint") for salt in range(SALTS)]))
    )
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
