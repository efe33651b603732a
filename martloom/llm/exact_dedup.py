"""Exact deduplication by merging sorted digest runs in rounds, in DataFrame functions only.

Every input partition is a run of digests. In round r the runs whose numbers agree but for the
last r digits (base FAN) exchange entries: each entry goes to the partner that owns the
digest's r-th digit, and each partner merges the runs it gets, keeping per digest the best row
and the count. After the last round every digest has one entry. Rounds are sort-merge
aggregations combined before each exchange, so a digest moves at most once per run, then
once per group of runs, however many copies it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import WHITE, join_by_size, row_key, text_of
from martloom.session import stage

FAN = 16


def digest_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored: number, key, id, code points, normalised length, SHA-256 and run of each row."""
    text = text_of(text_col)
    bare = F.translate(text, WHITE, "")
    return stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            *row_key(id_col, text_col),
            F.col(id_col).alias("id"),
            F.char_length(text).cast("long").alias("points"),
            F.octet_length(bare).cast("long").alias("length"),
            F.unhex(F.sha2(bare, 256)).alias("digest"),
            F.spark_partition_id().alias("run"),
        ),
        "digests",
    )


def merge_runs(entries: DataFrame, runs: int, fan: int = FAN) -> DataFrame:
    """Per digest the best row (most code points, then smallest id, null last) and the count.

    The normalised length goes with the digest in every comparison: entries that agree in
    the digest alone are not merged.
    """
    level = entries.select(
        "run",
        "digest",
        "length",
        F.struct(
            (-F.col("points")).alias("shorter"),
            F.col("id").isNull().alias("no_id"),
            "id",
            "row",
        ).alias("best"),
        F.lit(1).cast("long").alias("group_size"),
    )
    done, span = 0, 1
    while True:
        done, span = done + 1, span * fan
        owner = F.substring("digest", 1, done) if span < runs else F.lit(None).cast("binary")
        level = (
            level.withColumn("run", (F.col("run") / F.lit(fan)).cast("int"))
            .withColumn("owner", owner)
            .groupBy("run", "owner", "digest", "length")
            .agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))
            .drop("owner")
        )
        if span >= runs:
            return level.drop("run")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fan: int = FAN,
) -> DataFrame:
    """One row per input row: which row of equal texts stays.

    Texts are equal if they are identical without white space. Of a group the row with the
    most code points stays, then the smallest id (null last), then, for repeated rows, the
    first read. A null text is the empty text; empty texts form a group. Other columns are
    not read. An empty table gives no rows. Columns: id_col, keep_id, group_size, kept,
    text_sha256, and the row's key k1, k2.
    """
    entries = digest_table(docs, id_col, text_col)
    last = entries.agg(F.max("run")).first()[0]
    groups = stage(merge_runs(entries, (last or 0) + 1, fan).filter("group_size > 1"), "digest-groups")
    groups = groups.select(
        F.struct("digest", "length").alias("key"),
        F.col("best.id").alias("keep_id"),
        F.col("best.row").alias("keep_row"),
        "group_size",
    )
    base = entries.select("row", "k1", "k2", "id", "digest", F.struct("digest", "length").alias("key"))
    joined = join_by_size(base, groups, "key", "group_size", entries.count())
    alone = F.col("group_size").isNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "k1",
        "k2",
    )
