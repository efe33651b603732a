"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The white space of the corpus rules: x20 and x09 to x0D.
WHITE = " \t\n\x0b\x0c\r"
# A key is hot if it holds more than 1/HEAVY of the rows, so at most HEAVY keys are hot.
HEAVY = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column, null counting as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bytes_of(column: str) -> Column:
    """A text column as UTF-8 bytes, null counting as empty."""
    return text_of(column).cast("binary")


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of the frame has it."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(id_col: str, text_col: str) -> list[Column]:
    """k1 and k2, 96 bits of hashes of id and text, by which another read of the rows finds them again.

    Row numbers would not do: how files are split, and so numbered, may change between reads.
    """
    return [F.xxhash64(id_col, text_col).alias("k1"), F.hash(text_col, id_col).alias("k2")]


def decided(docs: DataFrame, decisions: DataFrame, values: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (k1, k2 and the columns of ``values``) has, whole.

    ``values`` names the columns to add, by their names in ``decisions``. Of repeated rows, which
    share a key, as many stay as there are decisions, each with its own values; only exact
    repeats of an id with its text are listed together. One shuffle of the rows.
    """
    k1, k2, list_, nth = (fresh(docs, name) for name in ("_k1", "_k2", "_decisions", "_nth"))
    packed = F.struct(F.lit(True).alias("_"), *[F.col(name) for name in values])
    listed = decisions.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(packed)).alias(list_))
    keyed = docs.withColumns(dict(zip((k1, k2), row_key(id_col, text_col))))
    joined = keyed.join(listed.withColumnsRenamed({"k1": k1, "k2": k2}), [k1, k2])
    counted = joined.withColumn(nth, F.row_number().over(Window.partitionBy(k1, k2).orderBy(k1, k2)))
    kept = counted.filter(F.col(nth) <= F.size(list_))
    mine = F.get(list_, F.col(nth) - 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns], *[mine[name].alias(new) for name, new in values.items()])


def join_by_size(base: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``base`` left-joined with one row per group of ``key``; hot groups don't meet in one task.

    ``size`` counts the rows of ``base`` that a group has, ``total`` all of them. Groups with
    more than total/HEAVY rows are HEAVY at most, so that part is broadcast; the rest is a
    shuffle join in which no key has more than that share.
    """
    hot = F.col(size) * HEAVY > F.lit(total)
    heavy, light = groups.filter(hot), groups.filter(~hot)
    first = base.join(F.broadcast(heavy), key)
    rest = base.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, "left")
    return first.unionByName(rest)


def perhaps_in(base: DataFrame, keys: DataFrame, key: str, bits: int = 1 << 26) -> DataFrame:
    """``base`` without most rows whose ``key`` (a hash, long) is not in ``keys``.

    All rows whose key is there stay, and others by chance: a key counts as there if its place in a
    map of ``bits`` bits is set. The map, 8 MB whatever the number of keys, is
    aggregated on the executors and broadcast; with more keys than bits it only filters less.
    """
    at = lambda name: F.pmod(F.col(name), F.lit(bits))
    # one map of 32768 bits a row, as bitmap_construct_agg makes them
    maps = keys.select(F.shiftright(at(key), 15).alias("_map"), at(key).bitwiseAND(32767).alias("_bit"))
    maps = maps.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_set"))
    placed = base.withColumns({"_map": F.shiftright(at(key), 15), "_bit": at(key).bitwiseAND(32767).cast("int")})
    byte = F.conv(F.hex(F.substring("_set", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = placed.join(F.broadcast(maps), "_map")
    hit = F.expr("power(2, _bit % 8)").cast("int")
    return joined.filter(byte.bitwiseAND(hit) != 0).drop("_map", "_bit", "_set")


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver notice that finished shuffles are unreachable, so their files go.

    Spark deletes shuffle files when the driver's garbage collector finds their handles; a
    driver that only plans may not collect for half an hour.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
