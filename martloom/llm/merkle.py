"""A Merkle manifest of a table: leaf digests, subroots by language, one root, and a proof per row.

Time-forward processing on Spark. Nodes carry labels (group, level, index); the shuffle by the
parent's label is the priority queue that delivers each pair of child digests to its parent, one
level per round, bottom up. A reversed sweep, top down, then delivers to every node the suffix of
its proof (the siblings above it and on which side they stand), so that every leaf ends with its
whole path. Every level is written to the shared folder, so a lost executor costs one level.

H is the lowercase hex SHA-256 of its inputs concatenated, digests entering as their hex text.
A leaf is H of doc_id, source, lang, n_chars, text, each ``-`` if null, else its UTF-8 byte
count, ``:`` and its value (integers in decimal). Within a group the nodes of a level, in order,
are taken two by two; the last run may be one node, which becomes H of that node alone. A group
of one leaf has that leaf as its subroot. Subroots, ordered by lang (null first, UTF-8 byte
order), make the root alike. Rows are ordered by doc_id (null first) and then by leaf digest, so
repeated rows are interchangeable and reruns agree. Empty table: no rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Fixed value of the contract: a row is tampered where this divides the crc32 of its decimal doc_id.
TAMPER_MOD = 7


def field(column: Column) -> Column:
    """``-`` for null, else its UTF-8 byte count, ``:`` and its text."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(columns[name]) for name in FIELDS]), 256)


def H(*digests: Column) -> Column:
    return F.sha2(F.concat(*digests), 256)


def _indexed(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``idx``, the 0-based place of each row in its group by ``order``, and ``n``, its group's size.

    Range-partitioned sort, a row number inside each partition and per group, and offsets from
    a table of counts per (partition, group); no group meets in one task.
    """
    ranged = nodes.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id())
    within = Window.partitionBy("_part", group).orderBy(*order)
    ranged = stage(ranged.withColumn("_n", F.row_number().over(within) - 1), "merkle-ranked")
    counts = ranged.groupBy(F.col("_part").alias("_p"), F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_p", "_g", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"), F.sum("_c").over(Window.partitionBy("_g")).alias("n")
    )
    joined = ranged.join(offsets, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.select(*nodes.columns, (F.col("_off") + F.col("_n")).alias("idx"), "n")


def _width(level: int) -> Column:
    """Nodes of a group at ``level``: ceil(n / 2**level)."""
    return F.expr(f"(n + {(1 << level) - 1}) div {1 << level}")


def tree(level0: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels of the trees of all groups, and their tops.

    ``level0``: g (group, may be null), idx (0-based), n (the group's leaves), digest. Returns
    (nodes, tops): nodes[L - 1] holds the nodes (g, level, idx, n, digest, left, right) of level L >= 1 (left, right:
    the children's digests, right null for a lone run), tops (g, level, digest) the one node of
    each group's top level. A group's width at every level follows from n, so a level needs no
    count; the number of levels follows from the largest n.
    """
    current = stage(level0.select("g", F.lit(0).alias("level"), "idx", "n", "digest"), "merkle-level")
    largest = current.agg(F.max("n").alias("n")).first().n or 0
    highest = (largest - 1).bit_length() if largest > 1 else 0
    tops = [current.filter(_width(0) == 1).select("g", "level", "digest")]
    uppers = []
    for level in range(1, highest + 1):
        rest = current.filter(_width(level - 1) > 1)
        parents = rest.groupBy("g", "n", F.floor(F.col("idx") / 2).alias("idx")).agg(
            F.min_by("digest", "idx").alias("left"), F.max_by("digest", "idx").alias("right"), F.count(F.lit(1)).alias("c")
        )
        parents = parents.select(
            "g",
            F.lit(level).alias("level"),
            "idx",
            "n",
            F.when(F.col("c") == 2, H(F.col("left"), F.col("right"))).otherwise(H(F.col("left"))).alias("digest"),
            "left",
            F.when(F.col("c") == 2, F.col("right")).alias("right"),
        )
        current = stage(parents, "merkle-level")
        uppers.append(current)
        tops.append(current.filter(_width(level) == 1).select("g", "level", "digest"))
    top = tops[0].select(F.col("g").cast("string"), F.col("level").cast("int"), "digest")
    for part in tops[1:]:
        top = top.unionByName(part.select(F.col("g").cast("string"), F.col("level").cast("int"), "digest"))
    return uppers, stage(top, "merkle-tops")


def paths(nodes: list[DataFrame], tops: DataFrame, above: DataFrame) -> DataFrame:
    """(g, idx, path) for every node of level 0: its siblings up to its group's top, and above.

    ``above`` gives each group's path above its top (g, path). A path is an array of
    (sibling, left), bottom up; ``left`` says the node stands left; a lone run has no sibling.
    The reversed sweep: each level's nodes take their parent's path and put their own step
    in front.
    """
    step_t = "array<struct<sibling:string,left:boolean>>"
    above = above.select(F.col("g").alias("_ag"), F.col("path").alias("_ap"))
    top = tops.join(above, F.col("g").eqNullSafe(F.col("_ag")), "left").select(
        "g", "level", F.coalesce("_ap", F.array().cast(step_t)).alias("path")
    )
    # the top node's index is 0; groups have their tops at different levels
    starts = stage(top.select("g", "level", F.lit(0).cast("long").alias("idx"), "path"), "merkle-path")
    known = starts.filter("level = 0").limit(0)
    highest = [r.level for r in tops.agg(F.max("level").alias("level")).collect()][0] or 0
    for level in range(highest, 0, -1):
        here = known.unionByName(starts.filter(F.col("level") == level))
        parents = nodes[level - 1].alias("p").join(
            here.alias("k"),
            (F.col("p.g").eqNullSafe(F.col("k.g"))) & (F.col("p.idx") == F.col("k.idx")),
        )
        left = parents.select(
            F.col("p.g").alias("g"), F.lit(level - 1).alias("level"), (F.col("p.idx") * 2).alias("idx"),
            F.concat(F.array(F.struct(F.col("p.right").alias("sibling"), F.lit(True).alias("left"))), F.col("k.path")).alias("path"),
        )
        right = parents.filter(F.col("p.right").isNotNull()).select(
            F.col("p.g").alias("g"), F.lit(level - 1).alias("level"), (F.col("p.idx") * 2 + 1).alias("idx"),
            F.concat(F.array(F.struct(F.col("p.left").alias("sibling"), F.lit(False).alias("left"))), F.col("k.path")).alias("path"),
        )
        known = stage(left.unionByName(right), "merkle-path")
    return known.unionByName(starts.filter("level = 0")).select("g", "idx", "path")


def fold(start: Column, path: Column) -> Column:
    """The top reached from ``start`` by the steps of ``path``."""
    return F.aggregate(
        path,
        start,
        lambda acc, s: F.when(s["sibling"].isNull(), H(acc)).when(s["left"], H(acc, s["sibling"])).otherwise(H(s["sibling"], acc)),
    )


def tampered_n_chars(doc_id: Column, n_chars: Column) -> Column:
    """n_chars + 1 where TAMPER_MOD divides the unsigned crc32 of the decimal doc_id; nulls stay."""
    hit = (F.crc32(doc_id.cast("string")) % TAMPER_MOD) == 0
    return F.when(hit & n_chars.isNotNull(), n_chars + 1).otherwise(n_chars)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text; others ignored).

    Returns doc_id, lang, leaf, subroot, root, proof_sha256 (H of all siblings on the path,
    bottom up, left to right), tampered_leaf, folded_root (from the tampered leaf and the
    original siblings) and verified (folded_root = root). Tampering: see ``tampered_n_chars``.
    Nulls in any field are part of the leaf; repeated rows give leaves of their own.
    """
    cols = {name: F.col(f"`{name}`") for name in FIELDS}
    base = docs.select(
        *[cols[name].alias(f"_{name}") for name in FIELDS],
    )
    own = {name: F.col(f"_{name}") for name in FIELDS}
    tampered = dict(own, n_chars=tampered_n_chars(own["doc_id"], own["n_chars"]))
    # the fields are only hashed: the leaves go on without them
    leaves = base.select(
        "_doc_id", leaf_of(own).alias("leaf"), leaf_of(tampered).alias("tampered_leaf"), own["lang"].cast("string").alias("g")
    )
    leaves = _indexed(leaves, "g", ["_doc_id", "leaf"])
    leaves = stage(leaves, "merkle-leaves")
    nodes, tops = tree(leaves.select("g", "idx", "n", F.col("leaf").alias("digest")))
    # subroots ordered by lang, null first, as leaves of one tree
    subroots = tops.select(F.col("g").alias("lang"), "digest")
    ordered = _indexed(subroots.withColumn("_one", F.lit("")), "_one", ["lang"])
    upper_nodes, upper_tops = tree(ordered.select(F.col("_one").alias("g"), "idx", "n", "digest"))
    empty = subroots.sparkSession.createDataFrame([], "g string, path array<struct<sibling:string,left:boolean>>")
    upper = paths(upper_nodes, upper_tops, empty)
    # one value: the root
    root = [r.digest for r in upper_tops.collect()]
    above = ordered.join(upper, "idx").select(F.col("lang").alias("g"), "path")
    lower = paths(nodes, tops, above)
    subroot = subroots.withColumnRenamed("digest", "subroot")
    lower = lower.select(F.col("g").alias("_lg"), F.col("idx").alias("_li"), "path")
    joined = leaves.join(lower, F.col("g").eqNullSafe(F.col("_lg")) & (F.col("idx") == F.col("_li")))
    joined = joined.join(subroot, F.col("g").eqNullSafe(F.col("lang"))).drop("lang")
    joined = joined.withColumn("root", F.lit(root[0] if root else None).cast("string"))
    siblings = F.filter(F.col("path"), lambda s: s["sibling"].isNotNull())
    return joined.select(
        F.col("_doc_id").alias("doc_id"),
        F.col("g").alias("lang"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(F.transform(siblings, lambda s: s["sibling"]), ""), 256).alias("proof_sha256"),
        "tampered_leaf",
        fold(F.col("tampered_leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def crc_tampered(doc_id: int | None) -> bool:
    """Whether the rule tampers a row (for tests and readers)."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % TAMPER_MOD == 0
