"""Which changed view files may be deployed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.joins import lookup_join

# Root folder, extension and first words of a deployable file.
ROOT = "Projects"
EXTENSION = ".sql"
FIRST_WORDS = "CREATE OR REPLACE VIEW"
# Project, dataset and table of the statement, each part or the whole name in backticks.
TARGET = r"^CREATE OR REPLACE VIEW\s+([`A-Za-z0-9_.\-]+)"


def gate_views(files: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """``path, project, dataset, table, verdict`` of every changed file.

    ``files`` has ``path, deleted, content``; a path reads
    ``Projects/<project>/<dataset>/<kind>/<table>.sql``. ``aliases`` lists pairs
    ``path_dataset, query_dataset`` that count as the same dataset. The verdict is the
    first that applies of ``deleted``, ``not_projects``, ``not_sql``, ``bad_path``,
    ``not_view``, ``invalid`` (no readable target), ``wrong_project``, ``wrong_dataset``,
    ``wrong_table``, ``deploy``. A two-part target is taken to be in the path's project.
    """
    parts = F.split("path", "/", -1)
    named = F.split(F.replace(F.regexp_extract("content", TARGET, 1), F.lit("`"), F.lit("")), r"\.", -1)
    file_part = F.get(parts, F.lit(4))
    read = files.select(
        "path",
        "deleted",
        "content",
        F.get(parts, F.lit(0)).alias("_root"),
        F.get(parts, F.lit(1)).alias("project"),
        F.get(parts, F.lit(2)).alias("dataset"),
        F.lower(F.left(file_part, F.length(file_part) - len(EXTENSION))).alias("table"),
        named.alias("_named"),
    )
    size = F.size("_named")
    read = (
        read.withColumn("_q_table", F.lower(F.element_at("_named", -1)))
        .withColumn("_q_dataset", F.when(size >= 2, F.try_element_at("_named", F.lit(-2))))
        .withColumn(
            "_q_project",
            F.when(size == 3, F.col("_named")[0]).when(size == 2, F.col("project")),
        )
    )
    if aliases is None:
        read = read.withColumn("_same", F.lit(None).cast("boolean"))
    else:
        pairs = aliases.select(
            F.col("path_dataset").alias("dataset"),
            F.col("query_dataset").alias("_q_dataset"),
            F.lit(True).alias("_same"),
        ).distinct()
        read = lookup_join(read, pairs, ["dataset", "_q_dataset"], "left", F.col("path"))
    verdict = (
        F.when(F.col("deleted"), "deleted")
        .when(F.col("_root") != ROOT, "not_projects")
        .when(~F.col("path").endswith(EXTENSION), "not_sql")
        .when(F.col("table").isNull(), "bad_path")
        .when(~F.coalesce(F.col("content"), F.lit("")).startswith(FIRST_WORDS), "not_view")
        .when(F.col("_q_project").isNull(), "invalid")
        .when(F.col("_q_project") != F.col("project"), "wrong_project")
        .when(
            (F.col("_q_dataset") != F.col("dataset")) & F.col("_same").isNull(), "wrong_dataset"
        )
        .when(F.col("_q_table") != F.col("table"), "wrong_table")
        .otherwise("deploy")
    )
    return read.select("path", "project", "dataset", "table", verdict.alias("verdict"), "content")


def view_ddl(gated: DataFrame) -> DataFrame:
    """``path, statement``: the full text of the files to deploy."""
    return gated.where("verdict = 'deploy'").select("path", F.col("content").alias("statement"))
