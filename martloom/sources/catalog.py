"""Snapshots of a Spark catalog as DataFrames."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sources.tables import table_name

LISTING = "project string, dataset string, table string"
FAILURES = "project string, dataset string, error string"
DETAIL = (
    "project string, dataset string, table string, description string, "
    "modified timestamp, labels map<string,string>"
)
COLUMNS = (
    "project string, dataset string, table string, field string, field_type string, "
    "mode string, description string, policy_tags array<string>"
)
LABEL = "label."
POLICY = "policy."


def list_tables(spark: SparkSession, datasets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables of every distinct ``project, dataset``, and the datasets that failed.

    A failed listing counts as empty. ``project`` names the catalog where the session has one.
    """
    tables, failures = [], []
    known = _catalogs(spark)
    for row in datasets.select("project", "dataset").distinct().toLocalIterator():
        try:
            found = spark.catalog.listTables(
                table_name(row["project"] if row["project"] in known else None, row["dataset"])
            )
            tables += [
                (row["project"], row["dataset"], t.name) for t in found if not t.isTemporary
            ]
        except PySparkException as error:
            failures.append((row["project"], row["dataset"], str(error).split("\n")[0]))
    return spark.createDataFrame(tables, LISTING), spark.createDataFrame(failures, FAILURES)


def _catalogs(spark: SparkSession) -> set[str]:
    return {catalog.name for catalog in spark.catalog.listCatalogs()}


def describe_tables(spark: SparkSession, listing: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``catalog_tables`` and ``catalog_columns`` of the listed tables, and those that failed.

    ``project`` names the catalog where the session has one of that name, else it only labels
    the rows. A table that cannot be described is listed in the third frame (``project, dataset,
    table, error``) and the rest go on. A few metastore calls per table, none of them reads table data. ``modified`` is the time
    of the last change the catalog knows, its creation where it keeps no other.
    """
    tables, columns, failures = [], [], []
    known = _catalogs(spark)
    for row in listing.toLocalIterator():
        key = (row["project"], row["dataset"], row["table"])
        name = table_name(row["project"] if row["project"] in known else None, row["dataset"], row["table"])
        try:
            entry, fields = _describe(spark, key, name)
        except PySparkException as error:
            failures.append((*key, str(error).split("\n")[0]))
            continue
        tables.append(entry)
        columns += fields
    raw = spark.createDataFrame(tables, DETAIL.replace("modified timestamp", "modified string"))
    without_weekday = F.regexp_replace("modified", "^[A-Za-z]+ ", "")
    stamp = F.try_to_timestamp(without_weekday, F.lit("MMM dd HH:mm:ss z yyyy"))
    return (
        raw.withColumn("modified", stamp),
        spark.createDataFrame(columns, COLUMNS),
        spark.createDataFrame(failures, f"{LISTING}, error string"),
    )


def _describe(spark: SparkSession, key: tuple, name: str) -> tuple[tuple, list[tuple]]:
    """Catalog row and column rows of one table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").toLocalIterator()
    detail = {r["col_name"]: r["data_type"] for r in described}
    properties = {
        r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").toLocalIterator()
    }
    labels = {k[len(LABEL) :]: v for k, v in properties.items() if k.startswith(LABEL)}
    entry = (*key, detail.get("Comment"), detail.get("Created Time"), labels)
    columns = []
    for column in spark.catalog.listColumns(name):
        tag = properties.get(POLICY + column.name)
        columns.append(
            (
                *key,
                column.name,
                column.dataType,
                "NULLABLE" if column.nullable else "REQUIRED",
                column.description,
                [tag] if tag else [],
            )
        )
    return entry, columns
