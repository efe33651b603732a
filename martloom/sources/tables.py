"""Table and query sources, snapshot and script sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import stage as write_aside

# Fixed value: the text of the error frame, spelling included.
SQL_ERROR = "sql is worng"
READERS = ("parquet", "orc", "json", "csv")


def read_table(spark: SparkSession, source: str, format: str | None = None, **options) -> DataFrame:
    """A catalog table by name, or files of a format by path."""
    if format is None:
        return spark.table(source)
    return spark.read.options(**options).format(format).load(source)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page table ``page_id, url, html``; a NULL ``html`` is a failed fetch."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_theme_dictionary(dictionary: DataFrame) -> DataFrame:
    """``industry, subindustry, keyword, weight``, heaviest keywords of a subindustry first."""
    return dictionary.select("industry", "subindustry", "keyword", "weight").orderBy(
        "industry", "subindustry", F.col("weight").desc(), "keyword"
    )


def query(spark: SparkSession, sql: str, args: Mapping | None = None) -> DataFrame:
    return spark.sql(sql, args=dict(args or {}))


def read_sql_or_error(spark: SparkSession, sql: str) -> DataFrame:
    """The query's result, or one row ``error`` where Spark cannot analyse it."""
    try:
        return spark.sql(sql)
    except PySparkException:
        return spark.createDataFrame([(SQL_ERROR,)], "error string")


def try_sql(spark: SparkSession, sql: str) -> DataFrame | None:
    """The query's rows, written to the shared folder; None where it fails, also while it runs."""
    try:
        return write_aside(spark.sql(sql), "query")
    except PySparkException:
        return None


def table_name(*parts: str | None) -> str:
    """Name of up to three parts, NULL parts left out, each in backticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts if part)


def write_snapshot(spark: SparkSession, frame: DataFrame, *parts: str) -> None:
    """Replace the table of that name by the rows of a frame, also where it reads that table.

    The rows are written once, to a new table beside the old one. Then the old table is
    renamed, the new one takes its name, and only then the old one is dropped: at every
    moment one of them is whole, and a failure puts the old one back.
    """
    run = uuid.uuid4().hex
    destination = table_name(*parts)
    staged = (*parts[:-1], f"{parts[-1]}_stage_{run}")
    former = (*parts[:-1], f"{parts[-1]}_former_{run}")

    def rename(old: Sequence[str], new: Sequence[str]) -> None:
        # the new name is read within the catalog of the table
        spark.sql(f"ALTER TABLE {table_name(*old)} RENAME TO {table_name(*new[-2:])}")

    try:
        frame.write.saveAsTable(table_name(*staged))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(*staged)}")
        raise
    replaces = spark.catalog.tableExists(destination)
    if replaces:
        rename(parts, former)
    try:
        rename(staged, parts)
    except Exception:
        if replaces:
            rename(former, parts)
        spark.sql(f"DROP TABLE IF EXISTS {table_name(*staged)}")
        raise
    if replaces:
        spark.sql(f"DROP TABLE {table_name(*former)}")


def materialise_sheet(
    spark: SparkSession, source: str, destination: Sequence[str], format: str = "csv", **options
) -> None:
    """Static table (name parts) from an external sheet; csv columns are all text."""
    if format not in READERS:
        raise ValueError(f"format must be one of {READERS}")
    if format == "csv":
        options = {"header": "true", **options}
    write_snapshot(spark, read_table(spark, source, format, **options), *destination)


def run_sql_script(
    spark: SparkSession, text: str, env: str = "prod", args: Mapping | None = None
) -> int:
    """Run the statements of a script in order; number of statements run.

    Statements are parted by ``;`` and a line end, as in the scripts this reads. The first
    failure stops the script. Nothing runs unless ``env`` is ``prod``.
    """
    if env != "prod":
        return 0
    statements = [part for part in text.split(";\n") if part.strip()]
    for statement in statements:
        spark.sql(statement, args=dict(args or {}))
    return len(statements)


def run_statements(spark: SparkSession, ddl: DataFrame) -> DataFrame:
    """Run the ``statement`` rows of a plan in launch order; ``statement, status, error``.

    Statements change the catalog, which only the driver does; they are read as a stream
    of rows, not collected. A failed one is recorded and the rest go on.
    """
    order = [name for name in ("launch_order", "table", "item", "path") if name in ddl.columns]
    outcome = []
    for row in ddl.orderBy(*order).toLocalIterator():
        try:
            spark.sql(row["statement"])
            outcome.append((row["statement"], "ok", None))
        except PySparkException as error:
            outcome.append((row["statement"], "failed", str(error).split("\n")[0]))
    return spark.createDataFrame(outcome, "statement string, status string, error string")


def combine_results(*frames: DataFrame) -> DataFrame:
    """All results under each other by column name; missing columns become NULL."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined
