"""Frames as column-oriented JSON: ``{"column": {"row": value}}``, one body per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import parse as P
from martloom.operators.joins import lookup_join

RESULT_COLUMNS = ("ds", "y", "yhat", "iliPlanIliFact")
# Names of the scalar facts in a result body.
FACT_NAMES = {
    "error_rate": "error_rate",
    "is_special": "isSpecialParametrs",
    "parameters": "parametrs_in_model",
    "regressors": "regressors_in_model",
    "forecasting_period": "forecasting_period",
}


def read_columnar_json(
    bodies: DataFrame, columns: Sequence[str], key: str = "series_id", body: str = "body"
) -> DataFrame:
    """Rows ``key, idx`` and the wanted columns as text; absent values are NULL.

    Values meet by their row name in one aggregation, whatever the order inside the body;
    scalar entries of the body are passed over.
    """
    fields = ", ".join(f"`{name}` map<string,string>" for name in columns)
    parsed = bodies.select(key, F.from_json(body, fields).alias("_p"))
    def cells_of(name: str):
        pairs = F.coalesce(F.map_entries(F.col(f"_p.`{name}`")), F.array())
        return F.transform(
            pairs,
            lambda pair: F.struct(
                F.lit(name).alias("name"), pair["key"].alias("idx"), pair["value"].alias("value")
            ),
        )

    entries = F.concat(*[cells_of(name) for name in columns])
    cells = parsed.select(key, F.inline(entries))
    return cells.groupBy(key, F.col("idx").cast("bigint").alias("idx")).agg(
        *[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in columns]
    )


def read_request_frame(bodies: DataFrame) -> DataFrame:
    """``series_id, idx, ds, y`` of request bodies; days as epoch milliseconds or text."""
    rows = read_columnar_json(bodies, ("ds", "y"))
    return rows.select(
        "series_id", "idx", P.epoch_or_text(F.col("ds")).alias("ds"), F.col("y").cast("double").alias("y")
    )


def decode_result(bodies: DataFrame) -> DataFrame:
    """``series_id, idx, ds, y, yhat, iliPlanIliFact`` of result bodies."""
    rows = read_columnar_json(bodies, RESULT_COLUMNS)
    numbers = [F.col(name).cast("double").alias(name) for name in RESULT_COLUMNS[1:]]
    return rows.select("series_id", "idx", P.epoch_or_text(F.col("ds")).alias("ds"), *numbers)


def number_rows(frame: DataFrame, key: str, day: str, order: Sequence[str]) -> DataFrame:
    """Add ``idx``: place of the row in its series by day and the other columns, from 0.

    Ranks are taken within a day and shifted by the rows of the earlier days, so no task
    sorts more of a long series than one day and its list of days.
    """
    days = frame.groupBy(key, day).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    starts = days.select(key, day, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(key, day).orderBy(*order)
    return (
        lookup_join(frame, starts, [key, day], "inner")
        .withColumn("idx", F.col("_start") + F.row_number().over(within) - 1)
        .drop("_start")
    )


def to_columnar_json(
    frame: DataFrame,
    columns: Sequence[str] = RESULT_COLUMNS,
    key: str = "series_id",
    facts: DataFrame | None = None,
    by_year: bool = False,
) -> DataFrame:
    """``key, part, body``: days as epoch milliseconds, rows numbered from 0.

    A series is one body, whatever its length, with ``part`` 0. ``by_year`` writes one body per
    calendar year instead (``part`` is the year, -1 without a day), whose row names go on, so
    that the union of the parts is the whole; ask for it where a series may be too long for
    one string. ``facts`` adds scalar entries to every body of its series.
    """
    day = columns[0]
    rest = list(columns[1:])
    numbered = number_rows(frame.select(key, *columns), key, day, rest).withColumn(
        "part", F.coalesce(F.year(day), F.lit(-1)) if by_year else F.lit(0)
    )
    millis = F.unix_millis(F.col(day).cast("timestamp"))

    def cells(name: str):
        value = millis if name == day else F.col(name)
        pairs = F.array_sort(F.collect_list(F.struct(F.col("idx"), value.alias("value"))))
        return F.map_from_entries(
            F.transform(pairs, lambda p: F.struct(p["idx"].cast("string"), p["value"]))
        ).alias(name)

    bodies = numbered.groupBy(key, "part").agg(*[cells(name) for name in columns])
    entries = [F.col(name) for name in columns]
    if facts is not None:
        given = [name for name in FACT_NAMES if name in facts.columns]
        named = facts.select(key, *[F.col(name).alias(FACT_NAMES[name]) for name in given])
        bodies = lookup_join(bodies, named, [key], "left")
        entries += [F.col(FACT_NAMES[name]) for name in given]
    body = F.to_json(F.struct(*entries), {"ignoreNullFields": "false"})
    return bodies.select(key, "part", body.alias("body"))
