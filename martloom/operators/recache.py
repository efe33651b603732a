"""Snapshots of views into tables, on a calendar and in launch order."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sources.tables import table_name, write_snapshot

LAST = 999999
DESTINATION = ("cache_project", "cache_dataset", "cache_table")
SOURCE = ("source_project", "source_dataset", "source_view")


def due_recaches(control: DataFrame, as_of: datetime.date) -> DataFrame:
    """Rows of the control table due on ``as_of``, in launch order.

    ``schedule`` (ISO weekday) and ``month_update`` (day of month) both have to fit; NULL
    or 0 fits every day. Rows without a launch order come last, ties by destination.
    """
    weekday = F.lit(as_of.isoweekday())
    day = F.lit(as_of.day)
    fits = F.coalesce("schedule", F.lit(0)).isin(0, weekday) & F.coalesce(
        "month_update", F.lit(0)
    ).isin(0, day)
    return control.where(fits).orderBy(F.coalesce("launch_order", F.lit(LAST)), *DESTINATION)


def run_recaches(spark: SparkSession, due: DataFrame) -> DataFrame:
    """Write every snapshot in order; ``destination, status, error`` per control row.

    The order is part of the job (later views may read earlier snapshots), so the rows of
    the control table are walked one by one; each snapshot itself is a Spark job. A failed
    one is recorded and the rest go on.
    """
    outcome = []
    for row in due.toLocalIterator():
        parts = [row[name] for name in DESTINATION if row[name]]
        destination = table_name(*parts)
        try:
            view = spark.table(table_name(*[row[name] for name in SOURCE]))
            write_snapshot(spark, view, *parts)
            outcome.append((destination, "ok", None))
        except Exception as error:  # noqa: BLE001 - the batch must go on after any failure
            outcome.append((destination, "failed", str(error).split("\n")[0]))
    return spark.createDataFrame(outcome, "destination string, status string, error string")
