"""Many daily series at once: parameters, history, regressors, spine, plan and fact."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import parse as P
from martloom.operators.joins import lookup_join
from martloom.sources.tables import SQL_ERROR, try_sql

DEFAULT_PERIOD = 365
DEFAULT_REGRESSOR = "dow"
INTERVAL_WIDTH = 0.8
FOLD_DAYS = 30
# Error rate of a series without a back-test, and of one without data.
NOT_REQUESTED = -1.0
NO_DATA = -3.14
# Fixed value: stands for a day without fact in the result; a real one counts the same.
NO_FACT = -1.0

PRIORS = ("changepoint_prior_scale", "seasonality_prior_scale", "holidays_prior_scale")
HYPER = (*PRIORS, "seasonality_mode", "regressors", "sql")


def latest_hyperparameters(hyper: DataFrame) -> DataFrame:
    """The row of the latest date for every marker, largest values on equal dates."""
    row = F.struct("date", *[F.col(name) for name in HYPER])
    latest = hyper.groupBy("forecastMarker").agg(F.max(row).alias("_row"))
    return latest.select("forecastMarker", "_row.*")


def forecast_params(requests: DataFrame, hyper: DataFrame) -> DataFrame:
    """One row of typed parameters per request, named by ``request_id``.

    Requests may carry a ``request_id`` of their own; else the marker names them, so several
    requests for one marker need one, and a request without a marker too. From here on a
    series is a request: history is cut, fitted and returned for each alone.

    Requests hold text: a missing or unreadable period is 365, a missing ``use_hypo`` is
    true, a missing ``error_output`` false. With ``use_hypo`` off the priors are dropped
    and the regressors are ``dow``, but the stored SQL still counts and the run is still
    special. Supplied SQL comes before stored SQL.
    """
    stored = latest_hyperparameters(hyper).withColumn("_found", F.lit(1))
    stored = stored.select(
        "forecastMarker", "_found", *[F.col(name).alias(f"_{name}") for name in HYPER]
    )
    joined = lookup_join(requests, stored, ["forecastMarker"], "left")
    use = P.flag(F.col("use_hypo"), True)
    found = F.coalesce("_found", F.lit(0))
    chosen = [F.when(use, F.col(f"_{name}")).alias(name) for name in (*PRIORS, "seasonality_mode")]
    regressors = F.when(use, F.col("_regressors"))
    named = F.col("request_id").cast("string") if "request_id" in requests.columns else F.lit(None).cast("string")
    return joined.select(
        F.coalesce(named, "forecastMarker").alias("request_id"),
        "forecastMarker",
        "sender",
        P.whole_number(F.col("forecasting_period"), DEFAULT_PERIOD).alias("forecasting_period"),
        F.try_to_date("fake_yesterday").alias("fake_yesterday"),
        use.alias("use_hypo"),
        P.flag(F.col("error_output"), False).alias("error_output"),
        *chosen,
        P.name_list(regressors, DEFAULT_REGRESSOR).alias("regressors"),
        F.coalesce("sql_query", "_sql").alias("sql_query"),
        (F.col("sql_query").isNull() & F.col("_sql").isNotNull()).alias("sql_from_hypo"),
        (found > 0).alias("is_special"),
        found.alias("found_records"),
    )


def parameter_map(params: DataFrame) -> DataFrame:
    """``request_id, forecastMarker, parameters``: the set parameters as text, NULL for plain runs."""
    entries = [F.lit("interval_width"), F.lit(str(INTERVAL_WIDTH))]
    for name in (*PRIORS, "seasonality_mode"):
        entries += [F.lit(name), F.col(name).cast("string")]
    filled = F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())
    return params.select(
        "request_id", "forecastMarker", F.when(F.col("is_special"), filled).alias("parameters")
    )


def choose_source(params: DataFrame, supplied: DataFrame | None = None) -> DataFrame:
    """Add ``source``: ``frame`` (rows supplied), ``request_sql``, ``stored_sql`` or ``none``."""
    if supplied is None:
        given = params.withColumn("_given", F.lit(False))
    else:
        markers = supplied.select(F.col("series_id").alias("forecastMarker")).distinct()
        given = lookup_join(params, markers.withColumn("_given", F.lit(True)), ["forecastMarker"])
    source = (
        F.when(F.col("_given"), "frame")
        .when(F.col("sql_query").isNull(), "none")
        .when(F.col("sql_from_hypo"), "stored_sql")
        .otherwise("request_sql")
    )
    return given.select(*params.columns, source.alias("source"))


def read_sources(
    spark: SparkSession, chosen: DataFrame, supplied: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """History and ``series_id, error`` of the requests whose SQL failed.

    In both ``series_id`` is the request (pass ``key="request_id"`` on), in ``supplied`` the marker.
    Each SQL is run within the try, so one that fails on its rows, or gives no ``ds`` and ``y``, is
    an error of its own requests and not of all. A result with a ``series_id`` column serves the marker of that name, any other one the
    whole request.
    Each distinct SQL text is planned once and joined with the series that ask for it;
    the texts come from the request table, the data never passes the driver.
    """
    wanted = chosen.where(F.col("source").isin("request_sql", "stored_sql")).select(
        "request_id", _marker().alias("series_id"), "sql_query"
    )
    schema = "series_id string, ds date, y double"
    history = spark.createDataFrame([], schema)
    if supplied is not None:
        framed = chosen.where("source = 'frame'").select("request_id", _marker().alias("series_id"))
        history = _named(lookup_join(_typed(supplied), framed, ["series_id"], "inner"))
    errors = spark.createDataFrame([], "series_id string, error string")
    for row in wanted.select("sql_query").distinct().toLocalIterator():
        asks = wanted.where(F.col("sql_query") == row["sql_query"]).select("request_id", "series_id")
        rows = try_sql(spark, row["sql_query"])
        if rows is None or not {"ds", "y"} <= set(rows.columns):
            failed = asks.select(F.col("request_id").alias("series_id"), F.lit(SQL_ERROR).alias("error"))
            errors = errors.unionByName(failed)
        elif "series_id" in rows.columns:
            history = history.unionByName(_named(lookup_join(_typed(rows), asks, ["series_id"], "inner")))
        else:
            # every request that asks for this SQL gets all of its rows
            names = asks.agg(F.collect_list("request_id")).scalar()
            history = history.unionByName(_typed(rows.withColumn("series_id", F.explode(names))))
    return history, errors


def _marker() -> Column:
    """The marker of a request, or its own name where it has none."""
    return F.coalesce("forecastMarker", "request_id")


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("request_id").alias("series_id"), "ds", "y")


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("series_id").cast("string").alias("series_id"),
        F.col("ds").cast("date").alias("ds"),
        F.col("y").cast("double").alias("y"),
    )


def history_rows(history: DataFrame, params: DataFrame, key: str = "forecastMarker") -> DataFrame:
    """History before ``fake_yesterday`` of every request, other columns kept.

    ``series_id`` of the history is the marker of requests (or, for those without one, their
    own name); with ``key="request_id"`` it is the request. In the result it is the request.
    """
    cut = params.select(
        (_marker() if key == "forecastMarker" else F.col(key)).alias("series_id"),
        F.col("request_id").alias("_request"),
        F.col("fake_yesterday").alias("_cut"),
    )
    typed = history.withColumn("ds", F.col("ds").cast("date")).withColumn(
        "y", F.col("y").cast("double")
    )
    kept = lookup_join(typed, cut, ["series_id"], "inner", F.col("ds"))
    kept = kept.where(F.col("_cut").isNull() | (F.col("ds") < F.col("_cut")))
    return kept.withColumn("series_id", F.col("_request")).drop("_cut", "_request")


def history_extent(rows: DataFrame, params: DataFrame, as_of: datetime.date) -> DataFrame:
    """``series_id, n_rows, n_days, n_columns, min_ds, max_ds, cutoff`` per series with history.

    ``n_days`` counts the days with a known fact, ``n_rows`` all rows.
    The back-test cutoff lies 30 days before the earlier of ``fake_yesterday`` (``as_of``
    if not given) and the last day.
    """
    known = F.col("y").isNotNull() & ~F.isnan("y")
    days = rows.groupBy("series_id", "ds").agg(
        F.count(F.lit(1)).alias("_rows"), F.max(known.cast("int")).alias("_known")
    )
    extent = days.groupBy("series_id").agg(
        F.sum("_rows").alias("n_rows"),
        F.sum("_known").alias("n_days"),
        F.min("ds").alias("min_ds"),
        F.max("ds").alias("max_ds"),
    )
    given = params.select(
        F.col("request_id").alias("series_id"),
        F.coalesce("fake_yesterday", F.lit(as_of)).alias("_until"),
    )
    cutoff = F.date_sub(F.least("_until", "max_ds"), FOLD_DAYS)
    return lookup_join(extent, given, ["series_id"], "inner").select(
        "series_id",
        "n_rows",
        "n_days",
        F.lit(len(rows.columns) - 1).alias("n_columns"),
        "min_ds",
        "max_ds",
        cutoff.alias("cutoff"),
    )


def history_frame(history: DataFrame, params: DataFrame, as_of: datetime.date) -> DataFrame:
    """Typed and cut history with the extent and back-test cutoff of its series."""
    rows = history_rows(history, params)
    extent = history_extent(rows, params, as_of).select("series_id", "max_ds", "cutoff")
    return lookup_join(rows, extent, ["series_id"], "inner", F.col("ds"))


def calendar_columns(calendar: DataFrame, wanted: Sequence[str] | None = None) -> list[str]:
    """Regressors the calendar has, of the wanted ones or all."""
    have = [name for name in calendar.columns if name != "ds"]
    return have if wanted is None else [name for name in wanted if name in have]


def add_regressors(
    frame: DataFrame, calendar: DataFrame, wanted: Sequence[str] | None = None
) -> DataFrame:
    """Left join of the wanted regressors on the day; wanted names the calendar lacks are
    ignored, and a column the frame already has stays as it is."""
    names = [name for name in calendar_columns(calendar, wanted) if name not in frame.columns]
    days = calendar.select(P.calendar_date(F.col("ds")).alias("ds"), *names)
    return lookup_join(frame, days, ["ds"], "left", F.col("series_id"))


def future_spine(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``series_id, ds, is_future``: distinct history days and the days of the horizon."""
    days = rows.select("series_id", "ds").distinct()
    horizon = params.select(F.col("request_id").alias("series_id"), "forecasting_period")
    ends = lookup_join(
        rows.groupBy("series_id").agg(F.max("ds").alias("_last")), horizon, ["series_id"], "inner"
    ).where("forecasting_period > 0")
    future = ends.select(
        "series_id",
        F.explode(
            F.sequence(
                F.date_add("_last", 1), F.date_add(F.col("_last"), F.col("forecasting_period"))
            )
        ).alias("ds"),
    )
    return days.withColumn("is_future", F.lit(False)).unionByName(
        future.withColumn("is_future", F.lit(True))
    )


def plan_fact(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """``series_id, ds, y, yhat, iliPlanIliFact``: fact where there is one, else forecast.

    A day with several facts gives several rows. Equal facts travel as one row with a
    count and are unfolded after the join. A fact of -1 counts as missing.
    """
    facts = actual.groupBy("series_id", "ds", F.col("y").cast("double").alias("y")).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    joined = forecast.select("series_id", "ds", "yhat").join(facts, ["series_id", "ds"], "left")
    y = F.coalesce(F.nanvl("y", F.lit(None).cast("double")), F.lit(NO_FACT))
    mixed = joined.withColumn("y", y).withColumn(
        "iliPlanIliFact", F.when(F.col("y") != NO_FACT, F.col("y")).otherwise(F.col("yhat"))
    )
    copies = F.sequence(F.lit(1).cast("bigint"), F.coalesce("_copies", F.lit(1).cast("bigint")))
    return mixed.select(
        "series_id", "ds", "y", "yhat", "iliPlanIliFact", F.explode(copies).alias("_copy")
    ).drop("_copy")


def session_id(run: Column) -> Column:
    """Identifier of a run: MD5 of its timestamp as text."""
    return F.md5(run.cast("string"))
