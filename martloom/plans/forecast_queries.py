"""Queries of the forecasting operators and JSON bodies with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.operators import forecast as FC
from martloom.operators import series as S
from martloom.plans import inputs as I
from martloom.session import stage
from martloom.sources import columnar_json as J

# ---- SQL twins ---------------------------------------------------------------------------

_HYPER = f"""{I.ctes('hyperparameters')},
    latest AS (SELECT * FROM hyperparameters
               QUALIFY row_number() OVER (PARTITION BY forecastMarker ORDER BY date DESC) = 1)"""

_PARAMS = f"""{_HYPER}, {I.ctes('requests')},
    flags AS (SELECT r.*, coalesce(try_cast(use_hypo AS BOOLEAN), TRUE) AS use,
                     l.* EXCLUDE (forecastMarker), l.forecastMarker IS NOT NULL AS found
              FROM requests r LEFT JOIN latest l ON l.forecastMarker = r.forecastMarker),
    params AS (SELECT forecastMarker AS request_id, forecastMarker, sender, coalesce(try_cast(forecasting_period AS INTEGER), 365) AS forecasting_period,
        CAST(fake_yesterday AS DATE) AS fake_yesterday, use AS use_hypo,
        coalesce(try_cast(error_output AS BOOLEAN), FALSE) AS error_output,
        CASE WHEN use THEN changepoint_prior_scale END AS changepoint_prior_scale,
        CASE WHEN use THEN seasonality_prior_scale END AS seasonality_prior_scale,
        CASE WHEN use THEN holidays_prior_scale END AS holidays_prior_scale,
        CASE WHEN use THEN seasonality_mode END AS seasonality_mode,
        CASE WHEN use AND regressors IS NOT NULL THEN replace(regressors, ' ', '') ELSE 'dow' END AS regressors,
        coalesce(sql_query, sql) AS sql_query, sql_query IS NULL AND sql IS NOT NULL AS sql_from_hypo,
        found AS is_special, CAST(found AS INTEGER) AS found_records FROM flags)"""

_ROWS = f"""{_PARAMS},
    hist AS (SELECT h.* FROM history h JOIN params p ON p.forecastMarker = h.series_id
             WHERE p.fake_yesterday IS NULL OR h.ds < p.fake_yesterday),
    extent AS (SELECT series_id, count(*) AS n_rows, count(DISTINCT CASE WHEN y IS NOT NULL AND NOT isnan(y) THEN ds END) AS n_days, 2 AS n_columns, min(ds) AS min_ds, max(ds) AS max_ds
               FROM hist GROUP BY 1),
    extents AS (SELECT e.*, CAST(least(coalesce(p.fake_yesterday, DATE '2001-08-01'), max_ds) - INTERVAL 30 DAY AS DATE) AS cutoff
                FROM extent e JOIN params p ON p.forecastMarker = e.series_id)"""

_SPINE = f"""{_ROWS},
    spine AS (SELECT DISTINCT series_id, ds, FALSE AS is_future FROM hist
              UNION ALL
              SELECT series_id, CAST(unnest(generate_series(max_ds + INTERVAL 1 DAY,
                     max_ds + to_days(forecasting_period), INTERVAL 1 DAY)) AS DATE), TRUE
              FROM extent JOIN params ON forecastMarker = series_id)"""


def _fit(source: str, name: str) -> str:
    """Line and weekday effects by the engine's own regression functions."""
    return f"""
    {name}_days AS (SELECT *, date_diff('day', DATE '2000-01-01', ds) AS t FROM {source}),
    {name}_line AS (SELECT series_id, coalesce(regr_slope(y, t), 0) AS b,
                           coalesce(regr_intercept(y, t), avg(y)) AS a FROM {name}_days GROUP BY 1),
    {name}_dow AS (SELECT series_id, isodow(ds) AS dow, avg(y - a - b * t) AS effect
                   FROM {name}_days JOIN {name}_line USING (series_id) GROUP BY 1, 2)"""


def _predict(days: str, name: str) -> str:
    return f"""(SELECT d.*, a + b * date_diff('day', DATE '2000-01-01', d.ds) + coalesce(effect, 0) AS yhat
        FROM {days} d JOIN {name}_line l ON l.series_id = d.series_id
        LEFT JOIN {name}_dow w ON w.series_id = d.series_id AND w.dow = isodow(d.ds))"""


_FORECAST = f"""{_SPINE}, {_fit('hist', 'full')}, forecast AS {_predict('spine', 'full')}"""

_MIX = f"""{_FORECAST},
    mixed AS (SELECT f.series_id, f.ds, coalesce(h.y, -1) AS y, f.yhat,
                     CASE WHEN coalesce(h.y, -1) <> -1 THEN h.y ELSE f.yhat END AS mix
              FROM forecast f LEFT JOIN hist h ON h.series_id = f.series_id AND h.ds = f.ds)"""

# the same chain where every request has a copy of its marker's history
_SHARED = (
    _MIX.replace(I.ctes("requests"), I.ctes("shared_requests"))
    .replace("FROM requests r", "FROM (SELECT * REPLACE (request_id AS forecastMarker) FROM shared_requests) r")
    .replace("FROM history h JOIN params", "FROM (SELECT q.request_id AS series_id, h.ds, h.y FROM history h JOIN shared_requests q ON q.forecastMarker = h.series_id) h JOIN params")
)

_BACKTEST = f"""{_ROWS},
    asked AS (SELECT forecastMarker AS series_id, error_output FROM params),
    rated AS (SELECT h.*, cutoff FROM hist h JOIN extents USING (series_id) JOIN asked USING (series_id) WHERE error_output),
    train AS (SELECT series_id, ds, y FROM rated WHERE ds <= cutoff),
    test AS (SELECT series_id, ds, y FROM rated WHERE ds > cutoff AND ds <= cutoff + INTERVAL 30 DAY),
    {_fit('train', 'part')}, tried AS {_predict('test', 'part')},
    errors AS (SELECT series_id, count(*) AS n_test,
                      CASE WHEN min(abs(y)) >= 1e-8 THEN avg(abs((y - yhat) / y)) END AS mape,
                      median(CASE WHEN y <> 0 THEN abs((y - yhat) / y) ELSE 'inf'::DOUBLE END) AS mdape FROM tried GROUP BY 1),
    backtest AS (SELECT a.series_id, coalesce(n_test, 0) AS n_test, mape, mdape,
                        CASE WHEN x.series_id IS NULL THEN -3.14 WHEN NOT error_output THEN -1.0
                             ELSE coalesce(mape, mdape) END AS error_rate,
                        CASE WHEN x.series_id IS NULL THEN 'no_data' WHEN NOT error_output THEN 'not_requested'
                             WHEN n_test IS NULL THEN 'no_fold' ELSE 'ok' END AS status
                 FROM asked a LEFT JOIN extent x USING (series_id) LEFT JOIN errors USING (series_id))"""

# ---- Spark queries -----------------------------------------------------------------------


def _round(name):
    return F.round(name, 4)


def _params(spark, d):
    return S.forecast_params(I.read(spark, d, "requests"), I.read(spark, d, "hyperparameters"))


def _history(spark, d):
    return I.read(spark, d, "history")


def _calendar(spark, d):
    return I.read(spark, d, "calendar")


def _rows(spark, d):
    return S.history_rows(_history(spark, d), _params(spark, d))


def _frame(spark, d):
    return S.history_frame(_history(spark, d), _params(spark, d), I.AS_OF)


def hyper_latest(spark, d):
    return S.latest_hyperparameters(I.read(spark, d, "hyperparameters"))


def forecast_params(spark, d):
    return _params(spark, d).withColumn("regressors", F.array_join("regressors", ","))


def forecast_parameter_map(spark, d):
    pairs = F.transform(
        F.array_sort(F.map_entries("parameters")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return S.parameter_map(_params(spark, d)).select(
        "forecastMarker", F.array_join(pairs, ",").alias("parameters")
    )


def forecast_source(spark, d):
    """Source of every request where the histories of the events are supplied as a frame."""
    events = spark.read.parquet(f"{d.rstrip('/')}/events.parquet")
    supplied = events.select(F.col("event_type").alias("series_id"))
    return S.choose_source(_params(spark, d), supplied).select("forecastMarker", "source")


def history_frame(spark, d):
    return _frame(spark, d)


def history_extent(spark, d):
    return S.history_extent(_rows(spark, d), _params(spark, d), I.AS_OF)


def regressor_calendar(spark, d):
    return S.add_regressors(
        S.future_spine(_rows(spark, d), _params(spark, d)), _calendar(spark, d), ["dow"]
    )


def regressor_join(spark, d):
    return S.add_regressors(_rows(spark, d), _calendar(spark, d), ["dow", "month_end", "unknown"])


def future_spine(spark, d):
    return S.future_spine(_rows(spark, d), _params(spark, d))


def _stored(spark, d):
    """Parameters and cut history, stored for the branches that read them."""
    params = stage(_params(spark, d), "params")
    return params, stage(S.history_rows(_history(spark, d), params), "rows")


def forecast_trend_dow(spark, d):
    params, rows = _stored(spark, d)
    forecast = FC.fit_predict(rows, S.future_spine(rows, params))
    return forecast.withColumn("yhat", _round("yhat"))


def plan_fact_mix(spark, d):
    params, rows = _stored(spark, d)
    forecast = FC.fit_predict(rows, S.future_spine(rows, params))
    return S.plan_fact(forecast, rows).withColumns(
        {"yhat": _round("yhat"), "iliPlanIliFact": _round("iliPlanIliFact")}
    )


def backtest_error(spark, d):
    rounded = {name: F.round(name, 6) for name in ("mape", "mdape", "error_rate")}
    params, rows = _stored(spark, d)
    frame = S.history_frame(rows, params, I.AS_OF)
    return FC.backtest(frame, params).withColumns(rounded)


def _additive_frames(spark, d):
    params, rows = _stored(spark, d)
    calendar = _calendar(spark, d)
    names = S.calendar_columns(calendar)
    frame = S.history_frame(rows, params, I.AS_OF)
    return S.add_regressors(frame, calendar, names), params, calendar, names


def forecast_additive(spark, d):
    rows, params, calendar, names = _additive_frames(spark, d)
    spine = S.add_regressors(S.future_spine(rows, params), calendar, names)
    done = FC.fit_predict(rows, spine, "additive", params, names)
    return done.select("series_id", "ds", "is_future", _round("yhat").alias("yhat"))


def backtest_additive(spark, d):
    rows, params, _, names = _additive_frames(spark, d)
    return FC.backtest(rows, params, "additive", names)


def regressor_gaps(spark, d):
    """Series whose spine meets a hole of a calendar with holes."""
    params, rows = _params(spark, d), _rows(spark, d)
    spine = S.add_regressors(S.future_spine(rows, params), I.read(spark, d, "gapped_calendar"), ["dow", "month_end"])
    return FC.regressor_gaps(spine, params, ["dow", "month_end"])


def forecast_shared_marker(spark, d):
    """Two requests for every marker, with horizons and cut days of their own."""
    result, summary = FC.forecast(
        I.read(spark, d, "shared_requests"), _history(spark, d), I.read(spark, d, "hyperparameters"),
        _calendar(spark, d), I.AS_OF, "2001-08-01 07:00:00", "trend_dow",
    )
    known = summary.select("series_id", "status", "forecasting_period", "n_rows")
    return result.withColumns({"yhat": _round("yhat"), "iliPlanIliFact": _round("iliPlanIliFact")}).join(known, "series_id")


def _end_to_end(spark, d, model="additive"):
    return FC.forecast(
        I.read(spark, d, "requests"), _history(spark, d), I.read(spark, d, "hyperparameters"),
        _calendar(spark, d), I.AS_OF, "2001-08-01 07:00:00", model,
    )


def forecast_end_to_end(spark, d):
    return _end_to_end(spark, d)[0]


def forecast_summary(spark, d):
    summary = _end_to_end(spark, d)[1]
    return summary.withColumns(
        {"parameters": F.to_json("parameters"), "regressors": F.array_join("regressors", ",")}
    )


def forecast_end_to_end_trend(spark, d):
    return _end_to_end(spark, d, "trend_dow")[0].withColumns(
        {"yhat": _round("yhat"), "iliPlanIliFact": _round("iliPlanIliFact")}
    )


def forecast_summary_trend(spark, d):
    return _end_to_end(spark, d, "trend_dow")[1].select(
        "series_id", "status", F.round("error_rate", 6).alias("error_rate"), "is_special",
        F.array_join("regressors", ",").alias("regressors"), "forecasting_period",
        "n_rows", "n_columns", "session_id",
    )


def session_id(spark, d):
    orders = spark.read.parquet(f"{d.rstrip('/')}/orders.parquet")
    runs = orders.groupBy("o_orderpriority").agg(F.max("o_orderdate").alias("run_ts"))
    return runs.select("o_orderpriority", S.session_id(F.col("run_ts")).alias("session_id"))


def _request_bodies(spark, d):
    return J.to_columnar_json(_history(spark, d), ("ds", "y"))


def columnar_json_write(spark, d):
    result, summary = _end_to_end(spark, d, "trend_dow")
    return J.to_columnar_json(result, facts=summary)


def columnar_json_read(spark, d):
    return J.read_request_frame(_request_bodies(spark, d))


def forecast_json_decode(spark, d):
    mixed = plan_fact_mix(spark, d)
    return J.decode_result(J.to_columnar_json(mixed))


def _select(chain: str, body: str) -> str:
    return f"WITH {chain} {body}"


_HYPER_MAP = """SELECT forecastMarker, CASE WHEN is_special THEN concat_ws(',',
    'changepoint_prior_scale=' || changepoint_prior_scale, 'holidays_prior_scale=' || holidays_prior_scale,
    'interval_width=0.8', 'seasonality_mode=' || seasonality_mode,
    'seasonality_prior_scale=' || seasonality_prior_scale) END AS parameters FROM params"""

_ROUND = "round({}, 4)"
_MIX_COLUMNS = f'{_ROUND.format("yhat")} AS yhat, {_ROUND.format("mix")} AS "iliPlanIliFact"'
_OTHER_CALENDAR = I.ctes("calendar").replace(I.ctes("history") + ",", "")

QUERIES = {
    "hyper_latest": (hyper_latest, _select(_HYPER, "SELECT * FROM latest")),
    "forecast_params": (forecast_params, _select(_PARAMS, "SELECT * FROM params")),
    "forecast_parameter_map": (forecast_parameter_map, _select(_PARAMS, _HYPER_MAP)),
    "forecast_source": (
        forecast_source,
        _select(
            _PARAMS,
            """SELECT forecastMarker, CASE WHEN forecastMarker IN (SELECT event_type FROM events) THEN 'frame'
            WHEN sql_query IS NULL THEN 'none' WHEN sql_from_hypo THEN 'stored_sql' ELSE 'request_sql' END AS source
            FROM params""",
        ),
    ),
    "history_frame": (
        history_frame,
        _select(_ROWS, "SELECT h.*, max_ds, cutoff FROM hist h JOIN extents USING (series_id)"),
    ),
    "history_extent": (history_extent, _select(_ROWS, "SELECT * FROM extents")),
    "regressor_calendar": (
        regressor_calendar,
        _select(
            f"{_SPINE}, {_OTHER_CALENDAR}",
            "SELECT s.*, c.dow FROM spine s LEFT JOIN calendar c ON CAST(left(c.ds, 10) AS DATE) = s.ds",
        ),
    ),
    "regressor_join": (
        regressor_join,
        _select(
            f"{_ROWS}, {_OTHER_CALENDAR}",
            "SELECT h.*, c.dow, c.month_end FROM hist h LEFT JOIN calendar c ON CAST(left(c.ds, 10) AS DATE) = h.ds",
        ),
    ),
    "future_spine": (future_spine, _select(_SPINE, "SELECT * FROM spine")),
    "forecast_trend_dow": (
        forecast_trend_dow,
        _select(_FORECAST, f"SELECT series_id, ds, is_future, {_ROUND.format('yhat')} AS yhat FROM forecast"),
    ),
    "plan_fact_mix": (
        plan_fact_mix,
        _select(_MIX, f"SELECT series_id, ds, y, {_MIX_COLUMNS} FROM mixed"),
    ),
    "backtest_error": (
        backtest_error,
        _select(
            _BACKTEST,
            "SELECT series_id, n_test, round(mape, 6) AS mape, round(mdape, 6) AS mdape, round(error_rate, 6) AS error_rate, status FROM backtest",
        ),
    ),
    "regressor_gaps": (
        regressor_gaps,
        _select(
            f"{_SPINE}, calendar AS ({I.INPUTS['calendar'][0](I.Duck())}), gapped_calendar AS ({I.INPUTS['gapped_calendar'][0](I.Duck())})",
            """SELECT DISTINCT series_id FROM spine JOIN params ON forecastMarker = series_id
            WHERE ds NOT IN (SELECT CAST(left(ds, 10) AS DATE) FROM gapped_calendar)
              AND len(list_intersect(string_split(regressors, ','), ['dow', 'month_end'])) > 0""",
        ),
    ),
    "forecast_additive": (forecast_additive, None),
    "backtest_additive": (backtest_additive, None),
    "forecast_end_to_end": (forecast_end_to_end, None),
    "forecast_summary": (forecast_summary, None),
    "forecast_end_to_end_trend": (
        forecast_end_to_end_trend,
        _select(_MIX, f"SELECT series_id, ds, y, {_MIX_COLUMNS} FROM mixed"),
    ),
    "forecast_summary_trend": (
        forecast_summary_trend,
        _select(
            _BACKTEST,
            """SELECT b.series_id, CASE WHEN x.n_rows IS NULL THEN 'no_data' WHEN x.n_days < 2 THEN 'too_short' ELSE 'ok' END AS status,
            round(error_rate, 6) AS error_rate, is_special, regressors, forecasting_period, n_rows, n_columns,
            md5('2001-08-01 07:00:00') AS session_id
            FROM backtest b JOIN params p ON p.forecastMarker = b.series_id LEFT JOIN extent x ON x.series_id = b.series_id""",
        ),
    ),
    "forecast_shared_marker": (
        forecast_shared_marker,
        _select(
            _SHARED,
            f"""SELECT m.series_id, ds, y, {_MIX_COLUMNS}, 'ok' AS status, forecasting_period, n_rows
            FROM mixed m JOIN params ON forecastMarker = m.series_id JOIN extent x ON x.series_id = m.series_id
            WHERE n_days >= 2""",
        ),
    ),
    "session_id": (
        session_id,
        "SELECT o_orderpriority, md5(strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S')) AS session_id FROM orders GROUP BY 1",
    ),
    "columnar_json_write": (columnar_json_write, None),
    "columnar_json_read": (
        columnar_json_read,
        _select(
            I.ctes("history"),
            "SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS idx, CAST(ds AS TIMESTAMP) AS ds, y FROM history",
        ),
    ),
    "forecast_json_decode": (
        forecast_json_decode,
        _select(
            _MIX,
            f"SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS idx, CAST(ds AS TIMESTAMP) AS ds, y, {_MIX_COLUMNS} FROM mixed",
        ),
    ),
}
