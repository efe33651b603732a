import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.operators import forecast as FC
from martloom.operators import series as S

from conftest import rows

REQUESTS = (
    "forecastMarker string, sender string, sql_query string, forecasting_period string, "
    "fake_yesterday string, use_hypo string, error_output string"
)
HYPER = (
    "forecastMarker string, date date, changepoint_prior_scale double, seasonality_prior_scale double, "
    "holidays_prior_scale double, seasonality_mode string, regressors string, sql string"
)
DAY = datetime.date
START = DAY(2020, 1, 1)
AS_OF = DAY(2024, 3, 1)
RUN = "2024-03-01 07:00:00"


def request(name, period="10", until=None, use=None, error=None, sql=None):
    return (name, "me", sql, period, until, use, error)


def requests(spark, *entries):
    return spark.createDataFrame(list(entries), REQUESTS)


def hyper(spark, *entries):
    return spark.createDataFrame(list(entries), HYPER)


def params(spark, *entries, stored=()):
    return S.forecast_params(requests(spark, *entries), hyper(spark, *stored))


def history(spark, name, values, start=START):
    entries = [(name, start + datetime.timedelta(days=i), float(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(entries, "series_id string, ds date, y double")


def calendar(spark, days=2000, start=START):
    entries = [
        (f"{start + datetime.timedelta(days=i)} 00:00:00", float((start + datetime.timedelta(days=i)).weekday() < 5), float(i % 11))
        for i in range(days)
    ]
    return spark.createDataFrame(entries, "ds string, dow double, load double")


def test_request_defaults_and_hyperparameters(spark):
    stored = [
        ("a", DAY(2023, 1, 1), 0.1, 1.0, 2.0, "multiplicative", "x", "OLD"),
        ("a", DAY(2024, 1, 1), 0.2, None, 3.0, None, "dow, load", "SQL"),
    ]
    got = {
        r["sender"]: r
        for r in rows(
            S.forecast_params(
                spark.createDataFrame(
                    [("a", "1", None, None, None, None, None), ("a", "2", "MINE", "x", "2024-01-05", "false", "true"),
                     ("b", "3", None, "7", "bad", "true", None), (None, "4", None, None, None, None, None)],
                    REQUESTS,
                ),
                hyper(spark, *stored),
            )
        )
    }
    one, two, three, four = (got[k] for k in "1234")
    assert (one["forecasting_period"], one["use_hypo"], one["error_output"]) == (365, True, False)
    assert (one["changepoint_prior_scale"], one["seasonality_prior_scale"]) == (0.2, None)
    assert one["regressors"] == ["dow", "load"] and one["sql_query"] == "SQL" and one["sql_from_hypo"]
    assert two["changepoint_prior_scale"] is None and two["regressors"] == ["dow"]
    assert two["is_special"] and two["sql_query"] == "MINE" and not two["sql_from_hypo"]
    assert two["fake_yesterday"] == DAY(2024, 1, 5) and two["forecasting_period"] == 365
    assert three["forecasting_period"] == 7 and not three["is_special"] and three["fake_yesterday"] is None
    assert four["found_records"] == 0


def test_cutoff_golden(spark):
    rows_ = history(spark, "a", [1.0] * 60, start=DAY(2024, 1, 15))  # to 2024-03-14
    p = params(spark, request("a", until="2024-03-01"))
    cut = S.history_rows(rows_, p)
    (extent,) = rows(S.history_extent(cut, p, AS_OF))
    assert extent["max_ds"] == DAY(2024, 2, 29) and extent["cutoff"] == DAY(2024, 1, 30)
    plain = params(spark, request("a"))
    (extent,) = rows(S.history_extent(S.history_rows(rows_, plain), plain, AS_OF))
    assert extent["cutoff"] == DAY(2024, 1, 31) and extent["n_rows"] == 60


def test_spine_has_history_and_horizon(spark):
    frame = history(spark, "a", [1, None, 3, 4]).unionByName(history(spark, "a", [9]))
    p = params(spark, request("a", period="5"))
    spine = rows(S.future_spine(frame, p))
    assert len(spine) == 3 + 5
    assert sum(r["is_future"] for r in spine) == 5
    assert max(r["ds"] for r in spine) == DAY(2020, 1, 9)


def test_sentinels(spark):
    forecast = spark.createDataFrame([("a", START, 5.0), ("a", DAY(2020, 1, 2), 6.0), ("a", DAY(2020, 1, 3), 7.0)], "series_id string, ds date, yhat double")
    actual = spark.createDataFrame(
        [("a", START, -1.0), ("a", DAY(2020, 1, 2), None), ("a", DAY(2020, 1, 3), 2.0), ("a", DAY(2020, 1, 3), 2.0), ("a", DAY(2020, 1, 3), 4.0)],
        "series_id string, ds date, y double",
    )
    got = [(r["ds"].day, r["y"], r["iliPlanIliFact"]) for r in rows(S.plan_fact(forecast, actual), "ds", "y")]
    assert got == [(1, -1.0, 5.0), (2, -1.0, 6.0), (3, 2.0, 2.0), (3, 2.0, 2.0), (3, 4.0, 4.0)]


def test_trend_dow_recovers_a_line_with_weekdays(spark):
    effect = [0, 1, 2, 3, 4, 5, 6]
    values = [100 + 2 * i + effect[(START + datetime.timedelta(days=i)).weekday()] for i in range(70)]
    rows_ = history(spark, "a", values)
    spine = S.future_spine(rows_, params(spark, request("a", period="14")))
    got = rows(FC.fit_predict(rows_, spine), "ds")
    for i, row in enumerate(got):
        day = START + datetime.timedelta(days=i)
        assert row["yhat"] == pytest.approx(100 + 2 * i + effect[day.weekday()], abs=0.2)


def test_trend_dow_of_one_day(spark):
    rows_ = history(spark, "a", [5.0])
    spine = S.future_spine(rows_, params(spark, request("a", period="2")))
    assert [r["yhat"] for r in rows(FC.fit_predict(rows_, spine))] == [5.0, 5.0, 5.0]


def _signal(i):
    day = START + datetime.timedelta(days=i)
    week = 5 * math.sin(2 * math.pi * i / 7)
    year = 20 * math.cos(2 * math.pi * i / 365.25)
    return 200 + 0.05 * i + week + year + 8 * (day.weekday() < 5) + 2 * (i % 11)


def test_additive_recovers_the_signal(spark):
    rows_ = history(spark, "a", [_signal(i) for i in range(900)])
    p = params(spark, request("a", period="30"), stored=[("a", START, None, None, None, None, "dow,load", None)])
    cal = calendar(spark)
    full = S.add_regressors(rows_, cal, ["dow", "load"])
    spine = S.add_regressors(S.future_spine(rows_, p), cal, ["dow", "load"])
    got = rows(FC.fit_predict(full, spine, "additive", p, ["dow", "load"]), "ds")
    assert len(got) == 930
    for i, row in enumerate(got):
        assert row["yhat"] == pytest.approx(_signal(i), abs=4.0), i


def test_multiplicative_beats_additive_on_its_own_data(spark):
    def grown(i):
        return (50 + 0.3 * i) * (1 + 0.3 * math.sin(2 * math.pi * i / 7))

    rows_ = history(spark, "a", [grown(i) for i in range(400)])
    worst = {}
    for mode in ("additive", "multiplicative"):
        p = params(spark, request("a", period="20"), stored=[("a", START, None, None, None, mode, "none", None)])
        got = rows(FC.fit_predict(rows_, S.future_spine(rows_, p), "additive", p), "ds")
        worst[mode] = max(abs(r["yhat"] - grown(i)) for i, r in enumerate(got))
    assert worst["multiplicative"] < 2.0 < worst["additive"]


def test_repeated_rows_weigh_like_copies(spark):
    base = history(spark, "a", [10 + i % 7 for i in range(60)])
    p = params(spark, request("a"))
    spine = S.future_spine(base, p)
    one = rows(FC.fit_predict(base, spine, "additive", p), "ds")
    three = rows(FC.fit_predict(base.unionByName(base).unionByName(base), spine, "additive", p), "ds")
    for a, b in zip(one, three):
        assert a["yhat"] == pytest.approx(b["yhat"], abs=0.1)


def test_backtest_cases(spark):
    p = params(
        spark, request("a", error="true"), request("b"), request("c", error="true"), request("z", error="true")
    )
    good = [100 + (START + datetime.timedelta(days=i)).weekday() for i in range(100)]
    frame = history(spark, "a", good).unionByName(history(spark, "b", good)).unionByName(
        history(spark, "z", [0 if i == 90 else v for i, v in enumerate(good)])
    )
    got = {r["series_id"]: r for r in rows(FC.backtest(S.history_frame(frame, p, AS_OF), p))}
    assert got["a"]["n_test"] == 30 and 0 <= got["a"]["error_rate"] < 0.01
    assert got["a"]["error_rate"] == got["a"]["mape"]
    assert got["b"]["error_rate"] == -1.0 and got["c"]["error_rate"] == -3.14
    assert got["z"]["mape"] is None and got["z"]["error_rate"] == got["z"]["mdape"] < 0.01


def test_forecast_end_to_end_statuses(spark):
    cal = calendar(spark, days=300)
    frame = (
        history(spark, "ok", [10 + i % 7 for i in range(200)])
        .unionByName(history(spark, "gap", [10 + i % 7 for i in range(280)]))
        .unionByName(history(spark, "short", [1.0]))
        .unionByName(history(spark, "unused", [1.0] * 50))
    )
    asks = requests(
        spark, request("ok", period="30", error="true"), request("gap", period="60"), request("short"), request("none")
    )
    stored = hyper(spark, ("ok", START, 0.1, None, None, "additive", "dow", "SELECT 1"))
    result, summary = FC.forecast(asks, frame, stored, cal, AS_OF, RUN)
    facts = {r["series_id"]: r for r in rows(summary)}
    assert {k: r["status"] for k, r in facts.items()} == {
        "ok": "ok", "gap": "regressor_gap", "short": "too_short", "none": "no_data",
    }
    assert 0 <= facts["ok"]["error_rate"] < 0.05 and facts["none"]["error_rate"] == -3.14
    assert facts["ok"]["parameters"] == {
        "interval_width": "0.8", "changepoint_prior_scale": "0.1", "seasonality_mode": "additive"
    }
    assert facts["gap"]["parameters"] is None and facts["ok"]["n_columns"] == 2
    assert len(facts["ok"]["session_id"]) == 32
    days = rows(result, "ds")
    assert {r["series_id"] for r in days} == {"ok"} and len(days) == 230
    assert all(r["iliPlanIliFact"] == r["y"] for r in days[:200])
    assert all(r["y"] == -1.0 and r["iliPlanIliFact"] == r["yhat"] for r in days[200:])


def test_sources(spark):
    history(spark, "x", [1, 2, 3]).createOrReplaceTempView("stored_history")
    asks = [
        request("sql", sql="SELECT ds, y FROM stored_history"),
        request("bad", sql="SELECT * FROM no_such_table_here"),
        request("frame", sql="SELECT ds, y FROM stored_history"),
        request("nothing"),
        request("hypo"),
    ]
    p = params(spark, *asks, stored=[("hypo", START, None, None, None, None, None, "SELECT ds, y FROM stored_history")])
    supplied = history(spark, "frame", [7])
    chosen = S.choose_source(p, supplied)
    assert {r["forecastMarker"]: r["source"] for r in rows(chosen)} == {
        "sql": "request_sql", "bad": "request_sql", "frame": "frame", "nothing": "none", "hypo": "stored_sql",
    }
    found, errors = S.read_sources(spark, chosen, supplied)
    counts = {}
    for r in rows(found):
        counts[r["series_id"]] = counts.get(r["series_id"], 0) + 1
    assert counts == {"sql": 3, "hypo": 3, "frame": 1}
    assert rows(errors) == [{"series_id": "bad", "error": "sql is worng"}]


def test_a_query_that_fails_while_it_runs(spark):
    """One request's failure is its own; a column named error is none."""
    history(spark, "x", [1, 2, 3]).createOrReplaceTempView("stored_history")
    asks = [
        request("late", sql="SELECT ds, cast(raise_error('late') AS double) AS y FROM stored_history"),
        request("good", sql="SELECT ds, y, 1 AS error FROM stored_history"),
        request("shape", sql="SELECT 'x' AS error"),
    ]
    found, errors = S.read_sources(spark, S.choose_source(params(spark, *asks)))
    assert {r["series_id"] for r in rows(found)} == {"good"}
    assert {r["series_id"] for r in rows(errors)} == {"late", "shape"}


def test_requests_for_one_marker_stay_apart(spark):
    """Two senders with one marker, and a request without marker, each with horizon and cut of its own."""
    entries = [("r1", *request("a", period="3")), ("r2", *request("a", period="5", until="2020-02-01")), ("r3", *request(None, period="2"))]
    asks = spark.createDataFrame(entries, "request_id string, " + REQUESTS)
    past = history(spark, "a", range(60)).unionByName(history(spark, "r3", range(20)))
    done, summary = FC.forecast(asks, past, hyper(spark), calendar(spark), AS_OF, RUN, "trend_dow")
    days = {}
    for r in rows(done):
        days.setdefault(r["series_id"], []).append(r["ds"])
    assert {k: len(v) for k, v in days.items()} == {"r1": 63, "r2": 36, "r3": 22}
    assert max(days["r2"]) == DAY(2020, 2, 5) and len(set(days["r1"])) == 63
    assert {r["series_id"]: r["n_rows"] for r in rows(summary)} == {"r1": 60, "r2": 31, "r3": 20}


def test_too_few_known_days(spark):
    """Rows of one day, and rows without facts, are no history to fit."""
    day = spark.createDataFrame([("one", START, 1.0), ("one", START, 2.0), ("null", START, None), ("null", DAY(2020, 1, 2), None)], "series_id string, ds date, y double")
    asks = requests(spark, request("one"), request("null"))
    for model in ("trend_dow", "additive"):
        done, summary = FC.forecast(asks, day, hyper(spark), calendar(spark), AS_OF, RUN, model)
        assert rows(done) == [] and {r["status"] for r in rows(summary)} == {"too_short"}


def test_a_gap_is_no_zero_outside_of_forecast(spark):
    rows_ = history(spark, "a", range(40))
    p = params(spark, request("a"), stored=[("a", START, None, None, None, None, "load", None)])
    full = S.add_regressors(rows_, calendar(spark, 30), ["load"])
    assert rows(FC.fit_predict(full, full.select("series_id", "ds", "load"), "additive", p, ["load"])) == []


def test_multiplicative_keeps_days_with_a_trend_near_zero(spark):
    """A line through zero: no day and no series is lost, and the season is found."""
    values = [(i - 50) * (1.5 if i % 7 == 0 else 1.0) for i in range(101)]
    p = params(spark, request("a", period="7"), stored=[("a", START, 0.05, 10.0, 10.0, "multiplicative", None, None)])
    full = S.add_regressors(history(spark, "a", values), calendar(spark), ["dow"])
    spine = S.add_regressors(S.future_spine(full, p), calendar(spark), ["dow"])
    got = rows(FC.fit_predict(full, spine, "additive", p, ["dow"]), "ds")
    assert len(got) == 108
    assert np.mean([abs(r["yhat"] - v) for r, v in zip(got, values)]) < 2.0


def test_back_test_without_a_fold_says_so(spark):
    p = params(spark, request("a", error="true"), request("b"), request("c", error="true"))
    base = history(spark, "a", range(10)).unionByName(history(spark, "b", range(60)))
    got = {r["series_id"]: r["status"] for r in rows(FC.backtest(S.history_frame(base, p, AS_OF), p))}
    assert got == {"a": "no_fold", "b": "not_requested", "c": "no_data"}


def test_own_column_wins_over_the_calendar(spark):
    frame = history(spark, "a", [1]).withColumn("dow", F.lit(42.0))
    (row,) = rows(S.add_regressors(frame, calendar(spark), ["dow", "load", "unknown"]))
    assert row["dow"] == 42.0 and row["load"] == 0.0 and "unknown" not in row


def _design(days, start, span, loads):
    t = (days - start) / span
    columns = [np.ones_like(t), t] + [np.maximum(t - 0.8 * k / 25, 0) for k in range(1, 26)]
    epoch = days - DAY(1970, 1, 1).toordinal()
    for order, period, wanted in ((3, 7.0, span >= 14), (10, 365.25, span >= 730)):
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * epoch / period
            columns += [np.sin(angle) * wanted, np.cos(angle) * wanted]
    return np.stack([*columns, loads], axis=1)


def test_additive_agrees_with_a_direct_solve(spark):
    values = [_signal(i) for i in range(800)]
    rows_ = history(spark, "a", values)
    p = params(spark, request("a", period="25"), stored=[("a", START, 0.3, 4.0, 2.0, "additive", "load", None)])
    cal = calendar(spark)
    full = S.add_regressors(rows_, cal, ["load"])
    spine = S.add_regressors(S.future_spine(rows_, p), cal, ["load"])
    got = np.array([r["yhat"] for r in rows(FC.fit_predict(full, spine, "additive", p, ["load"]), "ds")])

    days = START.toordinal() + np.arange(825.0)
    loads = np.arange(825) % 11.0
    x = _design(days, days[0], 799, loads)
    mean, spread = loads[:800].mean(), loads[:800].std()
    x[:, -1] = (loads - mean) / spread
    y = np.array(values)
    scale = y.max()
    penalty = np.array([1 / 25] * 2 + [0.5 / 0.3**2] * 25 + [1 / 16] * 26 + [1 / 4])
    noise = 0.01
    for _ in range(60):
        beta = np.linalg.solve(x[:800].T @ x[:800] + noise * np.diag(penalty), x[:800].T @ (y / scale))
        noise = max(np.mean((y / scale - x[:800] @ beta) ** 2), 1e-8)
    assert np.allclose(got, scale * (x @ beta), rtol=1e-6)


def test_median_of_repeated_errors(spark):
    values = [100.0] * 60 + [0.0] + [100.0] * 29
    p = params(spark, request("a", error="true"))
    base = history(spark, "a", values)
    one = rows(FC.backtest(S.history_frame(base, p, AS_OF), p))[0]
    two = rows(FC.backtest(S.history_frame(base.unionByName(base), p, AS_OF), p))[0]
    assert two["n_test"] == 2 * one["n_test"] and two["mdape"] == pytest.approx(one["mdape"])


def test_noise_of_near_exact_series_ends():
    """Rounded lines, constants and tiny noise: the noise search ends and is the fixed point."""
    rng = np.random.default_rng(5)
    days = START.toordinal() + np.arange(400.0)
    x = _design(days, days[0], 399, np.arange(400) % 11.0)
    penalty = np.array([1 / 25] * 2 + [0.5 / 0.05**2] * 25 + [1 / 100] * 26 + [1 / 100])
    cases = [np.round(1000 + 0.37 * np.arange(400) + 4 * np.sin(2 * np.pi * np.arange(400) / 7))]
    cases += [np.round(level + slope * np.arange(400)) for level, slope in ((5, 0.01), (3000, 2.5), (10, 0.0))]
    cases += [np.full(400, 7.0), 100 + 0.3 * np.arange(400) + rng.normal(0, 1e-4, 400)]
    for y in cases:
        y = y / np.abs(y).max()
        r = np.linalg.qr(np.hstack([x, y[:, None]]), mode="r")
        w = x.shape[1]
        beta, noise = FC.ridge_noise(r[:w, :w], r[:w, w], float(r[w, w] ** 2), 400.0, penalty)
        rss = float(np.sum((y - x @ beta) ** 2))
        assert noise == pytest.approx(max(rss / 400, 1e-8), rel=1e-9, abs=1e-15)
        direct = np.linalg.solve(x.T @ x + noise * np.diag(penalty), x.T @ y)
        assert np.allclose(x @ beta, x @ direct, rtol=1e-7, atol=1e-9)


def test_factor_partials_keep_the_residual():
    """Stacked block factors give the residual of a direct solve on a 20-year series."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(7305, 6))
    y = x @ rng.normal(size=6) + rng.normal(0, 1e-7, 7305)
    blocks = [FC._triangle(np.hstack([x[k : k + 3660], y[k : k + 3660, None]]), 7) for k in range(0, 7305, 3660)]
    r = FC._triangle(np.vstack(blocks), 7)
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    direct = float(np.sum((y - x @ beta) ** 2))
    assert r[6, 6] ** 2 == pytest.approx(direct, rel=1e-6)
    fitted = np.linalg.solve(r[:6, :6], r[:6, 6])
    assert np.allclose(fitted, beta, rtol=1e-9)


def test_additive_on_a_rounded_counter_ends(spark):
    values = [round(1000 + 0.37 * i + 4 * math.sin(2 * math.pi * i / 7)) for i in range(400)]
    rows_ = history(spark, "c", values)
    p = params(spark, request("c", period="10"), stored=[("c", START, None, None, None, None, None, None)])
    spine = S.future_spine(rows_, p)
    got = [r["yhat"] for r in rows(FC.fit_predict(rows_, spine, "additive", p), "ds")]
    assert len(got) == 410 and all(abs(g - v) < 3 for g, v in zip(got, values))


@pytest.mark.parametrize("exact", [64, 1, 10_000])
def test_weighted_median_equals_percentile(spark, monkeypatch, exact):
    monkeypatch.setattr(FC, "MEDIAN_EXACT", exact)  # 1: every range is narrowed by buckets
    rng = np.random.default_rng(7)
    data = []
    for k in range(12):
        size = int(rng.integers(1, 400))
        spread = [rng.exponential(1.0), rng.lognormal(0, 8), 1e-300, 3.0][k % 4]
        for v in np.round(rng.exponential(spread, size), int(rng.integers(1, 12))):
            data.append((f"s{k}", float(v), int(rng.integers(1, 4))))
    data += [("inf", float("inf"), 2), ("inf", 1.0, 1), ("nan", float("nan"), 1), ("nan", 2.0, 3), ("one", 5.0, 7)]
    frame = spark.createDataFrame(data, "series_id string, _ape double, _n long")
    got = {r.series_id: r.median for r in FC.weighted_median(frame).collect()}
    want = {r.series_id: r.m for r in frame.groupBy("series_id").agg(F.percentile("_ape", 0.5, F.col("_n")).alias("m")).collect()}
    assert set(got) == set(want)
    for name in want:
        assert got[name] == want[name] or (math.isnan(got[name]) and math.isnan(want[name])) or got[name] == pytest.approx(want[name], rel=1e-12), name
