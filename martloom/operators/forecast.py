"""Fitting, back-testing and assembling forecasts of many daily series.

Two models. ``trend_dow`` is a line plus the mean residual of every weekday, from plain
aggregates. ``additive`` is a piecewise-linear trend with weekly and yearly Fourier terms
and regressors, after Taylor and Letham, "Forecasting at Scale" (2018), fitted by ridge
least squares instead of a sampler: its numbers differ from those of a sampler.

Rows of one day are folded to a count and a mean before anything is grouped by series, so
a series never has more rows than calendar days, however many rows the history holds.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.operators import series as S
from martloom.operators.joins import lookup_join
from martloom.session import stage

ORIGIN = datetime.date(2000, 1, 1)
# Defaults of the published model.
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
WEEKLY_ORDER, WEEKLY_DAYS, WEEKLY_PERIOD = 3, 14, 7.0
YEARLY_ORDER, YEARLY_DAYS, YEARLY_PERIOD = 10, 730, 365.25
CHANGEPOINT_PRIOR, SEASONALITY_PRIOR, HOLIDAYS_PRIOR = 0.05, 10.0, 10.0
TREND_PRIOR = 5.0
MIN_FACT = 1e-8

TREND_WIDTH = 2 + CHANGEPOINTS
SEASON_WIDTH = 2 * (WEEKLY_ORDER + YEARLY_ORDER)
BLOCK_DAYS = 3660


def _day(ds: Column) -> Column:
    return F.datediff(ds, F.lit(ORIGIN)).cast("bigint")


def _known(y: Column) -> Column:
    return y.isNotNull() & ~F.isnan(y)


def fit_trend_dow(rows: DataFrame) -> DataFrame:
    """``series_id, slope, intercept, effects`` (weekday to mean residual).

    One shuffle to seven rows per series: the line and the mean residuals both follow from
    the sums per weekday.
    """
    t, y = _day(F.col("ds")), F.col("y")
    by_weekday = (
        rows.where(_known(y))
        .groupBy("series_id", F.weekday("ds").alias("_dow"))
        .agg(
            F.count(y).alias("_n"),
            F.sum(t).alias("_t"),
            F.sum(t * t).alias("_tt"),
            F.sum(y).alias("_y"),
            F.sum(t * y).alias("_ty"),
        )
    )
    sums = by_weekday.groupBy("series_id").agg(
        *[F.sum(name).cast("double").alias(name) for name in ("_n", "_t", "_tt", "_y", "_ty")],
        F.collect_list(F.struct("_dow", "_n", "_t", "_y")).alias("_days"),
    )
    sxx = F.col("_tt") - F.col("_t") * F.col("_t") / F.col("_n")
    sxy = F.col("_ty") - F.col("_t") * F.col("_y") / F.col("_n")
    lines = sums.withColumn("slope", F.when(sxx > 0, sxy / sxx).otherwise(0.0)).withColumn(
        "intercept", (F.col("_y") - F.col("slope") * F.col("_t")) / F.col("_n")
    )

    def effect(d: Column) -> Column:
        mean_rest = (d["_y"] - F.col("slope") * d["_t"]) / d["_n"] - F.col("intercept")
        return F.struct(d["_dow"], mean_rest)

    return lines.select(
        "series_id",
        "slope",
        "intercept",
        F.map_from_entries(F.transform("_days", effect)).alias("effects"),
    )


def predict_trend_dow(spine: DataFrame, model: DataFrame) -> DataFrame:
    """Add ``yhat`` to the days of the fitted series; unseen weekdays have no effect."""
    joined = lookup_join(spine, model, ["series_id"], "inner", F.col("ds"))
    effect = F.coalesce(F.try_element_at("effects", F.weekday("ds")), F.lit(0.0))
    yhat = F.col("intercept") + F.col("slope") * _day(F.col("ds")) + effect
    return joined.withColumn("yhat", yhat).drop("slope", "intercept", "effects")


def _fourier(order: int, period: float, wanted: Column) -> list[Column]:
    d = F.datediff("ds", F.lit(datetime.date(1970, 1, 1)))
    terms = []
    for k in range(1, order + 1):
        angle = d * F.lit(2.0 * math.pi * k / period)
        terms += [F.when(wanted, wave(angle)).otherwise(0.0) for wave in (F.sin, F.cos)]
    return terms


def _trend_terms() -> list[Column]:
    t = F.datediff("ds", "_start") / F.greatest("_span", F.lit(1))
    knots = [CHANGEPOINT_RANGE * k / CHANGEPOINTS for k in range(1, CHANGEPOINTS + 1)]
    return [F.lit(1.0), t, *[F.greatest(t - F.lit(knot), F.lit(0.0)) for knot in knots]]


def _season_terms(regressors: Sequence[str]) -> list[Column]:
    own = [
        F.when(F.array_contains("_use", name), F.coalesce(F.col(name).cast("double"), F.lit(0.0)))
        .otherwise(0.0)
        for name in regressors
    ]
    weekly = _fourier(WEEKLY_ORDER, WEEKLY_PERIOD, F.col("_span") >= WEEKLY_DAYS)
    yearly = _fourier(YEARLY_ORDER, YEARLY_PERIOD, F.col("_span") >= YEARLY_DAYS)
    return [*weekly, *yearly, *own]


def _penalties(regressors: Sequence[str]) -> tuple[Column, Column]:
    """Inverse prior variances of the trend and of the seasonal and regressor terms.

    Regressors take the holidays prior, as they do in the published implementation where
    none of their own is given.
    """
    level = F.lit(1.0 / TREND_PRIOR**2)
    bend = F.lit(0.5) / (F.col("_cps") * F.col("_cps"))
    season = F.lit(1.0) / (F.col("_sps") * F.col("_sps"))
    own = F.lit(1.0) / (F.col("_hps") * F.col("_hps"))
    trend = F.concat(F.array(level, level), F.array_repeat(bend, CHANGEPOINTS))
    rest = F.concat(F.array_repeat(season, SEASON_WIDTH), F.array_repeat(own, len(regressors)))
    return trend, rest


def fold_days(rows: DataFrame, regressors: Sequence[str] = ()) -> DataFrame:
    """One row per series and day: count, mean and sum of squares of ``y``, regressors."""
    y = F.col("y")
    return (
        rows.where(_known(y))
        .groupBy("series_id", "ds")
        .agg(
            F.count(y).alias("_n"),
            F.avg(y).alias("_y"),
            F.sum(y * y).alias("_yy"),
            *[F.avg(F.col(name).cast("double")).alias(name) for name in regressors],
        )
    )


def _series_setup(folded: DataFrame, params: DataFrame) -> DataFrame:
    """Scale, span and priors of every series."""
    extent = folded.groupBy("series_id").agg(
        F.min("ds").alias("_start"),
        F.datediff(F.max("ds"), F.min("ds")).alias("_span"),
        F.max(F.abs("_y")).alias("_absmax"),
        F.count(F.lit(1)).alias("_days"),
    )
    chosen = params.select(
        F.col("request_id").alias("series_id"),
        F.coalesce("changepoint_prior_scale", F.lit(CHANGEPOINT_PRIOR)).alias("_cps"),
        F.coalesce("seasonality_prior_scale", F.lit(SEASONALITY_PRIOR)).alias("_sps"),
        F.coalesce("holidays_prior_scale", F.lit(HOLIDAYS_PRIOR)).alias("_hps"),
        (F.coalesce("seasonality_mode", F.lit("additive")) == "multiplicative").alias("_times"),
        F.col("regressors").alias("_use"),
    )
    scale = F.when(F.col("_absmax") > 0, F.col("_absmax")).otherwise(1.0)
    joined = lookup_join(extent, chosen, ["series_id"], "inner").where("_days >= 2")
    return joined.withColumn("_scale", scale).drop("_absmax", "_days")


def _triangle(stacked: np.ndarray, size: int) -> np.ndarray:
    """The R of a QR of the rows, padded to ``size`` x ``size``; its sign is free."""
    found = np.linalg.qr(stacked, mode="r") if len(stacked) else np.zeros((0, size))
    out = np.zeros((size, size))
    out[: min(size, found.shape[0])] = found[:size]
    return out


def gram_partials(frame: DataFrame, terms: Sequence[Column], penalty: Column, width: int) -> DataFrame:
    """Mergeable partials of a least-squares problem: a triangular factor of [X | y], packed.

    Input: ``series_id, ds, _n, _y, _yy`` and what ``terms`` (the ``width`` columns of X) and
    ``penalty`` are made of. Rows of a series are brought together in blocks of days, so a
    long one is factored by several tasks and an ordinary one sends a single partial row on.
    Each block sends R of the QR of sqrt(n) * [x, mean y] (its upper triangle), the scatter of
    y within days (sum of squares about the day's mean) and n. Factors of blocks are stacked
    and factored again, so no sum of squares is subtracted from another: the residual keeps
    its digits even where the fit is nearly exact. The wide arrays are built behind that
    shuffle, which moves a few numbers a day.
    """
    block = F.floor(_day(F.col("ds")) / BLOCK_DAYS)
    placed = frame.withColumn("_block", block).repartition("series_id", "_block")
    placed = placed.sortWithinPartitions("series_id", "_block").select(
        "series_id", "_block", F.array(*terms).alias("_x"), "_n", "_y", "_yy", penalty.alias("_penalty")
    )
    size = width + 1
    upper = np.triu_indices(size)

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for (series_id, _), part in batch.groupby(["series_id", "_block"], sort=False):
                x = np.stack(part["_x"].to_numpy())
                n = part["_n"].to_numpy(dtype=float)
                y = part["_y"].to_numpy(dtype=float)
                root = np.sqrt(n)[:, None]
                factor = _triangle(np.hstack([x * root, y[:, None] * root]), size)
                scatter = np.maximum(part["_yy"].to_numpy(dtype=float) - n * y * y, 0.0).sum()
                out.append((series_id, factor[upper], float(scatter), float(n.sum()), part["_penalty"].iloc[0]))
            yield pd.DataFrame(out, columns=["series_id", "r", "scatter", "n", "penalty"])

    return placed.mapInPandas(
        partials,
        "series_id string, r array<double>, scatter double, n double, penalty array<double>",
    )


# Steps of the bisection of the noise: each halves a bracket of at most 60 octaves.
NOISE_STEPS = 200
NOISE_FLOOR = 1e-8
NOISE_START = 0.01


def ridge_noise(a: np.ndarray, b: np.ndarray, rest: float, n: float, penalty: np.ndarray) -> tuple[np.ndarray, float]:
    """beta and noise of min ||a beta - b||^2 + noise * beta' diag(penalty) beta, with noise = RSS / n.

    One singular value decomposition of a diag(penalty)^-1/2 turns the residual into a sum of
    non-negative terms for any noise; the fixed point noise = max(RSS(noise) / n, floor) is then
    a root of one scalar function, bracketed from the start value towards the side the fixed
    point iteration would go (RSS grows with the noise and is bounded by y'y), and bisected in a
    fixed number of steps. ``rest`` is the part of RSS that no beta reaches.
    """
    inv_root = 1.0 / np.sqrt(penalty)
    u, sv, vt = np.linalg.svd(a * inv_root[None, :], full_matrices=False)
    proj = u.T @ b
    outside = max(float(b @ b - proj @ proj), 0.0) if u.shape[0] > u.shape[1] else 0.0
    sq = sv * sv

    def noise_of(noise: float) -> float:
        shrink = noise / (sq + noise)
        return max((float(np.sum((shrink * proj) ** 2)) + outside + rest) / n, NOISE_FLOOR)

    lo = hi = NOISE_START
    if noise_of(NOISE_START) > NOISE_START:
        hi = max((float(proj @ proj) + outside + rest) / n, NOISE_START)
    else:
        lo = NOISE_FLOOR
    for _ in range(NOISE_STEPS):
        if hi <= lo * (1 + 1e-15):
            break
        mid = math.sqrt(lo * hi)
        if noise_of(mid) > mid:
            lo = mid
        else:
            hi = mid
    noise = math.sqrt(lo * hi)
    if lo == NOISE_FLOOR and noise_of(NOISE_FLOOR) <= NOISE_FLOOR:
        noise = NOISE_FLOOR
    beta = inv_root * (vt.T @ (sv / (sq + noise) * proj))
    return beta, noise


def solve_ridge(partials: DataFrame, width: int, regressors: int) -> DataFrame:
    """``series_id, beta``: the factors of a series' blocks merged, then one small solve.

    The last ``regressors`` columns are standardised for the penalty unless they are 0/1.
    The noise variance that weighs the penalty is the fixed point of the residual (``ridge_noise``).
    """
    size = width + 1
    upper = np.triu_indices(size)

    def solve(parts: pd.DataFrame) -> pd.DataFrame:
        stacked = np.zeros((len(parts) * size, size))
        for k, packed in enumerate(parts["r"]):
            stacked[k * size : (k + 1) * size][upper] = packed
        r = _triangle(stacked, size)
        r11, r12, r22 = r[:width, :width], r[:width, width], r[width, width]
        n = parts["n"].sum()
        penalty = np.asarray(parts["penalty"].iloc[0])
        gram = r11.T @ r11
        scaling = np.eye(width)
        for j in range(width - regressors, width):
            # the first column is 1, or the trend that multiplies the others
            mean, second = gram[0, j] / gram[0, 0], gram[j, j] / gram[0, 0]
            spread = second - mean * mean
            if spread > 1e-12 and abs(second - mean) > 1e-12:
                scaling[j, j] = 1.0 / math.sqrt(spread)
                scaling[0, j] = -mean * scaling[j, j]
        beta, _ = ridge_noise(r11 @ scaling, r12, float(r22 * r22 + parts["scatter"].sum()), n, penalty)
        return pd.DataFrame({"series_id": [parts["series_id"].iloc[0]], "beta": [scaling @ beta]})

    return partials.groupBy("series_id").applyInPandas(solve, "series_id string, beta array<double>")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def fit_additive(folded: DataFrame, setup: DataFrame, regressors: Sequence[str]) -> DataFrame:
    """``series_id, trend_beta, season_beta`` of every series.

    Additive series are fitted in one piece. Multiplicative ones in two: the trend first,
    then the relative rest on the seasonal terms.
    """
    count = len(regressors)
    rows = lookup_join(folded, setup, ["series_id"], "inner", F.col("ds"))
    trend_pen, season_pen = _penalties(regressors)
    rows = rows.withColumn("_y", F.col("_y") / F.col("_scale")).withColumn(
        "_yy", F.col("_yy") / (F.col("_scale") * F.col("_scale"))
    )
    width = TREND_WIDTH + SEASON_WIDTH + count
    terms = [*_trend_terms(), *_season_terms(regressors)]
    whole = gram_partials(rows.where("not _times"), terms, F.concat(trend_pen, season_pen), width)
    additive = solve_ridge(whole, width, count).select(
        "series_id",
        F.slice("beta", 1, TREND_WIDTH).alias("trend_beta"),
        F.concat(
            F.array(F.lit(0.0)), F.slice("beta", TREND_WIDTH + 1, SEASON_WIDTH + count)
        ).alias("season_beta"),
    )

    times = rows.where("_times")
    first = gram_partials(times, _trend_terms(), trend_pen, TREND_WIDTH)
    trend = solve_ridge(first, TREND_WIDTH, 0).withColumnRenamed("beta", "trend_beta")
    # y = trend * (1 + season): least squares of y - trend on trend * terms, so that a day on
    # which the trend is near zero weighs little and none is left out
    line = _dot(F.array(*_trend_terms()), F.col("trend_beta"))
    rest = (
        lookup_join(times, trend, ["series_id"], "inner", F.col("ds"))
        .withColumn("_line", line)
        .drop("trend_beta")
        .withColumn("_yy", F.col("_yy") + F.col("_n") * F.col("_line") * (F.col("_line") - 2 * F.col("_y")))
        .withColumn("_y", F.col("_y") - F.col("_line"))
    )
    season_width = 1 + SEASON_WIDTH + count
    weighted = [F.col("_line") * term for term in [F.lit(1.0), *_season_terms(regressors)]]
    season_pen = F.concat(F.array(F.lit(1.0 / TREND_PRIOR**2)), season_pen)
    season = solve_ridge(gram_partials(rest, weighted, season_pen, season_width), season_width, count)
    multiplicative = trend.join(season.withColumnRenamed("beta", "season_beta"), "series_id")
    return additive.unionByName(multiplicative)


def fit_predict_additive(
    rows: DataFrame, spine: DataFrame, params: DataFrame, regressors: Sequence[str]
) -> DataFrame:
    """``yhat`` of the spine's days; both frames carry the regressor columns."""
    folded = stage(fold_days(rows, regressors), "folded")
    setup = stage(_series_setup(folded, params), "setup")
    model = setup.join(fit_additive(folded, setup, regressors), "series_id")
    days = lookup_join(spine, model, ["series_id"], "inner", F.col("ds"))
    trend = _dot(F.array(*_trend_terms()), F.col("trend_beta"))
    season = _dot(F.array(F.lit(1.0), *_season_terms(regressors)), F.col("season_beta"))
    scaled = F.when(F.col("_times"), F.col("_trend") * (1 + F.col("_season"))).otherwise(
        F.col("_trend") + F.col("_season")
    )
    return (
        days.withColumn("_trend", trend)
        .withColumn("_season", season)
        .withColumn("yhat", F.col("_scale") * scaled)
        .select(*spine.columns, "yhat")
    )


def fit_predict(
    rows: DataFrame,
    spine: DataFrame,
    model: str = "trend_dow",
    params: DataFrame | None = None,
    regressors: Sequence[str] = (),
) -> DataFrame:
    """Fit every series of ``rows`` and add ``yhat`` to the days of ``spine``.

    The additive model leaves out series that miss a regressor they use on any day of either
    frame: a gap is no zero.
    """
    if model == "trend_dow":
        return predict_trend_dow(spine, fit_trend_dow(rows))
    if model != "additive":
        raise ValueError("model must be trend_dow or additive")
    if params is None:
        raise ValueError("the additive model needs params")
    if regressors:
        days = rows.select("series_id", *regressors).unionByName(spine.select("series_id", *regressors))
        gaps = stage(regressor_gaps(days, params, regressors), "gaps")
        rows = lookup_join(rows, gaps, ["series_id"], "left_anti", F.col("ds"))
    return fit_predict_additive(rows, spine, params, regressors)


def regressor_gaps(frame: DataFrame, params: DataFrame, regressors: Sequence[str]) -> DataFrame:
    """Series with a day on which a regressor they use is missing."""
    used = params.select(F.col("request_id").alias("series_id"), F.col("regressors").alias("_use"))
    missing = F.lit(False)
    for name in regressors:
        missing = missing | (F.array_contains("_use", name) & F.col(name).isNull())
    return (
        lookup_join(frame, used, ["series_id"], "inner")
        .where(missing)
        .select("series_id")
        .distinct()
    )


# Buckets a range of values is cut into per round, and the count at which a range's values are
# ranked one by one.
MEDIAN_BUCKETS = 256
MEDIAN_EXACT = 64
MEDIAN_ROUNDS = 200


def weighted_median(values: DataFrame, key: str = "series_id", value: str = "_ape", weight: str = "_n") -> DataFrame:
    """``key, median`` of weighted values, for many keys at once and without a key in one task.

    The median is Spark's exact percentile 0.5: position p = (N - 1) / 2 over the weights, the
    values at ranks floor(p) and ceil(p) weighed by their distance to p. Both ranks are found by
    selection: a key's range of finite values is cut into ``MEDIAN_BUCKETS`` buckets, the weights
    per bucket are counted (an aggregation with partial sums, a few rows per key), and the
    range narrows to the bucket that holds the rank, round by round, until its values are equal
    or at most ``MEDIAN_EXACT`` rows, which are ranked one by one. Infinity, then NaN, rank
    above every finite value. Rows with a null value or weight do not count. Where no key has
    more than ``MEDIAN_EXACT`` rows, the percentile aggregate gives the same in one step.
    """
    rows = values.select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v"), F.col(weight).cast("long").alias("_w"))
    rows = rows.where("_v IS NOT NULL AND _w IS NOT NULL AND _w > 0")
    # where no key has more than MEDIAN_EXACT rows, Spark's percentile holds as few values a group
    widest = rows.groupBy("_k").count().agg(F.max("count")).first()[0] or 0
    if widest <= MEDIAN_EXACT:
        return rows.groupBy("_k").agg(F.percentile("_v", 0.5, F.col("_w")).alias("median")).withColumnRenamed("_k", key)
    finite = F.col("_v") < F.lit(float("inf"))
    totals = rows.groupBy("_k").agg(
        F.sum("_w").alias("_all"),
        F.sum(F.when(finite, F.col("_w")).otherwise(0)).alias("_fin"),
        F.sum(F.when(F.col("_v") == float("inf"), F.col("_w")).otherwise(0)).alias("_inf"),
        F.min(F.when(finite, F.col("_v"))).alias("_lo"),
        F.max(F.when(finite, F.col("_v"))).alias("_hi"),
    )
    position = (F.col("_all") - 1) / 2
    targets = totals.select(
        "*", F.explode(F.array(F.floor(position), F.ceil(position))).alias("_rank")
    ).dropDuplicates(["_k", "_rank"])
    top = F.when(F.col("_rank") < F.col("_fin") + F.col("_inf"), F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    state = stage(
        targets.select(
            "_k", "_rank", F.col("_rank").alias("_r"), "_lo", "_hi", F.col("_fin").alias("_c"),
            F.when(F.col("_rank") >= F.col("_fin"), top).alias("_value"),
        ),
        "median-state",
    )
    finite_rows = rows.where(finite)
    for _ in range(MEDIAN_ROUNDS):
        active = state.where("_value IS NULL")
        if active.isEmpty():
            break
        inside = lookup_join(finite_rows, active.select("_k", "_rank", "_r", "_lo", "_hi", "_c"), ["_k"], "inner", F.col("_v"))
        inside = inside.where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        width = F.col("_hi") - F.col("_lo")
        bucket = F.least(F.lit(MEDIAN_BUCKETS - 1.0), F.floor((F.col("_v") - F.col("_lo")) / width * MEDIAN_BUCKETS).cast("double"))
        # few rows left: each value is its own bucket
        group = F.when((F.col("_c") <= MEDIAN_EXACT) | (width <= 0), F.col("_v")).otherwise(bucket)
        counted = inside.groupBy("_k", "_rank", "_r", group.alias("_g")).agg(
            F.sum("_w").alias("_cnt"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
        )
        upto = Window.partitionBy("_k", "_rank").orderBy("_g").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = counted.withColumn("_cum", F.sum("_cnt").over(upto))
        chosen = counted.where((F.col("_cum") - F.col("_cnt") <= F.col("_r")) & (F.col("_r") < F.col("_cum"))).select(
            "_k", "_rank", (F.col("_r") - (F.col("_cum") - F.col("_cnt"))).alias("_r"),
            F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), F.col("_cnt").alias("_c"),
            F.when(F.col("_min") == F.col("_max"), F.col("_min")).alias("_value"),
        )
        state = stage(state.where("_value IS NOT NULL").unionByName(chosen), "median-state")
    ranks = state.groupBy("_k").agg(
        F.min_by("_value", "_rank").alias("_low"), F.max_by("_value", "_rank").alias("_high"),
        F.min("_rank").alias("_a"), F.max("_rank").alias("_b"),
    )
    joined = ranks.join(totals.select("_k", "_all"), "_k")
    p = (F.col("_all") - 1) / 2
    median = F.when(F.col("_a") == F.col("_b"), F.col("_low")).otherwise(
        (F.col("_b") - p) * F.col("_low") + (p - F.col("_a")) * F.col("_high")
    )
    return joined.select(F.col("_k").alias(key), median.alias("median"))


def backtest(
    frame: DataFrame,
    params: DataFrame,
    model: str = "trend_dow",
    regressors: Sequence[str] = (),
) -> DataFrame:
    """``series_id, n_test, mape, mdape, error_rate, status`` of the fold after the cutoff.

    ``frame`` is a ``history_frame`` (with regressors for the additive model). The fit sees
    the days up to the cutoff and is tried on the 30 after it. MAPE is withheld where a
    fact is near zero and the median takes its place. A series that asked for no back-test
    has -1, one without history -3.14. Statuses: ``ok``, ``not_requested``, ``no_data`` and
    ``no_fold``, where the days up to the cutoff or after it do not suffice (no rate).
    """
    asked = params.select(
        F.col("request_id").alias("series_id"), F.col("error_output").alias("_asked")
    )
    rows = lookup_join(frame, asked.where("_asked"), ["series_id"], "inner", F.col("ds"))
    train = rows.where(F.col("ds") <= F.col("cutoff"))
    in_fold = (F.col("ds") > F.col("cutoff")) & (
        F.col("ds") <= F.date_add("cutoff", S.FOLD_DAYS)
    )
    test = rows.where(in_fold & _known(F.col("y"))).select("series_id", "ds", "y", *regressors)
    tried = fit_predict(train, test, model, params, regressors)
    ape = F.abs((F.col("y") - F.col("yhat")) / F.when(F.col("y") != 0, F.col("y")))
    # equal errors are counted before the rows of a series meet
    per_error = tried.groupBy(
        "series_id", F.coalesce(ape, F.lit(float("inf"))).alias("_ape")
    ).agg(F.count(F.lit(1)).alias("_n"), F.min(F.abs("y")).alias("_least"))
    per_error = stage(per_error, "errors")
    errors = per_error.groupBy("series_id").agg(
        F.sum("_n").alias("n_test"),
        F.min("_least").alias("_least"),
        (F.sum(F.col("_ape") * F.col("_n")) / F.sum("_n")).alias("_mean"),
    )
    errors = errors.join(weighted_median(per_error).withColumnRenamed("median", "mdape"), "series_id", "left")
    measured = errors.withColumn("mape", F.when(F.col("_least") >= MIN_FACT, F.col("_mean")))
    alive = frame.select("series_id").distinct().withColumn("_alive", F.lit(True))
    joined = lookup_join(lookup_join(asked, alive, ["series_id"]), measured, ["series_id"])
    rate = (
        F.when(F.col("_alive").isNull(), F.lit(S.NO_DATA))
        .when(~F.col("_asked"), F.lit(S.NOT_REQUESTED))
        .otherwise(F.coalesce("mape", "mdape"))
    )
    status = (
        F.when(F.col("_alive").isNull(), "no_data")
        .when(~F.col("_asked"), "not_requested")
        .when(F.col("n_test").isNull(), "no_fold")
        .otherwise("ok")
    )
    return joined.select(
        "series_id", F.coalesce("n_test", F.lit(0)).alias("n_test"), "mape", "mdape",
        rate.alias("error_rate"), status.alias("status"),
    )


def forecast_summary(
    params: DataFrame,
    extent: DataFrame,
    errors: DataFrame,
    gaps: DataFrame,
    run_ts: str,
    failed: DataFrame | None = None,
) -> DataFrame:
    """One row of facts per request: status, error rate, parameters, size, session.

    Statuses: ``ok``, ``no_data``, ``sql_error``, ``too_short`` (fewer than two days with a
    fact), ``regressor_gap``.
    """
    facts = params.select(
        F.col("request_id").alias("series_id"), "is_special", "regressors", "forecasting_period"
    )
    texts = S.parameter_map(params).select(F.col("request_id").alias("series_id"), "parameters")
    facts = lookup_join(facts, texts, ["series_id"])
    facts = lookup_join(facts, extent.select("series_id", "n_rows", "n_days", "n_columns"), ["series_id"])
    facts = lookup_join(facts, errors.select("series_id", "error_rate"), ["series_id"])
    facts = lookup_join(facts, gaps.withColumn("_gap", F.lit(True)), ["series_id"])
    if failed is None:
        facts = facts.withColumn("_failed", F.lit(None).cast("boolean"))
    else:
        bad = failed.select("series_id").distinct().withColumn("_failed", F.lit(True))
        facts = lookup_join(facts, bad, ["series_id"])
    status = (
        F.when(F.col("_failed"), "sql_error")
        .when(F.col("n_rows").isNull(), "no_data")
        .when(F.col("n_days") < 2, "too_short")
        .when(F.col("_gap"), "regressor_gap")
        .otherwise("ok")
    )
    no_fit = F.col("status").isin("no_data", "sql_error")
    return facts.withColumn("status", status).select(
        "series_id",
        "status",
        F.when(no_fit, F.lit(S.NO_DATA)).otherwise(F.col("error_rate")).alias("error_rate"),
        "is_special",
        "parameters",
        "regressors",
        "forecasting_period",
        "n_rows",
        "n_columns",
        S.session_id(F.lit(run_ts)).alias("session_id"),
    )


def forecast(
    requests: DataFrame,
    history: DataFrame,
    hyper: DataFrame,
    calendar: DataFrame,
    as_of: datetime.date,
    run_ts: str,
    model: str = "additive",
    failed: DataFrame | None = None,
    key: str = "forecastMarker",
) -> tuple[DataFrame, DataFrame]:
    """Forecast rows ``series_id, ds, y, yhat, iliPlanIliFact`` and one summary row per
    request; ``series_id`` is the request (see ``forecast_params``), in ``history`` it is ``key``. Series with a regressor gap or fewer than two known days have no forecast rows."""
    params = stage(S.forecast_params(requests, hyper), "params")
    names = S.calendar_columns(calendar) if model == "additive" else []
    rows = stage(S.history_rows(history.select("series_id", "ds", "y"), params, key), "rows")
    extent = stage(S.history_extent(rows, params, as_of), "extent")
    spine = S.future_spine(rows, params)
    full_rows, full_spine = rows, spine
    if names:
        full_rows = S.add_regressors(rows, calendar, names)
        full_spine = S.add_regressors(spine, calendar, names)
    # every history day is on the spine, so a gap shows there
    gaps = stage(regressor_gaps(full_spine, params, names), "gaps")
    long_enough = extent.where("n_days >= 2").select("series_id", "cutoff")
    good = lookup_join(full_rows, long_enough, ["series_id"], "inner", F.col("ds"))
    if names:
        good = lookup_join(good, gaps, ["series_id"], "left_anti", F.col("ds"))
    predicted = fit_predict(good, full_spine, model, params, names)
    result = S.plan_fact(predicted, rows)
    errors = backtest(good, params, model, names)
    return result, forecast_summary(params, extent, errors, gaps, run_ts, failed)
