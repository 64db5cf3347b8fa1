"""Monthly demand forecasts per key.

A key's history is one short array (one element per observed month), so every
key is a row and the work spreads over keys whatever their order volume is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.config import DEFAULTS, Settings
from stocklens.functions.scalar import KEYS, half_even, month_start, num_round, year_month
from stocklens.functions.smoothing import fit_column
from stocklens.operators.ordered import exact_quantiles
from stocklens.sources.scratch import materialize


def monthly_demand(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Units per key and observed month; months without sales are absent."""
    return sales.groupBy(*keys, month_start("transaction_date").alias("month")).agg(F.sum("qty_sold").alias("qty_sold"))


def monthly_series(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """keys, y (array in month order), last_month."""
    monthly = monthly_demand(sales, keys)
    points = F.array_sort(F.collect_list(F.struct("month", "qty_sold")))
    return monthly.groupBy(*keys).agg(points.alias("_p"), F.max("month").alias("last_month")).select(
        *keys, "last_month", F.transform(F.col("_p.qty_sold"), lambda v: v.cast("double")).alias("y")
    )


def eligible_series(
    sales: DataFrame,
    keys: Sequence[str] = KEYS,
    min_months: int = DEFAULTS.min_history_months,
    holdout: int = DEFAULTS.holdout_months,
) -> DataFrame:
    """Series long enough to forecast, split into train and test; all-zero training is skipped."""
    split = monthly_series(sales, keys).where(F.size("y") >= min_months).select(
        "*",
        F.slice("y", F.lit(1), F.size("y") - holdout).alias("train"),
        F.slice("y", F.size("y") - holdout + 1, F.lit(holdout)).alias("test"),
    )
    return split.where(_fold(F.col("train"), lambda v: v) != 0)


def split_holdout(sales: DataFrame, keys: Sequence[str] = KEYS, holdout: int = DEFAULTS.holdout_months) -> DataFrame:
    """Long form: every observed month of a key tagged train or test."""
    series = monthly_series(sales, keys)
    first_test = F.size("y") - holdout
    return series.select(*keys, first_test.alias("_cut"), F.posexplode("y").alias("position", "qty")).select(
        *keys, "position", "qty", F.when(F.col("position") >= F.col("_cut"), "test").otherwise("train").alias("part")
    )


def _fold(values: Column, f) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + f(v))


def seasonal_naive(y: Column, horizon: int, season: int = DEFAULTS.season_months) -> Column:
    """The last ``season`` values (or the whole shorter series) repeated over the horizon."""
    last = F.slice(y, F.greatest(F.size(y) - season + 1, F.lit(1)), F.lit(season))
    return F.transform(
        F.sequence(F.lit(0), F.lit(horizon - 1)),
        lambda i: F.element_at(last, (i % F.size(last) + 1).cast("int")),
    )


def mape_of(test: Column, predicted: Column) -> Column:
    """Mean absolute percentage error of two arrays over positive actuals; null if none."""
    pairs = F.filter(F.arrays_zip(test.alias("a"), predicted.alias("p")), lambda z: z["a"] > 0)
    total = _fold(F.transform(pairs, lambda z: F.abs((z["a"] - z["p"]) / z["a"])), lambda v: v)
    return F.when(F.size(pairs) > 0, total / F.size(pairs) * 100.0)


def rmse_of(test: Column, predicted: Column) -> Column:
    gaps = F.zip_with(test, predicted, lambda a, p: (a - p) * (a - p))
    return F.sqrt(_fold(gaps, lambda v: v) / F.size(test))


def _positive(values: Column) -> Column:
    return F.transform(values, lambda v: F.greatest(v, F.lit(0.0)))


def _flatten(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and future month."""
    zipped = F.arrays_zip("fc", "lower", "upper")
    rows = df.select(*keys, "last_month", "model_used", "mape", "rmse", F.posexplode(zipped).alias("step", "v"))
    date = F.add_months("last_month", F.col("step") + 1)
    return rows.select(
        date.alias("forecast_date"),
        year_month(date).alias("year_month"),
        *keys,
        num_round(F.greatest("v.fc", F.lit(0.0)), 2).alias("forecast_qty"),
        num_round(F.greatest("v.lower", F.lit(0.0)), 2).alias("forecast_lower"),
        num_round("v.upper", 2).alias("forecast_upper"),
        "model_used",
        num_round("mape", 2).alias("mape"),
        num_round("rmse", 2).alias("rmse"),
    )


def naive_forecast(
    sales: DataFrame, keys: Sequence[str] = KEYS, horizon: int = DEFAULTS.horizon_months, s: Settings = DEFAULTS
) -> DataFrame:
    """Seasonal naive for every series, evaluated on the hold-out; no Python involved."""
    series = eligible_series(sales, keys, s.min_history_months, s.holdout_months)
    check = seasonal_naive(F.col("train"), s.holdout_months)
    fc = seasonal_naive(F.col("y"), horizon)
    done = series.select(
        *keys,
        "last_month",
        fc.alias("fc"),
        F.transform(fc, lambda v: v * 0.0).alias("lower"),
        F.transform(fc, lambda v: v * 2.0).alias("upper"),
        F.lit("SEASONAL_NAIVE").alias("model_used"),
        mape_of(F.col("test"), check).alias("mape"),
        rmse_of(F.col("test"), check).alias("rmse"),
    )
    return _flatten(done, keys)


def _candidates(df: DataFrame, values: str, horizon: int, prefix: str) -> DataFrame:
    """Fits of one array column as {prefix}_{ets,ar}_{fc,lower,upper}.

    Where a series is too short for a model its slot falls back: the
    autoregression to smoothing, smoothing to the seasonal naive.
    """
    y = F.col(values)
    fitted = df.withColumn("_fit", fit_column(y, horizon))
    mean = _fold(y, lambda v: v) / F.size(y)
    spread = F.sqrt(_fold(F.transform(y, lambda v: (v - mean) * (v - mean)), lambda v: v) / F.size(y)) * 1.28
    naive = seasonal_naive(y, horizon)
    ets, ar, half = F.col("_fit.ets"), F.col("_fit.ar"), F.col("_fit.ar_half")
    ets_fc = F.when(ets.isNotNull(), _positive(ets)).otherwise(naive)
    ets_lo = F.when(ets.isNotNull(), _positive(F.transform(ets, lambda v: v - spread))).otherwise(
        F.transform(naive, lambda v: v * 0.0)
    )
    ets_up = F.when(ets.isNotNull(), F.transform(ets, lambda v: v + spread)).otherwise(
        F.transform(naive, lambda v: v * 2.0)
    )
    return fitted.select(
        *df.columns,
        ets_fc.alias(f"{prefix}_ets_fc"),
        ets_lo.alias(f"{prefix}_ets_lower"),
        F.zip_with(ets_up, ets_fc, lambda u, f: F.greatest(u, f)).alias(f"{prefix}_ets_upper"),
        F.coalesce(_positive(ar), ets_fc).alias(f"{prefix}_ar_fc"),
        F.coalesce(_positive(F.zip_with(ar, half, lambda v, h: v - h)), ets_lo).alias(f"{prefix}_ar_lower"),
        F.coalesce(_positive(F.zip_with(ar, half, lambda v, h: v + h)), ets_up).alias(f"{prefix}_ar_upper"),
    )


def _evaluated(
    sales: DataFrame, keys: Sequence[str], s: Settings
) -> DataFrame:
    """Series with hold-out fits and the chosen model.

    Rule: with 24 training months the autoregression goes first, and smoothing
    replaces it when its error is above 30 % and smoothing does better; shorter
    histories use smoothing.
    """
    base = eligible_series(sales, keys, s.min_history_months, s.holdout_months)
    tried = _candidates(base, "train", s.holdout_months, "h").select(
        "*",
        mape_of(F.col("test"), F.col("h_ets_fc")).alias("_mape_ets"),
        mape_of(F.col("test"), F.col("h_ar_fc")).alias("_mape_ar"),
        (F.size("train") >= 2 * s.season_months).alias("_long"),
    )
    retry = (F.col("_mape_ar") > s.mape_retry_pct) & (F.col("_mape_ets") < F.col("_mape_ar"))
    ar_wins = F.col("_long") & ~F.coalesce(retry, F.lit(False))
    pick = lambda name: F.when(ar_wins, F.col(f"h_ar_{name}")).otherwise(F.col(f"h_ets_{name}"))
    return tried.select(
        *keys, "last_month", "y", "test",
        F.when(ar_wins, "SEASONAL_AR").otherwise("ETS").alias("model_used"),
        F.when(ar_wins, F.col("_mape_ar")).otherwise(F.col("_mape_ets")).alias("mape"),
        rmse_of(F.col("test"), pick("fc")).alias("rmse"),
        pick("fc").alias("h_fc"), pick("lower").alias("h_lower"), pick("upper").alias("h_upper"),
    )


def forecast(
    sales: DataFrame, keys: Sequence[str] = KEYS, horizon: int = DEFAULTS.horizon_months, s: Settings = DEFAULTS
) -> DataFrame:
    """Model choice on the hold-out, refit on the full series, one row per future month."""
    chosen = _evaluated(sales, keys, s)
    final = _candidates(chosen, "y", horizon, "f")
    ar = F.col("model_used") == "SEASONAL_AR"
    pick = lambda name: F.when(ar, F.col(f"f_ar_{name}")).otherwise(F.col(f"f_ets_{name}")).alias(name)
    return _flatten(final.select(*keys, "last_month", "model_used", "mape", "rmse", pick("fc"), pick("lower"), pick("upper")), keys)


def holdout_comparison(sales: DataFrame, keys: Sequence[str] = KEYS, s: Settings = DEFAULTS) -> DataFrame:
    """Actual, forecast and interval for every hold-out month."""
    done = _evaluated(sales, keys, s)
    zipped = F.arrays_zip(F.col("test").alias("actual"), F.col("h_fc").alias("fc"), F.col("h_lower").alias("lo"), F.col("h_upper").alias("up"))
    rows = done.select(*keys, "last_month", "model_used", F.posexplode(zipped).alias("step", "v"))
    return rows.select(
        *keys, "model_used", F.col("step").alias("holdout_step"),
        F.col("v.actual").alias("actual_qty"),
        num_round("v.fc", 2).alias("forecast_qty"),
        num_round("v.lo", 2).alias("forecast_lower"),
        num_round("v.up", 2).alias("forecast_upper"),
    )


def accuracy_summary(forecasts: DataFrame) -> DataFrame:
    """Error statistics per model over forecast rows.

    The forecasts are computed once, into a (model, error) histogram that all the
    statistics, the exact median included, are read from.
    """
    counts = materialize(forecasts.groupBy("model_used", "mape").agg(F.count(F.lit(1)).alias("n")), "accuracy")
    scored = F.when(F.col("mape").isNotNull(), F.col("n"))
    below = lambda limit: F.sum(F.when(F.col("mape") < limit, F.col("n")).otherwise(0)) / F.sum("n") * 100
    rows = counts.groupBy("model_used").agg(
        F.coalesce(F.sum(scored), F.lit(0)).alias("count"),
        (F.sum(F.col("mape") * F.col("n")) / F.sum(scored)).alias("mean"),
        below(15).alias("u15"),
        below(25).alias("u25"),
    )
    median = exact_quantiles(counts, ["model_used"], "mape", {"median": 0.5}, weight="n")
    return rows.join(median, "model_used", "left").select(
        "model_used", "count",
        half_even("median", 2).alias("median_mape"),
        half_even("mean", 2).alias("mean_mape"),
        half_even("u15", 2).alias("pct_under_15"),
        half_even("u25", 2).alias("pct_under_25"),
    )
