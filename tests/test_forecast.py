import datetime as dt
import math
import random

import numpy as np
import pytest

from stocklens.functions.smoothing import fit_weights, holt_winters, seasonal_ar
from stocklens.operators import forecast as fc


def month(i):
    return dt.date(2020 + i // 12, i % 12 + 1, 15)


def sales(spark, series):
    rows = [(month(i), k, 1, int(v)) for k, values in series.items() for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "transaction_date DATE, part_id INT, dealer_id INT, qty_sold INT")


def seasonal(n, noise=0, seed=0):
    rng = random.Random(seed)
    return [100 + 2 * i + 30 * math.sin(2 * math.pi * i / 12) + rng.gauss(0, noise) for i in range(n)]


def test_naive_repeats_the_last_year(spark):
    series = {1: list(range(1, 31)), 2: list(range(1, 12)), 3: [0] * 14, 4: list(range(1, 13))}
    rows = fc.naive_forecast(sales(spark, series)).orderBy("part_id", "forecast_date").collect()
    assert {r["part_id"] for r in rows} == {1, 4}  # 2 is too short, 3 has no demand
    first = [r for r in rows if r["part_id"] == 1]
    assert [r["forecast_qty"] for r in first] == [19, 20, 21, 22, 23, 24]
    assert [str(r["forecast_date"]) for r in first][:2] == ["2022-07-01", "2022-08-01"] and first[0]["year_month"] == "2022-07"
    # hold-out 28, 29, 30 against 16, 17, 18
    assert first[0]["mape"] == round(100 * np.mean([12 / 28, 12 / 29, 12 / 30]), 2) and first[0]["rmse"] == 12.0
    assert all(r["forecast_lower"] == 0 and r["forecast_upper"] == 2 * r["forecast_qty"] for r in rows)
    # twelve months: nine train, so the hold-out repeats values 1, 2, 3
    assert [r for r in rows if r["part_id"] == 4][0]["mape"] == round(100 * np.mean([9 / 10, 9 / 11, 9 / 12]), 2)


def test_gaps_are_not_filled(spark):
    values = [10] * 6 + [None] * 4 + [20] * 8
    series = fc.monthly_series(sales(spark, {1: values})).first()
    assert series["y"] == [10.0] * 6 + [20.0] * 8
    parts = fc.split_holdout(sales(spark, {1: values})).collect()
    assert [r["position"] for r in parts if r["part"] == "test"] == [11, 12, 13]


def test_mape_is_null_without_positive_actuals(spark):
    row = fc.naive_forecast(sales(spark, {1: [5] * 12 + [0, 0, 0]})).first()
    assert row["mape"] is None and row["rmse"] == 5.0


def test_smoothing_follows_trend_and_season():
    y = np.array([seasonal(60)])
    truth = np.array(seasonal(66))[60:]
    got = holt_winters(y, np.array([60]), 6, True)[0]
    assert np.abs(got - truth).max() < 12
    line = holt_winters(np.array([[float(i) for i in range(14)]]), np.array([14]), 3, False)[0]
    assert np.allclose(line, [14, 15, 16])


@pytest.mark.parametrize("seasonal_", [True, False])
def test_fitted_weights_are_never_worse_than_the_grid(seasonal_):
    rng = np.random.default_rng(7)
    n = rng.integers(24, 61, 40)
    y = np.where(np.arange(60)[None, :] < n[:, None], rng.gamma(2.0, 20.0, (40, 60)) + 10 * np.sin(np.arange(60) / 2), 0.0)
    theta, error, of_grid = fit_weights(y, n, seasonal_)
    assert (error <= of_grid).all() and (error < of_grid * 0.999).mean() > 0.5
    assert (theta[:, :3] >= 0).all() and (theta[:, :3] <= 1).all() and (seasonal_ or (theta[:, 2] == 0).all())


def test_ragged_batch_equals_single_series():
    a, b = seasonal(60, 5, 1), seasonal(40, 5, 2)
    padded, n = np.zeros((2, 60)), np.array([60, 40])
    padded[0], padded[1, :40] = a, b
    for i, values in enumerate((a, b)):
        alone, m = np.array([values]), np.array([len(values)])
        assert np.allclose(holt_winters(padded, n, 6, True)[i], holt_winters(alone, m, 6, True)[0])
        for whole, single in zip(seasonal_ar(padded, n, 6), seasonal_ar(alone, m, 6)):
            assert np.allclose(whole[i], single[0])


def test_autoregression_is_exact_on_a_deterministic_season():
    y = np.array([seasonal(48)])
    pred, half = seasonal_ar(y, np.array([48]), 6)
    assert np.allclose(pred[0], np.array(seasonal(54))[48:], atol=1e-6) and half[0].max() < 1e-6


def test_model_choice_and_bounds(spark):
    series = {1: seasonal(60, 3, 1), 2: seasonal(20, 3, 2), 3: [random.Random(4).choice([1, 90]) for _ in range(50)], 4: seasonal(26, 3, 3)}
    df = sales(spark, series)
    rows = fc.forecast(df).collect()
    model = {r["part_id"]: r["model_used"] for r in rows}
    assert model[1] == "SEASONAL_AR" and model[2] == "ETS" and model[4] == "ETS"  # 23 training months
    assert all(0 <= r["forecast_lower"] <= r["forecast_qty"] <= r["forecast_upper"] for r in rows)
    assert all(sum(1 for r in rows if r["part_id"] == k) == 6 for k in series)
    compare = fc.holdout_comparison(df).collect()
    assert len(compare) == 12
    good = [r for r in compare if r["part_id"] == 1]
    assert np.mean([abs(r["actual_qty"] - r["forecast_qty"]) / r["actual_qty"] for r in good]) < 0.1


def test_accuracy_summary(spark):
    rows = [("A", 10.0), ("A", 20.0), ("A", 30.0), ("A", None), ("B", 14.0)]
    got = {r["model_used"]: r for r in fc.accuracy_summary(spark.createDataFrame(rows, "model_used STRING, mape DOUBLE")).collect()}
    assert (got["A"]["count"], got["A"]["median_mape"], got["A"]["mean_mape"]) == (3, 20.0, 20.0)
    assert (got["A"]["pct_under_15"], got["A"]["pct_under_25"], got["B"]["pct_under_15"]) == (25.0, 50.0, 100.0)
