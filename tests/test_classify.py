import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stocklens.operators.classify import abc_xyz, abc_xyz_summary, action_matrix, classify_abc, classify_xyz, with_actions
from stocklens.schemas import abc_xyz_table
from stocklens.sources.scratch import partitions


def abc_of(spark, values, **kw):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id INT, revenue DOUBLE")
    rows = classify_abc(df, "revenue", ["id"], **kw).orderBy("id").collect()
    return [r["abc_class"] for r in rows]


@pytest.mark.parametrize(
    "values, kw, expected",
    [
        ([9000, 100, 50, 30, 20], {"boundary": "preceding"}, "ACCCC"),
        ([9000, 100, 50, 30, 20], {}, "CCCCC"),
        ([10000, 2000, 500, 1, 1, 1, 1, 1], {}, "ACCCCCCC"),
        ([100] * 10, {}, "AAAAAAAABC"),
        ([0, 0, 0], {}, "CCC"),
        ([8000, 1000, 500, 100, 50], {"a_pct": 70.0, "b_pct": 90.0, "boundary": "preceding"}, "ABCCC"),
        ([500, 300, 100], {}, "ABC"),
    ],
)
def test_abc(spark, values, kw, expected):
    assert "".join(abc_of(spark, values, **kw)) == expected


def test_abc_rejects_unknown_boundary(spark):
    with pytest.raises(ValueError):
        abc_of(spark, [1], boundary="other")


def monthly(spark, values, part=1, kind="BIGINT"):
    rows = [(part, 1, dt.date(2023 + i // 12, i % 12 + 1, 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"part_id INT, dealer_id INT, year_month DATE, qty_sold {kind}")


@pytest.mark.parametrize("values, expected", [([10] * 24, "X"), ([0] * 24, "Z"), ([0, 100] * 12, "Z"), ([10, 30] * 12, "Y")])
def test_xyz(spark, values, expected):
    row = classify_xyz(monthly(spark, values)).first()
    assert row["xyz_class"] == expected
    if not any(values):
        assert row["demand_cov"] == 9999


def test_xyz_counts_absent_months_and_forms_agree(spark):
    both = monthly(spark, [5, 8, 2, 9], 1).unionByName(monthly(spark, [4], 2))
    exact = {r["part_id"]: r for r in classify_xyz(both).collect()}
    assert exact[2]["avg_monthly_demand"] == 1.0 and exact[2]["demand_std"] == pytest.approx(2.0)
    fractional = classify_xyz(both.withColumn("qty_sold", F.col("qty_sold").cast("double"))).collect()
    for r in fractional:
        for c in ("avg_monthly_demand", "demand_std", "demand_cov"):
            assert r[c] == pytest.approx(exact[r["part_id"]][c])


def sales(spark, parts=30, months=24, seed=0):
    rng, rows = random.Random(seed), []
    for p in range(1, parts + 1):
        mean = rng.uniform(1, 50)
        for m in range(months):
            qty = max(0, int(rng.gauss(mean, mean * 0.3)))
            if qty:
                day = dt.date(2023, 1, 1) + dt.timedelta(days=30 * m)
                rows.append((day, p, 1, qty, qty * rng.uniform(20, 200)))
    return spark.createDataFrame(rows, "transaction_date DATE, part_id INT, dealer_id INT, qty_sold INT, revenue DOUBLE")


def test_abc_xyz_end_to_end(spark):
    result = abc_xyz(sales(spark))
    rows = result.collect()
    valid = {a + x for a in "ABC" for x in "XYZ"}
    assert len(rows) == 30 and {r["combined_class"] for r in rows} <= valid
    assert all(r["combined_class"] == r["abc_class"] + r["xyz_class"] for r in rows)
    summary = abc_xyz_summary(result).collect()
    assert len(summary) <= 9
    assert sum(r["revenue_share_pct"] for r in summary) == pytest.approx(100, abs=0.5)
    assert sum(r["part_share_pct"] for r in summary) == pytest.approx(100, abs=0.5)
    assert sum(r["revenue_share_pct"] for r in summary if r["combined_class"][0] == "A") >= 70
    revenue = [r["total_revenue"] for r in summary]
    assert revenue == sorted(revenue, reverse=True)
    assert with_actions(result).where("recommended_action IS NULL").isEmpty()
    stored = abc_xyz_table(result, "2024-11-20").first()
    assert str(stored["classification_month"]) == "2024-11-01" and stored["annual_revenue"] is not None


def test_window_is_trailing_and_inclusive(spark):
    rows = [("2023-01-01", 1, 1, 5, 10.0), ("2023-01-02", 2, 1, 5, 10.0), ("2024-01-02", 3, 1, 5, 10.0), ("2024-01-03", 4, 1, 5, 10.0)]
    df = spark.createDataFrame(rows, "d STRING, part_id INT, dealer_id INT, qty_sold INT, revenue DOUBLE").select(
        F.to_date("d").alias("transaction_date"), "part_id", "dealer_id", "qty_sold", "revenue")
    assert {r["part_id"] for r in abc_xyz(df, as_of="2024-01-02").collect()} == {2, 3}
    with pytest.raises(ValueError, match="No sales data in the reference period"):
        abc_xyz(df, as_of="2030-01-01")


def test_windows_of_many_years(spark):
    rows = [(dt.date(2014 + i // 12, i % 12 + 1, 3), 1, 1, 4, 10.0) for i in range(124)]
    df = spark.createDataFrame(rows + rows[-1:], "transaction_date DATE, part_id INT, dealer_id INT, qty_sold INT, revenue DOUBLE")
    got = abc_xyz(df, months=130).first()
    assert got["avg_monthly_demand"] == pytest.approx(500 / 124)


def test_action_matrix(spark):
    rows = action_matrix(spark).collect()
    assert {r["combined_class"] for r in rows} == {a + x for a in "ABC" for x in "XYZ"} and len(rows) == 9


def test_xyz_deals_rows_by_key_to_many_tasks(spark):
    monthly = spark.createDataFrame([(k, m, k + m) for k in range(50) for m in range(4)] + [(None, 1, 3), (1, 1, 2)], "part_id int, month int, qty_sold int")
    out = classify_xyz(monthly, ["part_id"], "month")
    dealt = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line and "part_id" in line]
    assert len(dealt) == 1 and f", {partitions(spark)})" in dealt[0] and "month" not in dealt[0]
    means = {r.part_id: r.avg_monthly_demand for r in out.collect()}
    assert means[None] == 0.75 and means[1] == 12 / 4 and means[2] == 14 / 4 and len(means) == 51
