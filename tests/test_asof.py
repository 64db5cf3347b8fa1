"""As-of joins, period look-ups and future labels against brute-force versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stocklens.operators import future, kpi, periods
from stocklens.operators.asof import asof_join
from stocklens.operators.latest import last_non_null, latest_row

DAY = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def brute(left, right, direction, inclusive):
    """right rows: (k, day, tie, v); the held row is (tie, v) of the nearest day, the greatest of it."""
    out = []
    for k, t, name in left:
        ok = [r for r in right if None not in (k, t, r[0], r[1]) and r[0] == k]
        if direction == "backward":
            ok = [r for r in ok if r[1] < t or inclusive and r[1] == t]
            near = max((r[1] for r in ok), default=None)
        else:
            ok = [r for r in ok if r[1] > t or inclusive and r[1] == t]
            near = min((r[1] for r in ok), default=None)
        held = max(((r[2], r[3] is not None, r[3]) for r in ok if r[1] == near), default=None)
        out.append((k, t, name, near, None if held is None else held[2]))
    return sorted(out, key=str)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_asof_join_equals_brute_force(spark, direction, inclusive):
    random.seed(4)
    # Key 1 holds most rows, so that it is cut into several chunks; days repeat; keys and days may be null.
    key = lambda: random.choice([1] * 12 + [2, 3, 4, None])
    left = [(key(), random.choice([None, *range(60)]), i) for i in range(400)] + [(9, 5, -1)]
    right = [(key(), random.choice([None, *range(0, 60, 2)]), random.randint(0, 3), random.choice([None, 1, 2, 3])) for _ in range(150)] + [(8, 1, 0, 1)]
    a = spark.createDataFrame([(k, day(t), n) for k, t, n in left], "k int, at date, name int").repartition(7)
    b = spark.createDataFrame([(k, day(t), x, v) for k, t, x, v in right], "k int, since date, tie int, v int").repartition(3)
    out = asof_join(a, b, "at", "since", ["since", "v"], ["k"], ["tie"], direction, inclusive)
    assert out.columns == ["k", "at", "name", "since", "v"]
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([(k, day(t), n, day(s), v) for k, t, n, s, v in brute(left, right, direction, inclusive)], key=str)


def test_asof_join_carries_over_many_chunks_and_empty_sides(spark):
    a = spark.range(2000).selectExpr("7 AS k", "id AS at")
    b = spark.createDataFrame([(7, 10, "x"), (7, 1990, "y")], "k int, since bigint, v string")
    out = asof_join(a, b, "at", "since", ["v"], ["k"]).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in out} == {None: 10, "x": 1980, "y": 10}
    assert asof_join(a, b.where("false"), "at", "since", ["v"], ["k"]).where("v is null").count() == 2000
    assert asof_join(a.where("false"), b, "at", "since", ["v"], ["k"]).count() == 0
    with pytest.raises(ValueError):
        asof_join(a, b, "at", "since", ["v"], ["k"], direction="sideways")


def test_risk_history_uses_the_policy_of_the_day(spark):
    stock = spark.createDataFrame([(1, 1, day(n), 5, 0) for n in (0, 10, 20)], "part_id int, dealer_id int, snapshot_date date, qty_available int, qty_in_transit int")
    policy = spark.createDataFrame(
        [(1, 1, day(10), 3, 1, 1.0, 2.0), (1, 1, day(10), 9, 1, 1.0, 2.0), (1, 1, day(15), 4, 9, 1.0, 2.0)],
        "part_id int, dealer_id int, effective_date date, reorder_point int, safety_stock_qty int, avg_daily_demand double, avg_lead_time_days double")
    parts = spark.createDataFrame([(1, "P", "p", "c", False)], "part_id int, part_number string, part_name string, category string, is_critical boolean")
    dealers = spark.createDataFrame([(1, "d")], "dealer_id int, dealer_name string")
    out = {r.snapshot_date: (r.reorder_point, r.risk_level) for r in kpi.stockout_risk_history(stock, policy, parts, dealers).collect()}
    assert out == {day(0): (None, "OK"), day(10): (9, "ORDER NOW"), day(20): (4, "CRITICAL")}


def test_period_sums_equal_brute_force(spark):
    random.seed(6)
    rows = [(random.choice(["a", "a", "b", None]), day(random.randint(0, 800)), random.choice([None, 1, 2, 5])) for _ in range(300)]
    facts = spark.createDataFrame(rows, "g string, transaction_date date, q int").repartition(5)
    out = periods.period_table(facts.where("g is not null"), {"q": "q"}, ["g"]).collect()
    total = lambda g, lo, hi: sum(q or 0 for x, d, q in rows if x == g and lo <= d <= hi)
    assert len(out) == 2 * len({(d.year, d.month) for _, d, _ in rows})
    for r in out:
        d = r.anchor
        last_year = d.replace(year=d.year - 1, day=28 if (d.month, d.day) == (2, 29) else d.day)
        assert r.q_mtd == total(r.g, d.replace(day=1), d)
        assert r.q_ytd == total(r.g, d.replace(month=1, day=1), d)
        assert r.q_prior_year_ytd == total(r.g, d.replace(year=d.year - 1, month=1, day=1), last_year)
        assert r.q_trailing_12 == total(r.g, last_year + dt.timedelta(days=1), d)


def test_future_labels(spark):
    stock = [(1, 0, 10), (1, 31, 10), (1, 60, 0), (2, 0, 3), (2, 5, 50), (2, 20, -1), (3, 0, None), (4, 0, 8)]
    sales = [(1, 2, 4), (1, 9, 6), (1, 40, 9), (2, 4, 2), (2, 6, 9), (2, 7, 60), (4, 0, 99), (4, 30, 8)]
    inventory = spark.createDataFrame([(p, 1, day(t), q) for p, t, q in stock], "part_id int, dealer_id int, snapshot_date date, qty_available int").repartition(4)
    lines = spark.createDataFrame([(p, 1, day(t), q) for p, t, q in sales], "part_id int, dealer_id int, transaction_date date, qty_sold int")
    out = {(r.part_id, (r.snapshot_date - DAY).days): (r.gone_date, r.stockout_within_horizon) for r in future.label_future_stockout(inventory, lines).collect()}
    assert out == {
        (1, 0): (day(9), 1),  # ten sold by day 9
        (1, 31): (day(60), 0),  # nine sold by day 40; the snapshot of day 60 is empty
        (1, 60): (day(60), 1),
        (2, 0): (day(20), 0),  # a delivery before three were sold, then the empty snapshot of day 20
        (2, 5): (day(7), 1),
        (2, 20): (day(20), 1),
        (3, 0): (None, 0),
        (4, 0): (day(30), 0),  # sales of the snapshot's own day are in its stock already
    }
    counts = future.label_counts(future.label_future_stockout(inventory, lines)).collect()
    assert sum(r.snapshots for r in counts) == 8 and sum(r.stockouts for r in counts) == 4


def test_demand_before_each_snapshot(spark):
    inventory = spark.createDataFrame([(1, 1, day(40)), (1, 1, day(100)), (2, 1, day(40)), (None, 1, day(3))], "part_id int, dealer_id int, snapshot_date date")
    lines = spark.createDataFrame([(1, 1, day(t), q) for t, q in ((1, 1), (10, 2), (40, 4), (69, 8), (70, 16), (101, 32))], "part_id int, dealer_id int, transaction_date date, qty_sold int")
    out = {(r.part_id, (r.snapshot_date - DAY).days): tuple(r[3:]) for r in future.demand_before(inventory, lines).collect()}
    assert out == {(1, 40): (6, 7, 7), (1, 100): (16, 28, 30), (2, 40): (0, 0, 0)}


@pytest.mark.parametrize("kind", ["date", "timestamp", "int"])
def test_latest_row_does_not_depend_on_partitions(spark, kind):
    rows = [(1, 5, q, f"x{q}") for q in range(20)] + [(1, 4, 99, "old"), (2, None, 1, "none")]
    df = spark.createDataFrame(rows, "part_id int, n int, q int, s string")
    when = {"date": "date_add(DATE'2024-01-01', n)", "timestamp": "CAST(date_add(DATE'2024-01-01', n) AS TIMESTAMP)", "int": "n"}[kind]
    df = df.selectExpr("part_id", f"{when} AS at", "q", "s")
    picked = {tuple(r) for seed in range(4) for r in latest_row(df.orderBy(F.hash(F.col("q") + seed)).repartition(3 + seed), "at", ["q", "s"], ["part_id"]).collect()}
    assert len(picked) == 2 and all(s in (f"x{q}", None) for _, q, s in picked)
    assert (2, None, None) in picked
    exact = latest_row(df, "at", ["q", "s"], ["part_id"], tie_by=["q"]).where("part_id = 1").first()
    assert (exact.q, exact.s) == (19, "x19")
    newest = {tuple(r) for seed in range(3) for r in last_non_null(df.repartition(2 + seed), "at", ["q", "s"], ["part_id"]).collect()}
    assert len(newest) == 2
