"""The key x day state, and measures with subtotals over it, against the same operators over the facts."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stocklens.operators import classify, cube, features, key_day, kpi, measures, ordered, replenish
from stocklens.plans import registry
from stocklens.sources.scratch import partitions

DAY = dt.date(2024, 1, 1)
SCHEMA = """transaction_date date, part_id int, dealer_id int, qty_sold int, unit_price decimal(12,2), discount_pct decimal(5,2),
    revenue decimal(16,2), cogs decimal(16,2), was_fulfilled boolean, backorder_qty int, kind string"""


def make(seed, n=400, parts=6):
    random.seed(seed)
    rows = []
    for _ in range(n):
        qty, ok = random.choice([None, 1, 2, 7]), random.random() < 0.8
        price = Decimal(random.randint(100, 900)) / 100
        rows.append((DAY + dt.timedelta(days=random.choice([0, 1, 2, 100, 200, 300, 380])), random.randint(1, parts), random.randint(1, 2), qty, price,
                     Decimal(random.choice([0, 5])), (qty or 0) * price, (qty or 0) * price / 2, ok, 0 if ok else qty, random.choice("xyz")))
    return rows


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(make(1), SCHEMA).repartition(6)


def rows(df):
    return sorted((tuple(round(float(v), 6) if isinstance(v, (float, Decimal)) else v for v in r) for r in df.select(sorted(df.columns)).collect()), key=str)


def test_operators_over_a_state_equal_those_over_the_fact(spark, sales):
    state = key_day.key_day_state(sales)
    dealers = spark.createDataFrame([(1, "a", "r"), (2, "b", "r")], "dealer_id int, dealer_name string, region string")
    parts = spark.createDataFrame([(i, f"c{i % 2}") for i in range(1, 7)], "part_id int, category string")
    as_of = DAY + dt.timedelta(days=380)
    for operator in (
        replenish.demand_stats, lambda s: features.demand_windows(s, as_of=as_of), lambda s: kpi.fill_rate(s, dealers, as_of, 400), kpi.service_level,
        lambda s: kpi.monthly_by_category(s, parts), lambda s: measures.sales_overview(s, ("dealer_id",)), lambda s: classify.abc_xyz(s, as_of=as_of),
        lambda s: cube.measures_of(s, cube.sales_measures(s, as_of), ("dealer_id",)),
    ):
        assert rows(operator(state)) == rows(operator(sales))


def test_a_state_in_batches_equals_the_whole(spark, sales, tmp_path):
    folder = f"file://{tmp_path}/key_day"
    whole = key_day.key_day_state(sales)
    for i in (0, 1, 2, 1):  # the second batch is loaded twice
        key_day.write_batch(key_day.key_day_state(sales.where(F.pmod(F.hash("unit_price"), F.lit(3)) == i)), folder, f"b{i}")
    stored = key_day.read_state(spark, folder, whole.schema)
    assert stored.dtypes == whole.dtypes and rows(stored) == rows(whole)
    late = DAY + dt.timedelta(days=100)
    assert rows(key_day.read_state(spark, folder, whole.schema, late, late)) == rows(whole.where(F.col("transaction_date") == F.lit(late)))
    plan = key_day.read_state(spark, folder, whole.schema, late)._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters")[1].split("]")[0]
    key_day.compact(spark, folder, f"{folder}-base", whole.schema)
    assert rows(key_day.read_state(spark, f"{folder}-base", whole.schema)) == rows(whole)
    key_day.write_batch(whole.where("false"), folder, "b1")  # a corrected batch leaves nothing of the old one
    left = key_day.key_day_state(sales.where(F.pmod(F.hash("unit_price"), F.lit(3)) != 1))
    assert rows(key_day.read_state(spark, folder, whole.schema)) == rows(left)


def test_cube_finishes_ratios_and_distinct_counts_last(spark, sales):
    facts = sales.withColumn("kind", F.when(F.col("kind") != "z", F.col("kind")))  # null is a group, not a subtotal
    by = ("dealer_id", "kind")
    out = cube.measure_cube(facts, cube.sales_measures(facts), by)
    assert out.groupBy("level").count().count() == 4
    for level, keys in ((0, by), (1, by[:1]), (2, by[1:]), (3, ())):
        part = out.where(f"level = {level}").drop("level", *[c for c in by if c not in keys])
        direct = cube.measures_of(facts, cube.sales_measures(facts), keys)
        assert rows(part) == rows(direct)
        parts = facts.groupBy(*keys).agg(F.countDistinct("part_id").alias("n"))
        assert sorted(r.parts_sold for r in part.collect()) == sorted(r.n for r in parts.collect())
    rolled = cube.measure_cube(facts, cube.sales_measures(facts), by, cube.rollup_sets(by))
    assert rows(rolled) == rows(out.where("level in (0, 1, 3)"))
    assert cube.measure_cube(facts.where("false"), cube.sales_measures(facts), by).count() == 0
    with pytest.raises(ValueError):
        cube.measure_cube(facts, {"a": cube.Measure(F.lit(1), 0, distinct="part_id"), "b": cube.Measure(F.lit(1), 0, distinct="kind")}, by)


def test_cube_counts_null_and_repeated_values_and_shuffles_no_expanded_rows(spark, sales):
    facts = sales.withColumn("part_id", F.when(F.col("part_id") % 3 != 0, F.col("part_id"))).unionByName(sales.where("dealer_id = 1"))
    by = ("dealer_id", "kind", "part_id")  # the counted column is a column of the cube as well
    out = cube.measure_cube(facts, cube.sales_measures(facts), by)
    for level, keys in ((0, by), (6, by[2:]), (1, by[:2]), (7, ())):
        direct = facts.groupBy(*keys).agg(F.countDistinct("part_id").alias("parts_sold"), F.sum("qty_sold").alias("total_units_sold"))
        part = out.where(f"level = {level}").select(*keys, "parts_sold", "total_units_sold")
        assert rows(part) == rows(direct.select(part.columns))
    values = facts.select(*by[:2], F.col("part_id").alias("_distinct"))
    counts = cube._distinct_counts(values, by[:2], cube.cube_sets(by[:2]), "n")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    groups, dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]  # counts of groups, and below the values
    assert "_distinct" not in groups and "_distinct" in dealt and "level" not in dealt


def test_quantiles_of_any_values_are_exact(spark):
    random.seed(3)
    values = [0.0, -0.0, -5.5, 1e-300, 1e300, -1e300, 3.0, 3.0, 3.0000001, float("inf"), float("-inf")] + [random.gauss(0, 100) for _ in range(200)]
    data = [(random.choice([1, 1, 1, 2, None]), v) for v in values] + [(3, 7.0), (4, None)]
    df = spark.createDataFrame(data, "k int, v double").repartition(5)
    out = {r.k: (r.lo, r.mid, r.hi) for r in ordered.exact_quantiles(df, ["k"], "v", {"lo": 0.0, "mid": 0.5, "hi": 0.9}).collect()}
    assert set(out) == {1, 2, 3, None}
    for k, found in out.items():
        own = sorted(v for x, v in data if x == k and v is not None)
        for p, q in zip((0.0, 0.5, 0.9), found, strict=True):
            at = (len(own) - 1) * p
            low, high = own[int(at)], own[min(int(at) + (at % 1 > 0), len(own) - 1)]
            assert q == pytest.approx(low + (high - low) * (at % 1), nan_ok=True)
    whole = ordered.exact_quantiles(df.where("abs(v) < 1e9"), [], "v", {"mid": 0.5}).collect()
    assert len(whole) == 1
    counted = df.where("k = 1 and abs(v) < 1e9").groupBy("k", "v").count()
    same = ordered.exact_quantiles(df.where("k = 1 and abs(v) < 1e9"), ["k"], "v", {"mid": 0.5}).first()
    assert ordered.exact_quantiles(counted, ["k"], "v", {"mid": 0.5}, "count").first() == same


def test_buckets_never_fall(spark):
    values = sorted([0.0, 1e-310, 1e-5, 0.1, 0.5, 1.0, 1.0000001, 2.0, 1e10, float("inf")] + [-x for x in (1e-310, 1e-5, 0.1, 1.0, 1e10, float("inf"))])
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    buckets = [r.b for r in df.select("v", ordered.magnitude_bucket("v").alias("b")).orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_state_deals_lines_and_two_batches_read_the_sales_once(spark, sales):
    plan = key_day.key_day_state(sales)._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    assert f", {partitions(spark)})" in plan[dealt]
    assert [line for line in plan[dealt:] if "HashAggregate" in line] == []  # lines are shuffled, not their wider sums

    lines, session = sales, spark

    class Read:
        spark, times = session, 0

        @property
        def sales(self):
            Read.times += 1
            kind = F.pmod(F.hash("unit_price"), F.lit(4))
            return lines.withColumn("order_source", F.when(kind == 0, "1-URGENT").when(kind == 1, "2-HIGH").when(kind == 2, "5-LOW"))

    known = Read().sales.where("order_source IS NOT NULL")  # as before, lines without a source are in no batch
    Read.times = 0
    stored = registry._stored_state(Read())
    assert Read.times == 1 and rows(stored) == rows(key_day.key_day_state(known))
