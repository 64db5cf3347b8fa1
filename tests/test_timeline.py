"""Labels, demand windows, as-of joins by key and folds against brute force; none of them writes or moves the snapshots."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from stocklens.operators import future, stockout
from stocklens.operators.asof import asof_by_key, asof_join
from stocklens.sources.scratch import checkpoint_dir

DAY = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def tables(spark):
    random.seed(3)
    key = lambda: random.choice([1, 1, 1, 2, 3, None])
    stock = [(key(), 1, day(random.choice([None, *range(0, 60, 4)])), random.choice([None, -2, 0, 3, 8, 15])) for _ in range(150)]
    sales = [(key(), 1, day(random.choice([None, *range(60)])), random.choice([None, 0, 1, 2, 5])) for _ in range(90)]
    inventory = spark.createDataFrame(stock, "part_id int, dealer_id int, snapshot_date date, qty_available int").repartition(5)
    return stock, sales, inventory, spark.createDataFrame(sales, "part_id int, dealer_id int, transaction_date date, qty_sold int").repartition(3)


def written(spark):
    folder = checkpoint_dir(spark).removeprefix("file:") + "/stocklens"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_labels_of_repeated_and_null_snapshots_equal_brute_force_and_write_nothing(spark):
    stock, sales, inventory, lines = tables(spark)
    before = written(spark)
    out = future.label_future_stockout(inventory, lines).collect()
    assert written(spark) == before

    def gone(part, when, available):
        if None in (part, when, available):
            return None
        if available <= 0:
            return when
        own = [(d, q) for p, _, d, q in stock if p == part and d is not None and d > when]
        coming = min((d for d, _ in own), default=None)
        empty = [d for d, q in own if q is not None and q <= 0]
        after = sorted({d for p, _, d, q in sales if p == part and d is not None and d > when and (coming is None or d < coming)})
        reached = [d for d in after if sum(q or 0 for p, _, x, q in sales if p == part and x is not None and when < x <= d) >= available]
        return min([*empty, *reached[:1]], default=None)

    want = sorted((str((p, when, a)), str(gone(p, when, a))) for p, _, when, a in stock)
    assert sorted((str((r.part_id, r.snapshot_date, r.qty_available)), str(r.gone_date)) for r in out) == want


def test_demand_windows_equal_brute_force_and_write_nothing(spark):
    stock, sales, inventory, lines = tables(spark)
    before = written(spark)
    out = {(r.part_id, r.snapshot_date): tuple(r[3:]) for r in future.demand_before(inventory, lines, (5, 30)).collect()}
    assert written(spark) == before
    total = lambda p, when, n: sum(q or 0 for x, _, d, q in sales if x == p and d is not None and 0 <= (when - d).days <= n)
    assert out == {(p, when): (total(p, when, 5), total(p, when, 30)) for p, _, when, _ in stock if None not in (p, when)}


def test_asof_by_key_equals_asof_join(spark):
    _, _, inventory, lines = tables(spark)
    args = ("snapshot_date", "transaction_date", ["qty_sold", "transaction_date"])
    key = lambda r: str(tuple(r))
    assert sorted(map(key, asof_by_key(inventory, lines, *args).collect())) == sorted(map(key, asof_join(inventory, lines, *args).collect()))


def test_folds_have_their_size_among_ties_and_nulls(spark):
    rows = [(random.Random(i).choice([None, 1, 1, 2]), i % 2, i) for i in range(61)]
    df = spark.createDataFrame(rows, "a int, b int, n int").repartition(4)
    out = stockout.assign_folds(df, ["a", "b"]).collect()
    assert [sum(r.fold == f for r in out) for f in range(6)] == [11, 10, 10, 10, 10, 10]
    order = lambda r: (r.a is not None, r.a or 0, r.b)
    for f in range(5):
        assert max(order(r) for r in out if r.fold == f) <= min(order(r) for r in out if r.fold == f + 1)
    assert sorted(r.n for r in out) == list(range(61))
    assert {r.fold for r in stockout.assign_folds(df.limit(3), ["a", "b"]).collect()} == {0}


def test_folds_of_distinct_rows_rank_only_counts(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), F.col("id").alias("b"))
    seen = written(spark)
    out = {r.b: r.fold for r in stockout.assign_folds(df, ["a", "b"]).collect()}
    ordered = sorted(range(1000), key=lambda i: (i % 10, i))
    assert [out[i] for i in ordered] == [0] * 170 + [f for f in range(1, 6) for _ in range(166)]
    rows = [spark.read.parquet(checkpoint_dir(spark) + "/stocklens/" + name).count() for name in written(spark) - seen]
    assert rows and max(rows) <= 500
