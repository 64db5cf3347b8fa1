"""Month-wise replacement of stored facts, and distinct counts from stored sketches."""

import datetime as dt

import pytest

from stocklens.operators import quality, sketches
from stocklens.sources import files


def sales(spark, rows):
    schema = "sale_id bigint, transaction_date date, part_id int, dealer_id int, qty_sold int"
    return spark.createDataFrame([(i, dt.date.fromisoformat(d), p, 1, q) for i, d, p, q in rows], schema)


def stored(spark, folder):
    return sorted((r.sale_id, str(r.transaction_date), r.qty_sold) for r in files.read_table(spark, "fact_sales", folder).collect())


def test_a_batch_replaces_its_months_and_no_other(spark, tmp_path):
    folder = f"file://{tmp_path}"
    first = [(1, "2024-01-05", 1, 1), (2, "2024-02-05", 1, 2), (3, "2024-02-06", 2, 3)]
    assert files.replace_months(sales(spark, first), "fact_sales", folder) == {"2024-01-01": 1, "2024-02-01": 2}
    second = [(4, "2024-02-07", 1, 9), (5, "2024-03-01", 1, 4)]
    for _ in range(2):  # a second load of the same batch changes nothing
        files.replace_months(sales(spark, second), "fact_sales", folder)
        assert stored(spark, folder) == [(1, "2024-01-05", 1), (4, "2024-02-07", 9), (5, "2024-03-01", 4)]
    assert files.replace_months(sales(spark, []), "fact_sales", folder) == {}
    assert len(stored(spark, folder)) == 3


def test_a_large_batch_has_more_ranges_and_its_keys_are_counted_in_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "RANGE_ROWS", 2)
    rows = [(i, f"2024-01-{1 + i % 28:02d}", i, i) for i in range(60)]
    assert files.replace_months(sales(spark, rows), "fact_sales", f"file://{tmp_path}") == {"2024-01-01": 60}
    assert stored(spark, f"file://{tmp_path}") == sorted((i, d, q) for i, d, _, q in rows)
    assert len(list((tmp_path / "fact_sales" / "month=2024-01-01").glob("*.parquet"))) > 8  # the shuffle partitions of the tests
    plan = quality.check_unique(sales(spark, rows), ["sale_id"])._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    assert [line for line in plan[dealt:] if "HashAggregate" in line] == []


def test_an_unsound_batch_is_refused_whole(spark, tmp_path):
    folder = f"file://{tmp_path}"
    parts = spark.createDataFrame([(1,)], "part_id int")
    good = sales(spark, [(1, "2024-01-05", 1, 1)])
    files.replace_months(good, "fact_sales", folder, {"part_id": parts})
    for bad, message in (
        ([(7, "2024-01-06", 1, 1), (7, "2024-01-07", 1, 1)], "repeated sale_id 1"), ([(8, "2024-01-06", 2, 1)], "unknown part_id 1"),
    ):
        with pytest.raises(ValueError, match=message):
            files.replace_months(sales(spark, bad), "fact_sales", folder, {"part_id": parts})
    with pytest.raises(ValueError, match="without date 1"):
        files.replace_months(spark.createDataFrame([(9, None)], "sale_id bigint, transaction_date date"), "fact_sales", folder)
    assert stored(spark, folder) == [(1, "2024-01-05", 1)]
    files.replace_months(sales(spark, [(7, "2024-01-06", 1, 1), (7, "2024-01-07", 1, 1)]), "fact_sales", folder, keys=False)
    assert len(stored(spark, folder)) == 2


def test_a_dimension_is_replaced_as_a_whole(spark, tmp_path):
    folder = f"file://{tmp_path}"
    for parts in ([(1, "P-1"), (2, "P-2")], [(2, "P-2")]):
        assert files.replace_months(spark.createDataFrame(parts, "part_id int, part_number string"), "dim_parts", folder) == {}
    assert [r.part_id for r in files.read_table(spark, "dim_parts", folder).collect()] == [2]


def test_merged_sketches_are_within_their_error(spark):
    rows = spark.range(60_000).selectExpr(
        "CAST(id % 40000 AS INT) AS part_id", "IF(id % 3 = 0, 'a', 'b') AS category",
        "date_add(DATE'2024-01-01', CAST(id % 400 AS INT)) AS transaction_date")
    by_month = sketches.distinct_sketches(rows, "part_id", ["category"])
    audit = sketches.distinct_audit(rows, by_month, "part_id", ["category"]).collect()
    assert len(audit) == 2 and all(r.within for r in audit)
    whole = sketches.distinct_estimate(by_month).first().estimate
    assert abs(whole - 40_000) / 40_000 <= sketches.RELATIVE_ERROR
    part = sketches.distinct_estimate(by_month, start="2024-02-10", end="2024-03-01").first().estimate
    exact = rows.where("transaction_date between '2024-02-01' and '2024-03-31'").select("part_id").distinct().count()
    assert abs(part - exact) / exact <= sketches.RELATIVE_ERROR
    few = spark.createDataFrame([(1, None), (1, dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 1))], "part_id int, transaction_date date")
    assert sketches.distinct_estimate(sketches.distinct_sketches(few, "part_id")).first().estimate == 1
