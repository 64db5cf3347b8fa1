"""The star schema over order tables."""

import datetime as dt

from stocklens.operators.latest import latest_row
from stocklens.sources.star import SOURCES, Star


def test_snapshots_are_not_taken_for_a_small_table(spark, tmp_path):
    """A row for each part, dealer and month of sales; Spark's estimate does not fall below the latest stock's size."""
    days = [dt.datetime(2024, 1, 31), dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 30), None]
    tables = {
        "part": ([(i, f"name {i % 5}", "brand", "type", i % 50, 10.0 + i % 7) for i in range(3_000)], SOURCES["part"]),
        "region": ([(i, f"region {i}") for i in range(5)], SOURCES["region"]),
        "lineitem": ([(1, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", day) for day in days], SOURCES["lineitem"]),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/{name}.parquet")
    inventory = Star(spark, f"file://{tmp_path}").inventory
    found = {(r.part_id, r.dealer_id, str(r.snapshot_date), r.qty_on_hand) for r in inventory.collect()}
    on_hand = lambda p, d, m: (p * 7 + d * 13 + (2024 * 12 + m) * 5) % 121
    assert found == {(p, d, f"2024-0{m}-01", on_hand(p, d, m)) for p in range(3_000) for d in range(5) for m in (1, 3)}
    assert inventory.count() == len(found)
    latest = latest_row(inventory, "snapshot_date", ["qty_available"])
    estimate = int(str(latest._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert estimate >= 3_000 * 5 * (8 + 4 + 4)  # part, dealer and quantity of each position
