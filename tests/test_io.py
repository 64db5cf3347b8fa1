import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocklens.operators.cleaning import clean_file, clean_sales
from stocklens.plans.pipeline import run_pipeline
from stocklens.sources import files, scratch
from stocklens.streaming.incremental import clean_stream, read_cleaned

HEADER = ["transaction_date", "part_id", "dealer_id", "qty_sold", "unit_price", "discount_pct", "revenue", "was_fulfilled"]


def write_csv(path, rows, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def line(day, part, qty=5, price=10.0):
    return [day, part, 1, qty, price, 0, 1.0, "true"]


def demo_inputs(folder):
    rows = []
    for p in range(1, 41):
        for i in range(26):
            rows.append(line(f"{2022 + i // 12}-{i % 12 + 1:02d}-15", p, 3 + (p * 7 + i * 5) % 11, 10.0 + p))
    rows.append(line("bad-date", 1))
    write_csv(folder / "fact_sales_sample.csv", rows)
    inv = [["2024-02-15", p, 1, p % 13, 1, 2, 8.5] for p in range(1, 41)]
    write_csv(folder / "fact_inventory_sample.csv", inv, ["snapshot_date", "part_id", "dealer_id", "qty_on_hand", "qty_reserved", "qty_in_transit", "avg_unit_cost"])


def test_load_inputs_skips_missing_files(spark, tmp_path, caplog):
    demo_inputs(tmp_path)
    data = files.load_inputs(spark, str(tmp_path))
    assert set(data) == {"sales", "inventory", "purchase_orders"} and "dim_parts_sample.csv" in caplog.text
    assert data["sales"].count() == 1041 and data["purchase_orders"].columns[0] == "po_id" and len(data["purchase_orders"].columns) == 11
    assert dict(data["sales"].dtypes)["unit_price"] == "double" and dict(data["sales"].dtypes)["transaction_date"] == "string"


def test_full_pipeline_saves_five_outputs(spark, tmp_path):
    demo_inputs(tmp_path / "in")
    data = files.load_inputs(spark, str(tmp_path / "in"))
    out = run_pipeline(spark, data, "full", as_of="2024-02-28", output=str(tmp_path / "out"), run_at=dt.datetime(2024, 3, 1, 7, 30), trees=5, iterations=3)
    assert out["run_dir"].endswith("20240301_0730")
    saved = {n: spark.read.parquet(f"{out['run_dir']}/{n}") for n in files.OUTPUT_FILES.values() if n.endswith("parquet")}
    assert saved["abc_xyz_classification.parquet"].count() == 40 and saved["reorder_policies.parquet"].count() == 40
    assert saved["demand_forecasts.parquet"].count() == 240 and saved["stockout_risk_scores.parquet"].count() == 40
    summary = spark.read.csv(f"{out['run_dir']}/abc_xyz_summary.csv", header=True)
    assert "combined_class" in summary.columns and not summary.isEmpty()
    assert out["sales_report"].counts()["invalid_dates"] == 1 and not out["forecast_accuracy"].isEmpty()
    assert saved["reorder_policies.parquet"].select("avg_lead_time_days").distinct().collect() == [(21.0,)]


def test_pipeline_modes(spark, tmp_path):
    demo_inputs(tmp_path)
    data = files.load_inputs(spark, str(tmp_path))
    clean = run_pipeline(spark, data, "clean", as_of="2024-02-28")
    assert "sales_clean" in clean and "abc_xyz" not in clean
    assert "abc_xyz_summary" in run_pipeline(spark, data, "classify", as_of="2024-02-28")
    with pytest.raises(ValueError):
        run_pipeline(spark, data, "report")


def test_clean_file(spark, tmp_path):
    write_csv(tmp_path / "in.csv", [line("2024-01-01", 1), line("2024-01-01", 1), line("x", 1), line("2024-01-02", 2, qty=0)])
    report = clean_file(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), "sales", as_of="2024-06-01")
    assert (report.counts()["source_rows"], report.counts()["output_rows"], report.counts()["duplicate_rows"]) == (4, 1, 1)
    assert spark.read.csv(str(tmp_path / "out"), header=True).first()["revenue"] == "50.0000"
    with pytest.raises(ValueError, match="Unknown table_type"):
        clean_file(spark, "a", "b", "other")


def test_clean_file_keeps_the_first_copy(spark, tmp_path):
    first, second = line("2024-01-01", 1), line("2024-01-01", 1)
    first[5], second[5] = 20, 10
    for name, rows in (("a", [first, second]), ("b", [second])):
        write_csv(tmp_path / "in" / f"{name}.csv", rows)
    clean_file(spark, str(tmp_path / "in"), str(tmp_path / "out"), "sales", as_of="2024-06-01")
    kept = spark.read.csv(str(tmp_path / "out"), header=True).collect()
    assert [float(r["discount_pct"]) for r in kept] == [20.0]
    assert "_position" not in kept[0].asDict()


def test_stream_is_incremental_and_exact_across_batches(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    go = lambda: clean_stream(spark, str(src), out, state, columns=HEADER, as_of="2024-06-01").awaitTermination()
    write_csv(src / "a.csv", [line("2024-01-01", 1), line("2024-03-01", 2), line("oops", 3)])
    go()
    assert read_cleaned(spark, out).count() == 2
    write_csv(src / "b.csv", [line("2024-01-01", 1), line("2024-01-05", 4), line("2024-01-05", 4)])  # a late repeat and a new row
    go()
    rows = {(str(r["transaction_date"]), r["part_id"]) for r in read_cleaned(spark, out).collect()}
    assert read_cleaned(spark, out).count() == 3 and rows == {("2024-01-01", 1), ("2024-03-01", 2), ("2024-01-05", 4)}
    go()  # nothing new
    assert read_cleaned(spark, out).count() == 3


def test_stream_does_not_depend_on_batches(spark, tmp_path):
    rows = [line(f"2024-0{1 + i % 3}-0{1 + i % 7}", i % 4, price=10.0 + i % 9) for i in range(60)]
    rows += [line("2024-01-01", 1, price=900.0), line("2024-01-09", 2, price=11.0), line("2024-01-09", 2, price=11.0)]
    rows[-1][5], rows[-2][5] = 7, 3  # the smaller discount counts, in whichever batch it comes
    for i in range(7):
        write_csv(tmp_path / "in" / f"{i}.csv", rows[i::7])
    found = []
    for files_a_batch in (None, 1, 3):
        out = str(tmp_path / f"out{files_a_batch}")
        clean_stream(spark, str(tmp_path / "in"), out, str(tmp_path / f"state{files_a_batch}"), columns=HEADER, max_files=files_a_batch, as_of="2024-06-01").awaitTermination()
        found.append(sorted(map(str, read_cleaned(spark, out).collect())))
    assert found[0] == found[1] == found[2] and found[0]
    whole = clean_sales(files.read_csv(spark, str(tmp_path / "in"), files.RAW_SALES).select(*HEADER), "2024-06-01").clean
    assert sorted(map(str, whole.collect())) == found[0]


def test_stream_of_inventory(spark, tmp_path):
    names = ["snapshot_date", "part_id", "dealer_id", "qty_on_hand", "qty_reserved", "qty_in_transit", "avg_unit_cost"]
    write_csv(tmp_path / "in" / "a.csv", [["2024-01-01", 1, 1, -4, 0, 0, 2.5], ["2024-01-01", 2, 1, 4, 0, 0, 0]], names)
    clean_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), "inventory", columns=names).awaitTermination()
    assert [(r["part_id"], r["qty_on_hand"]) for r in read_cleaned(spark, str(tmp_path / "out")).collect()] == [(1, 0)]


def test_table_round_trip_is_partitioned_by_month(spark, tmp_path):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 5), 7), (2, dt.date(2024, 2, 6), 8)], "part_id INT, transaction_date DATE, qty_sold INT")
    path = files.write_table(rows, "fact_sales", str(tmp_path))
    assert {p.name for p in (tmp_path / "fact_sales").iterdir() if p.is_dir()} == {"month=2024-01-01", "month=2024-02-01"}
    back = files.read_table(spark, "fact_sales", str(tmp_path))
    assert back.where("month = DATE'2024-02-01'").select("part_id", "qty_sold").collect() == [(2, 8)]
    assert path.endswith("fact_sales")
    late = files.read_table(spark, "fact_sales", str(tmp_path), start="2024-02-01", end="2024-02-29")
    assert late.select("part_id").collect() == [(2,)]
    plan = late._jdf.queryExecution().explainString(late._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = next(row for row in plan.splitlines() if "PartitionFilters" in row)
    assert "month" in filters and "2024-02-01" in filters
    parts = spark.createDataFrame([(1, "P")], "part_id INT, part_number STRING")
    files.write_table(parts, "dim_parts", str(tmp_path))
    assert files.read_table(spark, "dim_parts", str(tmp_path)).first()["part_number"] == "P"
    with pytest.raises(ValueError, match="no date"):
        files.read_table(spark, "dim_parts", str(tmp_path), start="2024-01-01")


def test_materialize_writes_into_the_checkpoint_folder(spark):
    folder = scratch.checkpoint_dir(spark)
    df = scratch.materialize(spark.range(5), "five")
    assert df.count() == 5 and f"{folder.removeprefix('file:').rstrip('/')}/stocklens/five-" in df.inputFiles()[0]
    assert spark.conf.get("spark.checkpoint.dir", folder) == folder
