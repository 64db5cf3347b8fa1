"""Named queries over a folder of order-processing tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from stocklens.functions.scalar import num_round
from stocklens.operators import (
    classify, cleaning, cube, features, forecast, future, key_day, kpi, latest, measures, ordered, periods, quality, replenish, sketches,
    stockout,
)
from stocklens.plans import dashboards
from stocklens.plans.pipeline import run_pipeline
from stocklens.schemas import (
    PARTITION_DATE, abc_xyz_table, apply_defaults, derive_inventory, derive_purchase_orders, derive_sales, forecast_table, policy_table,
)
from stocklens.sources import files
from stocklens.sources.calendar import calendar_between
from stocklens.sources.scratch import checkpoint_dir, materialize
from stocklens.sources.star import Star
from stocklens.streaming.incremental import clean_stream, read_cleaned

QUERIES: dict[str, Callable[[Star], DataFrame]] = {}
SERIES_KEYS = ("brand", "dealer_id")


def query(fn: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Decimals and doubles as DOUBLE with at most six decimals, for comparison across engines."""
    return df.select(
        *[
            num_round(f.name, digits).alias(f.name) if isinstance(f.dataType, (DoubleType, DecimalType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return tidy(QUERIES[name](Star(spark, folder)))


# ---------------------------------------------------------------- shared inputs
def _classified(s: Star) -> DataFrame:
    return classify.abc_xyz(s.sales, as_of=s.as_of)


def _classified_state(s: Star) -> DataFrame:
    """Classes from the key x day state, for queries in which other operators read it as well."""
    return classify.abc_xyz(s.state, as_of=s.as_of)


def _policies(s: Star, classified: DataFrame | None = None) -> DataFrame:
    abc = _classified_state(s) if classified is None else classified
    return replenish.reorder_policies(s.state, s.purchase_orders, abc, s.parts)


def _policy_history(s: Star) -> DataFrame:
    """A superseded and a current policy per part and dealer."""
    now = materialize(_policies(s), "policies")
    old = now.withColumns(
        {"effective_date": F.date_sub(F.lit(str(s.as_of)).cast("date"), 30), "reorder_point": F.col("reorder_point") * 2}
    )
    return now.withColumn("effective_date", F.lit(str(s.as_of)).cast("date")).unionByName(old)


def _policy_versions(s: Star) -> DataFrame:
    """Four policies per part and dealer, valid from different days on."""
    now = materialize(_policies(s), "policies")
    ages = F.array(*[F.struct(F.lit(d).alias("age"), F.lit(f).alias("factor")) for d, f in ((0, 1), (30, 2), (400, 3), (800, 4))])
    rows = now.select("*", F.inline(ages))
    return rows.withColumns({
        "effective_date": F.date_sub(F.lit(str(s.as_of)).cast("date"), F.col("age")),
        "reorder_point": F.col("reorder_point") * F.col("factor"),
    }).drop("age", "factor")


def _stock(s: Star) -> DataFrame:
    return latest.latest_row(
        s.inventory, "snapshot_date", ["qty_on_hand", "qty_available", "avg_unit_cost", "last_movement_date"]
    )


def _branded(s: Star) -> DataFrame:
    return s.sales.join(s.parts.select("part_id", "brand"), "part_id")


def _features(s: Star) -> DataFrame:
    abc = _classified_state(s)
    return features.build_features(s.inventory, s.state, s.purchase_orders, _policies(s, abc), abc, s.as_of)


def _faulty_sales(s: Star) -> DataFrame:
    """Sales with one kind of fault per (quantity, discount) pair, and repeated rows."""
    q, d, price = F.col("qty_sold"), F.col("discount_pct"), F.col("unit_price").cast("double")
    is_ = lambda qty, disc: (q == qty) & (d == disc)
    columns = ["transaction_date", "part_id", "dealer_id", "customer_type", "qty_sold", "unit_price", "discount_pct",
               "revenue", "was_fulfilled", "backorder_qty"]
    faulty = s.sales.select(
        "order_source",
        F.when(is_(7, 1), "not-a-date").when(is_(11, 2), "2099-01-01").otherwise(F.col("transaction_date").cast("string"))
        .alias("transaction_date"),
        "part_id", "dealer_id", "customer_type",
        F.when(is_(23, 4), 0).when(is_(29, 5), -3).otherwise(q).alias("qty_sold"),
        F.when(is_(31, 6), 0.0).when(is_(47, 10), price * 1000).otherwise(price).alias("unit_price"),
        F.when(is_(37, 7), 150.0).when(is_(41, 8), -5.0).when(is_(43, 9), None).otherwise(d.cast("double")).alias("discount_pct"),
        F.when(is_(19, 3), None).otherwise(F.col("revenue").cast("double")).alias("revenue"),
        "was_fulfilled", "backorder_qty",
    )
    twice = F.when(F.col("order_source") == "1-URGENT", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = faulty.withColumn("_copy", F.explode(twice))
    copied = F.col("_copy") & (F.col("qty_sold") > 25)
    return rows.withColumn("customer_type", F.when(copied, "AAA COPY").otherwise(F.col("customer_type"))).select(columns)


def _dirty_sales(s: Star) -> DataFrame:
    """_faulty_sales landed as a table, as a raw extract is: the cleaner reads it twice."""
    return materialize(_faulty_sales(s), "raw_sales")


def _dirty_inventory(s: Star) -> DataFrame:
    h, r = F.col("qty_on_hand"), F.col("qty_reserved")
    return s.inventory.select(
        F.when((h == 50) & (r == 3), "INVALID").otherwise(F.col("snapshot_date").cast("string")).alias("snapshot_date"),
        "part_id", "dealer_id",
        F.when(h == 60, -10).otherwise(h).alias("qty_on_hand"),
        F.when(r == 4, -5).otherwise(r).alias("qty_reserved"),
        F.when(F.col("qty_in_transit") == 5, -1).otherwise(F.col("qty_in_transit")).alias("qty_in_transit"),
        F.when(h == 70, 0.0).when(h == 71, None).otherwise(F.col("avg_unit_cost").cast("double")).alias("avg_unit_cost"),
    )


CLEAN_COLUMNS = ["transaction_date", "part_id", "dealer_id", "customer_type", "qty_sold", "unit_price", "discount_pct",
                 "revenue", "was_fulfilled", "backorder_qty"]


def _scratch(s: Star, label: str) -> str:
    return f"{checkpoint_dir(s.spark).rstrip('/')}/stocklens/{label}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- star schema, quality
@query
def dim_dealers(s): return s.dealers
@query
def dim_suppliers(s): return s.suppliers
@query
def dim_parts(s): return s.parts
@query
def fact_sales(s): return s.sales
@query
def fact_inventory(s): return s.inventory
@query
def fact_purchase_orders(s): return s.purchase_orders
@query
def dim_date(s):
    span = s.sales.agg(F.min("transaction_date").alias("a"), F.max("transaction_date").alias("b"))
    return calendar_between(span, "a", "b")
@query
def derived_sales(s):
    raw = s.sales.drop("revenue", "cogs")
    return derive_sales(raw, s.parts).select("transaction_date", "part_id", "dealer_id", "qty_sold", "revenue", "cogs", "gross_profit")
@query
def derived_inventory(s):
    raw = s.inventory.drop("qty_available", "total_stock_value")
    return derive_inventory(raw).select("snapshot_date", "part_id", "dealer_id", "qty_available", "total_stock_value")
@query
def derived_purchase_orders(s):
    raw = s.purchase_orders.drop("total_cost", "lead_time_actual", "lead_time_delta")
    return derive_purchase_orders(raw).select("po_number", "po_line", "part_id", "total_cost", "lead_time_actual", "lead_time_delta")
@query
def stored_sales(s):
    folder = _scratch(s, "warehouse")
    files.write_table(s.sales, "fact_sales", folder)
    return files.read_table(s.spark, "fact_sales", folder).select(
        "month", "transaction_date", "part_id", "dealer_id", "customer_type", "qty_sold", "unit_price", "revenue", "was_fulfilled")
def _stored(s: Star, df: DataFrame, table: str, references: dict | None = None, keys: bool = True) -> DataFrame:
    """The table after it was loaded in two batches of months, the later one twice."""
    folder = _scratch(s, "warehouse")
    day = PARTITION_DATE.get(table)
    if day is None:
        batches = [df, df]
    else:
        late = F.year(day) >= s.as_of.year - 1
        batches = [df.where(~late), df.where(late), df.where(late)]
    for batch in batches:
        files.replace_months(batch, table, folder, references, keys)
    return files.read_table(s.spark, table, folder)
@query
def stored_parts(s): return _stored(s, s.parts, "dim_parts").select("part_id", "part_number", "part_name", "standard_cost", "is_critical")
@query
def stored_suppliers(s): return _stored(s, s.suppliers, "dim_suppliers").select("supplier_id", "supplier_name", "country", "lead_time_days", "is_preferred")
@query
def stored_dealers(s): return _stored(s, s.dealers, "dim_dealers").select("dealer_id", "dealer_name", "region")
@query
def stored_inventory(s):
    known = {"part_id": s.parts, "dealer_id": s.dealers}
    return _stored(s, s.inventory, "fact_inventory", known).select("month", "snapshot_date", "part_id", "dealer_id", "qty_available", "total_stock_value")
@query
def stored_sales_months(s):
    # The tables have no sale number: keys are not checked.
    known = {"part_id": s.parts, "dealer_id": s.dealers}
    return _stored(s, s.sales, "fact_sales", known, False).groupBy("month", "dealer_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue"))
@query
def stored_purchase_orders(s):
    known = {"part_id": s.parts, "supplier_id": s.suppliers, "dealer_id": s.dealers}
    return _stored(s, s.purchase_orders, "fact_purchase_orders", known, False).select(
        "month", "po_number", "po_line", "part_id", "supplier_id", "order_date", "qty_ordered", "total_cost", "po_status")
@query
def stored_abc_xyz(s):
    return _stored(s, abc_xyz_table(_classified(s), s.as_of), "analytics_abc_xyz", {"part_id": s.parts}).select(
        "month", "part_id", "dealer_id", "combined_class", "annual_revenue")
@query
def stored_policies(s):
    return _stored(s, policy_table(_policies(s), s.as_of), "analytics_reorder_policy", {"part_id": s.parts}).select(
        "month", "effective_date", "part_id", "dealer_id", "safety_stock_qty", "reorder_point", "economic_order_qty", "max_stock_level")
@query
def stored_forecasts(s):
    return _stored(s, forecast_table(forecast.naive_forecast(s.sales)), "fact_demand_forecast", {"part_id": s.parts}).select(
        "month", "forecast_date", "part_id", "dealer_id", "forecast_qty", "model_used")
@query
def distinct_parts_sketch(s):
    rows = s.sales.join(s.parts.select("part_id", "category"), "part_id").select("part_id", "category", "dealer_id", "transaction_date")
    stored = materialize(sketches.distinct_sketches(rows, "part_id", ("category", "dealer_id")), "sketches")
    return sketches.distinct_audit(rows, stored, "part_id", ("category",))
@query
def quality_unique(s): return quality.check_unique(s.purchase_orders, ["po_number", "po_line"])
@query
def quality_foreign_key(s): return quality.check_foreign_key(s.sales, "part_id", s.parts.where("is_active"))
@query
def quality_predicate(s):
    return quality.check_predicate(s.inventory, "qty_available >= 0").select("snapshot_date", "part_id", "dealer_id", "qty_available")
@query
def quality_rules(s): return quality.check_rules(s.sales, quality.sales_rules(s.as_of - dt.timedelta(days=365)))
@query
def quality_not_null(s):
    return quality.check_not_null(s.purchase_orders, ["po_number", "actual_receipt_date", "lead_time_actual", "po_status"])
@query
def quality_defaults(s):
    open_as_null = s.purchase_orders.withColumns(
        {"po_status": F.when(F.col("po_status") == "Closed", "Closed"), "qty_received": F.when(F.col("po_status") == "Closed", F.col("qty_ordered"))}
    )
    filled = apply_defaults(open_as_null, "fact_purchase_orders")
    return filled.groupBy("part_id", "po_status").agg(F.count(F.lit(1)).alias("orders"), F.sum("qty_received").alias("qty_received"))
@query
def quality_upsert(s):
    current = s.parts.select("part_id", "part_name", "list_price", F.lit("2001-01-01").cast("timestamp").alias("updated_at"))
    base = s.parts.where("is_critical").select("part_id", "part_name", "list_price")
    first = base.withColumns({"list_price": (F.col("list_price") * 2).cast("decimal(12,2)"), "seq": F.lit(1)})
    second = base.withColumns({"part_name": F.upper("part_name"), "seq": F.lit(2)}).where("list_price > 950")
    new = base.withColumns({"part_id": F.col("part_id") + 10_000_000, "seq": F.lit(1)})
    updates = first.unionByName(second).unionByName(new)
    out = quality.upsert_latest(current, updates, ["part_id"], "seq", now=dt.datetime(2002, 1, 1))
    return out.withColumn("updated_at", F.to_date("updated_at"))

# ---------------------------------------------------------------- cleaning
@query
def clean_sales(s): return cleaning.clean_sales(_dirty_sales(s), s.as_of).clean
@query
def clean_sales_report(s): return cleaning.clean_sales(_dirty_sales(s), s.as_of).report.rows.drop("step")
@query
def clean_inventory(s): return cleaning.clean_inventory(_dirty_inventory(s)).clean
@query
def clean_inventory_report(s): return cleaning.clean_inventory(_dirty_inventory(s)).report.rows.drop("step")
@query
def clean_csv_file(s):
    raw, out = _scratch(s, "csv_in"), _scratch(s, "csv_out")
    _faulty_sales(s).write.csv(raw, header=True)
    cleaning.clean_file(s.spark, raw, out, "sales", as_of=s.as_of, order_by=None)  # the files have no order of their own
    return files.read_csv(s.spark, out, files.RAW_SALES).select(
        F.col("transaction_date").cast("date").alias("transaction_date"), *CLEAN_COLUMNS[1:])
@query
def clean_csv_stream(s):
    raw, out, state = (_scratch(s, n) for n in ("stream_in", "stream_out", "stream_state"))
    _faulty_sales(s).write.csv(raw, header=True)
    clean_stream(s.spark, raw, out, state, "sales", columns=CLEAN_COLUMNS, as_of=s.as_of).awaitTermination()
    return read_cleaned(s.spark, out).select(*CLEAN_COLUMNS)
@query
def clean_csv_stream_batches(s):
    """The same files, one to a micro-batch."""
    raw, out, state = (_scratch(s, n) for n in ("stream_in", "stream_out", "stream_state"))
    _faulty_sales(s).repartition(7).write.csv(raw, header=True)
    clean_stream(s.spark, raw, out, state, "sales", columns=CLEAN_COLUMNS, max_files=1, as_of=s.as_of).awaitTermination()
    return read_cleaned(s.spark, out).select(*CLEAN_COLUMNS)

# ---------------------------------------------------------------- KPI queries
@query
def inventory_turnover(s): return kpi.inventory_turnover(s.sales, s.inventory, s.parts, s.as_of)
@query
def fill_rate(s): return kpi.fill_rate(s.sales, s.dealers, s.as_of)
@query
def dead_stock(s): return kpi.dead_stock(s.inventory, s.sales, s.parts, s.dealers, s.as_of)
@query
def stock_health(s): return kpi.stock_health(s.inventory, s.sales, s.parts, s.dealers, s.as_of)
@query
def supplier_lead_time(s): return kpi.supplier_lead_time(s.purchase_orders, s.suppliers)
@query
def abc_revenue(s): return kpi.abc_revenue(s.sales, s.parts, s.dealers, s.as_of)
@query
def monthly_trend(s): return kpi.monthly_trend(s.sales, s.parts)
@query
def stockout_risk(s): return kpi.stockout_risk(s.inventory, _policy_history(s), s.parts, s.dealers)
@query
def stockout_risk_view(s):
    name = f"stockout_risk_{uuid.uuid4().hex}"
    kpi.create_stockout_view(name, inventory=s.inventory, policy=_policy_history(s), parts=s.parts, dealers=s.dealers)
    return s.spark.table(name)
@query
def service_level(s): return kpi.service_level(s.sales)

@query
def stockout_risk_history(s): return kpi.stockout_risk_history(s.inventory, _policy_versions(s), s.parts, s.dealers)


def _earlier(s: Star) -> dt.date:
    """A day well before the last transaction: rows after it must not count."""
    return s.as_of - dt.timedelta(days=200)
@query
def inventory_turnover_earlier(s): return kpi.inventory_turnover(s.sales, s.inventory, s.parts, _earlier(s))
@query
def fill_rate_earlier(s): return kpi.fill_rate(s.sales, s.dealers, _earlier(s))
@query
def dead_stock_earlier(s): return kpi.dead_stock(s.inventory, s.sales, s.parts, s.dealers, _earlier(s))
@query
def stock_health_earlier(s): return kpi.stock_health(s.inventory, s.sales, s.parts, s.dealers, _earlier(s))
@query
def abc_revenue_earlier(s): return kpi.abc_revenue(s.sales, s.parts, s.dealers, _earlier(s))
@query
def demand_windows_earlier(s): return features.demand_windows(s.sales, as_of=_earlier(s))

# ---------------------------------------------------------------- key x day state, periods, subtotals
def _stored_state(s: Star) -> DataFrame:
    """The state of two batches that share every part, dealer and day, the second one loaded twice."""
    folder, late = _scratch(s, "key_day"), F.col("order_source").isin("1-URGENT", "2-HIGH")
    both = materialize(key_day.key_day_state(s.sales.withColumn("_late", late), ("_late",)), "batches")  # the sales are read once
    states = [both.where(rows).drop("_late") for rows in ("NOT _late", "_late")]
    for state, batch in ((states[0], "a"), (states[1], "b"), (states[1], "b")):
        key_day.write_batch(state, folder, batch)
    return key_day.read_state(s.spark, folder, states[0].schema)
@query
def key_day_state(s): return s.state
@query
def key_day_state_update(s): return _stored_state(s)
@query
def key_day_demand_windows(s): return features.demand_windows(_stored_state(s), as_of=s.as_of)
@query
def key_day_fill_rate(s): return kpi.fill_rate(s.state, s.dealers, s.as_of)
@query
def key_day_service_level(s): return kpi.service_level(s.state)
PERIOD_VALUES = {"units": "qty_sold", "revenue": "revenue"}
@query
def period_table(s): return periods.period_table(s.state, PERIOD_VALUES, ("dealer_id",))
@query
def period_table_total(s): return periods.period_table(s.state, PERIOD_VALUES)
@query
def period_table_category(s):
    per_part = s.state.groupBy("part_id", "transaction_date").agg(F.sum("qty_sold").alias("qty_sold"), F.sum("revenue").alias("revenue"))
    return periods.period_table(per_part.join(s.parts.select("part_id", "category"), "part_id"), PERIOD_VALUES, ("category",))
@query
def measure_rollup_dealer_type(s):
    by = ("dealer_id", "customer_type")
    return cube.measure_cube(s.sales, cube.sales_measures(s.sales, s.as_of), by, cube.rollup_sets(by))
@query
def measure_cube_category(s):
    rows = s.state.join(s.parts.select("part_id", "category", "brand"), "part_id").withColumn("year", F.year("transaction_date"))
    return cube.measure_cube(rows, cube.sales_measures(rows, s.as_of), ("category", "dealer_id", "year"))
@query
def measure_rollup_stock(s):
    by = ("dealer_id", "category", "brand")
    rows = _stock(s).join(s.parts.select("part_id", "category", "brand"), "part_id")
    return cube.measure_cube(rows, cube.stock_measures(s.as_of), by, cube.rollup_sets(by))

# ---------------------------------------------------------------- latest row, ordered
@query
def latest_inventory(s):
    return latest.latest_row(s.inventory, "snapshot_date", ["snapshot_date", "qty_on_hand", "qty_available", "total_stock_value"])
@query
def latest_inventory_as_of(s):
    day = s.as_of - dt.timedelta(days=120)
    return latest.latest_row(s.inventory, "snapshot_date", ["snapshot_date", "qty_on_hand"], as_of=day)
@query
def last_non_null_inventory(s):
    gaps = s.inventory.withColumn("qty_in_transit", F.when(F.col("qty_on_hand") > 60, F.col("qty_in_transit")))
    return latest.last_non_null(gaps, "snapshot_date", ["qty_on_hand", "qty_in_transit"])
@query
def last_sale(s): return latest.last_event(s.sales, "transaction_date", "last_sale_date")
@query
def running_revenue(s):
    per_key = s.sales.groupBy("part_id", "dealer_id").agg(F.sum("revenue").alias("revenue"))
    return ordered.prefix_sum(per_key, {"running": "revenue"}, [F.desc("revenue"), F.asc("part_id"), F.asc("dealer_id")])
@query
def running_dealer_units(s):
    daily = s.sales.groupBy("dealer_id", "transaction_date").agg(F.sum("qty_sold").alias("qty"))
    return ordered.prefix_sum(daily, {"running_qty": "qty"}, [F.asc("transaction_date")], ["dealer_id"])
@query
def price_quartiles(s):
    return ordered.exact_quantiles(s.sales, ["part_id"], "unit_price", {"q1": 0.25, "median": 0.5, "q3": 0.75})
@query
def dense_monthly_units(s):
    monthly = forecast.monthly_demand(s.sales, ["part_id"])
    return ordered.densify(monthly, ["part_id"], "month", "qty_sold")

# ---------------------------------------------------------------- classification
@query
def abc_running(s):
    per_part = s.sales.groupBy("part_id").agg(F.sum("revenue").alias("revenue"))
    return classify.classify_abc(per_part, "revenue", ["part_id"])
@query
def abc_preceding(s):
    per_part = s.sales.groupBy("part_id").agg(F.sum("revenue").alias("revenue"))
    return classify.classify_abc(per_part, "revenue", ["part_id"], boundary="preceding")
@query
def xyz_by_part(s):
    return classify.classify_xyz(forecast.monthly_demand(s.sales, ["part_id"]), ["part_id"], "month")
@query
def xyz_by_part_dealer(s):
    return classify.classify_xyz(forecast.monthly_demand(s.sales), period="month")
@query
def abc_xyz(s): return _classified(s)
@query
def abc_xyz_summary(s): return classify.abc_xyz_summary(_classified(s))
@query
def abc_xyz_actions(s):
    return classify.with_actions(_classified(s)).select("part_id", "dealer_id", "combined_class", "segment_label", "recommended_action")

@query
def pipeline_abc_xyz(s):
    return run_pipeline(s.spark, {"sales": _dirty_sales(s)}, "classify", as_of=s.as_of)["abc_xyz"]
@query
def pipeline_outputs(s):
    out = run_pipeline(
        s.spark, {"sales": _dirty_sales(s), "inventory": s.inventory, "parts": s.parts, "purchase_orders": s.purchase_orders},
        "score", as_of=s.as_of, output=_scratch(s, "run"))
    return s.spark.read.parquet(f"{out['run_dir']}/{files.OUTPUT_FILES['stockout_scores']}")

# ---------------------------------------------------------------- replenishment
@query
def demand_stats(s): return replenish.demand_stats(s.sales)
@query
def lead_time_stats(s): return replenish.lead_time_stats(s.purchase_orders)
@query
def reorder_policies(s): return _policies(s)
@query
def reorder_policies_fallback(s):
    return replenish.reorder_policies(s.sales, files.empty_purchase_orders(s.spark))

# ---------------------------------------------------------------- forecasting
@query
def monthly_demand(s): return forecast.monthly_demand(s.sales)
@query
def holdout_split(s): return forecast.split_holdout(_branded(s), SERIES_KEYS)
@query
def naive_forecast(s): return forecast.naive_forecast(_branded(s), SERIES_KEYS)
@query
def naive_forecast_short(s):
    # Part and dealer grain: only series with a year of history are eligible.
    return forecast.naive_forecast(s.sales)
@query
def naive_accuracy(s): return forecast.accuracy_summary(forecast.naive_forecast(_branded(s), SERIES_KEYS))
@query
def demand_forecast(s): return forecast.forecast(_branded(s), SERIES_KEYS)
@query
def forecast_accuracy(s): return forecast.accuracy_summary(forecast.forecast(_branded(s), SERIES_KEYS))
@query
def forecast_vs_actual(s): return forecast.holdout_comparison(_branded(s), SERIES_KEYS)
@query
def demand_forecast_part_dealer(s): return forecast.forecast(s.sales)
@query
def forecast_accuracy_part_dealer(s): return forecast.accuracy_summary(forecast.forecast(s.sales))
@query
def forecast_vs_actual_part_dealer(s): return forecast.holdout_comparison(s.sales)

# ---------------------------------------------------------------- stock-out model
@query
def demand_windows(s): return features.demand_windows(s.sales, as_of=s.as_of)
@query
def supplier_performance(s): return features.supplier_performance(s.purchase_orders)
@query
def stockout_features(s): return _features(s)
@query
def stockout_features_fallback(s):
    return features.build_features(s.inventory, s.sales, files.empty_purchase_orders(s.spark), as_of=s.as_of)
def _rule_scores(s):
    base = features.build_features(s.inventory, s.state, files.empty_purchase_orders(s.spark), as_of=s.as_of)
    # A graded score with many ties, independent of the target's own demand window.
    return base.select(
        "part_id", "dealer_id", features.TARGET_COL,
        num_round(1.0 / (1.0 + F.greatest(F.col("qty_available"), F.lit(0))), 6).alias("probability"))
@query
def ranking_metrics(s): return stockout.evaluate(materialize(_rule_scores(s), "scores"))
@query
def classification_report(s): return stockout.classification_report(_rule_scores(s), threshold=0.05)
@query
def ordered_folds(s): return stockout.assign_folds(s.inventory.select("snapshot_date", "part_id", "dealer_id"), ["snapshot_date", "part_id", "dealer_id"])
@query
def future_stockout_label(s): return future.label_future_stockout(s.inventory, s.state)
@query
def future_label_counts(s): return future.label_counts(future.label_future_stockout(s.inventory, s.state))
@query
def future_label_folds(s):
    """The labelled snapshots in time order, cut into expanding folds: rows, stock-outs and days of each."""
    labelled = materialize(future.label_future_stockout(s.inventory, s.state), "labelled")
    folds = stockout.assign_folds(labelled, ["snapshot_date", "part_id", "dealer_id"])
    return folds.groupBy("fold").agg(
        F.count(F.lit(1)).alias("snapshots"), F.sum(future.FUTURE_COL).alias("stockouts"),
        F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day"))
@query
def snapshot_demand(s): return future.demand_before(s.inventory, s.state)
@query
def stockout_scores(s):
    fixed = materialize(_features(s), "features")
    return stockout.score_inventory(stockout.train_stockout(fixed), fixed)
@query
def stockout_model_metrics(s):
    fixed = materialize(_features(s), "features")
    return stockout.evaluate(stockout.predict(stockout.train_stockout(fixed), fixed))
@query
def stockout_feature_importance(s):
    fixed = materialize(_features(s), "features")
    return stockout.feature_importance(stockout.StockoutModel(stockout.train_forest(fixed)), fixed)
@query
def stockout_cross_validation(s):
    fixed = materialize(_features(s), "features")
    return stockout.ordered_cv(fixed, ["part_id", "dealer_id"])

# ---------------------------------------------------------------- BI measures
DEALER = ("dealer_id",)
@query
def m_total_revenue(s): return measures.total_revenue(s.sales, DEALER)
@query
def m_revenue_vs_prior(s): return measures.revenue_vs_prior(s.sales, s.as_of, DEALER)
@query
def m_gross_margin_pct(s): return measures.gross_margin_pct(s.sales, ("dealer_id", "customer_type"))
@query
def m_active_sku_count(s): return measures.active_sku_count(s.inventory, s.parts, DEALER)
@query
def m_fill_rate_pct(s): return measures.fill_rate_pct(s.sales, ("customer_type",))
@query
def m_backorder_rate_pct(s): return measures.backorder_rate_pct(s.sales, ("customer_type",))
@query
def m_total_inventory_value(s): return measures.total_inventory_value(s.inventory, ("snapshot_date",))
@query
def m_dead_stock_value(s): return measures.dead_stock_value(s.inventory, s.as_of, DEALER)
@query
def m_dead_stock_pct(s): return measures.dead_stock_pct(s.inventory, s.as_of, DEALER)
@query
def m_inventory_turnover(s): return measures.inventory_turnover_ratio(s.sales, s.inventory, s.as_of, DEALER)
@query
def m_days_on_hand(s): return measures.days_on_hand(s.sales, s.inventory, s.as_of, DEALER)
@query
def m_avg_coverage_days(s): return measures.avg_coverage_days(_stock(s), s.sales, s.as_of, DEALER)
@query
def m_parts_at_risk(s): return measures.parts_at_risk(_stock(s), _policies(s), DEALER)
@query
def m_units_sold(s): return measures.units_sold(s.sales, DEALER)
@query
def m_avg_monthly_demand(s): return measures.avg_monthly_demand_per_part(s.sales, DEALER)
@query
def m_demand_mom_growth(s): return measures.demand_mom_growth_pct(s.sales, s.as_of, DEALER)
@query
def m_avg_forecast_mape(s): return measures.avg_forecast_mape(forecast.naive_forecast(_branded(s), SERIES_KEYS), DEALER)
@query
def m_a_class_share(s): return measures.a_class_revenue_share_pct(s.sales, _classified(s), DEALER)
@query
def m_supplier_on_time(s): return measures.on_time_pct(s.purchase_orders, ("supplier_id",))
@query
def m_avg_lead_time(s): return measures.avg_lead_time(s.purchase_orders, ("supplier_id",))
@query
def m_lead_time_std(s): return measures.lead_time_std(s.purchase_orders, ("supplier_id",))
@query
def m_total_po_value(s): return measures.total_po_value(s.purchase_orders, ("supplier_id",))
@query
def m_avg_delay_days(s): return measures.avg_delay_days(s.purchase_orders, ("supplier_id",))
@query
def m_next_month_forecast(s):
    return measures.next_month_forecast_qty(forecast.naive_forecast(_branded(s), SERIES_KEYS), s.as_of, DEALER)
@query
def m_urgency_score(s): return measures.urgency_score(_stock(s), s.state, _policies(s), s.parts, s.as_of, DEALER)
@query
def m_recommended_order_qty(s): return measures.recommended_order_qty(_stock(s), _policies(s), DEALER)
@query
def m_replenishment_cost(s): return measures.replenishment_cost(_stock(s), _policies(s), s.parts, DEALER)

# ---------------------------------------------------------------- dashboard datasets
@query
def v_monthly_revenue_cogs(s): return dashboards.monthly_revenue_cogs(s.sales)
@query
def v_revenue_by_category(s): return dashboards.revenue_by_category(s.sales, s.parts)
@query
def v_fill_by_branch(s): return dashboards.fill_by_branch(s.sales, s.dealers, s.as_of)
@query
def v_revenue_by_customer_type(s): return dashboards.revenue_by_customer_type(s.sales)
@query
def v_top_parts(s): return dashboards.top_parts(s.sales, s.parts)
@query
def v_segment_counts(s): return dashboards.segment_counts(_classified(s))
@query
def v_stock_by_age(s): return dashboards.stock_by_age(s.inventory, s.sales, s.as_of)
@query
def v_dead_stock_priority(s): return dashboards.dead_stock_priority(s.inventory, s.sales, s.parts, s.dealers, s.as_of)
@query
def v_health_counts(s): return dashboards.health_counts(s.inventory, s.sales, s.parts, s.dealers, s.as_of)
@query
def v_class_heatmap(s): return dashboards.class_heatmap(_classified(s))
@query
def v_top_category_demand(s): return dashboards.top_category_demand(s.sales, s.parts)
@query
def v_pareto(s): return dashboards.pareto(_classified(s))
@query
def v_xyz_distribution(s): return dashboards.xyz_distribution(_classified(s))
@query
def v_units_by_customer_type(s): return dashboards.units_by_customer_type(s.sales)
@query
def v_supplier_on_time(s): return dashboards.supplier_on_time(s.purchase_orders, s.suppliers, s.as_of)
@query
def v_lead_time_scatter(s): return dashboards.lead_time_scatter(s.purchase_orders, s.suppliers)
@query
def v_supplier_scorecard(s): return dashboards.supplier_scorecard(s.purchase_orders, s.suppliers)
@query
def v_late_deliveries(s): return dashboards.late_deliveries_by_month(s.purchase_orders, s.suppliers)
@query
def v_action_list(s):
    abc = _classified_state(s)
    return dashboards.action_list(s.inventory, _policies(s, abc), s.parts, abc)
@query
def v_action_list_by_risk(s):
    abc = _classified_state(s)
    scores = _rule_scores(s).select("part_id", "dealer_id", F.col("probability").alias("stockout_probability"))
    return dashboards.action_list(s.inventory, _policies(s, abc), s.parts, abc, scores)
@query
def v_kpi_cards(s):
    abc = _classified_state(s)
    policies = materialize(_policies(s, abc), "policies")
    forecasts = materialize(forecast.naive_forecast(_branded(s), SERIES_KEYS), "forecasts")
    return dashboards.kpi_cards(s.state, s.inventory, s.purchase_orders, s.parts, policies, s.as_of, abc, forecasts)
