"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
input and the cores. Each query runs once, in full, into a no-op sink. ``pipeline``
goes from raw sales to policies and risk ranks; model training is timed apart.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stocklens.operators import classify, cleaning, features, kpi, replenish, stockout  # noqa: E402
from stocklens.plans import registry  # noqa: E402
from stocklens.sources.scratch import materialize  # noqa: E402
from stocklens.sources.star import Star  # noqa: E402

HEADLINE = (
    "fill_rate", "inventory_turnover", "dead_stock", "stock_health", "supplier_lead_time", "abc_revenue",
    "monthly_trend", "service_level", "abc_xyz", "abc_xyz_summary", "reorder_policies", "stockout_risk",
    "clean_sales", "clean_sales_report", "clean_inventory", "xyz_by_part_dealer", "price_quartiles",
    "naive_forecast", "demand_forecast", "stockout_features", "ranking_metrics", "m_revenue_vs_prior",
    "m_urgency_score", "v_action_list", "v_kpi_cards",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # The JIT does not compile methods above 8000 bytes; split such stages instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def pipeline(s: Star) -> tuple[float, float]:
    """Seconds for clean + classify + policy + risk + features, and for training + scoring."""
    start = time.perf_counter()
    sales = materialize(cleaning.clean_sales(s.sales, s.as_of).clean, "bench_sales")
    stock = cleaning.clean_inventory(s.inventory).clean
    abc = materialize(classify.abc_xyz(sales, as_of=s.as_of), "bench_abc")
    policies = materialize(replenish.reorder_policies(sales, s.purchase_orders, abc, s.parts), "bench_policies")
    drain(kpi.stockout_risk(stock, policies, s.parts, s.dealers))
    matrix = materialize(features.build_features(stock, sales, s.purchase_orders, policies, abc, s.as_of), "bench_features")
    prepared = time.perf_counter() - start
    start = time.perf_counter()
    drain(stockout.score_inventory(stockout.train_stockout(matrix), matrix))
    return prepared, time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    drain(Star(spark, folder).sales)  # start-up: code generation and file listing
    only = sys.argv[1:] or [*HEADLINE, "pipeline"]
    times: dict[str, float] = {}
    for name in only:
        if name == "pipeline":
            times["pipeline"], times["train_and_score"] = (round(t, 3) for t in pipeline(Star(spark, folder)))
            continue
        start = time.perf_counter()
        drain(registry.run(name, spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
