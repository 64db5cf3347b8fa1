"""The registered queries as plain SQL over the same tables, for cross-checking."""

from __future__ import annotations


def r(x: str, n: int = 6) -> str:
    """Half away from zero on NUMERIC semantics."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,9)), {n}) AS DOUBLE)"


def he(x: str, n: int) -> str:
    """Half to even for non-negative numbers, by exact integer arithmetic."""
    nano = f"CAST(CAST({x} AS DECIMAL(28,9)) * 1000000000 AS HUGEINT)"
    unit = 10 ** (9 - n)
    q, rest = f"({nano} // {unit})", f"({nano} % {unit})"
    up = f"CASE WHEN 2 * {rest} > {unit} OR (2 * {rest} = {unit} AND {q} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CAST({q} + {up} AS DOUBLE) / {10 ** n}.0"


def std(n: str, s: str, q: str) -> str:
    """Sample deviation from exact integer sums; null below two observations."""
    spread = f"CAST(CAST({n} AS HUGEINT) * {q} - CAST({s} AS HUGEINT) * {s} AS DOUBLE)"
    return f"CASE WHEN {n} > 1 THEN sqrt({spread} / (CAST({n} AS DOUBLE) * (CAST({n} AS DOUBLE) - 1))) END"


D = "(SELECT d FROM today)"

STAR = """
dim_dealers AS (SELECT r_regionkey AS dealer_id, r_name AS dealer_name, r_name AS region FROM region),
dim_suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS country,
         CASE s_suppkey % 3 WHEN 0 THEN 'OEM' WHEN 1 THEN 'OES' ELSE 'Aftermarket' END AS supplier_type,
         CAST(5 + s_suppkey % 38 AS INT) AS lead_time_days, s_acctbal > 5000 AS is_preferred
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
dim_parts AS (
  SELECT p_partkey AS part_id, 'P-' || CAST(p_partkey AS VARCHAR(20)) AS part_number, p_name AS part_name,
         p_brand AS brand, p_type AS category, CAST(p_retailprice * 0.6 AS DECIMAL(12,2)) AS standard_cost,
         CAST(p_retailprice AS DECIMAL(12,2)) AS list_price, p_size > 42 AS is_critical, p_size > 2 AS is_active
  FROM part),
fact_sales AS (
  SELECT *, CAST(ROUND(qty_sold * unit_price * (100 - discount_pct) * 0.01, 2) AS DECIMAL(16,2)) AS revenue,
         CASE WHEN was_fulfilled THEN 0 ELSE qty_sold END AS backorder_qty
  FROM (
    SELECT CAST(l_shipdate AS DATE) AS transaction_date, l_partkey AS part_id, n_regionkey AS dealer_id,
           c_mktsegment AS customer_type, o_orderpriority AS order_source, CAST(l_quantity AS INT) AS qty_sold,
           CAST(CAST(FLOOR(l_extendedprice * 100 / l_quantity) AS BIGINT) * 0.01 AS DECIMAL(12,2)) AS unit_price,
           CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_pct,
           CAST(CAST(l_quantity AS INT) * CAST(p_retailprice * 0.6 AS DECIMAL(12,2)) AS DECIMAL(16,2)) AS cogs,
           l_returnflag <> 'R' AS was_fulfilled
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey) s),
fact_inventory AS (
  SELECT i.*, qty_on_hand - qty_reserved AS qty_available,
         CAST(qty_on_hand * avg_unit_cost AS DECIMAL(16,2)) AS total_stock_value,
         snapshot_date - CAST((part_id * 11 + dealer_id * 17) % 500 AS INT) AS last_movement_date
  FROM (
    SELECT snapshot_date, p_partkey AS part_id, r_regionkey AS dealer_id,
           CAST((p_partkey * 7 + r_regionkey * 13 + mo * 5) % 121 AS INT) AS qty_on_hand,
           CAST((p_partkey + mo) % 15 AS INT) AS qty_reserved,
           CAST((p_partkey * 3 + r_regionkey) % 40 AS INT) AS qty_in_transit,
           CAST(p_retailprice * 0.6 AS DECIMAL(12,2)) AS avg_unit_cost
    FROM part CROSS JOIN region CROSS JOIN (
      SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
             year(l_shipdate) * 12 + month(l_shipdate) AS mo
      FROM lineitem WHERE l_shipdate IS NOT NULL) m) i),
fact_purchase_orders AS (
  SELECT q.*, CAST(qty_ordered * unit_cost AS DECIMAL(16,2)) AS total_cost
  FROM (
    SELECT l_orderkey AS po_number, l_linenumber AS po_line, l_partkey AS part_id, l_suppkey AS supplier_id,
           n_regionkey AS dealer_id, CAST(o_orderdate AS DATE) AS order_date,
           CAST(o_orderdate AS DATE) + CAST(5 + l_suppkey % 38 AS INT) AS promised_date,
           CASE WHEN l_linestatus = 'F' THEN CAST(o_orderdate AS DATE)
                + CAST(5 + l_suppkey % 38 + (l_orderkey + l_linenumber) % 15 - 4 AS INT) END AS actual_receipt_date,
           CASE WHEN l_linestatus = 'F' THEN CAST(5 + l_suppkey % 38 + (l_orderkey + l_linenumber) % 15 - 4 AS INT) END AS lead_time_actual,
           CASE WHEN l_linestatus = 'F' THEN CAST((l_orderkey + l_linenumber) % 15 - 4 AS INT) END AS lead_time_delta,
           CAST(l_quantity AS INT) AS qty_ordered, CAST(p_retailprice * 0.6 AS DECIMAL(12,2)) AS unit_cost,
           CASE WHEN l_linestatus = 'F' THEN 'Closed' ELSE 'Open' END AS po_status
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey) q),
today AS (SELECT max(transaction_date) AS d FROM fact_sales)"""

LATEST = """
latest AS (
  SELECT part_id, dealer_id, max(snapshot_date) AS snapshot_date, arg_max(qty_on_hand, snapshot_date) AS qty_on_hand,
         arg_max(qty_available, snapshot_date) AS qty_available, arg_max(qty_in_transit, snapshot_date) AS qty_in_transit,
         arg_max(total_stock_value, snapshot_date) AS total_stock_value, arg_max(avg_unit_cost, snapshot_date) AS avg_unit_cost,
         arg_max(last_movement_date, snapshot_date) AS last_movement_date
  FROM fact_inventory GROUP BY part_id, dealer_id)"""

ABC = f"""
abc_month AS (
  SELECT part_id, dealer_id, date_trunc('month', transaction_date) AS m, SUM(revenue) AS rev, CAST(SUM(qty_sold) AS BIGINT) AS q
  FROM fact_sales WHERE transaction_date >= {D} - INTERVAL 12 MONTH GROUP BY ALL),
abc_n AS (SELECT COUNT(DISTINCT m) AS n FROM abc_month),
abc_key AS (SELECT part_id, dealer_id, SUM(rev) AS annual_revenue, SUM(q) AS s, SUM(q * q) AS qq FROM abc_month GROUP BY ALL),
abc_rank AS (
  SELECT k.*, n, CAST(s AS DOUBLE) / n AS mean, coalesce({std('n', 's', 'qq')}, 0) AS sd,
         CAST(annual_revenue AS DOUBLE) / CAST(SUM(annual_revenue) OVER () AS DOUBLE) * 100 AS revenue_pct,
         CAST(SUM(annual_revenue) OVER (ORDER BY annual_revenue DESC, part_id, dealer_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
           / CAST(SUM(annual_revenue) OVER () AS DOUBLE) * 100 AS cum_rev_pct
  FROM abc_key k, abc_n),
abc_class AS (
  SELECT *, CASE WHEN cum_rev_pct <= 80 THEN 'A' WHEN cum_rev_pct <= 95 THEN 'B' ELSE 'C' END AS abc,
         coalesce(sd / nullif(mean, 0), 9999) AS cov FROM abc_rank),
abc AS (
  SELECT part_id, dealer_id, annual_revenue, revenue_pct, cum_rev_pct, abc AS abc_class, mean AS avg_monthly_demand,
         sd AS demand_std, cov AS demand_cov,
         CASE WHEN cov <= 0.5 THEN 'X' WHEN cov <= 1.0 THEN 'Y' ELSE 'Z' END AS xyz_class,
         abc || CASE WHEN cov <= 0.5 THEN 'X' WHEN cov <= 1.0 THEN 'Y' ELSE 'Z' END AS combined_class
  FROM abc_class)"""

STATS = f"""
dstat AS (
  SELECT part_id, dealer_id, CAST(SUM(q) AS DOUBLE) / COUNT(*) AS avg_daily_demand,
         coalesce({std('COUNT(*)', 'SUM(q)', 'SUM(q * q)')}, 0) AS demand_std_daily
  FROM (SELECT part_id, dealer_id, transaction_date, CAST(SUM(qty_sold) AS BIGINT) AS q FROM fact_sales GROUP BY ALL) t
  GROUP BY part_id, dealer_id),
ltstat AS (
  SELECT part_id, CAST(SUM(l) AS DOUBLE) / COUNT(*) AS avg_lead_time_days,
         coalesce({std('COUNT(*)', 'SUM(l)', 'SUM(l * l)')}, 3.0) AS lead_time_std_dev
  FROM (SELECT part_id, CAST(lead_time_actual AS BIGINT) AS l FROM fact_purchase_orders
        WHERE actual_receipt_date IS NOT NULL AND lead_time_actual > 0) t
  GROUP BY part_id)"""


def policy(name: str, source: str, extra: str, z: str, cost: str, lead: str, lead_std: str) -> str:
    return f"""
{name}_a AS (
  SELECT d.part_id, d.dealer_id, avg_daily_demand, demand_std_daily, {lead} AS avg_lead_time_days,
         {lead_std} AS lead_time_std_dev, {extra} CAST({z} AS DOUBLE) AS service_level_z, CAST({cost} AS DOUBLE) AS unit_cost
  FROM {source}),
{name}_b AS (
  SELECT *, greatest(0, CAST(ceil(service_level_z * sqrt(avg_lead_time_days * (demand_std_daily * demand_std_daily)
           + (avg_daily_demand * avg_daily_demand) * (lead_time_std_dev * lead_time_std_dev))) AS BIGINT)) AS safety_stock_qty,
         CASE WHEN avg_daily_demand > 0 AND unit_cost > 0 THEN greatest(1, CAST(round_even(
           sqrt(2.0 * (avg_daily_demand * 365) * 25.0 / (unit_cost * 0.25)), 0) AS BIGINT)) ELSE 1 END AS economic_order_qty
  FROM {name}_a),
{name} AS (
  SELECT *, reorder_point + economic_order_qty AS max_stock_level FROM (
    SELECT *, greatest(1, CAST(ceil(avg_daily_demand * avg_lead_time_days + safety_stock_qty) AS BIGINT)) AS reorder_point
    FROM {name}_b) t)"""


POLICY = policy(
    "pol",
    "dstat d LEFT JOIN ltstat l ON d.part_id = l.part_id LEFT JOIN abc a ON d.part_id = a.part_id AND d.dealer_id = a.dealer_id"
    " LEFT JOIN dim_parts p ON d.part_id = p.part_id",
    "a.abc_class, p.is_critical, p.standard_cost,",
    "CASE WHEN a.abc_class = 'A' OR p.is_critical THEN 2.054 ELSE 1.645 END",
    "coalesce(p.standard_cost, 50.0)",
    "coalesce(l.avg_lead_time_days, 21.0)",
    "coalesce(l.lead_time_std_dev, 7.0)",
)
POLICY_BARE = policy("polx", "dstat d", "", "1.645", "50.0", "CAST(21.0 AS DOUBLE)", "CAST(7.0 AS DOUBLE)")


def _window(days: int) -> str:
    inside = f"FILTER (WHERE transaction_date >= {D} - {days})"
    n, s, q = f"COUNT(qty_sold) {inside}", f"SUM(CAST(qty_sold AS BIGINT)) {inside}", f"SUM(CAST(qty_sold AS BIGINT) * qty_sold) {inside}"
    return (
        f"CAST({s} AS BIGINT) AS qty_sold_{days}d, nullif({n}, 0) AS txn_count_{days}d, "
        f"CASE WHEN {n} > 0 THEN coalesce({std(n, s, q)}, 0) END AS demand_std_{days}d"
    )


WINDOWS = f"""
wins AS (SELECT part_id, dealer_id, {_window(30)}, {_window(60)}, {_window(90)}
         FROM fact_sales WHERE transaction_date >= {D} - 90 GROUP BY part_id, dealer_id)"""
PERF = """
perf AS (SELECT part_id, AVG(CASE WHEN lead_time_delta <= 0 THEN 1.0 ELSE 0.0 END) AS on_time_rate,
                AVG(lead_time_actual) AS avg_po_lead_time
         FROM fact_purchase_orders WHERE actual_receipt_date IS NOT NULL GROUP BY part_id)"""

DEMAND_FEATURES = f"""
  l.part_id, l.dealer_id, l.qty_on_hand, l.qty_available, l.qty_in_transit, {r('l.total_stock_value')} AS total_stock_value,
  qty_sold_30d, txn_count_30d, {r('demand_std_30d')} AS demand_std_30d, qty_sold_60d, txn_count_60d,
  {r('demand_std_60d')} AS demand_std_60d, qty_sold_90d, txn_count_90d, {r('demand_std_90d')} AS demand_std_90d,
  {r('qty_sold_30d / 30.0')} AS avg_daily_demand_30d, {r('qty_sold_90d / 90.0')} AS avg_daily_demand_90d,
  {r('CAST(qty_sold_30d AS DOUBLE) / 30.0 - CAST(qty_sold_90d AS DOUBLE) / 90.0')} AS demand_trend,
  {r('least(coalesce(CAST(l.qty_available AS DOUBLE) / nullif(CAST(qty_sold_30d AS DOUBLE) / 30.0, 0), 999), 365)')} AS days_coverage"""
TARGET = "CASE WHEN l.qty_available < CAST(qty_sold_30d AS DOUBLE) / 30.0 * 14 THEN 1 ELSE 0 END AS will_stockout_14d"
BARE_FEATURES = f"""
barefeat AS (
  SELECT {DEMAND_FEATURES}, CAST(0 AS BIGINT) AS stock_vs_rop, CAST(0 AS DOUBLE) AS safety_stock_coverage_days,
         CAST(21 AS DOUBLE) AS avg_lead_time_days, CAST(7 AS DOUBLE) AS lead_time_std_dev, CAST(0.8 AS DOUBLE) AS on_time_rate,
         CAST(21 AS DOUBLE) AS avg_po_lead_time, 2 AS abc_class, 2 AS xyz_class, 8 AS combined_class, {TARGET}
  FROM latest l LEFT JOIN wins w ON l.part_id = w.part_id AND l.dealer_id = w.dealer_id)"""
SCORES = """
scores AS (SELECT part_id, dealer_id, will_stockout_14d AS y,
                  CAST(round(CAST(1.0 / (1.0 + greatest(qty_available, 0)) AS DECIMAL(28,9)), 6) AS DOUBLE) AS p FROM barefeat)"""

MOVES = f"""
moves AS (
  SELECT l.*, coalesce(s.last_sale, l.last_movement_date) AS last_movement,
         CAST({D} - coalesce(s.last_sale, l.last_movement_date) AS INT) AS idle
  FROM latest l LEFT JOIN (SELECT part_id, dealer_id, max(transaction_date) AS last_sale FROM fact_sales GROUP BY ALL) s
       ON l.part_id = s.part_id AND l.dealer_id = s.dealer_id)"""

HEALTH = f"""
health AS (
  SELECT l.part_id, l.dealer_id, l.qty_on_hand, l.total_stock_value, coalesce(CAST(qty AS BIGINT), 0) AS qty,
         coalesce(daily, 0) AS daily
  FROM latest l LEFT JOIN (
    SELECT part_id, dealer_id, SUM(qty_sold) AS qty, {r('CAST(SUM(qty_sold) AS DOUBLE) / 90', 4)} AS daily
    FROM fact_sales WHERE transaction_date >= {D} - 90 GROUP BY ALL) d
    ON l.part_id = d.part_id AND l.dealer_id = d.dealer_id),
health2 AS (
  SELECT *, CASE WHEN daily = 0 THEN 9999 ELSE {r('qty_on_hand / nullif(daily, 0)', 0)} END AS days_of_stock,
         CASE WHEN daily = 0 THEN 'No Demand' WHEN qty_on_hand / daily > 180 THEN 'Overstock'
              WHEN qty_on_hand / daily > 90 THEN 'High Stock' WHEN qty_on_hand / daily < 14 THEN 'Low Stock'
              ELSE 'Normal' END AS stock_health FROM health)"""

DIRTY = """
faulty AS (
  SELECT order_source,
         CASE WHEN qty_sold = 7 AND discount_pct = 1 THEN 'not-a-date' WHEN qty_sold = 11 AND discount_pct = 2 THEN '2099-01-01'
              ELSE CAST(transaction_date AS VARCHAR) END AS transaction_date,
         part_id, dealer_id, customer_type,
         CASE WHEN qty_sold = 23 AND discount_pct = 4 THEN 0 WHEN qty_sold = 29 AND discount_pct = 5 THEN -3 ELSE qty_sold END AS qty_sold,
         CASE WHEN qty_sold = 31 AND discount_pct = 6 THEN 0.0 WHEN qty_sold = 47 AND discount_pct = 10 THEN CAST(unit_price AS DOUBLE) * 1000
              ELSE CAST(unit_price AS DOUBLE) END AS unit_price,
         CASE WHEN qty_sold = 37 AND discount_pct = 7 THEN 150.0 WHEN qty_sold = 41 AND discount_pct = 8 THEN -5.0
              WHEN qty_sold = 43 AND discount_pct = 9 THEN NULL ELSE CAST(discount_pct AS DOUBLE) END AS discount_pct,
         CASE WHEN qty_sold = 19 AND discount_pct = 3 THEN NULL ELSE CAST(revenue AS DOUBLE) END AS revenue,
         was_fulfilled, backorder_qty
  FROM fact_sales),
dirty AS (
  SELECT transaction_date, part_id, dealer_id, customer_type, qty_sold, unit_price, discount_pct, revenue, was_fulfilled, backorder_qty FROM faulty
  UNION ALL
  SELECT transaction_date, part_id, dealer_id, CASE WHEN qty_sold > 25 THEN 'AAA COPY' ELSE customer_type END, qty_sold, unit_price,
         discount_pct, revenue, was_fulfilled, backorder_qty FROM faulty WHERE order_source = '1-URGENT'),
dated AS (SELECT *, TRY_CAST(transaction_date AS DATE) AS day FROM dirty),
live AS (SELECT * FROM dated WHERE day <= (SELECT d FROM today) AND revenue IS NOT NULL AND part_id IS NOT NULL
         AND dealer_id IS NOT NULL AND qty_sold IS NOT NULL AND unit_price IS NOT NULL),
firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY day, part_id, dealer_id, qty_sold, unit_price
      ORDER BY CAST(customer_type IS NULL AS INT) + CAST(discount_pct IS NULL AS INT), customer_type NULLS FIRST, discount_pct NULLS FIRST, revenue NULLS FIRST, was_fulfilled, backorder_qty) AS rn
    FROM live) t WHERE rn = 1),
valid AS (SELECT * REPLACE (greatest(least(discount_pct, CASE WHEN discount_pct IS NULL THEN NULL ELSE 100 END),
                            CASE WHEN discount_pct IS NULL THEN NULL ELSE 0 END) AS discount_pct),
                 coalesce(discount_pct BETWEEN 0 AND 100, FALSE) AS disc_ok
          FROM firsts WHERE qty_sold > 0 AND unit_price > 0),
lims AS (SELECT part_id, quantile_cont(unit_price, 0.25) AS q1, quantile_cont(unit_price, 0.75) AS q3 FROM valid GROUP BY part_id),
judged AS (SELECT v.*, unit_price < q1 - 3.0 * (q3 - q1) OR unit_price > q3 + 3.0 * (q3 - q1) AS outlier
           FROM valid v JOIN lims l ON v.part_id = l.part_id)"""

DIRTY_INV = """
dirtyinv AS (
  SELECT TRY_CAST(CASE WHEN qty_on_hand = 50 AND qty_reserved = 3 THEN 'INVALID' ELSE CAST(snapshot_date AS VARCHAR) END AS DATE) AS snapshot_date,
         part_id, dealer_id, CASE WHEN qty_on_hand = 60 THEN -10 ELSE qty_on_hand END AS qty_on_hand,
         CASE WHEN qty_reserved = 4 THEN -5 ELSE qty_reserved END AS qty_reserved,
         CASE WHEN qty_in_transit = 5 THEN -1 ELSE qty_in_transit END AS qty_in_transit,
         CASE WHEN qty_on_hand = 70 THEN 0.0 WHEN qty_on_hand = 71 THEN NULL ELSE CAST(avg_unit_cost AS DOUBLE) END AS avg_unit_cost
  FROM fact_inventory)"""


def naive(prefix: str, keys: str, source: str) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    ak = ", ".join(f"a.{k}" for k in keys.split(", "))
    return f"""
{prefix}_mon AS (SELECT {keys}, CAST(date_trunc('month', transaction_date) AS DATE) AS m, CAST(SUM(qty_sold) AS BIGINT) AS q FROM {source} GROUP BY ALL),
{prefix}_seq AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY m) AS i, COUNT(*) OVER (PARTITION BY {keys}) AS n,
                        max(m) OVER (PARTITION BY {keys}) AS last_month FROM {prefix}_mon),
{prefix}_ok AS (SELECT {keys}, n, last_month FROM {prefix}_seq WHERE n >= 12 GROUP BY ALL HAVING SUM(CASE WHEN i <= n - 3 THEN q ELSE 0 END) <> 0),
{prefix}_test AS (
  SELECT {ak}, b.q AS actual, c.q AS pred
  FROM {prefix}_ok a JOIN {prefix}_seq b ON {on} AND b.i > b.n - 3
       JOIN {prefix}_seq c ON {on.replace('b.', 'c.')}
            AND c.i = (a.n - 3 - least(12, a.n - 3)) + ((b.i - (a.n - 3) - 1) % least(12, a.n - 3)) + 1),
{prefix}_err AS (
  SELECT {keys}, {r('AVG(CASE WHEN actual > 0 THEN abs((actual - pred) / CAST(actual AS DOUBLE)) END) * 100', 2)} AS mape,
         {r('sqrt(AVG(CAST((actual - pred) * (actual - pred) AS DOUBLE)))', 2)} AS rmse
  FROM {prefix}_test GROUP BY ALL),
{prefix}_fc AS (
  SELECT CAST(a.last_month + to_months(CAST(h.h + 1 AS INT)) AS DATE) AS forecast_date, {ak}, CAST(b.q AS DOUBLE) AS forecast_qty,
         CAST(0 AS DOUBLE) AS forecast_lower, CAST(b.q * 2 AS DOUBLE) AS forecast_upper, 'SEASONAL_NAIVE' AS model_used, e.mape, e.rmse
  FROM {prefix}_ok a CROSS JOIN (SELECT unnest(range(0, 6)) AS h) h
       JOIN {prefix}_seq b ON {on} AND b.i = a.n - 12 + (h.h % 12) + 1
       JOIN {prefix}_err e ON {on.replace('b.', 'e.')})"""


BRANDED = "branded AS (SELECT s.*, brand FROM fact_sales s JOIN dim_parts p ON s.part_id = p.part_id)"
NAIVE = BRANDED + "," + naive("nv", "brand, dealer_id", "branded")
NAIVE_KEY = naive("nk", "part_id, dealer_id", "fact_sales")
_FC = "forecast_date, strftime(forecast_date, '%Y-%m') AS year_month, {k}, forecast_qty, forecast_lower, forecast_upper, model_used, mape, rmse"

ORACLE: dict[str, str] = {}


def add(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = "WITH " + ",".join([STAR, *ctes]) + "\n" + body.strip()


def money(*cols: str) -> str:
    return "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + ") FROM "


# ---------------------------------------------------------------- star schema, quality
add("dim_dealers", "SELECT * FROM dim_dealers")
add("dim_suppliers", "SELECT * FROM dim_suppliers")
add("dim_parts", money("standard_cost", "list_price") + "dim_parts")
add("fact_sales", money("unit_price", "discount_pct", "cogs", "revenue") + "fact_sales")
add("fact_inventory", money("avg_unit_cost", "total_stock_value") + "fact_inventory")
add("fact_purchase_orders", money("unit_cost", "total_cost") + "fact_purchase_orders")
add("dim_date", """
SELECT date, CAST(year(date) AS INT) AS year, CAST(quarter(date) AS INT) AS quarter, CAST(month(date) AS INT) AS month,
       CAST(date_trunc('month', date) AS DATE) AS month_start, strftime(date, '%Y-%m') AS year_month,
       CAST(isodow(date) - 1 AS INT) AS day_of_week
FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT min(transaction_date) AS a, max(transaction_date) AS b FROM fact_sales) t) u""")
add("derived_sales", """
SELECT transaction_date, s.part_id, dealer_id, qty_sold, CAST(revenue AS DOUBLE) AS revenue,
       CAST(qty_sold * standard_cost AS DOUBLE) AS cogs, CAST(revenue - qty_sold * standard_cost AS DOUBLE) AS gross_profit
FROM fact_sales s JOIN dim_parts p ON s.part_id = p.part_id""")
add("derived_inventory", """
SELECT snapshot_date, part_id, dealer_id, qty_on_hand - qty_reserved AS qty_available,
       CAST(qty_on_hand * avg_unit_cost AS DOUBLE) AS total_stock_value FROM fact_inventory""")
add("derived_purchase_orders", """
SELECT po_number, po_line, part_id, CAST(qty_ordered * unit_cost AS DOUBLE) AS total_cost,
       CAST(actual_receipt_date - order_date AS INT) AS lead_time_actual,
       CAST(actual_receipt_date - promised_date AS INT) AS lead_time_delta FROM fact_purchase_orders""")
add("stored_sales", """
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, transaction_date, CAST(part_id AS INT) AS part_id, dealer_id, customer_type,
       qty_sold, CAST(unit_price AS DOUBLE) AS unit_price, CAST(revenue AS DOUBLE) AS revenue, was_fulfilled FROM fact_sales""")
add("quality_unique", "SELECT po_number, po_line, COUNT(*) AS row_count FROM fact_purchase_orders GROUP BY ALL HAVING COUNT(*) > 1")
add("quality_foreign_key", """
SELECT part_id, COUNT(*) AS row_count FROM fact_sales
WHERE part_id NOT IN (SELECT part_id FROM dim_parts WHERE is_active) GROUP BY part_id""")
add("quality_predicate", "SELECT snapshot_date, part_id, dealer_id, qty_available FROM fact_inventory WHERE NOT (qty_available >= 0)")
add("quality_rules", f"""
SELECT rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'date_not_in_future' AS rule, COUNT(*) FILTER (WHERE transaction_date > {D} - 365) AS violations FROM fact_sales
  UNION ALL SELECT 'qty_positive', COUNT(*) FILTER (WHERE qty_sold <= 0) FROM fact_sales
  UNION ALL SELECT 'price_positive', COUNT(*) FILTER (WHERE unit_price <= 0) FROM fact_sales
  UNION ALL SELECT 'discount_0_100', COUNT(*) FILTER (WHERE discount_pct NOT BETWEEN 0 AND 100) FROM fact_sales
  UNION ALL SELECT 'no_backorder_when_fulfilled', COUNT(*) FILTER (WHERE was_fulfilled AND backorder_qty <> 0) FROM fact_sales) t""")
add("quality_not_null", """
SELECT column_name, null_count FROM (
  SELECT 'po_number' AS column_name, COUNT(*) - COUNT(po_number) AS null_count FROM fact_purchase_orders
  UNION ALL SELECT 'actual_receipt_date', COUNT(*) - COUNT(actual_receipt_date) FROM fact_purchase_orders
  UNION ALL SELECT 'lead_time_actual', COUNT(*) - COUNT(lead_time_actual) FROM fact_purchase_orders
  UNION ALL SELECT 'po_status', COUNT(*) - COUNT(po_status) FROM fact_purchase_orders) t""")
add("quality_defaults", """
SELECT part_id, po_status, COUNT(*) AS orders,
       CAST(SUM(CASE WHEN po_status = 'Closed' THEN qty_ordered ELSE 0 END) AS BIGINT) AS qty_received
FROM fact_purchase_orders GROUP BY part_id, po_status""")
add("quality_upsert", """
SELECT part_id, CASE WHEN is_critical AND list_price > 475 AND list_price * 2 > 950 AND list_price > 950 THEN upper(part_name) ELSE part_name END AS part_name,
       CAST(CASE WHEN is_critical AND list_price <= 950 THEN list_price * 2 ELSE list_price END AS DOUBLE) AS list_price,
       CASE WHEN is_critical THEN DATE '2002-01-01' ELSE DATE '2001-01-01' END AS updated_at
FROM dim_parts
UNION ALL
SELECT part_id + 10000000, part_name, CAST(list_price AS DOUBLE), DATE '2002-01-01' FROM dim_parts WHERE is_critical""")

# ---------------------------------------------------------------- cleaning
_CLEAN = f"""day AS transaction_date, part_id, dealer_id, customer_type, qty_sold, {r('unit_price')} AS unit_price,
  {r('discount_pct')} AS discount_pct, {r('qty_sold * unit_price * (1 - discount_pct / 100)', 4)} AS revenue, was_fulfilled, backorder_qty"""
add("clean_sales", f"""
SELECT {_CLEAN}, CAST(year(day) AS INT) AS year, CAST(month(day) AS INT) AS month, CAST(quarter(day) AS INT) AS quarter,
       CAST(isodow(day) - 1 AS INT) AS day_of_week, CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CAST(date_trunc('month', day) AS DATE) AS year_month
FROM judged WHERE NOT outlier""", DIRTY)
for _name in ("clean_csv_file", "clean_csv_stream", "clean_csv_stream_batches"):
    add(_name, f"SELECT {_CLEAN} FROM judged WHERE NOT outlier", DIRTY)
add("clean_sales_report", """
SELECT "check", CAST(n AS BIGINT) AS affected_rows, action FROM (
  SELECT 'source_rows' AS "check", (SELECT COUNT(*) FROM dirty) AS n, 'total' AS action
  UNION ALL SELECT 'invalid_dates', (SELECT COUNT(*) FROM dated WHERE day IS NULL), 'dropped'
  UNION ALL SELECT 'future_dates', (SELECT COUNT(*) FROM dated WHERE day > (SELECT d FROM today)), 'dropped'
  UNION ALL SELECT 'null_required_fields', (SELECT COUNT(*) FROM dated WHERE day <= (SELECT d FROM today) AND revenue IS NULL), 'dropped'
  UNION ALL SELECT 'duplicate_rows', (SELECT COUNT(*) FROM live) - (SELECT COUNT(*) FROM firsts), 'dropped (kept first)'
  UNION ALL SELECT 'non_positive_qty', (SELECT COUNT(*) FROM firsts WHERE qty_sold <= 0), 'dropped'
  UNION ALL SELECT 'non_positive_price', (SELECT COUNT(*) FROM firsts WHERE qty_sold > 0 AND unit_price <= 0), 'dropped'
  UNION ALL SELECT 'invalid_discount', (SELECT COUNT(*) FROM valid WHERE NOT disc_ok), 'clipped to [0,100]'
  UNION ALL SELECT 'price_outliers_iqr', (SELECT COUNT(*) FROM judged WHERE outlier), 'dropped'
  UNION ALL SELECT 'output_rows', (SELECT COUNT(*) FROM judged WHERE NOT outlier), 'total') t""", DIRTY)
add("clean_inventory", f"""
SELECT snapshot_date, part_id, dealer_id, greatest(qty_on_hand, 0) AS qty_on_hand, greatest(qty_reserved, 0) AS qty_reserved,
       greatest(qty_in_transit, 0) AS qty_in_transit, avg_unit_cost, greatest(qty_on_hand, 0) - greatest(qty_reserved, 0) AS qty_available,
       {r('greatest(qty_on_hand, 0) * avg_unit_cost', 2)} AS total_stock_value
FROM dirtyinv WHERE snapshot_date IS NOT NULL AND avg_unit_cost > 0""", DIRTY_INV)
add("clean_inventory_report", """
SELECT "check", CAST(n AS BIGINT) AS affected_rows, action FROM (
  SELECT 'source_rows' AS "check", COUNT(*) AS n, 'total' AS action FROM dirtyinv
  UNION ALL SELECT 'invalid_snapshot_dates', COUNT(*) FILTER (WHERE snapshot_date IS NULL), 'dropped' FROM dirtyinv
  UNION ALL SELECT 'negative_qty_on_hand', COUNT(*) FILTER (WHERE snapshot_date IS NOT NULL AND qty_on_hand < 0), 'set to 0' FROM dirtyinv
  UNION ALL SELECT 'negative_qty_reserved', COUNT(*) FILTER (WHERE snapshot_date IS NOT NULL AND qty_reserved < 0), 'set to 0' FROM dirtyinv
  UNION ALL SELECT 'negative_qty_in_transit', COUNT(*) FILTER (WHERE snapshot_date IS NOT NULL AND qty_in_transit < 0), 'set to 0' FROM dirtyinv
  UNION ALL SELECT 'invalid_unit_cost', COUNT(*) FILTER (WHERE snapshot_date IS NOT NULL AND avg_unit_cost <= 0), 'dropped' FROM dirtyinv
  UNION ALL SELECT 'output_rows', COUNT(*) FILTER (WHERE snapshot_date IS NOT NULL AND avg_unit_cost > 0), 'total' FROM dirtyinv) t""", DIRTY_INV)

# ---------------------------------------------------------------- KPI queries
add("inventory_turnover", f"""
SELECT c.category, {r('cogs', 2)} AS annual_cogs, {r('v', 2)} AS avg_inventory_value, {r('cogs / nullif(v, 0)', 2)} AS inventory_turnover,
       {r('365.0 / nullif(cogs / nullif(v, 0), 0)', 1)} AS days_on_hand
FROM (SELECT category, CAST(SUM(cogs) AS DOUBLE) AS cogs FROM fact_sales s JOIN dim_parts p ON s.part_id = p.part_id
      WHERE transaction_date >= {D} - INTERVAL 12 MONTH GROUP BY category) c
JOIN (SELECT category, CAST(SUM(total_stock_value) AS DOUBLE) / COUNT(total_stock_value) AS v
      FROM fact_inventory i JOIN dim_parts p ON i.part_id = p.part_id
      WHERE snapshot_date >= {D} - INTERVAL 12 MONTH GROUP BY category) a ON c.category = a.category""")
_FILL = f"""
SELECT dealer_name, region, COUNT(*) AS total_order_lines, COUNT(*) FILTER (WHERE was_fulfilled) AS fulfilled_lines,
       CAST(SUM(backorder_qty) AS BIGINT) AS total_backorder_qty,
       {r('100.0 * COUNT(*) FILTER (WHERE was_fulfilled) / COUNT(*)', 2)} AS fill_rate_pct,
       {r('100.0 * COUNT(*) FILTER (WHERE NOT was_fulfilled) / COUNT(*)', 2)} AS backorder_rate_pct
FROM fact_sales s JOIN dim_dealers d ON s.dealer_id = d.dealer_id
WHERE transaction_date >= {D} - 90 GROUP BY dealer_name, region"""
add("fill_rate", _FILL)
_DEAD = f"""
SELECT part_number, part_name, category, brand, dealer_name, qty_on_hand, {r('total_stock_value', 2)} AS stock_value, last_movement,
       idle AS days_no_movement,
       CASE WHEN idle > 365 THEN 'Dead Stock' WHEN idle > 180 THEN 'Slow Moving' WHEN idle > 90 THEN 'Watch List' ELSE 'Active' END AS stock_status
FROM moves m JOIN dim_parts p ON m.part_id = p.part_id JOIN dim_dealers d ON m.dealer_id = d.dealer_id
WHERE qty_on_hand > 0 AND idle > 90"""
add("dead_stock", _DEAD, LATEST, MOVES)
add("stock_health", f"""
SELECT part_number, part_name, category, dealer_name, qty_on_hand, {r('total_stock_value', 2)} AS stock_value, qty AS qty_sold_90d,
       daily AS avg_daily_demand, CAST(days_of_stock AS DOUBLE) AS days_of_stock, stock_health
FROM health2 h JOIN dim_parts p ON h.part_id = p.part_id JOIN dim_dealers d ON h.dealer_id = d.dealer_id""", LATEST, HEALTH)
_LEAD = f"""
SELECT supplier_name, supplier_type, country, COUNT(*) AS po_count, {r('AVG(lead_time_actual)', 1)} AS avg_actual_lead_time,
       lead_time_days AS contracted_lead_time, {r('stddev_samp(lead_time_actual)', 2)} AS lead_time_std_dev,
       {r('stddev_samp(lead_time_actual) / nullif(AVG(lead_time_actual), 0) * 100', 1)} AS lead_time_cov_pct,
       {r('AVG(lead_time_delta)', 1)} AS avg_delay_days, COUNT(*) FILTER (WHERE lead_time_delta > 3) AS late_deliveries,
       {r('100.0 * COUNT(*) FILTER (WHERE lead_time_delta <= 0) / COUNT(*)', 1)} AS on_time_pct,
       {r('CAST(SUM(total_cost) AS DOUBLE) / COUNT(total_cost)', 2)} AS avg_po_value
FROM fact_purchase_orders po JOIN dim_suppliers s ON po.supplier_id = s.supplier_id
WHERE actual_receipt_date IS NOT NULL AND po_status = 'Closed'
GROUP BY s.supplier_id, supplier_name, supplier_type, country, lead_time_days HAVING COUNT(*) >= 3"""
add("supplier_lead_time", _LEAD)
add("abc_revenue", f"""
SELECT part_number, part_name, category, dealer_name, {r('v', 2)} AS annual_revenue, {r('v / t * 100', 3)} AS revenue_pct,
       {r('c / t * 100', 2)} AS cumulative_pct,
       CASE WHEN c / t * 100 <= 80 THEN 'A' WHEN c / t * 100 <= 95 THEN 'B' ELSE 'C' END AS abc_class
FROM (SELECT part_id, dealer_id, CAST(x AS DOUBLE) AS v, CAST(SUM(x) OVER () AS DOUBLE) AS t,
             CAST(SUM(x) OVER (ORDER BY x DESC, part_id, dealer_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS c
      FROM (SELECT part_id, dealer_id, SUM(revenue) AS x FROM fact_sales
            WHERE transaction_date >= date_trunc('year', {D}) GROUP BY ALL) a) k
JOIN dim_parts p ON k.part_id = p.part_id JOIN dim_dealers d ON k.dealer_id = d.dealer_id""")
add("monthly_trend", f"""
SELECT strftime(m, '%Y-%m') AS month, category, q AS total_qty, CAST(rev AS DOUBLE) AS total_revenue, parts AS unique_parts_sold,
       {r('CAST(q AS DOUBLE) / n', 2)} AS avg_qty_per_line, prev AS prev_month_qty, {r('100.0 * (q - prev) / nullif(prev, 0)', 1)} AS mom_growth_pct
FROM (SELECT *, lag(q) OVER (PARTITION BY category ORDER BY m) AS prev FROM (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS m, category, CAST(SUM(qty_sold) AS BIGINT) AS q, SUM(revenue) AS rev,
         COUNT(DISTINCT s.part_id) AS parts, COUNT(*) AS n
  FROM fact_sales s JOIN dim_parts p ON s.part_id = p.part_id GROUP BY ALL) a) b""")
add("stockout_risk", f"""
SELECT part_number, part_name, category, p.is_critical, dealer_name, qty_available, qty_in_transit, reorder_point, safety_stock_qty,
       {r('avg_daily_demand')} AS avg_daily_demand, {r('avg_lead_time_days')} AS avg_lead_time_days,
       {r('qty_available / nullif(avg_daily_demand, 0)', 1)} AS days_of_stock_remaining,
       CASE WHEN qty_available <= 0 THEN 'STOCKOUT' WHEN qty_available < safety_stock_qty THEN 'CRITICAL'
            WHEN qty_available < reorder_point THEN 'ORDER NOW' WHEN qty_available < reorder_point * CAST(1.2 AS DOUBLE) THEN 'WATCH' ELSE 'OK' END AS risk_level
FROM latest l JOIN dim_parts p ON l.part_id = p.part_id JOIN dim_dealers d ON l.dealer_id = d.dealer_id
     LEFT JOIN pol ON l.part_id = pol.part_id AND l.dealer_id = pol.dealer_id""", LATEST, ABC, STATS, POLICY)
ORACLE["stockout_risk_view"] = ORACLE["stockout_risk"]
add("service_level", f"""
SELECT dealer_id, COUNT(*) AS demand_events, CAST(SUM(missed) AS BIGINT) AS stockout_events,
       {r('100.0 * (1.0 - CAST(SUM(missed) AS DOUBLE) / COUNT(*))', 2)} AS service_level_pct
FROM (SELECT dealer_id, part_id, transaction_date, max(CASE WHEN was_fulfilled THEN 0 ELSE 1 END) AS missed FROM fact_sales GROUP BY ALL) e
GROUP BY dealer_id""")

# ---------------------------------------------------------------- latest row, ordered
add("latest_inventory", "SELECT part_id, dealer_id, snapshot_date, qty_on_hand, qty_available, CAST(total_stock_value AS DOUBLE) AS total_stock_value FROM latest", LATEST)
add("latest_inventory_as_of", f"""
SELECT part_id, dealer_id, max(snapshot_date) AS snapshot_date, arg_max(qty_on_hand, snapshot_date) AS qty_on_hand
FROM fact_inventory WHERE snapshot_date <= {D} - 120 GROUP BY part_id, dealer_id""")
add("last_non_null_inventory", """
SELECT part_id, dealer_id, arg_max(qty_on_hand, snapshot_date) AS qty_on_hand,
       arg_max(qty_in_transit, snapshot_date) FILTER (WHERE qty_on_hand > 60) AS qty_in_transit FROM fact_inventory GROUP BY part_id, dealer_id""")
add("last_sale", "SELECT part_id, dealer_id, max(transaction_date) AS last_sale_date FROM fact_sales GROUP BY part_id, dealer_id")
add("running_revenue", """
SELECT part_id, dealer_id, CAST(x AS DOUBLE) AS revenue,
       CAST(SUM(x) OVER (ORDER BY x DESC, part_id, dealer_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
FROM (SELECT part_id, dealer_id, SUM(revenue) AS x FROM fact_sales GROUP BY ALL) t""")
add("running_dealer_units", """
SELECT dealer_id, transaction_date, q AS qty, CAST(SUM(q) OVER (PARTITION BY dealer_id ORDER BY transaction_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_qty
FROM (SELECT dealer_id, transaction_date, CAST(SUM(qty_sold) AS BIGINT) AS q FROM fact_sales GROUP BY ALL) t""")
add("price_quartiles", "SELECT part_id, " + ", ".join(
    f"{r(f'quantile_cont(CAST(unit_price AS DOUBLE), {p})')} AS {n}" for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
) + " FROM fact_sales GROUP BY part_id")
_DENSE = """
dense AS (
  SELECT k.part_id, m.month, coalesce(q, 0) AS qty_sold
  FROM (SELECT DISTINCT part_id FROM fact_sales) k
  CROSS JOIN (SELECT DISTINCT CAST(date_trunc('month', transaction_date) AS DATE) AS month FROM fact_sales) m
  LEFT JOIN (SELECT part_id, CAST(date_trunc('month', transaction_date) AS DATE) AS month, CAST(SUM(qty_sold) AS BIGINT) AS q
             FROM fact_sales GROUP BY ALL) s ON k.part_id = s.part_id AND m.month = s.month)"""
add("dense_monthly_units", "SELECT part_id, month, qty_sold FROM dense", _DENSE)

# ---------------------------------------------------------------- classification
_PER_PART = """
pp AS (SELECT part_id, v, CAST(v AS DOUBLE) / t * 100 AS share, CAST(c AS DOUBLE) / t * 100 AS cum, CAST(c - v AS DOUBLE) / t * 100 AS before
       FROM (SELECT part_id, v, CAST(SUM(v) OVER () AS DOUBLE) AS t, SUM(v) OVER (ORDER BY v DESC, part_id ROWS UNBOUNDED PRECEDING) AS c
             FROM (SELECT part_id, SUM(revenue) AS v FROM fact_sales GROUP BY part_id) a) b)"""
_ABC_COLS = f"SELECT part_id, CAST(v AS DOUBLE) AS revenue, {r('share')} AS share_pct, {r('cum')} AS cum_pct, "
add("abc_running", _ABC_COLS + "CASE WHEN cum <= 80 THEN 'A' WHEN cum <= 95 THEN 'B' ELSE 'C' END AS abc_class FROM pp", _PER_PART)
add("abc_preceding", _ABC_COLS + "CASE WHEN before < 80 THEN 'A' WHEN before < 95 THEN 'B' ELSE 'C' END AS abc_class FROM pp", _PER_PART)
add("xyz_by_part", f"""
SELECT part_id, {r('mean')} AS avg_monthly_demand, {r('sd')} AS demand_std, {r('cov')} AS demand_cov,
       CASE WHEN cov <= 0.5 THEN 'X' WHEN cov <= 1.0 THEN 'Y' ELSE 'Z' END AS xyz_class
FROM (SELECT *, coalesce(sd / nullif(mean, 0), 9999) AS cov FROM (
  SELECT part_id, AVG(qty_sold) AS mean, coalesce(stddev_samp(qty_sold), 0) AS sd FROM dense GROUP BY part_id) a) b""", _DENSE)
add("xyz_by_part_dealer", f"""
SELECT part_id, dealer_id, {r('mean')} AS avg_monthly_demand, {r('sd')} AS demand_std, {r('cov')} AS demand_cov,
       CASE WHEN cov <= 0.5 THEN 'X' WHEN cov <= 1.0 THEN 'Y' ELSE 'Z' END AS xyz_class
FROM (SELECT *, coalesce(sd / nullif(mean, 0), 9999) AS cov FROM (
  SELECT part_id, dealer_id, CAST(SUM(q) AS DOUBLE) / max(n) AS mean, {std('max(n)', 'SUM(q)', 'SUM(q * q)')} AS sd
  FROM (SELECT part_id, dealer_id, date_trunc('month', transaction_date) AS m, CAST(SUM(qty_sold) AS BIGINT) AS q FROM fact_sales GROUP BY ALL) a,
       (SELECT COUNT(DISTINCT date_trunc('month', transaction_date)) AS n FROM fact_sales) c
  GROUP BY part_id, dealer_id) d) e""")
_ABC_XYZ = f"""
SELECT part_id, dealer_id, CAST(annual_revenue AS DOUBLE) AS annual_revenue, {r('revenue_pct')} AS revenue_pct, {r('cum_rev_pct')} AS cum_rev_pct,
       abc_class, {r('avg_monthly_demand')} AS avg_monthly_demand, {r('demand_std')} AS demand_std, {r('demand_cov')} AS demand_cov, xyz_class, combined_class
FROM abc"""
add("abc_xyz", _ABC_XYZ, ABC)
_CLEANED = """
cleaned AS (SELECT day AS transaction_date, part_id, dealer_id, qty_sold,
                   CAST(round(CAST(qty_sold * unit_price * (1 - discount_pct / 100) AS DECIMAL(28,9)), 4) AS DECIMAL(18,4)) AS revenue
            FROM judged WHERE NOT outlier)"""
add("pipeline_abc_xyz", _ABC_XYZ, DIRTY, _CLEANED, ABC.replace("FROM fact_sales", "FROM cleaned"))


def _summary(by: str) -> str:
    return f"""
SELECT {by}, COUNT(*) AS part_count, {he('SUM(annual_revenue)', 2)} AS total_revenue, {he('AVG(avg_monthly_demand)', 2)} AS avg_monthly_demand,
       {he('AVG(demand_cov)', 2)} AS avg_cov,
       {he('CAST(SUM(annual_revenue) AS DOUBLE) / max(t) * 100', 2)} AS revenue_share_pct, {he('CAST(COUNT(*) AS DOUBLE) / max(n) * 100', 2)} AS part_share_pct
FROM abc, (SELECT CAST(SUM(annual_revenue) AS DOUBLE) AS t, COUNT(*) AS n FROM abc) z GROUP BY {by}"""


add("abc_xyz_summary", _summary("combined_class"), ABC)
_ACTIONS = """
actions AS (SELECT * FROM (VALUES
  ('AX', 'High Value / Stable', 'Tight control. Min safety stock. Frequent replenishment.'),
  ('AY', 'High Value / Variable', 'Maintain safety stock. Short-term forecasting. Weekly review.'),
  ('AZ', 'High Value / Irregular', 'Close monitoring. Emergency supplier contract. Hold buffer.'),
  ('BX', 'Med Value / Stable', 'Standard replenishment. Monthly review.'),
  ('BY', 'Med Value / Variable', 'Moderate safety stock. Monthly forecast review.'),
  ('BZ', 'Med Value / Irregular', 'Demand analysis needed. Consider de-listing.'),
  ('CX', 'Low Value / Stable', 'Bulk ordering. Reduce review frequency.'),
  ('CY', 'Low Value / Variable', 'Consignment or JIT. Reduce stock holding.'),
  ('CZ', 'Low Value / Irregular', 'Candidate for removal. Order on demand only.')) v(combined_class, segment_label, recommended_action))"""
add("abc_xyz_actions", """
SELECT part_id, dealer_id, abc.combined_class, segment_label, recommended_action
FROM abc LEFT JOIN actions ON abc.combined_class = actions.combined_class""", ABC, _ACTIONS)

# ---------------------------------------------------------------- replenishment
add("demand_stats", f"SELECT part_id, dealer_id, {r('avg_daily_demand')} AS avg_daily_demand, {r('demand_std_daily')} AS demand_std_daily FROM dstat", STATS)
add("lead_time_stats", f"SELECT part_id, {r('avg_lead_time_days')} AS avg_lead_time_days, {r('lead_time_std_dev')} AS lead_time_std_dev FROM ltstat", STATS)


def _policy_cols(extra: str) -> str:
    return f"""part_id, dealer_id, {r('avg_daily_demand')} AS avg_daily_demand, {r('demand_std_daily')} AS demand_std_daily,
  {r('avg_lead_time_days')} AS avg_lead_time_days, {r('lead_time_std_dev')} AS lead_time_std_dev, {extra} service_level_z, safety_stock_qty,
  reorder_point, economic_order_qty, max_stock_level, {r('demand_std_daily / greatest(avg_daily_demand, 0.001)')} AS demand_cov,
  {r('safety_stock_qty / greatest(avg_daily_demand, 0.001)')} AS days_of_safety_stock"""


add("reorder_policies", "SELECT " + _policy_cols("abc_class, is_critical, CAST(standard_cost AS DOUBLE) AS standard_cost,") + " FROM pol", ABC, STATS, POLICY)
add("reorder_policies_fallback", "SELECT " + _policy_cols("") + " FROM polx", STATS, POLICY_BARE)

# ---------------------------------------------------------------- forecasting
add("monthly_demand", """
SELECT part_id, dealer_id, CAST(date_trunc('month', transaction_date) AS DATE) AS month, CAST(SUM(qty_sold) AS BIGINT) AS qty_sold
FROM fact_sales GROUP BY ALL""")
add("holdout_split", """
SELECT brand, dealer_id, CAST(i - 1 AS INT) AS position, CAST(q AS DOUBLE) AS qty, CASE WHEN i > n - 3 THEN 'test' ELSE 'train' END AS part
FROM nv_seq""", NAIVE)
add("naive_forecast", f"SELECT {_FC.format(k='brand, dealer_id')} FROM nv_fc", NAIVE)
add("naive_forecast_short", f"SELECT {_FC.format(k='part_id, dealer_id')} FROM nk_fc", NAIVE_KEY)
add("naive_accuracy", f"""
SELECT model_used, COUNT(mape) AS count, {he('median(mape)', 2)} AS median_mape, {he('AVG(mape)', 2)} AS mean_mape,
       {he('AVG(CASE WHEN mape < 15 THEN 1.0 ELSE 0.0 END) * 100', 2)} AS pct_under_15,
       {he('AVG(CASE WHEN mape < 25 THEN 1.0 ELSE 0.0 END) * 100', 2)} AS pct_under_25
FROM nv_fc GROUP BY model_used""", NAIVE)

# ---------------------------------------------------------------- stock-out model
add("demand_windows", f"""
SELECT * REPLACE ({r('demand_std_30d')} AS demand_std_30d, {r('demand_std_60d')} AS demand_std_60d, {r('demand_std_90d')} AS demand_std_90d)
FROM wins""", WINDOWS)
add("supplier_performance", f"SELECT part_id, {r('on_time_rate')} AS on_time_rate, {r('avg_po_lead_time')} AS avg_po_lead_time FROM perf", PERF)
_LABELS = """
cls AS (SELECT l.part_id, l.dealer_id, coalesce(a.abc_class, 'C') AS a, coalesce(a.xyz_class, 'C') AS x, coalesce(a.combined_class, 'C') AS c
        FROM latest l LEFT JOIN abc a ON l.part_id = a.part_id AND l.dealer_id = a.dealer_id),
codes AS (SELECT part_id, dealer_id, CAST(dense_rank() OVER (ORDER BY a) - 1 AS INT) AS abc_class,
                 CAST(dense_rank() OVER (ORDER BY x) - 1 AS INT) AS xyz_class, CAST(dense_rank() OVER (ORDER BY c) - 1 AS INT) AS combined_class FROM cls)"""
add("stockout_features", f"""
SELECT {DEMAND_FEATURES}, safety_stock_qty, reorder_point, {r('avg_lead_time_days')} AS avg_lead_time_days,
       {r('lead_time_std_dev')} AS lead_time_std_dev, economic_order_qty, l.qty_available - reorder_point AS stock_vs_rop,
       {r('coalesce(safety_stock_qty / nullif(CAST(qty_sold_30d AS DOUBLE) / 30.0, 0), 0)')} AS safety_stock_coverage_days,
       {r('coalesce(on_time_rate, 0.8)')} AS on_time_rate, {r('coalesce(avg_po_lead_time, 21)')} AS avg_po_lead_time,
       codes.abc_class, codes.xyz_class, codes.combined_class, {TARGET}
FROM latest l LEFT JOIN wins w ON l.part_id = w.part_id AND l.dealer_id = w.dealer_id
     LEFT JOIN pol ON l.part_id = pol.part_id AND l.dealer_id = pol.dealer_id
     LEFT JOIN perf ON l.part_id = perf.part_id
     JOIN codes ON l.part_id = codes.part_id AND l.dealer_id = codes.dealer_id""", LATEST, ABC, STATS, POLICY, WINDOWS, PERF, _LABELS)
add("stockout_features_fallback", "SELECT * FROM barefeat", LATEST, WINDOWS, BARE_FEATURES)
add("ranking_metrics", f"""
SELECT {he('SUM(neg * ((tp - pos) + pos / 2.0)) / (max(pt) * max(nt))', 4)} AS auc_roc, {he('SUM(pos * prec) / max(pt)', 4)} AS avg_precision,
       {he('arg_min(prec, (abs(tp / pt - 0.70), s))', 4)} AS precision_at_70_recall
FROM (SELECT *, tp / (tp + fp) AS prec, SUM(pos) OVER () AS pt, SUM(neg) OVER () AS nt FROM (
  SELECT s, pos, neg, SUM(pos) OVER (ORDER BY s DESC) AS tp, SUM(neg) OVER (ORDER BY s DESC) AS fp FROM (
    SELECT p AS s, CAST(SUM(y) AS DOUBLE) AS pos, CAST(SUM(1 - y) AS DOUBLE) AS neg FROM scores GROUP BY p) a) b) c""",
    LATEST, WINDOWS, BARE_FEATURES, SCORES)
add("classification_report", f"""
SELECT class, {he('pr', 4)} AS precision, {he('rc', 4)} AS recall, {he('f1', 4)} AS f1_score, CAST(sup AS BIGINT) AS support FROM (
  SELECT '0' AS class, p0 AS pr, r0 AS rc, f0 AS f1, s0 AS sup FROM m UNION ALL SELECT '1', p1, r1, f1, s1 FROM m
  UNION ALL SELECT 'accuracy', acc, acc, acc, s0 + s1 FROM m
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM m
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1), (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM m) t""",
    LATEST, WINDOWS, BARE_FEATURES, SCORES, """
cells AS (SELECT CAST(COUNT(*) FILTER (WHERE y = 1 AND p >= 0.05) AS DOUBLE) AS tp, CAST(COUNT(*) FILTER (WHERE y = 0 AND p >= 0.05) AS DOUBLE) AS fp,
                 CAST(COUNT(*) FILTER (WHERE y = 1 AND p < 0.05) AS DOUBLE) AS fn, CAST(COUNT(*) FILTER (WHERE y = 0 AND p < 0.05) AS DOUBLE) AS tn FROM scores),
m AS (SELECT coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0, tn + fp AS s0,
             coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0) AS f1, tp + fn AS s1,
             (tp + tn) / (tp + tn + fp + fn) AS acc FROM cells)""")
add("ordered_folds", """
SELECT snapshot_date, part_id, dealer_id, CAST(CASE WHEN i < n - (n // 6) * 5 THEN 0 ELSE (i - (n - (n // 6) * 5)) // (n // 6) + 1 END AS INT) AS fold
FROM (SELECT snapshot_date, part_id, dealer_id, row_number() OVER (ORDER BY snapshot_date, part_id, dealer_id) - 1 AS i, COUNT(*) OVER () AS n FROM fact_inventory) t""")

# ---------------------------------------------------------------- BI measures
NET = "CAST(SUM(qty_sold * unit_price * (100 - discount_pct)) AS DOUBLE) / 100"


def measure(name: str, out: str, value: str, source: str, by: str = "dealer_id", digits: int = 4, *ctes: str) -> None:
    add(name, f"SELECT {by}, {r(value, digits)} AS {out} FROM {source} GROUP BY {by}", *ctes)


measure("m_total_revenue", "total_revenue", NET, "fact_sales", digits=2)
_CUR = f"transaction_date BETWEEN date_trunc('year', {D}) AND {D}"
_PRI = f"transaction_date BETWEEN date_trunc('year', {D}) - INTERVAL 12 MONTH AND {D} - INTERVAL 12 MONTH"
add("m_revenue_vs_prior", f"""
SELECT dealer_id, {r('coalesce(c, 0)', 2)} AS current_revenue, {r('coalesce(p, 0)', 2)} AS prior_revenue,
       {r('coalesce((coalesce(c, 0) - p) / nullif(p, 0), 0)', 4)} AS revenue_vs_prior
FROM (SELECT dealer_id, CAST(SUM(qty_sold * unit_price * (100 - discount_pct)) FILTER (WHERE {_CUR}) AS DOUBLE) / 100 AS c,
             CAST(SUM(qty_sold * unit_price * (100 - discount_pct)) FILTER (WHERE {_PRI}) AS DOUBLE) / 100 AS p
      FROM fact_sales WHERE transaction_date >= date_trunc('year', {D}) - INTERVAL 12 MONTH GROUP BY dealer_id) t""")
measure("m_gross_margin_pct", "gross_profit_margin_pct", f"coalesce(CAST(SUM(revenue - cogs) AS DOUBLE) / nullif({NET}, 0), 0) * 100",
        "fact_sales", "dealer_id, customer_type")
add("m_active_sku_count", """
SELECT dealer_id, COUNT(DISTINCT i.part_id) AS active_sku_count FROM fact_inventory i JOIN dim_parts p ON i.part_id = p.part_id
WHERE is_active GROUP BY dealer_id""")
_OK = "CAST(COUNT(*) FILTER (WHERE was_fulfilled) AS DOUBLE) / COUNT(*) * 100"
measure("m_fill_rate_pct", "fill_rate_pct", _OK, "fact_sales", "customer_type")
measure("m_backorder_rate_pct", "backorder_rate_pct", f"100.0 - {_OK}", "fact_sales", "customer_type")
_VAL = "CAST(SUM(qty_on_hand * avg_unit_cost) AS DOUBLE)"
_DEADV = f"CAST(SUM(qty_on_hand * avg_unit_cost) FILTER (WHERE {D} - last_movement_date > 365) AS DOUBLE)"
measure("m_total_inventory_value", "total_inventory_value", _VAL, "fact_inventory", "snapshot_date", 2)
measure("m_dead_stock_value", "dead_stock_value", f"coalesce({_DEADV}, 0)", "fact_inventory", digits=2)
measure("m_dead_stock_pct", "dead_stock_pct", f"coalesce({_DEADV} / nullif({_VAL}, 0), 0) * 100", "fact_inventory")
_TURN = f"""
turn AS (
  SELECT i.dealer_id, coalesce(cogs / nullif(v, 0), 0) AS t
  FROM (SELECT dealer_id, CAST(SUM(x) AS DOUBLE) / COUNT(*) AS v FROM (
          SELECT dealer_id, date_trunc('month', snapshot_date) AS m, SUM(total_stock_value) AS x FROM fact_inventory GROUP BY ALL) a GROUP BY dealer_id) i
  LEFT JOIN (SELECT dealer_id, CAST(SUM(cogs) AS DOUBLE) AS cogs FROM fact_sales
             WHERE transaction_date > {D} - INTERVAL 12 MONTH GROUP BY dealer_id) c ON i.dealer_id = c.dealer_id)"""
add("m_inventory_turnover", f"SELECT dealer_id, {r('t', 4)} AS inventory_turnover FROM turn", _TURN)
add("m_days_on_hand", f"SELECT dealer_id, {r('coalesce(365.0 / nullif(t, 0), 0)', 4)} AS days_on_hand FROM turn", _TURN)
_COVER = f"""
cover AS (
  SELECT l.dealer_id, AVG({r('coalesce(qty_available / nullif(q / 90.0, 0), 999)')}) AS days
  FROM latest l LEFT JOIN (SELECT part_id, dealer_id, CAST(SUM(qty_sold) AS DOUBLE) AS q FROM fact_sales
                           WHERE transaction_date > {D} - 90 GROUP BY ALL) s ON l.part_id = s.part_id AND l.dealer_id = s.dealer_id
  GROUP BY l.dealer_id)"""
add("m_avg_coverage_days", f"SELECT dealer_id, {r('days', 4)} AS avg_stock_coverage_days FROM cover", LATEST, _COVER)
_SHORT = """
short AS (SELECT l.part_id, l.dealer_id, economic_order_qty, standard_cost, qty_available, reorder_point, avg_daily_demand
          FROM latest l JOIN pol ON l.part_id = pol.part_id AND l.dealer_id = pol.dealer_id WHERE qty_available < reorder_point)"""
_SHORT_CTES = (LATEST, ABC, STATS, POLICY, _SHORT)
add("m_parts_at_risk", "SELECT dealer_id, COUNT(*) AS parts_at_risk_count FROM short GROUP BY dealer_id", *_SHORT_CTES)
add("m_units_sold", "SELECT dealer_id, CAST(SUM(qty_sold) AS BIGINT) AS total_units_sold FROM fact_sales GROUP BY dealer_id")
measure("m_avg_monthly_demand", "avg_monthly_demand_per_part",
        "coalesce(CAST(SUM(qty_sold) AS DOUBLE) / nullif(COUNT(DISTINCT part_id) * date_diff('month', min(transaction_date), max(transaction_date)), 0), 0)",
        "fact_sales")
_NOW = f"SUM(qty_sold) FILTER (WHERE transaction_date >= date_trunc('month', {D}))"
_THEN = f"SUM(qty_sold) FILTER (WHERE transaction_date <= {D} - INTERVAL 1 MONTH)"
measure("m_demand_mom_growth", "demand_mom_growth_pct",
        f"coalesce(CAST(coalesce({_NOW}, 0) - {_THEN} AS DOUBLE) / nullif({_THEN}, 0), 0) * 100",
        f"(SELECT * FROM fact_sales WHERE transaction_date >= date_trunc('month', {D} - INTERVAL 1 MONTH)) t")
measure("m_avg_forecast_mape", "avg_forecast_mape", "CAST(SUM(CAST(mape AS DECIMAL(18,2))) AS DOUBLE) / COUNT(mape)", "nv_fc", "dealer_id", 4, NAIVE)
add("m_a_class_share", f"""
SELECT s.dealer_id, {r('coalesce(SUM(CASE WHEN abc_class = ' + "'A'" + ' THEN v ELSE 0 END) / nullif(SUM(v), 0), 0) * 100', 4)} AS a_class_revenue_share_pct
FROM (SELECT part_id, dealer_id, {NET} AS v FROM fact_sales GROUP BY ALL) s
LEFT JOIN abc a ON s.part_id = a.part_id AND s.dealer_id = a.dealer_id GROUP BY s.dealer_id""", ABC)
_CLOSED = "FILTER (WHERE po_status = 'Closed')"
measure("m_supplier_on_time", "supplier_on_time_pct",
        f"coalesce(CAST(COUNT(*) FILTER (WHERE po_status = 'Closed' AND lead_time_delta <= 0) AS DOUBLE) / nullif(COUNT(*) {_CLOSED}, 0), 0) * 100",
        "fact_purchase_orders", "supplier_id")
_LT = "CASE WHEN lead_time_actual > 0 THEN lead_time_actual END"
measure("m_avg_lead_time", "avg_lead_time_days", f"AVG({_LT})", "fact_purchase_orders", "supplier_id")
measure("m_lead_time_std", "lead_time_std_dev", f"stddev_pop({_LT})", "fact_purchase_orders", "supplier_id")
measure("m_total_po_value", "total_po_value", "CAST(SUM(qty_ordered * unit_cost) AS DOUBLE)", "fact_purchase_orders", "supplier_id", 2)
measure("m_avg_delay_days", "avg_delay_days", "AVG(CASE WHEN lead_time_delta > 0 AND po_status = 'Closed' THEN lead_time_delta END)",
        "fact_purchase_orders", "supplier_id")
add("m_next_month_forecast", f"""
SELECT dealer_id, {r('SUM(forecast_qty)', 2)} AS next_month_forecast_qty FROM nv_fc
WHERE strftime(forecast_date, '%Y-%m') = strftime({D} + INTERVAL 1 MONTH, '%Y-%m') GROUP BY dealer_id""", NAIVE)
_URGENT = f"0.60 * (100.0 - least({r('days', 4)} / 30.0 * 100, 100)) + 0.40 * (coalesce(risk, 0) * 100.0 / nullif(active, 0))"
add("m_urgency_score", f"""
SELECT c.dealer_id, {r(_URGENT, 4)} AS replenishment_urgency_score
FROM cover c LEFT JOIN (SELECT dealer_id, COUNT(*) AS risk FROM short GROUP BY dealer_id) k ON c.dealer_id = k.dealer_id
LEFT JOIN (SELECT dealer_id, COUNT(DISTINCT l.part_id) AS active FROM latest l JOIN dim_parts p ON l.part_id = p.part_id WHERE is_active
           GROUP BY dealer_id) a ON c.dealer_id = a.dealer_id""", *_SHORT_CTES, _COVER)
add("m_recommended_order_qty", "SELECT dealer_id, CAST(SUM(economic_order_qty) AS BIGINT) AS recommended_order_qty FROM short GROUP BY dealer_id", *_SHORT_CTES)
add("m_replenishment_cost", f"SELECT dealer_id, {r('CAST(SUM(economic_order_qty * standard_cost) AS DOUBLE)', 2)} AS estimated_replenishment_cost FROM short GROUP BY dealer_id", *_SHORT_CTES)

# ---------------------------------------------------------------- dashboard datasets
add("v_monthly_revenue_cogs", """
SELECT strftime(transaction_date, '%Y-%m') AS month, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(cogs) AS DOUBLE) AS cogs
FROM fact_sales GROUP BY 1""")


def _share(by: str, value: str, out: str, pct: str, source: str, cast: str = "DOUBLE") -> str:
    return f"""
SELECT {by}, CAST(v AS {cast}) AS {out}, {r('CAST(v AS DOUBLE) / CAST(SUM(v) OVER () AS DOUBLE) * 100', 2)} AS {pct}
FROM (SELECT {by}, {value} AS v FROM {source} GROUP BY {by}) t"""


add("v_revenue_by_category", _share("category", "SUM(revenue)", "revenue", "revenue_share_pct", "fact_sales s JOIN dim_parts p ON s.part_id = p.part_id"))
add("v_fill_by_branch", f"SELECT dealer_name, fill_rate_pct, backorder_rate_pct FROM ({_FILL}) t")
add("v_revenue_by_customer_type", _share("customer_type", "SUM(revenue)", "revenue", "revenue_share_pct", "fact_sales"))
add("v_top_parts", """
SELECT part_number, part_name, CAST(v AS DOUBLE) AS revenue FROM (
  SELECT part_id, SUM(revenue) AS v FROM fact_sales GROUP BY part_id ORDER BY v DESC, part_id LIMIT 10) t JOIN dim_parts p ON t.part_id = p.part_id""")
add("v_segment_counts", """
SELECT actions.combined_class, COUNT(abc.part_id) AS sku_count FROM actions LEFT JOIN abc ON actions.combined_class = abc.combined_class
GROUP BY actions.combined_class""", ABC, _ACTIONS)
add("v_stock_by_age", _share("age_band", "SUM(total_stock_value)", "stock_value", "value_share_pct", """(
  SELECT *, CASE WHEN idle < 30 THEN 'Active <30d' WHEN idle <= 90 THEN 'Watch 30-90d' WHEN idle <= 365 THEN 'Slow >90d' ELSE 'Dead >365d' END AS age_band FROM moves) u"""),
    LATEST, MOVES)
add("v_dead_stock_priority", f"""
SELECT part_number, part_name, category, dealer_name, qty_on_hand, stock_value, days_no_movement, stock_status FROM ({_DEAD}) t
ORDER BY stock_value DESC, days_no_movement DESC, part_number, dealer_name LIMIT 20""", LATEST, MOVES)
add("v_health_counts", "SELECT stock_health, COUNT(*) AS sku_count, CAST(SUM(total_stock_value) AS DOUBLE) AS stock_value FROM health2 GROUP BY stock_health", LATEST, HEALTH)
add("v_class_heatmap", "SELECT abc_class, " + ", ".join(f"COUNT(*) FILTER (WHERE xyz_class = '{c}') AS {c.lower()}_count" for c in "XYZ") + ", " + ", ".join(
    f"coalesce(CAST(SUM(annual_revenue) FILTER (WHERE xyz_class = '{c}') AS DOUBLE), 0) AS {c.lower()}_revenue" for c in "XYZ") + " FROM abc GROUP BY abc_class", ABC)
add("v_top_category_demand", """
SELECT strftime(m, '%Y-%m') AS month, category, q AS total_qty FROM mq
WHERE category IN (SELECT category FROM mq GROUP BY category ORDER BY SUM(q) DESC, category LIMIT 4)""", """
mq AS (SELECT date_trunc('month', transaction_date) AS m, category, CAST(SUM(qty_sold) AS BIGINT) AS q
       FROM fact_sales s JOIN dim_parts p ON s.part_id = p.part_id GROUP BY ALL)""")
add("v_pareto", f"SELECT abc_class, part_share_pct, revenue_share_pct FROM ({_summary('abc_class')}) t", ABC)
add("v_xyz_distribution", _share("xyz_class", "COUNT(*)", "sku_count", "sku_share_pct", "abc", "BIGINT"), ABC)
add("v_units_by_customer_type", _share("customer_type", "SUM(qty_sold)", "units", "unit_share_pct", "fact_sales", "BIGINT"))
add("v_supplier_on_time", f"""
SELECT supplier_name, n AS closed_pos, {r('pct', 1)} AS on_time_pct, CASE WHEN pct >= 90 THEN 'on target' WHEN pct >= 80 THEN 'watch' ELSE 'below' END AS otd_band
FROM (SELECT supplier_id, COUNT(*) AS n, CAST(COUNT(*) FILTER (WHERE lead_time_delta <= 0) AS DOUBLE) / COUNT(*) * 100 AS pct
      FROM fact_purchase_orders WHERE po_status = 'Closed' AND order_date >= {D} - INTERVAL 12 MONTH GROUP BY supplier_id) t
JOIN dim_suppliers s ON t.supplier_id = s.supplier_id""")
add("v_lead_time_scatter", f"""
SELECT supplier_name, supplier_type, {r(f'AVG({_LT})', 2)} AS avg_lead_time_days, {r(f'stddev_samp({_LT})', 2)} AS lead_time_std_dev,
       CAST(SUM(total_cost) AS DOUBLE) AS total_po_value
FROM fact_purchase_orders po JOIN dim_suppliers s ON po.supplier_id = s.supplier_id GROUP BY s.supplier_id, supplier_name, supplier_type""")
add("v_supplier_scorecard", f"""
SELECT supplier_name, supplier_type, country, on_time_pct, avg_actual_lead_time, lead_time_std_dev,
       CASE WHEN on_time_pct >= 90 THEN 'Preferred' WHEN on_time_pct >= 85 THEN 'Active' WHEN on_time_pct >= 75 THEN 'Monitor' ELSE 'Review' END AS supplier_status
FROM ({_LEAD}) t""")
add("v_late_deliveries", """
SELECT supplier_name, strftime(m, '%Y-%m') AS month, n AS received_pos, late AS late_deliveries
FROM (SELECT supplier_id, date_trunc('month', actual_receipt_date) AS m, COUNT(*) AS n, COUNT(*) FILTER (WHERE lead_time_delta > 3) AS late
      FROM fact_purchase_orders WHERE actual_receipt_date IS NOT NULL AND po_status = 'Closed' GROUP BY ALL) t
JOIN dim_suppliers s ON t.supplier_id = s.supplier_id""")
add("v_action_list", f"""
SELECT part_number, part_name, s.dealer_id, combined_class, qty_available, reorder_point, {r('qty_available / nullif(avg_daily_demand, 0)', 1)} AS days_of_stock, economic_order_qty
FROM short s LEFT JOIN abc a ON s.part_id = a.part_id AND s.dealer_id = a.dealer_id JOIN dim_parts p ON s.part_id = p.part_id""", *_SHORT_CTES)


def _cards() -> str:
    stock = "(SELECT CAST(SUM(CASE WHEN {c} THEN qty_on_hand * avg_unit_cost ELSE 0 END) AS DOUBLE) FROM latest)"
    idle = f"{D} - last_movement_date"
    dead, slow, total = (stock.format(c=c) for c in (f"{idle} > 365", f"{idle} > 180 AND NOT {idle} > 365", "TRUE"))
    turn = f"""(SELECT c / v FROM (SELECT CAST(SUM(cogs) AS DOUBLE) AS c FROM fact_sales WHERE transaction_date > {D} - INTERVAL 12 MONTH) a,
      (SELECT CAST(SUM(total_stock_value) AS DOUBLE) / COUNT(DISTINCT date_trunc('month', snapshot_date)) AS v FROM fact_inventory) b)"""
    cov = f"""(SELECT {r('AVG(x)', 4)} FROM (SELECT {r('coalesce(qty_available / nullif(q / 90.0, 0), 999)')} AS x FROM latest l LEFT JOIN (
      SELECT part_id, dealer_id, CAST(SUM(qty_sold) AS DOUBLE) AS q FROM fact_sales WHERE transaction_date > {D} - 90 GROUP BY ALL) s
      ON l.part_id = s.part_id AND l.dealer_id = s.dealer_id) z)"""
    active = "(SELECT COUNT(DISTINCT l.part_id) FROM latest l JOIN dim_parts p ON l.part_id = p.part_id WHERE is_active)"
    risk = "(SELECT COUNT(*) FROM short)"
    fill = f"(SELECT {_OK} FROM fact_sales)"
    po = "(SELECT {e} FROM fact_purchase_orders)"
    on_time = f"CAST(COUNT(*) FILTER (WHERE po_status = 'Closed' AND lead_time_delta <= 0) AS DOUBLE) / COUNT(*) {_CLOSED} * 100"
    delay = "AVG(CASE WHEN lead_time_delta > 0 AND po_status = 'Closed' THEN lead_time_delta END)"
    ytd = f"(SELECT {{e}} FROM fact_sales WHERE transaction_date BETWEEN date_trunc('year', {D}) AND {D})"
    net, prior = "SUM(qty_sold * unit_price * (100 - discount_pct))", f"(SELECT SUM(qty_sold * unit_price * (100 - discount_pct)) FROM fact_sales WHERE {_PRI})"
    growth = f"CAST({ytd.format(e=net)} - {prior} AS DOUBLE) / CAST({prior} AS DOUBLE)"
    margin = f"(SELECT CAST(SUM(revenue - cogs) AS DOUBLE) / ({NET}) * 100 FROM fact_sales)"
    per_part = """(SELECT CAST(SUM(qty_sold) AS DOUBLE) / (COUNT(DISTINCT part_id) * date_diff('month', min(transaction_date), max(transaction_date))) FROM fact_sales)"""
    mom = f"(SELECT coalesce(CAST(coalesce({_NOW}, 0) - {_THEN} AS DOUBLE) / nullif({_THEN}, 0), 0) * 100 FROM fact_sales WHERE transaction_date >= date_trunc('month', {D} - INTERVAL 1 MONTH))"
    share = f"""(SELECT CAST(SUM(CASE WHEN abc_class = 'A' THEN v ELSE 0 END) AS DOUBLE) / SUM(v) * 100 FROM (
      SELECT part_id, dealer_id, {NET} AS v FROM fact_sales GROUP BY ALL) s LEFT JOIN abc a ON s.part_id = a.part_id AND s.dealer_id = a.dealer_id)"""
    next_month = f"(SELECT SUM(forecast_qty) FROM nv_fc WHERE strftime(forecast_date, '%Y-%m') = strftime({D} + INTERVAL 1 MONTH, '%Y-%m'))"
    orders = f"(SELECT CAST(SUM(qty_ordered * unit_cost) AS DOUBLE) FROM fact_purchase_orders WHERE order_date BETWEEN date_trunc('year', {D}) AND {D})"
    cards = [
        ("revenue_vs_prior", r(growth, 4)),
        ("gross_profit_margin_pct", r(margin, 4)),
        ("avg_monthly_demand_per_part", r(per_part, 4)),
        ("demand_mom_growth_pct", r(mom, 4)),
        ("revenue_ytd", r(ytd.format(e=NET), 2)),
        ("units_ytd", ytd.format(e="CAST(SUM(qty_sold) AS DOUBLE)")),
        ("po_value_ytd", r(orders, 2)),
        ("avg_stock_coverage_days", cov),
        ("recommended_order_qty", "(SELECT CAST(coalesce(SUM(economic_order_qty), 0) AS DOUBLE) FROM short)"),
        ("a_class_revenue_share_pct", r(share, 4)),
        ("avg_forecast_mape", r("(SELECT CAST(SUM(CAST(mape AS DECIMAL(18,2))) AS DOUBLE) / COUNT(mape) FROM nv_fc)", 4)),
        ("next_month_forecast_qty", r(next_month, 2)),
        ("total_revenue", r(f"(SELECT {NET} FROM fact_sales)", 2)),
        ("total_units_sold", "(SELECT CAST(SUM(qty_sold) AS DOUBLE) FROM fact_sales)"),
        ("fill_rate_pct", r(fill, 4)),
        ("backorder_rate_pct", r(f"100.0 - {fill}", 4)),
        ("total_inventory_value", r(total, 2)),
        ("slow_moving_value", r(slow, 2)),
        ("dead_stock_value", r(dead, 2)),
        ("dead_stock_pct", r(f"{dead} / {total} * 100", 4)),
        ("active_sku_count", f"CAST({active} AS DOUBLE)"),
        ("inventory_turnover", r(turn, 4)),
        ("days_on_hand", r(f"365.0 / {r(turn, 4)}", 4)),
        ("supplier_on_time_pct", r(po.format(e=on_time), 4)),
        ("avg_lead_time_days", r(po.format(e=f"AVG({_LT})"), 4)),
        ("lead_time_std_dev", r(po.format(e=f"stddev_pop({_LT})"), 4)),
        ("total_po_value", r(po.format(e="CAST(SUM(qty_ordered * unit_cost) AS DOUBLE)"), 2)),
        ("avg_delay_days", r(po.format(e=delay), 4)),
        ("parts_at_risk_count", f"CAST({risk} AS DOUBLE)"),
        ("estimated_replenishment_cost", "(SELECT CAST(SUM(economic_order_qty * standard_cost) AS DOUBLE) FROM short)"),
        ("replenishment_urgency_score", r(f"0.60 * (100.0 - least({cov} / 30.0 * 100, 100)) + 0.40 * ({risk} * 100.0 / {active})", 4)),
        ("avg_safety_stock_days", he(f"(SELECT AVG({r('safety_stock_qty / greatest(avg_daily_demand, 0.001)')}) FROM pol)", 2)),
    ]
    return " UNION ALL ".join(f"SELECT '{n}' AS card, {v} AS value" for n, v in cards)


add("v_kpi_cards", _cards(), *_SHORT_CTES, NAIVE)
add("v_action_list_by_risk", f"""
SELECT part_number, part_name, s.dealer_id, combined_class, s.qty_available, s.reorder_point, {r('s.qty_available / nullif(avg_daily_demand, 0)', 1)} AS days_of_stock,
       c.p AS stockout_probability, economic_order_qty
FROM short s LEFT JOIN abc a ON s.part_id = a.part_id AND s.dealer_id = a.dealer_id JOIN dim_parts p ON s.part_id = p.part_id
     LEFT JOIN scores c ON s.part_id = c.part_id AND s.dealer_id = c.dealer_id""", *_SHORT_CTES, WINDOWS, BARE_FEATURES, SCORES)

# ---------------------------------------------------------------- an earlier day, as-of joins, labels
def _earlier(name: str) -> None:
    """The same query 200 days before the last transaction, over what was there by then."""
    sql = ORACLE[name].replace("fact_sales AS (", "fact_sales_all AS (", 1).replace("fact_inventory AS (", "fact_inventory_all AS (", 1)
    bounded = """today AS (SELECT max(transaction_date) - 200 AS d FROM fact_sales_all),
fact_sales AS (SELECT * FROM fact_sales_all WHERE transaction_date <= (SELECT d FROM today)),
fact_inventory AS (SELECT * FROM fact_inventory_all WHERE snapshot_date <= (SELECT d FROM today))"""
    ORACLE[f"{name}_earlier"] = sql.replace("today AS (SELECT max(transaction_date) AS d FROM fact_sales)", bounded, 1)


for _name in ("inventory_turnover", "fill_rate", "dead_stock", "stock_health", "abc_revenue", "demand_windows"):
    _earlier(_name)

add("stockout_risk_history", f"""
SELECT snapshot_date, effective_date, part_number, part_name, category, p.is_critical, dealer_name, qty_available, qty_in_transit, rop AS reorder_point,
       safety_stock_qty, {r('avg_daily_demand')} AS avg_daily_demand, {r('avg_lead_time_days')} AS avg_lead_time_days,
       {r('qty_available / nullif(avg_daily_demand, 0)', 1)} AS days_of_stock_remaining,
       CASE WHEN qty_available <= 0 THEN 'STOCKOUT' WHEN qty_available < safety_stock_qty THEN 'CRITICAL'
            WHEN qty_available < rop THEN 'ORDER NOW' WHEN qty_available < rop * CAST(1.2 AS DOUBLE) THEN 'WATCH' ELSE 'OK' END AS risk_level
FROM fact_inventory l ASOF LEFT JOIN versions v ON l.part_id = v.part_id AND l.dealer_id = v.dealer_id AND l.snapshot_date >= v.effective_date
     JOIN dim_parts p ON l.part_id = p.part_id JOIN dim_dealers d ON l.dealer_id = d.dealer_id""", ABC, STATS, POLICY, f"""
versions AS (SELECT part_id, dealer_id, safety_stock_qty, avg_daily_demand, avg_lead_time_days, reorder_point * f AS rop, {D} - age AS effective_date
             FROM pol CROSS JOIN (VALUES (0, 1), (30, 2), (400, 3), (800, 4)) t(age, f))""")
_RUN = """
run AS (SELECT part_id, dealer_id, day, CAST(SUM(q) OVER (PARTITION BY part_id, dealer_id ORDER BY day) AS BIGINT) AS sold
        FROM (SELECT part_id, dealer_id, transaction_date AS day, SUM(qty_sold) AS q FROM fact_sales GROUP BY ALL) t WHERE q > 0)"""
_FUTURE = """
ahead AS (
  SELECT part_id, dealer_id, snapshot_date, qty_available, lead(snapshot_date) OVER w AS next_date,
         min(CASE WHEN qty_available <= 0 THEN snapshot_date END) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS empty_date
  FROM fact_inventory WINDOW w AS (PARTITION BY part_id, dealer_id ORDER BY snapshot_date)),
due AS (SELECT a.*, coalesce(r.sold, 0) + greatest(qty_available, 0) AS due
        FROM ahead a ASOF LEFT JOIN run r ON a.part_id = r.part_id AND a.dealer_id = r.dealer_id AND a.snapshot_date >= r.day),
reached AS (SELECT a.*, CASE WHEN next_date IS NULL OR r.day < next_date THEN r.day END AS day
            FROM due a ASOF LEFT JOIN run r ON a.part_id = r.part_id AND a.dealer_id = r.dealer_id AND a.due <= r.sold),
gone AS (SELECT *, CASE WHEN qty_available <= 0 THEN snapshot_date ELSE least(empty_date, day) END AS gone_date FROM reached),
labelled AS (SELECT part_id, dealer_id, snapshot_date, qty_available, gone_date, CAST(gone_date - snapshot_date AS INT) AS days_to_stockout,
                    CASE WHEN gone_date - snapshot_date <= 14 THEN 1 ELSE 0 END AS stockout_within_horizon FROM gone)"""
add("future_stockout_label", "SELECT * FROM labelled", _RUN, _FUTURE)
add("future_label_counts", """
SELECT snapshot_date, COUNT(*) AS snapshots, CAST(SUM(stockout_within_horizon) AS BIGINT) AS stockouts FROM labelled GROUP BY snapshot_date""", _RUN, _FUTURE)
add("future_label_folds", """
SELECT fold, COUNT(*) AS snapshots, CAST(SUM(stockout_within_horizon) AS BIGINT) AS stockouts, min(snapshot_date) AS first_day, max(snapshot_date) AS last_day
FROM (SELECT *, CAST(CASE WHEN i < n - (n // 6) * 5 THEN 0 ELSE (i - (n - (n // 6) * 5)) // (n // 6) + 1 END AS INT) AS fold
      FROM (SELECT *, row_number() OVER (ORDER BY snapshot_date, part_id, dealer_id) - 1 AS i, COUNT(*) OVER () AS n FROM labelled) t) u
GROUP BY fold""", _RUN, _FUTURE)
add("snapshot_demand", "SELECT i.part_id, i.dealer_id, i.snapshot_date, " + ", ".join(
    f"coalesce(e.sold, 0) - coalesce(s{n}.sold, 0) AS qty_sold_{n}d" for n in (30, 60, 90)) + """
FROM (SELECT DISTINCT part_id, dealer_id, snapshot_date FROM fact_inventory) i
ASOF LEFT JOIN run e ON i.part_id = e.part_id AND i.dealer_id = e.dealer_id AND i.snapshot_date >= e.day""" + "".join(
    f" ASOF LEFT JOIN run s{n} ON i.part_id = s{n}.part_id AND i.dealer_id = s{n}.dealer_id AND i.snapshot_date - {n + 1} >= s{n}.day" for n in (30, 60, 90)), _RUN)

# ---------------------------------------------------------------- key x day state, periods, subtotals
_KEY_DAY = """
key_day AS (
  SELECT part_id, dealer_id, transaction_date, CAST(SUM(qty_sold) AS BIGINT) AS qty_sold, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(cogs) AS DOUBLE) AS cogs,
         CAST(SUM(backorder_qty) AS BIGINT) AS backorder_qty, COUNT(*) AS lines, COUNT(qty_sold) AS qty_lines,
         CAST(SUM(CAST(qty_sold AS BIGINT) * qty_sold) AS BIGINT) AS qty_squares, COUNT(*) FILTER (WHERE was_fulfilled) AS filled,
         COUNT(*) FILTER (WHERE NOT was_fulfilled) AS missed, CAST(SUM(qty_sold * unit_price * (100 - discount_pct)) AS DOUBLE) AS net
  FROM fact_sales GROUP BY part_id, dealer_id, transaction_date)"""
for _name in ("key_day_state", "key_day_state_update"):
    add(_name, "SELECT * FROM key_day", _KEY_DAY)
for _name in ("demand_windows", "fill_rate", "service_level"):
    ORACLE[f"key_day_{_name}"] = ORACLE[_name]


def _periods(by: str, source: str) -> str:
    """The standard periods by conditional sums over all days of each group."""
    spans = {
        "mtd": ("date_trunc('month', m)", "m"), "ytd": ("date_trunc('year', m)", "m"),
        "prior_month_mtd": ("date_trunc('month', m - INTERVAL 1 MONTH)", "m - INTERVAL 1 MONTH"),
        "prior_year_mtd": ("date_trunc('month', m) - INTERVAL 12 MONTH", "m - INTERVAL 12 MONTH"),
        "prior_year_ytd": ("date_trunc('year', m) - INTERVAL 12 MONTH", "m - INTERVAL 12 MONTH"),
        "trailing_12": ("m - INTERVAL 12 MONTH + INTERVAL 1 DAY", "m"),
    }
    value = lambda c, name, kind: f"CAST(coalesce(SUM({c}) FILTER (WHERE day BETWEEN {spans[name][0]} AND {spans[name][1]}), 0) AS {kind})"
    sums = [f"{value(c, name, kind)} AS {out}_{name}" for c, out, kind in (("q", "units", "BIGINT"), ("v", "revenue", "DOUBLE")) for name in spans]
    return f"""
SELECT {by}m AS anchor, {', '.join(sums)}
FROM (SELECT {by}transaction_date AS day, SUM(qty_sold) AS q, SUM(revenue) AS v FROM {source} GROUP BY ALL) d
CROSS JOIN (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(transaction_date)), date_trunc('month', max(transaction_date)), INTERVAL 1 MONTH)) AS DATE)) AS m
            FROM fact_sales) t GROUP BY {by}m"""


add("period_table", _periods("dealer_id, ", "fact_sales"))
add("period_table_total", _periods("", "fact_sales"))
add("period_table_category", _periods("category, ", "fact_sales s JOIN dim_parts p ON s.part_id = p.part_id"))
_LAST = f"transaction_date BETWEEN date_trunc('month', {D} - INTERVAL 1 MONTH) AND {D} - INTERVAL 1 MONTH"
_SUBTOTALS = f"""{r(NET, 2)} AS total_revenue, CAST(SUM(qty_sold) AS BIGINT) AS total_units_sold,
       {r(f'coalesce(CAST(SUM(revenue - cogs) AS DOUBLE) / nullif({NET}, 0), 0) * 100', 4)} AS gross_profit_margin_pct,
       {r(_OK, 4)} AS fill_rate_pct, {r(f'100.0 - {_OK}', 4)} AS backorder_rate_pct, COUNT(DISTINCT s.part_id) AS parts_sold,
       {r("coalesce(CAST(SUM(qty_sold) AS DOUBLE) / nullif(COUNT(DISTINCT s.part_id) * date_diff('month', min(transaction_date), max(transaction_date)), 0), 0)", 4)}
         AS avg_monthly_demand_per_part,
       {r(f'coalesce(CAST(coalesce(SUM(n) FILTER (WHERE {_CUR}), 0) - SUM(n) FILTER (WHERE {_PRI}) AS DOUBLE) / nullif(CAST(SUM(n) FILTER (WHERE {_PRI}) AS DOUBLE), 0), 0)', 4)}
         AS revenue_vs_prior,
       {r(f"coalesce(CAST(coalesce({_NOW}, 0) - SUM(qty_sold) FILTER (WHERE {_LAST}) AS DOUBLE) / nullif(CAST(SUM(qty_sold) FILTER (WHERE {_LAST}) AS DOUBLE), 0), 0) * 100", 4)}
         AS demand_mom_growth_pct"""
_LINES = "(SELECT *, qty_sold * unit_price * (100 - discount_pct) AS n, CAST(year(transaction_date) AS INT) AS year FROM fact_sales) s"
add("measure_rollup_dealer_type", f"""
SELECT dealer_id, customer_type, CAST(GROUPING(dealer_id, customer_type) AS INT) AS level, {_SUBTOTALS} FROM {_LINES} GROUP BY ROLLUP (dealer_id, customer_type)""")
add("measure_cube_category", f"""
SELECT category, dealer_id, year, CAST(GROUPING(category, dealer_id, year) AS INT) AS level, {_SUBTOTALS}
FROM {_LINES} JOIN dim_parts p ON s.part_id = p.part_id GROUP BY CUBE (category, dealer_id, year)""")
add("measure_rollup_stock", f"""
SELECT dealer_id, category, brand, CAST(GROUPING(dealer_id, category, brand) AS INT) AS level, {r(_VAL, 2)} AS total_inventory_value,
       {r(f'coalesce({_DEADV}, 0)', 2)} AS dead_stock_value, {r(f'coalesce({_DEADV} / nullif({_VAL}, 0), 0) * 100', 4)} AS dead_stock_pct,
       COUNT(DISTINCT l.part_id) AS sku_count
FROM latest l JOIN dim_parts p ON l.part_id = p.part_id GROUP BY ROLLUP (dealer_id, category, brand)""", LATEST)


# ---------------------------------------------------------------- stored tables
add("stored_parts", "SELECT CAST(part_id AS INT) AS part_id, part_number, part_name, CAST(standard_cost AS DOUBLE) AS standard_cost, is_critical FROM dim_parts")
add("stored_suppliers", "SELECT CAST(supplier_id AS INT) AS supplier_id, supplier_name, country, lead_time_days, is_preferred FROM dim_suppliers")
add("stored_dealers", "SELECT CAST(dealer_id AS INT) AS dealer_id, dealer_name, region FROM dim_dealers")
_MONTH = "CAST(date_trunc('month', {}) AS DATE) AS month"
add("stored_inventory", f"""
SELECT {_MONTH.format('snapshot_date')}, snapshot_date, CAST(part_id AS INT) AS part_id, dealer_id, qty_available, CAST(total_stock_value AS DOUBLE) AS total_stock_value
FROM fact_inventory""")
add("stored_sales_months", f"""
SELECT {_MONTH.format('transaction_date')}, dealer_id, COUNT(*) AS lines, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM fact_sales GROUP BY ALL""")
add("stored_purchase_orders", f"""
SELECT {_MONTH.format('order_date')}, CAST(po_number AS VARCHAR) AS po_number, po_line, CAST(part_id AS INT) AS part_id, CAST(supplier_id AS INT) AS supplier_id,
       order_date, qty_ordered, CAST(total_cost AS DOUBLE) AS total_cost, po_status FROM fact_purchase_orders""")
add("stored_abc_xyz", f"""
SELECT {_MONTH.format(D)}, CAST(part_id AS INT) AS part_id, dealer_id, combined_class, CAST(annual_revenue AS DOUBLE) AS annual_revenue FROM abc""", ABC)
add("stored_policies", f"""
SELECT {_MONTH.format(D)}, {D} AS effective_date, CAST(part_id AS INT) AS part_id, dealer_id, CAST(safety_stock_qty AS INT) AS safety_stock_qty,
       CAST(reorder_point AS INT) AS reorder_point, CAST(economic_order_qty AS INT) AS economic_order_qty, CAST(max_stock_level AS INT) AS max_stock_level FROM pol""",
    ABC, STATS, POLICY)
add("stored_forecasts", f"""
SELECT {_MONTH.format('forecast_date')}, forecast_date, CAST(part_id AS INT) AS part_id, dealer_id, forecast_qty, model_used FROM nk_fc""", NAIVE_KEY)
add("distinct_parts_sketch", """
SELECT category, COUNT(DISTINCT s.part_id) AS exact, TRUE AS within FROM fact_sales s JOIN dim_parts p ON s.part_id = p.part_id GROUP BY category""")
