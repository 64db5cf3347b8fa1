"""Star schema over the order-processing tables (orders, lineitem, part, ...).

``Star`` binds a folder of Parquet tables and exposes the dimension and fact
frames lazily; each property is a logical plan, nothing runs on access.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.operators.key_day import key_day_state
from stocklens.sources.scratch import materialize, partitions

# Declared types: no footer has to be read to plan a query.
SOURCES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


def _dec(col: Column, precision: int = 16, scale: int = 2) -> Column:
    return col.cast(f"decimal({precision},{scale})")


class Star:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[table]).parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def as_of(self) -> dt.date:
        """Latest transaction date: one aggregate over one column."""
        return self.raw("lineitem").agg(F.max(F.col("l_shipdate").cast("date"))).first()[0]

    # -- dimensions
    @cached_property
    def dealers(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").alias("dealer_id"),
            F.col("r_name").alias("dealer_name"),
            F.col("r_name").alias("region"),
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        s = self.raw("supplier").join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        kind = F.col("s_suppkey") % 3
        return s.select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.col("n_name").alias("country"),
            F.when(kind == 0, "OEM").when(kind == 1, "OES").otherwise("Aftermarket").alias("supplier_type"),
            self._contract_days("s_suppkey").alias("lead_time_days"),
            (F.col("s_acctbal") > 5000).alias("is_preferred"),
        )

    @staticmethod
    def _contract_days(key: str) -> Column:
        return (F.lit(5) + F.col(key) % 38).cast("int")

    @cached_property
    def parts(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("part_id"),
            F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("part_number"),
            F.col("p_name").alias("part_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            _dec(F.col("p_retailprice") * 0.6, 12).alias("standard_cost"),
            _dec(F.col("p_retailprice"), 12).alias("list_price"),
            (F.col("p_size") > 42).alias("is_critical"),
            (F.col("p_size") > 2).alias("is_active"),
        )

    # -- facts
    def _lines(self) -> DataFrame:
        """Order lines with the dealer of the ordering customer and the part cost.

        Written small to large: nation and customer reduce to (customer, dealer),
        that joins orders, and the result joins the lines once.
        """
        dealer = self.raw("customer").join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        orders = (
            self.raw("orders")
            .join(dealer, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "o_orderdate", "o_orderpriority", "c_mktsegment", "n_regionkey")
        )
        cost = self.raw("part").select("p_partkey", _dec(F.col("p_retailprice") * 0.6, 12).alias("cost"))
        return (
            self.raw("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(cost, F.col("l_partkey") == F.col("p_partkey"))
        )

    @cached_property
    def sales(self) -> DataFrame:
        qty = F.col("l_quantity").cast("int")
        cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
        base = self._lines().select(
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            F.col("l_partkey").alias("part_id"),
            F.col("n_regionkey").alias("dealer_id"),
            F.col("c_mktsegment").alias("customer_type"),
            F.col("o_orderpriority").alias("order_source"),
            qty.alias("qty_sold"),
            _dec(cents * F.lit("0.01").cast("decimal(3,2)"), 12).alias("unit_price"),
            _dec(F.col("l_discount") * 100, 5).alias("discount_pct"),
            _dec(qty * F.col("cost")).alias("cogs"),
            (F.col("l_returnflag") != "R").alias("was_fulfilled"),
        )
        net = F.col("qty_sold") * F.col("unit_price") * (100 - F.col("discount_pct"))
        return base.select(
            "*",
            _dec(F.round(net * F.lit("0.01").cast("decimal(3,2)"), 2)).alias("revenue"),
            F.when(F.col("was_fulfilled"), 0).otherwise(F.col("qty_sold")).alias("backorder_qty"),
        )

    @cached_property
    def state(self) -> DataFrame:
        """Sales per part, dealer and day, written once: what several key-level operators read instead of the fact."""
        return materialize(key_day_state(self.sales), "key_day")

    @cached_property
    def inventory(self) -> DataFrame:
        """A month-start snapshot per part and dealer for every month of sales.

        Dealers (one per region) are a short array taken as a scalar subquery and
        exploded per part, months a few rows sent to every task: the snapshot table is
        generated in parallel over parts. Spark takes rows made by ``explode`` for as
        large as the rows they come from, so that the latest stock of all parts passed
        for a table small enough to broadcast; by a join it knows that they are many.
        """
        month = F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("snapshot_date")
        months = F.broadcast(self.raw("lineitem").select(month).where("snapshot_date IS NOT NULL").distinct())
        dealers = self.raw("region").select(F.array_sort(F.collect_list("r_regionkey"))).scalar()
        # Dealt by part while it is small: each part becomes a row per dealer and month, and what is grouped by part stays in its task.
        grid = (
            self.raw("part")
            .repartition(partitions(self.spark), "p_partkey")
            .select("p_partkey", "p_retailprice", F.explode(dealers).alias("dealer_id"))
            .crossJoin(months)
        )
        part, dealer = F.col("p_partkey"), F.col("dealer_id")
        mo = F.year("snapshot_date") * 12 + F.month("snapshot_date")
        base = grid.select(
            "snapshot_date",
            part.alias("part_id"),
            "dealer_id",
            ((part * 7 + dealer * 13 + mo * 5) % 121).cast("int").alias("qty_on_hand"),
            ((part + mo) % 15).cast("int").alias("qty_reserved"),
            ((part * 3 + dealer) % 40).cast("int").alias("qty_in_transit"),
            _dec(F.col("p_retailprice") * 0.6, 12).alias("avg_unit_cost"),
        )
        idle = ((F.col("part_id") * 11 + dealer * 17) % 500).cast("int")
        return base.select(
            "*",
            (F.col("qty_on_hand") - F.col("qty_reserved")).alias("qty_available"),
            _dec(F.col("qty_on_hand") * F.col("avg_unit_cost")).alias("total_stock_value"),
            F.date_sub("snapshot_date", idle).alias("last_movement_date"),
        )

    @cached_property
    def purchase_orders(self) -> DataFrame:
        ordered = F.col("o_orderdate").cast("date")
        slip = ((F.col("l_orderkey") + F.col("l_linenumber")) % 15 - 4).cast("int")
        lead = (self._contract_days("l_suppkey") + slip).cast("int")
        closed = F.col("l_linestatus") == "F"
        qty = F.col("l_quantity").cast("int")
        return self._lines().select(
            F.col("l_orderkey").alias("po_number"),
            F.col("l_linenumber").alias("po_line"),
            F.col("l_partkey").alias("part_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("n_regionkey").alias("dealer_id"),
            ordered.alias("order_date"),
            F.date_add(ordered, self._contract_days("l_suppkey")).alias("promised_date"),
            F.when(closed, F.date_add(ordered, lead)).alias("actual_receipt_date"),
            F.when(closed, lead).alias("lead_time_actual"),
            F.when(closed, slip).alias("lead_time_delta"),
            qty.alias("qty_ordered"),
            F.col("cost").alias("unit_cost"),
            F.when(closed, "Closed").otherwise("Open").alias("po_status"),
            _dec(qty * F.col("cost")).alias("total_cost"),
        )
