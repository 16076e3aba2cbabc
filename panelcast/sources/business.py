"""The four monthly business extracts, derived from the driver's star schema.

The reference pulls four monthly tables out of a SQL database (weighted
sales forecast, rig counts, actuals by scenario, oil prices). The driver
tables carry no such facts, so this module fixes one mapping onto them:

=================  ===========================================================
basin, division    ``r_name``, ``c_mktsegment`` via customer -> nation -> region
weighted forecast  sum of ``l_extendedprice*(1-l_discount)`` by order month,
                   order year > 1995 (S1)
rig counts         orders per region, month and priority (the "environment");
                   scenario ALL = all orders, EXCL = status <> 'P' (S2)
actuals            by ship month: REV = sum of net price, CM = sum of
                   ``net - 0.6*extendedprice`` (S3)
oil prices         monthly mean ``o_totalprice``: WTI from 1-URGENT orders,
                   Brent from 5-LOW orders (S4)
eliminations       region AFRICA plays the eliminations basin (P3)
=================  ===========================================================

Money is summed exactly (integer cents in the large aggregations, DECIMAL
on the small results) so that every engine and every shuffle order gives
the same totals (float sums would differ in the last bits and could flip a
half-even rounding tie). Query edges cast to DOUBLE once.

Scale notes (lineitem and orders are the only large inputs):

* basin and division are attached to orders first (three narrow columns; customers
  with their geography are the other side, an ordinary exchange, so a customer that
  holds a third of all orders is split by the adaptive planner's skew join);
* lineitem is joined to these orders on the order key (unique in orders, at most
  seven lines per order: no skew), projected to four columns at the scan, and
  aggregated map-side straight to (order month, ship month, basin, division): lines
  cross the network once, orders twice, the last exchange is months^2 x cells small;
* rig counts and oil prices come from one aggregate of orders (:func:`order_cells`),
  so orders and customers are scanned twice for the whole panel;
* nation and region are tiny dimension scans; the planner broadcasts them
  behind its own size check (``autoBroadcastJoinThreshold``), no hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.calendar import month_key, month_start
from .tables import Tables

# Fixed values of the star-schema mapping.
ELIMINATIONS_BASIN = "AFRICA"
RIG_ALL = "ALL"
RIG_EXCL = "EXCL"
ACTUALS_CM = "CM"
ACTUALS_REV = "REV"
EXCLUDED_ORDER_STATUS = "P"
WTI_PRIORITY = "1-URGENT"
BRENT_PRIORITY = "5-LOW"
MARGIN_COST_SHARE = "0.6"
WEIGHTED_FROM = "1996-01-01"  # kept: order year > 1995


def customer_geo(t: Tables) -> DataFrame:
    """customer -> (custkey, basin, division)."""
    nation = t.nation.select("n_nationkey", "n_regionkey")
    region = t.region.select("r_regionkey", F.col("r_name").alias("basin"))
    return (t.customer
            .select(F.col("c_custkey").alias("custkey"), "c_nationkey",
                    F.col("c_mktsegment").alias("division"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("custkey", "basin", "division"))


def _cents(c: str) -> F.Column:
    """Money/rate given as a double with two decimals -> exact integer hundredths."""
    return F.round(F.col(c) * 100).cast("bigint")


def sales_fact(t: Tables, orders_from: str | None = None) -> DataFrame:
    """Net and gross sales by (order month, ship month, basin, division).

    The single pass over lineitem shared by the weighted forecast (S1) and the
    actuals (S3). Its size is months^2 x basins x divisions, independent of the
    number of line items. ``orders_from`` keeps orders from that day on, as a range
    the scan of orders can prune with (P1).

    The large aggregations run on exact integers: net price in 1e-4 units
    (cents x (100 - discount percent)), gross in cents. Spark's ``sum`` of a
    DECIMAL widens it past 18 digits, which forces boxed BigDecimal buffers
    and sort-based aggregation; bigint sums keep the fixed-width hash
    aggregate (overflow raises under ANSI mode, it never wraps). The result
    is turned into DECIMAL only on the small fact.
    """
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("orderkey"), month_start("l_shipdate").alias("ship_month"),
        (_cents("l_extendedprice") * (F.lit(100) - _cents("l_discount"))).alias("net_e4"),
        _cents("l_extendedprice").alias("gross_e2"))
    orders = t.orders
    if orders_from is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(orders_from).cast("timestamp_ntz"))
    placed = (orders.select(F.col("o_orderkey").alias("orderkey"),
                            F.col("o_custkey").alias("custkey"),
                            month_start("o_orderdate").alias("order_month"))
              .join(customer_geo(t), "custkey")
              .select("orderkey", "order_month", "basin", "division"))
    fact = (lines.join(placed, "orderkey")
            .groupBy("order_month", "ship_month", "basin", "division")
            .agg(F.sum("net_e4").alias("net_e4"), F.sum("gross_e2").alias("gross_e2")))
    return fact.select(
        "order_month", "ship_month", "basin", "division",
        (F.col("net_e4").cast("decimal(38,0)") / 10000).cast("decimal(38,4)").alias("net"),
        (F.col("gross_e2").cast("decimal(38,0)") / 100).cast("decimal(38,2)").alias("gross"))


def weighted_monthly(fact: DataFrame) -> DataFrame:
    """Weighted forecast by month, basin, division; year > 1995. Over a fact
    built with ``orders_from=WEIGHTED_FROM`` the range is part of the scan."""
    return (fact.where(F.col("order_month") >= F.lit(WEIGHTED_FROM).cast("date"))
            .groupBy("order_month", "basin", "division")
            .agg(F.sum("net").alias("weighted_fcst"))
            .select(month_key("order_month").alias("year_month"), "basin", "division",
                    "weighted_fcst"))


def actuals_monthly(fact: DataFrame) -> DataFrame:
    """S3: long actuals table (year_month, basin, division, total, scenario)."""
    margin = F.col("net") - F.lit(MARGIN_COST_SHARE).cast("decimal(2,1)") * F.col("gross")
    wide = (fact.groupBy("ship_month", "basin", "division")
            .agg(F.sum("net").alias("rev"), F.sum(margin).alias("cm")))
    return wide.select(
        month_key("ship_month").alias("year_month"), "basin", "division",
        F.inline(F.array(
            F.struct(F.col("cm").alias("total"), F.lit(ACTUALS_CM).alias("scenario")),
            F.struct(F.col("rev").alias("total"), F.lit(ACTUALS_REV).alias("scenario")))))


def order_cells(t: Tables) -> DataFrame:
    """Orders by (month, basin, priority, status): count and total in cents. Orders of
    unknown customers stay with a NULL basin (they count for oil, not for rigs)."""
    orders = t.orders.select(
        F.col("o_custkey").alias("custkey"), month_start("o_orderdate").alias("month"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        _cents("o_totalprice").alias("cents"))
    return (orders.join(customer_geo(t).select("custkey", "basin"), "custkey", "left")
            .groupBy("month", "basin", "priority", "status")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")))


def rig_counts(cells: DataFrame) -> DataFrame:
    """S2 from :func:`order_cells`: (year_month, basin, environment, rig_count,
    rig_total, scenario).

    ``rig_total`` repeats the basin total on every environment row of the
    month, as the source view does, so a quarterly mean averages rows.
    """
    kept = F.col("status") != EXCLUDED_ORDER_STATUS
    wide = (cells.where(F.col("basin").isNotNull())
            .groupBy("month", "basin", F.col("priority").alias("environment"))
            .agg(F.sum("n").alias("n_all"), F.sum(F.when(kept, F.col("n")).otherwise(0)).alias("n_excl")))
    long = (wide.select(
                "month", "basin", "environment",
                F.inline(F.array(
                    F.struct(F.col("n_all").alias("rig_count"), F.lit(RIG_ALL).alias("scenario")),
                    F.struct(F.col("n_excl").alias("rig_count"), F.lit(RIG_EXCL).alias("scenario")))))
            .where(F.col("rig_count") > 0))
    total = F.sum("rig_count").over(Window.partitionBy("month", "basin", "scenario"))
    return long.select(month_key("month").alias("year_month"), "basin", "environment",
                       F.col("rig_count").cast("bigint").alias("rig_count"),
                       total.cast("bigint").alias("rig_total"), "scenario")


def oil_prices(cells: DataFrame) -> DataFrame:
    """S4 from :func:`order_cells`: monthly (year_month, brent, wti) as mean order
    totals per priority."""
    prio = F.col("priority")

    def mean_of(p: str) -> F.Column:
        # exact cents sum -> double -> / 100 equals the DECIMAL sum cast to double
        s = F.sum(F.when(prio == p, F.col("cents"))).cast("double") / 100
        n = F.sum(F.when(prio == p, F.col("n")))
        return F.try_divide(s, F.nullif(n, F.lit(0)).cast("double"))

    return (cells.where(prio.isin(WTI_PRIORITY, BRENT_PRIORITY))
            .groupBy("month")
            .agg(mean_of(BRENT_PRIORITY).alias("brent"), mean_of(WTI_PRIORITY).alias("wti"))
            .select(month_key("month").alias("year_month"), "brent", "wti"))
