"""Bind the logical schedule tables to the driver's star-schema tables.

The operators take column names as parameters; these bindings only rename
and derive columns, so every query reads the whole given tables and its work
grows with them. Scans select only the needed columns, so the parquet reader
prunes the rest.

  routes      <- customer  (route_id=c_custkey, route_short_name=c_name, route_type=c_nationkey)
  trips       <- orders    (trip_id=o_orderkey, route_id=o_custkey, service_id=o_orderpriority,
                            trip_headsign=o_orderstatus, direction_id=o_orderkey % 2)
  stops       <- supplier  (stop_id=s_suppkey, stop_name=s_name)
  calendar    <- orders per o_orderpriority (first/last o_orderdate as yyyyMMdd)
  stop_times  <- lineitem per (l_orderkey, l_suppkey, l_linenumber), a clock time
                 derived from quantity, line number and supplier
  stop updates<- lineitem rows: arrival epoch from l_shipdate and l_partkey
                 (absent when l_returnflag = 'A'), departure 30 s later
                 (absent when also l_linestatus = 'O'); arrival order is the
                 struct of l_shipdate and the remaining columns
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.functions.schedule import epoch_of_ntz

KEYS = ("trip_id", "stop_id", "stop_sequence")
ORDER_COLS = ("l_shipdate", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def routes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("route_id"),
        F.col("c_name").alias("route_short_name"),
        F.col("c_nationkey").alias("route_type"))


def trips(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("route_id"),
        F.col("o_orderpriority").alias("service_id"),
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_orderstatus").alias("trip_headsign"),
        (F.col("o_orderkey") % 2).cast("int").alias("direction_id"))


def stops(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("stop_id"), F.col("s_name").alias("stop_name"))


def calendar(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("service_id"))
             .agg(F.date_format(F.min("o_orderdate"), "yyyyMMdd").alias("start_date"),
                  F.date_format(F.max("o_orderdate"), "yyyyMMdd").alias("end_date")))


def _hours(q: F.Column) -> F.Column:
    return F.when(q % 5 == 0, 26 + q % 4).otherwise(4 + q % 20)


def stop_times_raw(spark, sf_dir) -> DataFrame:
    """One clock time per lineitem row (keys may repeat)."""
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int")
    clock = F.format_string("%02d:%02d:%02d", _hours(q), (F.col("l_linenumber") * 7) % 60,
                            F.col("l_suppkey") % 60)
    return li.select(F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("stop_id"),
                     F.col("l_linenumber").alias("stop_sequence"), clock.alias("arrival_time"))


def stop_times(spark, sf_dir) -> DataFrame:
    """Timetable rows, one per (trip_id, stop_id, stop_sequence), earliest clock."""
    return (stop_times_raw(spark, sf_dir).groupBy(*KEYS)
            .agg(F.min("arrival_time").alias("arrival_time")))


def stop_updates(spark, sf_dir, with_order: bool = True) -> DataFrame:
    """Flat stop-time updates with nullable arrival/departure epochs."""
    li = table(spark, sf_dir, "lineitem")
    base = epoch_of_ntz("l_shipdate") + (F.col("l_partkey") * 37) % 86400
    arr = F.when(F.col("l_returnflag") != "A", base)
    dep = F.when(~((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")), base + 30)
    cols = [F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("stop_id"),
            F.col("l_linenumber").alias("stop_sequence"),
            arr.alias("arrival_epoch"), dep.alias("departure_epoch")]
    if with_order:
        cols.append(F.struct(*ORDER_COLS).alias("arrival_order"))
    return li.select(*cols)


def events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")
