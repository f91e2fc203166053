"""Feeds made from the given tables (for the proof queries and benchmarks).

Stop updates of lineitem (see plans.bindings) with their order's customer as
route, order date as start date and a trip-level delay for finished orders,
grouped into one feed per (ship day, block of 64 trip ids): a feed holds the
trips of one day in an id range, like a regional snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.functions.schedule import epoch_of_ntz
from adherence.plans import bindings as B
from adherence.streaming.feed import encode_feeds

TRIP_BLOCK = 64


def feed_rows(spark, sf_dir) -> DataFrame:
    o = B.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("route_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"),
        F.when(F.col("o_orderstatus") == "F", (F.col("o_totalprice").cast("bigint") % 600 - 300).cast("int"))
         .alias("trip_delay"))
    day = F.to_date("l_shipdate")
    li = B.table(spark, sf_dir, "lineitem")
    base = epoch_of_ntz("l_shipdate") + (F.col("l_partkey") * 37) % 86400
    rows = li.select(
        F.concat(F.date_format("l_shipdate", "yyyyMMdd"), F.lit("/"),
                 F.floor(F.col("l_orderkey") / TRIP_BLOCK).cast("string")).alias("feed_key"),
        epoch_of_ntz(F.to_timestamp_ntz(day)).alias("feed_ts"),
        F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("stop_id"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.when(F.col("l_returnflag") != "A", base).alias("arrival_time"),
        F.when(~((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")), base + 30).alias("departure_time"))
    return rows.join(o, "trip_id", "left")


def feeds(spark, sf_dir, partitions: int | None = None) -> DataFrame:
    return encode_feeds(feed_rows(spark, sf_dir), partitions=partitions)
