"""Flatten decoded feeds (P3-P11, U1, U2, R3, K4) with built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def trip_entities(decoded: DataFrame) -> DataFrame:
    """Entity rows that carry a trip update."""
    return decoded.filter(F.col("entity.trip_update").isNotNull())


def explode_entities(feeds: DataFrame) -> DataFrame:
    """P5 for feed-level rows: one row per entity with its position."""
    meta = [c for c in feeds.columns if c != "entity"]
    return feeds.select(*meta, F.posexplode("entity").alias("entity_pos", "entity"))


def stop_updates(decoded: DataFrame, defaults: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """P3 + P6 + P8: one row per stop-time update of each trip entity.

    ``defaults`` applies the proto defaults the reference relied on: absent
    trip_id / stop_id -> '' and absent stop_sequence -> 0. Columns: feed time,
    entity position and id, trip fields, stop position and the stop event
    fields (NULL when absent)."""
    tu = trip_entities(decoded)
    ex = tu.select(*keep, F.col("header.timestamp").alias("feed_ts"), "entity_pos",
                   F.col("entity.id").alias("entity_id"), F.col("entity.is_deleted").alias("is_deleted"),
                   F.col("entity.trip_update").alias("tu"),
                   F.posexplode("entity.trip_update.stop_time_update").alias("stop_pos", "stu"))
    trip_id = F.col("tu.trip.trip_id")
    stop_id = F.col("stu.stop_id")
    seq = F.col("stu.stop_sequence")
    if defaults:
        trip_id, stop_id, seq = F.coalesce(trip_id, F.lit("")), F.coalesce(stop_id, F.lit("")), \
            F.coalesce(seq, F.lit(0).cast("bigint"))
    return ex.select(
        *keep, "feed_ts", "entity_pos", "entity_id", "is_deleted",
        trip_id.alias("trip_id"), F.col("tu.trip.route_id").alias("route_id"),
        F.col("tu.trip.start_date").alias("start_date"),
        F.col("tu.trip.schedule_relationship").alias("trip_relationship"),
        F.col("tu.delay").alias("trip_delay"), "stop_pos",
        stop_id.alias("stop_id"), seq.alias("stop_sequence"),
        F.col("stu.arrival.time").alias("arrival_epoch"), F.col("stu.departure.time").alias("departure_epoch"),
        F.col("stu.arrival.delay").alias("arrival_delay"), F.col("stu.departure.delay").alias("departure_delay"),
        F.col("stu.schedule_relationship").alias("stop_relationship"))


def first_trip(feeds: DataFrame) -> DataFrame:
    """P9 on feed-level rows: the FIRST entity with a trip update; a feed
    without one (or a reject) gives (NULL, NULL, 0) as the reference's UDF.
    A per-row expression, no shuffle."""
    first = F.get(F.filter("entity", lambda e: e["trip_update"].isNotNull()), 0)["trip_update"]
    meta = [c for c in feeds.columns if c not in ("entity", "header", "decode_error")]
    return feeds.select(*meta, *_trip_fields(first), delay_default(first["delay"]).alias("delay"))


def _trip_fields(update: Column, *names: str) -> list[Column]:
    """Text fields of an update's trip: '' when the trip lacks one, NULL only
    when there is no update."""
    return [F.when(update.isNotNull(), F.coalesce(update["trip"][n], F.lit(""))).alias(n)
            for n in names or ("trip_id", "route_id")]


def delay_default(c: Column) -> Column:
    """P10: trip-level delay, 0 when absent."""
    return F.coalesce(c, F.lit(0))


def trip_update_rows(decoded_trip_updates: DataFrame, with_time: bool = True) -> DataFrame:
    """P11 (+F9) on bare trip-update records: (trip_id, start_date, route_id,
    processing time)."""
    cols = _trip_fields(F.col("message"), "trip_id", "start_date", "route_id")
    if with_time:
        cols.append(F.current_timestamp().alias("timestamp"))
    return decoded_trip_updates.filter(F.col("decode_error").isNull()).select(*cols)


def vehicle_positions(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat vehicle positions of entity rows."""
    v = F.col("entity.vehicle")
    return decoded.filter(v.isNotNull()).select(
        *keep, F.col("header.timestamp").alias("feed_ts"), "entity_pos", F.col("entity.id").alias("entity_id"),
        v["vehicle"]["id"].alias("vehicle_id"), v["vehicle"]["label"].alias("vehicle_label"),
        v["trip"]["trip_id"].alias("trip_id"), v["trip"]["route_id"].alias("route_id"),
        v["position"]["latitude"].alias("latitude"), v["position"]["longitude"].alias("longitude"),
        v["position"]["bearing"].alias("bearing"), v["position"]["speed"].alias("speed"),
        v["current_stop_sequence"].alias("current_stop_sequence"), v["current_status"].alias("current_status"),
        v["stop_id"].alias("stop_id"), v["timestamp"].alias("vehicle_ts"))


def latest_vehicles(positions: DataFrame, order: Sequence[str] = ("feed_ts", "entity_pos")) -> DataFrame:
    """The last position of every vehicle."""
    from adherence.operators.latest import latest_per_key
    return latest_per_key(positions, ["vehicle_id"], [c for c in positions.columns if c != "vehicle_id"], list(order))


def active_only(stops: DataFrame) -> DataFrame:
    """K4: drop skipped stops, cancelled or deleted trips, deleted entities."""
    return stops.filter(
        (F.coalesce(F.col("stop_relationship"), F.lit("SCHEDULED")) != "SKIPPED")
        & ~F.coalesce(F.col("trip_relationship"), F.lit("SCHEDULED")).isin("CANCELED", "DELETED")
        & ~F.coalesce(F.col("is_deleted"), F.lit(False)))


# ------------------------------------------------------------ U1 / U2
FIRST_TRIP_DDL = "struct<trip_id: string, route_id: string, delay: int>"


def first_trip_udf():
    """Bytes -> (trip_id, route_id, delay) of the first trip update, as
    an Arrow-batched pandas UDF (never row at a time). Bad bytes or no trip
    update -> (NULL, NULL, 0)."""
    @F.pandas_udf(FIRST_TRIP_DDL)
    def parse_first_trip(values: pd.Series) -> pd.DataFrame:
        from adherence.streaming.feed import first_update
        trips, routes, delays = [], [], []
        for u in map(first_update, values):
            trip = None if u is None else u.trip
            trips.append(None if u is None else trip.trip_id)
            routes.append(None if u is None else trip.route_id)
            delays.append(0 if u is None else u.delay)
        return pd.DataFrame({"trip_id": pd.Series(trips, dtype=object), "route_id": pd.Series(routes, dtype=object),
                             "delay": np.array(delays, np.int32)})

    return parse_first_trip


def register_udfs(spark: SparkSession, name: str = "parse_first_trip") -> str:
    """Register the parser by name; call with ``F.call_function(name, col)``
    or in SQL."""
    spark.udf.register(name, first_trip_udf())
    return name
