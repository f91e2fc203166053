"""Serving queries over the fact and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adherence.functions.labels import display_label


def key_filter(df: DataFrame, key: str, value) -> DataFrame:
    """Rows whose ``key`` equals ``value``. ``value`` may be a literal,
    a Column, or a DataFrame holding the wanted keys in column ``key`` (then a
    left-semi join, broadcast when the frame is a bounded selection such as
    a ``limit``)."""
    if value is None:
        return df
    if isinstance(value, DataFrame):
        return df.join(value.select(key).distinct(), key, "left_semi")
    v = value if isinstance(value, Column) else F.lit(value)
    return df.filter(F.col(key) == v)


def enrich(facts: DataFrame, trips: DataFrame, routes: DataFrame, trip_key: str = "trip_id",
           route_key: str = "route_id",
           trip_cols: Sequence[str] = ("route_id", "trip_headsign", "direction_id"),
           route_cols: Sequence[str] = ("route_short_name",)) -> DataFrame:
    """J3 + J4 (R6): facts joined with their trip (inner) and the trip's
    route (left outer). Only the named dimension columns are read."""
    t = trips.select(trip_key, *[c for c in trip_cols if c != trip_key])
    r = routes.select(route_key, *[c for c in route_cols if c != route_key])
    return facts.join(t, trip_key, "inner").join(r, route_key, "left")


def trip_options(facts: DataFrame, trips: DataFrame, routes: DataFrame, n: int = 100,
                 trip_key: str = "trip_id", route_key: str = "route_id",
                 route_name: str = "route_short_name", headsign: str = "trip_headsign") -> DataFrame:
    """Distinct (trip, route, route name, headsign) of trips that have
    facts, the ``n`` highest trip ids, with a display label.

    The reference joins every fact row before grouping. Here the fact side is
    first reduced to its distinct trip ids (partial aggregate, one shuffle of
    ids only), restricted to ids present in ``trips``, and only the top ``n``
    ids (a per-partition top-k) are joined back with the dimensions; the
    result rows all belong to those ids, so the answer is the same.
    Order: trip id descending, the other columns ascending (nulls last) as
    tie-break, since the reference's order is partial."""
    t = trips.select(trip_key, route_key, headsign)
    ids = facts.select(trip_key).distinct().join(t.select(trip_key), trip_key, "left_semi")
    top_ids = ids.orderBy(F.col(trip_key).desc()).limit(n)
    rows = (t.join(F.broadcast(top_ids), trip_key, "left_semi")
             .join(routes.select(route_key, route_name), route_key, "left")
             .select(trip_key, route_key, route_name, headsign).distinct())
    ordered = rows.orderBy(F.col(trip_key).desc(), F.col(route_key).asc_nulls_last(),
                           F.col(route_name).asc_nulls_last(), F.col(headsign).asc_nulls_last()).limit(n)
    return ordered.withColumn("display", display_label(trip_key, route_name, headsign))


def option_map(options: DataFrame, label: str = "display", value: str = "trip_id") -> DataFrame:
    """Label -> value, one row per label; on equal labels the last row
    (here: the greatest value) wins."""
    return options.groupBy(label).agg(F.max(value).alias(value))


def late_stops(facts: DataFrame, trip=None, trip_key: str = "trip_id", delay_col: str = "delay_seconds",
               cols: Sequence[str] = ("stop_sequence", "stop_id", "scheduled_epoch", "actual_epoch",
                                      "delay_seconds")) -> DataFrame:
    """The late stops (delay > 0) of one trip, or of all trips when
    ``trip`` is None (then the trip key is kept), in stop order."""
    df = key_filter(facts, trip_key, trip).filter(F.col(delay_col) > 0)
    if trip is None:
        return df.select(trip_key, *cols).orderBy(trip_key, "stop_sequence", "stop_id")
    return df.select(*cols).orderBy("stop_sequence", "stop_id")


def trip_info(trips: DataFrame, trip, trip_key: str = "trip_id",
              cols: Sequence[str] = ("route_id", "trip_headsign", "direction_id")) -> DataFrame:
    """(route, headsign, direction) of one trip, first row or none (O4:
    the smallest row, so the choice is repeatable). With a DataFrame of trip
    ids, one row per trip (``min`` of the struct per trip)."""
    df = key_filter(trips, trip_key, trip)
    if isinstance(trip, DataFrame):
        first = F.min(F.struct(*cols)).alias("_r")
        return df.groupBy(trip_key).agg(first).select(trip_key, *[F.col("_r")[c].alias(c) for c in cols])
    return df.select(*cols).orderBy(*cols).limit(1)


def delay_series(facts: DataFrame, trip=None, trip_key: str = "trip_id") -> DataFrame:
    """(stop_sequence, delay_seconds) of the late stops of a trip."""
    return late_stops(facts, trip, trip_key).select("stop_sequence", "delay_seconds") if trip is not None \
        else late_stops(facts, None, trip_key).select(trip_key, "stop_sequence", "delay_seconds")


def top_k(df: DataFrame, key: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """O1: the ``n`` rows with the highest ``key``."""
    return df.orderBy(F.col(key).desc(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(n)
