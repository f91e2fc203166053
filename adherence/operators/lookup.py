"""Schedule lookup (J2): stop updates joined with their timetable row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.session import dealt


def unique_schedule(stop_times: DataFrame, keys: Sequence[str], time_col: str = "arrival_time") -> DataFrame:
    """At most one timetable row per key (the reference takes an arbitrary
    one; here the smallest clock string, so results are repeatable)."""
    return stop_times.groupBy(*keys).agg(F.min(time_col).alias(time_col))


def lookup_table(stop_times: DataFrame, keys: Sequence[str], time_col: str = "arrival_time") -> DataFrame:
    """``unique_schedule`` stored in buckets of the keys: the batches of a stream
    that look up in it do not shuffle it."""
    n = int(stop_times.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt(unique_schedule(stop_times.select(*keys, time_col).repartition(n, *keys), keys, time_col), keys)


def schedule_lookup(updates: DataFrame, stop_times: DataFrame,
                    keys: Sequence[str] = ("trip_id", "stop_id", "stop_sequence"),
                    time_col: str = "arrival_time", dedupe: bool = True,
                    broadcast_updates: bool = False, shuffled: bool = False) -> DataFrame:
    """Inner equi-join on all keys; updates without a timetable row drop out.

    Only the key and time columns of the timetable are read. Both sides end
    hash-partitioned on the keys, so a following aggregate on the same keys
    needs no further exchange. ``broadcast_updates`` is for a micro-batch
    whose size the caller has bounded; ``shuffled`` for updates out of the state
    of a stream, whose size no statistics tell: a batch without input, taken
    for empty, can close whole days, and must not be broadcast."""
    st = stop_times.select(*keys, time_col)
    if dedupe:
        st = unique_schedule(st, keys, time_col)
    left = F.broadcast(updates) if broadcast_updates else updates.hint("merge") if shuffled else updates
    return left.join(st, list(keys), "inner")
