"""Delay of each stop update against its timetable (C2 core, K3, K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.functions.once import compute_once
from adherence.functions.schedule import (DEFAULT_TZ, actual_local_date, chosen, clock_fields, clock_parts, delay_seconds,
                                          epoch_of_ntz, service_days, valid_epoch, wall_of)
from adherence.operators.latest import latest_per_key
from adherence.operators.lookup import schedule_lookup

DEFAULT_KEYS = ("trip_id", "stop_id", "stop_sequence")


def choose_actual_time(df: DataFrame, arrival: str = "arrival_epoch", departure: str = "departure_epoch",
                       out: str = "actual_epoch", keep_timeless: bool = False) -> DataFrame:
    """The arrival time if present, else the departure time; rows with
    neither are dropped. Presence, not truthiness: time 0 is kept.
    ``time_source`` tells which one was used (the reference stores a
    departure time as the actual arrival)."""
    a, d = F.col(arrival), F.col(departure)
    df = df.withColumn(out, F.coalesce(a, d)).withColumn(
        "time_source", F.when(a.isNotNull(), "arrival").when(d.isNotNull(), "departure"))
    return df if keep_timeless else df.filter(F.col(out).isNotNull())


def add_delay(df: DataFrame, clock_col: str = "arrival_time", actual_col: str = "actual_epoch",
              tz: str = DEFAULT_TZ, day_rule: str = "reference", start_date_col: str | None = None) -> DataFrame:
    """Adds ``scheduled_epoch``, ``delay_seconds`` and a ``reject_reason``
    (NULL for good rows). F10: every row without a schedule or a delay is
    rejected, whatever made it so."""
    e = F.col(actual_col)
    h, m, s = (F.col(f"_{n}") for n in "hms")
    out = compute_once(df, {"_fields": clock_fields(clock_col), "_day": actual_local_date(e, tz)})
    out = compute_once(out, dict(zip(("_h", "_m", "_s"), clock_parts(None, F.col("_fields")))))
    days = service_days(h, F.col("_day"), day_rule, start_date_col)
    walls = [f"_wall{i}" for i in range(len(days))]
    out = compute_once(out, {w: wall_of(d, h, m, s, tz) for w, d in zip(walls, days)})
    out = compute_once(out, {"scheduled_epoch": chosen([epoch_of_ntz(w) for w in walls], h, e)})
    out = out.withColumn("delay_seconds", delay_seconds(actual_col, "scheduled_epoch"))
    return out.withColumn("reject_reason",
                          F.when(F.col(clock_col).isNull(), F.lit("missing clock time"))
                           .when(h.isNull(), F.lit("unparseable clock time"))
                           .when(valid_epoch(actual_col).isNull(), F.lit("actual time out of range"))
                           .when(F.col("scheduled_epoch").isNull(), F.lit("no service day"))
                           .when(F.col("delay_seconds").isNull(), F.lit("delay out of range"))) \
              .drop("_fields", "_day", "_h", "_m", "_s", *walls)


def trip_delays(updates: DataFrame, stop_times: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                order: str | Sequence[str] = "arrival_order", tz: str = DEFAULT_TZ,
                day_rule: str = "reference", arrival: str = "arrival_epoch",
                departure: str = "departure_epoch", time_col: str = "arrival_time",
                with_rejects: bool = False, keep_order: bool = False,
                unique_stop_times: bool = False, broadcast_updates: bool = False):
    """The fact table ``trip_delays``: latest delay per key.

    Plan: drop updates without a time, reduce to the latest update per key
    (partial aggregate before the shuffle), join the timetable on the same
    keys (the aggregate's partitioning is reused), compute the schedule and
    delay with column expressions. Whether an update finds a timetable row or
    has a parseable clock depends only on its key, so reducing before the
    join gives the same rows as the reference's per-update loop, where a
    failing update never replaces an older good one.
    Returns the accepted frame, or (accepted, rejected) with ``with_rejects``.
    ``unique_stop_times``: the timetable has one row per key already;
    ``broadcast_updates``: the caller has bounded their number.
    ``keep_order`` (``order`` a column name) keeps the winning order value,
    for merging with later batches."""
    timed = choose_actual_time(updates, arrival, departure)
    vals = ["actual_epoch", "time_source"] + ([order] if keep_order else [])
    latest = latest_per_key(timed, keys, vals, order)
    joined = schedule_lookup(latest, stop_times, keys, time_col, dedupe=not unique_stop_times,
                             broadcast_updates=broadcast_updates)
    scored = add_delay(joined, time_col, "actual_epoch", tz, day_rule)
    cols = [*keys, "scheduled_epoch", "actual_epoch", "delay_seconds", "time_source"] + \
        ([order] if keep_order else [])
    good = scored.filter(F.col("reject_reason").isNull()).select(*cols)
    if not with_rejects:
        return good
    bad = scored.filter(F.col("reject_reason").isNotNull()).select(*keys, time_col, "actual_epoch",
                                                                   "reject_reason")
    return good, bad

