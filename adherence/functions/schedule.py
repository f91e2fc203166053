"""Schedule time arithmetic as Spark column expressions.

A timetable gives clock times such as ``26:30:00`` relative to local midnight
of a service day, hours may pass 24. A feed gives instants as epoch seconds.
Everything here is built from built-in functions, so it stays inside
whole-stage codegen and does not depend on the session time zone: instants
are carried as epoch seconds (BIGINT), wall clocks as TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The local zone of the timetable and the clock-time pattern.
DEFAULT_TZ = "America/New_York"
CLOCK_PATTERN = r"^0*(\d{1,5}):0*(\d{1,7}):0*(\d{1,9})$"

DAY_RULES = ("reference", "nearest", "start_date")
#: Instants that have a calendar date: years 6 to about 9890.
MIN_EPOCH, MAX_EPOCH = -62_000_000_000, 250_000_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clock_fields(clock) -> Column:
    """The three fields of ``'H:M:S'`` as text, NULL for anything other than
    three unsigned integers."""
    c = _c(clock)
    return F.split(F.when(c.rlike(CLOCK_PATTERN), c), ":")


def clock_parts(clock, fields: Column | None = None) -> tuple[Column, Column, Column]:
    """``'H:M:S'`` -> (h, m, s) as INT. Hours may pass 24 (up to five
    digits), minutes and seconds are not range-checked. Anything other than
    three unsigned integers (or NULL) gives NULL parts. ``fields``: the clock's
    ``clock_fields`` where they are a column already."""
    fields = clock_fields(clock) if fields is None else fields
    return tuple(F.get(fields, F.lit(i)).try_cast("int") for i in range(3))


def valid_epoch(epoch) -> Column:
    """The instant, or NULL where no calendar date can be given for it (an
    epoch in milliseconds, for example)."""
    e = _c(epoch)
    return F.when(e.between(MIN_EPOCH, MAX_EPOCH), e)


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _epoch_date() -> Column:
    return F.expr("DATE'1970-01-01'")


def epoch_to_local_ntz(epoch, tz: str = DEFAULT_TZ) -> Column:
    """Epoch seconds -> wall clock in ``tz`` (TIMESTAMP_NTZ). Instants without
    a calendar date are moved to the nearest that has one; ``valid_epoch``
    tells them."""
    e = _c(epoch)
    within = F.when(e.isNotNull(), F.least(F.greatest(e, F.lit(MIN_EPOCH)), F.lit(MAX_EPOCH)))
    utc_wall = _epoch_ntz() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), within.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def epoch_of_ntz(ntz) -> Column:
    """A UTC wall clock (TIMESTAMP_NTZ) -> epoch seconds (BIGINT), without the
    session zone."""
    c = _c(ntz)
    return (F.datediff(F.to_date(c), _epoch_date()).cast("bigint") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c).cast("bigint"))


def actual_local_date(epoch, tz: str = DEFAULT_TZ) -> Column:
    """Calendar date of an instant in ``tz``."""
    return F.to_date(epoch_to_local_ntz(epoch, tz))


def service_date(local_date: Column, hours: Column) -> Column:
    """The reference's rule: the local date of the actual time, one day
    earlier when the scheduled clock is 24:00 or later (also for >= 48)."""
    return F.date_sub(local_date, F.when(hours >= 24, 1).otherwise(0))


def wall_of(sd: Column, h: Column, m: Column, s: Column, tz: str = DEFAULT_TZ) -> Column:
    """Local midnight of ``sd`` plus h:m:s on the wall clock of ``tz``, as UTC
    wall clock. A wall time in the spring gap moves forward; in the autumn
    overlap the earlier instant is taken."""
    wall = F.to_timestamp_ntz(sd) + F.make_dt_interval(F.lit(0), h, m, s.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)


def scheduled_epoch(clock, actual_epoch, tz: str = DEFAULT_TZ, day_rule: str = "reference",
                    start_date=None) -> Column:
    """Scheduled instant (epoch seconds) of a timetable clock time.

    ``day_rule``:
      * ``reference``: service day from the actual time (see ``service_date``);
      * ``nearest``: of the service days d-2 .. d+1 around the actual local
        date d, the one giving the smallest absolute delay (earlier on ties);
      * ``start_date``: the ``start_date`` column (``yyyyMMdd``) fixes the day.
    NULL when the clock, the actual time or the start date cannot be used.
    """
    h, m, s = clock_parts(clock)
    e = _c(actual_epoch)
    days = service_days(h, actual_local_date(e, tz), day_rule, start_date)
    return chosen([epoch_of_ntz(wall_of(d, h, m, s, tz)) for d in days], h, e)


def service_days(h: Column, local_day: Column, day_rule: str = "reference", start_date=None) -> list[Column]:
    """The service day of a clock, or with the rule ``nearest`` the four that
    are tried."""
    if day_rule not in DAY_RULES:
        raise ValueError(f"day_rule must be one of {DAY_RULES}, got {day_rule!r}")
    if day_rule == "start_date":
        if start_date is None:
            raise ValueError("day_rule='start_date' needs the start_date column")
        return [start_day(start_date)]
    return [service_date(local_day, h)] if day_rule == "reference" else [F.date_add(local_day, d) for d in (-2, -1, 0, 1)]


def chosen(instants: list[Column], h: Column, epoch: Column) -> Column:
    """The only instant, or of several the one closest to the actual time, the
    earlier on ties."""
    if len(instants) == 1:
        return instants[0]
    gaps = [F.struct(F.abs(epoch - c).alias("gap"), c.alias("inst")) for c in instants]
    return F.when(h.isNotNull(), F.least(*gaps).getField("inst"))


def start_day(start_date) -> Column:
    """``yyyyMMdd`` as a date; NULL when it is none."""
    c = _c(start_date)
    return F.when(c.rlike(r"^\d{8}$"), F.try_to_timestamp(c, F.lit("yyyyMMdd"))).cast("date")


def delay_seconds(actual_epoch, sched_epoch) -> Column:
    """actual - scheduled in whole seconds, sign kept; NULL when it does not
    fit."""
    return (valid_epoch(actual_epoch) - _c(sched_epoch)).try_cast("int")
