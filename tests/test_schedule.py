from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adherence.functions.schedule import clock_parts, scheduled_epoch

NY = ZoneInfo("America/New_York")

# (clock, actual epoch, scheduled epoch) - the rule's golden rows
GOLDEN = [("08:15:00", 1751372250, 1751372100), ("25:30:00", 1751434260, 1751434200),
          ("24:05:00", 1751428680, 1751342700), ("23:55:00", 1751429400, 1751514900),
          ("02:30:00", 1741505460, 1741505400), ("26:30:00", 1741505400, 1741505400),
          ("01:30:00", 1762061400, 1762061400), ("49:00:00", 1751518800, 1751605200),
          ("7:05:00", 1751367910, 1751367900), ("10:75:00", 1751382900, 1751382900),
          ("bad", 1751382900, None), ("08:15", 1751382900, None), ("", 1751382900, None),
          (None, 1751382900, None), (" 8:15:00", 1751382900, None), ("-1:00:00", 1751382900, None)]


def python_rule(clock: str, actual: int) -> int:
    """Independent restatement of the schedule rule with zoneinfo."""
    h, m, s = (int(x) for x in clock.split(":"))
    local = datetime.fromtimestamp(actual, tz=timezone.utc).astimezone(NY)
    sd = local.date() - (timedelta(days=1) if h >= 24 else timedelta(0))
    wall = datetime.combine(sd, datetime.min.time(), tzinfo=NY) + timedelta(hours=h, minutes=m, seconds=s)
    return int(wall.astimezone(timezone.utc).timestamp())


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_golden_rows_in_any_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(GOLDEN, "clock string, e long, want long")
        got = {(r.clock, r.e): r.got for r in df.select("*", scheduled_epoch("clock", "e").alias("got")).collect()}
        for clock, e, want in GOLDEN:
            assert got[(clock, e)] == want, (clock, e)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_clock_parts_rejects_malformed(spark):
    df = spark.createDataFrame([("1:2:3",), ("1_0:00:00",), ("+1:00:00",), ("a:b:c",)], "c string")
    rows = df.select(*[p.alias(n) for p, n in zip(clock_parts("c"), "hms")]).collect()
    assert (rows[0].h, rows[0].m, rows[0].s) == (1, 2, 3)
    assert all(r.h is None for r in rows[1:])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 49), st.integers(0, 59), st.integers(0, 59),
                          st.integers(1_500_000_000, 1_900_000_000)), min_size=20, max_size=60))
def test_property_equals_python_restatement(spark, rows):
    data = [(f"{h:02d}:{m:02d}:{s:02d}", e) for h, m, s, e in rows]
    df = spark.createDataFrame(data, "clock string, e long")
    got = df.select("clock", "e", scheduled_epoch("clock", "e").alias("s")).collect()
    for r in got:
        local_h = int(r.clock.split(":")[0]) % 24
        if local_h in (1, 2):   # DST-ambiguous wall times are covered by the golden rows
            continue
        assert r.s == python_rule(r.clock, r.e), r


def test_nearest_and_start_date_rules(spark):
    df = spark.createDataFrame([("24:05:00", 1751428680, "20250701")], "clock string, e long, sd string")
    r = df.select(scheduled_epoch("clock", "e", day_rule="nearest").alias("n"),
                  scheduled_epoch("clock", "e", day_rule="start_date", start_date="sd").alias("k")).first()
    assert r.n - 1751428680 == 420          # the next service day, 7 min later
    assert r.k == python_rule("24:05:00", 1751428680) + 86400
    with pytest.raises(ValueError):
        scheduled_epoch("clock", "e", day_rule="bogus")


def test_the_delay_is_computed_once_above_the_join(spark):
    """The filter on rejects stays above the lookup, which joins on its keys alone."""
    from adherence.plans import catalog as C
    from conftest import SF_SMALL
    df = C.facts(spark, SF_SMALL)
    plan = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    joins = [x for x in plan.split("\n\n") if "Join type: Inner" in x]
    assert len(joins) == 1 and "Join condition: None" in joins[0]
    assert plan.count("split(") == 1
    # the zone is asked for once for the local day and once for the instant
    assert plan.count("convert_timezone(") == 2
