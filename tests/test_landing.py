"""Inputs of the stream queries: stored once, landed in a bounded number of files."""

import datetime

import pytest
from pyspark.sql import functions as F

from adherence.operators.lookup import lookup_table, schedule_lookup
from adherence.plans import catalog as C
from adherence.session import SHUFFLES_GO, settings, work_path
from adherence.sources.stream import land_again, land_records


@pytest.fixture()
def tables(spark, tmp):
    """Two hundred updates of fifty orders."""
    days = [datetime.datetime(1995, 1, 1) + datetime.timedelta(days=d) for d in range(50)]
    spark.createDataFrame(
        [(i % 50 * 70, i, i % 9, i % 4, days[i % 50], "ANR"[i % 3], "OF"[i % 2]) for i in range(200)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp, l_returnflag string, "
        "l_linestatus string").write.parquet(f"{tmp}/lineitem.parquet")
    spark.createDataFrame([(i * 70, i, days[i], "F", 100.0 * i) for i in range(50)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderstatus string, o_totalprice double") \
        .write.parquet(f"{tmp}/orders.parquet")
    return tmp


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_landings_have_a_bounded_number_of_files(spark, tables):
    """more shuffle partitions gave more files, and so more batches."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.read.parquet(C.landed_feeds(spark, tables))
        assert len(rows.inputFiles()) <= C.LANDED_FILES and rows.count() == 50
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_mixed_feeds_are_decoded_once(spark, tables):
    """every part of the stream encoded and decoded all feeds again."""
    feeds = C.mixed_feeds(spark, tables)
    assert "InArrow" not in plan_of(feeds) and feeds.agg(F.sum("n_stops")).first()[0] == 200


def test_rows_out_of_state_are_not_broadcast(spark):
    """a frame that statistics take for empty was sent to the driver."""
    updates = spark.createDataFrame([(1, 2, 3, 10)], "trip_id long, stop_id long, stop_sequence int, actual_epoch long")
    times = spark.createDataFrame([(1, 2, 3, "08:00:00")], "trip_id long, stop_id long, stop_sequence int, arrival_time string")
    joined = schedule_lookup(updates, times, shuffled=True)
    assert "Broadcast" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert [tuple(r) for r in joined.collect()] == [(1, 2, 3, 10, "08:00:00")]


def test_a_stored_timetable_is_not_shuffled_again(spark):
    """every batch of a stream shuffled the whole timetable."""
    updates = spark.createDataFrame([(1, 2, 3, 10), (1, 2, 4, 11), (5, 5, 5, 12)],
                                    "trip_id long, stop_id long, stop_sequence int, actual_epoch long")
    times = spark.createDataFrame([(1, 2, 3, "08:00:00"), (1, 2, 3, "07:00:00"), (1, 2, 4, "09:00:00"), (None, 2, 4, "09:00:00")],
                                  "trip_id long, stop_id long, stop_sequence int, arrival_time string")
    before = {t.name for t in spark.catalog.listTables()}
    table = lookup_table(times, C.B.KEYS)
    joined = schedule_lookup(updates, table, dedupe=False, shuffled=True)
    assert plan_of(joined).count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan_of(joined)
    assert sorted(map(tuple, joined.collect())) == [(1, 2, 3, 10, "07:00:00"), (1, 2, 4, 11, "09:00:00")]
    assert table.count() == 3 and {t.name for t in spark.catalog.listTables()} == before
    assert lookup_table(times.limit(0), C.B.KEYS).count() == 0


@pytest.fixture()
def timed_tables(spark, tables, tmp):
    """The same updates, with what the timetable and the order of arrival are made of."""
    more = {"l_quantity": F.col("l_partkey") % 50, "l_extendedprice": F.lit(1.0), "l_discount": F.lit(0.0), "l_tax": F.lit(0.0)}
    spark.read.parquet(f"{tables}/lineitem.parquet").withColumns(more).write.parquet(f"{tmp}/timed/lineitem.parquet")
    spark.read.parquet(f"{tables}/orders.parquet").write.parquet(f"{tmp}/timed/orders.parquet")
    return f"{tmp}/timed"


def test_feeds_that_are_delivered_twice_are_made_once(spark, timed_tables, monkeypatch):
    """each delivery encoded all feeds and stored the timetable, and the landing stayed."""
    tables = timed_tables
    made, stored, real, keep, drop = [], [], C.FB.feeds, C.lookup_table, C.drop_folder
    monkeypatch.setattr(C.FB, "feeds", lambda *a, **k: made.append(1) or real(*a, **k))
    monkeypatch.setattr(C, "lookup_table", lambda *a: stored.append(1) or keep(*a))
    folders = []
    monkeypatch.setattr(C, "drop_folder", lambda s, path: folders.append((path, s.read.parquet(path).count())) or drop(s, path))
    once, twice = C.delay_log(spark, tables), C.delay_log(spark, tables, deliveries=2)
    assert (len(made), len(stored)) == (2, 2) and [n for _, n in folders] == [50, 100]
    assert twice.count() == 2 * once.count() and C.J.current_facts(twice).exceptAll(C.J.current_facts(once)).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folders[0][0])


def test_a_replay_sends_the_records_as_they_were(spark, tables):
    folder = work_path(spark, "tests", "replay", unique=True)
    land_records(C.FB.feeds(spark, tables, partitions=8), folder, "t", ts_col="feed_ts")
    first = spark.read.parquet(folder)
    n, files = first.count(), len(first.inputFiles())
    land_again(first, folder, 3)
    land_again(first, folder, 3)  # the first delivery, not all that has come
    rows = spark.read.parquet(folder)
    assert rows.count() == 3 * n and rows.distinct().count() == n and len(rows.inputFiles()) <= files + 6


def test_settings_hold_inside_and_give_way_to_the_session(spark):
    (key,) = SHUFFLES_GO
    with settings(spark, SHUFFLES_GO):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == "false"
    spark.conf.set(key, "false")
    try:
        with settings(spark, SHUFFLES_GO):
            assert spark.conf.get(key) == "false"
        assert key in spark.conf.getAll
    finally:
        spark.conf.unset(key)


def test_days_are_looked_up_in_a_stored_timetable(spark, timed_tables, monkeypatch):
    """every batch, also those that only close days, made the timetable unique and shuffled it."""
    joined, real = [], C.schedule_lookup
    monkeypatch.setattr(C, "schedule_lookup", lambda updates, times, *a, **k: joined.append(plan_of(times)) or real(updates, times, *a, **k))
    assert C.t1_latest_of_day_stream(spark, timed_tables).count() > 0
    assert len(joined) == 3 and not any("Exchange" in p or "Aggregate" in p for p in joined)


@pytest.mark.parametrize("query, view", [(C.k1_stream, "live_predictions"), (C.j2_stream, "scheduled_updates")])
def test_streams_have_buckets_for_their_trips(spark, timed_tables, monkeypatch, query, view):
    """the buckets of state grew with the trips, and every bucket was in Python at once."""
    asked, given, real = [], [], getattr(C.EV, view)
    monkeypatch.setattr(C.EV, "buckets_for", lambda rows: asked.append(rows.select("trip_id").distinct().count()) or 7)
    monkeypatch.setattr(C.EV, view, lambda events, buckets=None: given.append(buckets) or real(events, buckets=buckets))
    rows = query(spark, timed_tables).count()
    assert rows > 0 and asked == [50] and given == [7] * 3
