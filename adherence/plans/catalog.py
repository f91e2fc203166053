"""Registered queries: one per operator of the inventory, each reading the
whole given tables through the bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adherence.operators.delays import trip_delays
from adherence.plans import bindings as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``trip_delays`` fact table computed from the given tables."""
    return trip_delays(B.stop_updates(spark, sf_dir), B.stop_times_raw(spark, sf_dir),
                       keys=B.KEYS, order="arrival_order")


@query("c2_trip_delays")
def c2_trip_delays(spark, sf_dir):
    return facts(spark, sf_dir)


# ---------------------------------------------------------------- serving
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from adherence.functions.labels import display_label  # noqa: E402
from adherence.operators import serving as S  # noqa: E402
from adherence.session import stored, work_path  # noqa: E402
from adherence.sources.tables import drop_folder, publish, read_table, state_of  # noqa: E402
from adherence.streaming.jobs import publish_facts  # noqa: E402


def served_facts(spark, sf_dir) -> DataFrame:
    """The published fact table that the serving queries read (S14). It is
    computed and published when the session first asks for it, and again when
    the given tables have changed."""
    known = spark.sparkContext.__dict__.setdefault("_served_facts", {})
    state = state_of(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    if known.get(sf_dir, (None,))[0] != state:
        path = work_path(spark, "tables", "served", unique=True)
        # Stored first: dealing by ranges looks at its input twice.
        publish_facts(spark, stored(facts(spark, sf_dir)), path)
        known[sf_dir] = (state, path)
    return read_table(spark, known[sf_dir][1])


def selected_trip(spark, sf_dir) -> DataFrame:
    """The trip the dashboard shows first: the highest trip id among the
    facts that has a trip row (one row, derived from the data)."""
    ids = served_facts(spark, sf_dir).select("trip_id").join(B.trips(spark, sf_dir).select("trip_id"), "trip_id", "left_semi")
    return ids.agg(F.max("trip_id").alias("trip_id"))


def selected_trip_value(spark, sf_dir):
    """The selected trip as a literal parameter (one scalar, as the dashboard
    passes it), so the key filter is pushed down to the scans."""
    return selected_trip(spark, sf_dir).first()[0]


@query("c5_trip_options")
def c5_trip_options(spark, sf_dir):
    return S.trip_options(served_facts(spark, sf_dir), B.trips(spark, sf_dir), B.routes(spark, sf_dir))


@query("o5_label_unique")
def o5_label_unique(spark, sf_dir):
    return S.option_map(c5_trip_options(spark, sf_dir))


@query("o1_top_k")
def o1_top_k(spark, sf_dir):
    """The list of the highest trips, without labels: the ids are reduced and
    cut before the dimensions are joined."""
    return c5_trip_options(spark, sf_dir).drop("display")


@query("a4_group_dedup")
def a4_group_dedup(spark, sf_dir):
    return (S.enrich(facts(spark, sf_dir), B.trips(spark, sf_dir), B.routes(spark, sf_dir))
            .select("trip_id", "route_id", "route_short_name", "trip_headsign").distinct())


@query("c6_late_stops")
def c6_late_stops(spark, sf_dir):
    return S.late_stops(served_facts(spark, sf_dir), selected_trip_value(spark, sf_dir))


@query("c6_late_stops_all")
def c6_late_stops_all(spark, sf_dir):
    return S.late_stops(facts(spark, sf_dir), None)


@query("p13_late_filter")
def p13_late_filter(spark, sf_dir):
    return facts(spark, sf_dir).filter("delay_seconds > 0")


@query("p12_key_filter")
def p12_key_filter(spark, sf_dir):
    return S.key_filter(served_facts(spark, sf_dir), "trip_id", selected_trip_value(spark, sf_dir))


@query("p14_series_project")
def p14_series_project(spark, sf_dir):
    return S.delay_series(served_facts(spark, sf_dir), selected_trip_value(spark, sf_dir))


@query("o2_sort")
def o2_sort(spark, sf_dir):
    """All late stops with their place in the order of their trip."""
    place = F.row_number().over(Window.partitionBy("trip_id").orderBy("stop_sequence", "stop_id"))
    return facts(spark, sf_dir).filter("delay_seconds > 0").select(
        "trip_id", "stop_sequence", "stop_id", "delay_seconds", place.alias("place"))


@query("c7_trip_info")
def c7_trip_info(spark, sf_dir):
    return S.trip_info(B.trips(spark, sf_dir), selected_trip_value(spark, sf_dir))


@query("o4_first_row")
def o4_first_row(spark, sf_dir):
    """First timetable row of every trip (O4 per key)."""
    st = B.stop_times(spark, sf_dir)
    return st.groupBy("trip_id").agg(F.min(F.struct("stop_sequence", "stop_id", "arrival_time")).alias("r")) \
             .select("trip_id", "r.stop_sequence", "r.stop_id", "r.arrival_time")


@query("j3_fact_trip_join")
def j3_fact_trip_join(spark, sf_dir):
    t = B.trips(spark, sf_dir).select("trip_id", "route_id", "trip_headsign")
    return facts(spark, sf_dir).select("trip_id", "stop_id", "stop_sequence", "delay_seconds") \
        .join(t, "trip_id", "inner")


@query("j4_trip_route_join")
def j4_trip_route_join(spark, sf_dir):
    return B.trips(spark, sf_dir).select("trip_id", "route_id") \
        .join(B.routes(spark, sf_dir).select("route_id", "route_short_name"), "route_id", "left")


@query("r6_enrich")
def r6_enrich(spark, sf_dir):
    return S.enrich(facts(spark, sf_dir), B.trips(spark, sf_dir), B.routes(spark, sf_dir))


@query("f8_display_label")
def f8_display_label(spark, sf_dir):
    return j4_trip_route_join(spark, sf_dir).join(B.trips(spark, sf_dir).select("trip_id", "trip_headsign"),
                                                  "trip_id") \
        .select("trip_id", display_label().alias("display"))


@query("p1_project")
def p1_project(spark, sf_dir):
    return B.trips(spark, sf_dir).select("trip_id", "route_id")


# ---------------------------------------------------------------- quality
from adherence import schemas as SC  # noqa: E402
from adherence.operators import quality as Q  # noqa: E402
from adherence.plans.pipelines import load_static  # noqa: E402
from adherence.sources.csv import load_csv  # noqa: E402


def bound_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {"routes": B.routes(spark, sf_dir), "trips": B.trips(spark, sf_dir),
            "stops": B.stops(spark, sf_dir), "calendar": B.calendar(spark, sf_dir),
            "stop_times": B.stop_times_raw(spark, sf_dir)}


def quality_report(spark, sf_dir, **options) -> DataFrame:
    """The checks of every table (``checks`` names some) as one report."""
    parts = [Q.table_checks(df, name, SC.PRIMARY_KEYS[name], SC.STATIC_SCHEMAS[name], **options)
             for name, df in bound_tables(spark, sf_dir).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("q4_null_check")
def q4_null_check(spark, sf_dir):
    return quality_report(spark, sf_dir, checks=["null_check"])


@query("q5_unique_check")
def q5_unique_check(spark, sf_dir):
    return quality_report(spark, sf_dir, checks=["unique_check"])


@query("q6_row_count")
def q6_row_count(spark, sf_dir):
    return quality_report(spark, sf_dir, checks=["row_count"])


@query("q6_counts_while_staging")
def q6_counts_while_staging(spark, sf_dir):
    """All checks of every table, the counted ones observed by the write."""
    root = work_path(spark, "stage", unique=True)
    out = None
    for name, df in bound_tables(spark, sf_dir).items():
        _, found = Q.staged_checks(df, f"{root}/{name}", name, SC.PRIMARY_KEYS[name], SC.STATIC_SCHEMAS[name])
        out = found if out is None else out.unionByName(found)
    return out


@query("q7_foreign_key")
def q7_foreign_key(spark, sf_dir):
    return Q.foreign_key(B.trips(spark, sf_dir), B.routes(spark, sf_dir), "route_id", "route_id",
                         "trips", "routes")


@query("q7_foreign_key_unused_routes")
def q7_foreign_key_unused_routes(spark, sf_dir):
    """Routes that no trip uses (a link checked the other way round)."""
    return Q.foreign_key(B.routes(spark, sf_dir), B.trips(spark, sf_dir), "route_id", "route_id",
                         "routes", "trips")


@query("j1_anti_join")
def j1_anti_join(spark, sf_dir):
    return Q.missing_keys(B.routes(spark, sf_dir), B.trips(spark, sf_dir), "route_id", "route_id")


@query("q8_referential_integrity")
def q8_referential_integrity(spark, sf_dir):
    return Q.integrity(bound_tables(spark, sf_dir), SC.CODED_LINKS)


@query("r5_all_links")
def r5_all_links(spark, sf_dir):
    return Q.integrity(bound_tables(spark, sf_dir), SC.ALL_LINKS)


@query("a1_count")
def a1_count(spark, sf_dir):
    return facts(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count_if(F.col("delay_seconds") > 0).alias("n_late"))


@query("a2_distinct")
def a2_distinct(spark, sf_dir):
    return B.stop_times_raw(spark, sf_dir).select("trip_id", "stop_sequence").distinct()


@query("a3_excess_rows")
def a3_excess_rows(spark, sf_dir):
    g = B.stop_times_raw(spark, sf_dir).groupBy("trip_id", "stop_sequence").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("distinct_keys"),
                 (F.sum("n") - F.count(F.lit(1))).alias("excess_rows"))


@query("p2_null_or_empty")
def p2_null_or_empty(spark, sf_dir):
    t = B.trips(spark, sf_dir)
    return t.agg(*[F.count_if(Q.null_or_empty(t, c)).alias(f"empty_{c}")
                   for c in ("route_id", "service_id", "trip_id", "trip_headsign", "direction_id")])


def trips_csv_fixture(spark, sf_dir) -> str:
    """Write the bound trips table as a headed CSV under the shared folder:
    columns in another order than declared, the required ``shape_id``
    missing, a surplus ``fare`` column and text in the integer column
    ``wheelchair_accessible``. Returns the file folder."""
    o = B.table(spark, sf_dir, "orders")
    path = work_path(spark, "fixtures", "trips", unique=True)
    o.select(F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("route_id"),
             F.col("o_orderpriority").alias("service_id"), F.col("o_orderstatus").alias("trip_headsign"),
             (F.col("o_orderkey") % 2).alias("direction_id"),
             F.col("o_orderstatus").alias("wheelchair_accessible"),
             F.col("o_totalprice").alias("fare")) \
        .write.option("header", True).csv(path)
    return path


@query("s1_csv_scan")
def s1_csv_scan(spark, sf_dir):
    path = trips_csv_fixture(spark, sf_dir)
    return load_csv(spark, path, SC.STATIC_SCHEMAS["trips"], "trips").typed


def _csv_report(spark, sf_dir) -> DataFrame:
    path = trips_csv_fixture(spark, sf_dir)
    t = load_csv(spark, path, SC.STATIC_SCHEMAS["trips"], "trips")
    return Q.header_checks(spark, "trips", t.header, t.schema, SC.REQUIRED_COLUMNS["trips"]) \
        .unionByName(Q.table_checks(t.raw, "trips", SC.PRIMARY_KEYS["trips"], t.schema))


@query("q1_required_columns")
def q1_required_columns(spark, sf_dir):
    return _csv_report(spark, sf_dir).filter("check = 'required_columns'")


@query("q2_extra_columns")
def q2_extra_columns(spark, sf_dir):
    return _csv_report(spark, sf_dir).filter("check = 'extra_columns'")


@query("q3_type_match")
def q3_type_match(spark, sf_dir):
    return _csv_report(spark, sf_dir).filter("check = 'type_match'")


def timetable_csv_folder(spark, sf_dir) -> str:
    """All five bound tables as headed CSV files ``<name>.txt`` (a folder
    each), ids as text, as a timetable export would hold them."""
    root = work_path(spark, "fixtures", "timetable", unique=True)
    for name, df in bound_tables(spark, sf_dir).items():
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) \
          .write.option("header", True).csv(f"{root}/{name}.txt")
    return root


@query("c1_load_static")
def c1_load_static(spark, sf_dir):
    """Load the five tables from CSV with every check; the report (the
    timetable export has duplicate stop_times keys, so the job would stop
    before publishing; here the report is returned instead)."""
    return load_static(spark, timetable_csv_folder(spark, sf_dir), enforce=False).report


# ---------------------------------------------------------------- feed
from adherence.operators.delays import choose_actual_time  # noqa: E402
from adherence.streaming import bindings as FB  # noqa: E402
from adherence.streaming import feed as FD  # noqa: E402
from adherence.streaming import flatten as FL  # noqa: E402


def decoded_entities(spark, sf_dir) -> DataFrame:
    good, _ = FD.split_rejects(FD.decode(FB.feeds(spark, sf_dir), keep=["feed_key"]))
    return good


@query("s9_feed_publish")
def s9_feed_publish(spark, sf_dir):
    return FB.feeds(spark, sf_dir).select("feed_key", "feed_ts", "n_entities", "n_stops")


@query("t5_decode_feed")
def t5_decode_feed(spark, sf_dir):
    return FL.stop_updates(decoded_entities(spark, sf_dir), keep=["feed_key"]).select(
        "feed_key", "feed_ts", "entity_pos", "entity_id", "trip_id", "route_id", "start_date", "trip_delay",
        "stop_pos", "stop_id", "stop_sequence", "arrival_epoch", "departure_epoch")


@query("p3_struct_project")
def p3_struct_project(spark, sf_dir):
    e = decoded_entities(spark, sf_dir)
    return e.select("feed_key", F.col("entity.trip_update.trip.trip_id").alias("trip_id"),
                    F.col("entity.trip_update.trip.route_id").alias("route_id"),
                    F.col("entity.trip_update.delay").alias("delay"))


@query("p4_present_filter")
def p4_present_filter(spark, sf_dir):
    return FL.trip_entities(decoded_entities(spark, sf_dir)).select("feed_key", F.col("entity.id").alias("entity_id"))


@query("p5_explode_entities")
def p5_explode_entities(spark, sf_dir):
    feeds = FD.decode(FB.feeds(spark, sf_dir), keep=["feed_key"], level="feed")
    ent = FL.explode_entities(feeds.filter("decode_error IS NULL"))
    return ent.select("feed_key", "entity_pos", F.col("entity.id").alias("entity_id"),
                      F.size("entity.trip_update.stop_time_update").alias("n_stops"))


@query("p6_explode_stops")
def p6_explode_stops(spark, sf_dir):
    return FL.stop_updates(decoded_entities(spark, sf_dir), keep=["feed_key"]).select(
        "feed_key", "entity_pos", "stop_pos", "trip_id", "stop_id", "stop_sequence")


@query("p7_time_choice")
def p7_time_choice(spark, sf_dir):
    s = FL.stop_updates(decoded_entities(spark, sf_dir), keep=["feed_key"])
    return choose_actual_time(s).select("feed_key", "trip_id", "stop_id", "stop_sequence", "stop_pos",
                                        "actual_epoch", "time_source")


@query("p8_proto_defaults")
def p8_proto_defaults(spark, sf_dir):
    return FL.stop_updates(decoded_entities(spark, sf_dir), keep=["feed_key"], defaults=True).select(
        "feed_key", "stop_pos", "trip_id", "stop_id", "stop_sequence")


@query("p9_first_trip")
def p9_first_trip(spark, sf_dir):
    feeds = FD.decode(FB.feeds(spark, sf_dir), keep=["feed_key"], level="feed")
    return FL.first_trip(feeds)


@query("p10_delay_default")
def p10_delay_default(spark, sf_dir):
    e = FL.trip_entities(decoded_entities(spark, sf_dir))
    return e.select("feed_key", F.col("entity.id").alias("entity_id"),
                    FL.delay_default(F.col("entity.trip_update.delay")).alias("delay"))


@query("u1_scalar_udf")
def u1_scalar_udf(spark, sf_dir):
    f = FB.feeds(spark, sf_dir)
    return f.select("feed_key", FL.first_trip_udf()("value").alias("p")).select("feed_key", "p.*")


@query("u2_udf_register")
def u2_udf_register(spark, sf_dir):
    name = FL.register_udfs(spark)
    f = FB.feeds(spark, sf_dir)
    return f.select("feed_key", F.call_function(name, F.col("value")).alias("p")).select("feed_key", "p.*")


def trip_update_records(spark, sf_dir) -> DataFrame:
    """Bare trip-update records, split from the feeds (the second topic's
    record format)."""
    return FD.split_trip_updates(FB.feeds(spark, sf_dir), keep=["feed_key"])


@query("t6_decode_trip_update")
def t6_decode_trip_update(spark, sf_dir):
    d = FD.decode(trip_update_records(spark, sf_dir), root="TripUpdate", keep=["feed_key"])
    return d.filter("decode_error IS NULL").select(
            "feed_key", F.col("message.trip.trip_id").alias("trip_id"),
            F.col("message.trip.start_date").alias("start_date"),
            F.col("message.trip.route_id").alias("route_id"),
            F.size("message.stop_time_update").alias("n_stops"))


@query("p11_trip_update_map")
def p11_trip_update_map(spark, sf_dir):
    d = FD.decode(trip_update_records(spark, sf_dir), root="TripUpdate", keep=["feed_key"])
    return FL.trip_update_rows(d, with_time=False)


# ---------------------------------------------------------------- streaming
from adherence.sources.stream import RECORD_DDL, file_stream, land_again, land_records  # noqa: E402
from adherence.streaming import jobs as J  # noqa: E402


#: Files of a landing, at any size of it: with eight files a batch, a stream has
#: as many batches over a large landing as over a small one, so that what a
#: batch costs whatever it holds (the timetable's side of the join) does not
#: grow twice.
LANDED_FILES = 24


def landed_feeds(spark, sf_dir, files: int | None = None) -> str:
    folder = work_path(spark, "landing", "feeds", unique=True)
    land_records(FB.feeds(spark, sf_dir, partitions=LANDED_FILES), folder, "trip-updates", files=files, ts_col="feed_ts")
    return folder


def delay_log(spark, sf_dir, deliveries: int = 1) -> DataFrame:
    """The log of the delay stream over the landed feeds, which are delivered
    (landed, and the stream run) ``deliveries`` times. The timetable is stored
    once for all runs, and a later delivery sends the records of the first."""
    log, ck = (work_path(spark, kind, "c2", unique=True) for kind in ("tables", "streams"))
    folder = landed_feeds(spark, sf_dir)
    first = spark.read.schema(RECORD_DDL).parquet(folder)  # these files, whatever comes later
    times = lookup_table(B.stop_times_raw(spark, sf_dir), B.KEYS)
    for delivery in range(deliveries):
        if delivery:
            land_again(first, folder, LANDED_FILES)
        J.run_delay_stream(spark, file_stream(spark, folder, max_files_per_trigger=8), times, log, ck,
                           trigger={"availableNow": True}, unique_stop_times=True).awaitTermination()
    drop_folder(spark, folder)  # all of it is in the log
    return spark.read.parquet(log)


@query("c2_trip_delays_stream")
def c2_trip_delays_stream(spark, sf_dir):
    """C2 end to end as a stream: landed feed records -> file stream (S6) ->
    decode, flatten, lookup, delay -> log -> last good row per key (S11)."""
    return J.current_facts(delay_log(spark, sf_dir), B.KEYS)


# ---------------------------------------------------------------- analytics
from adherence.operators import analytics as AN  # noqa: E402
from adherence.operators.latest import apply_differential, apply_feeds, latest_per_key  # noqa: E402


@query("r1_delay_hotspots")
def r1_delay_hotspots(spark, sf_dir):
    return AN.hotspots(S.enrich(facts(spark, sf_dir), B.trips(spark, sf_dir), B.routes(spark, sf_dir)))


@query("r1_cube")
def r1_cube(spark, sf_dir):
    """Every combination of route, stop, hour and weekday, in one aggregate."""
    rows = S.enrich(facts(spark, sf_dir), B.trips(spark, sf_dir), B.routes(spark, sf_dir))
    return AN.hotspots(rows, sets=AN.CUBE_SETS)


@query("r1_top_hotspots")
def r1_top_hotspots(spark, sf_dir):
    """The ten most delay-prone stops with five or more facts."""
    return AN.top_hotspots(r1_delay_hotspots(spark, sf_dir), level=11, k=10, min_n=5)


@query("r1_percentiles")
def r1_percentiles(spark, sf_dir):
    """p50 and p90 of routes, hours and all, from stored sketches; told by rank:
    the share of the group's facts below and up to the value lies around the
    asked one, within two hundredths of the rows and one row."""
    rows = S.enrich(facts(spark, sf_dir), B.trips(spark, sf_dir), B.routes(spark, sf_dir))
    path = work_path(spark, "tables", "sketches", unique=True)
    AN.delay_sketches(rows).write.parquet(path)
    rows = AN.with_local_parts(rows).select("route_id", "hour", "delay_seconds")
    out = None
    for name, by in (("route", ["route_id"]), ("hour", ["hour"]), ("all", [])):
        found = AN.delay_percentiles(spark.read.parquet(path), by)
        d = F.col("delay_seconds")
        joined = rows.join(found, by) if by else rows.join(F.broadcast(found))  # one row
        ranks = joined.groupBy(*by, "n", "p50", "p90").agg(*[
            (((F.count_if(d < F.col(p)) - 1) <= (q + 0.02) * F.col("n")) & ((F.count_if(d <= F.col(p)) + 1) >= (q - 0.02) * F.col("n")))
            .alias(f"{p}_near") for p, q in (("p50", 0.5), ("p90", 0.9))])
        part = ranks.select(F.lit(name).alias("level"), (F.col(by[0]).cast("string") if by else F.lit("")).alias("of"), "n",
                            "p50_near", "p90_near")
        out = part if out is None else out.unionByName(part)
    return out


def history(spark, sf_dir) -> DataFrame:
    t = B.trips(spark, sf_dir).select("trip_id", "route_id")
    return AN.delay_history(B.stop_updates(spark, sf_dir, with_order=False), B.stop_times_raw(spark, sf_dir)) \
        .join(t, "trip_id")


@query("r2_delay_now")
def r2_delay_now(spark, sf_dir):
    return AN.delay_windows(history(spark, sf_dir), ["route_id"], "1 day")


@query("k1_delay_propagation")
def k1_delay_propagation(spark, sf_dir):
    return AN.propagate_delays(B.stop_times(spark, sf_dir), facts(spark, sf_dir))


@query("k2_trip_delay_fallback")
def k2_trip_delay_fallback(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trip_id"),
        F.when(F.col("o_orderstatus") == "F", (F.col("o_totalprice").cast("bigint") % 600 - 300).cast("int"))
         .alias("trip_delay"))
    return AN.propagate_delays(B.stop_times(spark, sf_dir), facts(spark, sf_dir), trip_delay=o)


@query("k5_start_date_day")
def k5_start_date_day(spark, sf_dir):
    """C2 with the service day taken from the trip's start date (order date)."""
    from adherence.operators.delays import add_delay as _add
    o = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trip_id"),
                                                F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"))
    st = B.stop_times(spark, sf_dir)
    f = facts(spark, sf_dir).select("trip_id", "stop_id", "stop_sequence", "actual_epoch")
    j = f.join(st, list(B.KEYS)).join(o, "trip_id")
    d = _add(j, day_rule="start_date", start_date_col="start_date").filter("reject_reason IS NULL")
    return d.select(*B.KEYS, "start_date", "scheduled_epoch", "actual_epoch", "delay_seconds")


@query("k6_differential")
def k6_differential(spark, sf_dir):
    e = decoded_entities(spark, sf_dir).select(
        F.col("entity.id").alias("entity_id"), "feed_key", F.col("entity.is_deleted").alias("is_deleted"),
        F.size("entity.trip_update.stop_time_update").alias("n_stops"),
        F.struct(F.col("header.timestamp"), F.col("entity_pos")).alias("arrival_order"))
    return apply_differential(e, values=["feed_key", "n_stops"], order="arrival_order").drop("is_deleted")


@query("t1_latest_per_key")
def t1_latest_per_key(spark, sf_dir):
    """Latest event per user (last write wins on the event stream table)."""
    ev = B.events(spark, sf_dir)
    return latest_per_key(ev, ["user_id"], ["event_id", "event_type", "value", "props"], ["ts", "event_id"])


# ------------------------------------------------- streams into their sinks


@query("c3_trip_level_delay")
def c3_trip_level_delay(spark, sf_dir):
    """C3 as a stream: landed feeds -> first trip of each -> append sink."""
    sink = work_path(spark, "tables", "trip_delay", unique=True)
    J.run_trip_level_stream(file_stream(spark, landed_feeds(spark, sf_dir), max_files_per_trigger=8), sink,
                            work_path(spark, "streams", "c3", unique=True), {"availableNow": True}).awaitTermination()
    return spark.read.schema("trip_id string, route_id string, delay int").parquet(sink)


@query("c4_trip_update_log")
def c4_trip_update_log(spark, sf_dir):
    """C4 as a stream: landed trip updates -> append sink (S13). The time of
    processing is compared as being there."""
    landing, sink = (work_path(spark, *p, unique=True) for p in (("landing", "updates"), ("tables", "trip_update")))
    land_records(trip_update_records(spark, sf_dir), landing, "trip-update-log")
    J.run_trip_update_log(file_stream(spark, landing, max_files_per_trigger=8), sink,
                          work_path(spark, "streams", "c4", unique=True), {"availableNow": True}).awaitTermination()
    rows = spark.read.schema("trip_id string, start_date string, route_id string, timestamp timestamp").parquet(sink)
    return rows.select("trip_id", "start_date", "route_id", F.col("timestamp").isNotNull().alias("has_time"))


@query("t4_replayed_batches")
def t4_replayed_batches(spark, sf_dir):
    """All feeds delivered twice, the stream stopped and started in between."""
    return J.current_facts(delay_log(spark, sf_dir, deliveries=2), B.KEYS)


@query("s5_table_overwrite")
def s5_table_overwrite(spark, sf_dir):
    """A table published twice: the second version is what is read."""
    path = work_path(spark, "tables", "trips", unique=True)
    t = B.trips(spark, sf_dir)
    publish(spark, t.filter("direction_id = 0"), path)
    publish(spark, t, path)
    return read_table(spark, path)


@query("r4_backfill")
def r4_backfill(spark, sf_dir):
    """Facts of every feed day (the ship day)."""
    day = epoch_of_ntz(F.to_timestamp_ntz(F.to_date("arrival_order.l_shipdate")))
    return J.backfill_facts(B.stop_updates(spark, sf_dir).withColumn("feed_ts", day), B.stop_times_raw(spark, sf_dir), B.KEYS)


# ---------------------------------------------------- schedule expressions
from adherence.functions import schedule as T  # noqa: E402
from adherence.functions.schedule import epoch_of_ntz  # noqa: E402
from adherence.operators.delays import add_delay  # noqa: E402
from adherence.operators.lookup import lookup_table, schedule_lookup  # noqa: E402


@query("j2_schedule_lookup")
def j2_schedule_lookup(spark, sf_dir):
    latest = latest_per_key(choose_actual_time(B.stop_updates(spark, sf_dir)), B.KEYS, ["actual_epoch"], "arrival_order")
    return schedule_lookup(latest, B.stop_times_raw(spark, sf_dir), B.KEYS)


@query("f1_clock_parse")
def f1_clock_parse(spark, sf_dir):
    h, m, s = T.clock_parts("arrival_time")
    return B.stop_times_raw(spark, sf_dir).select("trip_id", "stop_sequence", "arrival_time", h.alias("h"), m.alias("m"),
                                                  s.alias("s"))


@query("f2_duration")
def f2_duration(spark, sf_dir):
    h, m, s = T.clock_parts("arrival_time")
    return B.stop_times_raw(spark, sf_dir).select("trip_id", "stop_sequence", (h * 3600 + m * 60 + s).alias("seconds"))


@query("f3_epoch_to_ts")
def f3_epoch_to_ts(spark, sf_dir):
    wall = T.epoch_to_local_ntz("actual_epoch")
    return j2_schedule_lookup(spark, sf_dir).select(*B.KEYS, "actual_epoch", T.epoch_of_ntz(wall).alias("wall_seconds"))


@query("f4_local_date")
def f4_local_date(spark, sf_dir):
    return j2_schedule_lookup(spark, sf_dir).select(*B.KEYS, T.actual_local_date("actual_epoch").cast("string").alias("day"))


@query("f5_service_date")
def f5_service_date(spark, sf_dir):
    h, _, _ = T.clock_parts("arrival_time")
    day = T.service_date(T.actual_local_date("actual_epoch"), h)
    return j2_schedule_lookup(spark, sf_dir).select(*B.KEYS, day.cast("string").alias("day"))


@query("f6_schedule_instant")
def f6_schedule_instant(spark, sf_dir):
    return j2_schedule_lookup(spark, sf_dir).select(*B.KEYS, T.scheduled_epoch("arrival_time", "actual_epoch").alias("scheduled"))


@query("f7_delay_seconds")
def f7_delay_seconds(spark, sf_dir):
    at = T.scheduled_epoch("arrival_time", "actual_epoch")
    return j2_schedule_lookup(spark, sf_dir).select(*B.KEYS, T.delay_seconds("actual_epoch", at).alias("delay"))


@query("f10_skip_bad_row")
def f10_skip_bad_row(spark, sf_dir):
    """Delays of rows with every kind of fault, by the line number."""
    n = F.col("stop_sequence") % 7
    clock = (F.when(n == 1, "99999999:00:00").when(n == 2, "no clock").when(n == 3, None)
              .when(n == 4, "08:99999999999:00").otherwise(F.col("arrival_time")))
    epoch = F.when(n == 5, F.col("actual_epoch") * 1000).otherwise(F.col("actual_epoch"))
    bad = j2_schedule_lookup(spark, sf_dir).withColumns({"arrival_time": clock, "actual_epoch": epoch})
    return add_delay(bad).select(*B.KEYS, "reject_reason", "delay_seconds")


@query("k5_bad_start_date")
def k5_bad_start_date(spark, sf_dir):
    """The service day from start dates of which some are no dates."""
    n = F.col("trip_id") % 4
    day = F.when(n == 1, "2025-13-99").when(n == 2, None).when(n == 3, "20251399").otherwise("19950301")
    rows = j2_schedule_lookup(spark, sf_dir).withColumn("start_date", day)
    return add_delay(rows, day_rule="start_date", start_date_col="start_date").select(*B.KEYS, "reject_reason", "delay_seconds")


@query("t5_rejects")
def t5_rejects(spark, sf_dir):
    """Feeds of which a fifth have damaged bytes and a fifth none."""
    block = F.split("feed_key", "/")[1].cast("long") % 5
    value = F.when(block == 0, F.concat("value", F.unhex(F.lit("FF")))).when(block == 1, None).otherwise(F.col("value"))
    d = FD.decode(FB.feeds(spark, sf_dir).withColumn("value", value), keep=["feed_key"])
    return d.groupBy("feed_key").agg(F.count_if(F.col("decode_error").isNotNull()).alias("rejects"),
                                     F.count_if(F.col("decode_error").isNull()).alias("entities"))


# --------------------------------------------------- data with violations
def faulty_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The bound tables with routes missing, emptied text and NULLs by rule."""
    t = bound_tables(spark, sf_dir)
    t["routes"] = t["routes"].filter("route_id % 10 <> 3")
    t["trips"] = t["trips"].withColumns({
        "service_id": F.when(F.col("trip_id") % 11 == 0, "").otherwise(F.col("service_id")),
        "direction_id": F.when(F.col("trip_id") % 13 == 0, None).otherwise(F.col("direction_id"))})
    t["stops"] = t["stops"].filter("stop_id % 10 <> 7")
    return t


@query("q4_null_violations")
def q4_null_violations(spark, sf_dir):
    t = faulty_tables(spark, sf_dir)["trips"]
    return Q.table_checks(t, "trips", SC.PRIMARY_KEYS["trips"], SC.STATIC_SCHEMAS["trips"])


@query("q5_absent_key")
def q5_absent_key(spark, sf_dir):
    """A key column that the table lacks: the check is reported as skipped."""
    return Q.table_checks(B.trips(spark, sf_dir).drop("service_id"), "trips", SC.PRIMARY_KEYS["trips"])


@query("r5_link_violations")
def r5_link_violations(spark, sf_dir):
    return Q.integrity(faulty_tables(spark, sf_dir), SC.ALL_LINKS)


@query("q8_integrity_violations")
def q8_integrity_violations(spark, sf_dir):
    return Q.integrity(faulty_tables(spark, sf_dir), SC.CODED_LINKS)


@query("j1_missing_routes")
def j1_missing_routes(spark, sf_dir):
    t = faulty_tables(spark, sf_dir)
    return Q.missing_keys(t["trips"], t["routes"], "route_id", "route_id")


@query("p2_empty_values")
def p2_empty_values(spark, sf_dir):
    t = faulty_tables(spark, sf_dir)["trips"]
    return t.agg(*[F.count_if(Q.null_or_empty(t, c)).alias(f"empty_{c}") for c in ("service_id", "direction_id")])


@query("j4_unmatched_routes")
def j4_unmatched_routes(spark, sf_dir):
    t = faulty_tables(spark, sf_dir)
    return t["trips"].select("trip_id", "route_id").join(t["routes"].select("route_id", "route_short_name"), "route_id", "left")


@query("o3_sample_5")
def o3_sample_5(spark, sf_dir):
    dup = B.stop_times_raw(spark, sf_dir).groupBy("trip_id", "stop_sequence").count().filter("count > 1")
    return Q.sample_of(dup, ["trip_id", "stop_sequence"])


# ------------------------------------------- relationships and full feeds
def related_facts(spark, sf_dir) -> DataFrame:
    """Facts with a relationship, and delays that are missing, by rule."""
    return facts(spark, sf_dir).withColumns({
        "rel": F.when(F.col("stop_sequence") % 4 == 3, "NO_DATA"),
        "delay_seconds": F.when(F.col("stop_sequence") % 5 != 2, F.col("delay_seconds"))})


@query("k1_resets")
def k1_resets(spark, sf_dir):
    return AN.propagate_delays(B.stop_times(spark, sf_dir), related_facts(spark, sf_dir), relationship="rel")


@query("k1_resets_by_block")
def k1_resets_by_block(spark, sf_dir):
    return AN.propagate_delays(B.stop_times(spark, sf_dir), related_facts(spark, sf_dir), relationship="rel", block_size=2)


@query("k3_delay_only_event")
def k3_delay_only_event(spark, sf_dir):
    """Events with a time, with only a delay, or with neither."""
    n = F.col("stop_sequence") % 3
    rows = facts(spark, sf_dir).withColumns({"time": F.when(n == 0, F.col("actual_epoch")),
                                             "late": F.when(n < 2, F.col("stop_id") % 600)})
    return AN.resolve_event_time(rows, "time", "late", out="resolved").select(*B.KEYS, "resolved")


@query("k4_active_only")
def k4_active_only(spark, sf_dir):
    rows = B.stop_updates(spark, sf_dir, with_order=False).withColumns({
        "stop_relationship": F.when(F.col("stop_sequence") % 4 == 0, "SKIPPED").when(F.col("stop_sequence") % 4 == 1, "SCHEDULED"),
        "trip_relationship": F.when(F.col("trip_id") % 5 == 0, "CANCELED").when(F.col("trip_id") % 5 == 1, "DELETED"),
        "is_deleted": F.when(F.col("stop_id") % 7 == 0, True)})
    return FL.active_only(rows).select(*B.KEYS, "arrival_epoch", "departure_epoch")


def _entities(spark, sf_dir) -> DataFrame:
    return decoded_entities(spark, sf_dir).select(
        F.col("entity.id").alias("entity_id"), "feed_key", F.size("entity.trip_update.stop_time_update").alias("n_stops"),
        F.col("header.timestamp").alias("ts"), "entity_pos",
        (F.col("entity.id").cast("long") % 3 == (F.col("header.timestamp") / 86400).cast("long") % 3).alias("is_deleted"))


@query("k6_deleted")
def k6_deleted(spark, sf_dir):
    """Differential feeds of which some delete their entity."""
    e = _entities(spark, sf_dir).withColumn("arrival_order", F.struct("ts", "entity_pos", "feed_key"))
    return apply_differential(e, values=["feed_key", "n_stops"], order="arrival_order").drop("is_deleted")


def mixed_feeds(spark, sf_dir) -> DataFrame:
    """Feeds by day, of which every 100th day's are full datasets."""
    e = _entities(spark, sf_dir).withColumns({"is_full": (F.col("ts") / 86400).cast("long") % 100 == 0,
                                              "arrival_order": F.col("ts")})
    rows = e.groupBy("entity_id", "arrival_order").agg(F.sum("n_stops").alias("n_stops"), F.max("is_deleted").alias("is_deleted"),
                                                       F.max("is_full").alias("is_full"))
    return stored(rows)  # decoded once, read several times


@query("k6_full_dataset")
def k6_full_dataset(spark, sf_dir):
    return apply_feeds(mixed_feeds(spark, sf_dir), values=["n_stops"]).drop("is_deleted")


# ------------------------------------------------- views that move (streams)
from adherence.streaming import evolving as EV  # noqa: E402
from adherence.streaming import turns as TN  # noqa: E402
from adherence.streaming import vehicles as VH  # noqa: E402


def _flat_stream(spark, folder: str, like: DataFrame) -> DataFrame:
    """Landed rows as a stream."""
    return spark.readStream.schema(like.schema).parquet(folder)


def _paths(spark, name: str) -> tuple[str, str, str]:
    """Folders for what is landed, for the sink and for the checkpoint."""
    return tuple(work_path(spark, kind, name, unique=True) for kind in ("landing", "tables", "streams"))


def day_feeds(spark, sf_dir) -> DataFrame:
    """One feed of the whole network per ship day."""
    rows = FB.feed_rows(spark, sf_dir)
    return FD.encode_feeds(rows.withColumn("feed_key", F.split("feed_key", "/")[0]))


@query("r2_delay_now_stream")
def r2_delay_now_stream(spark, sf_dir):
    """R2 as a stream over landed feeds: a feed per day, day windows, two days
    of watermark. The feeds of every seventh day arrive after all others, so
    their windows are closed but for those at the end."""
    landing, sink, ck = _paths(spark, "r2")
    feeds = day_feeds(spark, sf_dir)
    day = F.floor(F.col("feed_ts") / 86400)
    late = day % 7 == 3
    types = {"trip_id": "bigint", "stop_id": "bigint", "stop_sequence": "int"}
    trips = B.trips(spark, sf_dir).select("trip_id", "route_id")
    times = lookup_table(B.stop_times_raw(spark, sf_dir), B.KEYS)  # not de-duplicated and shuffled in every batch

    def start():
        updates, _ = J.updates_from_records(file_stream(spark, landing), types)
        delays = EV.delays_of(updates.drop("route_id"), times, unique_stop_times=True).join(trips, "trip_id")
        return TN.append_stream(EV.moving_windows(delays, ["route_id"], "1 day", "2 days"), sink, ck, TN.NOW)

    records = feeds.select(F.lit("feeds").alias("topic"), F.lit(0).alias("partition"), F.col("feed_ts").alias("offset"),
                           F.timestamp_seconds("feed_ts").alias("timestamp"), "value", late.alias("late"))
    records = records.persist()  # encoded once for the turns
    try:
        on_time = TN.parts_by(records.filter(~F.col("late")), "offset", 2)
        TN.in_turns([p.drop("late") for p in (*on_time, records.filter("late"))], landing, start)
    finally:
        records.unpersist()
    return spark.read.schema("route_id bigint, window_start bigint, n bigint, avg_delay double").parquet(sink)


def frequent_updates(spark, sf_dir) -> DataFrame:
    """Updates of trips that run often: the supplier as trip, twenty groups of
    parts as its stops, the ship day as feed."""
    li = B.table(spark, sf_dir, "lineitem")
    base = epoch_of_ntz("l_shipdate") + (F.col("l_orderkey") * 37) % 86400
    return li.select(F.col("l_suppkey").alias("trip_id"), (F.col("l_partkey") % 20).alias("stop_id"), F.lit(1).alias("stop_sequence"),
                     F.when(F.col("l_returnflag") != "A", base).alias("arrival_epoch"), (base + 30).alias("departure_epoch"),
                     epoch_of_ntz(F.to_timestamp_ntz(F.to_date("l_shipdate"))).alias("feed_ts"))


def frequent_times(spark, sf_dir) -> DataFrame:
    """A timetable for them."""
    rows = frequent_updates(spark, sf_dir).select("trip_id", "stop_id", "stop_sequence").distinct()
    return rows.withColumn("arrival_time", F.format_string("%02d:%02d:00", 4 + F.col("trip_id") % 20, F.col("stop_id") * 3))


@query("r2_delay_changes_stream")
def r2_delay_changes_stream(spark, sf_dir):
    """R2 from feed to feed, the feeds cut into three batches by day."""
    landing, sink, ck = _paths(spark, "r2c")
    updates, times = frequent_updates(spark, sf_dir), lookup_table(frequent_times(spark, sf_dir), B.KEYS)
    buckets = EV.buckets_for(times)

    def start():
        delays = EV.delays_of(_flat_stream(spark, landing, updates), times, keep=["feed_ts"], unique_stop_times=True)
        return TN.append_stream(EV.delay_changes(delays, buckets=buckets), sink, ck, TN.NOW)

    TN.in_turns(TN.parts_by(updates, "feed_ts", 3), landing, start)
    return spark.read.parquet(sink)


@query("t1_latest_of_day_stream")
def t1_latest_of_day_stream(spark, sf_dir):
    """The facts of every finished feed day, with the finished days out of the state."""
    landing, sink, ck = _paths(spark, "t1")
    day = epoch_of_ntz(F.to_timestamp_ntz(F.to_date("arrival_order.l_shipdate")))
    updates = B.stop_updates(spark, sf_dir).withColumn("feed_ts", day)
    times = lookup_table(B.stop_times_raw(spark, sf_dir), B.KEYS)  # not de-duplicated and shuffled in every batch

    def start():
        timed = choose_actual_time(_flat_stream(spark, landing, updates))
        facts_ = add_delay(schedule_lookup(EV.latest_of_day(timed), times, B.KEYS, dedupe=False, shuffled=True)).filter("reject_reason IS NULL")
        cols = (*B.KEYS, "feed_date", "scheduled_epoch", "actual_epoch", "delay_seconds", "time_source")
        return TN.append_stream(facts_.select(*cols), sink, ck, TN.NOW)

    TN.in_turns(TN.parts_by(updates, "feed_ts", 3), landing, start)
    return spark.read.parquet(sink)


@query("k6_stream")
def k6_stream(spark, sf_dir):
    """The feeds of k6_full_dataset as a stream, cut into three batches."""
    landing, sink, ck = _paths(spark, "k6")
    feeds = mixed_feeds(spark, sf_dir).withColumnRenamed("arrival_order", "feed_ts")
    first = Window.partitionBy("feed_ts").orderBy("entity_id")
    feeds = stored(feeds.withColumn("is_head", F.row_number().over(first) == 1))

    def start():
        return TN.append_stream(EV.live_entities(_flat_stream(spark, landing, feeds)), sink, ck, TN.NOW)

    TN.in_turns(TN.parts_by(feeds, "feed_ts", 3), landing, start)
    return EV.last_emitted(spark.read.parquet(sink), ["entity_id"]).filter("live").drop("live")


@query("k1_stream")
def k1_stream(spark, sf_dir):
    """Predictions of k1_resets as a stream: the timetable first, then the
    updates in two batches; the last emission of every stop."""
    landing, sink, ck = _paths(spark, "k1")
    none = F.lit(None).cast("int")
    stops = B.stop_times(spark, sf_dir).select(F.lit("stop").alias("kind"), *B.KEYS, F.lit(-1).cast("long").alias("ord"),
                                               none.alias("delay_seconds"), none.alias("trip_delay"))
    own = F.when(F.coalesce("rel", F.lit("")) != "NO_DATA", F.col("delay_seconds"))
    updates = related_facts(spark, sf_dir).select(F.lit("update").alias("kind"), *B.KEYS, F.col("actual_epoch").alias("ord"),
                                                  own.alias("delay_seconds"), none.alias("trip_delay"))
    updates = stored(updates)  # the facts are computed once for the parts
    buckets = EV.buckets_for(B.stop_times_raw(spark, sf_dir))

    def start():
        return TN.append_stream(EV.live_predictions(_flat_stream(spark, landing, stops), buckets=buckets), sink, ck, TN.NOW)

    TN.in_turns([stops, *TN.parts_by(updates, "ord", 2)], landing, start)
    return EV.last_emitted(spark.read.parquet(sink), B.KEYS)


def vehicle_rows(spark, sf_dir) -> DataFrame:
    """Positions of vehicles: an event is where its user's vehicle was seen. A
    feed holds ten minutes; a third of the positions is in the next feed too."""
    ev = B.events(spark, sf_dir).select(F.col("user_id").alias("v"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("t")) \
          .distinct()
    s = B.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("vehicle_label"))
    n = F.when(F.col("t") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    ev = ev.join(s, F.col("v") == F.col("k"), "left").withColumn("later", F.explode(n))
    feed = (F.floor(F.col("t") / 600) + F.col("later")) * 600
    quarter = lambda c, k: ((c % k) / 4).cast("float")
    return ev.select(
        feed.cast("string").alias("feed_key"), feed.alias("feed_ts"), F.col("v").cast("string").alias("vehicle_id"), "vehicle_label",
        F.when(F.col("t") % 4 != 0, F.concat(F.lit("T"), (F.col("t") % 50).cast("string"))).alias("trip_id"),
        F.lit(None).cast("string").alias("route_id"),
        (quarter(F.col("t"), 720) - 90).cast("float").alias("latitude"),
        (quarter(F.col("t") * 7 + F.col("v"), 1440) - 180).cast("float").alias("longitude"),
        F.when(F.col("t") % 5 != 0, quarter(F.col("t"), 1440)).cast("float").alias("bearing"),
        F.when(F.col("t") % 7 != 0, quarter(F.col("t"), 120)).cast("float").alias("speed"),
        (F.col("t") % 40).alias("current_stop_sequence"),
        F.when(F.col("t") % 2 == 0, "STOPPED_AT").alias("current_status"),
        F.concat(F.lit("S"), (F.col("v") % 9).cast("string")).alias("stop_id"), F.col("t").alias("vehicle_ts"))


def seen_vehicles(spark, sf_dir) -> DataFrame:
    landing, sink, ck = _paths(spark, "r3")
    feeds = VH.encode_vehicle_feeds(vehicle_rows(spark, sf_dir)).persist()

    def start():
        return TN.append_stream(VH.positions_once(spark.readStream.schema("value binary").parquet(landing)), sink, ck, TN.NOW)

    try:
        TN.in_turns([p.select("value") for p in TN.parts_by(feeds, "feed_ts", 3)], landing, start)
    finally:
        feeds.unpersist()
    return spark.read.parquet(sink)


@query("r3_positions_stream")
def r3_positions_stream(spark, sf_dir):
    """Every position once, though feeds repeat them."""
    return seen_vehicles(spark, sf_dir).select(
        "vehicle_id", "vehicle_ts", "vehicle_label", "trip_id", F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"), F.col("bearing").cast("double").alias("bearing"),
        F.col("speed").cast("double").alias("speed"), "current_stop_sequence", "current_status", "stop_id")


@query("r3_latest_vehicles")
def r3_latest_vehicles(spark, sf_dir):
    """The last position of every vehicle, from the stream's table."""
    last = FL.latest_vehicles(seen_vehicles(spark, sf_dir), order=("vehicle_ts", "feed_ts"))
    return last.select("vehicle_id", "vehicle_ts", F.col("latitude").cast("double").alias("latitude"),
                       F.col("speed").cast("double").alias("speed"), "stop_id")


@query("j2_stream")
def j2_stream(spark, sf_dir):
    """The lookup of j2_schedule_lookup as one streaming plan whose timetable is
    landed as rows: the timetable first, then the updates in two batches."""
    landing, sink, ck = _paths(spark, "j2")
    latest = latest_per_key(choose_actual_time(B.stop_updates(spark, sf_dir)), B.KEYS, ["actual_epoch"], "arrival_order")
    none, one = F.lit(None), F.lit(1).cast("long").alias("version")
    stops = B.stop_times_raw(spark, sf_dir).select(F.lit("stop").alias("kind"), *B.KEYS, "arrival_time", one,
                                                   F.lit(0).cast("long").alias("actual_epoch"))
    updates = latest.select(F.lit("update").alias("kind"), *B.KEYS, none.cast("string").alias("arrival_time"), one, "actual_epoch")
    updates = stored(updates)  # once for the parts
    buckets = EV.buckets_for(B.stop_times_raw(spark, sf_dir))

    def start():
        return TN.append_stream(EV.scheduled_updates(_flat_stream(spark, landing, stops), buckets=buckets), sink, ck, TN.NOW)

    TN.in_turns([stops, *TN.parts_by(updates, "actual_epoch", 2)], landing, start)
    return spark.read.parquet(sink)


# ------------------------------------------------------ feeds of a network
def network_entities(spark, sf_dir) -> DataFrame:
    good, _ = FD.split_rejects(FD.decode(day_feeds(spark, sf_dir), keep=["feed_key"]))
    return good


@query("t5_decode_network")
def t5_decode_network(spark, sf_dir):
    """T5 over feeds of the whole network, one per day: many entities each."""
    return FL.stop_updates(network_entities(spark, sf_dir), keep=["feed_key"]).select(
        "feed_key", "feed_ts", "entity_pos", "entity_id", "trip_id", "route_id", "start_date", "trip_delay",
        "stop_pos", "stop_id", "stop_sequence", "arrival_epoch", "departure_epoch")


@query("p5_explode_network")
def p5_explode_network(spark, sf_dir):
    """P5 on nested feeds of many entities."""
    feeds = FD.decode(day_feeds(spark, sf_dir), keep=["feed_key"], level="feed")
    return FL.explode_entities(feeds.filter("decode_error IS NULL")).select(
        "feed_key", "entity_pos", F.col("entity.id").alias("entity_id"), F.size("entity.trip_update.stop_time_update").alias("n_stops"))


@query("s9_network_publish")
def s9_network_publish(spark, sf_dir):
    return day_feeds(spark, sf_dir).select("feed_key", "feed_ts", "n_entities", "n_stops")


@query("s9_publish_checked")
def s9_publish_checked(spark, sf_dir):
    """Given feeds, some damaged and some empty: the good ones are landed as
    they are, the others come back with an error."""
    landing = work_path(spark, "landing", "checked", unique=True)
    day = F.floor(F.col("feed_ts") / 86400) % 5
    value = F.when(day == 0, F.concat("value", F.unhex(F.lit("FF")))).when(day == 1, None).otherwise(F.col("value"))
    given = day_feeds(spark, sf_dir).select("feed_key", "feed_ts", value.alias("value"))
    bad = FD.publish_checked(given, lambda good: land_records(good, landing, "feeds", ts_col="feed_ts"))
    sent = FD.decode(spark.read.parquet(landing), keep=[]).select(F.col("header.timestamp").alias("feed_ts"), "entity_pos")
    return (sent.groupBy("feed_ts").agg(F.count("*").alias("entities")).withColumn("sent", F.lit(True))
                .unionByName(bad.select("feed_ts", F.lit(0).cast("long").alias("entities"), F.lit(False).alias("sent"))))
