"""Equivalent DuckDB SQL for the registered queries (the correctness oracle).

The shared CTEs restate the bindings of ``adherence.plans.bindings`` in SQL.
"""

from __future__ import annotations

TZ = "America/New_York"

# Logical tables over the given tables, as SQL (same rules as bindings.py).
BIND = f"""
routes AS (SELECT c_custkey AS route_id, c_name AS route_short_name, c_nationkey AS route_type FROM customer),
trips AS (SELECT o_custkey AS route_id, o_orderpriority AS service_id, o_orderkey AS trip_id,
                 o_orderstatus AS trip_headsign, CAST(o_orderkey % 2 AS INTEGER) AS direction_id FROM orders),
stops AS (SELECT s_suppkey AS stop_id, s_name AS stop_name FROM supplier),
stop_times_raw AS (
  SELECT l_orderkey AS trip_id, l_suppkey AS stop_id, l_linenumber AS stop_sequence,
         printf('%02d:%02d:%02d',
                CASE WHEN CAST(l_quantity AS INTEGER) % 5 = 0 THEN 26 + CAST(l_quantity AS INTEGER) % 4
                     ELSE 4 + CAST(l_quantity AS INTEGER) % 20 END,
                (l_linenumber * 7) % 60, l_suppkey % 60) AS arrival_time
  FROM lineitem),
stop_times AS (SELECT trip_id, stop_id, stop_sequence, min(arrival_time) AS arrival_time
               FROM stop_times_raw GROUP BY trip_id, stop_id, stop_sequence),
upd_base AS (
  SELECT l_orderkey AS trip_id, l_suppkey AS stop_id, l_linenumber AS stop_sequence,
         CAST(epoch(l_shipdate) AS BIGINT) + (l_partkey * 37) % 86400 AS base,
         l_returnflag, l_linestatus,
         row(l_shipdate, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus) AS ord
  FROM lineitem),
stop_updates AS (
  SELECT trip_id, stop_id, stop_sequence,
         CASE WHEN l_returnflag <> 'A' THEN base END AS arrival_epoch,
         CASE WHEN NOT (l_returnflag = 'A' AND l_linestatus = 'O') THEN base + 30 END AS departure_epoch,
         ord
  FROM upd_base),
timed AS (
  SELECT trip_id, stop_id, stop_sequence, coalesce(arrival_epoch, departure_epoch) AS actual_epoch,
         CASE WHEN arrival_epoch IS NOT NULL THEN 'arrival' ELSE 'departure' END AS time_source, ord
  FROM stop_updates WHERE coalesce(arrival_epoch, departure_epoch) IS NOT NULL),
latest AS (
  SELECT trip_id, stop_id, stop_sequence,
         max_by(struct_pack(actual_epoch := actual_epoch, time_source := time_source), ord) AS v
  FROM timed GROUP BY trip_id, stop_id, stop_sequence),
joined AS (
  SELECT l.trip_id, l.stop_id, l.stop_sequence, l.v.actual_epoch AS actual_epoch,
         l.v.time_source AS time_source, s.arrival_time,
         CAST(split_part(s.arrival_time, ':', 1) AS INTEGER) AS h,
         CAST(split_part(s.arrival_time, ':', 2) AS INTEGER) AS m,
         CAST(split_part(s.arrival_time, ':', 3) AS INTEGER) AS s
  FROM latest l JOIN stop_times s USING (trip_id, stop_id, stop_sequence)),
scored AS (
  SELECT *, CAST(epoch(timezone('{TZ}',
              CAST(CAST(timezone('{TZ}', to_timestamp(actual_epoch)) AS DATE)
                   - CAST(CASE WHEN h >= 24 THEN 1 ELSE 0 END AS INTEGER) AS TIMESTAMP)
              + to_seconds(CAST(h AS BIGINT) * 3600 + m * 60 + s))) AS BIGINT) AS scheduled_epoch
  FROM joined),
trip_delays AS (
  SELECT trip_id, stop_id, stop_sequence, scheduled_epoch, actual_epoch,
         CAST(actual_epoch - scheduled_epoch AS INTEGER) AS delay_seconds, time_source
  FROM scored)
"""


def with_bind(body: str) -> str:
    return "WITH " + BIND.strip() + "\n" + body


SQL: dict[str, str] = {}

SQL["c2_trip_delays"] = with_bind("SELECT * FROM trip_delays")

_SEL = "(SELECT max(trip_id) FROM trip_delays WHERE trip_id IN (SELECT trip_id FROM trips))"
_LABEL = ("'Trip: ' || coalesce(CAST(trip_id AS VARCHAR), 'None') || ' | Route: ' || "
          "coalesce(CAST(route_short_name AS VARCHAR), 'None') || ' | Headsign: ' || "
          "coalesce(CAST(trip_headsign AS VARCHAR), 'None')")
_C5 = f"""
, opts AS (
  SELECT td.trip_id, dt.route_id, dr.route_short_name, dt.trip_headsign
  FROM trip_delays td JOIN trips dt ON td.trip_id = dt.trip_id
  LEFT JOIN routes dr ON dt.route_id = dr.route_id
  GROUP BY td.trip_id, dt.route_id, dr.route_short_name, dt.trip_headsign
  ORDER BY td.trip_id DESC, dt.route_id NULLS LAST, dr.route_short_name NULLS LAST,
           dt.trip_headsign NULLS LAST
  LIMIT 100)
"""
SQL["c5_trip_options"] = with_bind(_C5 + f"SELECT *, {_LABEL} AS display FROM opts")
SQL["o5_label_unique"] = with_bind(_C5 + f"SELECT {_LABEL} AS display, max(trip_id) AS trip_id FROM opts GROUP BY 1")
SQL["o1_top_k"] = with_bind(_C5 + "SELECT * FROM opts")
SQL["a4_group_dedup"] = with_bind("""
SELECT td.trip_id, dt.route_id, dr.route_short_name, dt.trip_headsign
FROM trip_delays td JOIN trips dt ON td.trip_id = dt.trip_id LEFT JOIN routes dr ON dt.route_id = dr.route_id
GROUP BY td.trip_id, dt.route_id, dr.route_short_name, dt.trip_headsign""")
_LATE = "SELECT stop_sequence, stop_id, scheduled_epoch, actual_epoch, delay_seconds FROM trip_delays"
SQL["c6_late_stops"] = with_bind(f"{_LATE} WHERE trip_id = {_SEL} AND delay_seconds > 0 ORDER BY stop_sequence")
SQL["o2_sort"] = with_bind("""
SELECT trip_id, stop_sequence, stop_id, delay_seconds,
       CAST(row_number() OVER (PARTITION BY trip_id ORDER BY stop_sequence, stop_id) AS INTEGER) AS place
FROM trip_delays WHERE delay_seconds > 0""")
SQL["c6_late_stops_all"] = with_bind(
    "SELECT trip_id, stop_sequence, stop_id, scheduled_epoch, actual_epoch, delay_seconds FROM trip_delays "
    "WHERE delay_seconds > 0")
SQL["p13_late_filter"] = with_bind("SELECT * FROM trip_delays WHERE delay_seconds > 0")
SQL["p12_key_filter"] = with_bind(f"SELECT * FROM trip_delays WHERE trip_id = {_SEL}")
SQL["p14_series_project"] = with_bind(
    f"SELECT stop_sequence, delay_seconds FROM trip_delays WHERE trip_id = {_SEL} AND delay_seconds > 0")
SQL["c7_trip_info"] = with_bind(
    f"SELECT route_id, trip_headsign, direction_id FROM trips WHERE trip_id = {_SEL} "
    "ORDER BY route_id, trip_headsign, direction_id LIMIT 1")
SQL["o4_first_row"] = with_bind("""
SELECT trip_id, r.stop_sequence AS stop_sequence, r.stop_id AS stop_id, r.arrival_time AS arrival_time FROM (
  SELECT trip_id, min(struct_pack(stop_sequence := stop_sequence, stop_id := stop_id,
                                  arrival_time := arrival_time)) AS r
  FROM stop_times GROUP BY trip_id)""")
SQL["j3_fact_trip_join"] = with_bind("""
SELECT td.trip_id, td.stop_id, td.stop_sequence, td.delay_seconds, dt.route_id, dt.trip_headsign
FROM trip_delays td JOIN trips dt ON td.trip_id = dt.trip_id""")
SQL["j4_trip_route_join"] = with_bind("""
SELECT dt.route_id, dt.trip_id, dr.route_short_name FROM trips dt LEFT JOIN routes dr ON dt.route_id = dr.route_id""")
SQL["r6_enrich"] = with_bind("""
SELECT td.*, dt.route_id, dt.trip_headsign, dt.direction_id, dr.route_short_name
FROM trip_delays td JOIN trips dt ON td.trip_id = dt.trip_id LEFT JOIN routes dr ON dt.route_id = dr.route_id""")
SQL["f8_display_label"] = with_bind(f"""
SELECT trip_id, {_LABEL} AS display FROM (
  SELECT dt.trip_id, dr.route_short_name, dt.trip_headsign
  FROM trips dt LEFT JOIN routes dr ON dt.route_id = dr.route_id)""")
SQL["p1_project"] = with_bind("SELECT trip_id, route_id FROM trips")

# ---------------------------------------------------------------- quality
_NS = "NULL::VARCHAR[]"
_EMPTY = "[]::VARCHAR[]"
# bound table -> (keys, non-nullable columns present, text columns among them)
_QT = {
    "routes": (["route_id"], ["route_id", "route_type"], []),
    "trips": (["trip_id", "service_id"], ["route_id", "service_id", "trip_id", "direction_id"], ["service_id"]),
    "stops": (["stop_id"], ["stop_id", "stop_name"], ["stop_name"]),
    "calendar": (["service_id"], ["service_id", "start_date", "end_date"], ["service_id", "start_date", "end_date"]),
    "stop_times": (["trip_id", "stop_sequence"], ["trip_id", "stop_id", "stop_sequence"], []),
}
_CAL = """, calendar AS (SELECT o_orderpriority AS service_id, strftime(min(o_orderdate), '%Y%m%d') AS start_date,
                            strftime(max(o_orderdate), '%Y%m%d') AS end_date FROM orders GROUP BY 1)"""


def _ktext(keys, alias=""):
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({alias}{k} AS VARCHAR), 'NULL')" for k in keys) + ")"


def _sample(src, keys):
    ks = ", ".join(keys)
    return (f"(SELECT coalesce(list_sort(list({_ktext(keys)})), {_EMPTY}) FROM "
            f"(SELECT {ks} FROM {src} ORDER BY {ks} LIMIT 5))")


def _table_report(name, src=None):
    src = src or name
    keys, nn, text = _QT[name]
    ks = ", ".join(keys)
    parts = [f"SELECT '{name}' AS \"table\", 'row_count' AS \"check\", NULL::VARCHAR AS \"column\", "
             f"count(*) AS violations, {_NS} AS sample FROM {src}"]
    for c in nn:
        cond = f"{c} IS NULL OR {c} = ''" if c in text else f"{c} IS NULL"
        parts.append(f"SELECT '{name}', 'null_check', '{c}', count_if({cond}), {_NS} FROM {src}")
    dup = f"(SELECT {ks} FROM {src} GROUP BY {ks} HAVING count(*) > 1)"
    parts.append(f"SELECT '{name}', 'unique_check', '{','.join(keys)}', "
                 f"(SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT {ks} FROM {src})), "
                 f"{_sample(dup, keys)}")
    return "\nUNION ALL\n".join(parts)


_REPORT = "\nUNION ALL\n".join(_table_report(n) for n in _QT)
_BINDQ = BIND.strip().replace("stop_times AS (", "stop_times_agg AS (") + _CAL


def with_bind_q(body: str) -> str:
    # In the quality queries the stop_times table is the raw one (keys repeat).
    return ("WITH " + _BINDQ + ", stop_times AS (SELECT * FROM stop_times_raw)\n" + body)


SQL["q4_null_check"] = with_bind_q(f"SELECT * FROM ({_REPORT}) WHERE \"check\" = 'null_check'")
SQL["q5_unique_check"] = with_bind_q(f"SELECT * FROM ({_REPORT}) WHERE \"check\" = 'unique_check'")
SQL["q6_row_count"] = with_bind_q(f"SELECT * FROM ({_REPORT}) WHERE \"check\" = 'row_count'")


def _fk(child, ccol, parent, pcol):
    miss = (f"(SELECT DISTINCT {ccol} FROM {child} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{ccol}))")
    return (f"SELECT '{child}' AS \"table\", 'foreign_key' AS \"check\", "
            f"'{ccol}->{parent}.{pcol}' AS \"column\", (SELECT count(*) FROM {miss}) AS violations, "
            f"{_sample(miss, [ccol])} AS sample")


SQL["q7_foreign_key"] = with_bind_q(_fk("trips", "route_id", "routes", "route_id"))
SQL["q7_foreign_key_unused_routes"] = with_bind_q(_fk("routes", "route_id", "trips", "route_id"))
SQL["j1_anti_join"] = with_bind_q(
    "SELECT DISTINCT route_id FROM routes r WHERE NOT EXISTS (SELECT 1 FROM trips t WHERE t.route_id = r.route_id)")
SQL["q8_referential_integrity"] = SQL["q7_foreign_key"]
SQL["r5_all_links"] = with_bind_q("\nUNION ALL\n".join([
    _fk("trips", "route_id", "routes", "route_id"), _fk("trips", "service_id", "calendar", "service_id"),
    _fk("stop_times", "trip_id", "trips", "trip_id"), _fk("stop_times", "stop_id", "stops", "stop_id")]))
SQL["a1_count"] = with_bind(
    "SELECT count(*) AS n_rows, count_if(delay_seconds > 0) AS n_late FROM trip_delays")
SQL["a2_distinct"] = with_bind_q("SELECT DISTINCT trip_id, stop_sequence FROM stop_times")
SQL["a3_excess_rows"] = with_bind_q("""
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n) - count(*) AS BIGINT) AS excess_rows
FROM (SELECT trip_id, stop_sequence, count(*) AS n FROM stop_times GROUP BY ALL)""")
SQL["p2_null_or_empty"] = with_bind_q("""
SELECT count_if(route_id IS NULL) AS empty_route_id, count_if(service_id IS NULL OR service_id = '') AS empty_service_id,
       count_if(trip_id IS NULL) AS empty_trip_id, count_if(trip_headsign IS NULL OR trip_headsign = '') AS empty_trip_headsign,
       count_if(direction_id IS NULL) AS empty_direction_id FROM trips""")
SQL["s1_csv_scan"] = """
SELECT CAST(o_custkey AS VARCHAR) AS route_id, o_orderpriority AS service_id, CAST(o_orderkey AS VARCHAR) AS trip_id,
       o_orderstatus AS trip_headsign, NULL::VARCHAR AS trip_short_name, CAST(o_orderkey % 2 AS INTEGER) AS direction_id,
       NULL::VARCHAR AS block_id, NULL::VARCHAR AS shape_id, TRY_CAST(o_orderstatus AS INTEGER) AS wheelchair_accessible,
       NULL::INTEGER AS bikes_allowed
FROM orders"""
SQL["q1_required_columns"] = f"""SELECT 'trips' AS "table", 'required_columns' AS "check", 'shape_id' AS "column",
CAST(1 AS BIGINT) AS violations, {_EMPTY} AS sample"""
SQL["q2_extra_columns"] = f"""SELECT 'trips' AS "table", 'extra_columns' AS "check", 'fare' AS "column",
CAST(1 AS BIGINT) AS violations, {_EMPTY} AS sample"""
SQL["q3_type_match"] = f"""
SELECT 'trips' AS "table", 'type_match' AS "check", c AS "column", v AS violations, {_NS} AS sample FROM (
  SELECT 'direction_id' AS c, count_if(TRY_CAST(CAST(o_orderkey % 2 AS VARCHAR) AS INTEGER) IS NULL) AS v FROM orders
  UNION ALL
  SELECT 'wheelchair_accessible', count_if(TRY_CAST(o_orderstatus AS INTEGER) IS NULL) FROM orders)"""

# ---------------------------------------------------------------- feed
_FEED = """
WITH fr AS (
  SELECT strftime(l.l_shipdate, '%Y%m%d') || '/' || CAST(l.l_orderkey // 64 AS VARCHAR) AS feed_key,
         CAST(epoch(date_trunc('day', l.l_shipdate)) AS BIGINT) AS feed_ts,
         l.l_orderkey AS tk, CAST(l.l_orderkey AS VARCHAR) AS trip_id, CAST(o.o_custkey AS VARCHAR) AS route_id,
         strftime(o.o_orderdate, '%Y%m%d') AS start_date,
         CASE WHEN o.o_orderstatus = 'F' THEN CAST(CAST(trunc(o.o_totalprice) AS BIGINT) % 600 - 300 AS INTEGER) END
           AS trip_delay,
         l.l_suppkey AS sk, CAST(l.l_suppkey AS VARCHAR) AS stop_id, CAST(l.l_linenumber AS BIGINT) AS stop_sequence,
         CASE WHEN l.l_returnflag <> 'A' THEN CAST(epoch(l.l_shipdate) AS BIGINT) + (l.l_partkey * 37) % 86400 END
           AS arrival_epoch,
         CASE WHEN NOT (l.l_returnflag = 'A' AND l.l_linestatus = 'O')
              THEN CAST(epoch(l.l_shipdate) AS BIGINT) + (l.l_partkey * 37) % 86400 + 30 END AS departure_epoch
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey),
fs AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY feed_key ORDER BY tk) - 1 AS INTEGER) AS entity_pos,
         CAST(row_number() OVER (PARTITION BY feed_key, tk ORDER BY stop_sequence, sk, arrival_epoch NULLS FIRST,
                                 departure_epoch NULLS FIRST) - 1 AS INTEGER) AS stop_pos,
         trip_id AS entity_id
  FROM fr),
ent AS (
  SELECT feed_key, any_value(feed_ts) AS feed_ts, entity_pos, any_value(entity_id) AS entity_id,
         any_value(trip_id) AS trip_id, any_value(route_id) AS route_id, any_value(start_date) AS start_date,
         any_value(trip_delay) AS trip_delay, min(tk) AS tk, CAST(count(*) AS INTEGER) AS n_stops
  FROM fs GROUP BY feed_key, entity_pos),
first_trip AS (
  SELECT feed_key, arg_min(struct_pack(trip_id := trip_id, route_id := route_id, delay := coalesce(trip_delay, 0)), tk)
           AS f
  FROM ent GROUP BY feed_key)
"""
SQL["s9_feed_publish"] = _FEED + """
SELECT feed_key, any_value(feed_ts) AS feed_ts, CAST(count(DISTINCT tk) AS INTEGER) AS n_entities,
       CAST(count(*) AS INTEGER) AS n_stops FROM fr GROUP BY feed_key"""
SQL["t5_decode_feed"] = _FEED + """
SELECT feed_key, feed_ts, entity_pos, entity_id, trip_id, route_id, start_date, trip_delay, stop_pos, stop_id,
       stop_sequence, arrival_epoch, departure_epoch FROM fs"""
SQL["p3_struct_project"] = _FEED + "SELECT feed_key, trip_id, route_id, trip_delay AS delay FROM ent"
SQL["p4_present_filter"] = _FEED + "SELECT feed_key, entity_id FROM ent"
SQL["p5_explode_entities"] = _FEED + "SELECT feed_key, entity_pos, entity_id, n_stops FROM ent"
SQL["p6_explode_stops"] = _FEED + "SELECT feed_key, entity_pos, stop_pos, trip_id, stop_id, stop_sequence FROM fs"
SQL["p7_time_choice"] = _FEED + """
SELECT feed_key, trip_id, stop_id, stop_sequence, stop_pos, coalesce(arrival_epoch, departure_epoch) AS actual_epoch,
       CASE WHEN arrival_epoch IS NOT NULL THEN 'arrival' ELSE 'departure' END AS time_source
FROM fs WHERE coalesce(arrival_epoch, departure_epoch) IS NOT NULL"""
SQL["p8_proto_defaults"] = _FEED + "SELECT feed_key, stop_pos, trip_id, stop_id, stop_sequence FROM fs"
_FIRST = _FEED + "SELECT feed_key, f.trip_id AS trip_id, f.route_id AS route_id, f.delay AS delay FROM first_trip"
SQL["p9_first_trip"] = _FIRST
SQL["c3_trip_level_delay"] = _FEED + "SELECT f.trip_id AS trip_id, f.route_id AS route_id, f.delay AS delay FROM first_trip"
SQL["c4_trip_update_log"] = _FEED + "SELECT trip_id, start_date, route_id, true AS has_time FROM ent"
SQL["u1_scalar_udf"] = _FIRST
SQL["u2_udf_register"] = _FIRST
SQL["p10_delay_default"] = _FEED + "SELECT feed_key, entity_id, coalesce(trip_delay, 0) AS delay FROM ent"
SQL["t6_decode_trip_update"] = _FEED + "SELECT feed_key, trip_id, start_date, route_id, n_stops FROM ent"
SQL["p11_trip_update_map"] = _FEED + "SELECT trip_id, start_date, route_id FROM ent"

# Stream order: feed time, then the position inside the feed; for one key
# that is (ship day, arrival NULLS FIRST, departure NULLS FIRST).
SQL["c2_trip_delays_stream"] = with_bind("SELECT * FROM trip_delays").replace(
    """row(l_shipdate, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus) AS ord""",
    """row(date_trunc('day', l_shipdate),
             CASE WHEN l_returnflag <> 'A' THEN 1 ELSE 0 END,
             CASE WHEN l_returnflag <> 'A' THEN CAST(epoch(l_shipdate) AS BIGINT) + (l_partkey * 37) % 86400 ELSE 0 END,
             CASE WHEN NOT (l_returnflag = 'A' AND l_linestatus = 'O') THEN 1 ELSE 0 END,
             CASE WHEN NOT (l_returnflag = 'A' AND l_linestatus = 'O')
                  THEN CAST(epoch(l_shipdate) AS BIGINT) + (l_partkey * 37) % 86400 + 30 ELSE 0 END) AS ord""")

# ---------------------------------------------------------------- analytics
SQL["r1_delay_hotspots"] = with_bind(f"""
, e AS (
  SELECT td.*, dt.route_id,
         hour(timezone('{TZ}', to_timestamp(scheduled_epoch))) AS hour,
         dayofweek(CAST(timezone('{TZ}', to_timestamp(scheduled_epoch)) AS DATE)) + 1 AS weekday
  FROM trip_delays td JOIN trips dt ON td.trip_id = dt.trip_id LEFT JOIN routes dr ON dt.route_id = dr.route_id)
SELECT route_id, stop_id, CAST(hour AS INTEGER) AS hour, CAST(weekday AS INTEGER) AS weekday,
       CAST(GROUPING(route_id, stop_id, hour, weekday) AS INTEGER) AS level,
       count(*) AS n, round(avg(delay_seconds), 3) AS avg_delay, count_if(delay_seconds > 0) AS n_late,
       round(count_if(delay_seconds > 0) / count(*), 4) AS late_share, max(delay_seconds) AS max_delay
FROM e GROUP BY GROUPING SETS ((route_id), (stop_id), (hour), (weekday), (route_id, hour), ())""")
_SETS = "GROUP BY GROUPING SETS ((route_id), (stop_id), (hour), (weekday), (route_id, hour), ())"
SQL["r1_cube"] = SQL["r1_delay_hotspots"].replace(_SETS, "GROUP BY CUBE (route_id, stop_id, hour, weekday)")
SQL["r1_top_hotspots"] = f"""SELECT * FROM ({SQL["r1_delay_hotspots"]}) WHERE level = 11 AND n >= 5
ORDER BY late_share DESC, avg_delay DESC, route_id, stop_id, hour, weekday LIMIT 10"""
SQL["r2_delay_now"] = with_bind(f"""
, hist AS (
  SELECT s.trip_id, s.actual_epoch, t.route_id,
         CAST(s.actual_epoch - CAST(epoch(timezone('{TZ}',
              CAST(CAST(timezone('{TZ}', to_timestamp(s.actual_epoch)) AS DATE)
                   - CAST(CASE WHEN s.h >= 24 THEN 1 ELSE 0 END AS INTEGER) AS TIMESTAMP)
              + to_seconds(CAST(s.h AS BIGINT) * 3600 + s.m * 60 + s.s))) AS BIGINT) AS INTEGER) AS delay_seconds
  FROM (SELECT u.*, st.arrival_time,
               CAST(split_part(st.arrival_time, ':', 1) AS INTEGER) AS h,
               CAST(split_part(st.arrival_time, ':', 2) AS INTEGER) AS m,
               CAST(split_part(st.arrival_time, ':', 3) AS INTEGER) AS s
        FROM timed u JOIN stop_times st USING (trip_id, stop_id, stop_sequence)) s
  JOIN trips t ON s.trip_id = t.trip_id),
agg AS (
  SELECT route_id, (actual_epoch // 86400) * 86400 AS window_start, count(*) AS n, avg(delay_seconds) AS a
  FROM hist GROUP BY route_id, (actual_epoch // 86400) * 86400)
SELECT route_id, window_start, n, round(a, 3) AS avg_delay,
       round(a - lag(a) OVER (PARTITION BY route_id ORDER BY window_start), 3) AS change
FROM agg""")
_K1 = """
, j AS (
  SELECT st.trip_id, st.stop_id, st.stop_sequence, td.delay_seconds AS own_delay
  FROM stop_times st LEFT JOIN trip_delays td USING (trip_id, stop_id, stop_sequence)),
p AS (
  SELECT *, last(own_delay IGNORE NULLS) OVER (PARTITION BY trip_id ORDER BY stop_sequence, stop_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pd,
         max(CASE WHEN own_delay IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY trip_id ORDER BY stop_sequence, stop_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
  FROM j)
"""
SQL["k1_delay_propagation"] = with_bind(_K1 + """
SELECT trip_id, stop_id, stop_sequence, own_delay, pd AS predicted_delay,
       CASE WHEN own_delay IS NOT NULL THEN 'own' WHEN pd IS NOT NULL THEN 'propagated' END AS delay_source FROM p""")
SQL["k2_trip_delay_fallback"] = with_bind(_K1 + """
, o AS (SELECT o_orderkey AS trip_id, CASE WHEN o_orderstatus = 'F'
               THEN CAST(CAST(trunc(o_totalprice) AS BIGINT) % 600 - 300 AS INTEGER) END AS trip_delay FROM orders)
SELECT p.trip_id, stop_id, stop_sequence, own_delay,
       CASE WHEN pd IS NULL AND seen = 0 AND o.trip_delay IS NOT NULL THEN o.trip_delay ELSE pd END AS predicted_delay,
       CASE WHEN pd IS NULL AND seen = 0 AND o.trip_delay IS NOT NULL THEN 'trip'
            WHEN own_delay IS NOT NULL THEN 'own' WHEN pd IS NOT NULL THEN 'propagated' END AS delay_source
FROM p LEFT JOIN o ON p.trip_id = o.trip_id""")
SQL["k5_start_date_day"] = with_bind(f"""
, k AS (
  SELECT td.trip_id, td.stop_id, td.stop_sequence, strftime(o.o_orderdate, '%Y%m%d') AS start_date, td.actual_epoch,
         CAST(split_part(st.arrival_time, ':', 1) AS INTEGER) AS h,
         CAST(split_part(st.arrival_time, ':', 2) AS INTEGER) AS m,
         CAST(split_part(st.arrival_time, ':', 3) AS INTEGER) AS s
  FROM trip_delays td JOIN stop_times st USING (trip_id, stop_id, stop_sequence)
  JOIN orders o ON o.o_orderkey = td.trip_id),
k2 AS (
  SELECT *, CAST(epoch(timezone('{TZ}', CAST(CAST(strptime(start_date, '%Y%m%d') AS DATE) AS TIMESTAMP)
              + to_seconds(CAST(h AS BIGINT) * 3600 + m * 60 + s))) AS BIGINT) AS scheduled_epoch FROM k)
SELECT trip_id, stop_id, stop_sequence, start_date, scheduled_epoch, actual_epoch,
       CAST(actual_epoch - scheduled_epoch AS INTEGER) AS delay_seconds FROM k2""")
SQL["k6_differential"] = _FEED + """
SELECT entity_id, f.feed_key AS feed_key, f.n_stops AS n_stops FROM (
  SELECT entity_id, max_by(struct_pack(feed_key := feed_key, n_stops := n_stops), row(feed_ts, entity_pos)) AS f
  FROM ent GROUP BY entity_id)"""
SQL["t1_latest_per_key"] = """
SELECT user_id, v.event_id AS event_id, v.event_type AS event_type, v.value AS value, v.props AS props FROM (
  SELECT user_id, max_by(struct_pack(event_id := event_id, event_type := event_type, value := value, props := props),
                         row(ts, event_id)) AS v
  FROM events GROUP BY user_id)"""

# C1 over the CSV export of the bound tables: every column is text there, so
# samples order keys as text; declared non-text columns get a type check.
_C1_TYPED = {"routes": ["route_type"], "trips": ["direction_id"], "stop_times": ["stop_sequence"]}
_C1_MISSING = {"trips": ["shape_id"], "stops": ["stop_lat", "stop_lon"]}


def _c1_table(name):
    keys, nn, _ = _QT[name]
    src = f"t_{name}"
    parts = [f"SELECT '{name}' AS \"table\", 'row_count' AS \"check\", NULL::VARCHAR AS \"column\", "
             f"count(*) AS violations, {_NS} AS sample FROM {src}"]
    for c in nn:
        parts.append(f"SELECT '{name}', 'null_check', '{c}', count_if({c} IS NULL OR CAST({c} AS VARCHAR) = ''), "
                     f"{_NS} FROM {src}")
    for c in _C1_TYPED.get(name, []):
        parts.append(f"SELECT '{name}', 'type_match', '{c}', "
                     f"count_if(TRY_CAST(trim(CAST({c} AS VARCHAR)) AS INTEGER) IS NULL), {_NS} FROM {src}")
    for c in _C1_MISSING.get(name, []):
        parts.append(f"SELECT '{name}', 'required_columns', '{c}', CAST(1 AS BIGINT), {_EMPTY}")
    sample = (f"(SELECT coalesce(list_sort(list(concat_ws('|', " +
              ", ".join(f"coalesce(k{i}, 'NULL')" for i in range(len(keys))) +
              f"))), {_EMPTY}) FROM (SELECT * FROM (SELECT {', '.join(f'CAST({k} AS VARCHAR) AS k{i}' for i, k in enumerate(keys))} "
              f"FROM {src} GROUP BY {', '.join(keys)} HAVING count(*) > 1) ORDER BY "
              f"{', '.join(f'k{i}' for i in range(len(keys)))} LIMIT 5))")
    parts.append(f"SELECT '{name}', 'unique_check', '{','.join(keys)}', "
                 f"(SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {src})), "
                 f"{sample}")
    return "\nUNION ALL\n".join(parts)


SQL["c1_load_static"] = with_bind_q(
    ", t_routes AS (SELECT * FROM routes), t_trips AS (SELECT * FROM trips), t_stops AS (SELECT * FROM stops), "
    "t_calendar AS (SELECT * FROM calendar), t_stop_times AS (SELECT * FROM stop_times)\n"
    + "\nUNION ALL\n".join(_c1_table(n) for n in _QT) + "\nUNION ALL\n"
    + _fk("trips", "route_id", "routes", "route_id"))

# ------------------------------------------------------ schedule, streams
SQL["t4_replayed_batches"] = SQL["c2_trip_delays_stream"]
SQL["s5_table_overwrite"] = with_bind("SELECT * FROM trips")
SQL["j2_schedule_lookup"] = with_bind("SELECT trip_id, stop_id, stop_sequence, actual_epoch, arrival_time FROM joined")
_PARTS = "CAST(split_part(arrival_time, ':', {}) AS INTEGER)"
_HMS = [_PARTS.format(i) for i in (1, 2, 3)]
SQL["f1_clock_parse"] = with_bind(
    f"SELECT trip_id, stop_sequence, arrival_time, {_HMS[0]} AS h, {_HMS[1]} AS m, {_HMS[2]} AS s FROM stop_times_raw")
SQL["f2_duration"] = with_bind(
    f"SELECT trip_id, stop_sequence, {_HMS[0]} * 3600 + {_HMS[1]} * 60 + {_HMS[2]} AS seconds FROM stop_times_raw")
_K = "SELECT trip_id, stop_id, stop_sequence"
_WALL = f"timezone('{TZ}', to_timestamp(actual_epoch))"
SQL["f3_epoch_to_ts"] = with_bind(f"{_K}, actual_epoch, CAST(epoch({_WALL}) AS BIGINT) AS wall_seconds FROM joined")
SQL["f4_local_date"] = with_bind(f"{_K}, CAST(CAST({_WALL} AS DATE) AS VARCHAR) AS day FROM joined")
SQL["f5_service_date"] = with_bind(
    f"{_K}, CAST(CAST({_WALL} AS DATE) - CAST(CASE WHEN h >= 24 THEN 1 ELSE 0 END AS INTEGER) AS VARCHAR) AS day FROM joined")
SQL["f6_schedule_instant"] = with_bind(f"{_K}, scheduled_epoch AS scheduled FROM scored")
SQL["f7_delay_seconds"] = with_bind(f"{_K}, delay_seconds AS delay FROM trip_delays")
SQL["f10_skip_bad_row"] = with_bind(f"""{_K},
  CASE stop_sequence % 7 WHEN 1 THEN 'unparseable clock time' WHEN 2 THEN 'unparseable clock time' WHEN 3 THEN 'missing clock time'
       WHEN 4 THEN 'unparseable clock time' WHEN 5 THEN 'actual time out of range' END AS reject_reason,
  CASE WHEN stop_sequence % 7 IN (0, 6) THEN delay_seconds END AS delay_seconds FROM trip_delays""")
SQL["k5_bad_start_date"] = with_bind(f"""{_K}, CASE WHEN trip_id % 4 <> 0 THEN 'no service day' END AS reject_reason,
  CASE WHEN trip_id % 4 = 0 THEN CAST(actual_epoch - CAST(epoch(timezone('{TZ}', TIMESTAMP '1995-03-01 00:00:00'
    + to_seconds(CAST(h AS BIGINT) * 3600 + m * 60 + s))) AS BIGINT) AS INTEGER) END AS delay_seconds FROM joined""")
SQL["t5_rejects"] = _FEED + """
SELECT feed_key, CASE WHEN bad THEN 1 ELSE 0 END::BIGINT AS rejects, CASE WHEN bad THEN 0 ELSE n END::BIGINT AS entities FROM (
  SELECT feed_key, CAST(split_part(feed_key, '/', 2) AS BIGINT) % 5 < 2 AS bad, count(*) AS n FROM ent GROUP BY feed_key)"""
SQL["r4_backfill"] = with_bind(f"""
, perday AS (
  SELECT trip_id, stop_id, stop_sequence, strftime(ord[1], '%Y-%m-%d') AS feed_date,
         max_by(struct_pack(actual_epoch := actual_epoch, time_source := time_source), ord) AS v
  FROM timed GROUP BY ALL),
x AS (
  SELECT p.trip_id, p.stop_id, p.stop_sequence, p.feed_date, p.v.actual_epoch AS actual_epoch, p.v.time_source AS time_source,
         {_HMS[0]} AS h, {_HMS[1]} AS m, {_HMS[2]} AS s
  FROM perday p JOIN stop_times st USING (trip_id, stop_id, stop_sequence)),
y AS (
  SELECT *, CAST(epoch(timezone('{TZ}', CAST(CAST({_WALL} AS DATE) - CAST(CASE WHEN h >= 24 THEN 1 ELSE 0 END AS INTEGER)
                                               AS TIMESTAMP)
              + to_seconds(CAST(h AS BIGINT) * 3600 + m * 60 + s))) AS BIGINT) AS scheduled_epoch FROM x)
SELECT trip_id, stop_id, stop_sequence, feed_date, scheduled_epoch, actual_epoch,
       CAST(actual_epoch - scheduled_epoch AS INTEGER) AS delay_seconds, time_source FROM y""")

# -------------------------------------------------- data with violations
_BAD = """
, f_routes AS (SELECT * FROM routes WHERE route_id % 10 <> 3), f_stops AS (SELECT * FROM stops WHERE stop_id % 10 <> 7),
f_trips AS (SELECT route_id, CASE WHEN trip_id % 11 = 0 THEN '' ELSE service_id END AS service_id, trip_id, trip_headsign,
                   CASE WHEN trip_id % 13 <> 0 THEN direction_id END AS direction_id FROM trips)
"""


def _fk_of(child, ccol, parent, pcol, csrc, psrc):
    miss = (f"(SELECT DISTINCT {ccol} FROM {csrc} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM {psrc} p WHERE p.{pcol} = c.{ccol}))")
    return (f"SELECT '{child}' AS \"table\", 'foreign_key' AS \"check\", '{ccol}->{parent}.{pcol}' AS \"column\", "
            f"(SELECT count(*) FROM {miss}) AS violations, {_sample(miss, [ccol])} AS sample")


SQL["q4_null_violations"] = with_bind_q(_BAD + _table_report("trips", "f_trips"))
SQL["q5_absent_key"] = with_bind_q(f"""SELECT 'trips' AS "table", 'row_count' AS "check", NULL::VARCHAR AS "column",
count(*) AS violations, {_NS} AS sample FROM trips UNION ALL
SELECT 'trips', 'skipped', 'trip_id,service_id', NULL, {_NS}""")
SQL["q8_integrity_violations"] = with_bind_q(_BAD + _fk_of("trips", "route_id", "routes", "route_id", "f_trips", "f_routes"))
SQL["r5_link_violations"] = with_bind_q(_BAD + "\nUNION ALL\n".join([
    _fk_of("trips", "route_id", "routes", "route_id", "f_trips", "f_routes"),
    _fk_of("trips", "service_id", "calendar", "service_id", "f_trips", "calendar"),
    _fk_of("stop_times", "trip_id", "trips", "trip_id", "stop_times", "f_trips"),
    _fk_of("stop_times", "stop_id", "stops", "stop_id", "stop_times", "f_stops")]))
SQL["j1_missing_routes"] = with_bind_q(_BAD + """
SELECT DISTINCT route_id FROM f_trips t WHERE NOT EXISTS (SELECT 1 FROM f_routes r WHERE r.route_id = t.route_id)""")
SQL["p2_empty_values"] = with_bind_q(_BAD + """
SELECT count_if(service_id IS NULL OR service_id = '') AS empty_service_id, count_if(direction_id IS NULL) AS empty_direction_id
FROM f_trips""")
SQL["j4_unmatched_routes"] = with_bind_q(_BAD + """
SELECT t.route_id, t.trip_id, r.route_short_name FROM f_trips t LEFT JOIN f_routes r ON t.route_id = r.route_id""")
SQL["o3_sample_5"] = with_bind_q("SELECT " + _sample(
    "(SELECT trip_id, stop_sequence FROM stop_times GROUP BY ALL HAVING count(*) > 1)", ["trip_id", "stop_sequence"]) + " AS sample")

# ------------------------------------------- relationships and full feeds
SQL["k1_resets"] = with_bind("""
, u AS (
  SELECT trip_id, stop_id, stop_sequence,
         CASE WHEN stop_sequence % 4 <> 3 AND stop_sequence % 5 <> 2 THEN delay_seconds END AS v FROM trip_delays),
p AS (
  SELECT st.trip_id, st.stop_id, st.stop_sequence, u.v AS own_delay,
         last(CASE WHEN u.trip_id IS NOT NULL THEN struct_pack(v := u.v) END IGNORE NULLS) OVER (
           PARTITION BY st.trip_id ORDER BY st.stop_sequence, st.stop_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e
  FROM stop_times st LEFT JOIN u ON u.trip_id = st.trip_id AND u.stop_id = st.stop_id AND u.stop_sequence = st.stop_sequence)
SELECT trip_id, stop_id, stop_sequence, own_delay, e.v AS predicted_delay,
       CASE WHEN own_delay IS NOT NULL THEN 'own' WHEN e.v IS NOT NULL THEN 'propagated' END AS delay_source FROM p""")
SQL["k1_resets_by_block"] = SQL["k1_resets"]
SQL["k3_delay_only_event"] = with_bind(f"""{_K}, CASE WHEN stop_sequence % 3 = 0 THEN actual_epoch
  WHEN stop_sequence % 3 = 1 THEN scheduled_epoch + stop_id % 600 END AS resolved FROM trip_delays""")
SQL["k4_active_only"] = with_bind(f"""{_K}, arrival_epoch, departure_epoch FROM stop_updates
WHERE stop_sequence % 4 <> 0 AND trip_id % 5 NOT IN (0, 1) AND stop_id % 7 <> 0""")
_DEL = "CAST(entity_id AS BIGINT) % 3 = (feed_ts // 86400) % 3"
SQL["k6_deleted"] = _FEED + f"""
SELECT entity_id, f.feed_key AS feed_key, f.n_stops AS n_stops FROM (
  SELECT entity_id, max_by(struct_pack(feed_key := feed_key, n_stops := n_stops, d := {_DEL}), row(feed_ts, entity_pos, feed_key)) AS f
  FROM ent GROUP BY entity_id) WHERE NOT f.d"""
SQL["k6_full_dataset"] = _FEED + f"""
, one AS (SELECT entity_id, feed_ts, sum(n_stops)::BIGINT AS n_stops, bool_or({_DEL}) AS d FROM ent GROUP BY entity_id, feed_ts),
s AS (SELECT max(feed_ts) AS start FROM one WHERE (feed_ts // 86400) % 100 = 0)
SELECT entity_id, f.n_stops AS n_stops FROM (
  SELECT entity_id, max_by(struct_pack(n_stops := n_stops, d := d), feed_ts) AS f FROM one, s
  WHERE start IS NULL OR feed_ts >= start GROUP BY entity_id) WHERE NOT f.d"""

# ------------------------------------------------- views that move (streams)
_HIST = SQL["r2_delay_now"][: SQL["r2_delay_now"].index("agg AS (")]
assert "u.*" in _HIST
SQL["r2_delay_now_stream"] = _HIST.replace("SELECT s.trip_id, s.actual_epoch, t.route_id,",
    "SELECT s.trip_id, s.actual_epoch, t.route_id, (epoch(s.ord[1])::BIGINT // 86400) % 7 = 3 AS late,") + """
wm AS (SELECT max(actual_epoch) FILTER (NOT late) - 172800 AS before, max(actual_epoch) - 172800 AS after FROM hist)
SELECT route_id, (actual_epoch // 86400) * 86400 AS window_start, count(*) AS n, round(avg(delay_seconds), 3) AS avg_delay
FROM hist, wm WHERE (NOT late OR (actual_epoch // 86400 + 1) * 86400 > before)
  AND (actual_epoch // 86400 + 1) * 86400 <= greatest(before, after)
GROUP BY ALL"""
SQL["r2_delay_changes_stream"] = f"""
WITH u AS (
  SELECT l_suppkey AS trip_id, l_partkey % 20 AS stop_id, 1 AS stop_sequence, (epoch(l_shipdate)::BIGINT // 86400) * 86400 AS feed_ts,
         epoch(l_shipdate)::BIGINT + (l_orderkey * 37) % 86400 + CASE WHEN l_returnflag = 'A' THEN 30 ELSE 0 END AS actual_epoch,
         4 + l_suppkey % 20 AS h, l_partkey % 20 * 3 AS m FROM lineitem),
d AS (
  SELECT *, CAST(actual_epoch - CAST(epoch(timezone('{TZ}',
              CAST(CAST(timezone('{TZ}', to_timestamp(actual_epoch)) AS DATE) - CAST(CASE WHEN h >= 24 THEN 1 ELSE 0 END AS INTEGER)
                   AS TIMESTAMP) + to_seconds(CAST(h AS BIGINT) * 3600 + m * 60))) AS BIGINT) AS INTEGER) AS delay_seconds FROM u),
f AS (
  SELECT trip_id, stop_id, stop_sequence, feed_ts, max_by(delay_seconds, actual_epoch) AS delay_seconds FROM d
  GROUP BY trip_id, stop_id, stop_sequence, feed_ts)
SELECT *, lag(feed_ts) OVER w AS previous_feed_ts, CAST(delay_seconds - lag(delay_seconds) OVER w AS INTEGER) AS change
FROM f WINDOW w AS (PARTITION BY trip_id, stop_id, stop_sequence ORDER BY feed_ts)"""
SQL["t1_latest_of_day_stream"] = SQL["r4_backfill"] + """
WHERE feed_date < (SELECT strftime(max(l_shipdate), '%Y-%m-%d') FROM lineitem)"""
SQL["k6_stream"] = SQL["k6_full_dataset"]
SQL["k1_stream"] = SQL["k1_resets"]
_SEEN = """
WITH p AS (SELECT DISTINCT user_id AS v, epoch(date_trunc('second', ts))::BIGINT AS t FROM events),
seen AS (
  SELECT v::VARCHAR AS vehicle_id, t AS vehicle_ts, s_name AS vehicle_label,
         CASE WHEN t % 4 <> 0 THEN 'T' || (t % 50)::VARCHAR END AS trip_id, (t % 720) / 4.0 - 90 AS latitude,
         ((t * 7 + v) % 1440) / 4.0 - 180 AS longitude, CASE WHEN t % 5 <> 0 THEN (t % 1440) / 4.0 END AS bearing,
         CASE WHEN t % 7 <> 0 THEN (t % 120) / 4.0 END AS speed, t % 40 AS current_stop_sequence,
         CASE WHEN t % 2 = 0 THEN 'STOPPED_AT' END AS current_status, 'S' || (v % 9)::VARCHAR AS stop_id
  FROM p LEFT JOIN supplier ON v = s_suppkey)
"""
SQL["r3_positions_stream"] = _SEEN + """SELECT vehicle_id, vehicle_ts, vehicle_label, trip_id, latitude::DOUBLE AS latitude,
  longitude::DOUBLE AS longitude, bearing::DOUBLE AS bearing, speed::DOUBLE AS speed, current_stop_sequence, current_status, stop_id
FROM seen"""
SQL["r3_latest_vehicles"] = _SEEN + """SELECT vehicle_id, max(vehicle_ts) AS vehicle_ts, max_by(latitude, vehicle_ts)::DOUBLE AS latitude,
  max_by({'s': speed}, vehicle_ts).s::DOUBLE AS speed, max_by(stop_id, vehicle_ts) AS stop_id FROM seen GROUP BY vehicle_id"""
SQL["j2_stream"] = SQL["j2_schedule_lookup"]
SQL["r1_percentiles"] = SQL["r1_delay_hotspots"][: SQL["r1_delay_hotspots"].index("SELECT route_id, stop_id, CAST(hour")] + """
SELECT 'route' AS level, route_id::VARCHAR AS of, count(*) AS n, true AS p50_near, true AS p90_near FROM e GROUP BY route_id
UNION ALL SELECT 'hour', hour::VARCHAR, count(*), true, true FROM e GROUP BY hour
UNION ALL SELECT 'all', '', count(*), true, true FROM e"""

# ------------------------------------------------------ feeds of a network
_KEY = "strftime(l.l_shipdate, '%Y%m%d') || '/' || CAST(l.l_orderkey // 64 AS VARCHAR) AS feed_key"
for _wide, _narrow in (("t5_decode_network", "t5_decode_feed"), ("p5_explode_network", "p5_explode_entities"),
                       ("s9_network_publish", "s9_feed_publish")):
    assert _KEY in SQL[_narrow]
    SQL[_wide] = SQL[_narrow].replace(_KEY, "strftime(l.l_shipdate, '%Y%m%d') AS feed_key")
SQL["s9_publish_checked"] = """
WITH d AS (SELECT CAST(epoch(date_trunc('day', l_shipdate)) AS BIGINT) AS feed_ts, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1)
SELECT feed_ts, CASE WHEN feed_ts // 86400 % 5 < 2 THEN 0 ELSE n END::BIGINT AS entities, feed_ts // 86400 % 5 >= 2 AS sent FROM d"""
SQL["q6_counts_while_staging"] = with_bind_q(f"SELECT * FROM ({_REPORT})")
