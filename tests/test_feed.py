from pyspark.sql import functions as F

from adherence.operators.analytics import resolve_event_time
from adherence.streaming import feed as FD
from adherence.streaming import flatten as FL


def feed(entities, ts=100):
    return FD.encode_message({"header": {"gtfs_realtime_version": "2.0", "timestamp": ts}, "entity": entities})


def trip(eid, trip_id, stops, delay=None, rel=None, deleted=None):
    tu = {"trip": {"trip_id": trip_id, "route_id": "R", "schedule_relationship": rel}, "stop_time_update": stops}
    if delay is not None:
        tu["delay"] = delay
    return {"id": eid, "is_deleted": deleted, "trip_update": tu}


FEEDS = [
    feed([{"id": "v", "vehicle": {"vehicle": {"id": "bus1"}, "position": {"latitude": 1.5, "longitude": 2.5}}},
          trip("a", "T1", [{"stop_sequence": 1, "stop_id": "S1", "arrival": {"time": 0}},
                           {"stop_sequence": 2, "stop_id": "S2", "departure": {"time": 50}},
                           {"stop_sequence": 3, "stop_id": "S3", "arrival": {"delay": 30}},
                           {"stop_id": "S4", "arrival": {"time": 70}},
                           {"stop_sequence": 5, "arrival": {"time": 80}, "schedule_relationship": "SKIPPED"}],
               delay=12),
          trip("b", "T2", [{"stop_sequence": 1, "stop_id": "S1", "arrival": {"time": 5}}], rel="CANCELED")]),
    feed([]),
    b"\x0a\x05garbage-not-a-feed",
]


def records(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset long, value binary")


def test_decode_flatten_presence_and_defaults(spark):
    good, bad = FD.split_rejects(FD.decode(records(spark, FEEDS), keep=["offset"]))
    assert bad.count() == 1 and bad.first().offset == 2
    assert good.count() == 3                                  # two trips + one vehicle entity
    s = {r.stop_pos: r for r in FL.stop_updates(good).collect() if r.trip_id == "T1"}
    assert s[0].arrival_epoch == 0                            # time 0 is present
    assert s[1].arrival_epoch is None and s[1].departure_epoch == 50
    assert s[2].arrival_epoch is None and s[2].arrival_delay == 30   # only a delay
    assert s[3].stop_sequence == 0                            # absent -> proto default
    assert s[4].stop_id == "" and s[4].stop_relationship == "SKIPPED"
    v = FL.vehicle_positions(good).first()
    assert (v.vehicle_id, v.latitude) == ("bus1", 1.5)


def test_active_only_and_first_trip(spark):
    good, _ = FD.split_rejects(FD.decode(records(spark, FEEDS), keep=["offset"]))
    kept = FL.active_only(FL.stop_updates(good)).select("trip_id", "stop_sequence").collect()
    assert sorted(tuple(r) for r in kept) == [("T1", 0), ("T1", 1), ("T1", 2), ("T1", 3)]
    feeds = FD.decode(records(spark, FEEDS), keep=["offset"], level="feed")
    got = {r.offset: (r.trip_id, r.route_id, r.delay) for r in FL.first_trip(feeds).collect()}
    assert got == {0: ("T1", "R", 12), 1: (None, None, 0), 2: (None, None, 0)}
    udf = FL.first_trip_udf()
    got2 = {r.offset: tuple(r.p) for r in records(spark, FEEDS).select("offset", udf("value").alias("p")).collect()}
    assert got2 == got


def test_bare_trip_update_and_split(spark):
    tu = FD.encode_message({"trip": {"trip_id": "T9", "start_date": "20250701", "route_id": "R"}}, "TripUpdate")
    d = FD.decode(records(spark, [tu, b"\xff\xff"]), root="TripUpdate", keep=["offset"])
    rows = FL.trip_update_rows(d, with_time=False).collect()
    assert [tuple(r) for r in rows] == [("T9", "20250701", "R")]
    split = FD.split_trip_updates(records(spark, FEEDS), keep=["offset"])
    assert split.count() == 2


def test_delay_only_event(spark):
    df = spark.createDataFrame([(None, 30, 1000), (1100, 30, 1000)], "t long, d int, scheduled_epoch long")
    assert [r.actual_epoch for r in resolve_event_time(df, "t", "d").collect()] == [1030, 1100]


def test_encoder_keeps_one_entity_per_trip(spark):
    rows = spark.createDataFrame(
        [("k", 10, 7, "R", "20250701", None, 100 + i, i, 1000 + i, None) for i in range(1200)],
        "feed_key string, feed_ts long, trip_id long, route_id string, start_date string, trip_delay int, "
        "stop_id long, stop_sequence int, arrival_time long, departure_time long")
    enc = FD.encode_feeds(rows, partitions=2)
    r = enc.first()
    assert (r.n_entities, r.n_stops) == (1, 1200)
    good, _ = FD.split_rejects(FD.decode(enc.select("value")))
    assert [(x.entity.id, len(x.entity.trip_update.stop_time_update)) for x in good.collect()] == [("7", 1200)]


def _bytes(*fields):
    """A message written by hand from its wire format: (number, value) with an
    int as varint and bytes as a length-delimited field."""
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])
    out = b""
    for number, v in fields:
        out += varint(number << 3 | (0 if isinstance(v, int) else 2))
        out += varint(v) if isinstance(v, int) else varint(len(v)) + v
    return out


HEADER = _bytes((1, b"2.0"), (2, 1), (3, 1_700_000_000))
TRIP = _bytes((1, b"T1"), (3, b"20250701"), (4, 8), (5, b"R9"))
STOP = _bytes((1, 4), (2, _bytes((1, 60), (2, 1_700_000_100))), (4, b"S5"), (5, 2))
UPDATE = _bytes((1, TRIP), (2, STOP), (5, 30))
GOLDEN = _bytes((1, HEADER), (2, _bytes((1, b"e1"), (2, 0), (3, UPDATE))), (2, _bytes((1, b"e2"), (2, 1))))


def test_hand_written_bytes(spark):
    df = spark.createDataFrame([(bytearray(GOLDEN),)], "value binary")
    rows = FD.decode(df).collect()
    assert [r.decode_error for r in rows] == [None, None]
    h, u = rows[0].header, rows[0].entity.trip_update
    assert (h.gtfs_realtime_version, h.incrementality, h.timestamp) == ("2.0", "DIFFERENTIAL", 1_700_000_000)
    assert (u.trip.trip_id, u.trip.start_date, u.trip.schedule_relationship, u.trip.route_id, u.delay) == (
        "T1", "20250701", "NEW", "R9", 30)
    s = u.stop_time_update[0]
    assert (s.stop_sequence, s.arrival.delay, s.arrival.time, s.stop_id, s.schedule_relationship, s.departure) == (
        4, 60, 1_700_000_100, "S5", "NO_DATA", None)
    assert (rows[1].entity.id, rows[1].entity.is_deleted, rows[1].entity.trip_update) == ("e2", True, None)


def test_every_bad_value_is_one_reject(spark):
    late = _bytes((1, _bytes((1, b"2.0"), (3, 1 << 63))), (2, _bytes((1, b"e"), (3, UPDATE))))
    text = _bytes((1, HEADER), (2, _bytes((1, b"ok"), (3, UPDATE))), (2, _bytes((1, b"e"), (3, _bytes((1, _bytes((1, b"\xff\xfe"))))))))
    df = spark.createDataFrame([(1, bytearray(late)), (2, bytearray(text)), (3, None), (4, bytearray(b"\x0a\xff")),
                                (5, bytearray(GOLDEN))], "n int, value binary")
    good, bad = FD.split_rejects(FD.decode(df))
    assert sorted(r.n for r in bad.collect()) == [1, 2, 3, 4]
    assert sorted(r.n for r in good.collect()) == [5, 5]
    assert all(r.decode_error for r in bad.collect())


def test_absent_ids_are_empty_and_no_update_is_null(spark):
    bare = _bytes((1, HEADER), (2, _bytes((1, b"e"), (3, _bytes((1, b""))))))
    none = _bytes((1, HEADER), (2, _bytes((1, b"e"))))
    df = spark.createDataFrame([(1, bytearray(bare)), (2, bytearray(none)), (3, bytearray(b"x"))], "n int, value binary")
    want = [(1, "", "", 0), (2, None, None, 0), (3, None, None, 0)]
    assert sorted(map(tuple, FL.first_trip(FD.decode(df, keep=["n"], level="feed")).collect())) == want
    udf = df.select("n", FL.first_trip_udf()("value").alias("p")).select("n", "p.*")
    assert sorted(map(tuple, udf.collect())) == want


def test_latest_vehicle(spark):
    def feed(ts, vid, lat):
        pos = {"latitude": lat, "longitude": 2.0}
        return bytearray(FD.encode_message({"header": {"gtfs_realtime_version": "2.0", "timestamp": ts}, "entity": [
            {"id": "v", "vehicle": {"vehicle": {"id": vid}, "position": pos}}]}))
    df = spark.createDataFrame([(feed(5, "a", 1.0),), (feed(9, "a", 3.0),), (feed(7, "a", 2.0),), (feed(1, "b", 4.0),)], "value binary")
    got = FL.latest_vehicles(FL.vehicle_positions(FD.decode(df))).collect()
    assert sorted((r.vehicle_id, r.latitude) for r in got) == [("a", 3.0), ("b", 4.0)]


def test_publishing_given_bytes_rejects_the_bad_ones(spark, tmp):
    df = records(spark, [*FEEDS, None])
    bad = FD.publish_checked(df, lambda good: good.write.parquet(tmp))
    assert sorted(r.offset for r in bad.collect()) == [2, 3] and bad.filter("decode_error IS NULL").count() == 0
    sent = spark.read.parquet(tmp)
    assert sent.columns == df.columns and [bytes(r.value) for r in sent.orderBy("offset").collect()] == [bytes(f) for f in FEEDS[:2]]
    sizes = {r.offset: r.n_entities for r in FD.checked(df).collect()}
    assert sizes == {0: 3, 1: 0, 2: None, 3: None}


def test_start_positions(spark, tmp):
    import pytest
    from adherence.sources.stream import file_stream, kafka_options, land_records
    base = {"kafka.bootstrap.servers": "h:1", "subscribe": "t"}
    assert kafka_options("h:1", "t") == base | {"startingOffsets": "latest"}
    assert kafka_options("h:1", "t", "earliest", "g") == base | {"startingOffsets": "earliest", "kafka.group.id": "g"}
    assert kafka_options("h:1", "t", {"t": {"0": 5}}, options={"maxOffsetsPerTrigger": 9}) == base | {
        "startingOffsets": '{"t": {"0": 5}}', "maxOffsetsPerTrigger": "9"}
    assert kafka_options("h:1", "t", 1000) == base | {"startingTimestamp": "1000"}
    for wrong in ("newest", None, 1.5, True):
        with pytest.raises(ValueError):
            kafka_options("h:1", "t", wrong)
    land_records(spark.createDataFrame([(bytearray(b"a"), 10), (bytearray(b"b"), 20)], "value binary, feed_ts long"), f"{tmp}/in", "t",
                 ts_col="feed_ts")
    for name, starting, want in (("all", "earliest", [b"a", b"b"]), ("late", 15_000, [b"b"])):
        q = (file_stream(spark, f"{tmp}/in", starting=starting).select("value").writeStream.format("parquet")
             .option("path", f"{tmp}/{name}").option("checkpointLocation", f"{tmp}/ck-{name}").trigger(availableNow=True).start())
        q.awaitTermination()
        assert sorted(bytes(r.value) for r in spark.read.parquet(f"{tmp}/{name}").collect()) == want
    with pytest.raises(ValueError):
        file_stream(spark, f"{tmp}/in", starting="latest")


def _chunks_of(values, level="entity"):
    import pyarrow as pa
    ddl = FD._decoded_ddl("FeedMessage", level, [("offset", "bigint")])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int64()), pa.array(values, pa.binary())],
                                       ["offset", "__value"])
    return list(FD._decoded_batch(batch, ["offset"], "FeedMessage", level, FD._arrow_schema(ddl)))


def test_nested_feeds_leave_in_bounded_batches(spark):
    """long feeds were gathered by thousands of feeds."""
    long = feed([trip(str(i), f"T{i}", [{"stop_sequence": 1}]) for i in range(3000)])
    out = _chunks_of([long] * 10, "feed")
    held = [sum(len(e) for e in b.column("entity").to_pylist()) for b in out]
    assert sum(held) == 30000 and max(held) < FD.CHUNK_ENTITIES + 3000
    rows = [b.num_rows for b in _chunks_of([long] * 10)]
    assert sum(rows) == 30000 and max(rows) <= FD.CHUNK_ENTITIES


def test_a_long_feed_with_a_bad_value_is_one_reject(spark):
    """A value that is none, behind more entities than leave at once, keeps
    all rows of its feed back; the feeds around it are whole."""
    n = FD.CHUNK_ENTITIES + 5
    good = feed([trip("a", "T1", [{"stop_sequence": 1, "stop_id": "S1", "schedule_relationship": "SKIPPED"}, {}], delay=0)])
    entities = [{"id": str(i)} for i in range(n)]
    bad = {"id": "x", "trip_update": {"trip": {"trip_id": "x"}, "timestamp": 1 << 63}}
    out = [r for b in _chunks_of([good, feed(entities + [bad]), good, None]) for r in b.to_pylist()]
    assert sorted((r["offset"], r["decode_error"] is None) for r in out) == [(0, True), (1, False), (2, True), (3, False)]
    update = out[0]["entity"]["trip_update"]
    assert update["delay"] == 0 and update["trip"]["route_id"] == "R" and update["vehicle"] is None
    assert [s["schedule_relationship"] for s in update["stop_time_update"]] == ["SKIPPED", None]
    assert [s["stop_id"] for s in update["stop_time_update"]] == ["S1", None]


def test_encoded_feeds_leave_in_bounded_lists():
    """the encoder gathered 256 feeds of any length."""
    import pyarrow as pa
    n = 40000
    cols = {c: pa.array([None] * n, pa.int64()) for c in FD.ENCODE_INPUT}
    cols |= {"feed_key": pa.array([str(i // 8000) for i in range(n)]), "trip_id": pa.array([f"{i:0>200}" for i in range(n)]),
             "start_date": pa.array([None] * n, pa.string())}
    parts = list(FD._feed_chunks(iter([pa.RecordBatch.from_pydict(cols)])))
    sizes = [sum(len(f[2]) for f in p) for p in parts]
    longest = max(len(f[2]) for p in parts for f in p)
    assert [f[3] for p in parts for f in p] == [8000] * 5 and max(sizes) < FD.CHUNK_BYTES + longest
