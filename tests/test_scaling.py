"""What grows with the input: rows that are shuffled, work that is done twice, bytes made one by one."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from adherence.llm import alignment, lm
from adherence.operators import analytics as AN
from adherence.plans import catalog as C
from adherence.streaming import feed as FD


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feeds_are_encoded_without_message_objects(monkeypatch):
    """every stop update, trip and feed was a message object."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    rows = [(None, None, None, 5, "20250701", -3, None, None, -1, None),
            ("a", 300, 7, None, None, None, -12, 0, 0, 1 << 40), ("a", 300, 7, 9, "é", 1, 12, 200, None, 5),
            ("a", 300, 8, 1 << 50, "", 0, 12, 3, None, None), ("b", 1, 8, 1, None, (1 << 31) - 1, 0, 1, 2, 3)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=list(FD.ENCODE_INPUT))
               for part in (rows[:2], rows[2:])]

    def stop(r):
        return {"stop_sequence": r[7], "stop_id": None if r[6] is None else str(r[6]),
                "arrival": None if r[8] is None else {"time": r[8]}, "departure": None if r[9] is None else {"time": r[9]}}

    def entity(*of):
        r = of[0]
        text = lambda v: None if v is None else str(v)
        return {"id": str(r[2]), "trip_update": {"trip": {"trip_id": text(r[2]), "route_id": text(r[3]), "start_date": r[4]},
                                                 "delay": r[5], "stop_time_update": [stop(x) for x in of]}}

    def message(ts, *entities):
        return FD.encode_message({"header": {"gtfs_realtime_version": "2.0", "timestamp": ts}, "entity": list(entities)})

    want = [(None, None, message(None, entity(rows[0])), 1, 1), ("a", 300, message(300, entity(*rows[1:3]), entity(rows[3])), 2, 3),
            ("b", 1, message(1, entity(rows[4])), 1, 1)]
    monkeypatch.setattr(FD, "message_class", None)
    assert [f for part in FD._feed_chunks(iter(batches)) for f in part] == want


def test_texts_are_aligned_once(spark):
    """op11: the texts were shuffled, encoded and aligned a second time."""
    docs = spark.createDataFrame([(1, "one two two"), (2, None), (None, "two")], "doc_id long, text string")
    out = alignment.align(docs, with_groups=False)
    assert "FlatMapGroupsInArrow" not in plan_of(out) and "body" not in plan_of(out) and out.count() == 3


def test_training_tasks_follow_the_tokens(spark, monkeypatch):
    """op9: each of many small files sent a change of the whole weight table."""
    docs = spark.createDataFrame([("a b c",)] * 40, "text string").repartition(40)
    seen, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, *a, **k: seen.append(df.rdd.getNumPartitions()) or real(df, *a, **k))
    model = lm.Model([], np.ones(lm.CLASSES), np.ones(lm.CLASSES))
    lm.train_round(docs, model, 3 * lm.TASK_TOKENS)
    assert seen == [3] and np.abs(model.weights).max() > 0


def test_served_facts_are_computed_once(spark, monkeypatch):
    """dealing by ranges read the computed facts once for the bounds and once for the rows."""
    given = []
    monkeypatch.setattr(C, "publish_facts", lambda s, facts, path: given.append(plan_of(facts)) or facts.limit(0).write.parquet(path))
    monkeypatch.setattr(C, "read_table", lambda s, path: s.read.parquet(path))
    spark.sparkContext.__dict__.pop("_served_facts", None)
    try:
        C.served_facts(spark, "/root/testdata/sf0.001")
    finally:
        spark.sparkContext.__dict__.pop("_served_facts", None)
    assert "Join" not in given[0] and "Scan parquet" in given[0]


def test_a_cube_shuffles_a_fact_twice(spark):
    """a fact was shuffled once for each grouping set."""
    rows = spark.range(600).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("route_id"), (F.col("id") % 11).alias("stop_id"),
        (F.col("id") * 5003).alias("scheduled_epoch"), (F.col("id") % 13 - 5).cast("int").alias("delay_seconds"))
    dims = ["route_id", "stop_id", "hour", "weekday"]
    for sets in (AN.CUBE_SETS, AN.HOTSPOT_SETS, (("hour",), ("hour",))):
        out = AN.hotspots(rows, sets)
        want = AN.with_local_parts(rows).groupingSets([[F.col(c) for c in s] for s in sets], *dims) \
                 .agg(F.grouping_id(*dims).cast("int").alias("level"), *AN.delay_stats())
        assert out.schema.simpleString() == want.schema.simpleString() and "Expand" not in plan_of(out)
        assert plan_of(out).count("Exchange hashpartitioning") <= 3
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
