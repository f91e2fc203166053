"""Serving from the published fact table: what a lookup reads."""

import pytest
from pyspark.sql import functions as F

from adherence.operators import serving as S
from adherence.plans import catalog as C
from adherence.sources import tables as T
from adherence.streaming.jobs import publish_facts
from conftest import SF_SMALL


def rows_read(df) -> int:
    """Rows that left the scans of a frame that has been collected."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length()))


def test_a_lookup_skips_files_and_pushes_the_trip(spark, tmp):
    facts = C.facts(spark, SF_SMALL)
    publish_facts(spark, facts, tmp, files=8)
    served = T.read_table(spark, tmp)
    trip = facts.agg(F.max("trip_id")).first()[0]
    found = S.key_filter(served, "trip_id", trip)
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(map(tuple, facts.filter(F.col("trip_id") == trip).collect())) and got
    assert rows_read(found) <= facts.count() / 4
    plan = found._jdf.queryExecution().toString()
    assert f"EqualTo(trip_id,{trip})" in plan
    absent = S.key_filter(served, "trip_id", -1)
    assert absent.collect() == [] and rows_read(absent) == 0


def test_a_version_replaces_the_one_before(spark, tmp):
    with pytest.raises(FileNotFoundError):
        T.read_table(spark, tmp)
    schema = spark.range(0).schema
    assert T.read_table(spark, tmp, schema).count() == 0
    assert [T.publish(spark, spark.range(n), tmp) for n in (3, 5)] == [1, 2]
    assert T.read_table(spark, tmp).count() == 5 and T.current_version(spark, tmp) == 2


def test_serving_publishes_once_and_again_when_the_input_changes(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "_served_facts", {}, raising=False)
    made = []
    real = C.publish_facts
    monkeypatch.setattr(C, "publish_facts", lambda *a, **k: made.append(a) or real(*a, **k))
    trip = C.selected_trip_value(spark, SF_SMALL)
    late = C.c6_late_stops(spark, SF_SMALL).collect()
    assert C.p14_series_project(spark, SF_SMALL).count() == len(late)
    assert C.p12_key_filter(spark, SF_SMALL).filter(F.col("trip_id") != trip).count() == 0
    assert C.c5_trip_options(spark, SF_SMALL).first()["trip_id"] == trip and len(made) == 1
    monkeypatch.setattr(C, "state_of", lambda *a: ("changed",))
    assert C.c7_trip_info(spark, SF_SMALL).count() == 1 and len(made) == 2
