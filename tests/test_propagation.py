from adherence.operators.analytics import propagate_delays
from adherence.plans import bindings as B
from adherence.plans import catalog as C
from conftest import SF_SMALL


def test_blocks_do_not_change_the_result(spark):
    st, f = B.stop_times(spark, SF_SMALL), C.facts(spark, SF_SMALL)
    a = sorted(tuple(r) for r in propagate_delays(st, f).collect())
    b = sorted(tuple(r) for r in propagate_delays(st, f, block_size=2).collect())
    assert a == b


def test_no_data_resets_and_trip_fallback(spark):
    st = spark.createDataFrame([("T", f"S{i}", i) for i in range(1, 9)], "trip_id string, stop_id string, stop_sequence int")
    facts = spark.createDataFrame([("T", "S2", 2, 60, None), ("T", "S4", 4, None, "NO_DATA"), ("T", "S6", 6, 90, None)],
                                  "trip_id string, stop_id string, stop_sequence int, delay_seconds int, rel string")
    td = spark.createDataFrame([("T", 15)], "trip_id string, trip_delay int")
    for bs in (None, 1, 3, 100):
        got = {r.stop_sequence: (r.predicted_delay, r.delay_source) for r in
               propagate_delays(st, facts, relationship="rel", trip_delay=td, block_size=bs).collect()}
        assert got == {1: (15, "trip"), 2: (60, "own"), 3: (60, "propagated"), 4: (None, None), 5: (None, None),
                       6: (90, "own"), 7: (90, "propagated"), 8: (90, "propagated")}, bs


def test_an_update_without_a_delay_resets(spark):
    st = spark.createDataFrame([("T", f"S{i}", i) for i in range(1, 6)], "trip_id string, stop_id string, stop_sequence int")
    facts = spark.createDataFrame([("T", "S2", 2, 60), ("T", "S4", 4, None)],
                                  "trip_id string, stop_id string, stop_sequence int, delay_seconds int")
    for bs in (None, 2):
        got = {r.stop_sequence: r.predicted_delay for r in propagate_delays(st, facts, block_size=bs).collect()}
        assert got == {1: None, 2: 60, 3: 60, 4: None, 5: None}
