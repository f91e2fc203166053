import os

import pytest

from adherence import schemas as SC
from adherence.operators import quality as Q
from adherence.plans.pipelines import load_static
from adherence.sources.csv import MissingSourceError, load_csv


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def report_dict(df):
    return {(r["table"], r["check"], r["column"]): (r["violations"], r["sample"]) for r in df.collect()}


def test_header_binds_by_name_and_traps(spark, local_tmp):
    # header in another order, surplus column, missing optional, 'zz' in an int column,
    # quoted empty string, empty key
    p = write(local_tmp, "routes.txt",
              'route_type,extra,route_id,route_short_name\n3,x,R1,"A"\nzz,y,R2,""\n1,z,,C\n')
    t = load_csv(spark, p, SC.STATIC_SCHEMAS["routes"], "routes")
    rows = sorted(t.typed.select("route_id", "route_type", "route_short_name", "agency_id").collect(),
                  key=lambda r: str(r.route_id))
    assert [tuple(r) for r in rows] == [(None, 1, "C", None), ("R1", 3, "A", None), ("R2", None, "", None)]
    assert t.extra == ["extra"]
    rep = report_dict(Q.header_checks(spark, "routes", t.header, t.schema, SC.REQUIRED_COLUMNS["routes"])
                      .unionByName(Q.table_checks(t.raw, "routes", ["route_id"], t.schema)))
    assert rep[("routes", "extra_columns", "extra")][0] == 1
    assert rep[("routes", "type_match", "route_type")][0] == 1
    assert rep[("routes", "null_check", "route_id")][0] == 1
    assert rep[("routes", "row_count", None)][0] == 3
    assert rep[("routes", "unique_check", "route_id")] == (0, [])


def test_missing_required_duplicates_and_null_tuple(spark, local_tmp):
    p = write(local_tmp, "stop_times.txt",
              "trip_id,stop_sequence,arrival_time\nT1,1,08:00:00\nT1,1,08:01:00\nT1,,08:02:00\nT1,,08:03:00\nT2,1,x\n")
    t = load_csv(spark, p, SC.STATIC_SCHEMAS["stop_times"], "stop_times")
    rep = report_dict(Q.header_checks(spark, "stop_times", t.header, t.schema, SC.REQUIRED_COLUMNS["stop_times"])
                      .unionByName(Q.table_checks(t.raw, "stop_times", ["trip_id", "stop_sequence"], t.schema)))
    assert rep[("stop_times", "required_columns", "stop_id")][0] == 1
    # (T1,1) twice and (T1,NULL) twice: NULLs form one group
    assert rep[("stop_times", "unique_check", "trip_id,stop_sequence")] == (2, ["T1|1", "T1|NULL"])
    assert rep[("stop_times", "null_check", "stop_sequence")][0] == 2


def test_foreign_key_counts_null_child_and_samples(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("z",)], "route_id string")
    parent = spark.createDataFrame([("a",)], "rid string")
    r = Q.foreign_key(child, parent, "route_id", "rid", "trips", "routes").first()
    assert r.violations == 3                       # b, z and NULL (distinct)
    assert r.sample == sorted(["NULL", "b", "z"])
    brute = {v for (v,) in child.collect()} - {v for (v,) in parent.collect()}
    assert len(brute) == r.violations


def test_absent_file_and_empty_file(spark, local_tmp):
    with pytest.raises(MissingSourceError):
        load_csv(spark, os.path.join(local_tmp, "nope.txt"), SC.STATIC_SCHEMAS["routes"], "routes")
    p = write(local_tmp, "calendar.txt", "service_id,start_date,end_date\n")
    t = load_csv(spark, p, SC.STATIC_SCHEMAS["calendar"], "calendar")
    assert t.typed.count() == 0 and t.missing == ["monday", "tuesday", "wednesday", "thursday", "friday",
                                                  "saturday", "sunday"]


def _timetable(folder, trips_route="R1"):
    write(folder, "routes.txt", "route_id,route_type,route_short_name\nR1,3,One\n")
    write(folder, "trips.txt", f"route_id,service_id,trip_id,direction_id,shape_id\n{trips_route},S,T1,0,sh\n")
    write(folder, "stops.txt", "stop_id,stop_name,stop_lat,stop_lon\nA,Alpha,1.0,2.0\n")
    write(folder, "calendar.txt", "service_id,start_date,end_date\nS,20250101,20251231\n")
    write(folder, "stop_times.txt", "trip_id,arrival_time,stop_id,stop_sequence\nT1,08:00:00,A,1\n")


def test_load_static_checks_all_then_publishes(spark, local_tmp, tmp):
    good = os.path.join(local_tmp, "good")
    _timetable(good)
    res = load_static(spark, good, out_root=tmp)
    assert set(res.published) == set(SC.TABLE_ORDER)
    from adherence.sources.tables import read_table
    assert read_table(spark, f"{tmp}/dim_trips").count() == 1
    bad = os.path.join(local_tmp, "bad")
    _timetable(bad, trips_route="R9")              # child without parent
    out2 = tmp + "-2"
    with pytest.raises(Q.DataQualityError, match="foreign_key"):
        load_static(spark, bad, out_root=out2)
    from adherence.sources.tables import current_version
    assert current_version(spark, f"{out2}/dim_routes") is None    # nothing published


def test_schema_export_roundtrip(spark, local_tmp):
    SC.export_schemas(spark, local_tmp)
    for name in SC.TABLE_ORDER:
        assert SC.load_schema(name, spark, local_tmp) == SC.STATIC_SCHEMAS[name]
    with pytest.raises(FileNotFoundError):
        SC.load_schema("routes", spark, os.path.join(local_tmp, "missing"))


def test_counts_are_observed_by_the_staging_write(spark, tmp):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("id", StringType(), False), StructField("n", IntegerType()), StructField("t", StringType(), False)])
    raw = spark.createDataFrame([("a", "1", "x"), ("a", "two", ""), (None, " 3 ", "y"), ("", None, None)], "id string, n string, t string")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    staged, report = Q.staged_checks(raw.mapInArrow(counted, "id string, n string, t string"), tmp, "k", ["id"], schema)
    want = Q.table_checks(raw, "k", ["id"], schema)
    assert sorted(map(str, report.collect())) == sorted(map(str, want.collect()))
    assert reads.value == 4 and sorted(map(str, staged.collect())) == sorted(map(str, raw.collect()))  # the input is read once
    found = {(r.check, r.column): r.violations for r in report.collect()}
    assert found[("row_count", None)] == 4 and found[("null_check", "t")] == 2 and found[("type_match", "n")] == 1
    only = Q.table_checks(raw, "k", ["id"], schema, checks=["unique_check"])
    assert [r.check for r in only.collect()] == ["unique_check"]
    empty, none = Q.staged_checks(raw.limit(0), tmp + "-0", "k", ["nothing"], schema)
    assert empty.count() == 0 and {r.check for r in none.collect()} >= {"row_count", "skipped"}
