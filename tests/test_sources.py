import os

import pytest
from pyspark.sql import functions as F

from railyard.sources.raw import read_feed
from railyard.schemas import RAW_VEHICLE_POSITIONS, ROUTES, TRIPS
from railyard.session import scratch_path
from tests.conftest import types
from railyard.sources.reference import load_reference_set, load_trips, read_reference
from railyard.sources.sinks import (
    SchemaMismatch,
    append_raw,
    conform,
    create_raw_tables,
    materialize,
    run_ddl,
)

TRIPS_HEADER = "route_id,service_id,trip_id,trip_headsign,trip_short_name,direction_id,block_id,shape_id,wheelchair_accessible"


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_csv_bound_by_header_name(spark, tmp_dir):
    land = _local(tmp_dir)
    # permuted columns, one extra column, one bad int
    _write(land, "trips.txt", "trip_id,extra,direction_id,route_id,trip_headsign\n"
                              "T1,x,1,R1,Town\nT2,y,zz,R2,City\n")
    got = sorted(tuple(r) for r in load_trips(spark, land).select("trip_id", "route_id", "direction_id",
                                                                   "trip_headsign", "service_id").collect())
    assert got == [("T1", "R1", 1, "Town", None), ("T2", "R2", None, "City", None)]
    assert types(load_trips(spark, land).schema) == types(TRIPS)


def test_csv_position_mode_assigns_by_position(spark, tmp_dir):
    land = _local(tmp_dir)
    _write(land, "routes.txt", "route_long_name,route_id\nLong,R1\n")
    r = read_reference(spark, f"{land}/routes.txt", ROUTES, by="position").collect()[0]
    assert r.route_id == "Long"  # parity: the header names are not consulted


def test_reference_set_skips_absent_members(spark, tmp_dir):
    land1, land2, target = _local(tmp_dir) + "/d1", _local(tmp_dir) + "/d2", _local(tmp_dir) + "/pub"
    _write(land1, "trips.txt", TRIPS_HEADER + "\nR,S,T1,H,,0,,,0\n")
    _write(land1, "calendar_dates.txt", "service_id,date,exception_type\nS,20240101,1\n")
    _write(land1, "shapes.txt", "shape_id\nX\n")  # not a member: ignored
    first = load_reference_set(spark, land1, target)
    assert set(first) == {"trips", "calendar_dates"}
    _write(land2, "trips.txt", TRIPS_HEADER + "\nR,S,T2,H,,0,,,0\nR,S,T3,H,,0,,,0\n")
    second = load_reference_set(spark, land2, target)
    assert second["trips"].count() == 2  # replaced
    assert second["calendar_dates"].collect()[0].date == "20240101"  # previous copy kept


def test_append_raw_enforces_schema_and_counts(spark, tmp_dir):
    df = spark.createDataFrame([("e1", 5)], "entity_id string, feed_timestamp long")
    with pytest.raises(SchemaMismatch):
        append_raw(df, tmp_dir, RAW_VEHICLE_POSITIONS)
    full = df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c)
                       for c in RAW_VEHICLE_POSITIONS.fieldNames()])
    assert append_raw(full, tmp_dir, RAW_VEHICLE_POSITIONS) == 1
    assert append_raw(full, tmp_dir, RAW_VEHICLE_POSITIONS) == 1
    back = spark.read.parquet(tmp_dir)
    assert back.count() == 2 and types(back.schema) == types(RAW_VEHICLE_POSITIONS)
    with pytest.raises(SchemaMismatch):
        conform(full.withColumn("junk", F.lit(1)), RAW_VEHICLE_POSITIONS)


def test_ddl_idempotent_and_materialize(spark):
    loc = scratch_path(spark, "tables")
    for _ in range(2):
        status = create_raw_tables(spark, "transit_test", location=loc).collect()[0]
    assert status.status == "Initialisation complete" and status.schema == "transit_test"
    cols = spark.table("transit_test.raw_vehicle_positions").columns
    assert cols == RAW_VEHICLE_POSITIONS.fieldNames()
    from railyard.sources.raw import read_raw
    assert read_raw(spark, "transit_test.raw_trip_updates").count() == 0  # by table name
    out = materialize(spark.range(3), table="transit_test.tiny", comment="three rows")
    assert out.count() == 3
    desc = run_ddl(spark, "DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", {"t": "transit_test.tiny"}).collect()
    assert any(r[1] == "three rows" for r in desc)


def test_execute_immediate_with_named_parameters(spark):
    name = "transit_exec.t_exec"
    run_ddl(spark, "EXECUTE IMMEDIATE 'CREATE SCHEMA IF NOT EXISTS ' || :s", {"s": "transit_exec"})
    run_ddl(spark, "EXECUTE IMMEDIATE 'CREATE TABLE IF NOT EXISTS ' || :t || ' (x INT) USING parquet'",
            {"t": name})
    assert spark.table(name).columns == ["x"]


def test_csv_header_with_byte_order_mark(spark, tmp_dir):
    land = _local(tmp_dir)
    os.makedirs(land, exist_ok=True)
    with open(os.path.join(land, "routes.txt"), "w", encoding="utf-8-sig") as fh:
        fh.write("route_id,route_long_name\nR1,Long\n")
    r = read_reference(spark, f"{land}/routes.txt", ROUTES).collect()[0]
    assert (r.route_id, r.route_long_name) == ("R1", "Long")


def _land(spark, path, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def test_reference_header_case_and_missing_key(spark, tmp_dir):
    from railyard.sources.reference import MissingKey, load_routes

    _land(spark, f"{tmp_dir}/a/routes.txt", "Route_ID,ROUTE_LONG_NAME\nr1,One")
    assert [(r.route_id, r.route_long_name) for r in load_routes(spark, f"{tmp_dir}/a").collect()] == [("r1", "One")]
    _land(spark, f"{tmp_dir}/b/routes.txt", "id,route_long_name\nr1,One")
    with pytest.raises(MissingKey):
        load_routes(spark, f"{tmp_dir}/b")


def test_failed_reference_rewrite_keeps_the_old_copy(spark, tmp_dir, monkeypatch):
    from railyard.sources import reference

    out = f"{tmp_dir}/out"
    _land(spark, f"{tmp_dir}/one/routes.txt", "route_id,route_long_name\nr1,One")
    _land(spark, f"{tmp_dir}/two/routes.txt", "route_id,route_long_name\nr1,Two")
    reference.load_reference_set(spark, f"{tmp_dir}/one", out, ["routes"])

    def dies(df, target, name):
        df.write.parquet(f"{target}/{name}/half")
        raise OSError

    real = reference._publish
    monkeypatch.setattr(reference, "_publish", dies)
    with pytest.raises(OSError):
        reference.load_reference_set(spark, f"{tmp_dir}/two", out, ["routes"])
    monkeypatch.setattr(reference, "_publish", real)
    names = lambda d: [r.route_long_name for r in reference.load_reference_set(spark, d, out, ["routes"])["routes"].collect()]
    assert names(f"{tmp_dir}/none") == ["One"]
    assert names(f"{tmp_dir}/two") == ["Two"]


def test_materialize_drops_old_partitions_in_dynamic_sessions(spark, tmp_dir):
    from railyard.sources.sinks import materialize

    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        materialize(spark.sql("select 1 as a, 1 as d"), path=f"{tmp_dir}/m", partition_by=["d"])
        out = materialize(spark.sql("select 2 as a, 2 as d"), path=f"{tmp_dir}/m", partition_by=["d"])
        assert [r.a for r in out.collect()] == [2]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_bad_snapshots_fail_the_read(spark, tmp_dir):
    good = '{"header": {"timestamp": 1}, "entity": []}'
    for k, bad in enumerate(['{"header": {"timestamp": 2}, "enti', '{"entity": []}']):
        spark.createDataFrame([(good,), (bad,)], "value string").write.text(f"{tmp_dir}/{k}")
        with pytest.raises(Exception):
            read_feed(spark, f"{tmp_dir}/{k}").collect()
