import datetime as dt

from pyspark.sql import functions as F

from railyard.functions import enums as E
from railyard.functions.scalars import (
    bucket_start,
    delay_category,
    delay_seconds,
    epoch_seconds,
    epoch_to_ts,
    speed_kmh,
)


def test_delay_category_boundaries(spark):
    vals = [-61, -60, -59, 0, 60, 61, 300, 301, None]
    df = spark.createDataFrame([(v,) for v in vals], "d int")
    got = [r[0] for r in df.select(delay_category("d")).collect()]
    assert got == ["EARLY", "EARLY", "ON_TIME", "ON_TIME", "ON_TIME", "LATE", "LATE", "VERY_LATE", "UNKNOWN"]


def test_speed_kmh(spark):
    df = spark.createDataFrame([(None,), (10.0,), (12.3,), (0.014,)], "s float")
    got = [r[0] for r in df.select(speed_kmh("s")).collect()]
    assert got == [None, 36.0, 44.3, 0.1]


def test_delay_seconds_first_non_null(spark):
    df = spark.createDataFrame([(None, 400), (10, 400), (None, None)], "a int, d int")
    assert [r[0] for r in df.select(delay_seconds("a", "d")).collect()] == [400, 10, None]


def test_epoch_helpers_exact_and_zone_free(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),), (dt.datetime(1969, 12, 31, 23, 59, 59, 500000),)],
        "ts timestamp_ntz")
    rows = df.select(epoch_seconds("ts").alias("s"),
                     bucket_start(epoch_seconds("ts"), 86400).alias("day"),
                     epoch_to_ts(epoch_seconds("ts"), ntz=True).alias("back")).collect()
    assert rows[0]["s"] == 1704067207 and rows[0]["day"] == 1704067200
    assert rows[0]["back"] == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert rows[1]["s"] == -1 and rows[1]["day"] == -86400  # floor, not truncation


def test_epoch_to_ts_timestamp(spark):
    df = spark.createDataFrame([(0,), (1704067200,)], "s long")
    got = df.select(F.unix_micros(epoch_to_ts("s"))).collect()
    assert [r[0] for r in got] == [0, 1704067200 * 1_000_000]


def test_enum_names(spark):
    df = spark.createDataFrame([(None,), (0,), (2,), (4,), (8,), (9,)], "v int")
    sched = [r[0] for r in df.select(E.enum_name("v", E.TRIP_SCHEDULE_RELATIONSHIP)).collect()]
    assert sched == ["SCHEDULED", "SCHEDULED", "UNSCHEDULED", "4", "NEW", "9"]
    status = [r[0] for r in df.select(E.enum_name("v", E.VEHICLE_STOP_STATUS)).collect()]
    assert status[0] == "IN_TRANSIT_TO"
    occ = [r[0] for r in df.select(E.enum_name("v", E.OCCUPANCY_STATUS)).collect()]
    assert occ[0] == "EMPTY" and occ[4] == "NOT_BOARDABLE" and occ[5] == "9"
    raw = [r[0] for r in df.select(E.enum_name("v", E.WHEELCHAIR_ACCESSIBLE, fill_unset=False)).collect()]
    assert raw[0] is None and raw[1] == "NO_VALUE"
