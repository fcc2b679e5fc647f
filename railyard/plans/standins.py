"""The engine's operators run over the driver's tables.

Stand-ins: ``events`` plays the vehicle positions (user_id = vehicle and
entity, value = speed, ts = arrival time, UTC-day bucket of ts = snapshot
time); ``lineitem`` + ``orders`` play the trip updates (l_orderkey = trip,
l_linenumber = stop sequence, day difference = delay); ``customer``,
``nation``, ``region``, ``part`` and ``supplier`` play reference tables (the
silver shapes join them whole, on keys of which some miss; ``q_enrich_left``
leaves customers without a positive balance out for misses);
``embeddings`` holds a repeated field.

Every function reads whole tables and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions.enums import OCCUPANCY_STATUS, enum_name
from railyard.functions.scalars import (
    bucket_start,
    delay_category,
    delay_seconds,
    epoch_seconds,
    epoch_to_ts,
    speed_kmh,
)
from railyard.operators.enrich import attach_latest, enrich
from railyard.operators.flatten import stamp_ingested, unnest, zero_fill
from railyard.operators.latest import keep_latest
from railyard.operators.timeops import fresh, latest, rolling_window
from railyard.schemas import D, I, L, S, TS, struct_schema
from railyard.session import scratch_path
from railyard.sources.reference import read_reference
from railyard.sources.sinks import append_raw

DAY = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_positions(events: DataFrame) -> DataFrame:
    """Add the snapshot time: start of the UTC day of ``ts`` (epoch seconds)."""
    return events.withColumn("feed_timestamp", bucket_start(epoch_seconds("ts"), DAY))


def _latest_event(df: DataFrame, keys: list[str]) -> DataFrame:
    return keep_latest(df, keys, ["ts"], [F.col("event_id").desc()])


def _dedup_lines(lineitem: DataFrame) -> DataFrame:
    return keep_latest(
        lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"],
        [F.col("l_partkey").desc(), F.col("l_suppkey").desc(), F.col("l_extendedprice").desc()],
    )


def _positive_customers(customer: DataFrame) -> DataFrame:
    return customer.filter(F.col("c_acctbal") > 0)


# ── W1 / W2 / W3 ──

def q_dedup_positions(spark, sf_dir):
    ev = events_as_positions(table(spark, sf_dir, "events"))
    return _latest_event(ev, ["user_id", "feed_timestamp"]).select(
        "event_id", "user_id", "feed_timestamp", "event_type", "value")


def q_dedup_trip_updates(spark, sf_dir):
    return _dedup_lines(table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


# ── J1-J3, P1, P3 ──

def q_enrich_left(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    cust = _positive_customers(table(spark, sf_dir, "customer")).select(
        "c_custkey", F.col("c_name").alias("customer_name"), "c_nationkey")
    nat = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.col("n_name").alias("nation_name"), "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region_name"))
    out = enrich(ev, cust, "user_id", dim_key="c_custkey")
    out = enrich(out, nat, "c_nationkey", dim_key="n_nationkey")
    out = enrich(out, reg, "n_regionkey", dim_key="r_regionkey")
    return out.select("event_id", "user_id", "customer_name", "nation_name", "region_name")


# ── P6-P8, P11 ──

def q_speed_kmh(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    speed = F.when(F.col("event_type") != "error", F.col("value").cast("float"))
    return ev.select("event_id", speed_kmh(speed).alias("speed_kmh"))


# ── P9, P10, P17 ──

def _line_delays(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return li.join(orders, "l_orderkey").withColumn("days", F.datediff("l_shipdate", "o_orderdate"))


def q_delay_category(spark, sf_dir):
    d = _line_delays(spark, sf_dir)
    arr = F.when(F.col("l_returnflag") != "R", F.col("days"))
    dep = F.when(F.col("l_linestatus") != "F", F.col("days") + 1)
    delay = delay_seconds(arr, dep).cast("int")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", delay.alias("delay_seconds")).withColumn(
        "delay_category", delay_category("delay_seconds"))


# ── P12, P13 ──

def q_epoch_time(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    secs = epoch_seconds("ts")
    return ev.select("event_id", secs.alias("feed_timestamp"), epoch_to_ts(secs, ntz=True).alias("feed_time"))


# ── T1, T2, P14, P15 ──

def _as_of_second(ev: DataFrame):
    """Reference time: the newest event's whole second (scalar subquery)."""
    return epoch_to_ts(ev.select(epoch_seconds(F.max("ts"))).scalar(), ntz=True)


def q_fresh_cutoff(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return fresh(ev, "ts", _as_of_second(ev), 900).select("event_id", "user_id")


def q_rolling_window(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    kept = rolling_window(ev, "ts", _as_of_second(ev), 7200)
    return _latest_event(kept, ["user_id"]).select("event_id", "user_id")


# ── W4, W5 ──

def q_latest_per_vehicle(spark, sf_dir):
    return _latest_event(table(spark, sf_dir, "events"), ["user_id"]).select("user_id", "event_id", "value")


def q_latest_delay_per_trip(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    top = keep_latest(li, ["l_orderkey"], ["l_shipdate"],
                      ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return top.select(F.col("l_orderkey").alias("trip_id"), "l_linenumber", "l_partkey")


# ── Q3, J4, P4 ──

def q_gold_current(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    v = _latest_event(fresh(ev, "ts", latest(ev, "ts"), DAY), ["user_id"]).select("user_id", "event_id", "value")
    orders = table(spark, sf_dir, "orders")
    recent = fresh(orders, "o_orderdate", latest(orders, "o_orderdate"), 365 * DAY)
    d = keep_latest(recent, ["o_custkey"], ["o_orderdate"], [F.col("o_orderkey").desc()]).select(
        "o_custkey", F.col("o_orderkey").alias("latest_order"), F.col("o_totalprice").alias("latest_price"))
    return attach_latest(v, d, "user_id", "o_custkey")


# ── F4, F5 ──

def q_unnest(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return unnest(emb, "embedding", "val", keep=["vec_id", "label"], position="pos")


def nest_bounded(df: DataFrame, keys: list[str], item: str, payload: list[str] | Column,
                 max_items: int = 1024, finish: Callable[[Column], Column] | None = None) -> DataFrame:
    """Group rows into ``(keys, item: array<element>)`` rows of about
    ``max_items`` elements (element = ``struct(payload)`` or the given
    Column): a key with n rows is dealt evenly, by a row number, over
    ceil(n/max_items) chunks, so neither a hot key nor a row that repeats very
    often becomes one huge row. Rows are stored first (a task that is run again
    deals its rows alike), and the counts of keys with more than ``max_items``
    rows, at most one for so many rows: joined to few, rows need no shuffle but
    the one that collects them. ``finish`` makes the item of what was collected.
    Chunk choice does not affect the flattened result. Rows with a NULL key
    are dropped."""
    element = payload if isinstance(payload, Column) else F.struct(*payload)
    spark = df.sparkSession
    rows_at, counts_at = scratch_path(spark, "nest-rows"), scratch_path(spark, "nest-counts")
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    (df.where(known).select(*keys, element.alias("__item"), F.monotonically_increasing_id().alias("__nr"))
     .write.option("compression", "zstd").parquet(rows_at))
    rows = spark.read.parquet(rows_at)
    (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_items).write.parquet(counts_at))
    salted = rows.join(spark.read.parquet(counts_at), keys, "left").withColumn(
        "__chunk", F.pmod(F.xxhash64("__nr"), F.ceil(F.coalesce("__n", F.lit(1)) / F.lit(max_items))).cast("int"))
    nested = salted.groupBy(*keys, "__chunk").agg(F.collect_list("__item").alias(item)).drop("__chunk")
    return nested.withColumn(item, F.transform(item, finish)) if finish else nested


def q_unnest_two_level(spark, sf_dir):
    """Build customer -> orders -> lines snapshots (bounded arrays), then
    flatten them with two inner explodes; empty child lists yield no rows."""
    lines = nest_bounded(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "lines",
                         ["l_linenumber", "l_partkey"])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    entities = orders.join(lines.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    snapshots = nest_bounded(entities, ["o_custkey"], "entity", ["o_orderkey", "lines"])
    feed = table(spark, sf_dir, "customer").select("c_custkey").join(
        snapshots.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    ent = unnest(feed, "entity", "e", keep=["c_custkey"])
    rows = unnest(ent, "e.lines", "l", keep=["c_custkey", F.col("e.o_orderkey").alias("o_orderkey")])
    return rows.select("c_custkey", "o_orderkey", "l.l_linenumber", "l.l_partkey")


# ── F6, F7 ──

def q_zero_fill(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    j = enrich(cust, urgent, "c_custkey")
    return j.select("c_custkey", zero_fill("o_orderkey").alias("order_id"),
                    zero_fill("o_totalprice", value=0.0).alias("price"))


# ── F8 ──

def q_enum_name(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", enum_name("label", OCCUPANCY_STATUS, fill_unset=False).alias("occupancy_status"))


# ── S11: declared-schema JSON decode ──

def q_feed_json(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


# ── S1-S8: header-bound CSV read ──

NATION_CSV = struct_schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I))


def q_csv_by_name(spark, sf_dir):
    """Write nation as CSV with permuted columns and an extra one, then read
    it back binding columns by header name."""
    path = scratch_path(spark, "nation-csv")
    nation = table(spark, sf_dir, "nation")
    (nation.select("n_regionkey", F.lit("x").alias("n_comment"), "n_name", "n_nationkey")
     .write.option("header", True).csv(path))
    return read_reference(spark, path, NATION_CSV, by="name")


# ── S12, S14, F9: schema-enforced append ──

EVENT_RAW = struct_schema(("event_id", L), ("user_id", L), ("value", D), ("ingested_at", TS))


def q_append_raw(spark, sf_dir):
    path = scratch_path(spark, "events-raw")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    for stamp in (1_700_000_000_000_000, 1_700_000_060_000_000):
        append_raw(stamp_ingested(ev, stamp), path, EVENT_RAW)
    return spark.read.parquet(path).drop("ingested_at")


# ── Q1, Q2 ──

def q_silver_positions(spark, sf_dir):
    ev = events_as_positions(table(spark, sf_dir, "events"))
    d = _latest_event(ev, ["user_id", "feed_timestamp"])
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("route_long_name"), "c_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("stop_name"))
    # route keys spread wider than the dimension: some miss
    d = d.withColumn("c_custkey", F.col("user_id") * 12)
    j = enrich(enrich(d, cust, "c_custkey"), nat, "c_nationkey", dim_key="n_nationkey")
    return j.select(
        F.col("user_id").alias("entity_id"), "feed_timestamp",
        epoch_to_ts("feed_timestamp", ntz=True).alias("feed_time"),
        "route_long_name", "stop_name", F.col("value").alias("speed"),
        speed_kmh(F.col("value").cast("float")).alias("speed_kmh"),
    )


def q_silver_trip_updates(spark, sf_dir):
    d = _dedup_lines(table(spark, sf_dir, "lineitem"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    s = enrich(d, orders, "l_orderkey").withColumn(
        "delay_seconds", F.datediff("l_shipdate", "o_orderdate").cast("int"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("stop_name"))
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("route_long_name"))
    s = s.withColumn("p_partkey", F.col("l_partkey") + 50)  # the last keys miss
    j = enrich(enrich(s, part, "p_partkey"), supp, "l_suppkey", dim_key="s_suppkey")
    return j.select(
        F.col("l_orderkey").alias("trip_id"), F.col("l_linenumber").alias("stop_sequence"),
        "stop_name", "route_long_name", "delay_seconds",
        delay_category("delay_seconds").alias("delay_category"),
    )
