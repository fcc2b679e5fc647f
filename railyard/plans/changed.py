"""The refresh driven by what changed: only the days that new input touches are rebuilt.

Each silver table is a table of published versions (``sources.versions``) with
one bucket per UTC day of ``feed_timestamp``. The natural keys hold the
snapshot time, so a day's silver rows come from that day's raw rows and the
reference tables alone. A refresh finds the days to rebuild from

* raw files: the files of a day, by name, length and time of change, against
  those that the published version was built from (its version names the
  table that lists them). Only files changed since then are opened, for one
  column, to learn their days;
* reference tables: the keys whose used columns differ between the delivery
  the version was built with and the one in force, matched with the key
  columns of the published silver rows;
* the window: it is the version's horizon, so rows leave it without being
  rewritten, and whole days leave the table.

Nothing found, nothing written. Gold is rebuilt when a silver table has a new
version, or when the clock has moved so far that a fresh row is not fresh any
more. Every table is switched by its own version record: a refresh that fails
between two tables is completed by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from railyard.functions.scalars import now_epoch
from railyard.operators.enrich import ref_routes, ref_stops, ref_trips
from railyard.operators.latest import POSITION_KEYS, TRIP_UPDATE_KEYS
from railyard.operators.slices import in_slices
from railyard.operators.timeops import FEED_DATE, fresh
from railyard.plans.gold import gold_current_vehicle_positions
from railyard.plans.refresh import RefreshConfig, check_keys
from railyard.plans.silver import silver_trip_updates, silver_vehicle_positions
from railyard.session import freed_shuffles
from railyard.sources import versions
from railyard.sources.raw import read_raw
from railyard.sources.reference import Delivery, current_delivery, load_reference_set, read_reference_set
from railyard.sources.sinks import table_location
from railyard.sources.versions import PART, Version

DAY = 86400
# a raw file and a day that it holds rows of
_FILES = "file string, length long, changed timestamp, day long"
# what silver uses of a reference table, and the silver column it is joined on
DIMENSIONS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "routes": ("route_id", ref_routes), "stops": ("stop_id", ref_stops), "trips": ("trip_id", ref_trips)}


@dataclass
class Refreshed:
    tables: dict[str, DataFrame]
    rebuilt: dict[str, list[int | None]] = field(default_factory=dict)  # days (since the epoch) by silver table
    gold_rebuilt: bool = False


def _day(column: str = "feed_timestamp"):
    return F.floor(F.col(column) / DAY).cast("long")


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet files under ``path`` (their contents are not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
            .select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("changed")))


def _file_days(spark: SparkSession, path: str, before: DataFrame | None) -> DataFrame:
    """(file, length, changed, day) of all files: known ones from ``before``, others by reading their event times."""
    listed = _listing(spark, path)
    raw = spark.read.parquet(path)
    # a change of a file is never older than the newest one known; this prunes files before they are opened
    since = before.select(F.max("changed")).first()[0] if before is not None else None
    read = raw if since is None else raw.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    days = read.select(F.col("_metadata.file_path").alias("file"), _day().alias("day")).distinct()
    if before is None:
        return listed.join(days, "file")
    known = listed.join(before, ["file", "length", "changed"])
    return known.unionByName(listed.join(before, ["file", "length", "changed"], "left_anti").join(days, "file"))


def _changed_days(now: DataFrame, before: DataFrame | None) -> DataFrame:
    if before is None:
        return now.select("day").distinct()
    # files that came or went; a null day is a day like any other
    return now.exceptAll(before).unionByName(before.exceptAll(now)).select("day").distinct()


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of which a row was added, removed or altered."""
    return old.exceptAll(new).unionByName(new.exceptAll(old)).select(key).distinct()


def _days_of_keys(spark: SparkSession, root: str, base: Version, target: str, old: Delivery, new: Delivery) -> DataFrame:
    """Days of published silver rows whose route, stop or trip differs between two deliveries."""
    days = spark.createDataFrame([], "day long")
    rows = versions.rows_of(spark, root, base)
    was, now = read_reference_set(spark, target, old), read_reference_set(spark, target, new)
    for name, (key, used) in DIMENSIONS.items():
        if old.members[name].path == new.members[name].path:
            continue
        keys = changed_keys(used(was[name]), used(now[name]), key)
        days = days.unionByName(rows.join(keys, key, "left_semi").select(F.col(PART).alias("day")).distinct())
    return days.distinct()


def _rebuild(spark: SparkSession, cfg: RefreshConfig, name: str, raw_name: str, silver: Callable, keys: tuple[str, ...], as_of: int,
             delivery: Delivery, ref: dict[str, DataFrame]) -> tuple[Version, list[int | None]]:
    root, target = f"{cfg.out.rstrip('/')}/{name}", f"{cfg.out.rstrip('/')}/reference"
    path = raw_name if "/" in raw_name or ":" in raw_name else table_location(spark, raw_name)
    base = versions.current(spark, root)
    horizon = None if cfg.window_seconds is None else as_of - cfg.window_seconds
    widened = base is not None and (base.horizon is None) != (horizon is None) or (
        base is not None and horizon is not None and horizon < base.horizon)
    before, old = None, None
    if base is not None and not widened:
        before = spark.read.schema(_FILES).parquet(base.note["files"])
        old = current_delivery(spark, target, int(base.note["delivery"]))
    state = f"{cfg.out.rstrip('/')}/_state/{name}/{uuid.uuid4().hex}"
    _file_days(spark, path, before).write.parquet(state)
    files = spark.read.schema(_FILES).parquet(state)
    days = _changed_days(files, before)
    if base is not None and not widened and old.number != delivery.number:
        days = days.unionByName(_days_of_keys(spark, root, base, target, old, delivery)).distinct()
    if horizon is not None:
        days = days.where(F.col("day") >= horizon // DAY)
    touched = [r.day for r in days.collect()]  # one number per day of the raw table at most
    known = base is not None and not widened
    if known and not touched and horizon == base.horizon and old.number == delivery.number:
        return base, []
    note = {"files": state, "delivery": str(delivery.number)}
    if known and not touched:
        empty = spark.createDataFrame([], versions.MANIFEST)
        return versions.publish(spark, root, base, None, empty, base.schema, "feed_timestamp", note=note, horizon=horizon), []
    raw = _of_days(read_raw(spark, raw_name), touched)
    parts = [silver(some, ref["routes"], ref["stops"], ref["trips"], cfg.window_seconds, as_of) for some in in_slices(raw, keys)]
    out = parts[0]
    batch = versions.write_batch([part.withColumn(PART, _day()) for part in parts], root, name)
    fresh_rows = versions.entries(spark, root, batch, out.schema, "feed_timestamp")
    gone = versions.buckets_where(spark, root, touched) if known else versions.manifest_of(spark, root, base)
    schema = StructType.fromJson(out.schema.jsonValue())
    done = versions.publish(spark, root, base, gone, fresh_rows, schema, "feed_timestamp", note=note, horizon=horizon)
    return done, sorted(touched, key=lambda d: (d is None, d))


def _of_days(raw: DataFrame, days: list[int | None]) -> DataFrame:
    """Rows of the given days: by the partition column where there is one, and by bounds that reach the scan."""
    whole = [d for d in days if d is not None]
    cond = F.col("feed_timestamp").isNull() if None in days else F.lit(False)
    if whole:
        inside = (F.col("feed_timestamp") >= min(whole) * DAY) & (F.col("feed_timestamp") < (max(whole) + 1) * DAY)
        inside = inside & _day().isin(whole)
        if FEED_DATE in raw.columns:
            inside = inside & F.col(FEED_DATE).isin([F.date_from_unix_date(F.lit(d)) for d in whole])
        cond = inside if None not in days else inside | cond
    return raw.where(cond)


def refresh_changed(spark: SparkSession, cfg: RefreshConfig) -> Refreshed:
    """Equal to ``refresh`` in what it publishes. The raw tables must be folders of Parquet files, or catalog tables
    over such; ``cfg.as_of`` must be a number or None (wall clock)."""
    with freed_shuffles(spark):
        return _refresh_changed(spark, cfg)


def _refresh_changed(spark: SparkSession, cfg: RefreshConfig) -> Refreshed:
    as_of = cfg.as_of if cfg.as_of is not None else spark.range(1).select(now_epoch().cast("long")).first()[0]
    out, target = cfg.out.rstrip("/"), f"{cfg.out.rstrip('/')}/reference"
    load_reference_set(spark, cfg.landing, target, max_unparsed=cfg.max_unparsed)
    delivery = current_delivery(spark, target)
    ref = read_reference_set(spark, target, delivery)
    if cfg.unique_keys:
        check_keys(ref)
    done = Refreshed(dict(ref))
    now: dict[str, Version] = {}
    for name, raw, silver, keys in (
            ("slv_vehicle_positions", cfg.raw_positions, silver_vehicle_positions, POSITION_KEYS),
            ("slv_trip_updates", cfg.raw_trip_updates, silver_trip_updates, TRIP_UPDATE_KEYS)):
        now[name], done.rebuilt[name] = _rebuild(spark, cfg, name, raw, silver, keys, as_of, delivery, ref)
        done.tables[name] = versions.read_table(spark, f"{out}/{name}", now[name])
    gold, root = "gld_current_vehicle_positions", f"{out}/gld_current_vehicle_positions"
    vp, tu = done.tables["slv_vehicle_positions"], done.tables["slv_trip_updates"]
    made_from = {n: str(v.number) for n, v in now.items()} | {"freshness": str(cfg.freshness_seconds)}
    base = versions.current(spark, root)
    same = base is not None and all(base.note.get(k) == v for k, v in made_from.items())
    if not (same and int(base.note["as_of"]) <= as_of <= int(base.note["until"])):
        rows = gold_current_vehicle_positions(vp, tu, as_of, cfg.freshness_seconds)
        # the rows that are fresh stay so until the oldest of them is not
        oldest = [fresh(df, "feed_timestamp", as_of, cfg.freshness_seconds).agg(F.min("feed_timestamp")).first()[0] for df in (vp, tu)]
        until = min([o + cfg.freshness_seconds for o in oldest if o is not None], default=2 ** 62)
        base = versions.replace_buckets(rows.withColumn(PART, F.lit(0).cast("long")), root, None,
                                        note={**made_from, "as_of": str(as_of), "until": str(until)}, name="gold")
        done.gold_rebuilt = True
    done.tables[gold] = versions.read_table(spark, root, base)
    return done


def vacuum(spark: SparkSession, cfg: RefreshConfig, keep: int = versions.KEEP) -> None:
    """Remove old versions of the three tables (between two refreshes)."""
    for name in ("slv_vehicle_positions", "slv_trip_updates", "gld_current_vehicle_positions"):
        versions.vacuum(spark, f"{cfg.out.rstrip('/')}/{name}", keep)
