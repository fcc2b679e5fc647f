"""Volume and skew probe for the silver trip-update plan.

Derives from the driver's tables (default sf0.1) a raw trip-update table
with COPIES ingest copies of every row (the 1-minute poll of a 5-minute feed
yields ~5 copies per snapshot), then times the real silver plan on it:

* ``uniform``: copies differ only in their arrival stamp;
* ``hot``:     additionally one natural key (entity, snapshot, stop) holds a
               third of all rows — the skew case the dedup must survive.

Both raw tables are first stored as Parquet (32 files), as the refresh would
find them; each run then executes the whole silver plan over the stored table
into the ``noop`` sink. Prints one JSON line.
Usage: python scripts/scale_probe.py [SF_DIR] [COPIES]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from railyard.operators.latest import keep_latest  # noqa: E402
from railyard.plans import transit_standins as T  # noqa: E402
from railyard.plans.silver import silver_trip_updates  # noqa: E402
from railyard.session import build_session, scratch_path  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session("local[8]", app="railyard-scale", shuffle_partitions=64,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    i = T._inputs(spark, sf)
    base = i["raw_tu"]
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__copy")
    raw = (base.select("*", copy)
           .withColumn("ingested_at", F.timestamp_micros(F.unix_micros("ingested_at") + F.col("__copy") * 60_000_000))
           .drop("__copy"))
    # one third of all rows (chosen by hash, flag computed once) share one key
    flagged = raw.withColumn(
        "__hot", F.pmod(F.xxhash64("entity_id", "stop_sequence", "ingested_at"), F.lit(3)) == 0)
    hot = (flagged.withColumn("entity_id", F.when(F.col("__hot"), F.lit("HOT")).otherwise(F.col("entity_id")))
                  .withColumn("feed_timestamp", F.when(F.col("__hot"), F.lit(0)).otherwise(F.col("feed_timestamp")))
                  .withColumn("stop_sequence", F.when(F.col("__hot"), F.lit(1)).otherwise(F.col("stop_sequence")))
                  .drop("__hot"))
    # store both raw tables as the pipeline would find them: many files
    stored = {}
    for name, df in (("uniform", raw), ("hot", hot)):
        path = scratch_path(spark, f"probe-raw-{name}")
        df.repartition(32).write.parquet(path)
        stored[name] = spark.read.parquet(path)
    raw, hot = stored["uniform"], stored["hot"]
    out = {"sf": sf, "copies": copies}
    for name, df in (("uniform", raw), ("hot", hot)):
        silver = silver_trip_updates(df, i["routes"], i["stops"], i["trips"])
        n_raw = df.count()
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            silver.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        biggest = df.groupBy("entity_id", "feed_timestamp", "stop_sequence").count().agg(F.max("count")).first()[0]
        out[name] = {"raw_rows": n_raw, "largest_key_rows": biggest, "silver_rows": silver.count(),
                     "sec": round(best, 2)}
    # Top-1 per key two ways on the uniform table: the window form (partial
    # WindowGroupLimit) used by keep_latest, and the aggregate form max_by.
    keys = ["entity_id", "feed_timestamp", "stop_sequence"]
    rest = [c for c in raw.columns if c not in keys + ["ingested_at"]]
    by_window = keep_latest(raw, keys, ["ingested_at"], "rest")
    by_max_by = (raw.groupBy(*keys)
                 .agg(F.max_by(F.struct(*[c for c in raw.columns if c not in keys]),
                               F.struct("ingested_at", *rest)).alias("w"))
                 .select(*keys, "w.*"))
    for name, df in (("top1_window", by_window), ("top1_max_by", by_max_by)):
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[name] = {"sec": round(best, 2)}

    # Joins past the broadcast bound: a third of the rows share one route, the
    # reference tables are joined by sort-merge; AQE must split the hot route.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    # AQE's skew thresholds (256 MB and 5x the median partition) are sized
    # for large data; scale them to this probe so the mechanism is exercised
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4m")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    hot_route = raw.withColumn("route_id", F.when(
        F.pmod(F.xxhash64("entity_id", "stop_sequence", "ingested_at"), F.lit(3)) == 0,
        F.lit("0")).otherwise(F.col("route_id")))
    silver = silver_trip_updates(hot_route, i["routes"], i["stops"], i["trips"])
    # run this DataFrame's own execution (JVM side, nothing collected) so its
    # adaptive plan becomes final and can be inspected
    qe = silver._jdf.queryExecution()
    t0 = time.perf_counter()
    qe.toRdd().count()
    dt = time.perf_counter() - t0
    plan = qe.executedPlan().toString()
    out["hot_route_sort_merge"] = {"sec": round(dt, 2), "skew_split_join": "skew=true" in plan,
                                   "sort_merge_joins": plan.count("SortMergeJoin")}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
