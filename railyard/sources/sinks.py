"""Sinks: schema-enforced append, ingest counts, materialisation, DDL.

Writes go through Spark's file committers (task output becomes visible only
on job commit), so a lost executor just re-runs its tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from railyard.sources import files
from railyard.operators.timeops import FEED_DATE, with_feed_date
from railyard.schemas import RAW_TRIP_UPDATES, RAW_VEHICLE_POSITIONS
from railyard.session import freed_shuffles


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in order and cast to the declared types.
    A missing or an extra column is an error (the write is refused); values
    that do not fit the type fail the job (ANSI casts), as a typed table would."""
    have = set(df.columns)
    want = [f.name for f in schema.fields]
    missing = [c for c in want if c not in have]
    extra = sorted(have - set(want))
    if missing or extra:
        raise SchemaMismatch(f"missing columns {missing}, unexpected columns {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def ingest_metrics(df: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Attach a row counter computed while the data flows through the write
    (no second pass). Read ``obs.get["rows"]`` after the action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


class StreamManaged(ValueError):
    pass


def _refuse_streamed(spark: SparkSession, path: str) -> None:
    """A folder that a stream writes lists its files in a log of its own: files
    a batch job adds would never be read, so the write is refused."""
    if not files.exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        return
    raise StreamManaged(f"{path} is written by a stream; append to another folder and read both")


def append_raw(df: DataFrame, path: str, schema: StructType, date_partitioned: bool = False) -> int:
    """Append rows to a raw table folder after enforcing its schema; returns
    the number of rows accepted. ``date_partitioned`` lays files out under
    ``feed_date=YYYY-MM-DD/`` (UTC day of ``feed_timestamp``) so time-window
    reads prune whole days."""
    rows = conform(df, schema)
    _refuse_streamed(df.sparkSession, path)
    if date_partitioned:
        # rebalance on the partition column: about one file per day per write
        rows = with_feed_date(rows).hint("rebalance", FEED_DATE)
    observed, obs = ingest_metrics(rows)
    writer = observed.write.mode("append").option("compression", "zstd")
    if date_partitioned:
        writer = writer.partitionBy(FEED_DATE)
    with freed_shuffles(df.sparkSession):
        writer.parquet(path)
    return int(obs.get["rows"])


def append_vehicle_positions(df: DataFrame, path: str, date_partitioned: bool = False) -> int:
    return append_raw(df, path, RAW_VEHICLE_POSITIONS, date_partitioned)


def append_trip_updates(df: DataFrame, path: str, date_partitioned: bool = False) -> int:
    return append_raw(df, path, RAW_TRIP_UPDATES, date_partitioned)


def materialize(df: DataFrame | Sequence[DataFrame], path: str | None = None, table: str | None = None,
                comment: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Fully rebuild a derived dataset and return it read back, which also
    cuts the lineage of downstream plans at this layer. Several DataFrames are
    parts of it, written one after the other. A folder is overwritten; a table goes through ``publish_table``, which keeps the rows
    it had until the new ones are complete."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    if table is not None:
        return publish_table(df, table, comment=comment, partition_by=partition_by)
    return _write(_parts(df), path, partition_by, "overwrite").read.parquet(path)


def _parts(df: DataFrame | Sequence[DataFrame]) -> list[DataFrame]:
    return [df] if isinstance(df, DataFrame) else list(df)


def _write(parts: list[DataFrame], path: str, partition_by: list[str] | None, mode: str) -> SparkSession:
    """Write the parts to a folder, which is marked as complete after the last of them."""
    spark = parts[0].sparkSession
    with freed_shuffles(spark):
        for i, df in enumerate(parts):
            # without the hint every task writes one file per partition value it holds
            writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by) if partition_by else df.write
            # static whatever the session says: partitions that are gone must go
            writer = writer.mode("append" if i else mode).option("partitionOverwriteMode", "static").option("compression", "zstd")
            if i + 1 < len(parts):
                writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            writer.parquet(path)
    return spark


KEEP_VERSIONS = 2


def publish_table(df: DataFrame | Sequence[DataFrame], table: str, location: str | None = None, comment: str | None = None,
                  partition_by: list[str] | None = None, keep: int = KEEP_VERSIONS) -> DataFrame:
    """Rebuild a catalog table: the rows (of several parts, one after the
    other) are written to a new folder under ``location`` (default: ``<table>__versions`` in the schema's folder), then
    the table is pointed to it. Until that switch the table has its old rows,
    also if the write fails. The last ``keep`` folders stay, so that readers
    who resolved the table before can finish."""
    parts = _parts(df)
    df, spark = parts[0], parts[0].sparkSession
    schema_name, _, name = table.rpartition(".")
    if location is None:
        database = spark.catalog.getDatabase(schema_name or spark.catalog.currentDatabase())
        location = f"{database.locationUri.rstrip('/')}/{name}__versions"
    location = location.rstrip("/")
    number = 1 + max((int(v.partition("-")[0]) for v in files.children(spark, location) if v.partition("-")[0].isdigit()), default=0)
    folder = f"{location}/{number:08d}-{uuid.uuid4().hex}"
    _write(parts, folder, partition_by, "errorifexists")
    last = [c for c in df.columns if c not in (partition_by or [])] + (partition_by or [])
    columns = StructType([StructField(c, df.schema[c].dataType) for c in last])
    if spark.catalog.tableExists(table) and _can_move(spark, table, columns):
        run_ddl(spark, f"ALTER TABLE IDENTIFIER(:t) SET LOCATION {_sql_string(folder)}", {"t": table})
    else:
        _create_over(spark, table, columns, folder, partition_by)
    if comment:
        run_ddl(spark, f"COMMENT ON TABLE IDENTIFIER(:t) IS {_sql_string(comment)}", {"t": table})
    spark.catalog.refreshTable(table)
    done = [v for v in files.children(spark, location) if files.exists(spark, f"{location}/{v}/_SUCCESS")]
    for old in done[:-max(keep, 1)]:
        files.delete(spark, f"{location}/{old}")
    return spark.read.table(table)


def _can_move(spark: SparkSession, table: str, columns: StructType) -> bool:
    """Whether the table has these columns and no list of partitions in the catalog that a new location would miss."""
    facts = {r.col_name: r.data_type for r in run_ddl(spark, "DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", {"t": table}).collect()}
    have = [(f.name, f.dataType) for f in spark.read.table(table).schema.fields]
    return have == [(f.name, f.dataType) for f in columns.fields] and facts.get("Partition Provider") != "Catalog"


def _create_over(spark: SparkSession, table: str, columns: StructType, folder: str, partition_by: list[str] | None) -> None:
    """An external table over ``folder``. Its partitions are found in the folder, not listed in the catalog, so that
    a new location brings its own."""
    run_ddl(spark, "DROP TABLE IF EXISTS IDENTIFIER(:t)", {"t": table})  # external or not, other columns: a new table
    key, ddl = "spark.sql.hive.manageFilesourcePartitions", f"CREATE TABLE IDENTIFIER(:t) ({_columns_ddl(columns)}) USING parquet"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(partition_by)})"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        run_ddl(spark, f"{ddl} LOCATION {_sql_string(folder)}", {"t": table})
    finally:
        spark.conf.set(key, before)


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a catalog table."""
    rows = run_ddl(spark, "DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", {"t": table}).collect()
    return next(r.data_type for r in rows if r.col_name == "Location")


def _sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns_ddl(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)


def run_ddl(spark: SparkSession, template: str, args: dict[str, object] | None = None) -> DataFrame:
    """Run parameterised SQL; names go through ``IDENTIFIER(:p)`` and values
    through named parameters, never string pasting."""
    return spark.sql(template, args=args or {})


def create_raw_tables(spark: SparkSession, schema: str, location: str | None = None) -> DataFrame:
    """Idempotently create the schema and both raw tables; returns the
    one-row status (status, schema). With ``location`` each table lies in the
    folder of its name there (``table_location``), where batch or streaming
    appends put their files."""
    run_ddl(spark, "CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:s)", {"s": schema})
    for name, cols in (("raw_vehicle_positions", RAW_VEHICLE_POSITIONS),
                       ("raw_trip_updates", RAW_TRIP_UPDATES)):
        loc = f" LOCATION {_sql_string(location.rstrip('/') + '/' + name)}" if location else ""
        run_ddl(spark, f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({_columns_ddl(cols)}) USING parquet{loc}",
                {"t": f"{schema}.{name}"})
    return status_row(spark, {"schema": schema})


def status_row(spark: SparkSession, args: dict[str, str]) -> DataFrame:
    """Constant status row echoing the parameters."""
    cols = ", ".join(f":{k} AS {k}" for k in args)
    return spark.sql(f"SELECT 'Initialisation complete' AS status, {cols}", args=args)
