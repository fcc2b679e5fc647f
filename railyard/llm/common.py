"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.session import scratch_path
from railyard.sources import files

# ASCII white space: blank and the control characters tab to carriage return
SPACES = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, pins values, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read any more, not even a plan that is run again."""
    for table in tables:
        files.delete(table.sparkSession, table.scratch)


# rows of one Arrow batch of whole texts: at Spark's default of 10,000 a batch, held by the JVM and by Python several
# times over, is some hundred MB of texts
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Have the session send at most BATCH_ROWS rows a batch to Python (a smaller setting stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; an empty array for null or blank text."""
    trimmed = F.call_function("btrim", F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def once(df: DataFrame, expr: Column, name: str, *keep: str) -> DataFrame:
    """Add ``expr`` as a column that later expressions read as a value.

    The optimizer would otherwise copy the expression into lambda bodies that mention it and evaluate it once per
    array element; a one-element generator is a boundary it doesn't move expressions across."""
    return df.select(*(keep or ("*",)), F.explode(F.array(expr)).alias(name))


def remainder_is(doc_id: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text (null: empty text), modulo ``modulus``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == remainder
