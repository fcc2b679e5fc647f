"""Event-time cut-offs: freshness (gold) and rolling retention (silver).

Both are a lower bound on an event-time column written *before* ranking, so
the predicate reaches the Parquet scan (row-group / partition skipping) and
commutes with keep-latest (a lower bound on the DESC order key never removes
a key's winner while keeping a loser).

``as_of`` is the reference "now": ``None`` means wall clock
(``unix_timestamp()``, folded to a literal by the optimizer); a number or a
Column (e.g. :func:`latest` — a scalar subquery) for replays and fixtures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampNTZType, TimestampType

from railyard.functions.scalars import now_epoch

# Gold freshness window and the documented silver retention.
FRESHNESS_SECONDS = 15 * 60
ROLLING_WINDOW_SECONDS = 2 * 60 * 60


def latest(df: DataFrame, column: str) -> Column:
    """``(SELECT max(column) FROM df)`` as a Column (scalar subquery): the
    aggregate runs as its own small job, nothing is collected by hand."""
    return df.select(F.max(column)).scalar()


def cutoff(df: DataFrame, column: str, as_of: Column | int | None, seconds: int) -> Column:
    """``as_of - seconds`` in the type of ``column`` (epoch number or timestamp)."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        if as_of is None:
            ref = F.localtimestamp() if isinstance(dtype, TimestampNTZType) else F.current_timestamp()
        else:
            ref = as_of if isinstance(as_of, Column) else F.lit(as_of).cast(dtype)
        return ref - F.make_dt_interval(secs=F.lit(seconds))
    if isinstance(dtype, NumericType):
        return now_epoch(as_of) - F.lit(seconds)
    raise TypeError(f"{column}: event time must be epoch seconds or a timestamp, got {dtype}")


FEED_DATE = "feed_date"
FEED_DATE_SOURCE = "feed_timestamp"


def epoch_date(epoch: Column | str) -> Column:
    """UTC calendar date of POSIX seconds, independent of the session zone."""
    e = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.date_from_unix_date(F.floor(e / F.lit(86400)).cast("int"))


def with_feed_date(df: DataFrame) -> DataFrame:
    """Add the ``feed_date`` partition column (UTC day of ``feed_timestamp``)."""
    return df.withColumn(FEED_DATE, epoch_date(FEED_DATE_SOURCE))


def fresh(df: DataFrame, column: str, as_of: Column | int | None = None,
          seconds: int = FRESHNESS_SECONDS) -> DataFrame:
    """Rows whose event time is at most ``seconds`` before ``as_of`` (inclusive).

    On a table partitioned by ``feed_date`` (derived from this epoch column)
    the same bound is also stated on the partition column, so whole date
    directories are pruned before any file is opened."""
    bound = cutoff(df, column, as_of, seconds)
    cond = F.col(column) >= bound
    # feed_date is derived from feed_timestamp only; any other column's bound
    # says nothing about it
    if column == FEED_DATE_SOURCE and FEED_DATE in df.columns:
        cond = cond & (F.col(FEED_DATE) >= epoch_date(bound))
    return df.filter(cond)


def rolling_window(df: DataFrame, column: str, as_of: Column | int | None = None,
                   seconds: int = ROLLING_WINDOW_SECONDS) -> DataFrame:
    """Retention window applied before de-duplication (same predicate as :func:`fresh`)."""
    return fresh(df, column, as_of, seconds)
