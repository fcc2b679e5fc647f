"""Keep-latest-per-key (top-1 per group) and its four uses.

``row_number() == 1`` over ``partitionBy(keys)`` plans as a *partial*
WindowGroupLimit before the shuffle and a final one after it: each map task
keeps only its own best row per key, so a key holding a third of the input
still ships at most one row per map partition. Nothing is collected per
group and no group is ever held in memory.

The order must be total. The caller passes ``tie_breakers`` explicitly
(an empty list only when keys + order are already unique), or
``"rest"`` to break ties on every remaining column, so results never depend
on input order or partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_RANK = "__railyard_rn"

OrderSpec = Column | str


def _order(spec: OrderSpec, default_desc: bool) -> Column:
    if isinstance(spec, Column):
        return spec
    return F.col(spec).desc() if default_desc else F.col(spec).asc()


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderSpec],
    tie_breakers: Sequence[OrderSpec] | str,
) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order`` then ``tie_breakers``.

    Plain column names in ``order`` mean DESC (latest first); names in
    ``tie_breakers`` mean ASC. Pass Columns (``F.col(x).desc()``) to choose.
    NULL order values sort last under DESC, first under ASC (Spark default).
    """
    if isinstance(tie_breakers, str):
        if tie_breakers != "rest":
            raise ValueError("tie_breakers must be a sequence or 'rest'")
        named = {o for o in order if isinstance(o, str)}
        taken = set(keys) | named
        # maps have no ordering in Spark; every other type does
        tie_cols: list[Column] = [F.col(f.name).asc() for f in df.schema.fields
                                  if f.name not in taken and not isinstance(f.dataType, MapType)]
    else:
        tie_cols = [_order(t, default_desc=False) for t in tie_breakers]
    ordering = [_order(o, default_desc=True) for o in order] + tie_cols
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


# ── The four keep-latest uses of the transit tables ──

POSITION_KEYS = ("entity_id", "feed_timestamp")
TRIP_UPDATE_KEYS = ("entity_id", "feed_timestamp", "stop_sequence")


def dedup_positions(raw: DataFrame, keys: Sequence[str] = POSITION_KEYS) -> DataFrame:
    """One row per (entity, snapshot): the last ingested copy; exact ties
    broken on the remaining columns."""
    return keep_latest(raw, keys, ["ingested_at"], "rest")


def dedup_trip_updates(raw: DataFrame, keys: Sequence[str] = TRIP_UPDATE_KEYS) -> DataFrame:
    """One row per (entity, snapshot, stop_sequence); add ``stop_id`` to
    ``keys`` when stops come without sequence numbers."""
    return keep_latest(raw, keys, ["ingested_at"], "rest")


def latest_per_vehicle(positions: DataFrame) -> DataFrame:
    """Latest position per vehicle by snapshot time; ties: last ingested,
    then smallest entity id."""
    return keep_latest(
        positions, ["vehicle_id"], ["feed_timestamp", "ingested_at"], ["entity_id"],
    )


def latest_delay_per_trip(trip_updates: DataFrame, key_alias: str = "_tu_trip_id") -> DataFrame:
    """Latest delay per trip: newest snapshot, last ingested, then the
    lowest stop sequence (the next stop), then smallest entity id, stop id and delay.
    Returns (key_alias, trip_delay, delay_seconds, delay_category)."""
    latest = keep_latest(
        trip_updates, ["trip_id"], ["feed_timestamp", "ingested_at"], ["stop_sequence", "entity_id"]
        + [c for c in ("stop_id",) if c in trip_updates.columns] + ["delay_seconds"],
    )
    return latest.select(
        F.col("trip_id").alias(key_alias), "trip_delay", "delay_seconds", "delay_category",
    )
