"""The JSON form that protobuf tools print: lowerCamelCase names, enum names, 64-bit numbers as strings.

``from_canonical`` turns it into the feed schema's own form and ``to_canonical`` back; both are column expressions
built along the schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructField, StructType

from railyard.functions import enums as E

# enum fields by the field that holds them
ENUM_FIELDS: dict[str, E.Enum] = {
    "header.incrementality": E.INCREMENTALITY,
    "trip.schedule_relationship": E.TRIP_SCHEDULE_RELATIONSHIP,
    "stop_time_update.schedule_relationship": E.STOP_SCHEDULE_RELATIONSHIP,
    "vehicle.wheelchair_accessible": E.WHEELCHAIR_ACCESSIBLE,
    "vehicle.current_status": E.VEHICLE_STOP_STATUS,
    "vehicle.congestion_level": E.CONGESTION_LEVEL,
    "vehicle.occupancy_status": E.OCCUPANCY_STATUS,
}


def camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(p.capitalize() for p in rest)


def canonical_schema(t: DataType, parent: str = "") -> DataType:
    """What to read: numbers that may come as strings, and enums, are strings."""
    if isinstance(t, StructType):
        return StructType([StructField(camel(f.name), _text_or(f, parent), True) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(canonical_schema(t.elementType, parent))
    return t


def _text_or(f: StructField, parent: str) -> DataType:
    if isinstance(f.dataType, LongType) or f"{parent}.{f.name}" in ENUM_FIELDS:
        return StringType()
    return canonical_schema(f.dataType, f.name)


def _number(c: Column, enum: E.Enum) -> Column:
    """An enum's number from its name or its number; anything else fails the job."""
    out = F.when(c.isNull(), F.lit(None).cast("int"))
    for number, label in enum.values.items():
        out = out.when(c == label, F.lit(number))
    return out.otherwise(c.cast("int"))


def _convert(c: Column, t: DataType, parent: str, back: bool) -> Column:
    if isinstance(t, StructType):
        fields = []
        for f in t.fields:
            key, source, name = f"{parent}.{f.name}", c[f.name if back else camel(f.name)], camel(f.name) if back else f.name
            if key in ENUM_FIELDS:
                value = E.enum_name(source, ENUM_FIELDS[key], fill_unset=False) if back else _number(source, ENUM_FIELDS[key])
            elif isinstance(f.dataType, LongType):
                value = source.cast("string" if back else "long")
            else:
                value = _convert(source, f.dataType, f.name, back)
            fields.append(value.alias(name))
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(t, ArrayType):
        return F.transform(c, lambda x: _convert(x, t.elementType, parent, back))
    return c


def from_canonical(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[_convert(F.col(camel(f.name)), f.dataType, f.name, False).alias(f.name) for f in schema.fields])


def to_canonical(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[_convert(F.col(f.name), f.dataType, f.name, True).alias(camel(f.name)) for f in schema.fields])
