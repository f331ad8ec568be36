"""Whole rows inside operator state.

A state schema is derived from the input's: every column but the keys becomes a field of a
payload struct.  Times and dates are held as numbers and maps as their entries, because the state
API does not hand these types back as they were stored; they become what they were when a row
leaves the operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def payload_fields(schema: T.StructType, keys) -> list[T.StructField]:
    return [f for f in schema.fields if f.name not in keys]


def stored_type(fields: list[T.StructField]) -> T.StructType:
    def kind(t):
        if isinstance(t, _TIMES):
            return T.LongType()
        if isinstance(t, T.MapType):
            t = T.ArrayType(T.StructType([T.StructField("key", t.keyType, False),
                                          T.StructField("value", t.valueType, t.valueContainsNull)]), False)
        _check_inside(t)
        return t
    return T.StructType([T.StructField(f.name, kind(f.dataType)) for f in fields])


def _check_inside(t: T.DataType, top: bool = True) -> None:
    if not top and isinstance(t, (*_TIMES, T.MapType)):
        raise ValueError(f"{t.simpleString()} inside another type cannot be kept in operator state")
    inner = [t.elementType] if isinstance(t, T.ArrayType) else [f.dataType for f in t] if isinstance(t, T.StructType) else []
    for x in inner:
        _check_inside(x, False)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def pack(fields: list[T.StructField]) -> Column:
    """The payload struct of a row."""
    def stored(f):
        c = F.col(_quoted(f.name))
        if isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.expr(f"timestampdiff(MICROSECOND, {_NTZ}, {_quoted(f.name)})")
        elif isinstance(f.dataType, T.DateType):
            c = F.unix_date(c).cast("long")
        elif isinstance(f.dataType, T.MapType):
            c = F.map_entries(c)
        return c.alias(f.name)
    return F.struct(*[stored(f) for f in fields])


def unpack(struct: str, fields: list[T.StructField], prefix: str = "") -> list[Column]:
    """The payload's columns, named ``prefix`` + name."""
    def restored(f):
        c = F.col(f"{struct}.{_quoted(f.name)}")
        if isinstance(f.dataType, T.TimestampType):
            c = F.timestamp_micros(c)
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.timestamp_add("MICROSECOND", c, F.expr(_NTZ))
        elif isinstance(f.dataType, T.DateType):
            c = F.date_from_unix_date(c.cast("int"))
        elif isinstance(f.dataType, T.MapType):
            c = F.map_from_entries(c)
        return c.alias(prefix + f.name)
    return [restored(f) for f in fields]
