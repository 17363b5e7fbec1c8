"""Columns that drift between files: one name by case, one type that holds all values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# each type's values are held exactly by the next of its row
_LADDERS = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType(), T.TimestampType()),
)
_WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that both types' values can be cast to; text if there is no other.

    Whole numbers and doubles meet in a double, which holds whole numbers up to 2^53
    exactly; a column that mixes them holds amounts or counts far below.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    for ladder in _LADDERS:
        if a in ladder and b in ladder:
            return ladder[max(ladder.index(a), ladder.index(b))]
    whole, real = _LADDERS[:2]
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        if a in real or b in real:
            return T.DoubleType()
        if all(isinstance(t, T.DecimalType) or t in whole for t in (a, b)):
            scales, digits = [], []
            for t in (a, b):
                scales.append(t.scale if isinstance(t, T.DecimalType) else 0)
                size = t.precision - t.scale if isinstance(t, T.DecimalType) else None
                digits.append(_WHOLE_DIGITS[t.simpleString()] if size is None else size)
            if max(digits) + max(scales) <= 38:
                return T.DecimalType(max(digits) + max(scales), max(scales))
            return T.DoubleType()
    if (a in whole and b in real) or (a in real and b in whole):
        return T.DoubleType()
    return T.StringType()


def registry(schemas: Iterable[T.StructType]) -> T.StructType:
    """One schema for files of all the given ones: names that differ only in case are one
    column under the first spelling, with a type that holds every file's values."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        folded = [field.name.lower() for field in schema]
        if len(set(folded)) < len(folded):
            raise ValueError(f"a file has columns that differ only in case: {schema.names}")
        for field in schema:
            known = fields.get(field.name.lower())
            name = known.name if known else field.name
            kind = widen(known.dataType, field.dataType) if known else field.dataType
            fields[field.name.lower()] = T.StructField(name, kind, True)
    return T.StructType(list(fields.values()))


def unite(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """A frame's columns under the registry's names and types; absent ones are NULL."""
    present = {name.lower(): name for name in frame.columns}
    return frame.select(
        *[
            F.col(f"`{present[field.name.lower()]}`").cast(field.dataType).alias(field.name)
            if field.name.lower() in present
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )
