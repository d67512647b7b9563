"""A row's place in an order, and a value it carries, packed in one number that hash aggregates can take the ends of."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_VALUES = 1_000
LONG_PLACES, DECIMAL_PLACES = 2**63 - 1, 10**38 - 1
DECIMAL = T.DecimalType(38, 0)
WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class PackedPlace:
    """``place`` orders rows; ``value_at`` gives back the value that a place carries."""

    place: Column
    values: tuple[Any, ...]
    value_type: T.DataType

    def value_at(self, place: str | Column) -> Column:
        place = F.col(place) if isinstance(place, str) else place
        held = F.array(*[F.lit(v) for v in self.values]).cast(T.ArrayType(self.value_type))
        return F.get(held, F.pmod(place, F.lit(max(len(self.values), 1))).cast("int"))


def value_code(value: str | Column, values: Sequence[Any]) -> Column:
    """Zero-based position of ``value`` in ``values``; null for null, -1 for a value that is not listed."""
    value = F.col(value) if isinstance(value, str) else value
    return F.array_position(F.array(*[F.lit(v) for v in values]), value).cast("long") - 1 if values else F.lit(None).cast("long")


def packed_period(period: str, value: str, values: Sequence[Any], value_type: T.DataType) -> PackedPlace:
    """Place by an integer of at most 32 bits, equal ones by the order of ``values``; null where either is null or the value is not listed."""
    code = value_code(value, values)
    place = F.when(code >= 0, F.col(period).cast("int").cast("long") * max(len(values), 1) + code)
    return PackedPlace(place, tuple(values), value_type)


def _whole(column: str, kind: T.DataType) -> Column | None:
    if isinstance(kind, WHOLE_TYPES):
        return F.col(column).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        # Without a zone there is no instant to count from; day and time of day give the order.
        clock = (F.hour(column) * 60 + F.minute(column)).cast("long") * 60_000_000 + (F.date_part(F.lit("second"), column) * 1_000_000).cast("long")
        return F.unix_date(F.col(column).cast("date")).cast("long") * 86_400_000_000 + clock
    return None


def packed_place(df: DataFrame, order_by: Sequence[str], value: str) -> PackedPlace | None:
    """Place of the rows of ``df`` by ``order_by``, null first, then by value. ``value`` must not be null.

    The ranges of the order columns and the distinct values are measured in one job over these columns alone. The place is a long if
    the product of the ranges allows it, else a decimal of 38 digits. None if that is too small as well, if a column is neither a whole
    number nor a time, or if there are more than ``MAX_VALUES`` values: then compare the columns themselves.
    """
    wholes = [_whole(c, df.schema[c].dataType) for c in order_by]
    if not wholes or any(w is None for w in wholes):
        return None
    measured = [f(w).alias(f"{n}{i}") for i, w in enumerate(wholes) for n, f in (("low", F.min), ("high", F.max))]
    met = df.groupBy(F.col(value).alias("value")).agg(*measured).limit(MAX_VALUES + 1).collect()
    if len(met) > MAX_VALUES:
        return None
    values = tuple(sorted((r["value"] for r in met), key=lambda v: v.encode() if isinstance(v, str) else v))
    lows = [min((r[f"low{i}"] for r in met if r[f"low{i}"] is not None), default=0) for i in range(len(wholes))]
    highs = [max((r[f"high{i}"] for r in met if r[f"high{i}"] is not None), default=0) for i in range(len(wholes))]
    spans = [high - low + 2 for low, high in zip(lows, highs)]
    places = max(len(values), 1)
    for span in spans:
        places *= span
    if places > DECIMAL_PLACES or max(spans) > LONG_PLACES:
        return None
    wide = places > LONG_PLACES

    def number(n: int) -> Column:
        return F.lit(Decimal(n)).cast(DECIMAL) if wide else F.lit(n).cast("long")

    place = number(0)
    for whole, low, span in zip(wholes, lows, spans):
        digit = F.coalesce(whole - F.lit(low).cast("long") + 1, F.lit(0))
        place = (place * number(span) + (digit.cast(DECIMAL) if wide else digit)).cast(DECIMAL if wide else "long")
    code = value_code(value, values)
    place = (place * number(max(len(values), 1)) + (code.cast(DECIMAL) if wide else code)).cast(DECIMAL if wide else "long")
    return PackedPlace(place, values, df.schema[value].dataType)
