"""Checks made before a side is broadcast."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


class Size(NamedTuple):
    rows: int
    bytes: int


def size_of(df: DataFrame) -> Size:
    """Rows and bytes of ``df``, by one pass that shuffles nothing."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return Size(rows, size or 0)


def fits_broadcast(df: DataFrame, size: Size | None = None) -> bool:
    """Whether ``df`` may be broadcast, by the size given or else measured."""
    size = size or size_of(df)
    return size.rows <= BROADCAST_ROWS and size.bytes <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint when its measured size allows it, else unchanged."""
    return F.broadcast(df) if fits_broadcast(df) else df
