"""Null normalisation of a whole frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def fill_nulls(df: DataFrame) -> DataFrame:
    """Numbers become 0 (NaN too) and text becomes ``'None'``; dates and booleans stay null.

    Null integer keys thereby turn into key 0 and join with each other.
    """
    fills: dict[str, int | str] = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NumericType):
            fills[field.name] = 0
        elif isinstance(field.dataType, T.StringType):
            fills[field.name] = "None"
    return df.na.fill(fills) if fills else df
