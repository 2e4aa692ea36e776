"""Vectors, numbers, JSON text and time, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions import fixed as K


def flatten_vector(col: Column, dtype: T.DataType) -> Column:
    """One flat array<float> per row: a scalar becomes one element, nested arrays are unnested."""
    if not isinstance(dtype, T.ArrayType):
        return F.array(col.cast("float"))
    inner = dtype.elementType
    while isinstance(inner, T.ArrayType):
        col, inner = F.flatten(col), inner.elementType
    return col.cast("array<float>")


def to_double(col: Column, dtype: T.DataType) -> Column:
    return (col.cast("int") if isinstance(dtype, T.BooleanType) else col).cast("double")


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor empty, else ``unknown``."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(K.UNKNOWN))


def json_text(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), {"pretty": "true"})


def utc_now() -> Column:
    """Current time as ISO text in UTC, whatever the session time zone is."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
