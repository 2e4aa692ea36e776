"""Splits: named half-open episode ranges, parsed, checked and assigned to rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (split, start, end)
Bounds = Sequence[tuple[str, int, int]]


def range_columns(spec: Column, total: Column) -> dict[str, Column]:
    """Columns start, end and status (``ok`` or what is wrong) of a 'start:end' column."""
    start = F.split_part(spec, F.lit(":"), F.lit(1)).try_cast("long")
    end = F.regexp_replace(spec, "^[^:]*:", "").try_cast("long")
    status = (
        F.when(~F.contains(spec, F.lit(":")), "no colon")
        .when(start.isNull() | end.isNull(), "not a number")
        .when((start < 0) | (end < 0), "negative")
        .when(end < start, "end before start")
        .when(end > total, "beyond total")
        .otherwise("ok")
    )
    ok = status == "ok"
    return {"start": F.when(ok, start), "end": F.when(ok, end), "status": status}


def parse_range(spec: str, total: int) -> tuple[int, int]:
    """(start, end) of one 'start:end' text; raises ValueError if it is not a range in 0..total."""
    found = re.fullmatch(r"\s*([+-]?\d+)\s*:\s*([+-]?\d+)\s*", spec)
    if not found:
        raise ValueError(f"Range {spec!r} is not of the form 'start:end'.")
    start, end = map(int, found.groups())
    if not 0 <= start <= end <= total:
        raise ValueError(f"Range {spec!r} is not inside 0..{total} with start <= end.")
    return start, end


def split_bounds(specs: Mapping[str, str], total: int, names: Sequence[str] = ()) -> Bounds:
    """Parsed bounds of the named splits (all if none is named)."""
    return [(n, *parse_range(specs[n], total)) for n in _known("split", list(specs), names)]


def resolve_cameras(available: Sequence[str], keys: Sequence[str] = ()) -> list[str]:
    return _known("camera", list(available), keys)


def _known(what: str, available: list[str], wanted: Sequence[str]) -> list[str]:
    for name in wanted:
        if name not in available:
            raise ValueError(f"Unknown {what} {name!r}. Available: {available}.")
    return list(wanted) or available


def name_status(what: str, available: Sequence[str], name: Column) -> Column:
    """``ok`` for a known name, else the text that ``split_bounds`` and ``resolve_cameras`` raise for it."""
    text = F.concat(F.lit(f"Unknown {what} '"), F.coalesce(name, F.lit("None")), F.lit(f"'. Available: {list(available)}."))
    return F.when(name.isin(list(available)), "ok").otherwise(text)


def select_split(df: DataFrame, bounds: Bounds, split: str, key: str = "episode_index") -> DataFrame:
    """Rows of one split; the range reaches the Parquet scan."""
    start, end = next((s, e) for n, s, e in bounds if n == split)
    return df.where((F.col(key) >= start) & (F.col(key) < end))


def assign_splits(df: DataFrame, bounds: Bounds, key: str = "episode_index") -> DataFrame:
    """Add ``split``, one row per split that holds the episode, in a single pass.

    The bounds come from one metadata document, so they are literals of the plan, not a join.
    """
    if not bounds:
        raise ValueError("There is no split.")
    low, high = min(b[1] for b in bounds), max(b[2] for b in bounds)
    holders = F.array_compact(
        F.array(*[F.when((F.col(key) >= s) & (F.col(key) < e), F.lit(n)) for n, s, e in bounds])
    )
    return df.where((F.col(key) >= low) & (F.col(key) < high)).withColumn("split", F.explode(holders))


def fan_out(df: DataFrame, cameras: Sequence[str], name: str = "camera") -> DataFrame:
    """One copy of each row per camera; the camera keys are literals of the plan."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(c) for c in cameras])))
