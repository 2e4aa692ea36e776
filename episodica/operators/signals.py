"""One episode as time series: step windows, long-form signals, images, session metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.scalars import first_filled, json_text, to_double


def resolve_window(length: int, start: int = 0, end: int | None = None, stride: int = 1) -> tuple[int, int, int]:
    """(start, inclusive end, stride), checked against an episode of ``length`` steps."""
    last = length - 1
    stop = last if end is None else end
    if stride <= 0:
        raise ValueError(f"stride must be positive, got {stride}.")
    if not 0 <= start <= stop <= last:
        raise ValueError(f"Window {start}..{stop} must satisfy 0 <= start <= end <= {last}.")
    return start, stop, stride


def step_window(df: DataFrame, start: int = 0, end: int | None = None, stride: int = 1) -> DataFrame:
    """Rows at positions start, start + stride, ... <= end of their slice.

    Positions count from ep_offset, whatever step_idx says. Without ``end`` a slice is taken to
    its end. The filter needs columns row and ep_offset; use ``resolve_window`` to check bounds.
    """
    if stride <= 0 or start < 0 or (end is not None and end < start):
        raise ValueError(f"Invalid window start={start}, end={end}, stride={stride}.")
    at = F.col("row") - F.col("ep_offset")
    keep = (at >= start) & ((at - start) % stride == 0)
    return df.where(keep if end is None else keep & (at <= end))


def to_long(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, entity_path, step, value): every scalar and vector element of each step."""

    def signal(path: Column, value: Column) -> Column:
        return F.struct(path.alias("entity_path"), value.cast("double").alias("value"))

    def elements(name: str) -> Column:
        prefix = F.lit(f"signals/{name}/dim_")
        return F.transform(name, lambda x, i: signal(F.concat(prefix, i.cast("string")), x))

    scalars = [("done", "done"), ("episode_idx", "episode_idx"), ("step_idx", "step_idx")]
    cells = F.concat(
        F.array(
            *[signal(F.lit(f"signals/{n}"), to_double(F.col(c), df.schema[c].dataType)) for n, c in scalars]
        ),
        elements("action"),
        elements("state"),
    )
    return df.select(*keys, F.col("step_idx").alias("step"), F.inline(cells)).select(
        *keys, "entity_path", "step", "value"
    )


def images(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, entity_path, step, rank, pixels): one-channel frames are 2-D images."""
    rank = F.when(F.col("pixels.channels") == 1, 2).otherwise(3)
    return df.select(
        *keys, F.lit("episode/pixels").alias("entity_path"), F.col("step_idx").alias("step"), rank.alias("rank"), "pixels"
    )


def source_metadata(
    attributes: DataFrame,
    requested_split: Column,
    requested_camera: Column,
    name_split: Column,
    name_slug: Column,
) -> DataFrame:
    """Resolve source_repo_id, source_split and source_camera_key: request, attribute, name, unknown."""
    return attributes.withColumns(
        {
            "source_repo_id": F.coalesce("source_repo_id", F.lit("unknown")),
            "source_split": first_filled(requested_split, F.col("source_split"), name_split),
            "source_camera_key": first_filled(requested_camera, F.col("source_camera_key"), name_slug),
        }
    )


def metadata_rows(session: DataFrame) -> DataFrame:
    """(entity_path, text, value): the session document and three of its numbers."""
    numbers = ["episode_index", "start_step", "end_step"]
    document = F.struct(
        F.lit("metadata/session").alias("entity_path"),
        json_text(*[F.col(c) for c in session.columns]).alias("text"),
        F.lit(None).cast("double").alias("value"),
    )
    cells = [
        F.struct(
            F.lit(f"metadata/{n}").alias("entity_path"),
            F.lit(None).cast("string").alias("text"),
            F.col(n).cast("double").alias("value"),
        )
        for n in numbers
    ]
    return session.select(F.inline(F.array(document, *cells)))
