"""Episode index: lengths, positions, offsets, and agreement with the steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.operators.ordering import scan


def length_column(columns: Sequence[str]) -> Column:
    """Episode length from whichever metadata columns exist."""
    if {"dataset_from_index", "dataset_to_index"} <= set(columns):
        return (F.col("dataset_to_index") - F.col("dataset_from_index")).cast("long")
    if "length" in columns:
        return F.col("length").cast("long")
    raise KeyError("Episode metadata has neither dataset_from_index and dataset_to_index nor length.")


def lengths(meta: DataFrame, episodes: DataFrame | None = None) -> DataFrame:
    """Declared ep_len per episode; for the requested ``episodes`` only if they are given.

    A requested episode without metadata gets a null length (see ``without_metadata``).
    """
    declared = meta.select("episode_index", length_column(meta.columns).alias("ep_len"))
    return declared if episodes is None else episodes.join(declared, "episode_index", "left")


def without_metadata(episodes: DataFrame, meta: DataFrame) -> DataFrame:
    return episodes.join(meta.select("episode_index"), "episode_index", "left_anti")


def step_counts(steps: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Actual number of rows per episode."""
    return steps.groupBy(*group, "episode_index").agg(F.count(F.lit(1)).alias("ep_len"))


def episode_table(lengths: DataFrame, group: Sequence[str] = ("split",)) -> DataFrame:
    """Kept episodes in ascending order: ep_pos, and ep_offset = total length before it."""
    indexed = scan(lengths, "episode_index", group, position="ep_pos", sums={"ep_offset": F.col("ep_len")})
    return indexed.select(*group, "ep_pos", "episode_index", "ep_len", "ep_offset")


def reconcile(steps: DataFrame, meta: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Episodes whose declared length differs from their rows: declared, actual (0 if absent)."""
    actual = step_counts(steps, group).withColumnRenamed("ep_len", "actual")
    declared = meta.select(*group, "episode_index", length_column(meta.columns).alias("declared"))
    return (
        actual.join(declared, [*group, "episode_index"], "full")
        .na.fill(0, ["actual", "declared"])
        .where("actual <> declared")
        .select(*group, "episode_index", "declared", "actual")
    )
