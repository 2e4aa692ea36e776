"""Rows nearest to goal vectors, by squared Euclidean distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Goals of one pass over the rows, values that one numpy call works on, and branches of the merge.
GOALS, BLOCK_VALUES, BRANCHES = 1024, 1 << 21, 64


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as a matrix; null values are NaN, and a vector that is null or of another width is NaN throughout."""
    out = np.full((len(column), width), np.nan)
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    fits = np.flatnonzero((np.diff(offsets) == width) & column.is_valid().to_numpy(zero_copy_only=False))
    out[fits] = values[offsets[fits][:, None] + np.arange(width)]
    return out


class Heaps:
    """The k nearest ids of every goal so far, ordered by distance and then id."""

    def __init__(self, goals: np.ndarray, k: int):
        self.goals, self.k = goals, k
        self.distance, self.id = np.full((len(goals), k), np.inf), np.zeros((len(goals), k), np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, BLOCK_VALUES // max(1, self.goals.size))
        for at in range(0, len(ids), step):
            part = vectors[at : at + step]
            new = ((part[None] - self.goals[:, None]) ** 2).sum(2)
            new[np.isnan(new)] = np.inf
            # Only rows that reach some goal's heap take part in the sort.
            useful = np.flatnonzero((new <= self.distance[:, -1:]).any(0) & np.isfinite(new).any(0))
            distance = np.concatenate([self.distance, new[:, useful]], 1)
            id_ = np.concatenate([self.id, np.broadcast_to(ids[at : at + step][useful], (len(self.goals), len(useful)))], 1)
            order = np.lexsort((id_, distance), axis=1)[:, : self.k]
            self.distance, self.id = np.take_along_axis(distance, order, 1), np.take_along_axis(id_, order, 1)


def goal_topk(rows: DataFrame, goals: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """goal_id, rank (from 1), ``key``, distance: of every goal the ``k`` nearest rows, ties by the smaller key.

    ``goals`` (goal_id, goal) come in blocks of ``GOALS``; each block is one pass over the rows, in which a task keeps a
    heap of ``k`` rows for every goal. The heaps of all tasks are merged in two steps, so no task sees more than a share
    of them, and nothing is sorted as a whole. A vector that is null, has null values or another width than its
    goal is not near to anything; rows without a key are left out.
    """
    if k < 1:
        raise ValueError(f"k must be positive, got {k}.")
    spark = rows.sparkSession
    narrow = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    named = goals.where("goal_id is not null and goal is not null").select(F.col("goal_id").cast("long").alias("goal_id"), F.col("goal").cast("array<double>").alias("goal"))
    blocks = _blocks(named)
    parts = [_block_heaps(spark, narrow, ids, matrix, k) for ids, matrix in blocks]
    found = spark.createDataFrame([], "goal_id long, id long, distance double, branch int")
    for part in parts:
        found = found.union(part)
    for by in (["goal_id", "branch"], ["goal_id"]):
        nearest = Window.partitionBy(*by).orderBy("distance", "id")
        found = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return found.select("goal_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias(key), "distance")


def _blocks(goals: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of at most ``GOALS`` goals of one width at a time, as they come from the cluster."""
    waiting: dict[int, list] = {}
    for row in goals.toLocalIterator():
        of_width = waiting.setdefault(len(row.goal), [])
        of_width.append(row)
        if len(of_width) == GOALS:
            yield _matrix(waiting.pop(len(row.goal)))
    yield from map(_matrix, waiting.values())


def _matrix(goals: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array([r.goal_id for r in goals], np.int64), np.array([r.goal for r in goals], np.float64).reshape(len(goals), -1)


def _block_heaps(spark, rows: DataFrame, ids: np.ndarray, matrix: np.ndarray, k: int) -> DataFrame:
    sent = spark.sparkContext.broadcast((ids, matrix))

    def run(batches):
        names, goals = sent.value
        heaps = Heaps(goals, k)
        for batch in batches:
            heaps.add(batch.column("id").to_numpy(), _vectors(batch.column("v"), goals.shape[1]))
        full = np.isfinite(heaps.distance)
        columns = [np.repeat(names, full.sum(1)), heaps.id[full], heaps.distance[full]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["goal_id", "id", "distance"])

    out = rows.mapInArrow(run, "goal_id long, id long, distance double")
    return out.withColumn("branch", F.spark_partition_id() % BRANCHES)
