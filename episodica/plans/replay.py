"""Replay: one episode of one store as long-form signals, images and session metadata."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.functions.names import camera_slug, export_name, store_name
from episodica.operators import signals as S
from episodica.operators.store_checks import check_replay_columns, check_replay_rows
from episodica.sources import store


@dataclass(frozen=True)
class Replay:
    signals: DataFrame
    images: DataFrame
    metadata: DataFrame
    name: str

    def write(self, folder: str, mode: str = "overwrite") -> str:
        """Save as Parquet below ``folder``; returns the path."""
        path = f"{folder.rstrip('/')}/{self.name}"
        self.signals.write.mode(mode).parquet(f"{path}/signals")
        self.images.write.mode(mode).parquet(f"{path}/images")
        self.metadata.write.mode(mode).parquet(f"{path}/metadata")
        return path


def replay(
    spark: SparkSession,
    root: str,
    split: str | None = None,
    camera: str | None = None,
    ep_pos: int = 0,
    start: int = 0,
    end: int | None = None,
    stride: int = 1,
) -> Replay:
    if ep_pos < 0:
        raise ValueError(f"Episode position must not be negative, got {ep_pos}.")
    of_split, of_camera = store.select_store(store.list_stores(spark, root), split, camera)
    chosen = [(of_split, of_camera)]
    rows, table = store.read_store(spark, root, chosen), store.read_episode_table(spark, root, chosen)
    check_replay_columns(rows, table)
    offset, length = store.episode_bounds(table, of_split, of_camera, ep_pos)
    first, last, step = S.resolve_window(length, start, end, stride)
    episode = store.select_episode(rows, of_split, of_camera, offset, length)
    check_replay_rows(episode)
    shown = S.step_window(episode, first, last, step)

    attributes = store.read_attributes(spark, root).where((F.col("split") == of_split) & (F.col("camera") == of_camera))
    stem = store_name(F.lit(of_split), F.lit(of_camera))
    session = S.source_metadata(
        attributes, F.lit(split), F.lit(camera), F.lit(of_split), camera_slug(F.lit(of_camera))
    ).select(
        F.concat(F.lit(root.rstrip("/") + "/"), stem).alias("source_file"),
        "source_repo_id",
        "source_split",
        "source_camera_key",
        F.lit(ep_pos).cast("long").alias("episode_index"),
        F.lit(first).cast("long").alias("start_step"),
        F.lit(last).cast("long").alias("end_step"),
        F.lit(step).cast("long").alias("step_stride"),
        export_name(stem, F.lit(ep_pos)).alias("export"),
    )
    name = session.first().export
    return Replay(S.to_long(shown), S.images(shown), S.metadata_rows(session.drop("export")), name)
