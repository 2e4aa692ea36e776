"""Reports as JSON: a one-document summary, and lists as JSON lines that grow with the data."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.functions.scalars import utc_now


# What a report says of a store that a conversion wrote; decoders come with the number of videos they decoded.
PRODUCED = "camera string, path string, n_rows long, n_files long, decoders array<struct<name: string, n_videos: long>>"


def write_conversion_report(
    summary: DataFrame,
    episodes: DataFrame,
    path: str,
    repo_id: str,
    status: str,
    options: Mapping[str, Any],
    produced: DataFrame | None = None,
) -> None:
    """summary/: one document with the splits. episodes/: one line per requested episode.

    The split summary has one row per split, with the stores that were ``produced`` (split, camera, path, n_rows,
    n_files, decoders), none if the job failed; lists of episodes never enter one row.
    """
    if produced is None:
        produced = summary.sparkSession.createDataFrame([], f"split string, {PRODUCED}")
    file = F.struct("camera", *[c for c in produced.columns if c not in ("split", "camera")])
    files = produced.groupBy("split").agg(F.array_sort(F.collect_list(file)).alias("produced_files"))
    whole = summary.join(files, "split", "left").withColumn("produced_files", F.coalesce("produced_files", F.array().cast(files.schema["produced_files"].dataType)))
    document = (
        whole.agg(F.array_sort(F.collect_list(F.struct("split", *[c for c in whole.columns if c != "split"]))).alias("splits"))
        .select(
            utc_now().alias("generated_at_utc"),
            F.lit(repo_id).alias("repo_id"),
            F.lit(status).alias("status"),
            F.struct(*[F.lit(v).alias(k) for k, v in options.items()]).alias("config"),
            "splits",
        )
    )
    document.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    episodes.write.mode("overwrite").partitionBy("split").json(f"{path}/episodes")


def write_store_report(stores: DataFrame, details: DataFrame, path: str, mode: str, target: str) -> None:
    """summary/: mode, target and one entry per store. details/: messages or columns, as lines."""
    document = stores.agg(F.array_sort(F.collect_list(F.struct(*stores.columns))).alias("stores")).select(
        F.lit(mode).alias("mode"), F.lit(target).alias("target_path"), "stores"
    )
    document.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    details.write.mode("overwrite").partitionBy("split", "camera").json(f"{path}/details")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The summary document of a report."""
    return spark.read.json(f"{path}/summary")
