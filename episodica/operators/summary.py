"""What happened to the episodes of each split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.functions import fixed as K
from episodica.operators.quality import check_policy, dirty_episodes
from episodica.operators.splits import Bounds


def requested_episodes(spark: SparkSession, bounds: Bounds) -> DataFrame:
    """split, episode_index of every episode of every split."""
    parts = [
        spark.range(start, end).select(F.lit(name).alias("split"), F.col("id").alias("episode_index"))
        for name, start, end in bounds
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def episode_status(requested: DataFrame, issues: DataFrame, policy: str) -> DataFrame:
    """split, episode_index, valid, kept for every requested episode."""
    check_policy(policy)
    dirty = dirty_episodes(issues, ["split"]).withColumn("dirty", F.lit(True))
    valid = F.col("dirty").isNull()
    kept = valid if policy == "drop" else F.lit(True)
    return requested.join(dirty, ["split", "episode_index"], "left").select(
        "split", "episode_index", valid.alias("valid"), kept.alias("kept")
    )


def split_summary(status: DataFrame, policy: str) -> DataFrame:
    """One row per split: counts, the requested range, and the action taken.

    Lists stay in long form (``episode_status``): requested episodes are the range itself.
    """
    check_policy(policy)
    invalid = F.count_if(~F.col("valid"))
    action = F.when(invalid > 0, K.POLICY_ACTIONS[policy]).otherwise(K.NO_ACTION)
    return status.groupBy("split").agg(
        F.count(F.lit(1)).alias("requested_episode_count"),
        F.min("episode_index").alias("first_requested"),
        F.max("episode_index").alias("last_requested"),
        invalid.alias("invalid_episode_count"),
        F.count_if("kept").alias("kept_episode_count"),
        action.alias("action_taken"),
    )
