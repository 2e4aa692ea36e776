"""Pairs of successive steps, the input of a dynamics model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.operators.ordering import CROWD, ONE_WINDOW, RANGE_BITS, scan


def transitions(
    steps: DataFrame,
    group: Sequence[str] = (),
    order: str | Sequence[str] = "frame_index",
    bits: Sequence[int] = RANGE_BITS,
    one_window: int = ONE_WINDOW,
    crowd: int = CROWD,
) -> DataFrame:
    """group, episode_index, frame_index, state, action, next_frame, next_state of every step but the last of its episode.

    The next step is the one that follows in ``order``, whatever its number. It is looked up by ``scan``: inside a range
    of the order, or else as the first step of the next range, so a long episode is many ranges.
    """
    who = [*group, "episode_index"]
    rows = steps.select(*dict.fromkeys([*who, "frame_index", "state", "action", *([order] if isinstance(order, str) else order)]))
    following = {"next_frame": F.col("frame_index"), "next_state": F.col("state"), "followed": F.lit(True)}
    paired = scan(rows, order, who, leads=following, bits=bits, one_window=one_window, crowd=crowd)
    return paired.where("followed").select(*who, "frame_index", "state", "action", "next_frame", "next_state")
