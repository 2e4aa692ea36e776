"""Episode quality checks on source steps, and the policies that act on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodica.functions import fixed as K
from episodica.operators.ordering import CROWD, ONE_WINDOW, RANGE_BITS, STEP_ORDER
from episodica.operators.ordering import in_order, materialised, order_list, ordered, range_order, ranges_of, scan, sort_key, tied


def runs(
    steps: DataFrame,
    group: Sequence[str] = (),
    order: str | Sequence[str] = STEP_ORDER,
    bits: Sequence[int] = RANGE_BITS,
    one_window: int = ONE_WINDOW,
    crowd: int = CROWD,
) -> DataFrame:
    """Gaps and islands: one row per maximal run of rows with the same episode, in ``order``.

    The steps are read twice: for the number of rows in each range of the order, and to fold each range into
    pieces (one bounded window each), which are written. Pieces that touch a range border are then joined up
    through the table of ranges. Columns: group, episode_index, run_start, run_end (both in the first order
    column), n_rows, first_step, step_gap, last_done, n_done, again (the episode already had an earlier run).
    """
    group, order = list(group), order_list(order)
    done = F.coalesce(F.col("done"), F.lit(False)).alias("done")
    rows = steps.select(*group, *dict.fromkeys([*order, "episode_index", "frame_index"]), done)
    rows, _, _ = ranges_of(rows, order, group, [], "rng", bits[0], crowd)
    rows = rows.withColumns({"pos": F.col(order[0]), "at": sort_key(order), "step": F.col("frame_index")})
    key = [*group, "rng"]

    w = Window.partitionBy(*key).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.coalesce(F.col("prev_ep") != F.col("episode_index"), F.lit(True))
    pieces, _ = materialised(
        rows.withColumns({"prev_ep": F.lag("episode_index").over(w), "prev_step": F.lag("step").over(w), "tie": tied(w, order)})
        .withColumn("opens", in_order(opens, F.col("tie"), order))
        .withColumn("piece", F.sum(F.col("opens").cast("int")).over(so_far))
        .groupBy(*key, "piece", "episode_index")
        .agg(
            F.min("pos").alias("start"),
            F.max("pos").alias("end"),
            F.count(F.lit(1)).alias("n_rows"),
            F.min_by("step", "at").alias("first_step"),
            F.max_by("step", "at").alias("last_step"),
            F.max_by("done", "at").alias("last_done"),
            F.count_if("done").alias("n_done"),
            F.bool_or(~F.col("opens") & (F.col("step") != F.col("prev_step") + 1)).alias("gap"),
        )
    )

    ranges = pieces.groupBy(*key).agg(
        F.min_by("episode_index", "piece").alias("head_ep"),
        F.max_by("episode_index", "piece").alias("tail_ep"),
        F.max_by("last_step", "piece").alias("tail_step"),
        F.max("piece").alias("n_pieces"),
    )
    ranges, n_ranges = materialised(ranges)
    ranges, range_keys = range_order(ranges, "rng")
    across = {"order": range_keys, "group": group, "bits": bits[1:], "one_window": one_window}
    ranges = ordered(
        ranges,
        n_ranges,
        lags={"before_ep": F.col("tail_ep"), "before_step": F.col("tail_step")},
        **across,
    ).withColumn("continues", F.coalesce(F.col("before_ep") == F.col("head_ep"), F.lit(False)))
    ranges = ordered(
        ranges,
        n_ranges,
        maxima={"open_since": F.when((F.col("n_pieces") > 1) | ~F.col("continues"), F.col("rng"))},
        **across,
    ).select(*key, "n_pieces", "before_step", "continues", "open_since")

    continued = (F.col("piece") == 1) & F.col("continues")
    last = F.col("piece") == F.col("n_pieces")
    whole = (
        pieces.join(ranges, key)
        .select(
            *group,
            "episode_index",
            # The run's home: the range where it opened. One run at most leaves a range (number 0).
            F.when(continued, F.col("open_since")).otherwise(F.col("rng")).alias("home"),
            F.when(continued | last, 0).otherwise(F.col("piece")).alias("number"),
            "rng",
            "piece",
            "start",
            "end",
            "n_rows",
            "first_step",
            "last_done",
            "n_done",
            (F.col("gap") | (continued & (F.col("first_step") != F.col("before_step") + 1))).alias("gap"),
        )
        .groupBy(*group, "episode_index", "home", "number")
        .agg(
            F.min("start").alias("run_start"),
            F.max("end").alias("run_end"),
            F.sum("n_rows").alias("n_rows"),
            F.min_by("first_step", F.struct("rng", "piece")).alias("first_step"),
            F.bool_or("gap").alias("step_gap"),
            F.max_by("last_done", F.struct("rng", "piece")).alias("last_done"),
            F.sum("n_done").alias("n_done"),
        )
        .drop("home", "number")
    )
    # Joined on the run's own start, which is unique in its episode (rows of one value lie together by episode), so
    # a hot episode does not skew the join.
    opening = (
        pieces.groupBy(*group, "episode_index").agg(F.min("start").alias("run_start")).withColumn("opening", F.lit(True))
    )
    return (
        whole.join(opening, [*group, "episode_index", "run_start"], "left")
        .withColumn("again", F.col("opening").isNull())
        .drop("opening")
    )


def source_issues(
    steps: DataFrame,
    group: Sequence[str] = (),
    require_terminal_done: bool = True,
    require_no_early_done: bool = True,
    require_contiguous_steps: bool = True,
    order: str | Sequence[str] = STEP_ORDER,
    bits: Sequence[int] = RANGE_BITS,
    one_window: int = ONE_WINDOW,
    crowd: int = CROWD,
) -> DataFrame:
    """One row per message: group, episode_index, run_start, seq, message.

    Messages of an episode are ordered by (run_start, seq). Clean episodes yield no row.
    """
    found = runs(steps, group, order, bits, one_window, crowd)
    return run_issues(found, group, require_terminal_done, require_no_early_done, require_contiguous_steps)


def run_issues(
    found: DataFrame,
    group: Sequence[str] = (),
    require_terminal_done: bool = True,
    require_no_early_done: bool = True,
    require_contiguous_steps: bool = True,
) -> DataFrame:
    """The messages of ``source_issues`` from the runs of the steps."""
    early = F.col("n_done") > F.when(F.col("last_done"), 1).otherwise(0)
    checks = [(0, F.col("again"), F.lit(K.NOT_CONTIGUOUS))]
    if require_contiguous_steps:
        checks.append((1, F.col("first_step") != 0, F.format_string(K.STARTS_AT, F.col("first_step"))))
        checks.append((2, F.col("step_gap"), F.lit(K.STEP_GAP)))
    if require_terminal_done:
        checks.append((3, ~F.col("last_done"), F.lit(K.NOT_TERMINATED)))
    if require_no_early_done:
        checks.append((4, early, F.lit(K.EARLY_DONE)))
    cells = [F.when(bad, F.struct(F.lit(seq).alias("seq"), text.alias("message"))) for seq, bad, text in checks]
    return found.select(*group, "episode_index", "run_start", F.inline(F.array_compact(F.array(*cells))))


def issue_lists(
    issues: DataFrame,
    group: Sequence[str] = (),
    part_size: int = 1000,
    bits: Sequence[int] = RANGE_BITS,
    one_window: int = ONE_WINDOW,
    crowd: int = CROWD,
) -> DataFrame:
    """Messages of each episode as ordered arrays: group, episode_index, part, issues.

    An ordinary episode has one row (part 0). One with more than ``part_size`` messages goes on
    in further parts, so that no array grows with the data and nothing is cut off. Messages are numbered by
    ``scan``, so an episode with most of the messages is many ranges, and if these are too many, ranges of ranges.
    """
    who = [*group, "episode_index"]
    numbered = scan(issues, ("run_start", "seq"), who, position="ordinal", bits=bits, one_window=one_window, crowd=crowd)
    return (
        numbered.withColumn("part", F.expr(f"ordinal div {int(part_size)}"))
        .groupBy(*who, "part")
        .agg(F.array_sort(F.collect_list(F.struct("ordinal", "message"))).getField("message").alias("issues"))
    )


def dirty_episodes(issues: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Distinct episodes that have at least one message."""
    return issues.select(*group, "episode_index").distinct()


def drop_dirty(steps: DataFrame, issues: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Rows of episodes without a message."""
    return steps.join(dirty_episodes(issues, group), [*group, "episode_index"], "left_anti")


def check_policy(policy: str) -> None:
    if policy not in K.DIRTY_POLICIES:
        raise ValueError(f"Unknown dirty-episode policy {policy!r}; use one of {K.DIRTY_POLICIES}.")


class DirtyEpisodes(RuntimeError):
    """Raised by the policy ``fail`` when there are dirty episodes, and when nothing is left."""


def apply_policy(steps: DataFrame, issues: DataFrame, policy: str, group: Sequence[str] = ()) -> DataFrame:
    """fail: raise if any message exists. drop: remove dirty episodes. warn: keep all."""
    check_policy(policy)
    if policy == "warn":
        return steps
    if policy == "fail":
        if not issues.isEmpty():
            raise DirtyEpisodes("There are dirty episodes and the policy is 'fail'.")
        return steps
    return drop_dirty(steps, issues, group)
