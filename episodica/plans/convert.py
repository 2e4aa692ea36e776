"""Convert: raw dataset -> checked, indexed, aligned training store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from episodica.functions import fixed as K
from episodica.operators.episodes import episode_table, lengths
from episodica.operators.frames import FRAME_BATCH, Decoder, Opener, attach_frames, decode, frame_rows, read_file
from episodica.operators.ordering import dropping_tables, materialised, row_position, scan, setting
from episodica.operators.quality import DirtyEpisodes, check_policy, issue_lists, run_issues, runs
from episodica.operators.splits import assign_splits, fan_out, resolve_cameras
from episodica.operators.summary import episode_status, requested_episodes, split_summary
from episodica.sources.reports import write_conversion_report
from episodica.sources.steps import canonical_steps, no_key, read_episodes, read_info, read_steps, read_videos
from episodica.sources.store import BLOCK_BYTES, DECODER, OPENS, block_bits, check_compression, produced, store_rows, with_proprio, write_store

# Episodes whose offsets are sent to every executor (about 50 bytes each); a longer table is joined by a shuffle.
LISTED_EPISODES = 500_000
# Videos that one task opens if their sizes aren't known; else most files, or bytes of an average task; and most tasks.
FILES_A_TASK, SMALL_FILES_A_TASK, BYTES_A_TASK, MOST_TASKS = 16, 512, 1 << 23, 100_000


def convert(
    spark: SparkSession,
    root: str,
    out: str,
    repo_id: str,
    decoders: Sequence[tuple[str, Decoder]],
    splits: Sequence[str] = (),
    cameras: Sequence[str] = (),
    image_size: int | None = None,
    compression: str = "lzf",
    overwrite: bool = False,
    require_terminal_done: bool = True,
    policy: str = "fail",
    batch: int = FRAME_BATCH,
    videos: DataFrame | None = None,
    report: str | None = None,
    opener: Opener = read_file,
) -> DataFrame:
    """Run the whole job and return the split summary. The report is written on failure too.

    ``videos`` (episode_index, camera, optional frame_offset, and path or content) replaces the files that are
    found below the root by their names. Files are opened by ``opener`` (path -> bytes) in the task that decodes
    them. The job has a session of its own, so its settings reach no other query, and deletes its intermediate tables.
    """
    check_policy(policy)
    check_compression(compression)
    if image_size is not None and image_size <= 0:
        raise ValueError(f"image size must be positive, got {image_size}.")
    if batch <= 0:
        raise ValueError(f"batch must be positive, got {batch}.")
    spark = own_session(spark)
    with dropping_tables(spark):
        return _convert(spark, root, out, repo_id, decoders, splits, cameras, image_size, compression, overwrite, require_terminal_done, policy, batch, videos, report, opener)


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings, in which a join uses sides that are spread by some of its keys."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def _convert(
    spark, root, out, repo_id, decoders, splits, cameras, image_size, compression, overwrite, require_terminal_done, policy, batch, videos, report, opener
) -> DataFrame:
    info = read_info(spark, root)
    bounds = info.bounds(splits)
    cameras = resolve_cameras(list(info.cameras), cameras)
    options = {
        "dirty_episode_policy": policy,
        "require_terminal_done": require_terminal_done,
        "compression": compression,
        "image_size": image_size if image_size is not None else "native",
        "micro_batch_size": batch,
        "camera_keys": ",".join(cameras),
        "decoders": ",".join(name for name, _ in decoders),
    }

    source = canonical_steps(read_steps(spark, root, K.SOURCE_COLUMNS))
    steps = assign_splits(source, bounds)
    keys = Observation()
    found = runs(steps.observe(keys, F.count_if(no_key()).alias("n_null")), ["split"])
    if keys.get["n_null"]:
        raise ValueError("frame_index and index must not be null in the chosen splits.")
    found, _ = materialised(found)

    issues, n_issues = materialised(run_issues(found, ["split"], require_terminal_done))
    status, _ = materialised(episode_status(requested_episodes(spark, bounds), issues, policy))
    rows = split_summary(status, policy)
    summary = spark.createDataFrame(rows.collect(), rows.schema)

    def write_report(state: str, files: DataFrame | None = None) -> None:
        if report is not None:
            messages = issue_lists(issues, ["split"])
            detailed = status.join(messages, ["split", "episode_index"], "left")
            write_conversion_report(summary, detailed, report, repo_id, state, options, files)

    if n_issues and policy == "fail":
        write_report("failed")
        raise DirtyEpisodes("There are dirty episodes and the policy is 'fail'; see the report.")
    kept_per_split = {r.split: r.kept_episode_count for r in summary.collect()}
    empty = [name for name, _, _ in bounds if not kept_per_split.get(name)]
    if empty:
        write_report("failed")
        raise DirtyEpisodes(f"No episodes are left in splits {empty}.")

    kept = status.where("kept").select("split", "episode_index")
    table, n_episodes = materialised(episode_table(lengths(read_episodes(spark, root), kept)))
    n_rows, in_place = check_totals(found, table)
    rows = fan_out(with_proprio(store_rows(positioned(steps, table, n_episodes, in_place))), cameras)

    files = read_videos(spark, root).drop("content") if videos is None else videos
    located = locate(fan_out(table.where("ep_len > 0"), cameras), files)
    frames = frame_rows(decode(located, decoders, image_size, expected="expected", fail_short=True, batch=batch, opener=opener))
    size = frame_size(info.cameras, cameras, image_size)
    n_tasks = store_tasks(n_rows * len(cameras), size, spark.sparkContext.defaultParallelism)
    laid_out = attach_by_block(rows, frames, block_bits(size), n_tasks, [name for name, _ in decoders])
    named = attributes(spark, repo_id, info.fps, [b[0] for b in bounds], cameras)
    written = write_store(laid_out, table, named, out, "overwrite" if overwrite else "error", compression)
    write_report("ok", produced(spark, out, written))
    return summary


def check_totals(found: DataFrame, table: DataFrame) -> tuple[int, bool]:
    """Every split has rows, as many as its episode table declares: how many rows, and whether they lie in place.

    ``found`` are the runs of the steps. Rows lie in place if in every split the episodes follow each other by
    number, each in one run of frames 0, 1, 2, ... as long as declared; then a row's position is the offset of its
    episode plus its frame number, and no scan over the rows is needed to find it.
    """
    per_episode = found.groupBy("split", "episode_index").agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("run_start").alias("start"),
        F.max("run_end").alias("end"),
        ((F.count(F.lit(1)) == 1) & (F.min("first_step") == 0) & ~F.bool_or("step_gap")).alias("regular"),
    )
    joined = table.join(per_episode, ["split", "episode_index"], "left")
    followed = scan(joined, "ep_pos", ["split"], maxima={"before": F.col("end")})
    ordered = F.coalesce(F.col("before") <= F.col("start"), F.lit(True))
    fits = F.coalesce(F.col("regular") & (F.col("n_rows") == F.col("ep_len")), F.col("n_rows").isNull() & (F.col("ep_len") == 0))
    per_split = followed.groupBy("split").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("actual"),
        F.sum("ep_len").alias("declared"),
        F.count_if(F.col("ep_len").isNull()).alias("unknown"),
        F.bool_and(F.coalesce(ordered & fits, F.lit(False))).alias("in_place"),
    )
    totals = per_split.collect()
    for r in totals:
        if r.unknown:
            raise KeyError(f"{r.unknown} episodes of split {r.split!r} have no metadata.")
        if not r.actual:
            raise RuntimeError(f"Split {r.split!r} has no frames.")
        if r.actual != r.declared:
            raise RuntimeError(f"Split {r.split!r} has {r.actual} rows, but its episodes declare {r.declared}.")
    return sum(r.actual for r in totals), all(r.in_place for r in totals)


def positioned(steps: DataFrame, table: DataFrame, n_episodes: int, in_place: bool) -> DataFrame:
    """The steps of the episodes of ``table`` with their row in the store: by one join, or by a scan if they aren't in place."""
    key = ["split", "episode_index"]
    offsets = table.select(*key, "ep_offset")
    offsets = F.broadcast(offsets) if n_episodes <= LISTED_EPISODES else offsets
    if in_place:
        return steps.join(offsets, key).withColumn("row", F.col("ep_offset") + F.col("frame_index")).drop("ep_offset")
    return row_position(steps.join(offsets, key, "left_semi"), group=["split"])


def locate(wanted: DataFrame, files: DataFrame, files_a_task: int | None = None) -> DataFrame:
    """Wanted (split, episode, camera) rows with their file; raises if a file is missing or not the only one.

    Both are matched on names in Spark. Files known by their path are only named here: the rows are dealt to tasks of
    about ``files_a_task`` files, which open them; without it, of 16 files, or as many of at most 512 as come to 8 MB if
    ``files`` has their sizes. Files that come with their content are joined to it.
    """
    key = ["episode_index", "camera"]
    sized = "file_bytes" in files.columns and files_a_task is None and "content" not in files.columns
    size = [F.sum("file_bytes").alias("n_bytes")] if sized else []
    also = [c for c in ("path", "frame_offset") if c in files.columns]
    per = files.select(*key, *also, *(["file_bytes"] if sized else [])).groupBy(*key).agg(F.count(F.lit(1)).alias("n_files"), *[F.first(c).alias(c) for c in also], *size)
    # Names only: a file is no work, so a task takes some thousands of them.
    with setting(files.sparkSession, "spark.sql.files.openCostInBytes", "65536"):
        found, n = materialised(wanted.join(per, key, "left"))
    for wrong, error, text in (
        ("n_files is null", FileNotFoundError, "Episodes without a video"),
        ("n_files > 1", ValueError, "Episodes with several videos of one camera"),
    ):
        some = found.where(wrong).select(*key).limit(3).collect()
        if some:
            raise error(f"{text}, such as {[tuple(r) for r in some]}.")
    skipped = F.coalesce("frame_offset", F.lit(0)) if "frame_offset" in also else F.lit(0)
    found = found.drop("n_files").withColumn("expected", F.col("ep_len") + skipped)
    if "content" in files.columns:
        return found.join(files.select(*key, "content"), key)
    if not sized:
        n_tasks = -(-n // (files_a_task or FILES_A_TASK))
    else:
        n_bytes = found.agg(F.sum("n_bytes")).first()[0] or 0
        n_tasks = max(-(-n // SMALL_FILES_A_TASK), min(-(-n // FILES_A_TASK), -(-n_bytes // BYTES_A_TASK), MOST_TASKS))
        # Twice what the cluster runs at once, if there are that many files.
        n_tasks = max(n_tasks, min(-(-n // FILES_A_TASK), 2 * found.sparkSession.sparkContext.defaultParallelism))
        found = found.drop("n_bytes")
    return found.repartition(min(MOST_TASKS, max(1, n_tasks)), *key)


def frame_size(shapes: Mapping[str, tuple[int, ...]], cameras: Sequence[str], image_size: int | None) -> int:
    """Bytes of the largest stored frame."""
    sizes = [(image_size or h or 1, image_size or w or 1, c or 3) for h, w, c in (shapes[k] for k in cameras)]
    return max(h * w * c for h, w, c in sizes)


def store_tasks(n_rows: int, frame_bytes: int, parallelism: int) -> int:
    """Tasks that write a store: about one block of pixels each, and no fewer than the cluster runs at once."""
    return min(MOST_TASKS, max(parallelism, -(-n_rows * frame_bytes // BLOCK_BYTES)))


def attach_by_block(rows: DataFrame, frames: DataFrame, bits: int, n_tasks: int, decoders: Sequence[str]) -> DataFrame:
    """Join rows and frames in the layout of the store, so that pixels are shuffled once.

    Both sides are spread by (split, camera, block of rows), which is also how the writer lays
    out its files; a block has a fixed number of rows, so no episode or store is a hot spot.
    It needs the session of ``own_session``. Decoder and first frame of a video go along for the writer to count.
    """
    keys = ["split", "camera"]
    block = F.shiftright("row", bits).alias("block")
    left = rows.select("*", block).repartition(n_tasks, *keys, "block")
    shown = frames.select(*keys, "row", "pixels", DECODER, (F.col("row") == F.col("ep_offset")).alias(OPENS), block)
    joined = attach_frames(left, shown.repartition(n_tasks, *keys, "block"), [*keys, "block"], ["pixels", DECODER, OPENS])
    return joined.withMetadata(DECODER, {"names": list(dict.fromkeys(decoders))})


def attributes(spark: SparkSession, repo_id: str, fps: int, splits: Sequence[str], cameras: Sequence[str]) -> DataFrame:
    rows = [(repo_id, s, c, fps, "episodica.convert", False, s, c) for s in splits for c in cameras]
    return spark.createDataFrame(rows, K.ATTRIBUTES_SCHEMA).drop("complete")
