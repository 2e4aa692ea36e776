"""One query per operator over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as X
from episodica.functions import names, scalars
from episodica.operators import episodes, frames, nearest, quality, signals, slices, splits, store_checks, summary, transitions
from episodica.operators.ordering import materialised, row_position, spooled
from episodica.plans.check import check_stores
from episodica.plans.convert import attributes, convert, locate
from episodica.plans.replay import replay
from episodica.sources import steps as source
from episodica.sources import store
from episodica.sources.reports import read_report

STORE = ["split", "camera"]


def longs(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


# --- text decoder used by the decode queries -------------------------------------------------


def text_frames(content: bytes):
    """8 x 8 one-channel frames of the bytes of a text."""
    side = 64
    for at in range(0, len(content), side):
        yield np.frombuffer(content[at : at + side].ljust(side), np.uint8).reshape(8, 8, 1)


def lower_case_only(content: bytes):
    """A decoder that cannot open texts that begin with an ASCII capital."""
    if content[:1].isupper():
        raise ValueError("capital")
    return text_frames(content)


DECODERS = [("lower", lower_case_only), ("any", text_frames)]


# --- quality -------------------------------------------------------------------------------


def _issues(view):
    def run(spark, sf_dir):
        return longs(quality.source_issues(view(spark, sf_dir)), "seq")

    return run


def _issue_lists(view):
    def run(spark, sf_dir):
        lists = quality.issue_lists(quality.source_issues(view(spark, sf_dir)), part_size=20)
        return lists.select("episode_index", "part", F.array_join("issues", "; ").alias("issues"))

    return run


def check_counts(spark, sf_dir):
    """Episodes with at least one message of each kind, per view."""
    out = None
    for name, view in (("conv", X.conv_steps), ("line", X.line_steps), ("event", X.event_steps)):
        found = quality.source_issues(view(spark, sf_dir)).select("episode_index", "seq").distinct()
        counted = found.groupBy("seq").agg(F.count(F.lit(1)).alias("episodes")).withColumn("view", F.lit(name))
        out = counted if out is None else out.unionByName(counted)
    return longs(out, "seq")


def runs(spark, sf_dir):
    return quality.runs(X.line_steps(spark, sf_dir))


def runs_interleaved(spark, sf_dir):
    return quality.runs(X.event_steps(spark, sf_dir))


def without_terminal(spark, sf_dir):
    return longs(quality.source_issues(X.line_steps(spark, sf_dir), require_terminal_done=False), "seq")


def drop_dirty(spark, sf_dir):
    steps = X.line_steps(spark, sf_dir)
    return quality.apply_policy(steps, quality.source_issues(steps), "drop").select(
        "episode_index", "frame_index", "done", "index"
    )


def warn_policy(spark, sf_dir):
    steps = X.line_steps(spark, sf_dir)
    kept = quality.apply_policy(steps, quality.source_issues(steps), "warn")
    return kept.groupBy((F.col("episode_index") % 10).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def _status(spark, sf_dir, policy="drop"):
    bounds = X.bounds(spark, sf_dir)
    steps = splits.assign_splits(X.line_steps(spark, sf_dir), bounds)
    issues = quality.source_issues(steps, ["split"])
    return summary.episode_status(summary.requested_episodes(spark, bounds), issues, policy)


def split_summary(spark, sf_dir):
    return summary.split_summary(_status(spark, sf_dir), "drop")


def split_summary_warn(spark, sf_dir):
    return summary.split_summary(_status(spark, sf_dir, "warn"), "warn")


def episode_status(spark, sf_dir):
    return _status(spark, sf_dir)


# --- splits --------------------------------------------------------------------------------


def parse_range(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 11 == 3, F.col("o_orderkey").cast("string"))
        .when(F.col("o_orderkey") % 11 == 5, F.concat(F.col("o_orderkey"), F.lit(":x")))
        .when(F.col("o_orderkey") % 11 == 7, F.concat(F.lit(":"), F.col("o_orderkey")))
        .otherwise(
            F.concat(F.col("o_orderkey") - 2, F.lit(":"), F.col("o_orderkey") + F.col("o_custkey") % 7 - F.lit(4))
        )
        .alias("spec"),
    )
    total = F.lit(math.floor(X.table(spark, sf_dir, "orders").count() * 0.9))
    return orders.withColumns(splits.range_columns(F.col("spec"), total))


def select_split(spark, sf_dir):
    bounds = X.bounds(spark, sf_dir)
    lines = X.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_index"), "l_quantity")
    out = None
    for name, _, _ in bounds:
        part = splits.select_split(lines, bounds, name).agg(
            F.count(F.lit(1)).alias("n"), F.min("episode_index").alias("low"), F.max("episode_index").alias("high")
        )
        part = part.withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def assign_splits(spark, sf_dir):
    """The usual splits and one that overlaps all of them."""
    bounds = X.bounds(spark, sf_dir)
    n = bounds[-1][2]
    with_overlap = [*bounds, ("half", n // 4, n // 4 * 3)]
    return splits.assign_splits(X.line_steps(spark, sf_dir), with_overlap).select("split", "episode_index", "index")


def camera_fan_out(spark, sf_dir):
    return splits.fan_out(X.clean_steps(spark, sf_dir), X.CAMERAS).select("camera", "episode_index", "frame_index", "index")


# --- episodes ------------------------------------------------------------------------------


def row_positions(spark, sf_dir):
    return row_position(X.line_steps(spark, sf_dir)).select("episode_index", "index", "row")


def row_positions_per_split(spark, sf_dir):
    steps = splits.assign_splits(X.line_steps(spark, sf_dir), X.bounds(spark, sf_dir))
    return row_position(steps, group=["split"]).select("split", "episode_index", "index", "row")


def row_positions_repeated(spark, sf_dir):
    """Positions where a third of all rows share one order value; ranges of more than 1,000 rows are cut further."""
    return row_position(X.repeated_steps(spark, sf_dir), crowd=1000).select("episode_index", "frame_index", "index", "row")


def runs_repeated(spark, sf_dir):
    return quality.runs(X.repeated_steps(spark, sf_dir), crowd=1000)


def step_transitions(spark, sf_dir):
    """Successive steps of every episode; ranges of two frames, so that most pairs lie across a border."""
    pairs = transitions.transitions(X.line_steps(spark, sf_dir), bits=(1, 20, 20))
    vectors = [("state", 4), ("next_state", 4), ("action", 2)]
    cells = [F.get(n, F.lit(i)).cast("double").alias(f"{n}_{i}") for n, size in vectors for i in range(size)]
    return pairs.select("episode_index", "frame_index", "next_frame", *cells)


def goal_topk(spark, sf_dir):
    """The 10 nearest vectors of every hundredth one."""
    rows = X.table(spark, sf_dir, "embeddings")
    goals = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("goal_id"), F.col("embedding").alias("goal"))
    return nearest.goal_topk(rows, goals, 10).withColumn("distance", F.round("distance", 6))


def normalise_channels(spark, sf_dir):
    rows = X.pixel_rows(spark, sf_dir).select("vec_id", "copy", frames.normalise_values(F.col("values")).alias("b"))
    three = F.concat("b", F.reverse("b"), F.col("b"))
    return rows.select("vec_id", "copy", F.posexplode(frames.normalise_channels(three)).alias("pos", "value")).select(
        "vec_id", "copy", F.col("pos").cast("long").alias("pos"), F.round("value", 9).alias("value")
    )


def lengths_declared(spark, sf_dir):
    return episodes.lengths(X.episodes_meta(spark, sf_dir))


def lengths_from_bounds(spark, sf_dir):
    """Lengths from first and last row positions; the length column must not be used."""
    per_order = row_position(X.clean_steps(spark, sf_dir)).groupBy("episode_index").agg(
        F.min("row").alias("dataset_from_index"), (F.max("row") + 1).alias("dataset_to_index"), F.lit(-1).alias("length")
    )
    return episodes.lengths(per_order)


def episode_offsets(spark, sf_dir):
    return X.line_index(spark, sf_dir)


def episode_metadata(spark, sf_dir):
    """Declared length of every episode that has lines, and of one beyond each hundredth order."""
    wanted = X.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") + 50).alias("episode_index")).distinct()
    return episodes.lengths(X.episodes_meta(spark, sf_dir), wanted)


def missing_metadata(spark, sf_dir):
    wanted = X.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") + 50).alias("episode_index")).distinct()
    return episodes.without_metadata(wanted, X.episodes_meta(spark, sf_dir))


def reconcile(spark, sf_dir):
    return episodes.reconcile(X.clean_steps(spark, sf_dir), X.episodes_meta(spark, sf_dir))


# --- stores --------------------------------------------------------------------------------


def assign_slices(spark, sf_dir):
    """Rows with the slices of a broken index: overlaps, gaps, bounds beyond the end."""
    rows = X.line_rows(spark, sf_dir).select("split", "row", "episode_idx")
    n_rows, _ = materialised(rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows")))
    index = X.bad_index(spark, sf_dir).join(n_rows, "split")
    return slices.assign_slices(rows, index, "n_rows").select("split", "ep_pos", "row", "episode_idx")


def validate_clean(spark, sf_dir):
    rows, index = X.line_tables(spark, sf_dir)
    rows = splits.fan_out(rows, X.CAMERAS)
    return store_checks.verdicts(rows.select(*STORE).distinct(), store_checks.validate(rows, index))


def validate_bad(spark, sf_dir):
    return longs(store_checks.validate(*X.bad_tables(spark, sf_dir)), "check")


def validate_not_strict(spark, sf_dir):
    found = store_checks.validate(*X.bad_tables(spark, sf_dir), strict_done=False)
    return longs(found.groupBy(*STORE, "check").agg(F.count(F.lit(1)).alias("n")), "check")


def validate_missing(spark, sf_dir):
    rows = X.line_store(spark, sf_dir).drop("proprio", "timestamp")
    return longs(store_checks.validate(rows, X.line_index(spark, sf_dir).drop("ep_offset")), "check")


def any_error(spark, sf_dir):
    rows, index = X.bad_tables(spark, sf_dir)
    found = store_checks.validate(rows, index)
    return store_checks.any_error(store_checks.verdicts(rows.select(*STORE).distinct(), found))


def inspect_declared(spark, sf_dir):
    return store_checks.inspect(X.bad_store(spark, sf_dir), X.bad_index(spark, sf_dir))


def inspect_rows(spark, sf_dir):
    return store_checks.inspect(X.line_store(spark, sf_dir))


def inspect_columns(spark, sf_dir):
    return store_checks.inspect_columns(X.bad_store(spark, sf_dir), X.line_index(spark, sf_dir))


def written(spark, sf_dir, tables=None):
    """Root of a new store written from the lines."""
    root = f"{X.scratch(spark)}/store"
    bounds = X.bounds(spark, sf_dir)
    rows, index = tables or X.line_tables(spark, sf_dir)
    named = attributes(spark, "tables/lineitem", 10, [b[0] for b in bounds], X.CAMERAS)
    store.write_store(splits.fan_out(rows, X.CAMERAS), index, named, root, in_order=True)
    return root


def written_store(spark, sf_dir):
    back = store.read_store(spark, written(spark, sf_dir))
    return back.select(
        *STORE,
        "row",
        "episode_idx",
        "step_idx",
        "done",
        F.col("timestamp").cast("double").alias("timestamp"),
        "index",
        "task_index",
        F.get("action", F.lit(0)).cast("double").alias("action_0"),
        F.get("proprio", F.lit(1)).cast("double").alias("proprio_1"),
        F.get("state", F.lit(3)).cast("double").alias("state_3"),
        F.hex("pixels.data").alias("colour"),
    )


def written_episode_table(spark, sf_dir):
    return store.read_episode_table(spark, written(spark, sf_dir))


def cameras_apart(spark, sf_dir):
    """Two cameras of each split, written in two calls with different episodes: verdict and totals of each store."""
    root, names = f"{X.scratch(spark)}/store", [b[0] for b in X.bounds(spark, sf_dir)]
    steps = X.split_cells(spark, sf_dir)
    for camera, kept in zip(X.CAMERAS, (steps, steps.where("episode_index % 3 <> 0"))):
        rows = store.store_rows(X.full_steps(row_position(kept, group=["split"])))
        one = F.lit(1)
        frame = F.struct(*[one.alias(n) for n in ("height", "width", "channels")], F.lit(b"x").alias("data"))
        rows = splits.fan_out(store.with_proprio(rows).withColumn("pixels", frame), [camera])
        index = episodes.episode_table(spooled(episodes.step_counts(kept, ["split"]))[0])
        store.write_store(rows, index, attributes(spark, "tables/lineitem", 10, names, [camera]), root, in_order=True)
    verdicts = check_stores(spark, root, fail_on_error=False)[0]
    return verdicts.join(check_stores(spark, root, mode="inspect")[0], STORE)


def stored_without_action(spark, sf_dir):
    """Messages about stores on disk whose files have no actions."""
    root, names = f"{X.scratch(spark)}/store", [b[0] for b in X.bounds(spark, sf_dir)]
    rows, index = X.line_tables(spark, sf_dir)
    rows = splits.fan_out(rows, X.CAMERAS).drop("action")
    store.write_store(rows, index, attributes(spark, "tables/lineitem", 10, names, X.CAMERAS), root, in_order=True)
    return longs(check_stores(spark, root, fail_on_error=False)[1], "check")


def stored_without_index(spark, sf_dir):
    """Totals of stores on disk that have no episode table: they come from the rows."""
    root, names = f"{X.scratch(spark)}/store", [b[0] for b in X.bounds(spark, sf_dir)]
    rows, index = X.line_tables(spark, sf_dir)
    rows, nothing = splits.fan_out(rows, X.CAMERAS[1:]), index.where("ep_pos < 0")
    store.write_store(rows, nothing, attributes(spark, "tables/lineitem", 10, names, X.CAMERAS[1:]), root, verify=False, in_order=True)
    return check_stores(spark, root, mode="inspect")[0]


def written_attributes(spark, sf_dir):
    """Stores found below the root with their attributes and number of rows."""
    root = written(spark, sf_dir)
    n = store.read_store(spark, root).groupBy(*STORE).agg(F.count(F.lit(1)).alias("n_rows"))
    found = store.list_stores(spark, root).join(store.read_attributes(spark, root), STORE).join(n, STORE)
    return longs(found.drop("generated_by"), "fps")


def selected_episode(spark, sf_dir):
    root = written(spark, sf_dir)
    of_split, camera = store.select_store(store.list_stores(spark, root), "val", "observation_images_wrist")
    offset, length = store.episode_bounds(store.read_episode_table(spark, root), of_split, camera, 7)
    rows = store.select_episode(store.read_store(spark, root), of_split, camera, offset, length)
    return rows.select(*STORE, "row", "episode_idx", "step_idx", "ep_offset")


# --- sources -------------------------------------------------------------------------------


def raw_root(spark, sf_dir, view=None):
    """A raw dataset derived from the lines: steps, episode metadata and the info document."""
    root = X.scratch(spark)
    steps = (view or X.clean_steps)(spark, sf_dir)
    steps.withColumnsRenamed({"done": "next.done", "state": "observation.state"}).write.parquet(f"{root}/data")
    X.episodes_meta(spark, sf_dir).write.parquet(f"{root}/meta/episodes")
    n = X.table(spark, sf_dir, "orders").count()
    feature = {"dtype": "video", "shape": [8, 8, 3]}
    info = {
        "splits": {s: f"{a}:{b}" for s, a, b in X.bounds(spark, sf_dir)},
        "total_episodes": n,
        "fps": 10,
        "camera_keys": X.CAMERAS,
        "features": {c: feature for c in X.CAMERAS} | {"action": {"dtype": "float32", "shape": [2]}},
    }
    text = spark.createDataFrame([(json.dumps(info),)], "value string")
    text.coalesce(1).write.text(f"{root}/meta/info.json")
    return root


def read_steps(spark, sf_dir):
    root = raw_root(spark, sf_dir)
    steps = source.canonical_steps(source.read_steps(spark, root, source.K.SOURCE_COLUMNS))
    return steps.select(
        "episode_index",
        "frame_index",
        "done",
        F.col("timestamp").cast("double").alias("timestamp"),
        "index",
        "task_index",
        F.get("action", F.lit(1)).cast("double").alias("action_1"),
        F.get("state", F.lit(1)).cast("double").alias("state_1"),
    )


def read_steps_of_split(spark, sf_dir):
    root = raw_root(spark, sf_dir)
    info = source.read_info(spark, root)
    (name, start, end), *_ = info.bounds(["val"])
    steps = source.read_steps(spark, root, source.K.QUALITY_COLUMNS, episodes=(start, end))
    return source.canonical_steps(steps).withColumn("split", F.lit(name))


def dataset_info(spark, sf_dir):
    """Steps per split and camera as the info document names them."""
    root = raw_root(spark, sf_dir)
    info = source.read_info(spark, root)
    cameras = source.info_cameras(source.info_document(spark, root))
    steps = splits.assign_splits(source.read_steps(spark, root, ["episode_index"]), info.bounds())
    per = splits.fan_out(steps, list(info.cameras)).groupBy(*STORE).agg(F.count(F.lit(1)).alias("n_rows"))
    return per.join(cameras.withColumnRenamed("camera_key", "camera"), "camera")


def read_episode_metadata(spark, sf_dir):
    return source.read_episodes(spark, raw_root(spark, sf_dir))


def dataset_catalogue(spark, sf_dir):
    roots = {"tables/lines": raw_root(spark, sf_dir), "tables/events": raw_root(spark, sf_dir, X.event_steps)}
    return source.catalogue(source.read_many(spark, roots, ["episode_index", "frame_index"]))


def vector_dims(spark, sf_dir):
    ragged = X.line_steps(spark, sf_dir).withColumn(
        "state", F.when(F.col("episode_index") % 50 == 1, F.slice("state", 1, 3)).otherwise(F.col("state"))
    )
    return longs(source.vector_dims(ragged), "min_dim", "max_dim")


def flatten_vectors(spark, sf_dir):
    nested = X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.array(F.array("l_quantity", "l_discount"), F.array("l_tax", "l_extendedprice")).alias("m"),
    )
    flat = scalars.flatten_vector(F.col("m"), nested.schema["m"].dataType)
    single = scalars.flatten_vector(F.col("l_linenumber"), nested.schema["l_linenumber"].dataType)
    return nested.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.size(flat).cast("long").alias("n"),
        *[F.get(flat, F.lit(i)).cast("double").alias(f"x{i}") for i in range(4)],
        F.get(single, F.lit(0)).cast("double").alias("single"),
    )


# --- frames --------------------------------------------------------------------------------


def _frame_expectations(spark, sf_dir):
    """Declared rows per (episode, camera), and decoded frames: short, equal and long videos."""
    rank = F.when(F.col("camera") == X.CAMERAS[0], 0).otherwise(1)
    per = splits.fan_out(X.line_index(spark, sf_dir), X.CAMERAS).withColumn("expected", F.col("ep_len"))
    return per.withColumn("decoded", F.col("ep_len") + (F.col("episode_index") * 7 + rank) % 3 - 1)


def frame_count_issues(spark, sf_dir):
    per = _frame_expectations(spark, sf_dir)
    return frames.frame_count_issues(per, per.where("decoded > 0")).select(
        "split", "episode_index", "camera", "expected", "decoded"
    )


def frame_count_issues_strict(spark, sf_dir):
    per = _frame_expectations(spark, sf_dir)
    return frames.frame_count_issues(per, per.where("decoded > 0"), strict=True).select(
        "split", "episode_index", "camera", "expected", "decoded"
    )


def attach_frames(spark, sf_dir):
    """Frames of the videos above on the rows of the store; surplus frames are cut."""
    decoded = _frame_expectations(spark, sf_dir).where("decoded > 0").withColumn(
        "frame_pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("decoded") - 1))
    )
    shown = frames.frame_rows(decoded).withColumn("pixels", F.col("episode_index") * 1000 + F.col("frame_pos"))
    rows = X.line_store(spark, sf_dir).drop("pixels")
    return frames.attach_frames(rows, shown).select(*STORE, "row", "episode_idx", F.col("pixels").alias("frame"))


def normalise_values(spark, sf_dir):
    rows = X.pixel_rows(spark, sf_dir)
    return rows.select("vec_id", "copy", F.array_join(frames.normalise_values(F.col("values")), ",").alias("bytes"))


def normalise_pixels(spark, sf_dir):
    return frames.pixels_from_values(X.pixel_rows(spark, sf_dir)).select(
        "vec_id", "copy", F.col("pixels.channels").cast("long").alias("channels"), F.hex("pixels.data").alias("bytes")
    )


def channel_first(spark, sf_dir):
    """A frame of three channels of 8 x 8, each vector, itself reversed and its negative, moved to channel-last order."""
    rows = X.pixel_rows(spark, sf_dir)
    three = F.concat("values", F.reverse("values"), F.transform("values", lambda v: -v))
    moved = frames.to_hwc(three, F.lit(8), F.lit(8), F.lit(3))
    return rows.select("vec_id", "copy", F.posexplode(moved).alias("pos", "value")).select(
        "vec_id", "copy", F.col("pos").cast("long").alias("pos"), F.col("value").cast("double").alias("value")
    )


def resize_half(spark, sf_dir):
    full = frames.pixels_from_values(X.pixel_rows(spark, sf_dir))
    return frames.resize(full, 4).select("vec_id", "copy", F.hex("pixels.data").alias("bytes"))


def resize_up(spark, sf_dir):
    full = frames.pixels_from_values(X.pixel_rows(spark, sf_dir))
    return frames.resize(full, 13).select(
        "vec_id", "copy", F.col("pixels.height").cast("long").alias("height"), F.hex("pixels.data").alias("bytes")
    )


def _decoded_texts(spark, sf_dir):
    """Frames of every text; one without a byte, or a null, expects none."""
    n_frames = F.ceil(F.coalesce(F.octet_length("content"), F.lit(0)) / 64)
    return frames.decode(X.text_videos(spark, sf_dir).withColumn("expected", n_frames), DECODERS, expected="expected", fail_short=True)


def decode_texts(spark, sf_dir):
    return _decoded_texts(spark, sf_dir).select("episode_index", "frame_pos", "decoder", F.hex("pixels.data").alias("bytes"))


def decode_from_files(spark, sf_dir):
    """Every document as a file of its own, named by its path only and opened in the task that decodes it."""
    root = X.written_texts(spark, sf_dir)
    n_frames = F.ceil(F.octet_length(F.encode("text", "UTF-8")) / 64).alias("ep_len")
    wanted = X.table(spark, sf_dir, "documents").select(
        F.lit("all").alias("split"), F.col("doc_id").alias("episode_index"), F.lit(X.CAMERAS[0]).alias("camera"), n_frames
    )
    located = locate(wanted.where("ep_len > 0"), source.read_videos(spark, root).drop("content"))
    return frames.decode(located, DECODERS, expected="expected", fail_short=True).select(
        "episode_index", "frame_pos", "decoder", F.hex("pixels.data").alias("bytes")
    )


def decoder_counts(spark, sf_dir):
    return frames.decoder_counts(_decoded_texts(spark, sf_dir))


# --- signals -------------------------------------------------------------------------------


def signals_long(spark, sf_dir):
    return signals.to_long(X.line_rows(spark, sf_dir), "split", "row")


def step_window(spark, sf_dir):
    rows = slices.window_rows(X.line_store(spark, sf_dir), X.line_index(spark, sf_dir), start=1, end=4, stride=2)
    return rows.select(*STORE, "row", "ep_pos", "step_idx")


def image_stream(spark, sf_dir):
    return signals.images(X.line_store(spark, sf_dir), *STORE).select(
        *STORE, "entity_path", "step", F.col("rank").cast("long").alias("rank"), F.hex("pixels.data").alias("bytes")
    )


def _sessions(spark, sf_dir):
    """One session per episode of the episode table."""
    return X.line_index(spark, sf_dir).select(
        F.col("ep_pos").alias("episode_index"), F.lit(0).alias("start_step"), (F.col("ep_len") - 1).alias("end_step"), "split"
    )


def session_documents(spark, sf_dir):
    """The metadata streams of all sessions as they are: documents and numbers."""
    return signals.metadata_rows(_sessions(spark, sf_dir))


def image_rank(spark, sf_dir):
    """Frames of one and of three channels, all of them higher than wide."""
    pixels = F.col("pixels").withField("channels", F.when(F.col("row") % 2 == 0, 1).otherwise(3)).withField("height", (F.col("row") % 5 + 2).cast("int"))
    shown = signals.images(X.line_store(spark, sf_dir).withColumn("pixels", pixels), *STORE, "row")
    return longs(shown.select(*STORE, "row", "rank", "pixels.height", "pixels.width", "pixels.channels"), "rank", "height", "width", "channels")


def report_time(spark, sf_dir):
    """The report time beside every nation, as a text of a fixed form and within an hour of now."""
    form = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}\+00:00$"
    apart = F.abs(F.unix_timestamp(F.to_timestamp(scalars.utc_now())) - F.unix_timestamp(F.current_timestamp()))
    return X.table(spark, sf_dir, "nation").select("n_nationkey", scalars.utc_now().rlike(form).alias("of_form"), (apart < 3600).alias("near"))


def name_status(spark, sf_dir):
    """Every customer's segment and nation as requested names of splits and cameras."""
    both = X.table(spark, sf_dir, "customer").join(X.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return both.select(
        "c_custkey",
        splits.name_status("split", ["BUILDING", "MACHINERY"], F.col("c_mktsegment")).alias("split"),
        splits.name_status("camera", ["FRANCE", "PERU", "CHINA"], F.col("n_name")).alias("camera"),
    )


def null_keys(spark, sf_dir):
    """Events whose id, order or frame is missing break the read contract."""
    k = F.col("index")
    steps = X.event_steps(spark, sf_dir).select(
        k.alias("event_id"),
        F.when(k % 11 != 0, F.col("episode_index")).alias("episode_index"),
        F.when(k % 13 != 1, F.col("frame_index")).alias("frame_index"),
        F.when(k % 17 != 2, k).alias("index"),
    )
    return source.null_keys(steps)


def session_metadata(spark, sf_dir):
    """Numbers of the metadata streams of all sessions."""
    rows = signals.metadata_rows(_sessions(spark, sf_dir)).where("text is null")
    return rows.groupBy("entity_path").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def source_metadata(spark, sf_dir):
    """Customers as stores: the segment is the requested split, attributes are empty for some."""
    k = F.col("c_custkey")
    rows = X.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 3 == 0, F.col("c_mktsegment")).when(k % 3 == 1, "").alias("want_split"),
        F.when(k % 5 == 0, F.concat(F.lit("cam."), F.col("c_nationkey"))).alias("want_camera"),
        F.when(k % 4 != 0, "tables/customer").alias("source_repo_id"),
        F.when(k % 2 == 0, "train").otherwise("").alias("source_split"),
        F.when(k % 7 == 0, "observation.images.top").alias("source_camera_key"),
        F.when(k % 11 != 0, F.concat(F.lit("val__cam_"), F.col("c_nationkey"))).otherwise(F.lit("store")).alias("stem"),
    )
    name = names.parse_store_name(F.col("stem"))
    return signals.source_metadata(
        rows, F.col("want_split"), F.col("want_camera"), name.getField("split"), name.getField("slug")
    ).select("c_custkey", "source_repo_id", "source_split", "source_camera_key")


# --- names and scalars -----------------------------------------------------------------------


def name_functions(spark, sf_dir):
    url = F.col("url")
    stem = names.sanitize_repo_id(url)
    parsed = names.parse_store_name(stem)
    return X.table(spark, sf_dir, "pages").select(
        "page_id",
        stem.alias("sanitised"),
        names.camera_slug(url).alias("slug"),
        parsed.getField("split").alias("split"),
        parsed.getField("slug").alias("rest"),
        names.export_name(stem, F.col("page_id")).alias("export"),
        names.store_path("/stores/", url, F.lit("train"), url).alias("path"),
    )


def match_camera(spark, sf_dir):
    """Every customer's nation as a camera key, matched with a request given as key and as slug."""
    key = F.concat(F.lit("observation.images."), F.lower("n_name"))
    slug = names.camera_slug(key)
    cameras = X.table(spark, sf_dir, "customer").join(
        X.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    request = F.when(F.col("c_custkey") % 2 == 0, "observation.images.france").otherwise("observation_images_brazil")
    return cameras.select("c_custkey", names.match_camera(slug, request).alias("matches"))


def to_double(spark, sf_dir):
    lines = X.clean_steps(spark, sf_dir)
    cells = {n: scalars.to_double(F.col(n), lines.schema[n].dataType) for n in ("done", "frame_index", "timestamp")}
    return lines.select("index", *[c.alias(n) for n, c in cells.items()])


# --- end to end ------------------------------------------------------------------------------


def _conv_root(spark, sf_dir):
    """A raw dataset derived from the conversations, with uneven numbers of steps."""
    root = X.scratch(spark)
    base = X.conv_base(spark, sf_dir)
    size = F.length("said")
    steps = base.select(
        F.col("ep").alias("episode_index"),
        F.expr(X.RECIPE["frame_index"]).alias("frame_index"),
        F.expr(X.RECIPE["done"]).alias("next.done"),
        F.expr(X.RECIPE["index"]).alias("index"),
        (F.col("step0") / 10).cast("float").alias("timestamp"),
        (F.col("ep") % 3).alias("task_index"),
        F.array(size, F.col("step0")).cast("array<float>").alias("action"),
        F.array(size).cast("array<float>").alias("observation.state"),
    )
    steps.write.parquet(f"{root}/data")
    base.groupBy(F.col("ep").alias("episode_index")).agg(F.count(F.lit(1)).alias("length")).write.parquet(
        f"{root}/meta/episodes"
    )
    bounds = X.bounds(spark, sf_dir, "conversations")
    info = {
        "splits": {s: f"{a}:{b}" for s, a, b in bounds},
        "total_episodes": bounds[-1][2],
        "fps": 10,
        "camera_keys": X.CAMERAS,
        "features": {c: {"dtype": "video", "shape": [8, 8, 1]} for c in X.CAMERAS},
    }
    spark.createDataFrame([(json.dumps(info),)], "value string").coalesce(1).write.text(f"{root}/meta/info.json")
    return root


def conv_videos(spark, sf_dir):
    """One file per (conversation, camera): 64 bytes per turn, then two surplus frames."""
    n = F.count(F.lit(1))
    files = X.conv_base(spark, sf_dir).groupBy(F.col("ep").alias("episode_index")).agg(n.alias("n"))
    at = F.sequence(F.lit(0).cast("long"), F.col("n") + 1)
    turns = F.transform(at, lambda k: F.rpad(F.concat(F.lit("turn "), k, F.lit(" of "), "episode_index"), 64, "."))
    files = files.select("episode_index", F.encode(F.array_join(turns, ""), "UTF-8").alias("content"))
    return splits.fan_out(files, X.CAMERAS)


def convert_conversations(spark, sf_dir):
    """The whole conversion with policy drop, read back from the store."""
    out = f"{X.scratch(spark)}/store"
    convert(
        spark, _conv_root(spark, sf_dir), out, "tables/conversations", DECODERS,
        policy="drop", videos=conv_videos(spark, sf_dir), report=f"{out}-report",
    )
    return store.read_store(spark, out).select(
        *STORE, "row", "episode_idx", "step_idx", "done", "index", "task_index",
        F.get("state", F.lit(0)).cast("double").alias("state_0"),
        F.decode("pixels.data", "UTF-8").alias("frame"),
    )


def validate_converted(spark, sf_dir):
    """Policy warn: every episode is stored, and the validator reports what is wrong with it."""
    out = f"{X.scratch(spark)}/store"
    convert(
        spark, _conv_root(spark, sf_dir), out, "tables/conversations", DECODERS,
        policy="warn", videos=conv_videos(spark, sf_dir),
    )
    found = store_checks.validate(store.read_store(spark, out), store.read_episode_table(spark, out))
    return longs(found, "check")


def mixed_videos(spark, sf_dir):
    """``conv_videos`` of which every third begins with a capital, which one of the decoders can't open."""
    text = F.decode("content", "UTF-8")
    capital = F.when(F.col("episode_index") % 3 == 0, F.concat(F.lit("T"), F.expr("substring(decode(content, 'UTF-8'), 2)"))).otherwise(text)
    return conv_videos(spark, sf_dir).withColumn("content", F.encode(capital, "UTF-8"))


def conversion_document(spark, sf_dir):
    """The summary document of a conversion: the stores that it produced, by the decoders that it used."""
    out = f"{X.scratch(spark)}/store"
    convert(
        spark, _conv_root(spark, sf_dir), out, "tables/conversations", DECODERS,
        policy="drop", videos=mixed_videos(spark, sf_dir), report=f"{out}-report",
    )
    document = read_report(spark, f"{out}-report").select("repo_id", "status", "config", F.explode("splits").alias("s"))
    files = document.select("repo_id", "status", "config.decoders", "config.dirty_episode_policy", "s.*", F.explode("s.produced_files").alias("file"))
    return files.select(
        "repo_id", "status", F.col("decoders").alias("resolved"), "dirty_episode_policy", "split", "action_taken", "kept_episode_count",
        "file.camera", "file.n_rows", (F.col("file.n_files") > 0).alias("has_files"), F.inline("file.decoders"),
    )


def store_document(spark, sf_dir):
    """The summary document of a validation over a broken store on disk."""
    root, names = f"{X.scratch(spark)}/store", [b[0] for b in X.bounds(spark, sf_dir)]
    named = attributes(spark, "tables/lineitem", 10, names, X.CAMERAS)
    store.write_store(*X.bad_tables(spark, sf_dir), named, root, verify=False, in_order=True)
    check_stores(spark, root, report=f"{root}-report", fail_on_error=False)
    document = read_report(spark, f"{root}-report")
    return document.select("mode", F.col("target_path").endswith("/store").alias("of_root"), F.inline("stores"))


FAULTS = ("fewer", "mixed", "nested", "text", "torn", "whole")


def _faulty_stores(spark, sf_dir):
    """One store per split and fault, each with a camera named after it: sizes, bytes and types that are wrong."""
    root, bounds = f"{X.scratch(spark)}/store", X.bounds(spark, sf_dir)
    base, index = X.line_tables(spark, sf_dir)
    even = F.col("row") % 2 == 0
    high = F.col("pixels").withField("height", F.when(even, 1).otherwise(2)).withField("data", F.when(even, F.col("pixels.data")).otherwise(F.lit(bytes(6))))
    pixels = {"mixed": high, "text": F.lit("x"), "torn": F.col("pixels").withField("data", F.lit(b"12"))}
    tables = {
        "fewer": index.withColumn("ep_offset", F.when(F.col("ep_pos") != 5, F.col("ep_offset"))),
        "nested": index.withColumn("ep_offset", F.array("ep_offset")),
    }
    for fault in FAULTS:
        rows = splits.fan_out(base.withColumn("pixels", pixels.get(fault, F.col("pixels"))), [fault])
        named = attributes(spark, "tables/lineitem", 10, [b[0] for b in bounds], [fault])
        store.write_store(rows, tables.get(fault, index), named, root, in_order=True)
    return root


def faulty_stores(spark, sf_dir):
    return longs(check_stores(spark, _faulty_stores(spark, sf_dir), fail_on_error=False)[1], "check")


def inspected_faulty_stores(spark, sf_dir):
    """Columns of stores whose columns differ in type."""
    return check_stores(spark, _faulty_stores(spark, sf_dir), mode="inspect")[1]


def replay_checks(spark, sf_dir):
    """What a replay says of each of the faulty stores before it reads any step."""
    root, said = _faulty_stores(spark, sf_dir), []
    for r in store.records(spark, root):
        try:
            store_checks.check_replay_columns(store.read_store(spark, root, [r.store]), store.read_episode_table(spark, root, [r.store]))
            said.append((*r.store, "ok"))
        except (KeyError, ValueError) as e:
            said.append((*r.store, type(e).__name__))
    return spark.createDataFrame(said, "split string, camera string, outcome string")


def requested_positions(spark, sf_dir):
    """An episode position asked for by every order: below, inside and beyond the table, and of length zero."""
    table = splits.fan_out(X.bad_index(spark, sf_dir), X.CAMERAS)
    asked = X.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, "train").otherwise("val").alias("split"),
        F.lit(X.CAMERAS[0]).alias("camera"),
        (F.col("o_orderkey") % 1500 - 4).alias("ep_pos"),
    )
    return store.requested_bounds(asked, table)


def overwritten_stores(spark, sf_dir):
    """A write that meets existing stores is refused; an overwrite replaces its stores, here one by fewer rows and one by none."""
    tables, names = X.line_tables(spark, sf_dir), [b[0] for b in X.bounds(spark, sf_dir)]
    root, rows, index = written(spark, sf_dir, tables), splits.fan_out(tables[0], X.CAMERAS), tables[1]
    try:
        store.write_store(rows, index, attributes(spark, "again", 10, names, X.CAMERAS), root)
        refused = False
    except FileExistsError:
        refused = True
    few = index.where("split = 'val' and ep_pos < 20")
    end = few.agg(F.max(F.col("ep_offset") + F.col("ep_len"))).first()[0]
    kept = rows.where((F.col("split") == "val") & (F.col("row") < end))
    store.write_store(kept, few, attributes(spark, "again", 10, ["val", "test"], X.CAMERAS[:1]), root, "overwrite", in_order=True)
    counted = store.read_store(spark, root).groupBy(*STORE).agg(F.count(F.lit(1)).alias("n_rows"), F.max("row").alias("last"))
    listed = store.read_attributes(spark, root).select(*STORE, "source_repo_id")
    return listed.join(counted, STORE, "left").na.fill(0, ["n_rows"]).withColumn("refused", F.lit(refused))


def compressions(spark, sf_dir):
    """The same store under every codec, read back."""
    out, names = None, [b[0] for b in X.bounds(spark, sf_dir)]
    rows, index = X.line_tables(spark, sf_dir)
    for codec in store.CODECS:
        root = f"{X.scratch(spark)}/store"
        named = attributes(spark, "tables/lineitem", 10, names, X.CAMERAS[:1])
        store.write_store(splits.fan_out(rows, X.CAMERAS[:1]), index, named, root, compression=codec, in_order=True)
        part = store.read_store(spark, root).groupBy("split").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("index").alias("total"), F.sum(F.octet_length("pixels.data")).cast("long").alias("bytes")
        )
        part = part.withColumn("compression", F.lit(codec))
        out = part if out is None else out.unionByName(part)
    return out


def conversion_report(spark, sf_dir):
    """Lines of the report of a conversion: every requested episode with its messages."""
    out = f"{X.scratch(spark)}/store"
    convert(
        spark, _conv_root(spark, sf_dir), out, "tables/conversations", DECODERS,
        policy="drop", videos=conv_videos(spark, sf_dir), report=f"{out}-report",
    )
    lines = spark.read.schema("episode_index long, valid boolean, kept boolean, part long, issues array<string>, split string")
    return lines.json(f"{out}-report/episodes").select(
        "split", "episode_index", "valid", "kept", F.array_join(F.coalesce("issues", F.array()), "; ").alias("issues")
    )


def store_report(spark, sf_dir):
    """Lines of the report of a validation over a broken store on disk."""
    root = f"{X.scratch(spark)}/store"
    bounds = X.bounds(spark, sf_dir)
    named = attributes(spark, "tables/lineitem", 10, [b[0] for b in bounds], X.CAMERAS)
    store.write_store(*X.bad_tables(spark, sf_dir), named, root, verify=False, in_order=True)
    check_stores(spark, root, report=f"{root}-report", fail_on_error=False, pixel_bytes=False)
    lines = spark.read.schema("ep_pos long, check long, message string, split string, camera string")
    return lines.json(f"{root}-report/details")


def replayed_episode(spark, sf_dir):
    """Every second step of one episode of a store on disk."""
    return replay(spark, written(spark, sf_dir), "val", X.CAMERAS[1], ep_pos=7, stride=2).signals


QUERIES = {
    "q1_source_issues_conversations": _issues(X.conv_steps),
    "q1_source_issues_lines": _issues(X.line_steps),
    "q1_source_issues_events": _issues(X.event_steps),
    "q1_without_terminal_done": without_terminal,
    "q1_check_counts": check_counts,
    "w1_a4_runs": runs,
    "w1_runs_interleaved": runs_interleaved,
    "a5_issue_lists_conversations": _issue_lists(X.conv_steps),
    "a5_issue_lists_lines": _issue_lists(X.line_steps),
    "a5_issue_lists_events": _issue_lists(X.event_steps),
    "j1_p8_drop_dirty": drop_dirty,
    "p8_warn_policy": warn_policy,
    "a6_split_summary": split_summary,
    "a6_split_summary_warn": split_summary_warn,
    "a6_episode_status": episode_status,
    "f5_parse_range": parse_range,
    "p5_select_split": select_split,
    "j7_assign_splits": assign_splits,
    "j2_camera_fan_out": camera_fan_out,
    "w6_row_position": row_positions,
    "w6_row_position_per_split": row_positions_per_split,
    "w6_row_position_repeated": row_positions_repeated,
    "w1_runs_repeated": runs_repeated,
    "t1_transitions": step_transitions,
    "t2_goal_topk": goal_topk,
    "t3_normalise_channels": normalise_channels,
    "a1_lengths_declared": lengths_declared,
    "a1_lengths_from_bounds": lengths_from_bounds,
    "w2_o2_episode_offsets": episode_offsets,
    "j5_episode_metadata": episode_metadata,
    "j5_missing_metadata": missing_metadata,
    "j6_reconcile": reconcile,
    "j3_assign_slices": assign_slices,
    "v_validate_clean": validate_clean,
    "v_validate_bad": validate_bad,
    "v_validate_not_strict": validate_not_strict,
    "v1_validate_missing_columns": validate_missing,
    "a8_any_error": any_error,
    "a2_inspect_declared": inspect_declared,
    "a2_inspect_rows": inspect_rows,
    "a3_inspect_columns": inspect_columns,
    "s7_written_store": written_store,
    "s13_written_episode_table": written_episode_table,
    "s7_cameras_apart": cameras_apart,
    "v1_stored_without_action": stored_without_action,
    "a2_stored_without_index": stored_without_index,
    "s6_s12_written_attributes": written_attributes,
    "p10_p11_selected_episode": selected_episode,
    "s1_p1_p2_read_steps": read_steps,
    "s1_read_steps_of_split": read_steps_of_split,
    "s2_dataset_info": dataset_info,
    "s3_episode_metadata": read_episode_metadata,
    "s5_dataset_catalogue": dataset_catalogue,
    "a10_vector_dims": vector_dims,
    "p4_flatten_vectors": flatten_vectors,
    "j8_frame_count_issues": frame_count_issues,
    "j8_frame_count_issues_strict": frame_count_issues_strict,
    "j4_attach_frames": attach_frames,
    "f6_normalise_values": normalise_values,
    "f6_normalise_pixels": normalise_pixels,
    "f6_channel_first": channel_first,
    "f7_resize_half": resize_half,
    "f7_resize_up": resize_up,
    "u4_decode_texts": decode_texts,
    "a7_decoder_counts": decoder_counts,
    "s4_u4_decode_from_files": decode_from_files,
    "s8_overwritten_stores": overwritten_stores,
    "s9_compressions": compressions,
    "v3_v5_v6_faulty_stores": faulty_stores,
    "a3_inspected_faulty_stores": inspected_faulty_stores,
    "v17_replay_checks": replay_checks,
    "v18_requested_positions": requested_positions,
    "u2_image_rank": image_rank,
    "u3_f10_session_documents": session_documents,
    "f12_report_time": report_time,
    "p6_p7_name_status": name_status,
    "p12_null_keys": null_keys,
    "s10_a7_conversion_document": conversion_document,
    "s11_store_document": store_document,
    "u1_signals_long": signals_long,
    "p9_step_window": step_window,
    "u2_image_stream": image_stream,
    "u3_session_metadata": session_metadata,
    "f8_source_metadata": source_metadata,
    "f1_f2_f3_f11_f13_names": name_functions,
    "f4_match_camera": match_camera,
    "f9_to_double": to_double,
    "e1_convert_drop": convert_conversations,
    "e2_convert_warn_validate": validate_converted,
    "s10_conversion_report": conversion_report,
    "s11_store_report": store_report,
    "e3_replay": replayed_episode,
}
