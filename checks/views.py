"""Episode views over the given tables: the Spark side. ``oracle.py`` states the same in SQL."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episodica.operators.episodes import episode_table, step_counts
from episodica.operators.ordering import row_position, spooled
from episodica.operators.splits import assign_splits, fan_out
from episodica.sources.store import store_rows, with_proprio

CAMERAS = ["observation.images.top", "observation.images.wrist"]
CELLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Dirties a known minority of episodes, see FIXTURES.md.
RECIPE = {
    "frame_index": "step0 + (case when ep % 13 = 5 then 1 else 0 end)"
    " + (case when ep % 11 = 4 and step0 >= 1 then 1 else 0 end)",
    "done": "(is_last and ep % 5 <> 0) or (ep % 7 = 3 and step0 = 0 and not is_last)",
    "index": "case when ep % 17 = 2 and is_last then 1000000000 + ep else ord end",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for a derived dataset: below the shared folder of the cluster if one is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        return tempfile.mkdtemp(prefix="episodica-derived-")
    return f"{shared.rstrip('/')}/derived/{spark.sparkContext.applicationId}/{spark.range(1).select(F.uuid()).first()[0]}"


def _recipe(base: DataFrame, *extra: str) -> DataFrame:
    return base.select(F.col("ep").alias("episode_index"), *[F.expr(e).alias(n) for n, e in RECIPE.items()], *extra)


def conv_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    final = turns.groupBy("conv_id").agg(F.max("turn").alias("final"))
    return turns.join(final, "conv_id").select(
        F.col("conv_id").alias("ep"),
        F.col("turn").alias("step0"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"),
        (F.col("turn") == F.col("final")).alias("is_last"),
        F.col("text").alias("said"),
    )


def conv_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recipe(conv_base(spark, sf_dir))


def _line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_base`` with its vectors as single cells, which take half the room in a shuffle."""
    of_order = Window.partitionBy("l_orderkey")
    at = of_order.orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ep"),
        (F.row_number().over(at) - 1).cast("long").alias("step0"),
        F.count(F.lit(1)).over(of_order).alias("n"),
        *[F.col(c).cast("float").alias(c) for c in CELLS],
        F.lead(F.lit(True)).over(at).isNull().alias("is_last"),
    )
    return lines.select(*[c for c in lines.columns if c != "is_last"], (F.col("ep") * 100 + F.col("step0")).alias("ord"), "is_last")


def _vectors(lines: DataFrame) -> DataFrame:
    """The cells put together as action and state."""
    action, state = F.array("l_quantity", "l_discount"), F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return lines.withColumns({"action": action, "state": state}).drop(*CELLS)


def line_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(_line_cells(spark, sf_dir)).select("ep", "step0", "n", "action", "state", "ord", "is_last")


def line_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recipe(line_base(spark, sf_dir), "action", "state")


def repeated_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose ``index`` repeats: a third of all episodes share one value, the others lie ten to a value."""
    index = F.expr("case when episode_index % 3 = 0 then 7 else episode_index div 10 end")
    return line_steps(spark, sf_dir).withColumn("index", index)


def event_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return row_position(events, order="event_id", group=["user_id"], name="frame_index").select(
        F.col("user_id").alias("episode_index"),
        "frame_index",
        (F.col("event_type") == "purchase").alias("done"),
        F.col("event_id").alias("index"),
    )


def clean_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as clean steps with every column of the step schema."""
    return line_base(spark, sf_dir).select(
        F.col("ep").alias("episode_index"),
        F.col("step0").alias("frame_index"),
        F.col("is_last").alias("done"),
        (F.col("step0") / 10).cast("float").alias("timestamp"),
        F.col("ord").alias("index"),
        (F.col("ep") % 7).alias("task_index"),
        "action",
        "state",
    )


def episodes_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey")
        .join(lines, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("episode_index"),
            (F.coalesce("n", F.lit(0)) + F.when(F.col("o_orderkey") % 97 == 0, 1).otherwise(0)).alias("length"),
        )
    )


def bounds(spark: SparkSession, sf_dir: str, name: str = "orders") -> list[tuple[str, int, int]]:
    """80/10/10 splits of the orders or of the conversations."""
    if name == "orders":
        n = table(spark, sf_dir, name).count()
    else:
        n = table(spark, sf_dir, name).agg(F.max("conv_id")).first()[0] + 1
    a, b = n * 8 // 10, n * 9 // 10
    return [("train", 0, a), ("val", a, b), ("test", b, n)]


def split_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean steps with their split and without what follows from other columns, written once for all that reads them."""
    cells = _line_cells(spark, sf_dir).select(
        F.col("ep").alias("episode_index"), F.col("step0").alias("frame_index"), F.col("is_last").alias("done"), F.col("ord").alias("index"), *CELLS
    )
    return spooled(assign_splits(cells, bounds(spark, sf_dir)))[0]


def full_steps(cells: DataFrame) -> DataFrame:
    """``split_cells`` with every column of the step schema."""
    return _vectors(cells).select(
        "episode_index",
        "frame_index",
        "done",
        (F.col("frame_index") / 10).cast("float").alias("timestamp"),
        "index",
        (F.col("episode_index") % 7).alias("task_index"),
        "action",
        "state",
        *[c for c in cells.columns if c in ("split", "row")],
    )


def _rows_of(cells: DataFrame) -> DataFrame:
    rows = with_proprio(store_rows(full_steps(cells)))
    colour = F.unhex(F.lpad(F.hex(F.col("row") % 16777216), 6, "0"))
    one = F.lit(1)
    pixels = F.struct(one.alias("height"), one.alias("width"), F.lit(3).alias("channels"), colour.alias("data"))
    return rows.withColumn("pixels", pixels)


def _index_of(cells: DataFrame) -> DataFrame:
    return episode_table(spooled(step_counts(cells, ["split"]))[0])


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a clean store, the same for every camera: split, row and every per-step column."""
    return _rows_of(row_position(split_cells(spark, sf_dir), group=["split"]))


def line_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``line_rows`` and ``line_index`` of the same steps, each written once for all that reads it."""
    cells = split_cells(spark, sf_dir)
    return _rows_of(spooled(row_position(cells, group=["split"]))[0]), spooled(_index_of(cells))[0]


def line_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean store without files."""
    return fan_out(line_rows(spark, sf_dir), CAMERAS)


def line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index_of(assign_splits(clean_steps(spark, sf_dir), bounds(spark, sf_dir)))


def bad_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``bad_store`` and ``bad_index`` of the same steps."""
    rows, index = line_tables(spark, sf_dir)
    return _bad_rows(fan_out(rows, CAMERAS)), _bad_slices(index)


def bad_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_store`` with wrong steps, done flags, missing actions and a two-channel camera."""
    return _bad_rows(line_store(spark, sf_dir))


def _bad_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "action": F.when(F.col("row") % 1009 != 5, F.col("action")),
            "step_idx": F.col("step_idx") + F.when(F.col("episode_idx") % 79 == 4, 1).otherwise(0),
            "done": F.when(F.col("episode_idx") % 83 == 7, False)
            .when((F.col("episode_idx") % 89 == 3) & (F.col("step_idx") == 0), True)
            .otherwise(F.col("done")),
            "pixels": F.col("pixels").withField("channels", F.when(F.col("camera") == CAMERAS[1], 2).otherwise(3)),
        }
    )


def bad_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_index`` with broken lengths and offsets, see FIXTURES.md."""
    return _bad_slices(line_index(spark, sf_dir))


def _bad_slices(index: DataFrame) -> DataFrame:
    final = index.groupBy("split").agg(F.max("ep_pos").alias("final"))
    pos = F.col("ep_pos")
    return (
        index.join(final, "split")
        .select(
            "split",
            "ep_pos",
            "episode_index",
            F.when(pos == 60, -2)
            .when(pos == 61, -100000)
            .when(pos % 97 == 0, F.col("ep_len") + 1)
            .when(pos % 101 == 1, 0)
            .otherwise(F.col("ep_len"))
            .alias("ep_len"),
            F.when(pos == F.col("final"), F.col("ep_offset") + 5)
            .when(pos == 0, 1)
            .when(pos == 50, F.col("ep_offset") - 7)
            .otherwise(F.col("ep_offset"))
            .alias("ep_offset"),
        )
    )


def pixel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("values"))
    scaled = vectors.select("vec_id", F.transform("values", lambda v: v * F.lit(1000).cast("float")).alias("values"))
    return (
        vectors.withColumn("copy", F.lit("unit"))
        .unionByName(scaled.withColumn("copy", F.lit("scaled")))
        .withColumns({"height": F.lit(8), "width": F.lit(8), "channels": F.lit(1)})
    )


def text_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole document text as a file: 8 x 8 frames of its bytes, padded with blanks."""
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("episode_index"), F.lit(CAMERAS[0]).alias("camera"), F.encode("text", "UTF-8").alias("content")
    )
    # Decoding costs far more than moving a file, so files are spread evenly.
    return files.repartition("episode_index", "camera")


def written_texts(spark: SparkSession, sf_dir: str) -> str:
    """Root of a dataset whose videos are the whole document texts, each a file of its own, written by the tasks."""
    root = scratch(spark)
    rows = text_videos(spark, sf_dir).select("episode_index", "camera", "content")
    local = root.removeprefix("file:")

    def write(batches):
        folders = {}
        for batch in batches:
            for episode, camera, content in zip(*(c.to_pylist() for c in batch.columns)):
                if camera not in folders:
                    folders[camera] = Path(local, "videos", camera)
                    folders[camera].mkdir(parents=True, exist_ok=True)
                folders[camera].joinpath(f"episode_{episode:06d}.txt").write_bytes(content or b"")
            yield batch.select(["episode_index"])

    rows.mapInArrow(write, "episode_index long").write.format("noop").mode("overwrite").save()
    return root
