"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A raw dataset and a store are derived from the tables and written first (not timed); every job
then reads them as it would in production and consumes its whole result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks import queries as Q
from checks import views as X
from episodica.operators import frames, quality, signals, slices, splits, store_checks, summary
from episodica.operators.episodes import episode_table, lengths
from episodica.operators.ordering import materialised, row_position
from episodica.sources import steps as source
from episodica.sources import store


def consume(df) -> None:
    df.write.mode("overwrite").format("noop").save()


def jobs(spark, sf_dir, raw, out):
    info = source.read_info(spark, raw)
    bounds = info.bounds()

    def steps(columns=source.K.SOURCE_COLUMNS):
        return splits.assign_splits(source.canonical_steps(source.read_steps(spark, raw, columns)), bounds)

    narrow = [*source.K.QUALITY_COLUMNS, "index"]

    def issues():
        return quality.source_issues(steps(narrow), ["split"])

    def split_report():
        found, _ = materialised(issues())
        status = summary.episode_status(summary.requested_episodes(spark, bounds), found, "drop")
        consume(summary.split_summary(status, "drop"))

    def index():
        requested = summary.requested_episodes(spark, bounds)
        consume(episode_table(lengths(source.read_episodes(spark, raw), requested)))

    def rows():
        return store.read_store(spark, out)

    def table():
        return store.read_episode_table(spark, out)

    def sliced():
        counted, _ = materialised(rows().groupBy("split", "camera").agg(F.count(F.lit(1)).alias("n_rows")))
        return slices.assign_slices(rows(), table().join(counted, ["split", "camera"]), "n_rows", ["split", "camera"])

    def aligned():
        shown = table().withColumn("frame_pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ep_len") + 1)))
        shown = frames.frame_rows(shown).withColumn("pixels", F.col("frame_pos"))
        return frames.attach_frames(rows().drop("pixels"), shown)

    return {
        "q1_source_issues": lambda: consume(issues()),
        "a6_split_summary": split_report,
        "j1_drop_dirty": lambda: consume(quality.drop_dirty(steps(), issues(), ["split"])),
        "w6_row_position": lambda: consume(row_position(steps(), group=["split"])),
        "w2_episode_table": index,
        "s7_write_store": lambda: store.write_store(
            rows(), table(), store.read_attributes(spark, out), f"{X.scratch(spark)}/copy"
        ),
        "v_validate": lambda: consume(store_checks.validate(rows(), table())),
        "a3_inspect": lambda: consume(store_checks.inspect_columns(rows(), table())),
        "j3_assign_slices": lambda: consume(sliced()),
        "j4_attach_frames": lambda: consume(aligned()),
        "p9_step_window": lambda: consume(slices.window_rows(rows(), table(), 1, 4, 2, ["split", "camera"])),
        "u1_signals_long": lambda: consume(signals.to_long(rows(), "split", "camera")),
        "f6_f7_pixels": lambda: consume(frames.resize(frames.pixels_from_values(X.pixel_rows(spark, sf_dir)), 13)),
        "u4_decode": lambda: consume(frames.decode(X.text_videos(spark, sf_dir), Q.DECODERS)),
        "e1_convert": lambda: consume(Q.convert_conversations(spark, sf_dir)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = Q.raw_root(spark, sf_dir)
    out = Q.written(spark, sf_dir)
    timed = {}
    for name, job in jobs(spark, sf_dir, raw, out).items():
        started = time.perf_counter()
        job()
        timed[name] = round(time.perf_counter() - started, 3)
        print(name, timed[name], file=sys.stderr, flush=True)
    result = {
        "metric": "total_seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
