import json

import pytest
from pyspark.sql import functions as F

from episodica.functions import names as N
from episodica.functions import scalars as S
from episodica.operators import episodes, signals, slices, splits


def test_parse_range():
    assert splits.parse_range("0:10", 10) == (0, 10)
    assert splits.parse_range(" 3 : 3 ", 10) == (3, 3)
    for bad in ("10", "a:b", "-1:4", "5:3", "0:11", "1:2:3", ""):
        with pytest.raises(ValueError):
            splits.parse_range(bad, 10)


def test_known_names():
    specs = {"train": "0:8", "val": "8:10"}
    assert splits.split_bounds(specs, 10) == [("train", 0, 8), ("val", 8, 10)]
    assert splits.split_bounds(specs, 10, ["val"]) == [("val", 8, 10)]
    with pytest.raises(ValueError, match="Available: .*train"):
        splits.split_bounds(specs, 10, ["test"])
    assert splits.resolve_cameras(["a", "b"]) == ["a", "b"]
    with pytest.raises(ValueError):
        splits.resolve_cameras(["a"], ["b"])


def test_split_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumnRenamed("id", "episode_index").write.parquet(path)
    bounds = [("train", 0, 80), ("val", 80, 90), ("both", 70, 90)]
    df = spark.read.parquet(path)
    plan = splits.assign_splits(df, bounds[1:])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(episode_index,70)" in plan and "LessThan(episode_index,90)" in plan
    counted = {r["split"]: r["count"] for r in splits.assign_splits(df, bounds).groupBy("split").count().collect()}
    assert counted == {"train": 80, "val": 10, "both": 20}
    assert splits.select_split(df, bounds, "val").count() == 10


def test_lengths(spark):
    meta = spark.createDataFrame([(0, 0, 5, 99), (1, 5, 7, 99)], "episode_index long, dataset_from_index long, dataset_to_index long, length long")
    assert sorted(map(tuple, episodes.lengths(meta).collect())) == [(0, 5), (1, 2)]
    assert episodes.lengths(meta.drop("dataset_to_index")).first().ep_len == 99
    with pytest.raises(KeyError):
        episodes.lengths(meta.select("episode_index"))


def test_offsets_skip_dropped_episodes(spark):
    kept = spark.createDataFrame([("a", 7, 4), ("a", 2, 3), ("b", 9, 5), ("a", 90, 1)], "split string, episode_index long, ep_len long")
    got = sorted(map(tuple, episodes.episode_table(kept).collect()))
    assert got == [("a", 0, 2, 3, 0), ("a", 1, 7, 4, 3), ("a", 2, 90, 1, 7), ("b", 0, 9, 5, 0)]


def test_window():
    assert signals.resolve_window(10) == (0, 9, 1)
    assert signals.resolve_window(10, 2, 5, 3) == (2, 5, 3)
    for bad in ((10, 8, 2, 1), (10, -1, None, 1), (10, 10, None, 1), (10, 0, 10, 1), (10, 0, -1, 1), (10, 0, 3, 0)):
        with pytest.raises(ValueError):
            signals.resolve_window(*bad)


def test_long_signals(spark):
    df = spark.createDataFrame(
        [(5, 3, 1, True, [0.5], [1.0, 2.0])],
        "row long, ep_offset long, step_idx long, done boolean, action array<float>, state array<float>",
    ).withColumn("episode_idx", F.lit(4).cast("long"))
    assert {(r.entity_path, r.step, r.value) for r in signals.to_long(df).collect()} == {
        ("signals/done", 1, 1.0),
        ("signals/episode_idx", 1, 4.0),
        ("signals/step_idx", 1, 1.0),
        ("signals/action/dim_0", 1, 0.5),
        ("signals/state/dim_0", 1, 1.0),
        ("signals/state/dim_1", 1, 2.0),
    }
    assert signals.step_window(df, 0, 4, 2).count() == 1
    assert signals.step_window(df, 1, None, 2).count() == 0


def test_metadata_rows(spark):
    session = spark.createDataFrame([("f", 3, 0, 9)], "source_file string, episode_index long, start_step long, end_step long")
    got = {r.entity_path: (r.text, r.value) for r in signals.metadata_rows(session).collect()}
    document = got.pop("metadata/session")[0]
    assert json.loads(document) == {"source_file": "f", "episode_index": 3, "start_step": 0, "end_step": 9} and "\n" in document
    assert got == {"metadata/episode_index": (None, 3.0), "metadata/start_step": (None, 0.0), "metadata/end_step": (None, 9.0)}


def test_names(spark):
    stems = ["train__observation_images_front", "plain", "a__b__c", "__x"]
    df = spark.createDataFrame([(s,) for s in stems], "stem string")
    got = [tuple(r.p) for r in df.select(N.parse_store_name(F.col("stem")).alias("p")).collect()]
    assert got == [("train", "observation_images_front"), (None, None), ("a", "b__c"), ("", "x")]
    one = spark.range(1).select(
        N.sanitize_repo_id(F.lit("a/b")), N.camera_slug(F.lit("x.y.z")), N.export_name(F.lit("train__front"), F.lit(7)),
        N.match_camera(F.lit("x_y"), F.lit("x.y")), N.match_camera(F.lit("x_y"), F.lit("x_y")), N.match_camera(F.lit("x_y"), F.lit("y")),
    ).first()
    assert tuple(one) == ("a__b", "x_y_z", "train__front__ep7", True, True, False)


def test_vectors_and_time(spark):
    df = spark.sql("select 1.5d as a, array(1, 2) as b, array(array(array(1, 2)), array(array(3, 4))) as c")
    flat = df.select(*[S.flatten_vector(F.col(n), df.schema[n].dataType).alias(n) for n in "abc"]).first()
    assert tuple(map(list, flat)) == ([1.5], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0])
    filled = spark.sql("select '' as a, cast(null as string) as b, 'x' as c").select(
        S.first_filled(F.col("a"), F.col("b"), F.col("c")), S.first_filled(F.col("a"), F.col("b"))
    )
    assert tuple(filled.first()) == ("x", "unknown")
    assert spark.range(1).select(S.utc_now()).first()[0].endswith("+00:00")


def test_window_rows_agrees_with_the_filter(spark):
    rows = spark.range(40).selectExpr("'a' as split", "id as row")
    index = spark.createDataFrame([("a", 0, 0, 7), ("a", 1, 7, 1), ("a", 2, 5, 20), ("a", 3, 35, 9), ("a", 4, 3, 0)], "split string, ep_pos long, ep_offset long, ep_len long")
    pairs = slices.assign_slices(rows, index.withColumn("n_rows", F.lit(40)), "n_rows")
    for window in ((0, None, 1), (1, 4, 2), (2, None, 3), (0, 0, 1), (30, None, 1)):
        got = sorted((r.ep_pos, r.row) for r in slices.window_rows(rows, index, *window).collect())
        assert got == sorted((r.ep_pos, r.row) for r in signals.step_window(pairs, *window).collect())
    with pytest.raises(ValueError):
        slices.window_rows(rows, index, 3, 2)
