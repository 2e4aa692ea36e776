import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica import check_stores, convert, replay
from episodica.operators.frames import decode
from episodica.operators.quality import DirtyEpisodes, runs
from episodica.plans import convert as plans
from episodica.plans.check import InvalidStore
from episodica.plans.convert import locate
from episodica.sources import steps as source
from episodica.sources import store

CAMERAS = ["observation.images.front", "observation.images.wrist"]
LENGTHS = [3, 4, 2, 5, 3]


def raw_rgb(content):
    for at in range(0, len(content), 12):
        yield np.frombuffer(content[at : at + 12], np.uint8).reshape(2, 2, 3)


RAW = [("raw", raw_rgb)]


def make_raw(spark, root, dirty=(), short=(), declared=None, first=0):
    """Five episodes; ``dirty`` ones are not terminated, ``short`` ones miss a frame."""
    data, index = [], 0
    for e, n in enumerate(LENGTHS):
        for k in range(n):
            done = k == n - 1 and e not in dirty
            data.append(([float(e), float(k)], [float(index)], e, k + first, done, k / 10, index, 0))
            index += 1
    schema = (
        "action array<double>, `observation.state` array<double>, episode_index long, frame_index long,"
        " `next.done` boolean, timestamp double, index long, task_index long"
    )
    spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{root}/data")
    meta = list(enumerate(declared or LENGTHS))
    spark.createDataFrame(meta, "episode_index long, length long").write.parquet(f"{root}/meta/episodes")
    info = {
        "splits": {"train": "0:4", "val": "4:5"},
        "total_episodes": 5,
        "fps": 10,
        "features": {c: {"dtype": "video", "shape": [2, 2, 3]} for c in CAMERAS} | {"action": {"dtype": "float32", "shape": [2]}},
    }
    Path(root, "meta", "info.json").write_text(json.dumps(info, indent=2))
    for c_at, c in enumerate(CAMERAS):
        folder = Path(root, "videos", "chunk-000", c)
        folder.mkdir(parents=True)
        for e, n in enumerate(LENGTHS):
            frames = [bytes([10 * e + k + 100 * c_at] * 12) for k in range(n - (e in short))]
            folder.joinpath(f"episode_{e:06d}.mp4").write_bytes(b"".join(frames))
    return root


@pytest.fixture(scope="module")
def converted(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    root = make_raw(spark, str(base / "raw"))
    out, report = str(base / "out"), str(base / "report")
    summary = convert(spark, root, out, "some/robot", RAW, report=report)
    return root, out, report, summary


def test_sources(spark, converted):
    root = converted[0]
    info = source.read_info(spark, root)
    assert info.bounds() == [("train", 0, 4), ("val", 4, 5)] and info.fps == 10
    assert info.cameras == {c: (2, 2, 3) for c in CAMERAS}
    few = source.read_steps(spark, root, ["episode_index"], episodes=(1, 3))
    assert few.count() == 6 and few.columns == ["episode_index"]
    assert source.read_steps(spark, root, episodes=[0, 4]).count() == 6
    assert source.read_steps(spark, root, episodes=[0, 4, *range(100, 2000)]).count() == 6
    videos = source.read_videos(spark, root)
    assert {(r.episode_index, r.camera) for r in videos.select("episode_index", "camera").collect()} == {
        (e, c) for e in range(5) for c in CAMERAS
    }
    scan = videos.select("episode_index")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in scan
    manifest = spark.createDataFrame([(3, CAMERAS[0], f"videos/chunk-000/{CAMERAS[0]}/episode_000003.mp4")], "episode_index long, camera string, path string")
    assert source.read_videos(spark, root, manifest).first().content is not None
    both = source.read_many(spark, {"a/x": root, "b/y": root}, ["episode_index"])
    assert sorted(map(tuple, source.catalogue(both).collect())) == [("a/x", 5, 17), ("b/y", 5, 17)]
    dims = source.vector_dims(source.canonical_steps(source.read_steps(spark, root)))
    assert sorted(map(tuple, dims.collect())) == [("action", 2, 2), ("state", 1, 1)]


def test_convert_clean(spark, converted):
    _, out, report, summary = converted
    assert {r.split: (r.requested_episode_count, r.invalid_episode_count, r.kept_episode_count, r.action_taken) for r in summary.collect()} == {
        "train": (4, 0, 4, "kept_all"),
        "val": (1, 0, 1, "kept_all"),
    }
    rows = store.read_store(spark, out)
    assert rows.count() == 2 * sum(LENGTHS)
    for r in rows.collect():
        at = 100 * CAMERAS.index(r.camera)
        assert bytes(r.pixels.data) == bytes([10 * r.episode_idx + r.step_idx + at] * 12)
        assert r.proprio == r.state and list(r.action) == [r.episode_idx, r.step_idx]
    document = spark.read.json(f"{report}/summary").first()
    assert document.status == "ok" and document.repo_id == "some/robot" and len(document.splits) == 2
    assert document.config.decoders == "raw"
    files = {(s.split, f.camera): f for s in document.splits for f in s.produced_files}
    assert {k: (f.n_rows, [(d.name, d.n_videos) for d in f.decoders]) for k, f in files.items()} == {
        (s, c): (n, [("raw", videos)]) for s, n, videos in (("train", 14, 4), ("val", 3, 1)) for c in CAMERAS
    }
    assert all(len(list(Path(f.path).glob("*.parquet"))) == f.n_files > 0 for f in files.values())
    assert spark.read.json(f"{report}/episodes").where("kept and valid").count() == 5


def test_validate_and_inspect(spark, converted, tmp_path):
    out = converted[1]
    verdicts, details = check_stores(spark, out, report=str(tmp_path / "v"))
    assert verdicts.where("valid").count() == 4 and details.isEmpty()
    assert len(spark.read.json(str(tmp_path / "v" / "summary")).first().stores) == 4
    totals, columns = check_stores(spark, out, mode="inspect", report=str(tmp_path / "i"))
    assert {(r.split, r.num_episodes, r.total_steps) for r in totals.collect()} == {("train", 4, 14), ("val", 1, 3)}
    assert columns.where("column = 'pixels'").first().shape.endswith("2, 2, 3]")
    with pytest.raises(ValueError):
        check_stores(spark, out, mode="repair")
    with pytest.raises(FileNotFoundError):
        check_stores(spark, str(tmp_path / "none"))


def test_replay(spark, converted, tmp_path):
    out = converted[1]
    shown = replay(spark, out, "train", CAMERAS[1], ep_pos=3, start=1, end=4, stride=2)
    assert sorted({r.step for r in shown.signals.collect()}) == [1, 3]
    assert shown.signals.count() == 2 * (3 + 2 + 1)
    assert sorted(bytes(r.pixels.data)[0] for r in shown.images.collect()) == [131, 133]
    assert shown.name == "train__observation_images_wrist__ep3"
    document = json.loads(shown.metadata.where("text is not null").first().text)
    assert document["source_repo_id"] == "some/robot" and document["end_step"] == 4 and document["step_stride"] == 2
    path = shown.write(str(tmp_path / "exports"))
    assert spark.read.parquet(f"{path}/signals").count() == 12
    assert replay(spark, out, "val", CAMERAS[0]).signals.select("step").distinct().count() == 3
    for bad in ({"ep_pos": -1}, {"stride": 0}, {"start": 9}):
        with pytest.raises(ValueError):
            replay(spark, out, "val", CAMERAS[0], **bad)
    with pytest.raises(IndexError):
        replay(spark, out, "val", CAMERAS[0], ep_pos=1)


def test_policies(spark, tmp_path):
    root = make_raw(spark, str(tmp_path / "raw"), dirty=(1,))
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    with pytest.raises(DirtyEpisodes):
        convert(spark, root, out, "r", RAW, report=report)
    assert spark.read.json(f"{report}/summary").first().status == "failed"
    dirty = spark.read.json(f"{report}/episodes").where("not valid").first()
    assert dirty.episode_index == 1 and len(dirty.issues) == 1
    assert store.list_stores(spark, out).isEmpty()

    summary = convert(spark, root, out, "r", RAW, policy="drop", cameras=[CAMERAS[0]], image_size=4, compression="gzip")
    assert {r.split: (r.invalid_episode_count, r.action_taken) for r in summary.collect()} == {"train": (1, "drop_invalid"), "val": (0, "kept_all")}
    rows = store.read_store(spark, out)
    assert rows.where("episode_idx = 1").isEmpty() and rows.select(F.max("pixels.width")).first()[0] == 4
    assert check_stores(spark, out)[0].where("not valid").isEmpty()

    with pytest.raises(FileExistsError):
        convert(spark, root, out, "r", RAW, policy="warn", cameras=[CAMERAS[0]])
    convert(spark, root, out, "r", RAW, policy="warn", cameras=[CAMERAS[0]], overwrite=True)
    with pytest.raises(InvalidStore):
        check_stores(spark, out)
    assert check_stores(spark, out, strict_done=False)[0].where("not valid").isEmpty()
    convert(spark, root, str(tmp_path / "lax"), "r", RAW, require_terminal_done=False, splits=["train"])
    assert {r.split for r in store.list_stores(spark, str(tmp_path / "lax")).collect()} == {"train"}


def wanted_videos(spark, but=2):
    rows = [("train", e, c, n, 0) for e, n in enumerate(LENGTHS) for c in CAMERAS if e != but]
    return spark.createDataFrame(rows, "split string, episode_index long, camera string, ep_len long, ep_offset long")


@pytest.mark.parametrize("files_a_task", [1, 4, 1000])
def test_files_are_opened_in_the_tasks(spark, tmp_path, files_a_task):
    root = make_raw(spark, str(tmp_path / "raw"))
    located = locate(wanted_videos(spark), source.read_videos(spark, root).drop("content"), files_a_task)
    assert "content" not in located.columns and located.rdd.getNumPartitions() == -(-8 // files_a_task)
    plan = located._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "BroadcastHashJoin" not in plan
    frames = decode(located, RAW, expected="expected").select("episode_index", "camera", "frame_pos", "pixels.data").collect()
    assert {(r.episode_index, r.camera, r.frame_pos): r.data[0] for r in frames} == {
        (e, c, k): 10 * e + k + 100 * at for e, n in enumerate(LENGTHS) for at, c in enumerate(CAMERAS) for k in range(n) if e != 2
    }
    carried = decode(locate(wanted_videos(spark), source.read_videos(spark, root)), RAW, expected="expected")
    assert carried.count() == len(frames)


def test_small_files_share_a_task(spark, tmp_path):
    """1,000 files of some bytes took 63 tasks of 16 files, however small; now no more than twice what runs at once."""
    folder = tmp_path / "videos" / "cam"
    folder.mkdir(parents=True)
    for e in range(1000):
        folder.joinpath(f"episode_{e}.mp4").write_bytes(bytes([e % 251] * 12 * (1 + e % 3)))
    wanted = spark.range(1000).selectExpr("'s' as split", "id as episode_index", "'cam' as camera", "1 + id % 3 as ep_len", "0L as ep_offset")
    files = source.read_videos(spark, str(tmp_path)).drop("content")
    located = locate(wanted, files)
    assert "n_bytes" not in located.columns
    assert located.rdd.getNumPartitions() == min(63, 2 * spark.sparkContext.defaultParallelism)
    many = [(r.episode_index, r.frame_pos, r.pixels.data[0]) for r in decode(located, RAW, expected="expected").collect()]
    assert sorted(many) == [(e, k, e % 251) for e in range(1000) for k in range(1 + e % 3)]


def test_sparse_ids_and_odd_names(spark, tmp_path):
    folder = tmp_path / "videos" / "cam a%20b"
    folder.mkdir(parents=True)
    ids = [0, 7, 10**9, 10**15]
    for e in ids:
        folder.joinpath(f"episode_{e}.mp4").write_bytes(bytes([e % 251] * 12))
    files = source.read_videos(spark, str(tmp_path)).drop("content")
    wanted = spark.createDataFrame([("s", e, "cam a%20b", 1, 0) for e in ids], "split string, episode_index long, camera string, ep_len long, ep_offset long")
    located = locate(wanted, files)
    assert located.rdd.getNumPartitions() == 1
    assert {r.episode_index: r.pixels.data[0] for r in decode(located, RAW, expected="expected").collect()} == {e: e % 251 for e in ids}
    more = wanted.withColumn("episode_index", F.col("episode_index") + 1)
    with pytest.raises(FileNotFoundError):
        locate(more, files)
    with pytest.raises(ValueError, match="several"):
        locate(wanted, files.unionByName(files.limit(1)))


def test_opener_of_the_caller(spark, tmp_path):
    root = make_raw(spark, str(tmp_path / "raw"))
    convert(spark, root, str(tmp_path / "out"), "r", RAW, opener=lambda path: bytes([1]) * 12 * 5)
    assert {bytes(r.pixels.data) for r in store.read_store(spark, str(tmp_path / "out")).collect()} == {bytes([1] * 12)}


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_rows_in_place_are_found_by_one_join(spark, tmp_path, monkeypatch):
    root = make_raw(spark, str(tmp_path / "raw"), dirty=(1,))
    taken = []
    real = plans.positioned
    monkeypatch.setattr(plans, "positioned", lambda *a: taken.append((a[3], real(*a))) or taken[-1][1])
    convert(spark, root, str(tmp_path / "a"), "r", RAW, policy="drop")
    assert taken[0][0] and scans(taken[0][1]) == 1
    # Frames that start at 1 are kept by the policy "warn": positions come from a scan.
    convert(spark, make_raw(spark, str(tmp_path / "late"), first=1), str(tmp_path / "b"), "r", RAW, policy="warn")
    assert not taken[1][0]
    for out, n in (("a", sum(LENGTHS) - LENGTHS[1]), ("b", sum(LENGTHS))):
        rows = store.read_store(spark, str(tmp_path / out)).where(F.col("camera") == CAMERAS[0])
        by_split = rows.groupBy("split").agg(F.count_distinct("row").alias("n"), F.max("row").alias("top")).collect()
        assert sum(r.n for r in by_split) == n and all(r.top == r.n - 1 for r in by_split)


@pytest.mark.parametrize("case", ["turned", "repeated"])
def test_order_of_episodes_against_index(spark, case):
    """Episodes that follow the index the other way round are not in place; a common index keeps them by number."""
    data = [(e, k, k == 2, (9 - e) * 10 + k if case == "turned" else 5) for e in range(4) for k in range(3)]
    steps = spark.createDataFrame([("s", *r) for r in data], "split string, episode_index long, frame_index long, done boolean, index long")
    table = spark.createDataFrame([("s", e, e, 3, 3 * e) for e in range(4)], "split string, ep_pos long, episode_index long, ep_len long, ep_offset long")
    n, in_place = plans.check_totals(runs(steps, ["split"]), table)
    assert n == 12 and in_place == (case == "repeated")
    got = {(r.episode_index, r.frame_index): r.row for r in plans.positioned(steps, table, 4, in_place).collect()}
    order = sorted(data, key=lambda r: (r[3], r[0], r[1]))
    assert got == {(e, k): n for n, (e, k, _, _) in enumerate(order)}


def test_source_is_read_at_most_four_times(spark, tmp_path, monkeypatch):
    """Every row that a job reads passes a counter; the ranges, the pieces and the write read it once each."""
    root = make_raw(spark, str(tmp_path / "raw"))
    passed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    real = plans.canonical_steps
    monkeypatch.setattr(plans, "canonical_steps", lambda df: real(df).mapInArrow(counting, real(df).schema))
    convert(spark, root, str(tmp_path / "out"), "r", RAW, policy="drop")
    assert passed.value <= 4 * sum(LENGTHS)


def test_session_and_tables_are_left_alone(spark, tmp_path):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")) if spark.sparkContext.getCheckpointDir() else None
    held = set(folder.iterdir()) if folder else set()
    summary = convert(spark, make_raw(spark, str(tmp_path / "raw")), str(tmp_path / "out"), "r", RAW)
    assert spark.conf.get(name) == before and summary.count() == 2
    if folder:
        assert set(folder.iterdir()) == held


def test_failures(spark, tmp_path):
    out = str(tmp_path / "out")
    root = make_raw(spark, str(tmp_path / "short"), short=(2,))
    with pytest.raises(Exception, match="ended early"):
        convert(spark, root, out, "r", RAW)
    assert store.list_stores(spark, out).isEmpty()
    root = make_raw(spark, str(tmp_path / "declared"), declared=[3, 4, 2, 6, 3])
    with pytest.raises(RuntimeError, match="declare 15"):
        convert(spark, root, out, "r", RAW)
    root = make_raw(spark, str(tmp_path / "all"), dirty=range(5))
    with pytest.raises(DirtyEpisodes, match="No episodes"):
        convert(spark, root, out, "r", RAW, policy="drop")
    for bad in ({"policy": "x"}, {"compression": "x"}, {"image_size": 0}, {"batch": 0}, {"splits": ["x"]}, {"cameras": ["x"]}):
        with pytest.raises(ValueError):
            convert(spark, root, out, "r", RAW, **bad)
