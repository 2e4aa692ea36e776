import random
import re
from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from models import slice_issues_of, store_issues_of
from pyspark.sql import functions as F

from checks import views
from episodica import check_stores, replay
from episodica.functions import fixed as K
from episodica.operators import ordering, store_checks as V
from episodica.operators import slices as operators_slices
from episodica.operators.slices import assign_slices, doubtful_slices, row_pieces, slice_units, summarise_slices
from episodica.plans.convert import attributes
from episodica.sources import store, versions

CAMERA = "observation.images.front"


def rows_of(spark, steps, split="train", camera=CAMERA, shape=(4, 4, 3)):
    """steps: (episode, step, done) by position."""
    data = [
        (i, (*shape, bytes(shape[0] * shape[1] * shape[2])), [0.0, 0.0], [0.0, 0.0], [0.0, 0.0], e, s, bool(d), float(i), i, 0, split, camera)
        for i, (e, s, d) in enumerate(steps)
    ]
    return spark.createDataFrame(data, K.STORE_SCHEMA)


def table_of(spark, lengths, offsets, split="train"):
    data = [(i, i, n, o, split) for i, (n, o) in enumerate(zip(lengths, offsets))]
    return spark.createDataFrame(data, K.EPISODE_TABLE_SCHEMA[:-1])


def messages(found):
    return [r.message for r in sorted(found.collect(), key=lambda r: (r.camera, r.ep_pos, r.check))]


def four_rows(done):
    return [(e, s, d) for (e, s), d in zip([(0, 0), (0, 1), (1, 0), (1, 1)], done)]


@pytest.mark.parametrize(
    "done,text", [([0, 1, 0, 1], None), ([0, 0, 0, 1], "terminal step has done=False"), ([1, 1, 0, 1], "before terminal step")]
)
def test_literal_stores(spark, done, text):
    found = messages(V.validate(rows_of(spark, four_rows(done)), table_of(spark, [2, 2], [0, 2])))
    assert found == [] if text is None else len(found) == 1 and text in found[0]


@pytest.mark.parametrize("seed", range(4))
def test_random_stores_match_the_model(spark, seed):
    rng = random.Random(100 + seed)
    steps, lengths, offsets = [], [], []
    for e in range(rng.randint(1, 12)):
        n = rng.choice([1, 2, 3, 70, 130])
        offsets.append(len(steps))
        lengths.append(n)
        steps += [(e if rng.random() > 0.01 else e + 1, k + (rng.random() < 0.01), k == n - 1) for k in range(n)]
    for _ in range(3):
        i = rng.randrange(len(lengths))
        lengths[i] += rng.choice([-200, -3, -1, 0, 1, 5, 400])
        i = rng.randrange(len(offsets))
        offsets[i] = max(0, offsets[i] + rng.choice([-4, 0, 3, 60]))
    want = [(-1, m) for m in store_issues_of(len(steps), lengths, offsets)] + slice_issues_of(steps, list(zip(lengths, offsets)))
    rows = rows_of(spark, steps, shape=(1, 1, 1)).repartition(3)
    found = V.validate(rows, table_of(spark, lengths, offsets), bits=(2, 20))
    assert [(r.ep_pos, r.message) for r in sorted(found.collect(), key=lambda r: (r.ep_pos, r.check))] == want


def test_zero_length_slice_is_reported_without_a_crash(spark):
    found = messages(V.validate(rows_of(spark, four_rows([0, 1, 0, 1])), table_of(spark, [2, 0, 2], [0, 2, 2])))
    assert found == [K.NON_POSITIVE_LEN, K.SLICE_MIXED % 1]


def test_columns_pixels_and_index_types(spark):
    rows, table = rows_of(spark, four_rows([0, 1, 0, 1])), table_of(spark, [2, 2], [0, 2])
    assert messages(V.validate(rows.drop("state"), table)) == [K.MISSING_KEYS % ["state"]]
    assert messages(V.validate(rows_of(spark, four_rows([0, 1, 0, 1]), shape=(2, 2, 2)), table)) == [K.PIXELS_CHANNELS % 2]
    mixed = rows.withColumn("pixels", F.col("pixels").withField("height", F.col("row").cast("int")))
    assert messages(V.validate(mixed, table)) == [K.PIXELS_RANK % 1]
    short = rows.withColumn("action", F.when(F.col("row") > 0, F.col("action")))
    assert messages(V.validate(short, table)) == [K.LENGTH_MISMATCH % "'action': 3"]
    nested = table.withColumn("ep_len", F.array("ep_len"))
    assert messages(V.validate(rows, nested)) == [K.INDEX_RANK]
    fewer = table.withColumn("ep_offset", F.when(F.col("ep_pos") == 0, F.col("ep_offset")))
    assert messages(V.validate(rows, fewer)) == [K.INDEX_LENGTHS % (2, 1)]


def test_stores_are_judged_apart(spark):
    good, bad = four_rows([0, 1, 0, 1]), four_rows([0, 1, 0, 0])
    rows = rows_of(spark, good).unionByName(rows_of(spark, bad, camera="wrist")).unionByName(rows_of(spark, good, split="val"))
    table = table_of(spark, [2, 2], [0, 2]).unionByName(table_of(spark, [2, 2], [0, 2], "val"))
    verdicts = V.verdicts(rows.select("split", "camera").distinct(), V.validate(rows, table))
    assert {(r.split, r.camera): (r.valid, r.n_errors) for r in verdicts.collect()} == {
        ("train", CAMERA): (True, 0),
        ("train", "wrist"): (False, 1),
        ("val", CAMERA): (True, 0),
    }
    assert V.any_error(verdicts).first().any_error
    assert not V.any_error(verdicts.where("valid")).first().any_error


@pytest.mark.parametrize("block_bits", [1, 3, 6])
def test_slices_equal_a_plain_range_join(spark, block_bits):
    rows = spark.range(500).select(F.col("id").alias("row"), F.lit("a").alias("split"))
    data = [("a", i, o, n) for i, (o, n) in enumerate([(0, 10), (5, 300), (5, 300), (490, 40), (-3, 9), (20, 0), (30, -4), (0, 500)])]
    slices = spark.createDataFrame(data, "split string, ep_pos long, ep_offset long, ep_len long").withColumn("n_rows", F.lit(500))
    got = assign_slices(rows, slices, "n_rows", block_bits=block_bits).select("ep_pos", "row").collect()
    assert sorted(map(tuple, got)) == [(i, r) for _, i, o, n in data for r in range(500) if o <= r < o + n]


@pytest.mark.parametrize("bits", [(0, 1, 2, 3), (0, 2, 5), (0, 6, 14, 22)])
def test_units_tile_every_slice(spark, bits):
    rng = random.Random(7)
    data = [(i, lo, lo + rng.choice([1, 2, 9, 64, 65, 700, 40000])) for i, lo in enumerate(rng.randrange(0, 90000) for _ in range(60))]
    got = {}
    for r in slice_units(spark.createDataFrame(data, "ep_pos long, lo long, hi long"), bits).collect():
        got.setdefault(r.ep_pos, []).append((r.unit << bits[r.level], (r.unit + 1) << bits[r.level]))
    for i, lo, hi in data:
        at = lo
        for start, stop in sorted(got[i]):
            assert start == at
            at = stop
        assert at == hi
    if len(bits) == 4 and bits[1] == 6:
        assert max(map(len, got.values())) <= 126 + 510


def test_overlapping_slices_over_all_rows(spark):
    steps = [(0, k, k == 299) for k in range(300)]
    lengths, offsets = [300] * 40, [0] * 40
    found = V.validate(rows_of(spark, steps, shape=(1, 1, 1)), table_of(spark, lengths, offsets))
    assert messages(found) == store_issues_of(300, lengths, offsets)


@pytest.mark.parametrize("seed", range(3))
def test_summaries_of_rows_that_share_places(spark, seed):
    """Slices over rows of which some places are taken twice, or by no row, with ids and flags that are missing."""
    rng, odd = random.Random(seed), seed > 0
    some = lambda value, share: value if rng.random() < share else None
    rows = [(i, some(i % 7, 0.97), some(i // 7, 0.97), some(i % 7 == 6, 0.9)) for i in range(300)]
    if odd:
        rows = [r for r in rows if rng.random() < 0.98] + [(r[0], r[1], r[2], rng.random() < 0.5) for r in rng.choices(rows, k=20)]
    spans = [(lo, lo + rng.choice([1, 7, 7, 64, 128, 150])) for lo in [0, 64, 128, 63, *(rng.randrange(0, 21) * 7 for _ in range(25))]]
    table = spark.createDataFrame([("a", k, lo, hi - lo) for k, (lo, hi) in enumerate(spans)], "split string, ep_pos long, ep_offset long, ep_len long")
    df = spark.createDataFrame([("a", *r) for r in rows], "split string, row long, step_idx long, episode_idx long, done boolean").repartition(3)
    got = {r.ep_pos: (r.found, bool(r.bad_steps), bool(r.mixed), r.ends_done, r.early_done) for r in summarise_slices(df, table, ["split"]).collect()}
    want = {}
    for k, (lo, hi) in enumerate(spans):
        of = [r for r in rows if lo <= r[0] < hi]
        ids, ends = {r[2] for r in of} - {None}, any(r[3] for r in of if r[0] == hi - 1)
        bad = any(r[1] is not None and r[1] != r[0] - lo for r in of)
        want[k] = (len(of), bad, len(ids) > 1, ends, sum(bool(r[3]) for r in of) > ends)
    assert got == {k: v for k, v in want.items() if v[0]}


def test_only_slices_of_odd_blocks_are_looked_into(spark):
    """640 episodes of 5 rows; a wrong step, a wrong flag, a place taken twice and two slices over the same rows."""
    rows = spark.range(3200).selectExpr("'a' as split", "id as row", "id % 5 as step_idx", "id div 5 as episode_idx", "id % 5 = 4 as done")
    table = spark.range(640).selectExpr("'a' as split", "id as ep_pos", "5L as ep_len", "id * 5 as ep_offset", "id as episode_index")
    assert doubtful_slices(rows, table, ["split"])[2] == 0

    wrong = rows.withColumns({"step_idx": F.when(F.col("row") == 700, 3).otherwise(F.col("step_idx")), "done": F.when(F.col("row") == 1400, True).otherwise(F.col("done"))})
    wrong = wrong.unionByName(rows.where("row between 2100 and 2104"))
    slices = table.unionByName(table.where("ep_pos between 420 and 420 or ep_pos = 560").withColumn("ep_pos", F.col("ep_pos") + 1000))
    found, blocks, n = doubtful_slices(wrong, slices, ["split"])
    named = {r.ep_pos for r in found.collect()}
    assert {140, 280, 420, 560, 1420, 1560} <= named and n == len(named) < 80
    assert {r.block for r in blocks.collect()} >= {700 // 64, 1400 // 64, 2100 // 64, 2800 // 64}


def test_written_tables_are_joined_by_their_length(spark, monkeypatch):
    """Blocks and slices to look into went to the driver and every executor if their file was small, however many rows it held."""
    rows = spark.range(3200).selectExpr(
        "'a' as split", "'c' as camera", "id as row", "case when id % 700 = 99 then 3 else id % 5 end as step_idx", "id div 5 as episode_idx", "id % 5 = 4 as done"
    )
    rows = rows.unionByName(rows.where("row between 2100 and 2104"))
    slices = spark.range(640).selectExpr(
        "'a' as split", "'c' as camera", "id as ep_pos", "if(id = 500, 6L, 5L) as ep_len", "id * 5 as ep_offset", "id as episode_index", "3200L as n_rows"
    )
    want = messages(V.slice_messages(rows, slices))
    plans = []

    def written(df, *figure):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return ordering.spooled(df, *figure)

    monkeypatch.setattr(operators_slices, "spooled", written)
    monkeypatch.setattr(operators_slices, "LISTED_BLOCKS", 2)
    found = V.slice_messages(rows, slices)
    assert messages(found) == want and len(want) > 4
    joins = [p for p in plans if "Join" in p]
    assert len(joins) >= 3 and not any("BroadcastHashJoin" in p for p in joins)
    met = found._jdf.queryExecution().optimizedPlan().toString()
    assert met.count("strategy=merge") >= 2


def test_an_episode_is_one_piece_of_a_block(spark):
    """Single rows used to be shuffled one by one; an episode of 16 rows is one piece now."""
    rows = spark.range(64 * 50).selectExpr("'a' as split", "id as row", "id % 16 as step_idx", "id div 16 as episode_idx", "id % 16 = 15 as done")
    assert row_pieces(rows, ["split"]).count() == 64 * 50 // 16


def test_inspect(spark):
    rows, table = rows_of(spark, four_rows([0, 1, 0, 1])), table_of(spark, [2, 2], [0, 2])
    assert tuple(V.inspect(rows, table).first())[2:] == (2, 4)
    assert tuple(V.inspect(rows).first())[2:] == (2, 4)
    assert tuple(V.inspect(rows.drop("episode_idx")).first())[2:] == (None, None)
    found = {r.column: (r.shape, r.dtype) for r in V.inspect_columns(rows, table).collect()}
    assert found["pixels"] == ("[4, 4, 4, 3]", "uint8")
    assert found["action"] == ("[4, 2]", "float32")
    assert found["done"] == ("[4]", "bool")
    assert found["ep_len"] == ("[2]", "int64")
    assert "row" not in found and len(found) == 12


def write(spark, root, mode="error", compression="lzf", splits=("train",), cameras=(CAMERA,), done=(0, 1, 0, 1)):
    rows, table = None, None
    for s in splits:
        part = table_of(spark, [2, 2], [0, 2], s)
        table = part if table is None else table.unionByName(part)
        for c in cameras:
            one = rows_of(spark, four_rows(done), s, c)
            rows = one if rows is None else rows.unionByName(one)
    store.write_store(rows, table, attributes(spark, "some/data", 10, splits, cameras), root, mode, compression)


@pytest.mark.parametrize("compression", ["none", "lzf", "gzip"])
def test_write_and_read_back(spark, tmp_path, compression):
    root = str(tmp_path / "s")
    write(spark, root, compression=compression, splits=("001", "val"))
    back = store.read_store(spark, root)
    assert back.count() == 8 and {r.split for r in back.select("split").distinct().collect()} == {"001", "val"}
    assert V.validate(back, store.read_episode_table(spark, root)).isEmpty()
    first = store.read_attributes(spark, root).where("split = 'val'").first()
    assert (first.source_repo_id, first.source_split, first.source_camera_key, first.fps) == ("some/data", "val", CAMERA, 10)


def test_rows_in_order_are_written_as_they_lie(spark, tmp_path):
    """No shuffle and no sort: every task writes its own rows to one file for each store, and positions take next to no room."""
    rows = rows_of(spark, [(i // 5, i % 5, i % 5 == 4) for i in range(3000)], shape=(1, 1, 1)).repartitionByRange(3, "row").sortWithinPartitions("row")
    both = rows.drop("camera").withColumn("camera", F.explode(F.array(F.lit(CAMERA), F.lit("wrist"))))
    table = table_of(spark, [5] * 600, range(0, 3000, 5))
    setting = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    store.write_store(both, table, attributes(spark, "x", 10, ["train"], [CAMERA, "wrist"]), str(tmp_path), in_order=True)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == setting
    files = sorted(tmp_path.glob("steps/**/*.parquet"))
    assert len(files) == 6
    held = []
    for f in files:
        at = pq.read_table(f, columns=["row"], partitioning=None)["row"].to_pylist()
        assert at == list(range(at[0], at[0] + len(at)))
        held += at
        group = pq.ParquetFile(f).metadata.row_group(0)
        size = {group.column(k).path_in_schema: group.column(k).total_compressed_size for k in range(group.num_columns)}
        assert size["row"] < len(at) and size["episode_idx"] < len(at)
    assert sorted(held) == sorted([*range(3000)] * 2)


def test_rows_in_order_of_many_stores_need_no_sort(spark, tmp_path, monkeypatch):
    """A task with rows of all splits keeps a file of each store open: Spark sorts the rest when as many as allowed are open."""
    allowed, splits_, cameras = [], ["test", "train", "val"], [CAMERA, "wrist"]
    setting = store.setting
    monkeypatch.setattr(store, "setting", lambda spark, name, value: allowed.append((name, int(value))) or setting(spark, name, value))
    rows = rows_of(spark, [(i // 5, i % 5, i % 5 == 4) for i in range(30)], shape=(1, 1, 1)).drop("split", "camera")
    for name, values in (("split", splits_), ("camera", cameras)):
        rows = rows.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    index = table_of(spark, [5] * 6, range(0, 30, 5)).drop("split").withColumn("split", F.explode(F.array(*map(F.lit, splits_))))
    store.write_store(rows.coalesce(1), index, attributes(spark, "x", 10, splits_, cameras), str(tmp_path), in_order=True)
    assert all(n > 6 for name, n in allowed if name.endswith("OutputFileWriters")) and allowed
    files = sorted(tmp_path.glob("steps/**/*.parquet"))
    assert len(files) == 6
    assert all(pq.read_table(f, columns=["row"], partitioning=None)["row"].to_pylist() == list(range(30)) for f in files)


def test_cells_of_lines_take_one_window(spark, tmp_path):
    lines = [(o, 1, 1, n, 1.0, 2.0, 0.5, 0.25, datetime(2020, 1, 1)) for o, n in [(1, 1), (1, 2), (1, 2), (2, 7), (None, 1), (None, 3)]]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1,), (2,), (3,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    cells = views._line_cells(spark, str(tmp_path))
    rows = sorted(tuple(r) for r in cells.na.fill(-1, ["ep"]).select("ep", "step0", "n", "is_last").collect())
    assert rows == [(-1, 0, 2, False), (-1, 1, 2, True), (1, 0, 3, False), (1, 1, 3, False), (1, 2, 3, True), (2, 0, 1, True)]
    plan = cells.drop("n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def test_overwrite_guard(spark, tmp_path):
    root = str(tmp_path / "s")
    write(spark, root)
    with pytest.raises(FileExistsError):
        write(spark, root)
    write(spark, root, splits=("val",))
    write(spark, root, mode="overwrite", done=(1, 1, 1, 1))
    back = store.read_store(spark, root)
    assert {(r.split, r.n) for r in back.groupBy("split").agg(F.count_if("done").alias("n")).collect()} == {("train", 4), ("val", 2)}
    with pytest.raises(ValueError):
        write(spark, root, compression="zip")
    with pytest.raises(ValueError):
        write(spark, root, mode="append")


def test_cameras_have_their_own_episodes(spark, tmp_path):
    root = str(tmp_path / "s")
    write(spark, root)
    rows = rows_of(spark, [(7, 0, 0), (7, 1, 0), (7, 2, 1)], camera="wrist")
    table, named = table_of(spark, [3], [0]), attributes(spark, "some/data", 10, ["train"], ["wrist"])
    store.write_store(rows, table, named, root)
    back, index = store.read_store(spark, root), store.read_episode_table(spark, root)
    assert V.validate(back, index, pixel_bytes=True).isEmpty()
    assert store.episode_bounds(index, "train", "wrist", 0) == (0, 3)
    assert store.episode_bounds(index, "train", CAMERA, 1) == (2, 2)
    assert {(r.camera, r.num_episodes, r.total_steps) for r in V.inspect(back, index).collect()} == {(CAMERA, 2, 4), ("wrist", 1, 3)}


def done_of(spark, root):
    rows = store.read_store(spark, root).groupBy("split", "camera").agg(F.count_if("done").alias("n"), F.count(F.lit(1)).alias("rows"))
    return {(r.split, r.camera): (r.n, r.rows) for r in rows.collect()}


def test_a_failed_write_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "s")
    write(spark, root, cameras=(CAMERA, "wrist"))
    before = done_of(spark, root)
    named = attributes(spark, "some/data", 10, ["train"], [CAMERA])
    broken = table_of(spark, [2, 2], [0, 2]).withColumn("ep_len", F.expr("ep_len + cast(raise_error('no index') as bigint)"))
    for rows, table, why in (
        (rows_of(spark, four_rows([1, 1, 1, 1])), broken, "no index"),
        (rows_of(spark, four_rows([0, 1, 0, 1])[:3]), table_of(spark, [2, 2], [0, 2]), "sum"),
    ):
        with pytest.raises(Exception, match=why):
            store.write_store(rows, table, named, root, "overwrite")
        assert done_of(spark, root) == before and store.list_stores(spark, root).count() == 2
        assert V.validate(store.read_store(spark, root), store.read_episode_table(spark, root)).isEmpty()
    versions.remove_superseded(spark, root, older_than_hours=1)
    assert len(list(Path(root, "steps").iterdir())) == 3
    assert len(versions.remove_superseded(spark, root, older_than_hours=0)) >= 3 and done_of(spark, root) == before


def test_overwrite_with_no_rows_leaves_no_old_row(spark, tmp_path):
    root = str(tmp_path / "s")
    write(spark, root, cameras=(CAMERA, "wrist"))
    named = attributes(spark, "some/data", 10, ["train"], [CAMERA])
    store.write_store(rows_of(spark, four_rows([0, 1, 0, 1])).limit(0), table_of(spark, [2, 2], [0, 2]).limit(0), named, root, "overwrite")
    assert done_of(spark, root) == {("train", "wrist"): (2, 4)}
    (empty, full) = store.records(spark, root)
    assert (empty.n_rows, empty.n_files, full.n_rows) == (0, 0, 4) and full.n_files > 0
    assert store.read_store(spark, root, [("train", CAMERA)]).isEmpty()
    assert store.read_episode_table(spark, root).select("camera").distinct().count() == 1


@pytest.mark.parametrize("mode", ["error", "overwrite"])
def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch, mode):
    """Another writer publishes while the files of the first are under way: of the same store, or of another one."""
    root = str(tmp_path / "s")
    if mode == "overwrite":
        write(spark, root)
    real = store.files_per_store

    def second(*args):
        monkeypatch.setattr(store, "files_per_store", real)
        write(spark, root, mode, cameras=(other,), done=(1, 1, 1, 1))
        return real(*args)

    other = CAMERA
    monkeypatch.setattr(store, "files_per_store", second)
    with pytest.raises(versions.ConcurrentWrite):
        write(spark, root, mode)
    assert done_of(spark, root) == {("train", CAMERA): (4, 4)}
    other = "wrist"
    monkeypatch.setattr(store, "files_per_store", second)
    write(spark, root, "overwrite")
    assert done_of(spark, root) == {("train", CAMERA): (2, 4), ("train", "wrist"): (4, 4)}


def test_a_number_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert versions._put_new(spark, path, "a") and not versions._put_new(spark, path, "b")
    assert Path(path).read_text() == "a" and [p.name for p in Path(path).parent.iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_stores_of_different_columns(spark, tmp_path):
    """Every store is listed, validated and read by the columns that it has, and by nothing of the others."""
    root = str(tmp_path / "s")
    write(spark, root)
    rows = rows_of(spark, four_rows([0, 1, 0, 1]), camera="wrist").drop("proprio").withColumn("force", F.lit(1.5))
    store.write_store(rows, table_of(spark, [2, 2], [0, 2]), attributes(spark, "d", 10, ["train"], ["wrist"]), root)
    listed = {(r.camera, r.column): r.shape for r in check_stores(spark, root, "inspect")[1].collect()}
    assert (CAMERA, "force") not in listed and listed["wrist", "force"] == "[4]"
    assert ("wrist", "proprio") not in listed and listed[CAMERA, "proprio"] == "[4, 2]"
    found = {r.camera: r.message for r in check_stores(spark, root, fail_on_error=False)[1].collect()}
    assert found == {"wrist": K.MISSING_KEYS % ["proprio"]}
    assert "force" not in store.read_store(spark, root, [("train", CAMERA)]).columns
    assert store.read_store(spark, root).where("force is null").count() == 4
    # The files of the other store are not opened, not even for their footers.
    for file in Path(root, "steps").rglob("*"):
        if "wrist" in str(file) and file.is_file():
            file.write_bytes(b"no footer")
    assert store.read_store(spark, root, [("train", CAMERA)]).agg(F.sum("row")).first()[0] == 6
    assert replay(spark, root, "train", CAMERA).signals.count() > 0
    clash = rows.withColumn("force", F.lit("x")).withColumn("camera", F.lit("third"))
    store.write_store(clash, table_of(spark, [2, 2], [0, 2]), attributes(spark, "d", 10, ["train"], ["third"]), root)
    with pytest.raises(TypeError, match="force"):
        store.read_store(spark, root)


def test_stores_written_without_commits(spark, tmp_path):
    root = str(tmp_path / "s")
    rows, table = rows_of(spark, four_rows([0, 1, 0, 1])), table_of(spark, [2, 2], [0, 2]).withColumn("camera", F.lit(CAMERA))
    rows.drop("proprio").write.partitionBy("split", "camera").parquet(f"{root}/steps")
    table.write.partitionBy("split", "camera").parquet(f"{root}/episodes")
    attributes(spark, "old", 5, ["train"], [CAMERA]).withColumn("complete", F.lit(True)).write.partitionBy("split", "camera").parquet(f"{root}/attributes")
    (record,) = store.records(spark, root)
    assert record.version is None and "proprio" not in record.columns.names and record.source_repo_id == "old"
    write(spark, root, cameras=("wrist",))
    assert done_of(spark, root) == {("train", CAMERA): (2, 4), ("train", "wrist"): (2, 4)}
    assert {r.camera: r.n_errors for r in check_stores(spark, root, fail_on_error=False)[0].collect()} == {CAMERA: 1, "wrist": 0}
    write(spark, root, mode="overwrite", done=(1, 1, 1, 1))
    assert done_of(spark, root)["train", CAMERA] == (4, 4) and store.read_store(spark, root).where("proprio is null").isEmpty()


def test_wrong_frames_are_known_from_the_write(spark, tmp_path):
    root = str(tmp_path / "s")
    torn = rows_of(spark, four_rows([0, 1, 0, 1])).withColumn("pixels", F.expr("if(row = 2, named_struct('height', 4, 'width', 4, 'channels', 3, 'data', X'00'), pixels)"))
    (record,) = store.write_store(torn, table_of(spark, [2, 2], [0, 2]), attributes(spark, "d", 10, ["train"], [CAMERA]), root)
    assert (record.n_rows, record.n_torn) == (4, 1)
    assert [r.message for r in check_stores(spark, root, fail_on_error=False)[1].collect()] == [K.PIXELS_RANK % 1]
    assert check_stores(spark, root, pixel_bytes=False)[1].isEmpty()


def test_what_is_on_disk_is_checked(spark, tmp_path):
    rows, table = rows_of(spark, four_rows([0, 1, 0, 1])), table_of(spark, [2, 2], [0, 2])
    named = attributes(spark, "some/data", 10, ["train"], [CAMERA])

    def stored(label, rows, table=table, verify=True):
        root = str(tmp_path / label)
        store.write_store(rows, table, named, root, verify=verify)
        return store.read_store(spark, root), store.read_episode_table(spark, root)

    back, index = stored("keys", rows.drop("action", "proprio"))
    assert "action" not in back.columns and messages(V.validate(back, index)) == [K.MISSING_KEYS % ["action", "proprio"]]
    with pytest.raises(KeyError):
        V.check_replay_columns(back, index)
    back, index = stored("torn", rows.withColumn("pixels", F.col("pixels").withField("data", F.lit(b"12"))))
    assert messages(V.validate(back, index)) == [] and messages(V.validate(back, index, pixel_bytes=True)) == [K.PIXELS_RANK % 1]
    back, index = stored("text", rows.withColumn("pixels", F.lit("x")))
    assert messages(V.validate(back, index)) == [K.PIXELS_RANK % 1]
    back, index = stored("nested", rows, table.withColumn("ep_offset", F.array("ep_offset")))
    assert messages(V.validate(back, index)) == [K.INDEX_RANK]
    back, index = stored("none", rows, table.limit(0), verify=False)
    assert "ep_len" not in index.columns and tuple(V.inspect(back, index).first())[2:] == (2, 4)
    assert messages(V.validate(back, index)) == [K.MISSING_KEYS % ["ep_len", "ep_offset"]]
    both = rows.withColumn("action", F.lit(None).cast("array<float>")).withColumn("camera", F.lit("wrist")).unionByName(rows)
    assert messages(V.validate(both, table)) == [K.MISSING_KEYS % ["action"]]


def test_discovery_and_selection(spark, tmp_path):
    root = str(tmp_path / "s")
    assert store.list_stores(spark, root).isEmpty()
    with pytest.raises(FileNotFoundError):
        store.select_store(store.list_stores(spark, root))
    write(spark, root, splits=("train", "val"), cameras=("observation.images.wrist", CAMERA))
    stores = store.list_stores(spark, root)
    assert [tuple(r) for r in stores.collect()] == sorted((s, c) for s in ("train", "val") for c in (CAMERA, "observation.images.wrist"))
    assert store.select_store(stores, "train", CAMERA) == ("train", CAMERA)
    assert store.select_store(stores, "val", "observation_images_wrist") == ("val", "observation.images.wrist")
    with pytest.raises(ValueError):
        store.select_store(stores, "train", None)
    with pytest.raises(ValueError):
        store.select_store(stores, "", CAMERA)
    with pytest.raises(FileNotFoundError):
        store.select_store(stores, "test")


def test_episode_selection(spark, tmp_path):
    table = table_of(spark, [2, 0, 2], [0, 2, 2]).withColumn("camera", F.lit(CAMERA))
    assert store.episode_bounds(table, "train", CAMERA, 2) == (2, 2)
    with pytest.raises(IndexError):
        store.episode_bounds(table, "train", CAMERA, 3)
    with pytest.raises(IndexError):
        store.episode_bounds(table, "train", CAMERA, -1)
    with pytest.raises(ValueError):
        store.episode_bounds(table, "train", CAMERA, 1)
    root = str(tmp_path / "s")
    write(spark, root)
    chosen = store.select_episode(store.read_store(spark, root), "train", CAMERA, 2, 2)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*isnotnull\(split", plan) and "GreaterThanOrEqual(row,2)" in plan
    assert [r.row for r in chosen.orderBy("row").collect()] == [2, 3]


def test_replay_columns(spark):
    rows, table = rows_of(spark, four_rows([0, 1, 0, 1])), table_of(spark, [2, 2], [0, 2])
    V.check_replay_columns(rows, table)
    with pytest.raises(KeyError):
        V.check_replay_columns(rows.select("pixels"), table)
    with pytest.raises(ValueError):
        V.check_replay_columns(rows.withColumn("pixels", F.lit("x")), table)
    V.check_replay_rows(rows)
    with pytest.raises(ValueError, match="numbers of values"):
        V.check_replay_rows(rows.withColumn("state", F.when(F.col("row") > 1, F.col("state"))))
    with pytest.raises(ValueError, match="got 2"):
        V.check_replay_rows(rows_of(spark, four_rows([0, 1, 0, 1]), shape=(1, 1, 2)))
