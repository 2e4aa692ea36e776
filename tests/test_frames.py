import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import queries as Q
from episodica.functions import fixed as K
from episodica.operators import frames as P


def raw_rgb(content):
    """Frames of 2 x 2 x 3 bytes."""
    for at in range(0, len(content), 12):
        yield np.frombuffer(content[at : at + 12], np.uint8).reshape(2, 2, 3)


def broken(content):
    raise OSError("cannot open")


def breaks_later(content):
    yield np.zeros((2, 2, 3), np.uint8)
    raise OSError("stream lost")


def test_frame_shapes():
    assert P.frame_bytes(np.zeros((5, 4))).shape == (5, 4, 1)
    assert P.frame_bytes(np.zeros((3, 5, 4))).shape == (5, 4, 3)
    assert P.frame_bytes(np.zeros((3, 5, 3))).shape == (3, 5, 3)
    for bad in (np.zeros((5, 4, 2)), np.zeros(4), np.zeros((1, 2, 3, 3))):
        with pytest.raises(ValueError):
            P.frame_bytes(bad)
    with pytest.raises(ValueError):
        P.frame_bytes(np.zeros((5, 4)), add_channel=False)


def test_frame_values():
    unit = np.array([[[-0.5], [0.0]], [[0.999], [1.0]]], np.float32)
    assert P.frame_bytes(unit).ravel().tolist() == [0, 0, 254, 255]
    wide = np.array([[[-3.0], [1.9]], [[254.9], [300.0]]])
    assert P.frame_bytes(wide).ravel().tolist() == [0, 1, 254, 255]
    assert P.frame_bytes(np.array([[[-1], [1], [300]]])).ravel().tolist() == [0, 1, 255]


def test_resize():
    for value, shape in ((0, (16, 20, 3)), (200, (16, 20, 3))):
        out = P.resize_frame(np.full(shape, value, np.uint8), 8)
        assert out.shape == (8, 8, 3) and out.dtype == np.uint8 and (out == value).all()
    any_frame = np.random.default_rng(1).integers(0, 256, (9, 9, 3), dtype=np.uint8)
    assert (P.resize_frame(any_frame, 9) == any_frame).all()
    ramp = np.tile(np.arange(0, 160, 10, dtype=np.uint8)[None, :, None], (16, 1, 1))
    assert P.resize_frame(ramp, 8)[0, :, 0].tolist() == [5, 25, 45, 65, 85, 105, 125, 145]
    exact = np.array([[[0], [100]], [[100], [200]]], np.uint8)
    assert P.resize_frame(exact, 4)[:, :, 0].tolist() == [
        [0, 25, 75, 100], [25, 50, 100, 125], [75, 100, 150, 175], [100, 125, 175, 200]
    ]


def test_values_and_bytes_agree(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.uniform(-1, 1 if i % 2 else 300, 6).astype(np.float32).tolist(), 1, 2, 3) for i in range(20)]
    df = spark.createDataFrame(data, "id int, values array<float>, height int, width int, channels int")
    by_expr = {r.id: r.v for r in df.select("id", P.normalise_values(F.col("values")).alias("v")).collect()}
    by_numpy = {r.id: list(r.data) for r in P.pixels_from_values(df).select("id", "pixels.data").collect()}
    assert by_expr == by_numpy
    small = P.resize(P.pixels_from_values(df), 1).select("pixels.*").first()
    assert (small.height, small.width, small.channels, len(small.data)) == (1, 1, 3, 3)
    with pytest.raises(ValueError):
        P.resize(df, 0)


@pytest.fixture
def videos(spark):
    data = [(0, "a", bytes(range(48)), 3), (1, "a", bytes(24), 3), (2, "a", b"", 0), (3, "b", bytes(36), 3)]
    return spark.createDataFrame(data, "episode_index long, camera string, content binary, ep_len long")


def test_decode_falls_through_and_counts(videos):
    out = P.decode(videos.where("ep_len > 0"), [("first", broken), ("second", raw_rgb)], batch=2)
    counted = {r.episode_index: r.decoded for r in P.count_frames(out, ["episode_index"]).collect()}
    assert counted == {0: 4, 1: 2, 3: 3}
    assert {tuple(r) for r in P.decoder_counts(out).collect()} == {("second", 3)}
    one = out.where("episode_index = 0 and frame_pos = 2").first()
    assert bytes(one.pixels.data) == bytes(range(24, 36)) and one.camera == "a"


def test_decode_stops_at_the_expected_frames(videos):
    out = P.decode(videos, [("raw", raw_rgb)], expected="ep_len", image_size=1)
    assert {r.episode_index: r.decoded for r in P.count_frames(out, ["episode_index"]).collect()} == {0: 3, 1: 2, 3: 3}
    assert out.select(F.max("pixels.height")).first()[0] == 1
    with pytest.raises(Exception, match="ended early"):
        P.decode(videos, [("raw", raw_rgb)], expected="ep_len", fail_short=True).count()


def test_texts_without_a_byte_have_no_frames(spark, tmp_path):
    """An empty or missing text is opened by no decoder; it ended the job."""
    texts = {1: "Capital", 2: "", 3: None, 4: "small " * 20, 5: "é" * 40}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = Q.decode_texts(spark, str(tmp_path)).collect()
    data = {i: t.encode() for i, t in texts.items() if t}
    want = {(i, k // 64): d[k : k + 64].ljust(64).hex().upper() for i, d in data.items() for k in range(0, len(d), 64)}
    assert {(r.episode_index, r.frame_pos): r.bytes for r in rows} == want and len(rows) == len(want)
    assert {r.decoder for r in rows if r.episode_index == 1} == {"any"}
    assert {tuple(r) for r in Q.decoder_counts(spark, str(tmp_path)).collect()} == {("any", 1), ("lower", 2)}


def test_decode_errors(videos):
    with pytest.raises(Exception, match="empty stream.*cannot open"):
        P.decode(videos, [("raw", raw_rgb), ("broken", broken)]).count()
    with pytest.raises(Exception, match="stream lost"):
        P.decode(videos, [("late", breaks_later), ("raw", raw_rgb)]).count()
    with pytest.raises(ValueError):
        P.decode(videos, [])
    with pytest.raises(ValueError):
        P.decode(videos, [("raw", raw_rgb)], batch=0)


def test_frame_counts(spark):
    keys = "split string, episode_index long, camera string"
    expected = spark.createDataFrame([("train", 1, "front", 6), ("train", 2, "front", 4), ("train", 3, "front", 0)], keys + ", expected long")
    decoded = spark.createDataFrame([("train", 1, "front", 5), ("train", 2, "front", 9), ("train", 3, "front", 1)], keys + ", decoded long")
    assert [r.episode_index for r in P.frame_count_issues(expected, decoded).collect()] == [1]
    assert sorted(r.episode_index for r in P.frame_count_issues(expected, decoded, strict=True).collect()) == [1, 2]
    nothing = P.frame_count_issues(expected, decoded.where("episode_index > 9")).collect()
    assert sorted((r.episode_index, r.decoded) for r in nothing) == [(1, 0), (2, 0)]


def test_frame_rows_cut_and_skip(spark):
    data = [(0, k, 3, 10, 2) for k in range(7)]
    df = spark.createDataFrame(data, "episode_index long, frame_pos long, ep_len long, ep_offset long, frame_offset long")
    assert sorted((r.frame_pos, r.row) for r in P.frame_rows(df).collect()) == [(2, 10), (3, 11), (4, 12)]
    assert sorted((r.frame_pos, r.row) for r in P.frame_rows(df.drop("frame_offset")).collect()) == [(0, 10), (1, 11), (2, 12)]


def test_pixels_schema(videos):
    out = P.decode(videos.where("ep_len > 0"), [("raw", raw_rgb)])
    assert out.schema["pixels"].dataType == K.PIXELS


def test_blocks_of_mixed_shapes(spark):
    """Frames of several shapes in one batch, square or not, give what each gives alone."""
    rng = np.random.default_rng(5)
    shapes = [(4, 6, 3), (4, 6, 3), (5, 3, 1), (3, 5, 7), (4, 6, 3), (4, 6, 3), (4, 6, 3)]
    frames = [rng.uniform(-0.2, 1 if i % 2 else 300, s).astype(np.float32) for i, s in enumerate(shapes)]
    rows = [(i, f.ravel().tolist(), *f.shape) for i, f in enumerate(frames)]
    df = spark.createDataFrame(rows, "id int, values array<float>, height int, width int, channels int").coalesce(1)
    assert list(P._shape_runs(np.array(shapes), 1 << 19)) == [(0, 2), (2, 3), (3, 4), (4, 6), (6, 7)]
    for size in (None, 3, 9):
        alone = {i: P.frame_bytes(f) for i, f in enumerate(frames)}
        alone = {i: f if size is None else P.resize_frame(f, size) for i, f in alone.items()}
        got = {r.id: r.pixels for r in P.pixels_from_values(df, size=size).collect()}
        again = {r.id: r.pixels for r in P.resize(P.pixels_from_values(df), size).collect()}
        for out in (got, again):
            assert {i: (p.height, p.width, p.channels, bytes(p.data)) for i, p in out.items()} == {i: (*f.shape, f.tobytes()) for i, f in alone.items()}
