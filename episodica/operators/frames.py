"""Frames: decode videos into rows, normalise and resize pixels, align frames with steps."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, groupby, islice
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from episodica.functions import fixed as K

Decoder = Callable[[bytes], Iterator[np.ndarray]]
Opener = Callable[[str], bytes]
FRAME_BATCH = 64
# Pixel values that one numpy call works on, and bytes from which on decoded frames are passed on.
BLOCK_VALUES, BATCH_BYTES = 1 << 20, 1 << 20


# --- pixels as arrays of numbers: stays in the JVM -------------------------------------------


def normalise_values(values: Column) -> Column:
    """uint8 values (array<int>) of a float frame: scaled by 255 if its maximum is at most 1."""
    # Single-precision factor: the product of a float value stays a float.
    scale = F.when(F.coalesce(F.array_max(values), F.lit(0.0)) <= 1, 255).otherwise(1).cast("float")
    return F.transform(values, lambda v: F.least(F.greatest(v * scale, F.lit(0)), F.lit(255)).cast("int"))


def to_hwc(values: Column, height: Column, width: Column, channels: Column) -> Column:
    """Reorder a flat channel-first frame to row-major height, width, channel."""

    def source(i: Column) -> Column:
        channel, y, x = i % channels, F.floor(i / (width * channels)), F.floor(i / channels) % width
        return ((channel * height + y) * width + x).cast("int")

    return F.transform(F.sequence(F.lit(0), height * width * channels - 1), lambda i: F.get(values, source(i)))


def normalise_channels(values: Column, mean: Sequence[float] = K.CHANNEL_MEAN, std: Sequence[float] = K.CHANNEL_STD) -> Column:
    """Values 0..255 of a channel-last frame as (value / 255 - mean) / std of their channel (array<double>).

    There are as many channels as means; the k-th value is of channel k modulo that number.
    """
    if len(mean) != len(std) or not len(mean) or 0 in std:
        raise ValueError("Every channel needs a mean and a standard deviation that is not zero.")
    means, stds = (F.array(*[F.lit(float(x)) for x in xs]) for xs in (mean, std))
    channel = lambda i: i % len(mean)
    return F.transform(values, lambda v, i: (v.cast("double") / 255 - F.get(means, channel(i))) / F.get(stds, channel(i)))


# --- pixels as bytes: Arrow batches with numpy -----------------------------------------------


def block_bytes(block: np.ndarray, add_channel: bool = True) -> np.ndarray:
    """Frames of one shape, stacked on the first axis, as uint8 with the channels last; each frame is scaled by its own maximum."""
    if block.ndim == 3 and add_channel:
        block = block[..., None]
    shape = block.shape[1:]
    if len(shape) != 3:
        raise ValueError(f"A frame needs three dimensions, got shape {shape}.")
    channels = next((axis for axis in (2, 0) if shape[axis] in (1, 3)), None)
    if channels is None:
        raise ValueError(f"A frame needs 1 or 3 channels, got shape {shape}.")
    last = block if channels == 2 else block.transpose(0, 2, 3, 1)
    if last.dtype.kind == "f":
        unit = last.max(axis=(1, 2, 3), keepdims=True, initial=0) <= 1
        last = last * np.where(unit, 255, 1).astype(last.dtype)
    return np.ascontiguousarray(last if last.dtype == np.uint8 else np.clip(last, 0, 255).astype(np.uint8))


def frame_bytes(frame: np.ndarray, add_channel: bool = True) -> np.ndarray:
    """One frame as contiguous uint8 height x width x channel, with 1 or 3 channels."""
    return block_bytes(np.asarray(frame)[None], add_channel)[0]


def _axis_weights(size: int, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left neighbour, right neighbour and right weight (of 2048) with half-pixel centres."""
    centre = ((np.arange(target) + 0.5) * (size / target) - 0.5).astype(np.float32)
    centre = np.clip(centre, 0, size - 1)
    left = np.minimum(np.floor(centre).astype(np.int64), size - 1)
    right = np.minimum(left + 1, size - 1)
    return left, right, np.rint((centre - left) * 2048).astype(np.int32)


def resize_block(block: np.ndarray, size: int) -> np.ndarray:
    """Bilinear resize of stacked uint8 frames to size x size, in fixed point with 11-bit weights."""
    top, bottom, wy = _axis_weights(block.shape[1], size)
    left, right, wx = _axis_weights(block.shape[2], size)
    wide = block.astype(np.int32)  # the largest product is 2048 * (255 * 2048 >> 4) < 2^31
    rows = wide[:, :, left] * (2048 - wx)[:, None] + wide[:, :, right] * wx[:, None]
    wy = wy[:, None, None]
    out = (((2048 - wy) * (rows[:, top] >> 4)) >> 16) + ((wy * (rows[:, bottom] >> 4)) >> 16)
    return ((out + 2) >> 2).astype(np.uint8)


def resize_frame(frame: np.ndarray, size: int) -> np.ndarray:
    """One uint8 frame, resized to size x size."""
    return resize_block(frame[None], size)[0]


def _shape_runs(shapes: np.ndarray, least: int = 1) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of one shape, of about BLOCK_VALUES pixel values each (a frame counts for ``least`` at least)."""
    change = np.flatnonzero((shapes[1:] != shapes[:-1]).any(1)) + 1
    for start, stop in zip([0, *change], [*change, len(shapes)]):
        step = max(1, BLOCK_VALUES // max(1, least, int(np.prod(shapes[start], dtype=np.int64)))) if stop > start else 1
        yield from ((at, min(at + step, stop)) for at in range(start, stop, step))


def _pixel_array(frames: Sequence[np.ndarray]) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [
            pa.array([f.shape[0] for f in frames], pa.int32()),
            pa.array([f.shape[1] for f in frames], pa.int32()),
            pa.array([f.shape[2] for f in frames], pa.int32()),
            pa.array([f.tobytes() for f in frames], pa.binary()),
        ],
        names=K.PIXELS.names,
    )


def pixels_from_values(df: DataFrame, values: str = "values", size: int | None = None) -> DataFrame:
    """Replace height, width, channels and ``values`` (array<float>) by a normalised pixels struct."""
    kept = [c for c in df.columns if c not in (values, "height", "width", "channels")]
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField("pixels", K.PIXELS)])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shapes = np.stack([b.column(n).to_numpy(zero_copy_only=False) for n in ("height", "width", "channels")], 1)
            lists = b.column(values)
            numbers, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            frames = []
            for start, stop in _shape_runs(shapes, (size or 0) ** 2):
                block = block_bytes(numbers[at[start] : at[stop]].reshape(stop - start, *shapes[start]))
                frames.extend(block if size is None else resize_block(block, size))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], _pixel_array(frames)], [*kept, "pixels"])

    return df.select(*kept, "height", "width", "channels", values).mapInArrow(convert, schema)


def resize(df: DataFrame, size: int | None) -> DataFrame:
    """Resize the pixels column to size x size; None keeps it."""
    if size is None:
        return df
    if size <= 0:
        raise ValueError(f"image size must be positive, got {size}.")
    kept = [c for c in df.columns if c != "pixels"]
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField("pixels", K.PIXELS)])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *shape, data = b.column("pixels").flatten()
            shapes = np.stack([n.to_numpy(zero_copy_only=False) for n in shape], 1)
            out = []
            for start, stop in _shape_runs(shapes, size**2):
                block = np.frombuffer(b"".join(data[start:stop].to_pylist()), np.uint8).reshape(stop - start, *shapes[start])
                out.extend(resize_block(block, size))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], _pixel_array(out)], [*kept, "pixels"])

    return df.select(*kept, "pixels").mapInArrow(convert, schema)


# --- decode --------------------------------------------------------------------------------


def decode(
    videos: DataFrame,
    decoders: Sequence[tuple[str, Decoder]],
    image_size: int | None = None,
    expected: str | None = None,
    fail_short: bool = False,
    batch: int = FRAME_BATCH,
    opener: Opener | None = None,
) -> DataFrame:
    """One row per frame: the columns of ``videos`` but content, frame_pos, decoder, pixels.

    Files without a ``content`` are opened at their ``path`` by ``opener`` (``read_file`` by default) in the task that
    decodes them, one at a time, so that no list of files and no bytes of theirs go through the driver or a shuffle.

    ``decoders`` is an ordered list of (name, bytes -> iterator of frames). A decoder is passed
    over if it fails, or has nothing, at the first frame; a failure later on raises. With an
    ``expected`` column, decoding stops at that many frames and skips files that expect none;
    ``fail_short`` raises if a file has fewer.
    """
    if batch <= 0 or not decoders:
        raise ValueError("decode needs a positive batch and at least one decoder.")
    kept = [f for f in videos.schema.fields if f.name != "content"]
    names = [f.name for f in kept]
    schema = T.StructType(
        [
            *kept,
            T.StructField("frame_pos", T.LongType()),
            T.StructField("decoder", T.StringType()),
            T.StructField("pixels", K.PIXELS),
        ]
    )
    arrow, carried, opener = to_arrow_schema(schema), "content" in videos.columns, opener or read_file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Frames of short files wait for those of the next, so that not every file is a batch of its own.
        shown, waiting = [], 0
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                most = None if expected is None else one.column(expected)[0].as_py()
                if most is not None and most <= 0:
                    continue
                who = one.select(names).to_pylist()[0]
                content = one.column("content")[0].as_py() if carried else opener(one.column("path")[0].as_py())
                name, frames = _open(content, decoders, str(who))
                at = 0
                while held := list(islice(frames, batch if most is None else min(batch, most - at))):
                    shown.append(_frame_batch(one, names, at, name, _pixel_blocks(held, image_size), arrow))
                    at, waiting = at + len(held), waiting + shown[-1].nbytes
                    if waiting >= BATCH_BYTES:
                        yield _joined(shown)
                        shown, waiting = [], 0
                if fail_short and most is not None and at < most:
                    raise RuntimeError(f"Video ended early: {at} of {most} frames ({who}).")
        if shown:
            yield _joined(shown)

    return videos.select(*names, *(["content"] if carried else [])).mapInArrow(run, schema)


def read_file(path: str) -> bytes:
    """The content of a file named by a Hadoop path: on this machine's file system or one that Arrow knows."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file":
        name = rest if found else path
        with open(re.sub("^/+", "/", name), "rb") as file:
            return file.read()
    host, _, name = rest.lstrip("/").partition("/")
    system, name = fs.FileSystem.from_uri(f"{scheme}://{host}/{quote(name)}")
    with system.open_input_stream(name, compression=None) as file:
        return file.read()


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.concat_batches(batches) if len(batches) > 1 else batches[0]


def _pixel_blocks(frames: Sequence[np.ndarray], size: int | None) -> pa.StructArray:
    """Decoded frames as pixels; neighbours of one shape and type are normalised and resized in one numpy call."""
    parts, frames = [], [np.asarray(f) for f in frames]
    for _, alike in groupby(frames, key=lambda f: (f.shape, f.dtype)):
        alike = list(alike)
        step = max(1, BLOCK_VALUES // max(1, alike[0].size, (size or 0) ** 2))
        for k in range(0, len(alike), step):
            block = block_bytes(np.stack(alike[k : k + step]))
            block = block if size is None else resize_block(block, size)
            n, *shape = block.shape
            each = block[0].size
            offsets = pa.py_buffer(np.arange(0, (n + 1) * each, each, dtype=np.int32) if each else np.zeros(n + 1, np.int32))
            data = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(block.tobytes())])
            parts.append(pa.StructArray.from_arrays([*[pa.array(np.full(n, x, np.int32)) for x in shape], data], names=K.PIXELS.names))
    return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)


def _frame_batch(one: pa.RecordBatch, names, at: int, decoder: str, pixels: pa.StructArray, schema: pa.Schema) -> pa.RecordBatch:
    n = len(pixels)
    repeat = pa.array(np.zeros(n, np.int64))
    columns = [one.column(c).take(repeat) for c in names]
    columns += [pa.array(range(at, at + n), pa.int64()), pa.array([decoder] * n), pixels]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def _open(content: bytes, decoders: Sequence[tuple[str, Decoder]], what: str) -> tuple[str, Iterator[np.ndarray]]:
    reasons = []
    for name, decoder in decoders:
        try:
            frames = iter(decoder(content))
            first = frame_bytes(next(frames))
        except StopIteration:
            reasons.append(f"{name}: empty stream")
            continue
        except Exception as e:  # any failure to open falls through to the next decoder
            reasons.append(f"{name}: {e}")
            continue
        return name, chain([first], frames)
    raise RuntimeError(f"No decoder opened {what}: {reasons}")


def decoder_counts(frames: DataFrame) -> DataFrame:
    """Files decoded per decoder: every decoded file has exactly one frame 0."""
    return frames.where("frame_pos = 0").groupBy("decoder").agg(F.count(F.lit(1)).alias("n_files"))


# --- align ---------------------------------------------------------------------------------


def frame_rows(frames: DataFrame, offset: str = "ep_offset", length: str = "ep_len") -> DataFrame:
    """Row of each frame in its store: the k-th frame of an episode is row ep_offset + k.

    Frames beyond the length of the episode are cut. An optional frame_offset column skips the
    frames of other episodes at the start of a shared file.
    """
    at = F.col("frame_pos")
    if "frame_offset" in frames.columns:
        at = at - F.coalesce("frame_offset", F.lit(0))
    return frames.where((at >= 0) & (at < F.col(length))).withColumn("row", F.col(offset) + at)


def attach_frames(
    rows: DataFrame, frames: DataFrame, keys: Sequence[str] = ("split", "camera"), columns: Sequence[str] = ("pixels",)
) -> DataFrame:
    """Rows with ``columns`` of their frame, joined on the store position, which is unique on both sides."""
    return rows.join(frames.select(*keys, "row", *columns), [*keys, "row"], "left")


def frame_count_issues(
    expected: DataFrame, decoded: DataFrame, keys: Sequence[str] = ("split", "episode_index", "camera"), strict: bool = False
) -> DataFrame:
    """Keys whose ``decoded`` frames are fewer than the ``expected`` rows (or differ, if strict)."""
    both = expected.select(*keys, "expected").join(decoded.select(*keys, "decoded"), list(keys), "full")
    both = both.na.fill(0, ["expected", "decoded"])
    wrong = F.col("decoded") != F.col("expected") if strict else F.col("decoded") < F.col("expected")
    return both.where((F.col("expected") > 0) & wrong)


def count_frames(frames: DataFrame, keys: Sequence[str] = ("split", "episode_index", "camera")) -> DataFrame:
    return frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("decoded"))
