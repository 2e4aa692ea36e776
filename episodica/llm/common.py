"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Python tasks work on a whole Arrow batch in blocks of about this many characters.
BLOCK_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the one in ``spark.checkpoint.dir``; without it only local mode has one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        shared = tempfile.mkdtemp(prefix="episodica-llm-")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, column: str = "text"):
    """The text as a string column; null is the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def blocks(texts: list[str], limit: int = BLOCK_CHARS):
    """Ranges (start, end) of consecutive texts with about ``limit`` characters each."""
    start = size = 0
    for at, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, at
            start, size = at, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def code_points(text: str) -> np.ndarray:
    """The code points of a text, lone surrogates included."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


# The words of the contracts: what lies between ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer, for arrays of uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive values (uint64), in order."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for i in range(width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + values[i : i + n]
    return mix(out)


# Most bits of a bitmap (16 MB), and bits for each key it is meant for.
BITMAP_BITS, BITS_A_KEY = 1 << 27, 16


@dataclass
class Bitmap:
    """A set of keys by their low bits; it may hold keys that were not put in."""

    words: np.ndarray
    bits: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64(self.bits - 1)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(keys: DataFrame, column: str, most_bits: int = BITMAP_BITS) -> Bitmap:
    """The bitmap of a column of keys; at most ``most_bits`` / 64 words come to the driver."""
    n = keys.count()
    bits = min(most_bits, max(1 << 10, 1 << (BITS_A_KEY * n).bit_length()))
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    bit = F.expr(f"shiftleft(1L, int(`{column}` & 63))")
    rows = keys.select(F.shiftright(slot, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    words = np.zeros(bits // 64, np.uint64)
    words[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return Bitmap(words, bits)
