"""Byte-level BPE: encoding by a two-tier lookup, and decoding.

The text is split by the tokenizer's pattern. A minimal perfect hash over the vocabulary gives the id
of a piece that is a token itself; every other piece is merged, lowest rank first, with a heap over a
linked list of its bytes, so a piece of n bytes takes O(n log n). The vocabulary and its hash are
built on the driver and broadcast; their size is that of the tokenizer's file, whatever the data.
Pieces that were resolved are remembered by each worker, up to ``REMEMBERED``; then it starts anew.

Defined results: null and empty texts have no tokens (the digests are those of the empty string);
repeated rows are encoded each; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import blocks, table, texts_of

REMEMBERED = 800_000
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@functools.cache
def _ranges(name: str) -> list[tuple[int, int]]:
    r"""The code points that ``name`` (as ``\p{L}``) stands for in the tokenizer library, as ranges."""
    plain = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    codes = np.frombuffer(bytes(probe.encode_ordinary(plain)).decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    cuts = np.flatnonzero(np.diff(codes, prepend=-2) != 1)
    return [(int(x[0]), int(x[-1])) for x in np.split(codes, cuts[1:])]


def _class(name: str, last: int) -> str:
    return "".join(f"\\U{a:08x}-\\U{min(b, last):08x}" for a, b in _ranges(name) if a <= last)


def splitter(pattern: str, last: int = 0x10FFFF) -> re.Pattern:
    r"""``pattern`` for ``re``, with ``\p{L}``, ``\p{N}`` and ``\s`` spelt out, for texts of code points up to ``last``."""
    known = {x: _class(x, last) for x in (r"\p{L}", r"\p{N}", r"\s")} | {r"\S": None}
    out, inside, i = [], False, 0
    while i < len(pattern):
        item = next((k for k in known if pattern.startswith(k, i)), None)
        if item:
            text = known[item]
            out.append(f"[^{known[r'\s']}]" if text is None else text if inside else f"[{text}]")
            i += len(item)
            continue
        if pattern[i] in "[]":
            inside = pattern[i] == "["
        out.append(pattern[i])
        i += 1
    return re.compile("".join(out))


class PerfectHash:
    """Minimal perfect hash by displacement: n keys take the places 0..n-1, one each.

    Keys fall into buckets; large buckets come first, and each looks for a displacement that puts its
    keys on free places. A bucket of one key names its place itself, as a negative number.
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 3):
        self.n, self.n_buckets = len(keys), len(keys) // per_bucket + 1
        bucket, first, step = self._parts(keys)
        self.shift = np.zeros(self.n_buckets, np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        groups = sorted(np.split(order, cuts[1:]) if len(order) else [], key=len, reverse=True)
        free = np.ones(self.n, bool)
        single = [g[0] for g in groups if len(g) == 1]
        tries = np.arange(1, 65)
        for group in groups[: len(groups) - len(single)]:
            base = 0
            while True:
                places = (first[group][None] + (base + tries)[:, None] * step[group][None]) % self.n
                fits = free[places].all(1)
                if len(group) > 1:
                    fits &= (np.diff(np.sort(places, 1), axis=1) > 0).all(1)
                if fits.any():
                    k = int(np.argmax(fits))
                    free[places[k]] = False
                    self.shift[bucket[group[0]]] = base + tries[k]
                    break
                base += len(tries)
        for key, place in zip(single, np.flatnonzero(free)):
            self.shift[bucket[key]] = -place - 1
        self.shifts: list[int] = self.shift.tolist()

    def _parts(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
        cell = lambda x, n: (x % np.uint64(max(1, n))).astype(np.int64)
        return cell(h >> np.uint64(40), self.n_buckets), cell(h & np.uint64(0xFFFFFFF), self.n), 1 + cell(h >> np.uint64(28) & np.uint64(0xFFFFFFF), max(1, self.n - 1))

    def place(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shifts[(h >> 40) % self.n_buckets]
        if shift < 0:
            return -shift - 1
        return ((h & 0xFFFFFFF) % self.n + shift * (1 + (h >> 28 & 0xFFFFFFF) % max(1, self.n - 1))) % self.n

    def places(self, keys: list[bytes]) -> np.ndarray:
        bucket, first, step = self._parts(keys)
        shift = self.shift[bucket]
        return np.where(shift < 0, -shift - 1, (first + shift * step) % max(1, self.n))


class _Known(dict):
    """Remembers what ``resolve`` gives for a key."""

    def __init__(self, resolve):
        super().__init__()
        self.resolve = resolve

    def __missing__(self, key):
        found = self[key] = self.resolve(key)
        return found


class ByteBpe:
    """Encoder and decoder for a file of ranks (base64 token and rank per line)."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, lines))}
        self.pattern = pattern
        keys = list(self.ranks)
        self.hash = PerfectHash(keys)
        self.key_at: list[bytes] = [b""] * len(keys)
        for key, place in zip(keys, self.hash.places(keys)):
            self.key_at[place] = key
        self.id_at = [self.ranks[k] for k in self.key_at]
        self.__setstate__(self.__getstate__())

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("narrow", "wide", "known", "tokens", "digits")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.narrow, self.wide, self.known = splitter(self.pattern, 0xFFFF), None, _Known(self.resolved)
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.digits = {i: str(i) for i in self.tokens}

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Merge the bytes of a piece: the pair of lowest rank first, of equal pairs the leftmost.

        ``rank[i]`` is the rank of the pair that begins at byte i, so an entry of the heap (rank * n + i)
        is out of date if it names another.
        """
        n, get = len(piece), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = [get(piece[i : i + 2]) for i in range(n - 1)] + [None]
        heap = [r * n + i for i, r in enumerate(rank) if r is not None]
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            if rank[i] != r:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            rank[gone] = rank[i] = None
            if end < n:
                before[end] = i
                if (q := get(piece[i : after[end]])) is not None:
                    rank[i] = q
                    heapq.heappush(heap, q * n + i)
            if i:
                left = before[i]
                q = rank[left] = get(piece[left:end])
                if q is not None:
                    heapq.heappush(heap, q * n + left)
        out, at = [], 0
        while at < n:
            out.append(get(piece[at : after[at]]))
            at = after[at]
        return tuple(out)

    def resolved(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8", "replace")
        place = self.hash.place(raw)
        return (self.id_at[place],) if self.key_at[place] == raw else self.merged(raw)

    def split(self, text: str) -> list[str]:
        """The pieces of a text; ranges beyond the basic plane slow ``re`` down, so few texts get them."""
        if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text):
            return self.narrow.findall(text)
        self.wide = self.wide or splitter(self.pattern)
        return self.wide.findall(text)

    def encode(self, text: str) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return list(chain.from_iterable(map(self.known.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def written(self, ids: list[int]) -> str:
        return ",".join(map(self.digits.__getitem__, ids))


def encoded(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids, n_tokens of every row."""
    coder = docs.sparkSession.sparkContext.broadcast(ByteBpe(path, pattern))

    def rows(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in blocks(texts):
                ids = [coder.value.encode(t) for t in texts[a:b]]
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(ids, pa.list_(pa.int32())), pa.array(map(len, ids), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens"])

    return _narrow(docs).mapInArrow(rows, "doc_id long, ids array<int>, n_tokens long")


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes that they decode to, of every row."""
    coder = docs.sparkSession.sparkContext.broadcast(ByteBpe(path, pattern))
    digest = lambda x: hashlib.sha256(x).hexdigest()

    def rows(batches):
        for batch in batches:
            out = []
            for text in texts_of(batch.column("text")):
                ids = coder.value.encode(text)
                out.append((len(ids), digest(coder.value.written(ids).encode()), digest(coder.value.decode(ids))))
            columns = [batch.column("doc_id"), *map(pa.array, zip(*out))] if out else []
            if out:
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _narrow(docs).mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decoded(tokens: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and text of every row of doc_id and ids; bytes that are no UTF-8 become U+FFFD, null ids no text."""
    coder = tokens.sparkSession.sparkContext.broadcast(ByteBpe(path, pattern))

    def rows(batches):
        for batch in batches:
            texts = [coder.value.decode(x or []).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(rows, "doc_id long, text string")


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
ORACLE: dict[str, str] = {}
