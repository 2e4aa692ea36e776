"""Benchmark decontamination by q-gram lemma filtering.

A copy of an item of n characters with at most k edits keeps at least n - q + 1 - k * q of its q-grams,
all on at most k + 1 neighbouring diagonals (place in the text minus place in the item). So shared
q-grams are counted in overlapping bands of 2 (k + 1) diagonals; a band that reaches the bound is
verified by a banded alignment, which gives the region and its edits.

Texts and items are compared in lower case with runs of white space as one space; regions are
given in code points of the original text, end exclusive. The edit budget is ``error`` of the item's
length. Items are taken in blocks of at most ``block_chars`` characters, one pass over the
documents for each, so what is broadcast doesn't grow with the benchmark. Very long texts go through in
overlapping pieces. No row of documents is shuffled.

Defined results: null and empty texts match nothing; items with fewer than ``min_chars`` characters
are not looked for (they would hit clean texts); equal items are reported each; repeated rows too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import BLOCK_CHARS, blocks, code_points, rolling, stored, table, texts_of

Q, ERROR, MIN_CHARS, BLOCK_ITEMS = 10, 0.06, 40, 2_000_000
FILTER_BITS = 20
SPACES = np.array([*range(9, 14), 32, 0x85, 0xA0], np.uint32)
GAP = np.uint32(0x110000)
MATCH = "doc_id long, item_id long, start long, end long, edits long, similarity double"


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with single spaces, and the place of each in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    codes = code_points(low)
    space = (codes < 33) | (codes == 0x85) | (codes == 0xA0)
    space[space] = np.isin(codes[space], SPACES)
    kept = np.flatnonzero(~(space & np.concatenate([[True], space[:-1]])))
    out = codes[kept].copy()
    out[space[kept]] = 32
    if len(out) and out[-1] == 32:
        out, kept = out[:-1], kept[:-1]
    return out, kept


@dataclass
class Items:
    """The q-grams of a block of items: sorted, with the items and places of each."""

    ids: list[int]
    codes: list[np.ndarray]
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    q: int


def index(ids: list[int], texts: list[str], q: int = Q, error: float = ERROR, min_chars: int = MIN_CHARS) -> Items:
    named = [(i, c) for i, t in zip(ids, texts) if len(c := normal(t)[0]) >= max(min_chars, q)]
    codes = [c for _, c in named]
    grams = [rolling(c.astype(np.uint64), q) for c in codes]
    sizes = np.array([len(c) for c in codes], np.int64)
    budget = np.minimum((error * sizes).astype(np.int64), np.maximum(0, (sizes - q) // q))
    flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    unique, first = np.unique(flat[order], return_index=True)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[unique >> np.uint64(64 - FILTER_BITS)] = True
    return Items(
        [i for i, _ in named], codes, unique, np.append(first, len(flat)), item[order], place[order], seen, budget, sizes - q + 1 - budget * q, q
    )


def _align(item: np.ndarray, region: np.ndarray, width: int) -> tuple[int, int]:
    """Least edits of ``item`` against a piece of ``region``, and where that piece ends.

    Cell (i, d) of the band stands for item place i and region place i + d, 0 <= d < width.
    """
    at = np.arange(width)
    padded = np.concatenate([region, np.full(max(0, len(item) + width - len(region)), GAP, np.uint32)])
    out_of = len(item) + width
    row = np.where(at <= len(region), 0, out_of)
    for i, code in enumerate(item):
        step = row + (padded[i : i + width] != code)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - at) + at
    ends = np.where(len(item) + at <= len(region), row, out_of)
    best = int(np.argmin(ends))
    return int(ends[best]), len(item) + best


def verified(items: Items, k: int, text: np.ndarray, low: int) -> tuple[int, int, int] | None:
    """Region and edits of item ``k`` near the band of diagonals that begins at ``low``, if in budget."""
    item, budget = items.codes[k], int(items.budget[k])
    width = 4 * (budget + 1)
    begin = low - budget - 1
    # Before its first character a text goes on with gaps, so that diagonals may begin there.
    gaps = np.full(max(0, -begin), GAP, np.uint32)
    region = np.concatenate([gaps, text[max(0, begin) : max(0, begin + len(item) + width + budget + 1)]])
    for exact in range(min(width, max(0, len(region) - len(item) + 1))):
        if region[exact] == item[0] and np.array_equal(region[exact : exact + len(item)], item):
            return begin + exact, begin + exact + len(item), 0
    edits, end = _align(item, region, width)
    if edits > budget:
        return None
    turned = np.concatenate([np.full(budget, GAP, np.uint32), region[:end][::-1]])
    size = _align(item[::-1], turned, 2 * budget + 1)[1] - budget
    return max(0, begin + end - size), min(len(text), begin + end), edits


def _bands(items: Items, text: np.ndarray) -> list[tuple[int, int]]:
    """(item, first diagonal) of the bands of a text that reach their item's bound."""
    hashed = rolling(text.astype(np.uint64), items.q)
    at = np.flatnonzero(items.seen[hashed >> np.uint64(64 - FILTER_BITS)])
    if not len(at) or not len(items.grams):
        return []
    slot = np.minimum(np.searchsorted(items.grams, hashed[at]), len(items.grams) - 1)
    same = items.grams[slot] == hashed[at]
    at, slot = at[same], slot[same]
    n = items.first[slot + 1] - items.first[slot]
    entry = np.repeat(items.first[slot] - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64), n) + np.arange(n.sum())
    item = items.item[entry]
    band = (np.repeat(at, n) - items.place[entry]) // (items.budget[item] + 1)
    offset = np.int64(1) << 40
    keys, counts = np.unique(np.concatenate([item * offset + band + offset // 2, item * offset + band - 1 + offset // 2]), return_counts=True)
    item, band = keys // offset, keys % offset - offset // 2
    good = counts >= items.bound[item]
    return [(int(k), int(b) * (int(items.budget[k]) + 1)) for k, b in zip(item[good], band[good])]


def matches(items: Items, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """Per text, its distinct regions (item, start, end, edits); those of one item don't overlap."""
    found: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    overlap = 4 * max((len(c) for c in items.codes), default=0)
    pieces = [(n, s) for n, t in enumerate(texts) for s in range(0, max(1, len(t)), BLOCK_CHARS)]
    parts = [normal(texts[n][s : s + BLOCK_CHARS + overlap]) for n, s in pieces]
    for a, b in blocks_of([len(p[0]) for p in parts]):
        starts = np.cumsum([0, *(len(p[0]) + 1 for p in parts[a:b])])
        joined = np.concatenate([x for p in parts[a:b] for x in (p[0], np.array([GAP]))]) if b > a else np.zeros(0, np.uint32)
        for k, low in _bands(items, joined):
            size = len(items.codes[k]) + 4 * (int(items.budget[k]) + 1)
            for at in range(max(0, int(np.searchsorted(starts, low, "right")) - 1), min(b - a, int(np.searchsorted(starts, low + size, "left")))):
                codes, places = parts[a + at]
                n, shift = pieces[a + at]
                hit = verified(items, k, codes, low - int(starts[at]))
                if hit and hit[1] > hit[0]:
                    found[n].append((hit[2], k, shift + int(places[hit[0]]), shift + int(places[hit[1] - 1]) + 1))
    return [_apart(x) for x in found]


def _apart(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    kept: list[tuple[int, int, int, int]] = []
    for edits, k, start, end in sorted(set(hits)):
        if all(k != k_ or end <= s or e <= start for k_, s, e, _ in kept):
            kept.append((k, start, end, edits))
    return sorted(kept)


def blocks_of(sizes: list[int], limit: int = BLOCK_CHARS):
    start = total = 0
    for at, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_ITEMS, **settings):
    """Indexes of the items, a bounded block at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids, texts, size = [], [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        if size and size + len(row.text) > block_chars:
            yield index(ids, texts, **settings)
            ids, texts, size = [], [], 0
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text)
    yield index(ids, texts, **settings)


def contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """A row for each region of a document that is an item within the edit budget."""
    sc = docs.sparkSession.sparkContext
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in item_blocks(benchmark, **settings):
        shared = sc.broadcast(items)

        def rows(batches, shared=shared):
            for batch in batches:
                x, texts = shared.value, texts_of(batch.column("text"))
                ids = batch.column("doc_id").to_pylist()
                for a, b in blocks(texts):
                    hits = [
                        (i, x.ids[k], start, end, edits, 1 - edits / len(x.codes[k]))
                        for i, found in zip(ids[a:b], matches(x, texts[a:b]))
                        for k, start, end, edits in found
                    ]
                    if hits:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.float64() if n == 5 else pa.int64()) for n, c in enumerate(zip(*hits))],
                            ["doc_id", "item_id", "start", "end", "edits", "similarity"],
                        )

        found = narrow.mapInArrow(rows, MATCH)
        out = found if out is None else stored(out, "regions").union(stored(found, "regions"))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, with all their columns, that have no item within the edit budget."""
    sc = docs.sparkSession.sparkContext
    for items in item_blocks(benchmark, **settings):
        shared = sc.broadcast(items)

        def kept(batches, shared=shared):
            for batch in batches:
                texts = texts_of(batch.column(batch.schema.get_field_index("text")))
                clean = [not x for a, b in blocks(texts) for x in matches(shared.value, texts[a:b])]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(kept, docs.schema)
    return docs


def op5_qgram_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_qgram_decontam": op5_qgram_decontam}
ORACLE: dict[str, str] = {}
