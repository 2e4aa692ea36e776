"""Sharding by minimax contiguous partition: equal texts stay together, the largest shard is as small as can be.

Groups of equal texts are atomic and ordered by a 64-bit hash of the text. For a capacity, shards are filled
greedily in that order; the smallest capacity for which the shards suffice is found by binary search, and
the order is cut there.

The sizes of all groups never meet on the driver. The hash is taken in levels of 12 bits: the driver
gets the totals of the segments of one level, and searches twice, once as if a shard could end anywhere
inside a segment (a capacity below cannot do) and once as if only between segments (that capacity
will do). Segments that hold more than a 64th of a shard are opened first, until a hot group stands
apart; then only those in which a cut can fall between the bounds, until every such segment is a single group
and both searches agree. So at most 4096 rows for each open segment come to the driver, and few are open.

Slots come from counts per shard and bucket of ids (``SLOT_BUCKETS`` rows for each shard, a fixed
bound) and a window over one bucket.

Defined results: a null text has the size 1, the crc32 of the empty text and is grouped with the empty
text; repeated rows have slots of their own; an empty table gives no rows; fewer groups than shards
leave shards empty. Other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import stored, table

SHARDS, LEVEL_BITS, SLOT_BUCKETS = 8, 12, 4096
# A segment of several groups is large if it holds more than this part of a shard's even share.
LARGE = 64


@dataclass(frozen=True, order=True)
class Segment:
    """Groups whose hash (as an unsigned number) begins at ``first`` and lies below ``end``."""

    first: int
    end: int
    size: int
    groups: int


def greedy(segments: list[Segment], capacity: int, anywhere: bool) -> tuple[int, list[tuple[int, int]]]:
    """Shards needed, and for each cut the segment it falls in or before and the size before it.

    ``anywhere``: segments of several groups can be cut at any place; otherwise none can be cut.
    """
    n, filled, done, cuts = 1, 0, 0, []
    for k, s in enumerate(segments):
        left = s.size
        if not anywhere or s.groups == 1:
            if left > capacity:
                return 1 << 62, cuts
            if filled + left > capacity:
                cuts.append((k, done))
                n, filled = n + 1, 0
        else:
            while filled + left > capacity:
                left -= capacity - filled
                done += capacity - filled
                cuts.append((k, done))
                n, filled = n + 1, 0
        filled += left
        done += left
    return n, cuts


def smallest_capacity(segments: list[Segment], shards: int, anywhere: bool) -> int:
    """Binary search for the smallest capacity with which the shards suffice."""
    low, high = 1, max(1, sum(s.size for s in segments))
    while low < high:
        middle = (low + high) // 2
        if greedy(segments, middle, anywhere)[0] <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def segment_totals(groups: DataFrame, opened: list[Segment] | None = None) -> list[Segment]:
    """The segments of the first level, or those of the next level below each of the ``opened`` ones, in order."""
    by_depth: dict[int, list[Segment]] = {0: []} if opened is None else {}
    for s in opened or ():
        by_depth.setdefault(64 - (s.end - s.first).bit_length() + 1, []).append(s)
    out = []
    for depth, above in by_depth.items():
        width = 1 << (64 - min(64, depth + LEVEL_BITS))
        place = F.shiftrightunsigned("order_key", width.bit_length() - 1)
        prefixes = [_signed(s.first >> (64 - depth)) for s in above]
        chosen = groups.where(F.shiftrightunsigned("order_key", 64 - depth).isin(prefixes)) if above else groups
        rows = chosen.groupBy(place.alias("place")).agg(F.sum("size").alias("size"), F.count_distinct("order_key").alias("groups")).collect()
        starts = [((r.place % (1 << 64)) * width, r) for r in rows]
        out += [Segment(a, a + width, int(r["size"]), int(r["groups"])) for a, r in starts]
    return sorted(out)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def find_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity, and the hashes (unsigned) with which the second and later shards begin.

    ``groups``: order_key long and size long; a key's rows may be many, and count together.
    """
    segments = segment_totals(groups)
    total = sum(s.size for s in segments)
    while True:
        low, high = smallest_capacity(segments, shards, True), smallest_capacity(segments, shards, False)
        if low == high:
            plain = greedy(segments, high, False)
            if _same_cuts(segments, plain[1], greedy(segments, high, True)[1]):
                return high, [segments[k].first for k, _ in plain[1]]
        # A large segment would blur the bounds of all cuts, so it is opened alone until its hot group stands apart.
        large = [s for s in segments if s.groups > 1 and s.size * shards * LARGE > total]
        opened = large or _open(segments, low, high, shards)
        if not opened:
            return high, [segments[k].first for k, _ in greedy(segments, high, False)[1]]
        gone = set(opened)
        segments = sorted([s for s in segments if s not in gone] + segment_totals(groups, opened))


def _same_cuts(segments: list[Segment], plain, loose) -> bool:
    """Whether no cut falls inside a segment of several groups."""
    return [p for _, p in plain] == [p for _, p in loose]


def _open(segments: list[Segment], low: int, high: int, shards: int) -> list[Segment]:
    """Segments of several groups in which a cut of the best partition can fall.

    A cut of the greedy filling lies no earlier than with the smallest capacity in whole segments that
    end early, and no later than the same number of full shards of the largest capacity.
    """
    ranges, early = [], 0
    largest = max((s.size for s in segments if s.groups > 1), default=0)
    for k in range(1, shards):
        early = max(0, k * low - k * largest)
        ranges.append((early, k * high))
    ends = greedy(segments, high, False)[1]
    for k, (_, at) in enumerate(ends):
        ranges.append((max(0, at - (k + 1) * (high - low) - largest), at + (k + 1) * (high - low) + largest))
    out, before = [], 0
    for s in segments:
        if s.groups > 1 and any(before <= b and before + s.size >= a for a, b in ranges):
            out.append(s)
        before += s.size
    return out


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("order_key"),
        ),
        "sizes",
    )
    groups = stored(rows.groupBy("order_key").agg(F.sum("size").alias("size")), "groups")
    _, cuts = find_cuts(groups, shards)
    # Signed order of the flipped key is unsigned order of the key.
    flipped = F.col("order_key").bitwiseXOR(F.lit(-(1 << 63)))
    shard = sum((F.when(flipped >= F.lit(_signed(c ^ (1 << 63))), 1).otherwise(0) for c in cuts), F.lit(0))
    placed = rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(SLOT_BUCKETS)).alias("bucket"))
    counts = sorted((r.shard, r.bucket, r["count"]) for r in placed.groupBy("shard", "bucket").count().collect())
    return _slotted(placed, counts)


def _slotted(placed: DataFrame, counts: list[tuple[int, int, int]]) -> DataFrame:
    from pyspark.sql import Window

    starts, now, total = [], None, 0
    for shard, bucket, n in counts:
        total = total if shard == now else 0
        now = shard
        starts.append((shard, bucket, total))
        total += n
    offsets = placed.sparkSession.createDataFrame(starts, "shard int, bucket long, first long")
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


QUERIES = {"op6_minimax_shards": op6_minimax_shards}
ORACLE: dict[str, str] = {}
