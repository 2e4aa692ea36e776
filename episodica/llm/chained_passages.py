"""Fuzzy repeated passages by collinear chaining.

1. Equal texts are one class; only its smallest id goes on, the others are reported as whole copies.
2. Seeds: hashes of every run of ``K`` words at all its places (see ``seeds``). A passage of ``MIN_WORDS`` words with ``SIMILARITY`` of them
   equal and the others replaced keeps ``MIN_SEEDS`` at least (see there). Packed hashes are counted first, so that only places
   of seeds that occur again are dealt out.
3. Places are sorted by seed, then by the ``MIN_WORDS`` words from there on, in ranges, so a common seed is no burden to one
   task. Up to ``ALL_PAIRS`` places of a seed meet each other; of more, each meets its next neighbour, the first with the same
   ``MIN_WORDS`` words and the smallest, which serves passages with words put in or left out.
   Besides, all places of such a common seed meet with the words around them, where a run of equal words begins: every window of
   ``MIN_WORDS`` words around the seed with ``SIMILARITY`` of them equal is linked to the smallest partner that has it, so none
   is lost, with at most one link a window. Pairs are compared in cells of ``CELL`` by ``CELL`` places, spread over tasks,
   in ``SEED_ROUNDS`` rounds.
4. The matches of a document and an anchor (a smaller document, or an earlier place of its own at least ``MIN_WORDS``
   before) are chained in order on both sides: a Fenwick tree over the anchor's places gives the best chain that a match
   can go on from, gaps costing ``GAP_COST`` per word. Chains are split at gaps of more than ``MAX_GAP`` words.
5. A chain's words are fetched and aligned: exactly between seeds, and outwards from both ends while that pays.
   Passages of at least ``MIN_WORDS`` words on both sides with ``SIMILARITY`` of them equal are returned, those inside
   another passage of their document only as part of that. This goes in ``ROUNDS`` rounds, in each the longest chains of a
   document first, so that chains inside a passage need no alignment.

Words are compared in lower case (A-Z). Places are code points, end exclusive.

Defined results: null, empty and short texts have no passages; a whole copy is reported if it has ``MIN_WORDS`` words;
rows with a null id are left out; rows that repeat an id with one text count once, with other texts each. Other
columns of the input are not read.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episodica.llm.common import BLOCK_CHARS, bitmap, mix, rolling, shared_folder, table

K, MIN_WORDS, SIMILARITY = 4, 50, 0.8
GAP_COST, MAX_GAP, MARGIN = 0.1, 40, 48
# 50 words with 10 replaced fall into at most 11 runs with 40 words, which have 40 - 11 * 3 seeds at least; longer ones have more.
MIN_SEEDS = 7
ALL_PAIRS = 6
# Words after a seed that order its places, as hashes of 16 bits (the last of 15); the lowest bit says that all words exist.
AFTER = ((4, 12), (12, 20), (20, 34), (34, MIN_WORDS))
# Rows of one seed that a task links at once.
GROUP_ROWS = 1 << 18
# Places of a common seed that a task compares with as many others at once.
CELL = 1024
# Words before a seed that a window around it may begin with, words kept for a place, and windows.
BEFORE = MIN_WORDS - K
AROUND, WINDOWS = BEFORE + MIN_WORDS, BEFORE + 1
LEAST_EQUAL = round(MIN_WORDS * SIMILARITY)
# Ids of copies that are broadcast; more are shuffled, with the texts.
BROADCAST_IDS = 500_000
# Hashes that a task counts at once.
COUNTED = 1 << 22
# Shares of the common seeds, and of the documents to align, that are worked on one after the other: only the words or pieces of
# one are on disk at a time.
SEED_ROUNDS, ROUNDS = 2, 3
# Chains of a text that its pieces are cut for at once.
TOGETHER = 64
# While it is set, the files of shuffles go when the write that needed them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACES = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
# Kinds of matches: one seed, MIN_WORDS equal words, a row at the border of a range, a seed of a window.
PLAIN, SURE, BORDER, WINDOW = range(4)
MATCH = "id long, anchor long, x long, y long, sure long"
PASSAGE = "doc_id long, start long, end long, partner_id long, partner_start long, partner_end long, words long, similarity double"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the files of its shuffles go as soon as it is written."""
    path, conf = shared_folder(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def seeds(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the seeds of a text, what orders the places of a seed (the words from there on), and the places.

    All places count. Only in a run of one repeated word, whose places are all alike, those counted off from its two ends stand
    for the others, so that runs meet at their ends.
    """
    words = word_hashes(text)
    h, kept = _kept(words)
    n = len(h)
    if not n:
        return h.view(np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded, after = np.concatenate([words, np.zeros(MIN_WORDS, np.uint64)]), np.zeros(n, np.uint64)
    runs = _runs(padded, {end - start for start, end in AFTER})
    for start, end in AFTER:
        after = after << np.uint64(16) | runs[end - start][start : start + n] >> np.uint64(48)
    after = after & ~np.uint64(1) | (np.arange(n) + MIN_WORDS <= len(words)).astype(np.uint64)
    return h[kept].view(np.int64), after[kept].view(np.int64), kept


def _runs(values: np.ndarray, widths: set[int]) -> dict[int, np.ndarray]:
    """``rolling`` of each of the widths, put together from runs of 1, 2, 4, ... values."""
    out, doubled, power = {}, {1: values}, lambda n: np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64))
    with np.errstate(over="ignore"):
        for n in (1 << k for k in range(max(widths).bit_length() - 1)):
            doubled[2 * n] = doubled[n][:-n] * power(n) + doubled[n][n:]
        for width in widths:
            size, at, h = len(values) - width + 1, 0, None
            for n in sorted((n for n in doubled if n & width), reverse=True):
                piece = doubled[n][at : at + size]
                h, at = piece if h is None else h * power(n) + piece, at + n
            out[width] = mix(h)
    return out


def _kept(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all seeds of a text, and the places that count."""
    h = rolling(words, K)
    n = len(h)
    if not n:
        return h, np.zeros(0, np.int64)
    at, new = np.arange(n), np.insert(h[1:] != h[:-1], 0, True)
    first = np.maximum.accumulate(np.where(new, at, 0))
    left = np.minimum.accumulate(np.where(np.append(new[1:], True), at, n)[::-1])[::-1] - at
    return h, np.flatnonzero(((at - first) % MIN_WORDS == 0) | (left < MIN_WORDS) & (left % 8 == 0))


def words_around(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The words around each place in codes of 16 bits; 0 stands for none."""
    none = np.zeros(BEFORE, np.uint16)
    codes = np.concatenate([none, np.maximum(words >> np.uint64(48), np.uint64(1)).astype(np.uint16), none])
    return np.lib.stride_tricks.sliding_window_view(codes, AROUND)[places]


def chains(x: np.ndarray, y: np.ndarray, seeds_at: np.ndarray | None = None) -> list[np.ndarray]:
    """Disjoint chains of matches (places x and y, sorted by x), best first; each as indices in order.

    A match stands for ``seeds_at`` seeds, 1 without it; chains of fewer than ``MIN_SEEDS`` are left out.
    """
    n = len(x)
    seeds_at = np.ones(n, np.int64) if seeds_at is None else seeds_at
    cost, at = (GAP_COST * (x + y)).tolist(), x.tolist()
    score, previous = [0.0] * n, [-1] * n
    if (np.diff(x) > 0).all() and (np.diff(y) > 0).all():
        # All go on in order: then the best to go on from is the one before, which costs no more gaps and has a match more.
        for i in range(n):
            best = score[i - 1] + cost[i - 1] - cost[i] if i else 0.0
            if best > 0:
                previous[i] = i - 1
            score[i] = K + max(best, 0.0)
    else:
        _best_before(at, (np.unique(y, return_inverse=True)[1] + 1).tolist(), cost, score, previous)
    used, out, seeds_of = [False] * n, [], seeds_at.tolist()
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = previous[i]
        if len(chain) > 1 and sum(seeds_of[k] for k in chain) >= MIN_SEEDS:
            c = np.array(chain[::-1])
            far = np.flatnonzero((np.diff(x[c]) > MAX_GAP) | (np.diff(y[c]) > MAX_GAP)) + 1
            out += [p for p in np.split(c, far) if len(p) > 1 and seeds_at[p].sum() >= MIN_SEEDS]
    return out


def _best_before(at: list[int], rank: list[int], cost: list[float], score: list[float], previous: list[int]) -> None:
    """Fill in the score of each match and the one that it best goes on from, by a Fenwick tree over the ranks of its places."""
    n = len(at)
    tree_value, tree_at = [-np.inf] * (n + 1), [-1] * (n + 1)
    group = 0
    for i in range(n):
        # Matches at one place of the document can't follow each other: they enter the tree together.
        while at[group] < at[i]:
            value, k = score[group] + cost[group], rank[group]
            while k <= n:
                if value > tree_value[k]:
                    tree_value[k], tree_at[k] = value, group
                k += k & -k
            group += 1
        best, k = -np.inf, rank[i] - 1
        while k > 0:
            if tree_value[k] > best:
                best, previous[i] = tree_value[k], tree_at[k]
            k -= k & -k
        best -= cost[i]
        if best <= 0:
            previous[i], best = -1, 0.0
        score[i] = K + best


def _edit_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Words in common, in order, of two short pieces."""
    ends = 0
    for _ in range(2):
        # Equal words at the two ends belong to it.
        n = min(len(a), len(b))
        other = np.flatnonzero(a[:n] != b[:n])
        same = int(other[0]) if len(other) else n
        ends, a, b = ends + same, a[same:][::-1], b[same:][::-1]
    if not len(a) or not len(b):
        return ends
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[:-1] + (b == word), row[1:]))
    return ends + int(row[-1])


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Words to add at an end and how many of them are equal: word by word while the score hasn't dropped by 6."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    if not n:
        return 0, 0
    stop = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score >= 6)
    score = score[: stop[0]] if len(stop) else score
    if not len(score) or score.max() <= 0:
        return 0, 0
    length = int(np.argmax(score)) + 1
    return length, int(same[:length].sum())


def align(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, room: int | None = None) -> tuple[int, int, int, int, float]:
    """(start, end) in ``a`` and in ``b`` and the share of equal words, from the seeds at ``x`` and ``y``; with ``room``, so many words are added in all."""
    true = np.all([a[x + k] == b[y + k] for k in range(K)], axis=0)
    if not true.all():
        # Windows are found by short codes of words.
        x, y = x[true], y[true]
        if not len(x):
            return 0, 0, 0, 0, 0.0
    equal, far = K, np.diff(x)
    straight = far == np.diff(y)
    if straight.any():
        # Words between seeds at equal distances, all at once.
        step = far[straight]
        begin = np.cumsum(step) - step
        at = np.arange(int(step.sum())) + np.repeat(x[:-1][straight] - begin, step)
        same = np.add.reduceat(a[at] == b[at + np.repeat((y - x)[:-1][straight], step)], begin, dtype=np.int64)
        equal += int(step[same == step].sum())
        straight[straight] = same == step
    for i in np.flatnonzero(~straight):
        equal += _edit_matches(a[x[i] : x[i + 1]], b[y[i] : y[i + 1]])
    left, same_left = _extend(a[: x[0]][::-1][:room], b[: y[0]][::-1])
    right, same_right = _extend(a[x[-1] + K :][: None if room is None else room - left], b[y[-1] + K :])
    shorter, longer = sorted((x[-1] - x[0] + K, y[-1] - y[0] + K))
    if shorter + left + right < MIN_WORDS:
        # Too short: the ends may be worth it together, down to the least similarity.
        ends = [(a[: x[0]][::-1][:room], b[: y[0]][::-1]), (a[x[-1] + K :][:room], b[y[-1] + K :])]
        same = [p[: len(q)] == q[: len(p)] for p, q in ends]
        sums = [np.insert(np.cumsum(m), 0, 0) for m in same]
        size = np.arange(len(sums[0]))[:, None] + np.arange(len(sums[1]))
        shares = (equal + sums[0][:, None] + sums[1]) / (longer + size)
        shares[(size + shorter < MIN_WORDS) | (size > (size.max() if room is None else room))] = 0
        # A passage ends with equal words.
        shares[~np.insert(same[0], 0, True)] = 0
        shares[:, ~np.insert(same[1], 0, True)] = 0
        if shares.max() >= SIMILARITY:
            left, right = np.unravel_index(int(shares.argmax()), shares.shape)
            same_left, same_right = sums[0][left], sums[1][right]
    start_a, end_a, start_b, end_b = x[0] - left, x[-1] + K + right, y[0] - left, y[-1] + K + right
    share = (equal + same_left + same_right) / max(end_a - start_a, end_b - start_b)
    return int(start_a), int(end_a), int(start_b), int(end_b), min(1.0, float(share))


def linked(rows: np.ndarray) -> np.ndarray:
    """Matches (id, anchor, x, y, sure) among places (seed, after, id, x) in order; sure ones share ``MIN_WORDS`` words."""
    same = (rows[1:, 0] == rows[:-1, 0]) if len(rows) else np.zeros(0, bool)
    rows = rows[np.append(same, False) | np.insert(same, 0, False)] if len(same) else rows[:0]
    if not len(rows):
        return np.zeros((0, 5), np.int64)
    at = np.arange(len(rows))
    new = np.insert(rows[1:, 0] != rows[:-1, 0], 0, True)
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(rows)))[group]
    pairs = []
    for d in range(1, ALL_PAIRS):
        i = at[: max(0, len(rows) - d)]
        i = i[(group[i] == group[i + d]) & (size[i] <= ALL_PAIRS)]
        pairs.append(np.stack([i, i + d]))
    many = np.flatnonzero(size > ALL_PAIRS)
    if len(many):
        least = many[np.lexsort((rows[many, 3], rows[many, 2], group[many]))]
        smallest = np.zeros(len(begin), np.int64)
        smallest[group[least][::-1]] = least[::-1]
        tied = np.maximum.accumulate(np.where(new | np.insert(rows[1:, 1] != rows[:-1, 1], 0, True), at, 0))
        before = np.where(new, at, at - 1)
        for other in (before[many], tied[many], smallest[group[many]]):
            pairs.append(np.stack([many, other]))
    i, j = np.unique(np.sort(np.concatenate(pairs, 1), 0), axis=1)
    swap = (rows[i, 2] < rows[j, 2]) | (rows[i, 2] == rows[j, 2]) & (rows[i, 3] < rows[j, 3])
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    good = (i != j) & ((rows[i, 2] != rows[j, 2]) | (rows[i, 3] - rows[j, 3] >= MIN_WORDS))
    i, j = i[good], j[good]
    sure = (rows[i, 1] == rows[j, 1]) & (rows[i, 1] & 1 == 1)
    return np.stack([rows[i, 2], rows[j, 2], rows[i, 3], rows[j, 3], sure.astype(np.int64)], 1)


def numbered(texts: DataFrame) -> DataFrame:
    """(part, chars, ids, ends, texts): rows (id, text) in parts of about a million bytes, a row each, the texts joined and compressed."""
    names = ["part", "chars", "ids", "ends", "texts"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def row(part: int, ids: list[int], raw: list[bytes]) -> pa.RecordBatch:
        joined = b"".join(raw)
        chars = len(joined.decode("utf-8", "surrogatepass"))
        columns = [[part], [chars], [ids], [np.cumsum([len(t) for t in raw])], [pa.compress(joined, "zstd", asbytes=True)]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def parts(batches):
        part, ids, raw, size = uuid.uuid4().int >> 85 << 20, [], [], 0
        for batch in batches:
            for i, text in zip(batch.column("id"), batch.column("text").cast(pa.large_binary())):
                ids.append(i.as_py())
                raw.append(text.as_py())
                size += len(raw[-1])
                if size >= BLOCK_CHARS:
                    yield row(part, ids, raw)
                    part, ids, raw, size = part + 1, [], [], 0
        if ids:
            yield row(part, ids, raw)

    return texts.select("id", "text").mapInArrow(parts, "part long, chars long, ids array<long>, ends array<long>, texts binary")


def texts_in(parts: pa.Table | pa.RecordBatch):
    """(part, ids, texts) of the rows of ``numbered``."""
    for part, ids, ends, blob in zip(*(parts.column(c).to_pylist() for c in ("part", "ids", "ends", "texts"))):
        raw = pa.decompress(blob, ends[-1], "zstd", asbytes=True) if ends[-1] else b""
        yield part, ids, [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends)]


def repeated_seeds(texts: DataFrame, bits: int) -> DataFrame:
    """(part, slot, keys, many): keys of seeds of a part that occur again anywhere, and whether at more than ``ALL_PAIRS`` places.

    A key is the first 32 + ``bits`` bits of a seed: ``bits`` of them name the slot, the others are sorted and packed.
    """

    def packed(batches):
        for batch in batches:
            for part, _, found in texts_in(batch):
                keys = np.sort(np.concatenate([h[kept] for h, kept in (_kept(word_hashes(t)) for t in found)])) >> np.uint64(32 - bits)
                # More copies than make a seed common tell nothing.
                keys = keys[np.insert(keys[ALL_PAIRS + 1 :] != keys[: -ALL_PAIRS - 1], 0, np.ones(min(len(keys), ALL_PAIRS + 1), bool))]
                slots, first = np.unique(keys >> np.uint64(32), return_index=True)
                lists = [k.astype(np.uint32).tobytes() for k in np.split(keys, first[1:])] if len(keys) else []
                kinds = [pa.int64(), pa.int64(), pa.binary()]
                columns = [slots.astype(np.int64), np.full(len(slots), part), lists]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["slot", "part", "keys"])

    def counted(slot: pa.Table) -> pa.Table:
        lists = [np.frombuffer(k, np.uint32) for k in slot.column("keys").to_pylist()]
        keys, n = np.unique(np.concatenate(lists), return_counts=True)
        keys, n = keys[n > 1], n[n > 1]
        found, many = [], []
        for one in lists:
            one = one[np.insert(one[1:] != one[:-1], 0, True)]
            at = np.minimum(np.searchsorted(keys, one), max(0, len(keys) - 1))
            again = keys[at] == one if len(keys) else np.zeros(len(one), bool)
            found.append(one[again].tobytes())
            many.append((n[at[again]] > ALL_PAIRS).astype(np.uint8).tobytes())
        columns = [slot.column("part"), slot.column("slot"), pa.array(found, pa.binary()), pa.array(many, pa.binary())]
        return pa.table(columns, names=["part", "slot", "keys", "many"])

    hashes = texts.select("part", "ids", "ends", "texts").mapInArrow(packed, "slot long, part long, keys binary")
    return hashes.groupBy("slot").applyInArrow(counted, "part long, slot long, keys binary, many binary")


def repeated_places(texts: DataFrame) -> DataFrame:
    """(part, seed, after, id, x, prev): places of seeds that occur again.

    ``prev`` is null unless the seed is common and in a window with ``MIN_SEEDS`` places: then the seed one word before if that
    is as well, else 0.
    """
    size = texts.agg(F.sum("chars")).first()[0] or 0
    # A seed takes about five characters at least.
    bits = min(31, max(5, (size // 5 // COUNTED).bit_length()))

    def places(part: pa.Table, again: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 5 + (np.zeros(0, bool),)]
        if part.num_rows and again.num_rows:
            lists = again.to_pydict()
            keys = np.concatenate([np.frombuffer(k, np.uint32).astype(np.uint64) | np.uint64(s << 32) for s, k in zip(lists["slot"], lists["keys"])])
            many = np.concatenate([np.frombuffer(m, np.uint8) for m in lists["many"]]).astype(bool)
            order = np.argsort(keys)
            keys, many = keys[order], many[order]
            for i, text in ((i, t) for _, ids, found in texts_in(part) for i, t in zip(ids, found)):
                h, after, x = seeds(text)
                if not len(h) or not len(keys):
                    continue
                thinned = len(x) < x[-1] + 1
                key = h.view(np.uint64) >> np.uint64(32 - bits)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                good = np.flatnonzero(keys[at] == key)
                h, after, x, common = h[good], after[good], x[good], many[at[good]]
                if len(h):
                    common = common & (thinned | dense(x))
                    goes_on = np.insert((np.diff(x) == 1) & common[:-1], 0, False)
                    out.append((h, after, np.full(len(h), i), x, np.where(goes_on, np.roll(h, 1), 0), common))
        *rows, common = (np.concatenate(c) for c in zip(*out))
        number = part.column("part")[0].as_py() if part.num_rows else 0
        columns = [np.full(len(common), number), *rows[:4]]
        return pa.table([*(pa.array(c, pa.int64()) for c in columns), pa.array(rows[4], pa.int64(), mask=~common)], names=["part", "seed", "after", "id", "x", "prev"])

    again = repeated_seeds(texts, bits).groupBy("part")
    schema = "part long, seed long, after long, id long, x long, prev long"
    return texts.select("part", "ids", "ends", "texts").groupBy("part").cogroup(again).applyInArrow(places, schema)


def dense(x: np.ndarray) -> np.ndarray:
    """Whether each place is in a window with ``MIN_SEEDS`` places."""
    near = np.flatnonzero(x[MIN_SEEDS - 1 :] - x[: len(x) - MIN_SEEDS + 1] < WINDOWS) if len(x) >= MIN_SEEDS else x[:0]
    steps = np.zeros(len(x) + 1, np.int64)
    np.add.at(steps, near, 1)
    np.add.at(steps, near + MIN_SEEDS, -1)
    return np.cumsum(steps)[:-1] > 0


def same_windows(rows: np.ndarray, prev: np.ndarray, codes: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """Matches (id, anchor, x, y, WINDOW) among places (id, x) of one seed in order, given the words around them.

    Places meet unless they have the same ``prev``: then they meet one word before. Those of two chunks meet only across.
    """
    n = len(rows)
    nothing = np.zeros((0, 5), np.int64)
    if n < 2 or prev[0] != 0 and (prev == prev[0]).all():
        return nothing
    apart = (prev[:, None] != prev) | (prev == 0)
    apart &= np.tri(n, k=-1, dtype=bool)
    apart &= (rows[:, None, 0] != rows[:, 0]) | (rows[:, None, 1] - rows[:, 1] >= MIN_WORDS)
    if (chunk != chunk[0]).any():
        apart &= chunk[:, None] != chunk
    late, early = np.nonzero(apart)
    found = []
    for s in range(0, len(late), 1 << 14):
        i, j = late[s : s + (1 << 14)], early[s : s + (1 << 14)]
        equal = (codes[i] == codes[j]) & (codes[i] != 0)
        some = np.flatnonzero(equal.sum(1, dtype=np.uint8) >= LEAST_EQUAL)
        sums = np.pad(np.cumsum(equal[some], axis=1, dtype=np.int8), ((0, 0), (1, 0)))
        whole = sums[:, MIN_WORDS:] - sums[:, :WINDOWS] >= LEAST_EQUAL
        masks = (whole * (np.uint64(1) << np.arange(WINDOWS, dtype=np.uint64))).sum(1, dtype=np.uint64)
        kept = masks != 0
        found.append((i[some][kept], j[some][kept], masks[kept]))
    if not found:
        return nothing
    i, j, masks = (np.concatenate(c) for c in zip(*found))
    if not len(i):
        return nothing
    # Only partners with a window that no smaller one has.
    table_ = np.zeros((n, n), np.uint64)
    table_[i, j] = masks
    table_[:, 1:] &= ~np.bitwise_or.accumulate(table_, axis=1)[:, :-1]
    i, j = np.nonzero(table_)
    out = []
    for s in range(0, len(i), 1 << 14):
        p, q = i[s : s + (1 << 14)], j[s : s + (1 << 14)]
        equal = (codes[p] == codes[q]) & (codes[p] != 0)
        shared = np.logical_and.reduce([equal[:, k : AROUND - K + 1 + k] for k in range(K)])
        begins = (table_[p, q][:, None] >> np.arange(WINDOWS, dtype=np.uint64) & np.uint64(1)).astype(bool)
        first, last = begins.argmax(1), WINDOWS - 1 - begins[:, ::-1].argmax(1)
        at = np.arange(AROUND - K + 1)
        shared &= (at >= first[:, None]) & (at <= last[:, None] + BEFORE)
        # The ends of runs and every 16th seed stand for the others, near enough for a chain.
        inner = np.pad(shared, ((0, 0), (1, 1)))
        shared &= ~(inner[:, :-2] & inner[:, 2:]) | (at % 16 == 0)
        pair, o = np.nonzero(shared)
        p, q = p[pair], q[pair]
        out.append(np.stack([rows[p, 0], rows[q, 0], rows[p, 1] + o - BEFORE, rows[q, 1] + o - BEFORE, np.full(len(p), WINDOW)], 1))
    return np.concatenate(out)


def common_windows(places: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, anchor, x, y, sure): seeds of all windows that places of common seeds share."""
    common = places.where("prev is not null").select("part", "seed", "id", "x", "prev")
    share = F.pmod(F.xxhash64("seed"), F.lit(SEED_ROUNDS))
    return functools.reduce(DataFrame.union, [written(_windows(common.where(share == k), texts), "windows") for k in range(SEED_ROUNDS)])


def _windows(common: DataFrame, texts: DataFrame) -> DataFrame:
    kinds = common.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("prev").alias("low"), F.max("prev").alias("high"))
    # Where all have the same seed before them, they meet there.
    wanted = kinds.where("n > 1 and (low <> high or low = 0)").select("seed", F.ceil(F.col("n") / CELL).alias("chunks"))

    def with_words(part: pa.Table, asked: pa.Table) -> pa.Table:
        chosen = [np.zeros(0, np.int64)]
        codes = [np.zeros((0, AROUND), np.uint16)]
        if part.num_rows and asked.num_rows:
            ids, x, seed = (asked.column(c).to_numpy() for c in ("id", "x", "seed"))
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            for i, text in ((i, t) for _, ids, found in texts_in(part) for i, t in zip(ids, found)):
                rows = order[np.searchsorted(ids, i) : np.searchsorted(ids, i, "right")]
                if len(rows):
                    words = word_hashes(text)
                    h = rolling(words, K).view(np.int64)
                    # An id may have several texts.
                    rows = rows[x[rows] < len(h)]
                    rows = rows[h[x[rows]] == seed[rows]]
                    chosen.append(rows)
                    codes.append(words_around(words, x[rows]) if len(rows) else codes[0])
        rows = np.concatenate(chosen)
        raw = pa.Array.from_buffers(pa.binary(2 * AROUND), len(rows), [None, pa.py_buffer(np.concatenate(codes).tobytes())])
        return asked.select(names).take(pa.array(rows)).append_column("around", raw.cast(pa.binary()))

    names = ["seed", "id", "x", "prev", "chunks"]
    schema = ", ".join(f"{c} long" for c in names) + ", around binary"
    asked = common.join(wanted, "seed").select("part", *names).groupBy("part")
    found = texts.select("part", "ids", "ends", "texts").groupBy("part").cogroup(asked).applyInArrow(with_words, schema)
    chunked = found.withColumn("chunk", F.pmod(F.xxhash64("id", "x"), "chunks"))
    cells = chunked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    cells = cells.select("seed", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "id", "x", "prev", "chunk", "around")

    def compared(batches):
        rest = None
        for batch in batches:
            now = _cells(batch)
            now = now if rest is None else tuple(np.concatenate(c) for c in zip(rest, now))
            cuts = np.flatnonzero((np.diff(now[0][:, :3], axis=0) != 0).any(1)) + 1
            bounds = [0, *cuts.tolist()]
            out = [m for a, b in zip(bounds, bounds[1:]) if len(m := _compare(now, a, b))]
            rest = tuple(c[bounds[-1] :] for c in now)
            if out:
                yield _matches(np.concatenate(out))
        if rest is not None and len(m := _compare(rest, 0, len(rest[0]))):
            yield _matches(m)

    dealt = cells.repartition("seed", "i", "j").sortWithinPartitions("seed", "i", "j", "id", "x")
    return dealt.mapInArrow(compared, MATCH)


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(seed, i, j, id, x, prev, chunk) and codes of words of a batch."""
    numbers = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in range(7)], 1)
    return numbers, np.frombuffer(b"".join(batch.column("around").to_pylist()), np.uint16).reshape(-1, AROUND)


def _compare(rows: tuple[np.ndarray, np.ndarray], a: int, b: int) -> np.ndarray:
    numbers, codes = rows[0][a:b], rows[1][a:b]
    return same_windows(numbers[:, 3:5], numbers[:, 5], codes, numbers[:, 6])


def _matches(m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in m.T], ["id", "anchor", "x", "y", "sure"])


def matched_seeds(texts: DataFrame) -> DataFrame:
    """(id, anchor, x, y, sure): matches of places with equal seeds, of texts with parts (see ``numbered``)."""
    places = written(repeated_places(texts), "places")

    def links(batches):
        rest, first = np.zeros((0, 4), np.int64), None
        for batch in batches:
            rows = np.concatenate([rest, np.stack([np.asarray(batch.column(c)) for c in range(4)], 1)])
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            if first is None and last:
                first = rows[: int(np.searchsorted(rows[:, 0], rows[0, 0], "right"))][:ALL_PAIRS]
                yield _matches(border(first))
            if len(rows) - last > GROUP_ROWS:
                if first is None:
                    first = rows[:ALL_PAIRS]
                    yield _matches(border(first))
                last, done = len(rows) - 1, rows
            else:
                done = rows[:last]
            rest = rows[last:]
            yield _matches(linked(done))
        if len(rest):
            yield _matches(linked(rest))
            if first is None:
                yield _matches(border(rest[:ALL_PAIRS]))
            yield _matches(border(rest[-ALL_PAIRS:]))

    # A group at the end of a range may go on in the next: its places there are kept as BORDER, seed and after as id and anchor.
    border = lambda rows: np.stack([rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], np.full(len(rows), BORDER)], 1)
    ordered = places.select("seed", "after", "id", "x").repartitionByRange("seed", "after", "id", "x")
    out = written(ordered.sortWithinPartitions("seed", "after", "id", "x").mapInArrow(links, MATCH), "matches")
    ends = sorted(set(map(tuple, out.where(F.col("sure") == BORDER).collect())))
    more = linked(np.array(ends, np.int64).reshape(-1, 5)[:, :4])
    every = out.where(F.col("sure") < BORDER).union(common_windows(places, texts))
    return every.union(out.sparkSession.createDataFrame(more.tolist(), MATCH)) if len(more) else every


def chained(matches: DataFrame) -> DataFrame:
    """(id, anchor, xs, ys) of every chain long enough to be worth aligning."""

    def rows(batches):
        rest = None
        for batch in batches:
            now = np.stack([np.asarray(batch.column(c)) for c in range(5)], 1).astype(np.int64)
            now = now if rest is None else np.concatenate([rest, now])
            new = np.append(0, np.flatnonzero((np.diff(now[:, :2], axis=0) != 0).any(1)) + 1)
            # Most pairs of texts share too few seeds for a chain.
            seeds_at = np.add.reduceat(np.where(now[:, 4] == PLAIN, 1, 1 + MIN_SEEDS), new) if len(now) else new
            ends = np.append(new[1:], len(now))
            if out := [r for k in np.flatnonzero(seeds_at[:-1] >= MIN_SEEDS) for r in _chains_of(now[new[k] : ends[k]])]:
                yield _batch(out)
            rest = now[new[-1] :]
        if rest is not None and (out := _chains_of(rest)):
            yield _batch(out)

    dealt = matches.repartition("id").sortWithinPartitions("id", "anchor")
    return dealt.mapInArrow(rows, "id long, anchor long, xs array<long>, ys array<long>")


def _batch(out: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["id", "anchor", "xs", "ys"])


def _chains_of(part: np.ndarray) -> list[tuple]:
    sure, window = part[part[:, 4] == SURE, 2:4], part[part[:, 4] == WINDOW, 2:4]
    if len(part) + MIN_SEEDS * (len(sure) + len(window)) < MIN_SEEDS:
        return []
    # A sure match has all the words' seeds; so many of them are enough.
    steps = np.linspace(0, MIN_WORDS - K, MIN_SEEDS).astype(np.int64)
    x, y = np.concatenate([part[:, 2:4], (sure[:, None, :] + steps[:, None]).reshape(-1, 2)]).T
    # Inside an equal run, one match in eight stands for the others.
    key = np.unique((x - y + (1 << 31)) << 31 | x)
    # Seeds of a window count for all seeds that it has.
    strong = np.isin(key, (window[:, 0] - window[:, 1] + (1 << 31)) << 31 | window[:, 0])
    x = key & ((1 << 31) - 1)
    y = x - (key >> 31) + (1 << 31)
    if len(x) < MIN_SEEDS and not len(window):
        return []
    goes_on = np.diff(key) == 1
    kept = np.flatnonzero(~(np.insert(goes_on, 0, False) & np.append(goes_on, False)) | (x % 8 == 0) | strong)
    n = np.maximum(np.diff(np.append(kept, len(x))), np.where(strong[kept], MIN_SEEDS, 0))
    order = np.lexsort((y[kept], x[kept]))
    x, y, n = x[kept][order], y[kept][order], n[order]
    i, anchor = int(part[0, 0]), int(part[0, 1])
    found = [(x[c], y[c]) for c in chains(x, y, n)]
    if len(sure) and len(x) > 2 * len(np.unique(x)):
        # Among repeated words a chain may wander between diagonals; the sure matches of each diagonal are chains as well.
        straight = []
        for d in np.unique(sure[:, 0] - sure[:, 1]):
            xs = np.unique((sure[sure[:, 0] - sure[:, 1] == d, :1] + steps).ravel())
            straight += [(part, part - d) for part in np.split(xs, np.flatnonzero(np.diff(xs) > MAX_GAP) + 1)]
        found = sorted(straight, key=lambda c: int(c[0][0] - c[0][-1])) + found
    out, taken = [], []
    for xs, ys in found:
        if i == anchor:
            # Passages of one text don't overlap.
            apart = ys + K <= xs[0]
            xs, ys = xs[apart], ys[apart]
        if len(xs) > 1 and not any(first <= xs[0] and xs[-1] <= last for first, last in taken):
            taken.append((xs[0], xs[-1]))
            out.append((i, anchor, xs.tolist(), ys.tolist()))
    return out


def _word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes where the words of a text begin and end."""
    word = ~SPACES[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]])))
    return edges[::2], edges[1::2]


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lists of a column begin, and their values."""
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _slices(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Two rows (side 0 and 1) for each chain: its document and length there, its places on a side, the piece of text around them, and where that begins (word, code point)."""
    sides = F.array(*[F.struct(F.lit(n).alias("side"), F.col(i).alias("id"), F.col(p).alias("places")) for n, i, p in ((0, "id", "xs"), (1, "anchor", "ys"))])
    length = (F.element_at("xs", -1) - F.element_at("xs", 1)).alias("length")
    asked = found.select(F.col("id").alias("doc"), length, "chain", F.explode(sides).alias("s")).select("doc", "length", "chain", "s.*")
    # Only texts that may be asked for are dealt out.
    ids = bitmap(asked.select("id").distinct().select(F.xxhash64("id").alias("key")), "key")

    def held(batches):
        for batch in batches:
            keep = ids.holds(batch.column("key").to_numpy().view(np.uint64))
            yield batch.select(["id", "text"]).filter(pa.array(keep))

    some = rows.select("id", "text", F.xxhash64("id").alias("key")).mapInArrow(held, "id long, text string")
    # A text goes to Python once for so many rows, not with each.
    number = F.row_number().over(Window.partitionBy("id").orderBy("chain", "side"))
    lists = asked.withColumn("list", F.floor(number / TOGETHER)).groupBy("id", "list").agg(F.collect_list(F.struct("doc", "length", "chain", "side", "id", "places")).alias("asked"))
    with_text = some.join(lists.hint("shuffle_hash"), "id").select("asked", "text")

    def cut(batches):
        raw, ascii_, begin, end = None, True, None, None
        for batch in batches:
            of, rows_ = batch.column("asked").offsets.to_numpy(), batch.column("asked").values
            starts, places = _lists(rows_.field("places"))
            kept, lows, firsts, pieces, size = [], [], [], [], 0
            # One text at a time: those of a batch may be long.
            for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
                if (now := text.as_py()) != raw:
                    raw, ascii_ = now, now.isascii()
                    begin, end = _word_spans(raw)
                for k in range(of[row], of[row + 1]):
                    least, most = int(places[starts[k]]), int(places[starts[k + 1] - 1])
                    low, high = max(0, least - MARGIN), min(len(begin), most + K + MARGIN)
                    # Another text of the same id may be shorter.
                    if len(begin) >= most + K:
                        a, b = int(begin[low]), int(end[high - 1])
                        kept.append(k)
                        lows.append(low)
                        firsts.append(a if ascii_ else len(raw[:a].decode("utf-8", "surrogatepass")))
                        pieces.append(raw[a:b].decode("utf-8", "surrogatepass"))
                        size += b - a
                if kept and (size >= BLOCK_CHARS or row == batch.num_rows - 1):
                    some_ = rows_.take(pa.array(kept))
                    columns = [*(some_.field(c) for c in names[:6]), pa.array(lows, pa.int64()), pa.array(firsts, pa.int64()), pa.array(pieces, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    kept, lows, firsts, pieces, size = [], [], [], [], 0

    names = ["doc", "length", "chain", "side", "id", "places", "low", "first", "piece"]
    schema = "doc long, length long, chain long, side int, id long, places array<long>, low long, first long, piece string"
    return with_text.mapInArrow(cut, schema)


def _aligned(sides: list[dict], taken: list[tuple[int, int]]) -> list[tuple]:
    """Passages of the rows of one chain; an id may have several texts. ``taken`` gets those of the document: what lies inside one is left out."""
    out = []
    words = {}
    for r in sides:
        if r["side"] or any(a <= r["first"] and r["first"] + len(r["piece"]) <= b and (a, b) != (r["first"], r["first"] + len(r["piece"])) for a, b in taken):
            continue
        for o in sides:
            if o["side"] != 1:
                continue
            a, b = (words[id(c)] if id(c) in words else words.setdefault(id(c), word_hashes(c["piece"]).view(np.int64)) for c in (r, o))
            x, y = (c["places"] - c["low"] for c in (r, o))
            room = int(r["places"][0] - o["places"][-1]) - K if r["id"] == o["id"] else None
            p, q, s, t, share = align(a, b, x, y, room)
            if min(q - p, t - s) >= MIN_WORDS and share >= SIMILARITY:
                out.append((r["id"], *_span(r, p, q), o["id"], *_span(o, s, t), q - p, share))
    taken += [row[1:3] for row in out if row[1:3] not in taken]
    return out


def _span(side: dict, start: int, end: int) -> tuple[int, int]:
    """Code points of words of a piece."""
    raw = side["piece"].encode("utf-8", "surrogatepass")
    begins, ends = _word_spans(raw)
    a, b = int(begins[start]), int(ends[end - 1])
    if len(raw) != len(side["piece"]):
        a = len(raw[:a].decode("utf-8", "surrogatepass"))
        b = a + len(raw[int(begins[start]) : b].decode("utf-8", "surrogatepass"))
    return side["first"] + a, side["first"] + b


def _passages(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [c.split()[0] for c in PASSAGE.split(", ")])


def passages(docs: DataFrame) -> DataFrame:
    """A row for each passage of a document that another has: places, share of equal words, and the other's."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("id is not null")
    key = F.xxhash64("text", F.reverse("text"))
    keys = written(rows.select("id", key.alias("class"), F.length("text").alias("size")), "classes")
    marked = keys.distinct().join(keys.groupBy("class").agg(F.min("id").alias("first")), "class")
    copies = written(marked.where("id <> first").select("id", F.col("first").alias("anchor"), "size"), "copies")
    hint = "broadcast" if copies.count() <= BROADCAST_IDS else "shuffle_hash"
    texts = written(numbered(rows.join(copies.select("id").distinct().hint(hint), "id", "left_anti")), "texts")
    found = written(chained(matched_seeds(texts)).withColumn("chain", F.monotonically_increasing_id()), "chains")

    def aligned(batches):
        rest, doc, taken = [], None, []
        for batch in batches:
            out = []
            starts, places = _lists(batch.column("places"))
            others = batch.drop_columns(["places"]).to_pylist()
            for row, a, b in zip(others, starts, starts[1:]):
                row["places"] = places[a:b]
                if rest and rest[0]["chain"] != row["chain"]:
                    out += _aligned(rest, taken)
                    rest = []
                if doc != row["doc"]:
                    doc, taken = row["doc"], []
                rest.append(row)
            if out:
                yield _passages(out)
        if out := _aligned(rest, taken):
            yield _passages(out)

    # The longest chains of a document come first: what lies inside their passages needs no alignment.
    order = ["doc", F.desc("length"), "chain", "side"]
    rounds = []
    for k in range(ROUNDS):
        sides = _slices(found.where(F.pmod(F.xxhash64("id"), F.lit(ROUNDS)) == k), rows)
        rounds.append(written(sides.repartition("doc").sortWithinPartitions(*order).mapInArrow(aligned, PASSAGE), "passages"))
    fuzzy = functools.reduce(DataFrame.union, rounds)
    # The rows of a document are few: its own passages. One that lies inside another is part of that.
    order = Window.partitionBy("doc_id").orderBy("start", F.desc("end"), F.desc("similarity"), "partner_id", "partner_start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    once = fuzzy.withColumn("reach", reach).where("reach is null or end > reach").drop("reach")
    return once.union(_whole(copies, rows))


def _whole(copies: DataFrame, rows: DataFrame) -> DataFrame:
    """Copies of whole texts of enough words, as passages."""
    hint = "broadcast" if copies.count() <= BROADCAST_IDS else "shuffle_hash"
    of_copies = rows.join(copies.select("id").distinct().hint(hint), "id", "left_semi")

    # In Spark's own functions the count would go before the join, over all texts.
    def counted(batches):
        for batch in batches:
            n = [len(_word_spans(t)[0]) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64())], ["id", "words"])

    long_enough = of_copies.select("id", "text").mapInArrow(counted, "id long, words long").where(F.col("words") >= MIN_WORDS).distinct()
    zero, size = F.lit(0).cast("long"), F.col("size").cast("long")
    return copies.join(long_enough, "id").select(
        F.col("id").alias("doc_id"), zero.alias("start"), size.alias("end"), F.col("anchor").alias("partner_id"),
        zero.alias("partner_start"), size.alias("partner_end"), "words", F.lit(1.0).alias("similarity"),
    )


def op9_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))


QUERIES = {"op9_chained_passages": op9_chained_passages}
ORACLE: dict[str, str] = {}
