"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins; the model is one lookup table per feature and one per chosen pair
of features. The tables are learnt by cyclic boosting: feature after feature, a shallow tree on the
histogram of the current gradients moves that feature's table by a small step; then the pairs whose
joint tree gains most are boosted in the same way. A score is the logistic of the sum of table
entries, so scoring is array lookups and additions.

The tables are fitted on at most ``max_rows`` labelled rows (those with the smallest hash of their
id), which is the only bounded sample here; every row is scored from its whole text.

Defined results: null and empty texts have the features of an empty text and get a score too; rows
with a null label, a label other than 0 or 1 or a null id are not learnt from; repeated labels
count once each; without rows of both labels the score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import table, texts_of

FEATURES = (
    "log_chars log_words word_length upper symbol pipe digit stop newline distinct repeat top_word "
    "line_repeat bang short_words long_words non_ascii worst_upper worst_symbol worst_repeat"
).split()
# Classes of bytes: lower, upper, digit, space, newline, stop, pipe, bang, symbol, non-ASCII.
_CLASS = np.full(256, 8, np.int64)
_CLASS[128:] = 9
for _chars, _kind in (
    (b"abcdefghijklmnopqrstuvwxyz", 0),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1),
    (b"0123456789", 2),
    (b" \t", 3),
    (b"\n\r", 4),
    (b".,;:'-", 5),
    (b"|", 6),
    (b"!", 7),
):
    _CLASS[list(_chars)] = _kind
_CLASS = _CLASS.astype(np.uint8)
# Piece of a text whose worst value is a feature of its own, in bytes and in pairs of words.
PIECE, PAIRS = 512, 32
# Bins of a feature in its own table, and in the tables of pairs.
BINS, PAIR_BINS = 32, 8


def _worst(hits: np.ndarray, piece: int) -> float:
    """The largest share of hits in a piece: the pieces from the start, and the last one, which ends with the text."""
    n = len(hits)
    if n < piece:
        return float(hits.mean()) if n else 0.0
    whole = hits[: n // piece * piece].reshape(-1, piece)
    return max(float(whole.mean(1).max()), float(hits[-piece:].mean()))


def text_features(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    n = max(1, len(raw))
    c = np.bincount(kinds, minlength=10)
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    same = np.fromiter(map(str.__eq__, words, words[1:]), bool, max(0, len(words) - 1))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = max(1, int(c[0] + c[1] + c[9]))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        float(lengths.sum()) / m,
        c[1] / letters,
        c[8] / n,
        c[6] / n,
        c[2] / n,
        c[5] / m,
        c[4] / m,
        len(counts) / m,
        float(same.sum()) / m,
        max(counts.values(), default=0) / m,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        c[7] / m,
        float((lengths <= 3).sum()) / m,
        float((lengths >= 13).sum()) / m,
        c[9] / n,
        _worst(kinds == 1, PIECE),
        _worst((kinds >= 6) & (kinds <= 8), PIECE),
        _worst(same, PAIRS),
    ]


def feature_matrix(texts: list[str]) -> np.ndarray:
    return np.array([text_features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Gam:
    """Bin edges and lookup tables; ``pairs`` holds the two features of each table in ``joint``."""

    edges: list[np.ndarray]
    intercept: float
    single: np.ndarray
    pairs: list[tuple[int, int]] = field(default_factory=list)
    joint: np.ndarray = field(default_factory=lambda: np.zeros((0, PAIR_BINS, PAIR_BINS)))

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], 1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        total = np.full(len(x), self.intercept)
        for f in range(bins.shape[1]):
            total += self.single[f, bins[:, f]]
        coarse = bins * PAIR_BINS // BINS
        for (i, j), values in zip(self.pairs, self.joint):
            total += values[coarse[:, i], coarse[:, j]]
        return 1 / (1 + np.exp(-total))


def _cut(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + penalty) + (all_g - left_g) ** 2 / (all_h - left_h + penalty)
    if not len(gain):
        return 0.0, 0
    at = int(np.argmax(gain))
    return float(gain[at] - all_g**2 / (all_h + penalty)), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int, penalty: float) -> tuple[np.ndarray, float]:
    """Leaf values of a shallow tree over a histogram of any number of axes, and its gain."""
    best = (1e-9, None, 0)
    if depth:
        for axis in range(g.ndim):
            rest = tuple(a for a in range(g.ndim) if a != axis)
            gain, at = _cut(g.sum(rest), h.sum(rest), penalty)
            if gain > best[0]:
                best = (gain, axis, at)
    if best[1] is None:
        return np.full(g.shape, -g.sum() / (h.sum() + penalty)), 0.0
    gain, axis, at = best
    halves = [_tree(*(np.split(x, [at], axis)[k] for x in (g, h)), depth - 1, penalty) for k in (0, 1)]
    return np.concatenate([v for v, _ in halves], axis), gain + sum(x for _, x in halves)


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, n_pairs: int = 10, rate: float = 0.1, penalty: float = 5.0
) -> Gam:
    """Learn the tables from features ``x`` and labels ``y`` (0 or 1)."""
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) if len(x) else np.zeros(0) for f in range(len(FEATURES))]
    share = float(y.mean()) if len(y) else 0.5
    model = Gam(edges, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), np.zeros((len(FEATURES), BINS)))
    if not len(y) or share in (0.0, 1.0):
        return model
    bins = model.bins(x)
    coarse = bins * PAIR_BINS // BINS
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for f in range(len(FEATURES)):
            g, h = slopes()
            step, _ = _tree(np.bincount(bins[:, f], g, BINS), np.bincount(bins[:, f], h, BINS), 2, penalty)
            model.single[f] += rate * step
            total += rate * step[bins[:, f]]

    cells = {(i, j): coarse[:, i] * PAIR_BINS + coarse[:, j] for i in range(len(FEATURES)) for j in range(i)}
    shape = (PAIR_BINS, PAIR_BINS)

    def joint_tree(pair, g, h):
        return _tree(*(np.bincount(cells[pair], v, PAIR_BINS**2).reshape(shape) for v in (g, h)), 2, penalty)

    g, h = slopes()
    gains = {pair: joint_tree(pair, g, h)[1] for pair in cells}
    model.pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:n_pairs]
    model.joint = np.zeros((len(model.pairs), *shape))
    for _ in range(pair_rounds):
        for k, pair in enumerate(model.pairs):
            g, h = slopes()
            step, _ = joint_tree(pair, g, h)
            model.joint[k] += rate * step
            total += rate * step.ravel()[cells[pair]]
    return model


def learnable(labels: DataFrame, label: str = "quality", max_rows: int = 30_000) -> DataFrame:
    """At most ``max_rows`` labelled ids outside the held-out fold, by hash order."""
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = named.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)


def held_out(doc_id: str):
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 30_000, **settings) -> Gam:
    """Fit a model; the ids (at most ``max_rows``) are broadcast, their features come to the driver."""
    wanted = F.broadcast(learnable(labels, label, max_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id").select("doc_id", "label", "text")

    def features(batches):
        for batch in batches:
            x = feature_matrix(texts_of(batch.column("text")))
            columns = [batch.column("doc_id"), batch.column("label"), *map(pa.array, x.T)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", *FEATURES])

    schema = "doc_id long, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = texts.mapInArrow(features, schema).toPandas().sort_values(["doc_id", "label", *FEATURES])
    return fit(rows[FEATURES].to_numpy(np.float64), rows["label"].to_numpy(np.float64), **settings)


def score(docs: DataFrame, model: Gam) -> DataFrame:
    """doc_id and score of every row of ``docs``; other columns are not read."""

    def scored(batches):
        for batch in batches:
            s = model.scores(feature_matrix(texts_of(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Gam, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``threshold``."""

    def kept(batches):
        for batch in batches:
            s = model.scores(feature_matrix(texts_of(batch.column(batch.schema.get_field_index("text")))))
            yield batch.filter(pa.array(s >= threshold))

    return docs.mapInArrow(kept, docs.schema)


def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


QUERIES = {"op8_quality_gam": op8_quality_gam}
ORACLE: dict[str, str] = {}
