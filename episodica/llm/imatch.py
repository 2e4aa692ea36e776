"""Document fingerprints by I-Match with several randomised lexicons.

The lexicon holds the terms whose inverse document frequency ln(N / df) lies in a band. Each of
``LEVELS`` times ``PER_LEVEL`` randomised subsets keeps a term with the probability of its level. A
fingerprint has one signature per subset: the hash of the document's sorted distinct terms that are in the
subset, zero if there are none. The likeness of two fingerprints is the largest share, over the levels,
of equal signatures among those that are not zero on both sides: dense subsets tell small changes
apart in short documents, sparse ones still agree on long documents that changed in part.

A term in the band has df >= N * exp(-idf_high), so the lexicon has at most the mean number of distinct
terms of a document times exp(idf_high) terms, however many documents there are. That bounds what
the driver collects and broadcasts.

Defined results: a null text is the empty text; a text without terms in the band takes all its terms
instead; without any terms all signatures are zero, which is like (1.0) another such text and unlike (0.0)
every other; equal texts have equal fingerprints. The next document is the one before in ascending
doc_id; rows with one id follow each other by text, null ids come last, and after the last row comes the
first. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import blocks, mix, table, texts_of

TERM = re.compile(r"\w+")
IDF_LOW, IDF_HIGH = 2.3, 8.5
LEVELS, PER_LEVEL = (4, 16, 64, 256), 16
# Terms that one task counts before it hands them on.
HELD = 400_000
SEED = 77
NO_ID = -(1 << 63)


def terms(text: str) -> set[str]:
    return set(TERM.findall(text.lower()))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(term, df) over all rows of ``text``; tasks add up before the shuffle."""

    def counted(batches):
        held: Counter[str] = Counter()
        for batch in batches:
            for text in texts_of(batch.column("text")):
                held.update(terms(text))
                if len(held) > HELD:
                    yield _counts(held)
                    held = Counter()
        if held:
            yield _counts(held)

    return texts.select("text").mapInArrow(counted, "term string, n long").groupBy("term").agg(F.sum("n").alias("df"))


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["term", "n"])


def lexicon(texts: DataFrame, idf_low: float = IDF_LOW, idf_high: float = IDF_HIGH) -> list[str]:
    """The terms in the band, sorted; their number is bounded as said above."""
    n = texts.count()
    low, high = n * np.exp(-idf_high), n * np.exp(-idf_low)
    rows = document_frequencies(texts).where(F.col("df").between(float(low), float(high))).select("term")
    return sorted(r.term for r in rows.collect())


class Lexicon:
    """Signatures of texts by the randomised subsets of a lexicon."""

    def __init__(self, words: list[str]):
        self.words = words
        self.__setstate__({"words": words})

    def __getstate__(self) -> dict:
        return {"words": self.words}

    def __setstate__(self, state: dict) -> None:
        self.words = state["words"]
        self.at = {w: i for i, w in enumerate(self.words)}
        self.hashes, self.member = _subsets(self.words)

    def signatures(self, text: str) -> np.ndarray:
        """One 16-bit signature for each subset."""
        found = terms(text)
        known = sorted(map(self.at.__getitem__, found & self.at.keys()) if len(found) > len(self.at) else [self.at[w] for w in found if w in self.at])
        if known:
            hashes, member = self.hashes[known], self.member[known]
        else:
            hashes, member = _subsets(sorted(found))
        with np.errstate(over="ignore"):
            total = mix((member * hashes[:, None]).sum(0, dtype=np.uint64)) >> np.uint64(48)
        return np.where(member.any(0), np.maximum(total, 1), 0).astype(np.uint16)


def _subsets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and whether each subset keeps it."""
    base = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    member = []
    with np.errstate(over="ignore"):
        for k, level in enumerate(LEVELS):
            for i in range(PER_LEVEL):
                draw = mix(base + np.uint64(SEED + 1000 * k + i) * np.uint64(0x9E3779B97F4A7C15))
                member.append(draw % np.uint64(level) == 0)
    return mix(base ^ np.uint64(SEED)), np.array(member, bool).T.reshape(len(words), len(LEVELS) * PER_LEVEL)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1; the levels with at least a quarter of their subsets in use count, or else all together."""
    used = ((a != 0) | (b != 0)).reshape(len(LEVELS), PER_LEVEL)
    same = ((a == b) & (a != 0)).reshape(len(LEVELS), PER_LEVEL)
    if not used.any():
        return 1.0
    n, equal = used.sum(1), same.sum(1)
    full = n >= PER_LEVEL // 4
    return float((equal[full] / n[full]).max()) if full.any() else float(equal.sum() / n.sum())


def printed(signatures: np.ndarray) -> str:
    return signatures.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def in_order(docs: DataFrame) -> DataFrame:
    """Rows in ranges of descending id, each followed by the first rows of the next range (``lent``).

    The ranges are cut at quantiles of the ids, one for each partition. What the driver holds is one
    largest id per range. Every text is shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("at"),
    )
    ids = rows.select("at")
    n = max(1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted({0.0} | {float(x) for x in ids.select(F.col("at").cast("double")).approxQuantile("at", [i / n for i in range(1, n)], 0.2 / n)})
    ranged = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="at_double", outputCol="range")
    cut = lambda df: ranged.transform(df.withColumn("at_double", F.col("at").cast("double"))).drop("at_double")
    heads = sorted(((int(r["range"]), r.head) for r in cut(ids).groupBy("range").agg(F.max("at").alias("head")).collect()), reverse=True)
    # The head of each range is lent to the range above it, that of the highest to the lowest.
    loans = [(head, above) for (_, head), above in zip(heads, [heads[-1][0]] + [r for r, _ in heads[:-1]])] if heads else []
    lent = F.broadcast(spark.createDataFrame(loans, "head long, above int"))
    own = F.array(F.struct(F.col("range").cast("int").alias("range"), F.lit(False).alias("lent")))
    also = F.array(F.struct(F.col("above").alias("range"), F.lit(True).alias("lent")))
    placed = cut(rows).join(lent, F.col("at") == F.col("head"), "left").withColumn(
        "places", F.when(F.col("above").isNull(), own).otherwise(F.concat(own, also))
    )
    return (
        placed.select("doc_id", "at", "text", F.explode("places").alias("p"))
        .select(F.col("p.range").alias("range"), F.col("p.lent").alias("lent"), "at", "doc_id", "text")
        .repartition("range")
        .sortWithinPartitions("range", "lent", F.desc("at"), "text")
    )


def fingerprints(docs: DataFrame, **band) -> DataFrame:
    """One row per row of ``docs``, with the columns of the query below."""
    words = lexicon(docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), **band)
    shared = docs.sparkSession.sparkContext.broadcast(Lexicon(words))

    def compared(batches):
        last = None
        for batch in batches:
            texts = texts_of(batch.column("text"))
            ranges, lent, ids = (batch.column(c).to_pylist() for c in ("range", "lent", "doc_id"))
            for a, b in blocks(texts):
                out = []
                for i in range(a, b):
                    now = (ranges[i], lent[i], ids[i], texts[i], shared.value.signatures(texts[i]))
                    # The first row of a range, or what follows its own rows, ends the row before.
                    if last is not None and not last[1] and last[0] == now[0]:
                        out.append(_row(last, now, shared.value))
                    last = now
                if out:
                    yield pa.RecordBatch.from_pylist(out, OUT)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs).mapInArrow(compared, schema)


OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _row(own: tuple, following: tuple, words: Lexicon) -> dict:
    _, _, doc_id, text, signatures = own
    new = edited(text, following[3])
    of_new = words.signatures(new)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": printed(signatures),
        "edited_fingerprint": printed(of_new),
        "near_edited": likeness(signatures, of_new),
        "near_next": likeness(signatures, following[4]),
    }


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op1_imatch": op1_imatch}
ORACLE: dict[str, str] = {}
