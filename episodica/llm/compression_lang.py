"""Language identification by compression: the language whose dictionary makes a text smallest.

Every learned language has a dictionary of raw content, put together from passages of labelled texts. Texts
are folded first: letters in lower case, everything else one blank. A folded text is cut into pieces, every piece is compressed with each dictionary, and the sizes of all pieces are
added up, so the end of a long text counts as much as its beginning. The smallest sum names the language.
Sizes are code lengths, so their differences a byte of text, times a factor learnt on labelled texts outside
the dictionaries, give probabilities; where the best two lie too close, the guess is rejected.

The dictionaries are fitted on a bounded sample: of each language at most ``sample`` labelled rows outside
the held-out fold (the smallest hashes of their id), from each one passage of at most ``PASSAGE`` characters,
and at most ``DICTIONARY`` bytes of them make the dictionary. Half of the rows fill it, the other half
learn the factor. That is the only sample; every row is judged by its whole text. More than ``most`` languages
raise, so what is broadcast is at most ``MOST`` times ``DICTIONARY`` bytes (16 MB).

Defined results: a null text and one without a letter have the language ``und`` and score 0, and so has every
row if no language is learned; a null label teaches nothing, an empty one is a language; equal sizes, which only
texts of a few words have, go to the language with most labels, then to the first by name; repeated rows are judged
each; other columns of the input are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episodica.llm.common import table

UNKNOWN = "und"
# Characters of a labelled text that are learnt from, and bytes of a dictionary.
PASSAGE, DICTIONARY = 2048, 1 << 15
# Bytes of a piece, short against the dictionary, so that a piece can't be its own dictionary.
PIECE = 2048
# Labelled rows of a language that are learnt from, and languages.
SAMPLE, MOST = 128, 500
# Words are short, so matches of three bytes must count.
LEVEL, LEAST_MATCH = 12, 3
LETTER = re.compile(r"[^\W\d_]")
NO_LETTERS = re.compile(r"[\W\d_]+")


def folded(text: str) -> bytes:
    return f" {NO_LETTERS.sub(' ', text.lower()).strip()} ".encode("utf-8", "surrogatepass")


def held_out(doc_id: str | Column) -> Column:
    """Whether crc32 of the id as text can be divided by 5; true for a null id, which nothing is learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _usable(docs: DataFrame, label: str) -> DataFrame:
    named = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[label].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))
    return named.where("lang is not null and text is not null").where(~held_out("doc_id"))


def label_counts(docs: DataFrame, most: int = MOST, label: str = "lang") -> dict[str, int]:
    """Learnable rows of each language; more than ``most`` languages raise."""
    counts = _usable(docs, label).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    if len(counts) > most:
        raise ValueError(f"More than {most} languages are labelled.")
    return {r.lang: r.n for r in counts}


def learnable(docs: DataFrame, counts: dict[str, int], sample: int = SAMPLE, label: str = "lang") -> DataFrame:
    """lang, place (from 0, by hash) and passage of at most ``sample`` labelled rows of each language.

    Of a language with many rows, a share by hash that holds at least about four times ``sample`` is ranked,
    so no task ranks a whole language. ``counts`` says how many rows there are.
    """
    every = {lang: n // (4 * sample) for lang, n in counts.items() if n >= 8 * sample}
    rows = _usable(docs, label)
    if every:
        share = F.create_map(*[F.lit(x) for pair in every.items() for x in pair])
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.coalesce(share[F.col("lang")], F.lit(1))) == 0)
    # The passage begins at a place that depends on the id, and is the whole of a short text.
    spare = F.greatest(F.char_length("text") - PASSAGE, F.lit(0)) + 1
    passage = F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(1)), spare) + 1).cast("int"), F.lit(PASSAGE))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id", "passage")
    ranked = rows.select("doc_id", "lang", passage.alias("passage")).withColumn("place", F.row_number().over(by_hash) - 1)
    return ranked.where(F.col("place") < sample).select("lang", "place", "passage")


@dataclass
class Model:
    """Dictionaries of raw content by language, and the factor that turns bytes saved into evidence."""

    languages: list[str]
    contents: list[bytes]
    factor: float = 8 * float(np.log(2))
    ready: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "ready": []}

    def _compressors(self) -> list:
        if not self.ready:
            plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            settings = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=PIECE, dict_size=DICTIONARY, min_match=LEAST_MATCH, **plain
            )
            for content in self.contents:
                # The library takes no dictionary of fewer than eight bytes.
                raw = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(compression_params=settings)
                self.ready.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=settings))
        return self.ready

    def sizes(self, text: str) -> tuple[np.ndarray, int]:
        """Compressed size of the whole folded text with each dictionary, and its number of bytes."""
        data = folded(text)
        pieces = [data[k : k + PIECE] for k in range(0, len(data), PIECE)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self._compressors()], np.int64), len(data)

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, its probability, and the margin: bytes that the second best takes more, a byte of text."""
        if text is None or not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        sizes, n = self.sizes(text)
        best = int(np.argmin(sizes))
        margin = float(np.partition(sizes, 1)[1] - sizes[best]) / n if len(sizes) > 1 else 1.0
        return self.languages[best], float(shares(sizes[None], np.array([n]), self.factor)[0, best]), margin


def shares(sizes: np.ndarray, lengths: np.ndarray, factor: float) -> np.ndarray:
    """Probabilities of the languages (axis 1) from compressed sizes; evidence grows with the square root of the length."""
    extra = (sizes - sizes.min(1, keepdims=True)) / np.sqrt(np.maximum(lengths, 1))[:, None]
    weight = np.exp(-factor * extra)
    return weight / weight.sum(1, keepdims=True)


def fit(rows: list[tuple[str, int, str]], weights: dict[str, int] | None = None) -> Model:
    """A model from (lang, place, passage): even places fill the dictionaries, odd ones learn the factor.

    ``weights`` is the number of labels of each language, which decides between equal sizes.
    """
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for lang, place, passage in rows:
        by_lang.setdefault(lang, []).append((place, passage))
    weights = weights or {}
    languages = sorted(by_lang, key=lambda x: (-weights.get(x, 0), x))
    contents, others = [], []
    for at, lang in enumerate(languages):
        ordered = [p for _, p in sorted(by_lang[lang])]
        used, size = [], 0
        for p in ordered[::2]:
            raw = folded(p)[: DICTIONARY - size]
            used.append(raw)
            size += len(raw)
            if size >= DICTIONARY:
                break
        contents.append(b"".join(reversed(used)))  # what comes last is cheapest to refer to
        others += [(at, p) for p in ordered[1::2] if LETTER.search(p)]
    model = Model(languages, contents)
    if others and len(languages) > 1:
        truth = np.array([at for at, _ in others])
        found = [model.sizes(p) for _, p in others]
        sizes, lengths = np.stack([s for s, _ in found]), np.array([n for _, n in found])
        tried = np.geomspace(0.01, 100, 41)
        loss = [-np.log(np.maximum(shares(sizes, lengths, f)[np.arange(len(truth)), truth], 1e-9)).mean() for f in tried]
        model.factor = float(tried[int(np.argmin(loss))])
    return model


def train(docs: DataFrame, sample: int = SAMPLE, most: int = MOST, label: str = "lang") -> Model:
    """Fit on the bounded sample, which comes to the driver: at most ``most`` languages of ``sample`` passages."""
    counts = label_counts(docs, most, label)
    rows = learnable(docs, counts, sample, label).collect()
    return fit([(r.lang, r.place, r.passage) for r in rows], counts)


def identified(docs: DataFrame, model: Model, least_margin: float = 0.005) -> DataFrame:
    """doc_id, lang, nearest, score, margin of every row; lang is ``und`` where the margin is below ``least_margin``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [sent.value.judge(t.as_py()) for t in batch.column("text")]
            nearest, score, margin = zip(*found) if found else ((), (), ())
            lang = [name if m >= least_margin else UNKNOWN for name, m in zip(nearest, margin)]
            columns = [pa.array(lang, pa.string()), pa.array(nearest, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang", "nearest", "score", "margin"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang string, nearest string, score double, margin double")


def op11_compression_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identified(docs, train(docs)).select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("nearest").alias("lang_pred"), "score", "margin", (F.col("lang") == F.col("nearest")).alias("accepted")
    )


QUERIES = {"op11_compression_lang": op11_compression_lang}
ORACLE: dict[str, str] = {}
