"""Fill-in-middle transformation: a wavelet matrix over character classes finds both cuts.

A text is cut into units (words with the white space before them, or lines, or single characters).
Every character belongs to one of seven classes, which tell blanks from words and mark where a word, a
line or the text ends. The wavelet matrix answers how many characters of a class lie before any place
(a rank), from one bit vector for each bit of the class. The ranks of the classes that end a unit add up to
the number of units before a place, and bisection on these sums finds where the k-th unit ends. One
matrix serves all texts of a block, and all cuts of the block are found together.

The first two numbers of a digest of seed and id choose the cuts, the third whether the text is changed and
the fourth in which order its parts are written, so a rerun of a lost task writes the same.

Defined results: null and empty texts are plain, with an empty output and no units; a null id is digested
as no digits; equal rows give equal outputs, each row its own; a text that holds a marker stays plain;
other columns of the input are not read, whatever their names. A text longer than a block is a block of
its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import blocks, code_points, table, texts_of

INSIDE, WORD_END, BLANK, NEWLINE, FINAL_BLANK, FINAL_NEWLINE, FINAL_WORD = range(7)
CLASS_BITS = 3
# Classes whose characters end a unit.
UNITS = {
    "word": (WORD_END, FINAL_BLANK, FINAL_NEWLINE, FINAL_WORD),
    "line": (NEWLINE, FINAL_BLANK, FINAL_NEWLINE, FINAL_WORD),
    "char": tuple(range(7)),
}
# Marks before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class WaveletMatrix:
    """Ranks of small symbols: one bit vector per bit of the symbols, highest first.

    On each level the symbols with a zero bit move before those with a one, in their old order.
    """

    def __init__(self, symbols: np.ndarray, bits: int = CLASS_BITS):
        self.size, self.bits, self.levels = len(symbols), bits, []
        now = symbols.astype(np.uint8)
        for b in reversed(range(bits)):
            one = (now >> b & 1).astype(bool)
            padded = np.zeros(self.size // 64 * 64 + 64, bool)
            padded[: self.size] = one
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((words, before, self.size - int(before[-1])))
            now = np.concatenate([now[~one], now[one]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & below)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols (0 to size, an array) are ``symbol``."""
        ends = np.concatenate([[0], np.asarray(at, np.int64)])
        for b, (words, before, zeros) in zip(reversed(range(self.bits)), self.levels):
            ones = self._ones(words, before, ends)
            ends = zeros + ones if symbol >> b & 1 else ends - ones
        return ends[1:] - ends[0]


class Boundaries:
    """Unit ends of the texts of one block."""

    def __init__(self, texts: list[str], unit: str = "word"):
        self.ends_unit = UNITS[unit]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.stop = np.cumsum(lengths)
        self.start = self.stop - lengths
        self.matrix = WaveletMatrix(classes(code_points("".join(texts)), self.stop[lengths > 0] - 1))
        self.first = self.before(self.start)
        self.units = self.before(self.stop) - self.first

    def before(self, at: np.ndarray) -> np.ndarray:
        """Units that end among the first ``at`` characters of the block."""
        return sum(self.matrix.rank(c, at) for c in self.ends_unit)

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Place in each text, in characters, at which its first ``k`` units end: bisection on ranks."""
        low, high, wanted = self.start.copy(), self.stop.copy(), self.first + k
        while (open_ := low < high).any():
            middle = (low + high) // 2
            reached = self.before(middle) >= wanted
            high = np.where(open_ & reached, middle, high)
            low = np.where(open_ & ~reached, middle + 1, low)
        return low - self.start


def classes(codes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Class of every character of a block; ``last`` holds the places of the last characters of its texts."""
    final = np.zeros(len(codes), bool)
    final[last] = True
    newline = codes == 10
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    blank_next = np.append(blank[1:], True)
    out = np.where(blank, np.where(newline, NEWLINE, BLANK), np.where(blank_next, WORD_END, INSIDE))
    return np.where(final, np.where(newline, FINAL_NEWLINE, np.where(blank, FINAL_BLANK, FINAL_WORD)), out)


def draws(doc_id: int | None, seed: int = 42) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from a digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4))


def check_markers(markers: tuple[str, str, str]) -> None:
    """An output can be taken apart only if no marker begins inside another."""
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError(f"Markers {markers} are not three different texts.")
    for a in markers:
        for b in markers:
            if any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))) or (a != b and a in b):
                raise ValueError(f"Markers {a!r} and {b!r} overlap.")


def transformed(
    docs: DataFrame,
    unit: str = "word",
    rate: int = 50,
    spm_rate: int = 80,
    seed: int = 42,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """doc_id, n units, form (plain, psm, spm), prefix_chars, middle_chars and output of every row.

    ``rate`` per cent of the texts are changed, ``spm_rate`` per cent of these put the suffix first.
    """
    check_markers(markers)
    if unit not in UNITS:
        raise ValueError(f"Unknown unit {unit!r}; use one of {list(UNITS)}.")
    p, s, m = markers

    def block(ids: list, texts: list[str]) -> list[tuple]:
        units = Boundaries(texts, unit)
        n = units.units
        h = np.array([draws(i, seed) for i in ids], np.int64)
        counts = np.sort(h[:, :2] % (n[:, None] + 1), 1)
        ends = units.cut(counts[:, 0]), units.cut(counts[:, 1])
        out = []
        for i, text, count, a, b, draw in zip(ids, texts, n.tolist(), *(e.tolist() for e in ends), h.tolist()):
            if not text or draw[2] % 100 >= rate or any(x in text for x in markers):
                out.append((i, count, "plain", None, None, text))
            elif draw[3] % 100 < spm_rate:
                out.append((i, count, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"))
            else:
                out.append((i, count, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"))
        return out

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))
            for a, b in blocks(texts):
                columns = zip(*block(ids[a:b], texts[a:b]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def original(output: str, form: str, markers: tuple[str, str, str] = MARKERS) -> str:
    """The text that an output was made from."""
    p, s, m = markers
    if form == "plain":
        return output
    first, second = (p, s) if form == "psm" else (s, p)
    one, rest = output[len(first) :].split(second, 1)
    two, middle = rest.split(m, 1)
    return one + middle + two if form == "psm" else two + middle + one


def restored(rows: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``rows`` (with output and form) and their ``text``, rebuilt from these two; null if one of them is null."""
    check_markers(markers)

    def run(batches):
        for batch in batches:
            outputs, forms = batch.column("output").to_pylist(), batch.column("form").to_pylist()
            texts = [None if o is None or f is None else original(o, f, markers) for o, f in zip(outputs, forms)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    if "text" in rows.columns:
        rows = rows.drop("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, text string")


def op13_fim_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = restored(transformed(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256")
    )


QUERIES = {"op13_fim_wavelet": op13_fim_wavelet}
ORACLE = {
    "op13_fim_wavelet": r"""
with texts as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || cast(doc_id as varchar)) as h from documents
), units as (
  select *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
    cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from texts
), cuts as (
  select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b from units
), parts as (
  select *, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle, array_to_string(u[b + 1:], '') as suffix,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
      when h4 % 100 < 80 then 'spm' else 'psm' end as form from cuts
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""
}
