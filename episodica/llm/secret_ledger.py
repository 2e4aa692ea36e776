"""Secret scans with an incremental blob ledger.

Every version of a text is addressed by its content (SHA-256). The ledger, a folder of Parquet files, has
one row for each blob and rule version that was ever scanned, with the spans found, none included. A scan
reads the texts of blobs that the ledger doesn't have under the current rule version, appends
their rows, and joins the findings back to all paths of each blob. Moved, copied and restored
versions cost no scan.

Rules: the base kinds assign, access and hex; beyond them ``key`` (private key blocks) and ``jwt``
(three base64url parts that begin as JSON does). Spans are in code points, end exclusive.

Defined results: a null text is the empty text, which is a blob like any other; paths may repeat or be
null, each row gets its findings; a blob that was appended twice (a retry) counts once. Other
columns of the input are kept where stated and never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import bitmap, shared_folder, stored, table, text_of, texts_of

RULES_VERSION = "1"
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "jwt")
SPANS = "array<struct<kind:string,start:long,end:long>>"
LEDGER = f"blob binary, rules string, spans {SPANS}"
MASK = "[secret]"
# Tasks over which the copies of one blob are spread when findings are joined back.
SALTS = 16

_ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEY = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then kind in the order of ``KINDS``."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [(m.start(), 3, m.end()) for m in _KEY.finditer(text)]
    if "eyJ" in text:
        found += [(m.start(), 4, m.end()) for m in _JWT.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def written(spans: Iterable) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _blob(df: DataFrame, text: str):
    return F.unhex(F.sha2(text_of(df, text), 256))


def open_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a ledger, none if there is no ledger yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder)


def scan(versions: DataFrame, ledger: str, text: str = "text", rules: str = RULES_VERSION) -> None:
    """Scan the blobs of ``versions`` that the ledger hasn't under ``rules``, and append them.

    Which blobs are unseen is found on their addresses alone. A bitmap of these (at most 16 MB) goes to the readers of the
    texts, so that no text of a seen blob is shuffled; what passes by chance is dropped by a join. One row stands for
    all copies of a blob: those in one partition are dropped before the shuffle.
    """
    spark = versions.sparkSession
    known = open_ledger(spark, ledger).where(F.col("rules") == rules).select("blob")
    unseen = stored(versions.select(_blob(versions, text).alias("blob")).distinct().join(known, "blob", "left_anti"), "unseen")
    low_bits = F.conv(F.hex(F.substring("blob", 1, 7)), 16, 10).cast("long")
    few = unseen.select(low_bits.alias("key"))
    if few.isEmpty():
        return
    sent = spark.sparkContext.broadcast(bitmap(few, "key"))

    def passing(batches):
        for batch in batches:
            keys = np.array([int.from_bytes(b[:7], "big") for b in batch.column("blob").to_pylist()], np.uint64)
            yield batch.filter(pa.array(sent.value.holds(keys)))

    def scanned(batches):
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in texts_of(batch.column("text"))]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array([rules] * len(spans), pa.string()), pa.array(spans, kind)], ["blob", "rules", "spans"])

    texts = versions.select(_blob(versions, text).alias("blob"), text_of(versions, text).alias("text")).mapInArrow(passing, "blob binary, text string")
    texts.dropDuplicates(["blob"]).join(unseen, "blob", "left_semi").mapInArrow(scanned, LEDGER).write.mode("append").parquet(ledger)


def _unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that is no column of ``df`` in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def findings(versions: DataFrame, ledger: str, text: str = "text", rules: str = RULES_VERSION, name: str = "found_spans") -> DataFrame:
    """``versions`` with the spans of every row (empty if none) in a new column ``name``, from the ledger.

    The blobs with findings are repeated over ``SALTS``, and the copies of a blob spread over these, so that no
    task gets all copies. A column ``name`` of ``versions`` raises.
    """
    if name.lower() in {c.lower() for c in versions.columns}:
        raise ValueError(f"There is a column {name!r} already; give another name.")
    blob, salt = _unused(versions, "versions_blob"), _unused(versions, "versions_salt")
    rows = open_ledger(versions.sparkSession, ledger).where((F.col("rules") == rules) & (F.size("spans") > 0))
    hits = rows.groupBy("blob").agg(F.first("spans").alias(name))
    hits = hits.withColumnRenamed("blob", blob).withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    others = [F.col(f"`{f.name}`") for f in versions.schema if f.name != text and "map<" not in f.dataType.simpleString()]
    spread = versions.withColumns({blob: _blob(versions, text), salt: F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int") if others else F.lit(0)})
    joined = spread.join(hits, [blob, salt], "left")
    return joined.select(*[F.col(f"`{c}`") for c in versions.columns], F.coalesce(name, F.array().cast(SPANS)).alias(name))


def masked(docs: DataFrame, ledger: str) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``MASK`` and ``n_chars`` brought up to date."""
    added = _unused(docs, "found_spans")
    found = findings(docs, ledger, name=added)

    def rows(batches):
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text")).to_pylist()
            spans = batch.column(names.index(added)).to_pylist()
            new = [t if not s else _mask(t, s) for t, s in zip(texts, spans)]
            out = {n: batch.column(i) for i, n in enumerate(names) if n != added}
            out["text"] = pa.array(new, out["text"].type)
            if "n_chars" in out:
                sizes = [len(t) if s else n for t, s, n in zip(new, spans, out["n_chars"].to_pylist())]
                out["n_chars"] = pa.array(sizes, out["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return found.mapInArrow(rows, docs.schema)


def _mask(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], MASK]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def _of_kind(kind: str):
    return lambda s: s.kind == kind


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = shared_folder(spark, "ledger")
    scan(docs, ledger)
    spans = findings(docs, ledger).select("doc_id", "found_spans")
    line = lambda kinds: F.array_join(F.transform(kinds, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("found_spans", lambda s: s.kind.isin(*BASE))
    return spans.select(
        "doc_id",
        *[F.size(F.filter("found_spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("found_spans")).alias("spans"),
    )


def digest(text: str) -> tuple:
    """What the query returns for a text, without the ledger; for tests."""
    spans = find_spans(text)
    base = [s for s in spans if s[0] in BASE]
    return (*[sum(s[0] == k for s in base) for k in BASE], hashlib.sha256(written(base).encode()).hexdigest(), written(spans))


QUERIES = {"op2_secret_ledger": op2_secret_ledger}
# The rules again, for SQL: pattern, and which group is the span.
_NAMES = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else f"{c}?" for c in n) for n in ("password", "passwd", "secret", "token", "api_key"))
_SQL_RULES = {
    "assign": rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "()(AKIA[A-Z0-9]+)",
    "hex": "()([0-9a-f]+)",
    "key": "()(-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=[:space:]]*-----END [A-Z ]*PRIVATE KEY-----)",
    "jwt": r"(^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,})",
}
_LEAST = {"assign": 6, "access": 20, "hex": 24, "key": 1, "jwt": 1}
_MATCHES = " union all ".join(
    f"""select doc_id, '{kind}' as kind, {k} as k, {_LEAST[kind]} as least, regexp_extract_all(t, '{rule}') as m,
  regexp_extract_all(t, '{rule}', 2) as g, string_split_regex(t, '{rule}') as p from texts"""
    for k, (kind, rule) in enumerate(_SQL_RULES.items())
)
# A match begins after the pieces between the matches before it and these matches themselves.
ORACLE = {
    "op2_secret_ledger": f"""
with texts as (select doc_id, coalesce(text, '') as t from documents), matches as ({_MATCHES}),
listed as (select *, unnest(range(1, len(m) + 1)) as i from matches),
placed as (
  select doc_id, kind, k, length(m[i]) as size, length(g[i]) as part, least,
    list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as pos
  from listed
), spans as (
  select doc_id, kind, k, cast(case kind when 'jwt' then pos + size - part else pos end as bigint) as a, cast(pos + size as bigint) as b
  from placed where part >= least
), lines as (
  select doc_id, string_agg(kind || ':' || a || ':' || b, ',' order by a, k) as spans,
    string_agg(kind || ':' || a || ':' || b, ',' order by a, k) filter (where k < 3) as base,
    count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access, count(*) filter (where k = 2) as n_hex
  from spans group by 1
)
select t.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts t left join lines l on l.doc_id = t.doc_id
"""
}
