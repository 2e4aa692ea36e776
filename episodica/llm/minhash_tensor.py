"""Near-duplicate documents by MinHash with tensored banding.

Two collections of ``m`` sub-keys are formed, each sub-key from ``rows`` minhashes. A table key is
a pair (i, j) of one sub-key from each collection, so m * m tables need only 2 * m * rows minhashes.
Documents at the similarity 0.8 share a table unless one whole collection disagrees: for m = 12 and
rows = 2 that is 2 * 0.36 ** 12, about one in 100,000 pairs.

1. Documents with equal shingle sets are one class; only its smallest id goes on.
2. A sub-key value that only one class has can't be part of a shared table: pairs are formed from
   the rest, which is what shares at least one sub-key with another class.
3. In every table bucket the members are compared with one member (the one whose sub-keys most
   others have), never all with all; links are confirmed on full sets and give components.
4. In a bucket that still holds several components, every member outside the largest is compared
   with the members of the other components, as far as both have a rare shingle in common that an
   alike pair must share (an exact bound). So no link between classes that share a bucket is lost
   to the component, and pairs inside a component are not compared again.

Defined results: null and empty texts, and texts of white space, have no shingles and are linked
with nothing; fewer words than a shingle make one shingle; rows with one id are one document; a null
id links with nothing, its component is null and it is kept. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episodica.llm.common import mix, rolling, stored, table, texts_of
from episodica.llm.components import components

SHINGLE, M, ROWS = 4, 12, 2
SEED = 20_250_101
# Sets are hashed in pieces of this many shingles, which bounds the memory of a very long text.
PIECE = 1 << 14
PAIR = "a long, b long"


def shingle_set(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(hashed):
        return hashed
    if len(hashed) < width:
        return rolling(hashed, len(hashed)) ^ mix(np.array([len(hashed)], np.uint64))
    return np.unique(rolling(hashed, width))


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(SEED))
    return seeds[:n, None], seeds[n:, None] | np.uint64(1)


def sub_keys(shingles: np.ndarray, m: int = M, rows: int = ROWS) -> np.ndarray:
    """The 2 * m sub-keys of a set that isn't empty: first those of one collection, then the other's."""
    masks, factors = _family(2 * m * rows)
    low = np.full(2 * m * rows, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), PIECE):
            low = np.minimum(low, ((shingles[None, at : at + PIECE] ^ masks) * factors).min(1))
        return mix((low.reshape(2 * m, rows) * (2 * np.arange(1, rows + 1, dtype=np.uint64) + 1)).sum(1, dtype=np.uint64))


def prepare(docs: DataFrame, width: int = SHINGLE, m: int = M, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits, null for empty sets) and sub_keys of every row."""

    def keys(batches):
        for batch in batches:
            n, key, subs = [], [], []
            for text in texts_of(batch.column("text")):
                s = shingle_set(text, width)
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                subs.append(sub_keys(s, m, rows).view(np.int64) if len(s) else None)
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(subs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "sub_keys"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(keys, "doc_id long, n_shingles long, set_key binary, sub_keys array<long>")


def table_keys(classes: DataFrame, m: int = M) -> DataFrame:
    """(id, n, weight, key) for every table bucket that a class may share: both sub-keys occur in other classes too.

    ``weight`` says how often others have the class's sub-keys: the original of many altered copies has the largest.
    """
    subs = classes.select("id", "n", F.posexplode("sub_keys").alias("at", "value"))
    common = subs.groupBy("at", "value").agg(F.count(F.lit(1)).alias("users")).where("users > 1")
    shared = subs.join(common, ["at", "value"])
    sides = shared.groupBy("id", "n").agg(
        F.sum("users").alias("weight"),
        F.collect_list(F.when(F.col("at") < m, F.struct("at", "value"))).alias("left"),
        F.collect_list(F.when(F.col("at") >= m, F.struct("at", "value"))).alias("right"),
    )
    one = sides.select("id", "n", "weight", F.explode("left").alias("x"), "right")
    return one.select("id", "n", "weight", "x", F.explode("right").alias("y")).select(
        "id", "n", "weight", F.xxhash64("x.at", "x.value", "y.at", "y.value").alias("key")
    )


def _alike(n: str, other: str, percent: int):
    return 100 * F.least(n, other) >= percent * F.greatest(n, other)


def star_pairs(keys: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of each member of a bucket with its member of largest weight, if their sizes allow a link."""
    centres = keys.groupBy("key").agg(
        F.min(F.struct((-F.col("weight")).alias("rank"), F.col("id").alias("c"), F.col("n").alias("c_n"))).alias("centre"), F.count(F.lit(1)).alias("size")
    ).where("size > 1").select("key", "centre.c", "centre.c_n")
    met = keys.join(centres, "key").where((F.col("id") != F.col("c")) & _alike("n", "c_n", percent))
    return met.select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()


def mixed_members(keys: DataFrame, found: DataFrame) -> DataFrame:
    """(id, n, component, minor) of the members of buckets that hold several components; ``minor`` if the
    member is outside the largest component of one of them."""
    named = keys.join(found, F.col("id") == F.col("node"), "left").select("key", "id", "n", F.coalesce("component", "id").alias("component"))
    parts = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("key").agg(
        F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").select("key", F.col("top.component").alias("largest"))
    return named.join(largest, "key").groupBy("id", "n", "component").agg(F.max(F.col("component") != F.col("largest")).alias("minor"))


def rare_shingles(members: DataFrame, texts: DataFrame, percent: int, width: int = SHINGLE) -> DataFrame:
    """The members' rarest shingles, as many that members which are alike have at least one of them in common.

    A link needs ``percent`` of the larger set in common. So of each set, in one order of all shingles,
    all but that many and one more are enough; the rarest shingles come first in that order.
    """

    def exploded(batches):
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), texts_of(batch.column("text"))):
                s = shingle_set(text, width).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i)), pa.array(s)], ["id", "shingle"])

    rows = texts.join(members.select("id"), "id", "left_semi").mapInArrow(exploded, "id long, shingle long")
    users = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("users")).where("users > 1")
    ranked = rows.join(users, "shingle", "left").withColumn(
        "place", F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("users", F.lit(1)), "shingle"))
    ).where("users > 1").select("id", "shingle", "place")
    needed = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    return ranked.join(members, "id").where(F.col("place") <= needed).select(
        "id", "n", "component", "minor", "shingle", (F.col("n") - F.col("place") + 1).alias("rest")
    )


def cross_pairs(keys: DataFrame, found: DataFrame, texts: DataFrame, percent: int, width: int = SHINGLE) -> DataFrame:
    """Distinct pairs of different components that share buckets and may be alike, as far as one is minor there.

    Of an alike pair, the first common shingle in that order has nearly the whole intersection behind
    it on both sides, so rows with too short a rest are left out.
    """
    members = stored(mixed_members(keys, found), "members")
    rare = stored(rare_shingles(members, texts, percent, width), "rare")
    minor = rare.where("minor").select("shingle", F.col("id").alias("id_"), F.col("n").alias("n_"), F.col("component").alias("component_"), F.col("rest").alias("rest_"))
    once = ~F.col("minor") | (F.col("id") < F.col("id_"))
    enough = (100 + percent) * F.least("rest", "rest_") >= percent * (F.col("n") + F.col("n_"))
    met = rare.join(minor, "shingle").where((F.col("component") != F.col("component_")) & once & _alike("n", "n_", percent) & enough)
    return met.select(F.least("id", "id_").alias("a"), F.greatest("id", "id_").alias("b")).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are alike: 100 * intersection >= percent * union."""
    side = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"text_{x}"))

    def linked(batches):
        for batch in batches:
            known: dict[str, np.ndarray] = {}
            keep = []
            for a, b in zip(texts_of(batch.column("text_a")), texts_of(batch.column("text_b"))):
                if a not in known:
                    known = {a: shingle_set(a, width)}
                x, y = known[a], shingle_set(b, width)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(linked, PAIR).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = SHINGLE, m: int = M, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    prepared = stored(prepare(docs, width, m, rows), "minhash")
    full = prepared.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = stored(
        full.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sub_keys").alias("sub_keys")), "classes"
    )
    keys = stored(table_keys(classes, m), "keys")
    involved = keys.select("id").distinct()
    texts = stored(
        docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(
            involved.hint("shuffle_hash"), "id", "left_semi"
        ), "texts"
    )
    first = stored(confirmed(star_pairs(keys, percent), texts, percent, width), "links")
    found = stored(components(first), "components")
    second = stored(confirmed(cross_pairs(keys, found, texts, percent, width), texts, percent, width), "links")
    edges = found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second)
    named = components(edges).select(F.col("node").alias("id"), "component")
    of_set = classes.select("set_key", "id").join(named, "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
    out = prepared.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    whole = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return whole.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, percent: int = 80, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that near-duplicate a smaller id."""
    dropped = near_duplicates(docs.select("doc_id", "text"), percent, width).where("not kept").select(F.col("doc_id").alias("dropped_id")).distinct()
    same = docs["doc_id"].cast("long") == dropped["dropped_id"]
    return docs.join(dropped.hint("shuffle_hash"), same, "left_anti")


def op10_minhash_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op10_minhash_tensor": op10_minhash_tensor}
ORACLE = {
    "op10_minhash_tensor": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words
), sizes as (select doc_id, count(*) as n from shingles group by 1),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)
), edges as (select x, y from links union all select y, x from links),
reached as (
  select doc_id as x, doc_id as y from words
  union select r.x, b.y from reached r join edges b on b.x = r.y
)
select r.x as doc_id, coalesce(any_value(n), 0) as n_shingles, min(r.y) as component_id, min(r.y) = r.x as kept
from reached r left join sizes s on s.doc_id = r.x group by r.x
"""
}
