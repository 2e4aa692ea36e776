"""The training store: Parquet steps by split and camera, an episode table and attributes.

Layout of a root: steps and episodes, each by version=/split=/camera=, and commits (see ``versions``), which say for every
store which version is its current one, its attributes, its columns and what its write observed. So a store is
read without opening the files of another, and a failed or empty overwrite leaves neither a mix nor stale rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions import fixed as K
from episodica.functions.names import camera_slug, match_camera
from episodica.operators.ordering import setting
from episodica.sources.reports import PRODUCED
from episodica.sources.versions import Record, exists, files_per_store, last_commit, publish, published

# Parquet codec per option; lz4_raw stands for the fast codec, which Parquet does not have.
CODECS = {"none": "none", "lzf": "lz4_raw", "gzip": "gzip"}
STORE_KEYS = ["split", "camera"]
# Pixels per block of consecutive rows. Files hold whole blocks, so a slice touches few files,
# and a block fits one task whatever the size of a frame.
BLOCK_BYTES = 1 << 28
# Differences for whole numbers and prefixes for bytes: positions and ids that rise take little room, less than in a dictionary.
ENCODINGS = {"parquet.writer.version": "v2", "parquet.enable.dictionary#episode_idx": "false", "parquet.enable.dictionary#index": "false"}
# Files that a task may hold open at once; with more stores Spark sorts the rest of its rows by store.
MOST_OPEN = 16
# Figures that one node of the plan observes; more stores take more nodes of the same pass.
OBSERVED = 64
# Columns that rows may bring for the write and that are not stored.
DECODER, OPENS = "decoder", "opens_video"

Stores = Sequence[tuple[str, str]]


def block_bits(frame_bytes: int) -> int:
    """Rows per block as a power of two, from the size of one frame: 64 to 65,536 rows."""
    return min(max((BLOCK_BYTES // max(frame_bytes, 1)).bit_length() - 1, 6), 16)


def check_compression(compression: str) -> str:
    if compression not in K.COMPRESSIONS:
        raise ValueError(f"Unknown compression {compression!r}; use one of {K.COMPRESSIONS}.")
    return CODECS[compression]


# --- read ----------------------------------------------------------------------------------


def records(spark: SparkSession, root: str, stores: Stores | None = None) -> list[Record]:
    """Every store below a root (of ``stores``, if given), sorted; one written without commits takes one footer."""
    found = published(spark, root)
    found += _without_commits(spark, root, {r.store for r in found})
    wanted = None if stores is None else set(map(tuple, stores))
    return sorted((r for r in found if wanted is None or r.store in wanted), key=lambda r: r.store)


def _without_commits(spark: SparkSession, root: str, known: set[tuple[str, str]]) -> list[Record]:
    """Records of complete stores of the older layout, steps/split=/camera= with an attribute table."""
    if not exists(spark, f"{root}/attributes"):
        return []
    rows = spark.read.schema(K.ATTRIBUTES_SCHEMA).parquet(f"{root}/attributes").where("complete").drop("complete").collect()

    def footer(kind: str, split: str, camera: str) -> T.StructType | None:
        keys = T.StructType([T.StructField(k, T.StringType()) for k in STORE_KEYS])
        if not exists(spark, f"{root}/{kind}"):
            return None
        files = _older_files(spark, root, kind, keys).where((F.col("split") == split) & (F.col("camera") == camera)).inputFiles()
        return spark.read.parquet(files[0]).schema if files else None

    out = []
    for r in rows:
        if (r.split, r.camera) not in known:
            columns, index = (footer(kind, r.split, r.camera) for kind in ("steps", "episodes"))
            numbers = {"n_rows": None, "n_files": None, "n_torn": None, "decoders": {}}
            out.append(Record(**r.asDict(), version=None, commit=-1, columns=columns, index_columns=index, **numbers))
    return out


def merged_columns(schemas: Iterable[T.StructType | None], usual: T.StructType) -> list[T.StructField]:
    """Every column of any of the schemas, those of ``usual`` first; a column must have one type."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema or ():
            other = fields.setdefault(field.name, field)
            if other.dataType != field.dataType:
                raise TypeError(f"Column {field.name!r} is {other.dataType.simpleString()} in one store and {field.dataType.simpleString()} in another; read them apart.")
    order = [n for n in usual.names if n in fields] + [n for n in fields if n not in usual.names]
    return [T.StructField(n, fields[n].dataType) for n in order if n not in STORE_KEYS]


def _read(spark: SparkSession, root: str, kind: str, found: Sequence[Record], fields: list[T.StructField]) -> DataFrame:
    keys = [T.StructField(k, T.StringType()) for k in STORE_KEYS]
    parts = []
    versioned = [r for r in found if r.version is not None]
    if versioned:
        # Values of the partitions are text, also where they look like numbers.
        schema = T.StructType([*fields, T.StructField("version", T.StringType()), *keys])
        folders = [f"{root}/{kind}/version={v}" for v in sorted({r.version for r in versioned})]
        files = spark.read.schema(schema).option("basePath", f"{root}/{kind}").parquet(*folders)
        parts.append(files.where(_is_one_of(versioned, [*STORE_KEYS, "version"])).drop("version"))
    older = [r for r in found if r.version is None]
    if older:
        files = _older_files(spark, root, kind, T.StructType([*fields, *keys]))
        parts.append(files.where(_is_one_of(older, STORE_KEYS)))
    if not parts:
        return spark.createDataFrame([], T.StructType([*fields, *keys]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _older_files(spark: SparkSession, root: str, kind: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("basePath", f"{root}/{kind}").parquet(f"{root}/{kind}/split=*")


def _is_one_of(found: Sequence[Record], keys: list[str]):
    """A condition on partition columns only, so that the scan lists no other store."""
    if len(found) == 1:
        return reduce(and_, [F.col(k) == getattr(found[0], k) for k in keys])
    named = F.concat_ws("\x00", *keys)
    return named.isin(["\x00".join(getattr(r, k) for k in keys) for r in found])


def read_store(spark: SparkSession, root: str, stores: Stores | None = None) -> DataFrame:
    """Steps of all stores (of ``stores``, if given) with the columns that these have; one that a store lacks is null in it."""
    found = records(spark, root, stores)
    fields = merged_columns([r.columns for r in found], K.STORE_SCHEMA) if found else [f for f in K.STORE_SCHEMA if f.name not in STORE_KEYS]
    return _read(spark, root, "steps", found, fields)


def read_episode_table(spark: SparkSession, root: str, stores: Stores | None = None) -> DataFrame:
    """Episodes of every store; if no store has any, there are no columns but split and camera."""
    found = [r for r in records(spark, root, stores) if r.index_columns is not None]
    return _read(spark, root, "episodes", found, merged_columns([r.index_columns for r in found], K.EPISODE_TABLE_SCHEMA))


def read_attributes(spark: SparkSession, root: str) -> DataFrame:
    """Attributes of every store."""
    names = [n for n in K.ATTRIBUTES_SCHEMA.names if n != "complete"]
    schema = T.StructType([K.ATTRIBUTES_SCHEMA[n] for n in names])
    return spark.createDataFrame([tuple(getattr(r, n) for n in names) for r in records(spark, root)], schema)


def list_stores(spark: SparkSession, root: str) -> DataFrame:
    """split, camera of the stores below a root, sorted; empty if there is nothing."""
    return spark.createDataFrame([r.store for r in records(spark, root)], "split string, camera string")


def produced(spark: SparkSession, root: str, found: Sequence[Record] | None = None) -> DataFrame:
    """split, camera, path, n_rows, n_files, decoders (name, n_videos) of every store, as its write observed them."""
    rows = [
        (r.split, r.camera, f"{root.rstrip('/')}/steps/version={r.version}/split={r.split}/camera={r.camera}", r.n_rows, r.n_files, sorted(r.decoders.items()))
        for r in (records(spark, root) if found is None else found)
    ]
    return spark.createDataFrame(rows, f"split string, {PRODUCED}")


def select_store(stores: DataFrame, split: str | None = None, camera: str | None = None) -> tuple[str, str]:
    """The one store that matches; a filter that is empty or None is not applied."""
    found = stores
    if split:
        found = found.where(F.col("split") == split)
    if camera:
        found = found.where((F.col("camera") == camera) | match_camera(camera_slug(F.col("camera")), F.lit(camera)))
    matches = [tuple(r) for r in found.select("split", "camera").distinct().orderBy("split", "camera").collect()]
    if len(matches) == 1:
        return matches[0]
    asked = f"split={split!r}, camera={camera!r}"
    if not matches:
        raise FileNotFoundError(f"No store matches {asked}.")
    raise ValueError(f"More than one store matches {asked}: {matches}; give split and camera.")


def episode_bounds(episode_table: DataFrame, split: str, camera: str, ep_pos: int) -> tuple[int, int]:
    """(ep_offset, ep_len) of the episode at a position of the store."""
    of_store = episode_table.where((F.col("split") == split) & (F.col("camera") == camera))
    row = of_store.where(F.col("ep_pos") == ep_pos).select("ep_offset", "ep_len").first()
    if row is None:
        raise IndexError(f"Episode position {ep_pos} is outside 0..{of_store.count() - 1}.")
    if row.ep_len <= 0:
        raise ValueError(f"Episode {ep_pos} has length {row.ep_len}.")
    return row.ep_offset, row.ep_len


def requested_bounds(requests: DataFrame, episode_table: DataFrame) -> DataFrame:
    """``requests`` (split, camera, ep_pos, ...) with ep_offset, ep_len and status of the episodes: what ``episode_bounds``
    returns or raises for one of them, for any number at once. status: ``ok``, ``outside`` or ``empty``.
    """
    found = episode_table.select(*STORE_KEYS, "ep_pos", "ep_offset", "ep_len")
    status = F.when(F.col("ep_len").isNull(), "outside").when(F.col("ep_len") <= 0, "empty").otherwise("ok")
    return requests.join(found, [*STORE_KEYS, "ep_pos"], "left").withColumn("status", status)


def select_episode(rows: DataFrame, split: str, camera: str, offset: int, length: int) -> DataFrame:
    """Rows of one slice: partitions and row range are pruned by the scan."""
    return rows.where(
        (F.col("split") == split)
        & (F.col("camera") == camera)
        & (F.col("row") >= offset)
        & (F.col("row") < offset + length)
    ).withColumn("ep_offset", F.lit(offset).cast("long"))


def with_proprio(rows: DataFrame) -> DataFrame:
    """Proprioception is a copy of the state."""
    return rows.withColumn("proprio", F.col("state"))


def store_rows(steps: DataFrame) -> DataFrame:
    """Step columns under the names of the store."""
    return steps.withColumnsRenamed({"episode_index": "episode_idx", "frame_index": "step_idx"})


def write_store(
    rows: DataFrame,
    episode_table: DataFrame,
    attributes: DataFrame,
    root: str,
    mode: str = "error",
    compression: str = "lzf",
    frame_bytes: int = 0,
    verify: bool = True,
    in_order: bool = False,
) -> list[Record]:
    """Write the stores named in ``attributes`` and publish them together; other stores stay as they are.

    mode ``error`` raises if one of them exists; ``overwrite`` replaces exactly these, with nothing if there are
    no rows. An episode table without a camera holds for every camera of its split. Rows that have a ``block``
    column are taken as spread by it already, as after ``attach_by_block``; with ``in_order`` the rows of a task are taken to lie in
    order in long stretches, as after ``row_position``, and are written as they come, unshuffled and unsorted. ``decoder`` and ``opens_video`` are counted
    and not stored. Rows, files, decoders and frames of a wrong size are observed by the one write;
    ``verify`` compares the rows with the episode table, and nothing is published if they differ.
    """
    codec = check_compression(compression)
    if mode not in ("error", "overwrite"):
        raise ValueError(f"Unknown mode {mode!r}; use 'error' or 'overwrite'.")
    spark = rows.sparkSession
    base = last_commit(spark, root)
    named = {(r.split, r.camera): r for r in attributes.collect()}
    stores = sorted(named)
    if mode == "error":
        clash = [r.store for r in records(spark, root, stores)][:3]
        if clash:
            raise FileExistsError(f"Stores exist below {root}, such as {clash}; use mode='overwrite'.")

    if in_order:
        laid_out = rows
    else:
        if "block" not in rows.columns:
            rows = rows.withColumn("block", F.shiftright("row", block_bits(frame_bytes)))
            rows = rows.repartition("split", "camera", "block")
        laid_out = rows.sortWithinPartitions("split", "camera", "block", "row").drop("block")
    of_stores = spark.createDataFrame(stores, "split string, camera string")
    index = episode_table.join(F.broadcast(of_stores), [k for k in STORE_KEYS if k in episode_table.columns])
    version = uuid.uuid4().hex

    written = _Observed(laid_out, stores)
    written.add("n_rows", F.lit(True))
    if "pixels" in rows.columns and {*K.PIXELS.names} <= {*getattr(rows.schema["pixels"].dataType, "names", ())}:
        size = F.col("pixels.height").cast("long") * F.col("pixels.width") * F.col("pixels.channels")
        written.whole("n_torn", F.col("pixels").isNotNull() & (F.coalesce(F.octet_length("pixels.data"), F.lit(-1)) != size))
    if DECODER in rows.columns:
        written.count_values("decoders", F.when(F.col(OPENS), F.col(DECODER)))
    listed = _Observed(index, stores)
    listed.add("n_index", F.lit(True))
    countable = "ep_len" in index.columns and isinstance(index.schema["ep_len"].dataType, T.IntegralType)
    if countable:
        listed.total("declared", F.col("ep_len"))

    def put(df: DataFrame, kind: str) -> None:
        df.write.options(**ENCODINGS, compression=codec).partitionBy(*STORE_KEYS).parquet(f"{root}/{kind}/version={version}")

    # A task may hold the files of all stores open, so that rows which lie in order need no sort; Spark sorts from the last one allowed on.
    open_files = min(len(stores), MOST_OPEN) + 1 if in_order else 0
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(open_files)):
        put(written.rows().drop(DECODER, OPENS), "steps")
    put(listed.rows(), "episodes")
    figures = {s: written.get(s) | listed.get(s) for s in stores}
    wrong = [(*s, f["n_rows"], f["declared"]) for s, f in figures.items() if countable and f["n_rows"] != f["declared"]]
    if verify and wrong:
        raise RuntimeError(f"Stores whose written rows differ from sum(ep_len): {wrong}.")

    n_files = files_per_store(spark, f"{root}/steps/version={version}")
    columns = T.StructType([f for f in laid_out.drop(DECODER, OPENS).schema if f.name not in STORE_KEYS]).json()
    index_columns = T.StructType([f for f in index.schema if f.name not in STORE_KEYS]).json()
    lines = []
    for s in stores:
        attribute = {n: getattr(named[s], n) for n in K.ATTRIBUTES_SCHEMA.names if n != "complete"}
        observed = {"n_rows": figures[s]["n_rows"], "n_torn": figures[s].get("n_torn", 0), "decoders": figures[s].get("decoders", {})}
        # A store with rows and no episodes has no episode table.
        known = index_columns if figures[s]["n_index"] or not figures[s]["n_rows"] else None
        lines.append({**attribute, "version": version, **observed, "n_files": n_files.get(s, 0), "columns": columns, "index_columns": known})
    number = publish(spark, root, lines, base, exclusive=mode == "error")
    return [Record.of(line | {"commit": number}) for line in lines]


class _Observed:
    """Figures of every store, taken while the rows of a DataFrame pass by on their way into files."""

    def __init__(self, df: DataFrame, stores: Stores):
        self.df, self.stores, self.cells, self.values, self.wholes, self.seen = df, stores, {}, {}, [], []

    def _of(self, k: int):
        split, camera = self.stores[k]
        return (F.col("split") == split) & (F.col("camera") == camera)

    def add(self, name: str, condition) -> None:
        """How many rows of a store fulfil a condition."""
        for k in range(len(self.stores)):
            self.cells[f"{name}_{k}"] = F.count_if(self._of(k) & condition)

    def whole(self, name: str, condition) -> None:
        """How many rows of all stores together fulfil a condition."""
        self.wholes.append(name)
        self.cells[f"{name}_0"] = F.count_if(condition)

    def total(self, name: str, value) -> None:
        for k in range(len(self.stores)):
            self.cells[f"{name}_{k}"] = F.coalesce(F.sum(F.when(self._of(k), value)), F.lit(0))

    def count_values(self, name: str, value) -> None:
        """How often each value of a small set occurs in a store; the set is that of ``DECODER`` names given by its metadata."""
        self.values[name] = self.df.schema[DECODER].metadata["names"]
        for at, one in enumerate(self.values[name]):
            for k in range(len(self.stores)):
                self.cells[f"{name}_{at}_{k}"] = F.count_if(self._of(k) & (value == one))

    def rows(self) -> DataFrame:
        out, cells = self.df, list(self.cells.items())
        for at in range(0, len(cells), OBSERVED):
            self.seen.append(Observation())
            out = out.observe(self.seen[-1], *[c.alias(n) for n, c in cells[at : at + OBSERVED]])
        return out

    @cached_property
    def found(self) -> dict:
        return {n: v for o in self.seen for n, v in o.get.items()}

    def get(self, store: tuple[str, str]) -> dict:
        k = list(self.stores).index(store)
        out = {}
        for name in self.cells:
            stem, _, number = name.rpartition("_")
            if int(number) == k or stem in self.wholes:
                out[stem] = int(self.found.get(name) or 0)
        for name, values in self.values.items():
            counts = {one: out.pop(f"{name}_{at}") for at, one in enumerate(values)}
            out[name] = {one: n for one, n in counts.items() if n}
        return out
