"""Inspection and validation of training stores, all stores of a table in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions import fixed as K
from episodica.operators.ordering import RANGE_BITS, materialised, scan
from episodica.operators.slices import PIECE_BITS, doubtful_slices, summarise_slices

STORE = ["split", "camera"]
# Stores (split x camera) up to which the table of stores is sent to every executor.
BROADCAST_STORES = 10_000

DTYPES = {
    T.FloatType(): "float32",
    T.DoubleType(): "float64",
    T.IntegerType(): "int32",
    T.LongType(): "int64",
    T.BooleanType(): "bool",
    T.BinaryType(): "uint8",
    T.StringType(): "object",
}


def _keys(episode_table: DataFrame) -> list[str]:
    """An episode table is one per store, or one per split for all its cameras."""
    return [k for k in STORE if k in episode_table.columns]


def _has_frames(rows: DataFrame) -> bool:
    dtype = rows.schema["pixels"].dataType
    return isinstance(dtype, T.StructType) and {*K.PIXELS.names} <= {*dtype.names}


def _per_store(table: DataFrame, n_stores: int) -> DataFrame:
    return F.broadcast(table) if n_stores <= BROADCAST_STORES else table


# --- inspect -------------------------------------------------------------------------------


def inspect(rows: DataFrame, episode_table: DataFrame | None = None) -> DataFrame:
    """split, camera, num_episodes, total_steps.

    From ep_len if there is an episode table, else from episode_idx, else null.
    """
    n = F.count(F.lit(1))
    if episode_table is not None and "ep_len" in episode_table.columns:
        keys = _keys(episode_table)
        declared = episode_table.groupBy(*keys).agg(
            F.count("ep_len").alias("num_episodes"), F.coalesce(F.sum("ep_len"), F.lit(0)).alias("total_steps")
        )
        return rows.select(*STORE).distinct().join(declared, keys, "left")
    if "episode_idx" in rows.columns:
        per_episode = rows.groupBy(*STORE, "episode_idx").agg(n.alias("n"))
        return per_episode.groupBy(*STORE).agg(n.alias("num_episodes"), F.sum("n").alias("total_steps"))
    null = F.lit(None).cast("long")
    return rows.select(*STORE).distinct().select(*STORE, null.alias("num_episodes"), null.alias("total_steps"))


def inspect_columns(rows: DataFrame, episode_table: DataFrame | None = None) -> DataFrame:
    """split, camera, column, dtype, n_values, shape: one row per column, sorted by name.

    shape is text: [rows, width] for vectors and [rows, height, width, channels] for pixels;
    a width that differs between rows shows as min..max.
    """
    aggs, labels = [], {}
    for field in sorted(rows.schema.fields, key=lambda f: f.name):
        name = field.name
        if name in (*STORE, "row"):
            continue
        sizes, dtype = [], field.dataType
        is_pixels = dtype.simpleString() == K.PIXELS.simpleString()
        if is_pixels:
            sizes, dtype = [F.col(f"{name}.{p}") for p in ("height", "width", "channels")], T.BinaryType()
        elif isinstance(dtype, T.ArrayType):
            sizes, dtype = [F.size(name)], dtype.elementType
        # A leaf of a struct is counted, so that pixel bytes are not read.
        present = sizes[0] if is_pixels else F.col(name)
        dims = [_extent(F.min(s), F.max(s)) for s in sizes]
        shape = F.concat(F.lit("["), F.concat_ws(", ", F.count(present).cast("string"), *dims), F.lit("]"))
        aggs.append(F.struct(F.count(present).alias("n_values"), shape.alias("shape")).alias(name))
        labels[name] = DTYPES.get(dtype, dtype.simpleString())
    per_store = rows.groupBy(*STORE).agg(*aggs)
    out = _unpivot(per_store, labels)
    names = [c for c in K.EPISODE_COLUMNS if episode_table is not None and c in episode_table.columns]
    if not names:
        return out
    types = {c: DTYPES.get(episode_table.schema[c].dataType, "object") for c in names}
    keys = _keys(episode_table)
    counted = episode_table.groupBy(*keys).agg(
        *[
            F.struct(
                F.count(c).alias("n_values"),
                F.concat(F.lit("["), F.count(c).cast("string"), F.lit("]")).alias("shape"),
            ).alias(c)
            for c in names
        ]
    )
    stores = per_store.select(*STORE)
    return out.unionByName(_unpivot(stores.join(counted, keys), types))


def _extent(low: Column, high: Column) -> Column:
    low, high = low.cast("string"), high.cast("string")
    return F.when(low == high, low).otherwise(F.concat(low, F.lit(".."), high))


def _unpivot(table: DataFrame, dtypes: dict[str, str]) -> DataFrame:
    cells = F.array(
        *[
            F.struct(
                F.lit(n).alias("column"),
                F.lit(d).alias("dtype"),
                F.col(f"{n}.n_values").alias("n_values"),
                F.col(f"{n}.shape").alias("shape"),
            )
            for n, d in dtypes.items()
        ]
    )
    return table.select(*STORE, F.inline(cells))


# --- validate ------------------------------------------------------------------------------


def missing_columns(
    rows: DataFrame, episode_table: DataFrame, required: Sequence[str] = (*K.PER_STEP_COLUMNS, *K.EPISODE_COLUMNS)
) -> list[str]:
    have = {*rows.columns, *episode_table.columns}
    return [c for c in required if c not in have]


def validate(
    rows: DataFrame,
    episode_table: DataFrame,
    strict_done: bool = True,
    required: Sequence[str] = (*K.PER_STEP_COLUMNS, *K.EPISODE_COLUMNS),
    bits: Sequence[int] = RANGE_BITS,
    pixel_bytes: bool = False,
) -> DataFrame:
    """All messages of all stores: split, camera, ep_pos, check, message; valid stores yield none.

    Ordered by (ep_pos, check): store-wide messages have ep_pos -1; ``check`` numbers the rules
    in the order they are applied. ``required`` may leave out columns a table does not have. A
    column without any value in one store is missing there. ``pixel_bytes`` reads the pixels too and
    compares their number with the shape.
    """
    missing = missing_columns(rows, episode_table, required)
    if missing:
        text = K.MISSING_KEYS % missing
        return _messages(rows.select(*STORE).distinct(), [(1, F.lit(True), F.lit(text))])

    stores, n_stores = materialised(store_totals(rows, pixel_bytes))
    rank_one = all(isinstance(episode_table.schema[c].dataType, T.IntegralType) for c in K.EPISODE_COLUMNS)
    if not rank_one:
        return _messages(stores, [*_row_checks(rows, pixel_bytes), (5, F.lit(True), F.lit(K.INDEX_RANK))])

    keys = _keys(episode_table)
    index, n_indexes = materialised(index_totals(episode_table, bits))
    whole = stores.join(_per_store(index, n_indexes), keys, "left").na.fill(0, ["n_len", "n_offset", "sum_len"])
    store_wide = _messages(whole, [*_row_checks(rows, pixel_bytes), *_index_checks()])

    named = [c for c in ("episode_index",) if c in episode_table.columns and isinstance(episode_table.schema[c].dataType, T.IntegralType)]
    slices = (
        episode_table.where("ep_len is not null and ep_offset is not null")
        .select(*keys, "ep_pos", "ep_len", "ep_offset", *named)
        .join(_per_store(stores.select(*STORE, "n_rows"), n_stores), keys)
    )
    return store_wide.unionByName(slice_messages(rows, slices, strict_done))


def store_totals(rows: DataFrame, pixel_bytes: bool = False) -> DataFrame:
    """Per store: n_rows, the number of values of each column, and the extent of the pixels."""
    aggs = [F.count("episode_idx").alias("n_rows")]
    for c in K.PER_STEP_COLUMNS:
        if c in rows.columns and c != "pixels":
            aggs.append(F.count(c).alias(f"n_{c}"))
    if "pixels" in rows.columns and not _has_frames(rows):
        aggs.append(F.count("pixels").alias("n_pixels"))
    elif "pixels" in rows.columns:
        aggs.append(F.count("pixels.channels").alias("n_pixels"))
        if pixel_bytes:
            size = F.col("pixels.height").cast("long") * F.col("pixels.width") * F.col("pixels.channels")
            aggs.append(F.count_if(F.coalesce(F.octet_length("pixels.data"), F.lit(-1)) != size).alias("n_torn"))
        for part in ("height", "width", "channels"):
            aggs += [F.min(f"pixels.{part}").alias(f"min_{part}"), F.max(f"pixels.{part}").alias(f"max_{part}")]
    return rows.groupBy(*STORE).agg(*aggs)


def index_totals(episode_table: DataFrame, bits: Sequence[int] = RANGE_BITS) -> DataFrame:
    """Per store (or split): what the store-wide checks need from the episode table."""
    keys = _keys(episode_table)
    before = scan(episode_table, "ep_pos", keys, lags={"before": F.col("ep_offset")}, bits=bits)
    return before.groupBy(*keys).agg(
        F.count("ep_len").alias("n_len"),
        F.count("ep_offset").alias("n_offset"),
        F.min_by("ep_offset", "ep_pos").alias("first_offset"),
        F.bool_or(F.col("ep_len") <= 0).alias("non_positive"),
        F.bool_or(F.col("ep_offset") < F.col("before")).alias("decreases"),
        F.coalesce(F.sum("ep_len"), F.lit(0)).alias("sum_len"),
    )


def _row_checks(rows: DataFrame, pixel_bytes: bool = False) -> list[tuple[int, Column, Column]]:
    columns = [c for c in K.PER_STEP_COLUMNS if c in rows.columns]
    empty = {c: (F.col(f"n_{c}") == 0) & (F.col("n_rows") > 0) for c in columns}
    lacking = F.concat_ws(", ", *[F.when(empty[c], F.lit(f"'{c}'")) for c in columns])
    short = F.concat_ws(
        ", ",
        *[F.when((F.col(f"n_{c}") != F.col("n_rows")) & ~empty[c], F.format_string(f"'{c}': %d", f"n_{c}")) for c in columns],
    )
    checks = [(1, lacking != "", F.format_string(K.MISSING_KEYS, F.concat(F.lit("["), lacking, F.lit("]"))))]
    checks += [(2, short != "", F.format_string(K.LENGTH_MISMATCH, short))]
    if "pixels" in columns and not _has_frames(rows):
        checks.append((3, F.lit(True), F.lit(K.PIXELS_RANK % 1)))
    elif "pixels" in columns:
        parts = ("height", "width", "channels")
        uniform = F.lit(True)
        for p in parts:
            uniform = uniform & (F.col(f"min_{p}") == F.col(f"max_{p}"))
        if pixel_bytes:
            uniform = uniform & (F.col("n_torn") == 0)
        channels = F.col("max_channels")
        checks += [
            # Frames of different sizes, or with too few or many bytes, do not stack into a rank-4 array.
            (3, ~uniform, F.format_string(K.PIXELS_RANK, F.lit(1))),
            (4, uniform & ~channels.isin(1, 3), F.format_string(K.PIXELS_CHANNELS, channels)),
        ]
    return checks


def _index_checks() -> list[tuple[int, Column, Column]]:
    text, col = F.format_string, F.col
    return [
        (6, col("n_len") != col("n_offset"), text(K.INDEX_LENGTHS, col("n_len"), col("n_offset"))),
        (7, col("first_offset") != 0, text(K.FIRST_OFFSET, col("first_offset"))),
        (8, col("non_positive"), F.lit(K.NON_POSITIVE_LEN)),
        (9, col("decreases"), F.lit(K.OFFSETS_DECREASE)),
        (10, col("sum_len") != col("n_rows"), text(K.TOTAL_ROWS, col("sum_len"), col("n_rows"))),
    ]


def slice_messages(rows: DataFrame, slices: DataFrame, strict_done: bool = True) -> DataFrame:
    """Messages about single slices; ``slices`` has one row per store and slice, with n_rows.

    With an ``episode_index`` the blocks of rows are compared with what the slices ask for, and only slices that differ are looked into.
    """
    narrow = rows.select(*STORE, "row", "step_idx", "episode_idx", "done")
    usable = F.coalesce(_fits() & (F.col("ep_len") > 0) & F.col("ep_pos").isNotNull(), F.lit(False))
    whole = slices.where(usable)
    if "episode_index" in slices.columns:
        whole, blocks, n = doubtful_slices(narrow, whole, STORE)
        if not n:
            narrow = narrow.where(F.lit(False))
        elif blocks is not None:
            narrow = narrow.withColumn("block", F.shiftright("row", PIECE_BITS)).join(F.broadcast(blocks), [*STORE, "block"], "left_semi").drop("block")
        slices = slices.where(~usable).unionByName(whole.select(*slices.columns))
    seen = summarise_slices(narrow, whole, STORE)
    end = F.col("ep_offset") + F.col("ep_len")
    # A negative length selects rows as a Python slice does: an end below 0 counts from the back.
    stop = F.when(end < 0, F.greatest(end + F.col("n_rows"), F.lit(0))).otherwise(end)
    found = F.when(F.col("ep_len") < 0, F.greatest(stop - F.col("ep_offset"), F.lit(0))).otherwise(
        F.coalesce(F.col("found"), F.lit(0))
    )
    judged = (
        slices.withColumns({"slice_end": end, "outside": ~_fits()})
        .join(seen, [*STORE, "ep_pos"], "left")
        .withColumn("found", found)
        .withColumn("complete", ~F.col("outside") & (F.col("found") == F.col("ep_len")))
    )
    text, col = F.format_string, F.col
    whole = col("complete") & (col("ep_len") > 0)
    checks = [
        (11, col("outside"), text(K.SLICE_BOUNDS, "ep_pos", "ep_offset", "slice_end", "n_rows")),
        (12, ~col("outside") & ~col("complete"), text(K.SLICE_ROWS, "ep_pos", "ep_len", "found")),
        (13, whole & col("bad_steps"), text(K.SLICE_STEPS, col("ep_pos"), col("ep_len") - 1)),
        (14, (whole & col("mixed")) | (col("complete") & (col("ep_len") == 0)), text(K.SLICE_MIXED, "ep_pos")),
    ]
    if strict_done:
        checks += [
            (15, whole & ~col("ends_done"), text(K.SLICE_TERMINAL, "ep_pos")),
            (16, whole & col("early_done"), text(K.SLICE_EARLY, "ep_pos")),
        ]
    return _messages(judged, checks, F.col("ep_pos").cast("long"))


def _fits() -> Column:
    return (F.col("ep_offset") >= 0) & (F.col("ep_offset") + F.col("ep_len") <= F.col("n_rows"))


def _messages(table: DataFrame, checks: list[tuple[int, Column, Column]], ep_pos: Column | None = None) -> DataFrame:
    hits = F.array_compact(
        F.array(*[F.when(bad, F.struct(F.lit(n).alias("check"), text.alias("message"))) for n, bad, text in checks])
    )
    where = F.lit(-1).cast("long") if ep_pos is None else ep_pos
    return table.select(*STORE, where.alias("ep_pos"), F.inline(hits))


def verdicts(stores: DataFrame, messages: DataFrame) -> DataFrame:
    """split, camera, valid, n_errors for every store."""
    counted = messages.groupBy(*STORE).agg(F.count(F.lit(1)).alias("n"))
    return stores.select(*STORE).join(counted, STORE, "left").select(
        *STORE, F.col("n").isNull().alias("valid"), F.coalesce("n", F.lit(0)).alias("n_errors")
    )


def any_error(verdicts: DataFrame) -> DataFrame:
    """One row, any_error: True if a store has errors."""
    return verdicts.agg(F.coalesce(F.bool_or(~F.col("valid")), F.lit(False)).alias("any_error"))


def check_replay_columns(rows: DataFrame, episode_table: DataFrame) -> None:
    """Schema checks before a replay; raises on the first that fails."""
    missing = missing_columns(rows, episode_table, K.REPLAY_COLUMNS)
    if missing:
        raise KeyError(K.MISSING_KEYS % missing)
    pixels = rows.schema["pixels"].dataType
    if not isinstance(pixels, T.StructType) or {*pixels.names} != {*K.PIXELS.names}:
        raise ValueError(f"pixels must be {K.PIXELS.simpleString()}, got {pixels.simpleString()}.")
    if pixels["data"].dataType != T.BinaryType():
        raise ValueError(f"pixels must be unsigned bytes, got {pixels['data'].dataType.simpleString()}.")
    for c in K.EPISODE_COLUMNS:
        if not isinstance(episode_table.schema[c].dataType, T.IntegralType):
            raise ValueError(K.INDEX_RANK)


def check_replay_rows(rows: DataFrame) -> None:
    """Value checks on the rows of a replay: nothing missing, 1 or 3 channels."""
    gap = F.col("pixels.channels").isNull() | F.col("action").isNull() | F.col("state").isNull()
    if not rows.where(gap).isEmpty():
        raise ValueError("Per-step columns have different numbers of values.")
    odd = rows.where(~F.col("pixels.channels").isin(1, 3)).select("pixels.channels").first()
    if odd is not None:
        raise ValueError(K.PIXELS_CHANNELS % odd.channels)
