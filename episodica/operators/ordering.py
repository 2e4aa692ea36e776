"""Ordered computations without an unbounded window.

Positions, running totals and neighbouring values are defined over the order of a whole table
(or of a whole split). A window over such a group would put it into one task. ``scan`` cuts the
order key into ranges instead: one window per range, plus a table with one row per range
that carries totals, first and last values across the cuts. That table is written once, so its size is
known: a short one takes a plain window, a long one is cut into ranges again. Where values of the key
repeat so often that a range is too large, the next order columns cut it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits dropped from the order key at each level: a range holds at most 2^16 distinct keys, a
# range of ranges at most 2^20 ranges.
RANGE_BITS = (16, 20, 20)
# Longest range table that one window may take.
ONE_WINDOW = 4_000_000
# The order of steps: by ``index``, equal ones by episode and frame.
STEP_ORDER = ("index", "episode_index", "frame_index")
# Most rows of a range that is not cut further, crowded ranges that are sent to every executor, and salts beyond.
CROWD, LISTED_RANGES, SALTS = 1 << 18, 100_000, 64


# Checkpoints made since the innermost ``dropping_tables`` began.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def materialised(df: DataFrame) -> tuple[DataFrame, int]:
    """Write ``df`` to the cluster's checkpoint folder; return it with its row count."""
    _checkpoint_folder(df)
    size = Observation()
    done = df.observe(size, F.count(F.lit(1)).alias("n")).checkpoint()
    if (made := _made.get()) is not None:
        file = done._jdf.queryExecution().logical().rdd().getCheckpointFile()
        made += [file.get()] if file.isDefined() else []
    return done, size.get["n"]


def spooled(df: DataFrame, figure: Column | None = None) -> tuple[DataFrame, int]:
    """Write ``df`` as Parquet to the checkpoint folder, a fraction of what rows take; return it with its row count, or with ``figure`` over its rows."""
    spark = df.sparkSession
    path = f"{_checkpoint_folder(df)}/{uuid.uuid4().hex}"
    size = Observation()
    counted = df.observe(size, (F.count(F.lit(1)) if figure is None else figure).alias("n"))
    # Whole numbers as differences, which take less room than a dictionary where they rise.
    whole = {f"parquet.enable.dictionary#{f.name}": "false" for f in df.schema if isinstance(f.dataType, T.LongType)}
    counted.write.options(**whole, compression="zstd").option("parquet.writer.version", "v2").parquet(path)
    if (made := _made.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path), size.get["n"]


def _checkpoint_folder(df: DataFrame) -> str:
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="episodica-"))
    return sc.getCheckpointDir()


@contextmanager
def dropping_tables(spark: SparkSession) -> Iterator[None]:
    """Delete what ``materialised`` wrote inside, at the end; results that are still lazy can't be read after."""
    token = _made.set([])
    try:
        yield
    finally:
        for path in _made.get():
            file = spark._jvm.org.apache.hadoop.fs.Path(path)
            file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, True)
        _made.reset(token)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """One setting of the session, as long as a job of ours runs."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def order_list(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def sort_key(order: Sequence[str]) -> Column:
    """One comparable value for the order columns."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def ranged(
    df: DataFrame, order: Sequence[str], group: Sequence[str], name: str, bits: int, crowded: DataFrame | None = None, deeper: DataFrame | None = None
) -> DataFrame:
    """Add ``name``, the range of a row: equal ranges are neighbours in the order, and ranges follow it.

    A range is 2^``bits`` values of the first order column. Where these hold too many rows because values repeat
    (``crowded``, see ``ranges_of``), each value is cut by the second column, and where that is crowded too
    (``deeper``), each of its values by the third. The range is then a struct of all cuts.
    """
    cut = lambda c: F.shiftright(F.col(c), bits)
    if crowded is None:
        return df.withColumn(name, cut(order[0]))
    cuts = [cut(order[0]), F.col(order[0]), cut(order[1])]
    out = _flagged(df.withColumn("cut_0", cuts[0]), crowded, [*group, "cut_0"], "crowded_1", order)
    out = out.withColumns({f"cut_{k}": F.when(F.col("crowded_1"), cuts[k]).otherwise(0) for k in (1, 2)})
    names = ["cut_0", "cut_1", "cut_2"]
    if deeper is not None:
        out = _flagged(out, deeper, [*group, *names], "crowded_2", order)
        more = {"cut_3": F.col(order[1]), "cut_4": cut(order[2])}
        out = out.withColumns({k: F.when(F.col("crowded_2"), c).otherwise(0) for k, c in more.items()})
        names += list(more)
    return out.withColumn(name, F.struct(*names)).drop(*names, "crowded_1", "crowded_2")


def _flagged(df: DataFrame, crowded: DataFrame, keys: Sequence[str], name: str, order: Sequence[str]) -> DataFrame:
    """Add a flag for rows of crowded ranges. These are few but hold many rows, so their list is repeated over
    salts and no range meets its rows in one task; a short list needs no shuffle at all.
    """
    listed, n = materialised(crowded.select(*keys).withColumn(name, F.lit(True)))
    if n <= LISTED_RANGES:
        out = df.join(F.broadcast(listed), list(keys), "left")
    else:
        salts = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int"))
        out = spread.join(salts, [*keys, "salt"], "left").drop("salt")
    return out.withColumn(name, F.coalesce(name, F.lit(False)))


def ranges_of(
    df: DataFrame, order: Sequence[str], group: Sequence[str], aggregates: Sequence[Column], name: str, bits: int, crowd: int = CROWD
) -> tuple[DataFrame, DataFrame, int]:
    """(``df`` with its range, table of ranges with ``aggregates``, length of the table).

    A unique first order column fills no range above 2^``bits`` rows; then this is one aggregation. Only if a range
    holds more than ``crowd`` rows are the values of its first column cut by the next ones, so that a value that a third
    of all rows share is many ranges too.
    """
    crowded = deeper = None
    while True:
        rows = ranged(df, order, group, name, bits, crowded, deeper)
        table, n = materialised(rows.groupBy(*group, name).agg(*aggregates, F.count(F.lit(1)).alias("n_in_range")))
        full = table.where(F.col("n_in_range") > crowd)
        level = 1 + (crowded is not None) + (deeper is not None)
        if level >= len(order) or level == 3 or full.isEmpty():
            return rows, table.drop("n_in_range"), n
        if level == 1:
            crowded = full.select(*group, F.col(name).alias("cut_0"))
        else:
            deeper = full.select(*group, *[f"{name}.cut_{k}" for k in range(3)])


def range_order(table: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """The table of ranges with the columns that order it."""
    kind = table.schema[name].dataType
    if not isinstance(kind, T.StructType):
        return table, [name]
    cuts = {f"{name}_{f}": F.col(f"{name}.{f}") for f in kind.names}
    return table.withColumns(cuts), list(cuts)


def tied(w, order: Sequence[str]) -> Column:
    """Whether a row has the same order columns as the one before it in its window; then there is no order."""
    key = sort_key(order)
    return F.coalesce(F.lag(key).over(w) == key, F.lit(False))


def in_order(value: Column, tie: Column, order: Sequence[str]) -> Column:
    """``value``; raises where two rows tie."""
    return F.when(tie, F.raise_error(F.lit(f"Two rows have the same {', '.join(order)}; their order is not defined."))).otherwise(value)


def scan(
    df: DataFrame,
    order: str | Sequence[str],
    group: Sequence[str] = (),
    position: str | None = None,
    sums: Mapping[str, Column] | None = None,
    lags: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    leads: Mapping[str, Column] | None = None,
    bits: Sequence[int] = RANGE_BITS,
    one_window: int = ONE_WINDOW,
    crowd: int = CROWD,
) -> DataFrame:
    """Add order-dependent columns to ``df``; ``order`` is one or more long columns, unique together inside each group.

    Rows follow the first order column, equal ones the second, then the third; two rows that are equal in all of
    them raise. position: 0-based dense position. sums / maxima: running value over the rows *before* this one (0 /
    null at the start). lags / leads: value of the previous / next row (null at the start / end).
    """
    group, order = list(group), order_list(order)
    sums, lags, maxima, leads = dict(sums or {}), dict(lags or {}), dict(maxima or {}), dict(leads or {})
    if position is not None:
        sums[position] = F.lit(1).cast("long")
    names = [*sums, *lags, *maxima, *leads]
    rng, key = f"range_{len(bits)}", sort_key(order)
    keyed = df.withColumns({f"in_{n}": c for n, c in (sums | lags | maxima | leads).items()})
    aggregates = [
        *[F.sum(f"in_{n}").alias(f"in_{n}") for n in sums],
        *[F.max_by(f"in_{n}", key).alias(f"in_{n}") for n in lags],
        *[F.max(f"in_{n}").alias(f"in_{n}") for n in maxima],
        *[F.min_by(f"in_{n}", key).alias(f"in_{n}") for n in leads],
    ]
    keyed, totals, n_ranges = ranges_of(keyed, order, group, aggregates, rng, bits[0], crowd)
    totals, range_keys = range_order(totals, rng)
    carried = ordered(
        totals,
        n_ranges,
        range_keys,
        group,
        sums={f"base_{n}": F.col(f"in_{n}") for n in sums},
        lags={f"base_{n}": F.col(f"in_{n}") for n in lags},
        maxima={f"base_{n}": F.col(f"in_{n}") for n in maxima},
        leads={f"base_{n}": F.col(f"in_{n}") for n in leads},
        bits=bits[1:],
        one_window=one_window,
    ).select(*group, rng, *[f"base_{n}" for n in names])

    within = Window.partitionBy(*group, rng).orderBy(*order)
    inside = [{n: F.col(f"in_{n}") for n in part} for part in (sums, lags, maxima, leads)]
    rows = keyed.select(
        *df.columns,
        rng,
        *[c.alias(f"here_{n}") for n, c in _windowed(within, *inside).items()],
        (F.row_number().over(within) == 1).alias("opens_range"),
        *([F.lead(F.lit(True)).over(within).isNull().alias("ends_range")] if leads else []),
        tied(within, order).alias("tie"),
    ).join(carried, [*group, rng])

    out = {}
    for n in names:
        here, base = F.col(f"here_{n}"), F.col(f"base_{n}")
        if n in sums:
            out[n] = here + base
        elif n in lags:
            out[n] = F.when(F.col("opens_range"), base).otherwise(here)
        elif n in leads:
            out[n] = F.when(F.col("ends_range"), base).otherwise(here)
        else:
            out[n] = F.greatest(here, base)
    return rows.select(*df.columns, *[in_order(c, F.col("tie"), order).alias(n) for n, c in out.items()])


def ordered(
    table: DataFrame,
    n_rows: int,
    order: str | Sequence[str],
    group: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    lags: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    leads: Mapping[str, Column] | None = None,
    bits: Sequence[int] = RANGE_BITS[1:],
    one_window: int = ONE_WINDOW,
) -> DataFrame:
    """Same as ``scan`` for a table of known length: a plain window if it is short enough."""
    parts = [sums or {}, lags or {}, maxima or {}, leads or {}]
    if n_rows > one_window and bits:
        names = dict(zip(("sums", "lags", "maxima", "leads"), parts))
        return scan(table, order, group, **names, bits=bits, one_window=one_window)
    w = Window.partitionBy(*group).orderBy(*order_list(order))
    return table.withColumns(_windowed(w, *parts))


def _windowed(w, sums, lags, maxima, leads=()) -> dict[str, Column]:
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = {n: F.coalesce(F.sum(c).over(before), F.lit(0)) for n, c in sums.items()}
    out |= {n: F.lag(c).over(w) for n, c in lags.items()}
    out |= {n: F.max(c).over(before) for n, c in maxima.items()}
    out |= {n: F.lead(c).over(w) for n, c in dict(leads).items()}
    return out


def row_position(
    df: DataFrame,
    order: str | Sequence[str] = STEP_ORDER,
    group: Sequence[str] = (),
    name: str = "row",
    bits: Sequence[int] = RANGE_BITS,
    one_window: int = ONE_WINDOW,
    crowd: int = CROWD,
) -> DataFrame:
    """Dense 0-based row position in ``order``, per group."""
    return scan(df, order, group, position=name, bits=bits, one_window=one_window, crowd=crowd)
