"""Rows and the slices [ep_offset, ep_offset + ep_len) that hold them.

``assign_slices`` gives the pairs. ``summarise_slices`` gives one row per slice without forming
pairs: rows are folded into units of growing size, and a slice is made up of few units.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.operators.ordering import spooled

# Rows per block, as a power of two: near the length of an episode, so that a slice covers few
# blocks and a block meets few slices.
BLOCK_BITS = 6
# Blocks that one row of the slice table may expand to in one task.
SPREAD_BITS = 20
# Unit sizes as powers of two. A slice takes at most 126 units of the first size, 510 of each of
# the next two, and one of the last per four million rows, however long it is.
UNIT_BITS = (0, 6, 14, 22)


def assign_slices(
    rows: DataFrame, slices: DataFrame, n_rows: str, keys: Sequence[str] = ("split",), block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Each row with each slice that holds it (slices may overlap or leave gaps).

    ``slices`` has the keys, ep_pos, ep_offset, ep_len and a column named ``n_rows`` with the
    number of rows of its store; bounds beyond the rows are clipped. The range condition becomes
    an equi-join on row blocks: a long slice is spread over many blocks, in two steps so that
    no task expands it alone.
    """
    keys = list(keys)
    first, last = F.shiftright("lo", block_bits), F.shiftright(F.col("hi") - 1, block_bits)
    covered = (
        slices.withColumns(
            {
                "lo": F.greatest(F.col("ep_offset"), F.lit(0)),
                "hi": F.least(F.col("ep_offset") + F.col("ep_len"), F.col(n_rows)),
            }
        )
        .where("lo < hi")
        .withColumn("stretch", F.explode(F.sequence(F.shiftright(first, SPREAD_BITS), F.shiftright(last, SPREAD_BITS))))
        .repartition(*keys, "ep_pos", "stretch")
        .withColumn(
            "block",
            F.explode(
                F.sequence(
                    F.greatest(first, F.shiftleft("stretch", SPREAD_BITS)),
                    F.least(last, F.shiftleft(F.col("stretch") + 1, SPREAD_BITS) - 1),
                )
            ),
        )
        .drop("stretch")
    )
    return (
        rows.withColumn("block", F.shiftright("row", block_bits))
        .join(covered, [*keys, "block"])
        .where((F.col("row") >= F.col("lo")) & (F.col("row") < F.col("hi")))
        .drop("block", "lo", "hi")
    )


def window_rows(
    rows: DataFrame, slices: DataFrame, start: int = 0, end: int | None = None, stride: int = 1, keys: Sequence[str] = ("split",)
) -> DataFrame:
    """The rows at start, start + stride, ... <= end of their slice, with the columns of the slice.

    Only the wanted positions are expanded, as ep_offset plus a multiple of the stride, and met with
    rows by equality. Positions outside a slice or the store give no row; without ``end`` a slice is
    taken to its end, and a long one is expanded in two steps.
    """
    if stride <= 0 or start < 0 or (end is not None and end < start):
        raise ValueError(f"Invalid window start={start}, end={end}, stride={stride}.")
    final = F.col("ep_len") - 1 if end is None else F.least(F.col("ep_len") - 1, F.lit(end))
    steps = F.floor((final - start) / stride)
    wanted = slices.where(final >= start).withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(steps, SPREAD_BITS))))
    if end is None or (end - start) // stride >> SPREAD_BITS:
        wanted = wanted.repartition(*keys, "ep_pos", "stretch")
    part = F.sequence(F.shiftleft("stretch", SPREAD_BITS), F.least(steps, F.shiftleft(F.col("stretch") + 1, SPREAD_BITS) - 1))
    placed = wanted.withColumn("at", F.explode(part)).withColumn("row", F.col("ep_offset") + start + F.col("at") * stride)
    return rows.join(placed.drop("stretch", "at"), [*keys, "row"])


def slice_units(slices: DataFrame, bits: Sequence[int] = UNIT_BITS) -> DataFrame:
    """Each slice cut into whole units: its columns, level and unit. Columns lo and hi bound it."""

    def span(start: Column, stop: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        return F.when(start < stop, F.sequence(start, F.greatest(start, stop - 1))).otherwise(empty)

    def inside(level: int) -> tuple[Column, Column]:
        last = F.lit((1 << bits[level]) - 1)
        return F.shiftright(F.col("lo") + last, bits[level]), F.shiftright(F.col("hi"), bits[level])

    def labelled(units: Column, level: int) -> Column:
        return F.transform(units, lambda unit: F.struct(F.lit(level).alias("level"), unit.alias("unit")))

    pieces = []
    for level in range(len(bits)):
        first, stop = inside(level)
        units = span(first, stop)
        if level + 1 < len(bits):
            step = bits[level + 1] - bits[level]
            up_first, up_stop = inside(level + 1)
            edges = F.concat(span(first, F.shiftleft(up_first, step)), span(F.shiftleft(up_stop, step), stop))
            units = F.when(up_first < up_stop, edges).otherwise(units)
        pieces.append(labelled(units, level))
    return slices.select("*", F.inline(F.concat(*pieces)))


# Blocks of a short slice, and blocks or slices that are sent to every executor.
SHORT_BLOCKS, LISTED_BLOCKS = 16, 100_000
# Rows of a block whose places in it are the bits of one long.
PIECE_BITS = 6


def _by_length(table: DataFrame, n: int) -> DataFrame:
    """A written table as a side of a join, by its known length: Spark would judge it by its file, where sorted keys take a
    fraction of a byte each, and send tens of millions of rows to the driver and to every executor.
    """
    return F.broadcast(table) if n <= LISTED_BLOCKS else table.hint("merge")


def row_pieces(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows folded by block of 64, lead (step_idx - row) and episode: which places of the block they take, as bits.

    present and dones: bits of the rows, and of those that are done; n and n_done: numbers of them; times: how often each
    bit counts. A clean episode is one piece for each block that it touches. Rows that share a place can't be told by
    bits; the rows of such a block are pieces of their own, with ``times`` as their number.
    """
    bit = F.expr(f"shiftleft(1L, cast(row & {(1 << PIECE_BITS) - 1} as int))")
    narrow = rows.select(
        *keys,
        F.shiftright("row", PIECE_BITS).alias("block"),
        (F.col("step_idx") - F.col("row")).alias("lead"),
        F.col("episode_idx").alias("ep"),
        F.coalesce(F.col("done"), F.lit(False)).alias("done"),
        bit.alias("bit"),
    ).where("block is not null")
    done = F.coalesce(F.bit_or(F.when(F.col("done"), F.col("bit"))), F.lit(0).cast("long"))
    n, one = F.count(F.lit(1)), F.lit(1).cast("long")
    folded = narrow.groupBy(*keys, "block", "lead", "ep").agg(
        F.bit_or("bit").alias("present"), done.alias("dones"), n.alias("n"), F.count_if("done").alias("n_done")
    )
    shared = F.col("n") != F.bit_count("present")
    pieces, n_shared = spooled(folded.withColumn("times", one), F.count_if(shared))
    if not n_shared:
        return pieces
    blocks = _by_length(pieces.where(shared).select(*keys, "block").distinct(), n_shared)
    apart = narrow.join(blocks, [*keys, "block"], "left_semi").groupBy(*keys, "block", "lead", "ep", "bit", "done").agg(n.alias("n"))
    apart = apart.select(
        *keys, "block", "lead", "ep", F.col("bit").alias("present"), F.when(F.col("done"), F.col("bit")).otherwise(0).alias("dones"),
        "n", F.when(F.col("done"), F.col("n")).otherwise(0).alias("n_done"), F.col("n").alias("times"),
    )
    return pieces.join(blocks, [*keys, "block"], "left_anti").unionByName(apart)


def _block_digests(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per block of 64 rows: two sums over the hashes of its rows (row, lead, ep, done), their number, and whether each has a place of its own."""
    place = F.expr(f"shiftleft(1L, cast(row & {(1 << PIECE_BITS) - 1} as int))")
    hashed = rows.where("row is not null").select(
        *keys, F.shiftright("row", PIECE_BITS).alias("block"), F.xxhash64("row", "lead", "ep", "done").alias("h"), place.alias("place"),
        (F.col("lead").isNull() | F.col("ep").isNull()).alias("gap"),
    )
    sums = [F.sum(F.expr("h & 4294967295L")).alias("low"), F.sum(F.shiftrightunsigned("h", 32)).alias("high")]
    n = F.count(F.lit(1))
    return hashed.groupBy(*keys, "block").agg(n.alias("n"), *sums, ((F.bit_count(F.bit_or("place")) == n) & ~F.bool_or("gap")).alias("plain"))


def doubtful_slices(rows: DataFrame, slices: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None, int]:
    """The slices that may have a fault, the blocks that they touch (None: all) and the number of slices.

    A block whose rows are just what its slices ask for (each place once, lead and episode of the slice, done at its end) is
    told by one comparison of digests (two sums of 64-bit hashes), one row per block from either side, so clean stores shuffle
    next to nothing. Slices that touch another block, and long ones, are left for ``summarise_slices``.
    """
    keys = list(keys)
    placed = slices.withColumns({"lo": F.col("ep_offset"), "hi": F.col("ep_offset") + F.col("ep_len")})
    first, last = F.shiftright("lo", PIECE_BITS), F.shiftright(F.col("hi") - 1, PIECE_BITS)
    short = last - first < SHORT_BLOCKS
    asked = placed.where(short).select(*keys, "lo", "hi", F.col("episode_index").cast("long").alias("ep"), F.explode(F.sequence("lo", F.col("hi") - 1)).alias("row"))
    asked = asked.select(*keys, "row", (-F.col("lo")).alias("lead"), "ep", (F.col("row") == F.col("hi") - 1).alias("done"))
    there = rows.select(
        *keys, "row", (F.col("step_idx") - F.col("row")).alias("lead"), F.col("episode_idx").cast("long").alias("ep"), F.coalesce("done", F.lit(False)).alias("done")
    )
    both = _block_digests(there, keys).join(_block_digests(asked, keys).withColumnsRenamed({c: f"asked_{c}" for c in ("n", "low", "high", "plain")}), [*keys, "block"], "full")
    alike = F.col("plain") & (F.col("n") == F.col("asked_n")) & (F.col("low") == F.col("asked_low")) & (F.col("high") == F.col("asked_high"))
    odd, n_odd = spooled(both.where(~F.coalesce(alike, F.lit(False))).select(*keys, "block"))
    blocks = F.explode(F.sequence(first, last)).alias("block")
    touched = placed.where(short).select(*keys, "ep_pos", blocks).join(_by_length(odd, n_odd), [*keys, "block"], "left_semi").select(*keys, "ep_pos").distinct()
    touched, n_touched = spooled(touched)
    doubted = placed.join(_by_length(touched, n_touched), [*keys, "ep_pos"], "left_semi").unionByName(placed.where(~short))
    doubted, n = spooled(doubted.withColumn("short", short))
    if not n:
        return doubted, None, 0
    long_ones = doubted.where(~F.col("short")).limit(1).count()
    listed = None
    if not long_ones:
        listed, n_blocks = spooled(doubted.select(*keys, blocks).distinct())
        listed = listed if n_blocks <= LISTED_BLOCKS else None
    return doubted if n <= LISTED_BLOCKS else doubted.hint("merge"), listed, n


def slice_edges(slices: DataFrame) -> DataFrame:
    """The blocks that a slice [lo, hi) holds in part, at most two: its columns, block, and the first and last place in it."""
    size = 1 << PIECE_BITS
    first, last = F.shiftright("lo", PIECE_BITS), F.shiftright(F.col("hi") - 1, PIECE_BITS)
    place = lambda c: c.bitwiseAND(F.lit(size - 1).cast("long")).cast("int")
    in_one, opens, cut = first == last, place(F.col("lo")) != 0, place(F.col("hi")) != 0
    to = F.when(in_one, place(F.col("hi") - 1)).otherwise(size - 1)
    pieces = F.array(
        F.when(opens | (in_one & cut), F.struct(first.alias("block"), place(F.col("lo")).alias("from"), to.alias("to"))),
        F.when(~in_one & cut, F.struct(last.alias("block"), F.lit(0).alias("from"), place(F.col("hi") - 1).alias("to"))),
    )
    return slices.select("*", F.inline(F.array_compact(pieces)))


def unit_summaries(pieces: DataFrame, keys: Sequence[str], bits: Sequence[int]) -> DataFrame:
    """Pieces folded into units of every level: what the slice checks need to know of them."""
    figures = [
        F.sum("n").alias("n"), F.min("min_lead").alias("min_lead"), F.max("max_lead").alias("max_lead"),
        F.min("min_ep").alias("min_ep"), F.max("max_ep").alias("max_ep"), F.sum("n_done").alias("n_done"),
    ]
    single = pieces.withColumns({"min_lead": F.col("lead"), "max_lead": F.col("lead"), "min_ep": F.col("ep"), "max_ep": F.col("ep")})
    # The last place of a block is the sign of its bits.
    blocks = single.groupBy(*keys, "block").agg(*figures, F.bool_or(F.col("dones") < 0).alias("ends_done"))
    holders = [
        F.struct(
            F.lit(k).alias("level"),
            F.shiftright("block", b - PIECE_BITS).alias("unit"),
            ((F.col("block") + 1) % (1 << (b - PIECE_BITS)) == 0).alias("closes"),
        )
        for k, b in enumerate(bits)
    ]
    spread = blocks.select("*", F.inline(F.array(*holders)))
    return spread.groupBy(*keys, "level", "unit").agg(*figures, F.bool_or(F.col("closes") & F.col("ends_done")).alias("ends_done"))


def summarise_slices(
    rows: DataFrame, slices: DataFrame, keys: Sequence[str] = ("split", "camera"), bits: Sequence[int] = UNIT_BITS
) -> DataFrame:
    """Per slice with rows: keys, ep_pos, found, bad_steps, mixed, ends_done, early_done.

    ``slices`` lie inside the rows and are not empty. Overlaps cost no more than gaps: a slice meets the pieces of
    the two blocks at its ends, and whole units between them.
    """
    keys, bits = list(keys), [b for b in bits if b >= PIECE_BITS]
    bounds = {"lo": F.col("ep_offset"), "hi": F.col("ep_offset") + F.col("ep_len")}
    bounded = slices.select(*keys, "ep_pos", "ep_offset", "ep_len").withColumns(bounds).drop("ep_offset", "ep_len")
    pieces = row_pieces(rows, keys)

    inside = F.expr(f"shiftleft(-1L, `from`) & shiftrightunsigned(-1L, {(1 << PIECE_BITS) - 1} - `to`)")
    here, dones = F.col("present").bitwiseAND(F.col("inside")), F.col("dones").bitwiseAND(F.col("inside"))
    # Only the piece of the end has the place before ``hi``.
    final = F.col("block") * (1 << PIECE_BITS) + F.col("to") + 1 == F.col("hi")
    met = pieces.join(slice_edges(bounded).withColumn("inside", inside), [*keys, "block"]).where(here != 0)
    cut = met.select(
        *keys, "ep_pos", "lo",
        (F.bit_count(here) * F.col("times")).alias("n"),
        *[F.col(c).alias(f"{m}_{c}") for c in ("lead", "ep") for m in ("min", "max")],
        (F.bit_count(dones) * F.col("times")).alias("n_done"),
        (final & (F.expr("shiftrightunsigned(dones, `to`) & 1L") == 1)).alias("ends_done"),
    )
    units = slice_units(bounded, bits)
    size = F.element_at(F.array(*[F.lit(1 << b).cast("long") for b in bits]), F.col("level") + 1)
    closes = (F.col("unit") + 1) * size == F.col("hi")
    # A slice is up to a thousand units, so their number says nothing of the size of ``slices``.
    whole = unit_summaries(pieces, keys, bits).join(units.hint("merge"), [*keys, "level", "unit"]).withColumn("ends_done", closes & F.col("ends_done"))
    ends_done = F.coalesce(F.bool_or("ends_done"), F.lit(False))
    return (
        cut.unionByName(whole.select(*cut.columns))
        .groupBy(*keys, "ep_pos")
        .agg(
            F.sum("n").alias("found"),
            F.bool_or((F.col("min_lead") != -F.col("lo")) | (F.col("max_lead") != -F.col("lo"))).alias("bad_steps"),
            (F.min("min_ep") != F.max("max_ep")).alias("mixed"),
            ends_done.alias("ends_done"),
            (F.sum("n_done") > ends_done.cast("long")).alias("early_done"),
        )
    )
