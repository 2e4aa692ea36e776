"""Personal data by candidate gradient boosting, in DataFrame functions only.

Generators with high recall propose spans that may overlap: the four base kinds (matches that fail the
base's checks included) and looser forms (addresses written with "at", numbers in groups without a plus).
Boosted trees score every candidate from its format and its context. They learn from what the base rules say of
the base candidates and, for loose ones, from their normal form and context; neither the kind nor the checks are features. These are small integers, so all candidates of the corpus reduce to at most
``MAX_CELLS`` counted combinations, and the trees are fitted on those counts. The threshold is calibrated there: the
lowest score with the wanted precision among the candidates above it. Spans returned are those of the base
rules and every other candidate at or above the threshold outside them. Scores are CASE expressions over arrays,
so no row is shuffled or leaves the JVM.

Positions come from ``split`` and ``regexp_extract_all``: what lies between matches gives the places of the
matches, in code points. The patterns use possessive quantifiers and start only where a match can
begin, which changes no match and keeps long runs linear.

Defined results: null and empty texts have no spans; repeated rows each get theirs; an empty table gives no
rows; without candidates nothing is added. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import stored, table

_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email_loose": r"(?<![A-Za-z0-9])[A-Za-z0-9._-]{2,40}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{2,40}(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z]{2,20}){1,4}",
    "phone_loose": r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])",
}
KINDS = (*BASE, *LOOSE)
CONTEXT = r"(?i)(mail|tel|phone|call|fax|mobile|card|visa|ip|address|contact)[^A-Za-z0-9]{0,6}$"
FEATURES = {"digits": 8, "letters": 3, "marks": 4, "context": 2, "edge": 2, "at": 3}
MAX_CELLS = int(np.prod(list(FEATURES.values())))
ROUNDS, RATE, PRECISION = 40, 0.3, 0.98
SPAN = "array<struct<kind:int,start:bigint,end:bigint,m:string>>"


def spans(text: Column, kind: int, pattern: str) -> Column:
    """All leftmost non-overlapping matches with their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("out"))
    pairs = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
    return F.aggregate(pairs, begin, step, lambda s: s["out"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled and reduced, and the others add up to a multiple of ten."""
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: _luhn_digit(digits, i))
    return (F.length(digits) > 0) & (F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0)


def _luhn_digit(digits: Column, i: Column) -> Column:
    d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    twice = 2 * d
    return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)


def passes(kind: Column, m: Column) -> Column:
    """The checks of the base kinds; false for the loose ones."""
    digits = _digits(m)
    n = F.length(digits)
    parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return (
        F.when(kind == 0, True)
        .when(kind == 1, small)
        .when(kind == 2, n.between(16, 19) & F.when(n.between(16, 19), luhn(digits)).otherwise(False))
        .when(kind == 3, n.between(8, 15))
        .otherwise(False)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: the candidates with their features and whether the base rules take them."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    needs = {"email": "@", "phone": "+"}
    none = F.array().cast(SPAN)

    def of(kind: int, name: str) -> Column:
        if name in needs:
            return F.when(F.contains("text", F.lit(needs[name])), spans(F.col("text"), kind, (BASE | LOOSE)[name])).otherwise(none)
        return F.when(F.col("text").rlike((BASE | LOOSE)[name]), spans(F.col("text"), kind, (BASE | LOOSE)[name])).otherwise(none)

    every = rows.withColumn("all", F.concat(*[of(k, name) for k, name in enumerate(KINDS)]))

    def described(c: Column) -> Column:
        m, start = c["m"], c["start"].cast("int")
        before = F.substring(F.col("text"), F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24)))
        around = F.concat(F.substring(F.col("text"), F.greatest(start, F.lit(1)), F.least(start, F.lit(1))), F.lit(" "), F.substring(F.col("text"), c["end"].cast("int") + 1, F.lit(1)))
        letters = F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
        valid, named, n = passes(c["kind"], m), before.rlike(CONTEXT), F.length(_digits(m))
        # A loose address is one once its marks are put back; a loose number of a phone's length counts where its context or brackets say so.
        loose = F.when(c["kind"] == 4, True).when(c["kind"] == 5, n.between(8, 15) & (named | m.startswith("("))).otherwise(False)
        return F.struct(
            c["kind"].alias("kind"),
            c["start"].alias("start"),
            c["end"].alias("end"),
            F.least(F.length(_digits(m)) / 3, F.lit(7)).cast("int").alias("digits"),
            F.least(letters / 8, F.lit(2)).cast("int").alias("letters"),
            F.least(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), F.lit(3)).cast("int").alias("marks"),
            named.cast("int").alias("context"),
            around.rlike("[A-Za-z0-9]").cast("int").alias("edge"),
            F.when(m.rlike("@|[\\[(]at[\\])]"), 2).when(m.rlike(r"^[+(]"), 1).otherwise(0).alias("at"),
            (valid | loose).alias("label"),
            valid.alias("base"),
        )

    return every.select("doc_id", F.transform("all", described).alias("found"))


def fit(cells: np.ndarray, weight: np.ndarray, positive: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> list[tuple]:
    """Boosted trees of two levels over counted cells: (feature, cut, left, right), leaves are numbers."""
    score, trees = np.zeros(len(cells)), []

    def grow(rows: np.ndarray, depth: int, g: np.ndarray, h: np.ndarray):
        total = (g[rows].sum(), h[rows].sum())
        best = (1e-6, 0, 0)
        for f in range(cells.shape[1]) if depth else ():
            for cut in np.unique(cells[rows, f])[:-1]:
                left = rows[cells[rows, f] <= cut]
                a, b = g[left].sum(), h[left].sum()
                gain = a * a / (b + 1) + (total[0] - a) ** 2 / (total[1] - b + 1) - total[0] ** 2 / (total[1] + 1)
                if gain > best[0]:
                    best = (gain, f, int(cut))
        if best[0] <= 1e-6:
            return float(-rate * total[0] / (total[1] + 1))
        _, f, cut = best
        low = cells[rows, f] <= cut
        return (f, cut, grow(rows[low], depth - 1, g, h), grow(rows[~low], depth - 1, g, h))

    for _ in range(rounds if len(cells) else 0):
        p = 1 / (1 + np.exp(-score))
        tree = grow(np.arange(len(cells)), 2, weight * p - positive, weight * p * (1 - p))
        trees.append(tree)
        score += np.array([_value(tree, c) for c in cells])
    return trees


def _value(tree, cell) -> float:
    while isinstance(tree, tuple):
        f, cut, left, right = tree
        tree = left if cell[f] <= cut else right
    return tree


def _case(tree, c: Column, names: list[str]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    f, cut, left, right = tree
    return F.when(c[names[f]] <= cut, _case(left, c, names)).otherwise(_case(right, c, names))


def calibrate(score: np.ndarray, weight: np.ndarray, positive: np.ndarray, precision: float = PRECISION) -> float:
    """The lowest score above which the share of positives reaches ``precision``; infinite if none does."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(positive[order]) / np.maximum(np.cumsum(weight[order]), 1)
    # Cells with one score stand or fall together.
    last = np.append(np.diff(score[order]) != 0, True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero(last & (share >= precision))
    return float(score[order][good[-1]]) - 1e-9 if len(good) else float("inf")


def detected(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """doc_id, base (spans of the base rules) and spans (all spans), by kind and start, of every row."""
    found = stored(candidates(docs), "candidates")
    names = list(FEATURES)
    one = found.select(F.explode("found").alias("c"))
    counted = one.groupBy(*[F.col(f"c.{n}").alias(n) for n in names]).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c.label").cast("int")).alias("yes"))
    rows = sorted(map(tuple, counted.collect()))
    data = np.array(rows, np.int64).reshape(len(rows), len(names) + 2)
    cells, weight, positive = data[:, : len(names)], data[:, -2].astype(float), data[:, -1].astype(float)
    trees = fit(cells, weight, positive)
    least = calibrate(np.array([sum(_value(t, c) for t in trees) for c in cells]), weight, positive, precision)

    def chosen(c: Column) -> Column:
        if not trees or least == float("inf"):
            return c["base"]
        return c["base"] | (sum((_case(t, c, names) for t in trees), F.lit(0.0)) >= F.lit(least))

    def alone(c: Column) -> Column:
        return c["base"] | ~F.exists("found", lambda b: b["base"] & (b["start"] <= c["start"]) & (b["end"] >= c["end"]))

    shown = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    return found.select(
        "doc_id",
        F.transform(F.filter("found", lambda c: c["base"]), shown).alias("base"),
        F.transform(F.filter("found", lambda c: chosen(c) & alone(c)), shown).alias("spans"),
    )


def written(spans_: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def _of_kind(kind: int):
    return lambda s: s["kind"] == kind


def op4_pii_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detected(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.sha2(written("base"), 256).alias("base_sha256"),
        written("spans").alias("spans"),
    )


QUERIES = {"op4_pii_candidates": op4_pii_candidates}
ORACLE: dict[str, str] = {}
