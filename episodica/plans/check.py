"""Inspect or validate every store below a root, in one job for all of the same columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from episodica.functions import fixed as K
from episodica.operators import store_checks as V
from episodica.operators.ordering import materialised
from episodica.sources.reports import write_store_report
from episodica.sources.store import list_stores, read_episode_table, read_store, records
from episodica.sources.versions import Record


class InvalidStore(RuntimeError):
    """Raised after the report is written if a store has errors."""


def check_stores(
    spark: SparkSession,
    root: str,
    mode: str = "validate",
    report: str | None = None,
    strict_done: bool = True,
    fail_on_error: bool = True,
    pixel_bytes: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(one row per store, details): verdicts and messages, or totals and column shapes.

    Stores of the same columns are checked together, and each is judged by the columns that it has. The bytes of
    every frame are compared with its shape when they are written; ``pixel_bytes`` does so again, which reads all
    pixels. If it is None, that is done only where the write found a wrong frame or where there is no record of it.
    """
    if mode not in K.STORE_MODES:
        raise ValueError(f"Unknown mode {mode!r}; use one of {K.STORE_MODES}.")
    found = records(spark, root)
    if not found:
        raise FileNotFoundError(f"No store below {root}.")
    alike: dict[tuple, list[Record]] = {}
    for r in found:
        kinds = tuple(None if c is None else c.json() for c in (r.columns, r.index_columns))
        alike.setdefault((*kinds, bool(r.n_torn is None or r.n_torn)), []).append(r)
    totals, listed = [], []
    for (*_, torn), of_kind in alike.items():
        names = [r.store for r in of_kind]
        rows, table = read_store(spark, root, names), read_episode_table(spark, root, names)
        if mode == "inspect":
            totals.append(V.inspect(rows, table))
            listed.append(V.inspect_columns(rows, table))
        else:
            listed.append(V.validate(rows, table, strict_done, pixel_bytes=torn if pixel_bytes is None else pixel_bytes))
    details = reduce(DataFrame.unionByName, listed)
    if mode == "inspect":
        per_store = reduce(DataFrame.unionByName, totals)
    else:
        details, _ = materialised(details)
        per_store = V.verdicts(list_stores(spark, root), details)
    if report is not None:
        write_store_report(per_store, details, report, mode, root)
    if mode == "validate" and fail_on_error and V.any_error(per_store).first().any_error:
        raise InvalidStore(f"Stores below {root} have errors.")
    return per_store, details
