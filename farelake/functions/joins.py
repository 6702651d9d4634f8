"""Size-checked broadcast joins.

A join side is broadcast only after Spark has counted it under a bound. The
count reads at most ``max_rows + 1`` rows (a limit), so checking a table that
turns out to be large stops early. Above the bound no hint is given and the
planner picks a shuffle join (AQE may still broadcast it from runtime sizes).

The answer is remembered per DataFrame object: warehouse tables are written
once to fresh folders and never change, so a dimension joined by several
reports is counted once.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimensions and lookups up to this many rows are broadcast.
BROADCAST_MAX_ROWS = 1_000_000

_FITS: "weakref.WeakKeyDictionary[DataFrame, dict[int, bool]]" = weakref.WeakKeyDictionary()


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows."""
    seen = _FITS.setdefault(df, {})
    if max_rows not in seen:
        seen[max_rows] = df.limit(max_rows + 1).count() <= max_rows
    return seen[max_rows]


def fits_all(dfs: list[DataFrame], max_rows: int = BROADCAST_MAX_ROWS) -> None:
    """Check several tables in one job (a union of the limited counts) and
    remember each answer, so later ``fits``/``bounded`` calls run no job."""
    todo = [d for d in dfs if max_rows not in _FITS.get(d, {})]
    if not todo:
        return
    union = None
    for i, d in enumerate(todo):
        part = d.limit(max_rows + 1).select(F.lit(i).alias("_i"))
        union = part if union is None else union.unionByName(part)
    counts = {r["_i"]: r["n"] for r in union.groupBy("_i").agg(F.count(F.lit(1)).alias("n")).collect()}
    for i, d in enumerate(todo):
        _FITS.setdefault(d, {})[max_rows] = counts.get(i, 0) <= max_rows


def bounded(side: DataFrame, source: DataFrame | None = None,
            max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``side`` with a broadcast hint when ``source`` (default ``side``) is
    within ``max_rows``. Pass the stored table as ``source`` when ``side`` is
    a projection or filter of it, so the count is remembered for the table."""
    return F.broadcast(side) if fits(source if source is not None else side, max_rows) else side
