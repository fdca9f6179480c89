"""Exact and approximate quantiles for many columns in one plan.

Exact (default) = linear interpolation between order statistics, the same
definition as pandas ``quantile``, Spark ``percentile`` and DuckDB
``quantile_cont``.  One path at every size, by counting; no value is sorted
or moved.  The columns are kept (in memory, then on disk) for the passes, so
that the input's plan runs once:

1. one pass counts the cells and takes ``percentile_approx`` sketches (a
   proven rank error) a little below and above each wanted rank: a bracket;
2. one pass counts exactly what lies below each bracket, on its two ends and
   between them.  A rank on an end is found; ties, however many, end here;
3. of a bracket that still has more than ``FEW`` cells between its ends, a
   sketch of those cells gives a bracket some thousand times smaller, and step
   2 follows again; a rank that its bracket misses goes on in what is left on
   that side.  The other brackets' few values are counted and picked from.

``method="approx"`` uses ``percentile_approx`` alone (one pass, bounded memory).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Cells of a bracket whose distinct values are read by the driver.
FEW = 10_000
#: Least accuracy of a sketch inside a bracket.
INNER = 1000


def _cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles c0, c1, ..., NaN as NULL."""
    return df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}")
                       for i, c in enumerate(cols)])


def _count(cells: DataFrame, brackets: dict[int, tuple[int, float, float]]) -> dict[int, list[int]]:
    """Cells below, on the low end, between and on the high end of each bracket (column, low, high)."""
    aggs = []
    for t, (c, low, high) in brackets.items():
        x, a, b = F.col(f"c{c}"), F.lit(low), F.lit(high)
        parts = [x < a, x == a, (x > a) & (x < b), (x == b) & F.lit(low != high)]
        aggs += [F.count_if(p).alias(f"k{t}_{i}") for i, p in enumerate(parts)]
    row = cells.agg(*aggs).first()
    return {t: [row[f"k{t}_{i}"] for i in range(4)] for t in brackets}


def _between(cells: DataFrame, brackets: dict[int, tuple[int, float, float]]) -> dict[int, list[tuple[float, int]]]:
    """The sorted distinct values between each bracket's ends, with their counts."""
    inner = {t: (F.col(f"c{c}") > low) & (F.col(f"c{c}") < high) for t, (c, low, high) in brackets.items()}
    found = F.explode(F.filter(F.array(*[
        F.struct(F.lit(t).alias("t"), F.when(inner[t], F.col(f"c{c}")).alias("value")) for t, (c, _, _) in brackets.items()]),
        lambda x: x["value"].isNotNull()))
    cells = cells.where(reduce(lambda a, b: a | b, inner.values()))  # most rows end here
    out: dict[int, list[tuple[float, int]]] = {t: [] for t in brackets}
    for r in cells.select(found.alias("x")).select("x.*").groupBy("t", "value").agg(F.count("*").alias("n")).collect():
        out[r["t"]].append((r["value"], r["n"]))
    return {t: sorted(v) for t, v in out.items()}


def _ranked(cells: DataFrame, wanted: dict[int, tuple[int, int]], brackets: dict[int, tuple[int, float, float]],
            ends: dict[int, tuple[float, float]], accuracy: int) -> dict[int, float]:
    """The value of rank r in column c, for each wanted (c, r); ends holds each column's least and largest value."""
    out: dict[int, float] = {}
    while brackets:
        refine: dict[int, tuple[float, float, float, float]] = {}
        few: dict[int, tuple[int, float, float]] = {}
        start: dict[int, int] = {}
        counts = _count(cells, brackets)
        missed = {}
        for t, (c, low, high) in brackets.items():
            below, at_low, inner, at_high = counts[t]
            r = wanted[t][1]
            if r < below:
                missed[t] = (c, ends[c][0], low)
            elif r >= below + at_low + inner + at_high:
                missed[t] = (c, high, ends[c][1])
            elif r < below + at_low:
                out[t] = low
            elif r >= below + at_low + inner:
                out[t] = high
            elif inner <= FEW:
                few[t], start[t] = (c, low, high), below + at_low
            else:
                share, slack = (r - below - at_low) / inner, 2.0 / max(accuracy, INNER)
                refine[t] = (low, high, max(0.0, share - slack), min(1.0, share + slack))
        for t, values in (_between(cells, few) if few else {}).items():
            at = start[t]
            for v, n in values:
                at += n
                if wanted[t][1] < at:
                    out[t] = v
                    break
        if refine:
            row = cells.agg(*[F.percentile_approx(
                F.when((F.col(f"c{wanted[t][0]}") > low) & (F.col(f"c{wanted[t][0]}") < high), F.col(f"c{wanted[t][0]}")),
                [p, q], max(accuracy, INNER)).alias(f"r{t}") for t, (low, high, p, q) in refine.items()]).first()
            missed |= {t: (wanted[t][0], *row[f"r{t}"]) for t in refine}
        brackets = missed
    return out


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    method: str = "exact",
    accuracy: int = 10000,
) -> DataFrame:
    """Long result: (feature, prob, quantile), one row for every column and
    probability; a column without values has NULL quantiles.  The driver sees
    counts, brackets and results: |cols|·|probs| numbers."""
    cols, probs = list(cols), [float(p) for p in probs]
    if method not in ("exact", "approx"):
        raise ValueError("method must be 'exact' or 'approx'")
    cells = _cells(df, cols)
    if method == "approx":
        return _found(df, cells, cols, probs, method, accuracy)
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _found(df, cells, cols, probs, method, accuracy)
    finally:
        cells.unpersist()


def _found(df: DataFrame, cells: DataFrame, cols: list[str], probs: list[float], method: str, accuracy: int) -> DataFrame:
    """The result of ``quantiles`` from its cells."""
    slack = 2.0 / accuracy
    asked = probs if method == "approx" else [min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)]
    first = cells.agg(*[x for i in range(len(cols)) for x in (
        F.count(f"c{i}").alias(f"n{i}"), F.min(f"c{i}").alias(f"lo{i}"), F.max(f"c{i}").alias(f"hi{i}"),
        F.percentile_approx(f"c{i}", asked, accuracy).alias(f"q{i}"))]).first()
    result: dict[tuple[int, int], float | None] = {(i, j): None for i in range(len(cols)) for j in range(len(probs))}
    if method == "approx":
        result |= {(i, j): first[f"q{i}"][j] for i, j in result if first[f"n{i}"]}
    else:
        # order statistics floor(h) and floor(h) + 1 (capped), h = p·(N − 1)
        ranks, wanted, brackets = {}, {}, {}
        for i, j in result:
            if n := first[f"n{i}"]:
                low = int(probs[j] * (n - 1))
                ranks[i, j] = (low, min(low + 1, n - 1), probs[j] * (n - 1) - low)
                for k, r in enumerate(dict.fromkeys(ranks[i, j][:2])):
                    t = 2 * (i * len(probs) + j) + k
                    wanted[t], brackets[t] = (i, r), (i, *first[f"q{i}"][2 * j : 2 * j + 2])
        ends = {i: (first[f"lo{i}"], first[f"hi{i}"]) for i in range(len(cols))}
        got = _ranked(cells, wanted, brackets, ends, accuracy)
        for (i, j), (low, high, part) in ranks.items():
            t = 2 * (i * len(probs) + j)
            a, b = got[t], got[t + 1] if high != low else got[t]
            result[i, j] = a if a == b else a + (b - a) * part
    rows = [(cols[i], probs[j], v) for (i, j), v in result.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, prob double, quantile double")


def quantile_row(df: DataFrame, cols: Sequence[str], prob: float, method: str = "exact",
                 prefix: str = "") -> DataFrame:
    """One row, one column per feature (e.g. medians for imputation)."""
    long = quantiles(df, cols, [prob], method)
    return long.groupBy().pivot("feature", list(cols)).agg(F.first("quantile")).select(
        *[F.col(c).alias(f"{prefix}{c}") for c in cols]
    )
