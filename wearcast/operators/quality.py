"""Data-quality profiles and gates (Q1-Q20).

Design rule: every statistic over the data is one ``agg`` with all
expressions (one pass, partial aggregation per task), then the single
result row is unpivoted.  The data itself is never unpivoted; exact quantiles
only emit the values inside a narrow bracket.

Gates return a check table ``(check, value, lower, upper, severity, passed)``;
:func:`enforce` raises on failed ``error`` rows only when asked.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import missing_columns
from .quantiles import quantiles


class GateError(ValueError):
    pass


def _struct_rows(row_df: DataFrame, items: list[tuple[dict[str, Column]]]) -> DataFrame:
    """Explode a list of structs built from a one-row frame into rows."""
    structs = [F.struct(*[v.alias(k) for k, v in it.items()]) for it in items]
    return row_df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


# --------------------------------------------------------------------- Q1 ---
def null_counts(df: DataFrame, only_positive: bool = True, with_total: bool = True) -> DataFrame:
    """(column_name, null_count) per column with NULLs, plus a ``*`` total row."""
    cols = df.columns
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    items = [{"column_name": F.lit(c), "null_count": F.col(f"n{i}")} for i, c in enumerate(cols)]
    if with_total:
        total = sum((F.col(f"n{i}") for i in range(len(cols))), F.lit(0).cast("long"))
        items.append({"column_name": F.lit("*"), "null_count": total})
    out = _struct_rows(row, items)
    if only_positive:
        out = out.where(F.col("null_count") > 0)
    return out


def total_missing(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Aggregate expression: NULL cells over ``cols``."""
    cols = list(cols or df.columns)
    return sum((F.count_if(F.col(f"`{c}`").isNull()) for c in cols), F.lit(0).cast("long"))


# --------------------------------------------------------------- Q2, Q3 ---
def duplicate_count(df: DataFrame) -> DataFrame:
    """All-column duplicates beyond the first (NULL equals NULL).  One
    aggregation on all columns: duplicates collapse map-side, so a hot
    duplicate group is one row per task before the shuffle."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
    )


def deduplicate(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


# ------------------------------------------------------------ Q4, Q7 ---
def column_profile(df: DataFrame, cols: Sequence[str], stats: Sequence[str] = ("min", "max", "mean")) -> DataFrame:
    """(feature, <stat>...) for each column, one pass."""
    fns = {
        "min": F.min,
        "max": F.max,
        "mean": F.avg,
        "std": F.stddev_samp,
        "std_pop": F.stddev_pop,
        "variance": F.var_samp,
        "count": F.count,
    }
    row = df.agg(*[fns[s](F.col(c)).alias(f"{s}__{i}") for i, c in enumerate(cols) for s in stats])
    items = [{"feature": F.lit(c), **{s: F.col(f"{s}__{i}") for s in stats}} for i, c in enumerate(cols)]
    return _struct_rows(row, items)


def sensor_profile(df: DataFrame, cols: Sequence[str] = S.SENSORS) -> DataFrame:
    return column_profile(df, cols, ("min", "max", "mean"))


def sensor_ranges(df: DataFrame, cols: Sequence[str] = S.SENSORS) -> DataFrame:
    return column_profile(df, cols, ("min", "max"))


# ----------------------------------------------------------- Q5, Q6 ---
def target_distribution(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("count"))


def failure_rate(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.agg(F.avg(F.col(target).cast("double")).alias("failure_rate"))


# ---------------------------------------------------------------- gates ---
def _checks(row: DataFrame, specs: list[tuple[str, Column, float | None, float | None, str]]) -> DataFrame:
    items = []
    for name, value, lo, hi, sev in specs:
        v = value.cast("double")
        ok = F.lit(True)
        if lo is not None:
            ok = ok & (v >= F.lit(float(lo)))
        if hi is not None:
            ok = ok & (v <= F.lit(float(hi)))
        items.append(
            {
                "check": F.lit(name),
                "value": v,
                "lower": F.lit(lo).cast("double"),
                "upper": F.lit(hi).cast("double"),
                "severity": F.lit(sev),
                "passed": F.coalesce(ok, F.lit(False)),
            }
        )
    return _struct_rows(row, items)


def enforce(checks: DataFrame) -> DataFrame:
    """Raise :class:`GateError` if any ``error`` check failed (one small job)."""
    failed = checks.where((F.col("severity") == "error") & ~F.col("passed")).collect()
    if failed:
        raise GateError("; ".join(f"{r['check']}={r['value']}" for r in failed))
    return checks


def raw_quality_gate(
    df: DataFrame,
    required: Sequence[str] = (*S.SENSORS, S.TARGET),
    min_rows: int = S.RAW_MIN_ROWS,
    rate: tuple[float, float] = S.RAW_FAILURE_RATE,
) -> DataFrame:
    """Q8: required columns (error), rows (error), failure rate (warn),
    missing cells over the required columns (warn), duplicates (info),
    sensor ranges (info).  One pass plus the duplicate aggregation."""
    miss = missing_columns(df, required)
    if miss:
        row = df.sparkSession.range(1)
        return _checks(row, [("required_columns_missing", F.lit(len(miss)), None, 0, "error")])
    present = [c for c in required]
    stats = df.agg(
        F.count("*").alias("rows"),
        F.avg(F.col(S.TARGET).cast("double")).alias("rate"),
        total_missing(df, present).alias("missing"),
        *[F.min(c).alias(f"min_{c}") for c in S.SENSORS if c in df.columns],
        *[F.max(c).alias(f"max_{c}") for c in S.SENSORS if c in df.columns],
    )
    dups = duplicate_count(df).select("duplicates")
    row = stats.crossJoin(dups)
    specs = [
        ("required_columns_missing", F.lit(0), None, 0, "error"),
        ("total_samples", F.col("rows"), min_rows, None, "error"),
        ("failure_rate", F.col("rate"), rate[0], rate[1], "warn"),
        ("missing_values", F.col("missing"), None, 0, "warn"),
        ("duplicates", F.col("duplicates"), None, None, "info"),
    ]
    for c in S.SENSORS:
        if c in df.columns:
            specs.append((f"{c}_min", F.col(f"min_{c}"), None, None, "info"))
            specs.append((f"{c}_max", F.col(f"max_{c}"), None, None, "info"))
    return _checks(row, specs)


# ------------------------------------------------------------- Q9, Q10 ---
def feature_profile(df: DataFrame, target: str = S.TARGET, n_stat_features: int | None = None) -> DataFrame:
    """Q9 as long rows (metric, key, value): shape, NaN/NULL cells, inf
    cells, classes, failure rate, target distribution, and mean/std(n−1)/
    min/max of every feature column (or the first ``n_stat_features``)."""
    feats = [c for c in df.columns if c != target]
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    nan_cells = sum(
        (F.count_if(F.col(c).isNull() | (F.isnan(c) if c in dbl else F.lit(False))) for c in feats),
        F.lit(0).cast("long"),
    )
    inf_cells = sum(
        (F.count_if(F.abs(F.col(c)) == float("inf")) for c in feats if c in dbl), F.lit(0).cast("long")
    )
    first = feats[:n_stat_features]
    stats = df.agg(
        F.count("*").alias("rows"),
        nan_cells.alias("nan_cells"),
        inf_cells.alias("inf_cells"),
        F.avg(F.col(target).cast("double")).alias("rate"),
        *[f(c).alias(f"{n}__{i}") for i, c in enumerate(first)
          for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))],
    )
    items = [
        {"metric": F.lit("rows"), "key": F.lit(None).cast("string"), "value": F.col("rows").cast("double")},
        {"metric": F.lit("columns"), "key": F.lit(None).cast("string"), "value": F.lit(float(len(df.columns)))},
        {"metric": F.lit("feature_count"), "key": F.lit(None).cast("string"), "value": F.lit(float(len(feats)))},
        {"metric": F.lit("nan_cells"), "key": F.lit(None).cast("string"), "value": F.col("nan_cells").cast("double")},
        {"metric": F.lit("inf_cells"), "key": F.lit(None).cast("string"), "value": F.col("inf_cells").cast("double")},
        {"metric": F.lit("failure_rate"), "key": F.lit(None).cast("string"), "value": F.col("rate")},
    ]
    for i, c in enumerate(first):
        for n in ("mean", "std", "min", "max"):
            items.append({"metric": F.lit(n), "key": F.lit(c), "value": F.col(f"{n}__{i}").cast("double")})
    main = _struct_rows(stats, items)
    dist = target_distribution(df, target)
    classes = dist.agg(F.count("*").cast("double").alias("value")).select(
        F.lit("unique_classes").alias("metric"), F.lit(None).cast("string").alias("key"), "value"
    )
    per_class = dist.select(
        F.lit("target_count").alias("metric"),
        F.col(target).cast("string").alias("key"),
        F.col("count").cast("double").alias("value"),
    )
    return main.unionByName(classes).unionByName(per_class)


def feature_gate(
    df: DataFrame,
    target: str = S.TARGET,
    expected: Sequence[str] = S.SENSORS,
    min_features: int = S.FEATURE_MIN_COUNT,
    rate: tuple[float, float] = S.FEATURE_FAILURE_RATE,
) -> DataFrame:
    """Q10 from Q9's numbers."""
    if target not in df.columns:
        return _checks(df.sparkSession.range(1), [("target_missing", F.lit(1), None, 0, "error")])
    prof = feature_profile(df, target)
    wide = prof.groupBy().pivot(
        "metric", ["feature_count", "unique_classes", "failure_rate", "nan_cells", "inf_cells"]
    ).agg(F.first("value"))
    n_missing = len(missing_columns(df, expected))
    return _checks(
        wide,
        [
            ("target_missing", F.lit(0), None, 0, "error"),
            ("feature_count", F.col("feature_count"), min_features, None, "error"),
            ("unique_classes", F.coalesce(F.col("unique_classes"), F.lit(0.0)), 2, 2, "error"),
            ("failure_rate", F.col("failure_rate"), rate[0], rate[1], "warn"),
            ("nan_cells", F.col("nan_cells"), None, 0, "warn"),
            ("inf_cells", F.col("inf_cells"), None, 0, "warn"),
            ("expected_features_missing", F.lit(n_missing), None, 0, "warn"),
        ],
    )


# -------------------------------------------------------------- Q11, Q12 ---
def training_gate(df: DataFrame, min_rows: int = S.TRAINING_MIN_ROWS, target: str = S.TARGET) -> DataFrame:
    has_target = target in df.columns
    row = df.agg(F.count("*").alias("rows"), total_missing(df).alias("missing"))
    return _checks(
        row,
        [
            ("total_samples", F.col("rows"), min_rows, None, "error"),
            ("target_missing", F.lit(0 if has_target else 1), None, 0, "error"),
            ("missing_values", F.col("missing"), None, None, "info"),
        ],
    )


def inference_gate(df: DataFrame, max_missing_per_row: float = S.INFERENCE_MAX_MISSING_PER_ROW) -> DataFrame:
    """Q12.  The limit compares missing *cells* with *rows*; kept, named."""
    row = df.agg(F.count("*").alias("rows"), total_missing(df).alias("missing"))
    per_row = F.when(F.col("rows") > 0, F.col("missing") / F.col("rows")).otherwise(F.lit(0.0))
    return _checks(
        row,
        [
            ("total_samples", F.col("rows"), 1, None, "error"),
            ("missing_cells_per_row", per_row, None, max_missing_per_row, "error"),
            ("missing_values", F.col("missing"), None, None, "info"),
        ],
    )


# ------------------------------------------------------------------ Q13 ---
def out_of_range(df: DataFrame, bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Count per sensor outside the inclusive bounds; NULL not counted."""
    bounds = bounds or S.SENSOR_BOUNDS
    names = [c for c in bounds if c in df.columns]
    row = df.agg(
        *[F.count_if((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1])).alias(f"o{i}")
          for i, c in enumerate(names)]
    )
    items = [
        {"feature": F.lit(c), "lower": F.lit(float(bounds[c][0])), "upper": F.lit(float(bounds[c][1])),
         "out_of_range": F.col(f"o{i}")}
        for i, c in enumerate(names)
    ]
    return _struct_rows(row, items)


# ------------------------------------------------------------------ Q14 ---
def impute_median(df: DataFrame, cols: Sequence[str] = S.SENSORS, method: str = "exact",
                  medians: dict[str, float] | None = None) -> DataFrame:
    """Replace NULLs by the column median of this batch (or given medians,
    e.g. stored training medians for a stream).  The medians are a handful
    of numbers: they become literals in one projection."""
    cols = [c for c in cols if c in df.columns]
    if medians is None:
        q = quantiles(df, cols, [0.5], method)  # materialised, ≤ len(cols) rows
        medians = {r["feature"]: r["quantile"] for r in q.collect()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians.get(c)).cast("double")) for c in cols})


# ------------------------------------------------------------------ Q15 ---
def iqr_outliers(df: DataFrame, cols: Sequence[str], factor: float = S.IQR_FACTOR,
                 method: str = "exact") -> DataFrame:
    """Per feature: q1, q3, iqr, bounds, outliers (strictly outside) and
    their share of all rows in percent."""
    q = quantiles(df, cols, [0.25, 0.75], method)
    qs = q.groupBy("feature").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
    )
    b = qs.select(
        "feature", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        (F.col("q1") - factor * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
        (F.col("q3") + factor * (F.col("q3") - F.col("q1"))).alias("upper_bound"),
    )
    # 2 numbers per feature from the materialised quartiles: literals in a
    # single counting pass over the data
    got = {r["feature"]: (r["lower_bound"], r["upper_bound"]) for r in b.collect()}
    bounds = {c: got.get(c, (None, None)) for c in cols}  # all-NULL column: no bounds
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if((F.col(c) < F.lit(bounds[c][0]).cast("double"))
                     | (F.col(c) > F.lit(bounds[c][1]).cast("double"))).alias(f"_o{i}")
          for i, c in enumerate(cols)],
    )
    items = [{"feature": F.lit(c), "n_outliers": F.col(f"_o{i}"),
              "outlier_pct": F.col(f"_o{i}") * 100.0 / F.col("_rows")} for i, c in enumerate(cols)]
    return b.join(_struct_rows(counts, items), "feature")


# ------------------------------------------------------------ Q16-Q18 ---
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson, pairwise-complete, full matrix as (feature_a, feature_b, corr).

    Two passes without moving rows: the column means, then one task-local sum
    of centred products per Arrow batch (a masked Gram matrix: counts, sums
    and products of every pair, n² numbers a task).  NULL and NaN cells drop
    out of their pairs; an infinite cell or a constant column gives NULL."""
    cols = list(cols)
    n = len(cols)
    clean = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}")
                        for i, c in enumerate(cols)])
    finite = [F.when(F.abs(F.col(f"c{i}")) != float("inf"), F.col(f"c{i}")) for i in range(n)]
    means = [m if m is not None else 0.0 for m in clean.agg(*[F.avg(c) for c in finite]).first()]

    def gram(batches):
        total = np.zeros((5, n, n))
        for b in batches:
            x = np.column_stack([np.asarray(b.column(i).fill_null(np.nan)) for i in range(n)]) - means
            has = ~np.isnan(x)
            bad = np.isinf(x).astype(float)
            x = np.where(has & ~np.isinf(x), x, 0.0)
            m = has.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x, bad.T @ m + m.T @ bad])
        at = np.indices((n, n)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*at.astype(np.int32), *total.reshape(5, -1))],
                                         ["i", "j", "cnt", "sx", "sxx", "sxy", "bad"])

    sums = clean.mapInArrow(gram, "i int, j int, cnt double, sx double, sxx double, sxy double, bad double").groupBy(
        "i", "j").agg(*[F.sum(c).alias(c) for c in ("cnt", "sx", "sxx", "sxy", "bad")])
    other = sums.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))

    def spread(squares: Column, total: Column) -> Column:
        """Sum of squared deviations; what rounding leaves of a constant counts as 0."""
        left = squares - total * total / F.col("cnt")
        return F.when(left > 1e-10 * squares, left).otherwise(F.lit(0.0))

    var = F.sqrt(spread(F.col("sxx"), F.col("sx")) * spread(F.col("syy"), F.col("sy")))
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("cnt")
    corr = F.when((F.col("cnt") > 0) & (F.col("bad") == 0), F.nanvl(F.try_divide(cov, var), F.lit(None).cast("double")))
    names = F.array(*[F.lit(c) for c in cols])
    # both sides are n² rows
    return sums.join(other, ["i", "j"]).select(
        F.get(names, "i").alias("feature_a"), F.get(names, "j").alias("feature_b"),
        corr.alias("corr"), F.col("i").alias("pos_a"), F.col("j").alias("pos_b"))


def high_correlation(df: DataFrame, cols: Sequence[str], threshold: float = S.HIGH_CORRELATION) -> DataFrame:
    m = correlation_matrix(df, cols)
    return m.where((F.col("pos_a") < F.col("pos_b")) & (F.abs("corr") > threshold)).select(
        "feature_a", "feature_b", "corr"
    )


def low_variance(df: DataFrame, cols: Sequence[str], threshold: float = S.LOW_VARIANCE) -> DataFrame:
    prof = column_profile(df, cols, ("variance",))
    return prof.where(F.col("variance") < threshold)


# ------------------------------------------------------------------ Q19 ---
def dataset_summary(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """(metric, key, value): rows, columns, NULLs per column, failure rate,
    target distribution."""
    cols = df.columns
    has_t = target in cols
    row = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
        *([F.avg(F.col(target).cast("double")).alias("rate")] if has_t else []),
    )
    nul = F.lit(None).cast("string")
    items = [
        {"metric": F.lit("total_samples"), "key": nul, "value": F.col("rows").cast("double")},
        {"metric": F.lit("columns"), "key": nul, "value": F.lit(float(len(cols)))},
    ]
    items += [{"metric": F.lit("missing_values"), "key": F.lit(c), "value": F.col(f"n{i}").cast("double")}
              for i, c in enumerate(cols)]
    if has_t:
        items.append({"metric": F.lit("failure_rate"), "key": nul, "value": F.col("rate")})
    out = _struct_rows(row, items)
    if has_t:
        dist = target_distribution(df, target).select(
            F.lit("target_count").alias("metric"), F.col(target).cast("string").alias("key"),
            F.col("count").cast("double").alias("value"))
        out = out.unionByName(dist)
    return out


# ------------------------------------------------------------------ Q20 ---
def processing_report(original: DataFrame, processed: DataFrame, cols: Sequence[str],
                      outliers: DataFrame | None = None) -> DataFrame:
    """(metric, key, value): input rows, processed rows, feature count,
    missing cells in the input, per processed feature mean/std(n−1)/min/max,
    and the outlier count (from ``iqr_outliers`` when given)."""
    nul = F.lit(None).cast("string")
    o = original.agg(F.count("*").alias("rows"), total_missing(original).alias("missing"))
    p = processed.agg(
        F.count("*").alias("prows"),
        *[f(c).alias(f"{n}__{i}") for i, c in enumerate(cols)
          for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))],
    )
    row = o.crossJoin(p)
    items = [
        {"metric": F.lit("original_samples"), "key": nul, "value": F.col("rows").cast("double")},
        {"metric": F.lit("processed_samples"), "key": nul, "value": F.col("prows").cast("double")},
        {"metric": F.lit("features_count"), "key": nul, "value": F.lit(float(len(cols)))},
        {"metric": F.lit("missing_values"), "key": nul, "value": F.col("missing").cast("double")},
    ]
    for i, c in enumerate(cols):
        for n in ("mean", "std", "min", "max"):
            items.append({"metric": F.lit(n), "key": F.lit(c), "value": F.col(f"{n}__{i}").cast("double")})
    out = _struct_rows(row, items)
    if outliers is not None:
        out = out.unionByName(outliers.agg(F.sum("n_outliers").cast("double").alias("value")).select(
            F.lit("outliers_detected").alias("metric"), nul.alias("key"), "value"))
    return out
