"""Scalers (T1-T4) as one-row statistics + column expressions.

The fitted scaler is a one-row frame (2 columns per feature), broadcast to
every task, or literals (``scaler_literals``) for streaming/saved pipelines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .quantiles import quantiles


def scaler_fit(df: DataFrame, cols: Sequence[str] = S.FEATURES) -> DataFrame:
    """Standard scaler: mean and *population* std per feature (std 0 → 1).
    Long form (feature, mean, scale); one aggregation pass."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])
    arr = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"),
                 F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("scale"))
        for i, c in enumerate(cols)
    ])
    return row.select(F.explode(arr).alias("x")).select("x.*")


def _wide(stats: DataFrame, cols: Sequence[str], center: str, scale: str) -> DataFrame:
    return stats.groupBy().pivot("feature", list(cols)).agg(
        F.first(center).alias("c"), F.first(scale).alias("s")
    )


def scaler_transform(df: DataFrame, stats: DataFrame, cols: Sequence[str] = S.FEATURES,
                     center: str = "mean", scale: str = "scale") -> DataFrame:
    """(x − center) / scale by column name; the stats row is broadcast."""
    wide = _wide(stats, cols, center, scale)
    j = df.crossJoin(F.broadcast(wide))
    out = j.withColumns({c: (F.col(c) - F.col(f"{c}_c")) / F.col(f"{c}_s") for c in cols})
    return out.drop(*[f"{c}_c" for c in cols], *[f"{c}_s" for c in cols])


def scaler_literals(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Apply (center, scale) given as literals: no join, streaming-safe."""
    return df.withColumns({c: (F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, (m, s) in params.items()
                           if c in df.columns})


def collect_scaler(stats: DataFrame, center: str = "mean", scale: str = "scale") -> dict[str, tuple[float, float]]:
    """Bring the fitted statistics (one row per feature) to the driver, e.g.
    to freeze them into a saved pipeline."""
    return {r["feature"]: (float(r[center]), float(r[scale])) for r in stats.collect()}


def robust_scaler_fit(df: DataFrame, cols: Sequence[str] = S.FEATURES, method: str = "exact") -> DataFrame:
    """(feature, median, iqr): center = median, scale = q75 − q25 (0 → 1)."""
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method)
    g = q.groupBy("feature").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    return g.select("feature", "median", F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("iqr"))


def robust_scaler_transform(df: DataFrame, stats: DataFrame, cols: Sequence[str] = S.FEATURES) -> DataFrame:
    return scaler_transform(df, stats, cols, center="median", scale="iqr")


def fixed_scaler(df: DataFrame) -> DataFrame:
    """Serving-path scaler with the fixed constants (only consistent with
    ``features_serving``)."""
    return scaler_literals(df, S.SERVING_SCALER)
