"""Column-level helpers: IEEE division under ANSI mode, NaN discipline,
renames, projections, schema checks and metadata columns (P2-P7).

All of these are narrow projections: no job, no shuffle, fused into the
scan's whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .. import schema as S


class MissingColumnsError(ValueError):
    """Raised when a hard gate finds required columns absent."""

    def __init__(self, missing: Iterable[str]):
        self.missing = sorted(missing)
        super().__init__(f"missing required columns: {self.missing}")


def ieee_divide(num: Column, den: Column) -> Column:
    """``num / den`` with IEEE-754 results for a zero divisor (±inf, NaN).

    Spark 4 runs ANSI by default, where ``x / 0.0`` raises; pandas/numpy and
    DuckDB give inf/NaN.  ``inf * signum(num)`` yields +inf, -inf or NaN.
    """
    return F.when(den == 0, F.lit(float("inf")) * F.signum(num)).otherwise(num / den)


def nan_to_null(c: Column) -> Column:
    """NaN → NULL, so Spark aggregates skip it like pandas does."""
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def nans_to_nulls(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or df.columns) if c in _double_cols(df)]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in cols}) if cols else df


def _double_cols(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}


def normalize_columns(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Bracketed → snake-case names (P4); absent names are ignored."""
    mapping = dict(mapping or S.RAW_TO_SNAKE)
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def to_bracketed(df: DataFrame) -> DataFrame:
    """Snake-case → bracketed names (the reverse mapping)."""
    return normalize_columns(df, {v: k for k, v in S.RAW_TO_SNAKE.items()})


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop id/target/metadata columns when they exist."""
    return df.drop(*names)


def select_sensors(df: DataFrame, with_target: bool = True) -> DataFrame:
    """Project the five sensors (+ target when present)."""
    cols = list(S.SENSORS)
    if with_target and S.TARGET in df.columns:
        cols.append(S.TARGET)
    return df.select(*cols)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Iterable[str], hard: bool = True) -> list[str]:
    """Schema-only check (P5): no Spark job runs.

    ``hard=True`` raises :class:`MissingColumnsError` (gate semantics);
    otherwise the missing names are returned for a warning row.
    """
    missing = missing_columns(df, required)
    if missing and hard:
        raise MissingColumnsError(missing)
    return missing


def numeric_columns(df: DataFrame, integral_and_double_only: bool = False) -> list[str]:
    """Numeric column names from the schema.

    ``integral_and_double_only`` mirrors the scaling path (64-bit float/int);
    the default keeps every numeric type (scoring path).
    """
    out = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, NumericType):
            continue
        if integral_and_double_only and f.dataType.typeName() not in ("double", "long"):
            continue
        out.append(f.name)
    return out


def select_numeric(df: DataFrame, integral_and_double_only: bool = False) -> DataFrame:
    return df.select(*numeric_columns(df, integral_and_double_only))


def add_metadata(
    df: DataFrame,
    model_version: str,
    model_stage: str,
    with_timestamp: bool = True,
) -> DataFrame:
    """Constant model columns + inference timestamp."""
    cols: dict[str, Column] = {
        "model_version": F.lit(model_version),
        "model_stage": F.lit(model_stage),
    }
    if with_timestamp:
        cols["inference_timestamp"] = F.current_timestamp()
    return df.withColumns(cols)
