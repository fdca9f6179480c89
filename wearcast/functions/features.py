"""Derived physical features (F1-F6) as Column expressions.

One projection adds all five; Catalyst folds the constants and whole-stage
codegen fuses it with the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .columns import ieee_divide


def feature_columns(
    air: Column | str = "air_temperature",
    process: Column | str = "process_temperature",
    rpm: Column | str = "rotational_speed",
    torque: Column | str = "torque",
    wear: Column | str = "tool_wear",
) -> dict[str, Column]:
    """Training-path formulas (F1-F5), keyed by output name.

    ``estimated_power`` keeps the association ``torque * (rpm * 2π / 60)``;
    a different association changes the last bits.
    """
    a, p, r, t, w = (F.col(c) if isinstance(c, str) else c for c in (air, process, rpm, torque, wear))
    return {
        "temp_difference": p - a,
        "estimated_power": t * (r * 2 * F.lit(math.pi) / 60),
        "mechanical_stress": ieee_divide(t, r / 1000),
        "thermal_efficiency": ieee_divide(p, a),
        "wear_per_operation": ieee_divide(w, r * 0.001),
    }


def add_features(df: DataFrame) -> DataFrame:
    """Append F1-F5 to a frame holding the five sensors."""
    return df.withColumns(feature_columns())


def extract_features(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sensors + derived features (+ target if present) in contract order."""
    out = [F.col(c) for c in keep] + [F.col(c) for c in S.SENSORS]
    out += [e.alias(n) for n, e in feature_columns().items()]
    if S.TARGET in df.columns:
        out.append(F.col(S.TARGET))
    return df.select(*out)


def _ieee_sql(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN CAST('Infinity' AS DOUBLE) * signum({num}) ELSE ({num}) / ({den}) END"


# The same five formulas as SQL text, for the features stage of a saved
# model pipeline (tests assert both forms agree bit for bit).
FEATURE_SQL = {
    "temp_difference": "process_temperature - air_temperature",
    "estimated_power": "torque * (rotational_speed * 2 * pi() / 60)",
    "mechanical_stress": _ieee_sql("torque", "rotational_speed / 1000"),
    "thermal_efficiency": _ieee_sql("process_temperature", "air_temperature"),
    "wear_per_operation": _ieee_sql("tool_wear", "rotational_speed * 0.001D"),
}


def serving_feature_columns() -> dict[str, Column]:
    """Serving variant (F6): ``+1e-6`` in the divisors and no /1000 scaling.

    Its ``mechanical_stress`` / ``wear_per_operation`` are 1000x smaller than
    the training path.  Only consistent with the fixed serving scaler; never
    mix with the training formulas.
    """
    a, p, r, t, w = (F.col(c) for c in S.SENSORS)
    eps = F.lit(S.SERVING_EPSILON)
    return {
        "temp_difference": p - a,
        "estimated_power": t * r * 2 * F.lit(math.pi) / 60,
        "mechanical_stress": ieee_divide(t, r + eps),
        "thermal_efficiency": ieee_divide(p, a + eps),
        "wear_per_operation": ieee_divide(w, r + eps),
    }


def extract_serving_features(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    out = [F.col(c) for c in keep] + [F.col(c) for c in S.SENSORS]
    out += [e.alias(n) for n, e in serving_feature_columns().items()]
    return df.select(*out)
