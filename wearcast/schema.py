"""Column names, DDL schemas, bounds and gate limits.

Everything in the FIXED VALUES block must equal the behaviour we reproduce
(names, bounds and thresholds); everything else is our own design.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the recorded pipeline's behaviour)
# ---------------------------------------------------------------------------
# Raw (bracketed) column name -> snake-case name used throughout the library.
RAW_TO_SNAKE = {
    "UDI": "udi",
    "Product ID": "product_id",
    "Type": "type",
    "Air temperature [K]": "air_temperature",
    "Process temperature [K]": "process_temperature",
    "Rotational speed [rpm]": "rotational_speed",
    "Torque [Nm]": "torque",
    "Tool wear [min]": "tool_wear",
    "Machine failure": "target",
}
# The five sensors, in contract order.
SENSORS = ["air_temperature", "process_temperature", "rotational_speed", "torque", "tool_wear"]
# The five derived features, in contract order.
DERIVED = [
    "temp_difference",
    "estimated_power",
    "mechanical_stress",
    "thermal_efficiency",
    "wear_per_operation",
]
# Plausible sensor ranges (inclusive bounds) used by the out-of-range check.
SENSOR_BOUNDS = {
    "air_temperature": (295.0, 305.0),
    "process_temperature": (305.0, 315.0),
    "rotational_speed": (1100.0, 3000.0),
    "torque": (3.0, 80.0),
    "tool_wear": (0.0, 300.0),
}
# Gate limits.
RAW_MIN_ROWS = 5000
RAW_FAILURE_RATE = (0.01, 0.1)
FEATURE_MIN_COUNT = 5
FEATURE_FAILURE_RATE = (0.01, 0.2)
TRAINING_MIN_ROWS = 1000
INFERENCE_MAX_MISSING_PER_ROW = 0.5
IQR_FACTOR = 1.5
HIGH_CORRELATION = 0.9
LOW_VARIANCE = 0.01
LOW_CONFIDENCE = 0.7
LOW_CONFIDENCE_SHARE = 0.1
MIN_AVERAGE_CONFIDENCE = 0.8
PRODUCTION_MIN_F1 = 0.85
PRODUCTION_MAX_GAP = 0.05
OVERFIT_GAP = 0.05
SPLIT_SEED = 2024
SPLIT_TEST_SIZE = 0.2
CV_FOLDS = 3
BATCH_SEED = 42
BATCH_SIZE = 50
RUN_WINDOW_MINUTES = 10
RUN_LIMIT = 50
# Serving-path fixed scaler: feature -> (mean, scale).  Consistent only with
# the serving feature variant (features_serving).
SERVING_SCALER = {
    "air_temperature": (299.969, 2.003),
    "process_temperature": (310.005, 1.484),
    "rotational_speed": (1538.777, 179.284),
    "torque": (39.986, 9.968),
    "tool_wear": (107.951, 63.654),
    "temp_difference": (10.035, 2.009),
    "estimated_power": (6434.5, 2928.6),
    "mechanical_stress": (0.026, 0.009),
    "thermal_efficiency": (1.033, 0.007),
    "wear_per_operation": (0.070, 0.040),
}
SERVING_EPSILON = 1e-6
# ---------------------------------------------------------------------------

FEATURES = SENSORS + DERIVED
TARGET = "target"

# Explicit DDL for the raw CSV (no inferSchema pass).  Sensors are DOUBLE on
# purpose: an INT column silently turns '112 ' into NULL.
RAW_CSV_DDL = (
    "`UDI` BIGINT, `Product ID` STRING, `Type` STRING, "
    "`Air temperature [K]` DOUBLE, `Process temperature [K]` DOUBLE, "
    "`Rotational speed [rpm]` DOUBLE, `Torque [Nm]` DOUBLE, `Tool wear [min]` DOUBLE, "
    "`Machine failure` INT"
)
NEW_READINGS_DDL = ", ".join(f"{c} DOUBLE" for c in SENSORS)
READINGS_DDL = (
    "reading_id STRING, type STRING, "
    + ", ".join(f"{c} DOUBLE" for c in SENSORS)
    + ", target INT"
)
