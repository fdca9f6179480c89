"""Checked queries: sources, projections and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..functions.features import extract_features, extract_serving_features
from ..sources import fixtures as X
from ..sources import readings as R
from ..sources import sinks
from .book import register, rounded, with_ctes

# DuckDB: training features of type-L readings.
FEATURES_SQL = """
features AS (
  SELECT reading_id, air_temperature, process_temperature, rotational_speed, torque, tool_wear,
         process_temperature - air_temperature AS temp_difference,
         torque * (rotational_speed * 2 * pi() / 60) AS estimated_power,
         torque / (rotational_speed / 1000) AS mechanical_stress,
         process_temperature / air_temperature AS thermal_efficiency,
         tool_wear / (rotational_speed * CAST(0.001 AS DOUBLE)) AS wear_per_operation,
         target
  FROM readings WHERE type = 'L'
)"""


def type_l_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reading_id + 10 features + target for type-L readings."""
    return extract_features(R.filter_type(X.readings(spark, sf_dir)), keep=("reading_id",))


def _round_sql(cols, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


# ------------------------------------------------------------- flagship ---
@register(
    "type_profile",
    with_ctes(
        X.READINGS_SQL,
        body=f"""
SELECT type, count(*) AS readings, round(avg(target), 6) AS failure_rate,
       round(avg(air_temperature), 6) AS air_temperature, round(avg(process_temperature), 6) AS process_temperature,
       round(avg(rotational_speed), 6) AS rotational_speed, round(avg(torque), 6) AS torque,
       round(avg(tool_wear), 6) AS tool_wear,
       round(avg(process_temperature - air_temperature), 6) AS temp_difference,
       round(avg(torque * (rotational_speed * 2 * pi() / 60)), 6) AS estimated_power,
       round(avg(torque / (rotational_speed / 1000)), 6) AS mechanical_stress,
       round(avg(process_temperature / air_temperature), 6) AS thermal_efficiency,
       round(avg(tool_wear / (rotational_speed * CAST(0.001 AS DOUBLE))), 6) AS wear_per_operation
FROM readings GROUP BY type""",
    ),
)
def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings → features → failure rate and mean of every feature per
    machine type (one hash aggregation, partial per task)."""
    f = extract_features(X.readings(spark, sf_dir), keep=("type",))
    return rounded(
        f.groupBy("type").agg(
            F.count("*").alias("readings"),
            F.avg(F.col("target").cast("double")).alias("failure_rate"),
            *[F.avg(c).alias(c) for c in S.FEATURES],
        )
    )


# ------------------------------------------------------------ S1 .. S5 ---
_READINGS_COLS = "reading_id, type, " + ", ".join(S.SENSORS) + ", target"


@register("read_readings", with_ctes(X.READINGS_SQL, body=f"SELECT {_READINGS_COLS} FROM readings"))
def read_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write readings as a bracketed-header CSV, scan it back with the
    explicit DDL and normalise names (CSV round trip of the whole table)."""
    src = X.readings(spark, sf_dir).withColumn("udi", F.lit(None).cast("bigint"))
    raw = C.to_bracketed(src.withColumnRenamed("reading_id", "product_id"))
    path = R.scratch_path(spark, "raw_csv")
    raw.select(*[F.col(f"`{c}`") for c in S.RAW_TO_SNAKE]).write.option("header", True).csv(path)
    back = R.read_readings_csv(spark, path)
    return back.select(F.col("product_id").alias("reading_id"), "type", *S.SENSORS, "target")


@register(
    "type_partition",
    with_ctes(X.READINGS_SQL, body=f"SELECT {_READINGS_COLS} FROM readings WHERE type = 'L'"),
)
def type_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-partitioned table, type-L read by partition pruning."""
    path = R.scratch_path(spark, "by_type")
    out = R.type_partition(X.readings(spark, sf_dir), path, "L")
    return out.select("reading_id", "type", *S.SENSORS, "target")


@register(
    "write_table",
    with_ctes(X.READINGS_SQL, FEATURES_SQL, body=f"SELECT reading_id, {_round_sql(S.FEATURES)}, target FROM features"),
)
def write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: features written as parquet under a run_ts partition and read back."""
    path = R.scratch_path(spark, "features")
    sinks.write_table(type_l_features(spark, sf_dir), path, run_ts="r1")
    back = spark.read.parquet(path).where(F.col("run_ts") == "r1").drop("run_ts")
    return rounded(back)


def _report_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quality import column_profile

    return column_profile(type_l_features(spark, sf_dir), S.FEATURES, ("mean", "std", "min", "max"))


@register(
    "write_report",
    with_ctes(
        X.READINGS_SQL,
        FEATURES_SQL,
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            f"round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM features"
            for c in S.FEATURES
        ),
    ),
)
def write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature statistics written as a JSON report, read back."""
    path = R.scratch_path(spark, "report")
    sinks.write_report(_report_frame(spark, sf_dir), path)
    back = spark.read.schema(
        "feature string, mean double, std double, min double, max double, generated_at timestamp"
    ).json(path)
    return rounded(back.drop("generated_at"))


_LINEITEM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@register("source_profile", "SELECT count(*) AS total_samples, " + f"CAST({len(_LINEITEM)} AS BIGINT)" + " AS n_columns, CAST(" + " + ".join(
    f"count_if({c} IS NULL)" for c in _LINEITEM) + " AS BIGINT) AS missing_values, true AS has_size FROM lineitem")
def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns, missing cells and input size of a source table."""
    out = sinks.source_profile(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return out.select("total_samples", "n_columns", "missing_values", (F.col("file_size_mb") > 0).alias("has_size"))


# ------------------------------------------------------------ P1 .. P7 ---
@register("filter_type", with_ctes(X.READINGS_SQL, body=f"SELECT {_READINGS_COLS} FROM readings WHERE type = 'L'"))
def filter_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.filter_type(X.readings(spark, sf_dir), "L")


@register(
    "select_sensors",
    with_ctes(X.READINGS_SQL, body="SELECT " + ", ".join(S.SENSORS) + ", target FROM readings WHERE type = 'L'"),
)
def select_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.select_sensors(R.filter_type(X.readings(spark, sf_dir)))


@register(
    "drop_if_present",
    with_ctes(X.READINGS_SQL, body="SELECT " + ", ".join(S.SENSORS) + " FROM readings"),
)
def drop_if_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop id/type/target (+ an absent name, ignored)."""
    return C.drop_if_present(X.readings(spark, sf_dir), "reading_id", "type", "target", "udi", "Timestamp")


@register(
    "normalize_columns",
    with_ctes(X.READINGS_SQL, body=f"SELECT {_READINGS_COLS} FROM readings"),
)
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snake → bracketed → snake (both mappings, absent names ignored)."""
    src = X.readings(spark, sf_dir)
    return C.normalize_columns(C.to_bracketed(src)).select("reading_id", "type", *S.SENSORS, "target")


_REQUIRED = [*S.SENSORS, "target", "udi"]


@register(
    "require_columns",
    with_ctes(
        X.READINGS_SQL,
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, false AS missing, count({c}) AS non_null FROM readings"
            for c in _REQUIRED[:-1]
        ) + " UNION ALL SELECT 'udi', true, CAST(0 AS BIGINT)",
    ),
)
def require_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 as a report over the whole table: required names vs the schema
    (no job) plus each present column's non-null count (one pass)."""
    df = X.readings(spark, sf_dir)
    miss = set(C.require_columns(df, _REQUIRED, hard=False))
    present = [c for c in _REQUIRED if c not in miss]
    row = df.agg(*[F.count(c).alias(c) for c in present])
    items = [F.struct(F.lit(c).alias("column_name"), F.lit(c in miss).alias("missing"),
                      (F.lit(0).cast("long") if c in miss else F.col(c)).alias("non_null")) for c in _REQUIRED]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


@register(
    "select_numeric",
    with_ctes(X.READINGS_SQL, body="SELECT " + ", ".join(S.SENSORS) + ", target FROM readings"),
)
def select_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.select_numeric(X.readings(spark, sf_dir))


@register(
    "add_metadata",
    with_ctes(
        X.READINGS_SQL,
        body="SELECT reading_id, target, 'v1' AS model_version, 'champion' AS model_stage FROM readings",
    ),
)
def add_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = X.readings(spark, sf_dir).select("reading_id", "target")
    return C.add_metadata(f, "v1", "champion", with_timestamp=False)


# ------------------------------------------------------------------- F ---
@register(
    "features",
    with_ctes(X.READINGS_SQL, FEATURES_SQL, body=f"SELECT reading_id, {_round_sql(S.FEATURES)}, target FROM features"),
)
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(type_l_features(spark, sf_dir))


@register(
    "features_serving",
    with_ctes(
        X.READINGS_SQL,
        body="""
SELECT reading_id, round(air_temperature, 6) AS air_temperature, round(process_temperature, 6) AS process_temperature,
       round(rotational_speed, 6) AS rotational_speed, round(torque, 6) AS torque, round(tool_wear, 6) AS tool_wear,
       round(process_temperature - air_temperature, 6) AS temp_difference,
       round(torque * rotational_speed * 2 * pi() / 60, 6) AS estimated_power,
       round(torque / (rotational_speed + 1e-6), 9) AS mechanical_stress,
       round(process_temperature / (air_temperature + 1e-6), 9) AS thermal_efficiency,
       round(tool_wear / (rotational_speed + 1e-6), 9) AS wear_per_operation
FROM readings""",
    ),
)
def features_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = extract_serving_features(X.readings(spark, sf_dir), keep=("reading_id",))
    small = {"mechanical_stress", "thermal_efficiency", "wear_per_operation"}
    return f.select("reading_id", *[F.round(c, 9 if c in small else 6).alias(c) for c in S.FEATURES])
