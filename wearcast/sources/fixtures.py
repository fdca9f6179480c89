"""Adapted test tables over the generated TPC-H-like parquet.

Each view exists twice: as Spark column expressions (what queries() run) and
as DuckDB SQL text (what the oracle runs).  Both must evaluate identically,
so expressions use the same association order and only integer keys are
cast to text.

readings        sensor readings derived from ``lineitem`` (one row per line)
readings_dirty  readings with NULL torque, out-of-range rpm, duplicate rows
readings_text   readings whose torque arrives as text (unparsable cells)
scored          labels + scores without a model (evaluation/scoring stats)
runs            experiment runs derived from ``events``
model_versions  registered model versions derived from ``orders``
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _target_expr(air: Column, proc: Column, rpm: Column, torque: Column, wear: Column) -> Column:
    power = torque * (rpm * 2 * F.lit(math.pi) / 60)
    fail = ((proc - air < 3) & (rpm < 1300)) | (power > 21000) | (wear * torque > 16500)
    return F.when(fail, F.lit(1)).otherwise(F.lit(0)).cast("int")


def _reading_cols(li: DataFrame) -> dict[str, Column]:
    rid = F.concat_ws(
        "-",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.col("l_quantity").cast("bigint").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
    )
    rtype = (
        F.when(F.col("l_returnflag") == "A", "L")
        .when(F.col("l_returnflag") == "N", "M")
        .otherwise("H")
    )
    return {
        "reading_id": rid,
        "type": rtype,
        "air_temperature": F.lit(295) + F.col("l_discount") * 100,
        "process_temperature": F.lit(305) + F.col("l_tax") * 120,
        "rotational_speed": F.lit(1100) + F.col("l_extendedprice") / 56,
        "torque": F.lit(3) + F.col("l_quantity") * 1.5,
        "tool_wear": ((F.col("l_suppkey") * 37 + F.col("l_partkey") * 11) % 254).cast("double"),
    }


def readings(spark: SparkSession, sf_dir: str, keep_orderkey: bool = False) -> DataFrame:
    """``readings`` (FIXTURES §2.1); lazily projected from lineitem."""
    li = _table(spark, sf_dir, "lineitem")
    cols = _reading_cols(li)
    base = li.select(*[e.alias(n) for n, e in cols.items()], *(["l_orderkey"] if keep_orderkey else []))
    return base.withColumn(
        "target", _target_expr(*(F.col(c) for c in S.SENSORS))
    )


def readings_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with missing torque, out-of-range rpm and duplicated rows."""
    r = readings(spark, sf_dir, keep_orderkey=True)
    dirty = r.withColumns(
        {
            "torque": F.when(F.col("l_orderkey") % 17 == 0, F.lit(None).cast("double")).otherwise(
                F.col("torque")
            ),
            "rotational_speed": F.when(
                F.col("l_orderkey") % 23 == 0, F.col("rotational_speed") + 2500
            ).otherwise(F.col("rotational_speed")),
        }
    )
    dups = dirty.where(F.col("l_orderkey") % 50 == 0)
    return dirty.unionByName(dups).drop("l_orderkey")


def readings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose torque column is text; some cells are not numbers."""
    li = _table(spark, sf_dir, "lineitem")
    cols = _reading_cols(li)
    cols["torque"] = F.when(F.col("l_orderkey") % 97 == 0, F.lit("n/a")).otherwise(
        F.col("l_quantity").cast("bigint").cast("string")
    )
    return li.select(*[cols[c].alias(c) for c in ["reading_id", "type", *S.SENSORS]])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and scores without a model (FIXTURES §2.3)."""
    r = readings(spark, sf_dir)
    score = F.least(F.lit(1.0), F.col("tool_wear") * F.col("torque") / 17000)
    return r.select(
        "reading_id",
        F.col("target").alias("y"),
        score.alias("score"),
    ).select(
        "reading_id",
        "y",
        "score",
        (F.col("score") > 0.5).cast("int").alias("prediction"),
        F.col("score").alias("prob_class_1"),
        (1 - F.col("score")).alias("prob_class_0"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment runs (FIXTURES §2.4) derived from ``events``."""
    ev = _table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("run_id"),
        F.col("ts").alias("start_time"),
        F.col("event_type").alias("algorithm"),
        (F.col("value") / 500).alias("f1"),
        (F.col("value") / 400).alias("accuracy"),
        (F.col("user_id") % 20 / 100).alias("train_test_gap"),
        F.date_format("ts", "yyyyMMdd").alias("experiment"),
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_name"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("status"),
        F.concat(F.lit("model_"), (F.col("user_id") % 3).cast("string")).alias("best_model"),
    )


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered model versions (FIXTURES §2.4) derived from ``orders``."""
    o = _table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("name"),
        F.col("o_orderkey").alias("version"),
        (F.col("o_totalprice") / 500000).alias("f1"),
        F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "O", "Staging").otherwise(
            "None").alias("stage"),
        F.col("o_orderdate").alias("created"),
        F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("source"),
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.lit("READY").alias("status"),
        F.concat(F.lit("priority="), F.col("o_orderpriority")).alias("tags"),
    )


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL (oracle side).  Used as CTE prefixes.
# ---------------------------------------------------------------------------
_READINGS_BASE_SQL = """
readings_base AS (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
              CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
              CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
              CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS reading_id,
    CASE l_returnflag WHEN 'A' THEN 'L' WHEN 'N' THEN 'M' ELSE 'H' END AS type,
    295 + l_discount * 100 AS air_temperature,
    305 + l_tax * 120 AS process_temperature,
    1100 + l_extendedprice / 56 AS rotational_speed,
    3 + l_quantity * 1.5E0 AS torque,
    CAST((l_suppkey * 37 + l_partkey * 11) % 254 AS DOUBLE) AS tool_wear,
    l_orderkey,
    l_quantity
  FROM lineitem
)"""

_TARGET_SQL = """CAST(CASE WHEN (process_temperature - air_temperature < 3 AND rotational_speed < 1300)
              OR torque * (rotational_speed * 2 * pi() / 60) > 21000
              OR tool_wear * torque > 16500 THEN 1 ELSE 0 END AS INTEGER)"""

READINGS_SQL = (
    _READINGS_BASE_SQL
    + """,
readings AS (
  SELECT reading_id, type, air_temperature, process_temperature, rotational_speed,
         torque, tool_wear, """
    + _TARGET_SQL
    + """ AS target
  FROM readings_base
)"""
)

READINGS_DIRTY_SQL = (
    READINGS_SQL
    + """,
readings_dirty_base AS (
  SELECT reading_id, type, air_temperature, process_temperature,
         CASE WHEN l_orderkey % 23 = 0 THEN rotational_speed + 2500 ELSE rotational_speed END
           AS rotational_speed,
         CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE torque END AS torque,
         tool_wear, """
    + _TARGET_SQL
    + """ AS target,
         l_orderkey
  FROM readings_base
),
readings_dirty AS (
  SELECT reading_id, type, air_temperature, process_temperature, rotational_speed, torque,
         tool_wear, target FROM readings_dirty_base
  UNION ALL
  SELECT reading_id, type, air_temperature, process_temperature, rotational_speed, torque,
         tool_wear, target FROM readings_dirty_base WHERE l_orderkey % 50 = 0
)"""
)

READINGS_TEXT_SQL = (
    _READINGS_BASE_SQL
    + """,
readings_text AS (
  SELECT reading_id, type, air_temperature, process_temperature, rotational_speed,
         CASE WHEN l_orderkey % 97 = 0 THEN 'n/a'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS torque,
         tool_wear
  FROM readings_base
)"""
)

SCORED_SQL = (
    READINGS_SQL
    + """,
scored_base AS (
  SELECT reading_id, target AS y, least(1.0E0, tool_wear * torque / 17000) AS score FROM readings
),
scored AS (
  SELECT reading_id, y, score, CAST(score > 0.5 AS INTEGER) AS prediction,
         score AS prob_class_1, 1 - score AS prob_class_0
  FROM scored_base
)"""
)

RUNS_SQL = """
runs AS (
  SELECT event_id AS run_id, ts AS start_time, event_type AS algorithm, value / 500 AS f1, value / 400 AS accuracy,
         CAST(user_id % 20 AS DOUBLE) / 100 AS train_test_gap, strftime(ts, '%Y%m%d') AS experiment,
         'run_' || user_id AS run_name, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS status,
         'model_' || (user_id % 3) AS best_model
  FROM events
)"""

MODEL_VERSIONS_SQL = """
model_versions AS (
  SELECT o_custkey AS name, o_orderkey AS version, o_totalprice / 500000 AS f1,
         CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'None' END AS stage,
         o_orderdate AS created, 'models/' || o_orderkey AS source, 'r' || o_orderkey AS run_id, 'READY' AS status,
         'priority=' || o_orderpriority AS tags FROM orders
)"""
