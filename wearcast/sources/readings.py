"""Reading sources (S1, S2): explicit-schema scans and the type partition.

Everything is normalised at ingest: snake-case names, sensors as DOUBLE,
NaN turned into NULL (so aggregates skip missing values like pandas does).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import nans_to_nulls, normalize_columns
from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/wearcast-tables/{name}-{uuid.uuid4().hex[:12]}"


def read_readings_csv(spark: SparkSession, path: str, ddl: str = S.RAW_CSV_DDL) -> DataFrame:
    """CSV with header, explicit DDL (no inference pass), trailing blanks
    ignored, names normalised to snake case, NaN → NULL."""
    df = (
        spark.read.schema(ddl)
        .option("header", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return nans_to_nulls(normalize_columns(df))


def read_new_readings_csv(spark: SparkSession, path: str) -> DataFrame:
    """New (unlabelled) readings: five snake-case sensors, all DOUBLE."""
    return read_readings_csv(spark, path, S.NEW_READINGS_DDL)


def read_readings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    df = spark.read.format(fmt).load(path)
    return nans_to_nulls(normalize_columns(df))


def filter_type(df: DataFrame, machine_type: str = "L") -> DataFrame:
    """P1.  On a ``partitionBy("type")`` table this is partition pruning."""
    return df.where(F.col("type") == machine_type)


def write_type_partitioned(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy("type").parquet(path)


def type_partition(df: DataFrame, path: str, machine_type: str = "L") -> DataFrame:
    """Use the type-partitioned table when it exists, else write it once
    (all types, ``partitionBy("type")``) and read it back; the type filter
    then prunes partitions instead of scanning the whole table."""
    spark = df.sparkSession
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        write_type_partitioned(df, path)
        table = spark.read.parquet(path)
    return filter_type(table, machine_type)
