"""Checked queries: file-arrival streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..functions.features import extract_features
from ..sources import fixtures as X
from ..sources import readings as R
from ..streaming import files as ST
from .book import register, rounded, with_ctes
from .ingest_checks import FEATURES_SQL, _round_sql
from .model_checks import _new_readings
from .tree_checks import RULE_SCORES_SQL, rule_model, rule_scores_sql


#: Rows of an arriving file; the number of files follows the input.
FILE_ROWS = 1_000_000


def _arrivals(df: DataFrame, spark: SparkSession, name: str) -> str:
    """Drop the rows into a folder as files (the arrivals)."""
    src = R.scratch_path(spark, name)
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(src)
    return src


@register(
    "stream_new_files",
    with_ctes(X.READINGS_SQL, FEATURES_SQL, body=f"SELECT reading_id, {_round_sql(S.FEATURES)}, target FROM features"),
)
def stream_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings arrive as files; an availableNow stream extracts features of
    type-L rows into a parquet sink; the sink equals the batch result."""
    src = _arrivals(X.readings(spark, sf_dir), spark, "arrivals")
    stream = ST.file_stream(spark, src, S.READINGS_DDL)
    feats = extract_features(R.filter_type(stream), keep=("reading_id",))
    sink, ckpt = R.scratch_path(spark, "features_sink"), R.scratch_path(spark, "features_ckpt")
    ST.run_available_now(feats, sink, ckpt)
    return rounded(spark.read.parquet(sink))


@register("stream_score", RULE_SCORES_SQL)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New readings arrive as files; a pipeline scores
    each batch; predictions and per-batch statistics land in tables."""
    new = _new_readings(spark, sf_dir)
    src = _arrivals(new, spark, "new_readings")
    stream = ST.file_stream(spark, src, "reading_id STRING, " + ", ".join(f"{c} DOUBLE" for c in S.SENSORS))
    preds, stats = R.scratch_path(spark, "pred_sink"), R.scratch_path(spark, "stats_sink")
    ST.score_stream(stream, rule_model(), "1", "champion", preds, stats,
                    R.scratch_path(spark, "score_ckpt"), keep=("reading_id",))
    return rounded(spark.read.parquet(preds).drop("batch_id", "inference_timestamp"))


@register("stream_score_checked", rule_scores_sql(
    X.READINGS_DIRTY_SQL, "m AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in S.SENSORS) + " FROM readings_dirty)",
    "filled AS (SELECT reading_id, target, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in S.SENSORS)
    + " FROM readings_dirty CROSS JOIN m)", source="filled"))
def stream_score_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with missing cells arrive as files; the batch passes the gate,
    is filled with its medians and scored."""
    new = X.readings_dirty(spark, sf_dir).select("reading_id", *S.SENSORS)
    src = _arrivals(new, spark, "dirty_readings")
    stream = ST.file_stream(spark, src, "reading_id STRING, " + ", ".join(f"{c} DOUBLE" for c in S.SENSORS))
    base = R.scratch_path(spark, "checked_stream")
    ST.score_checked_stream(stream, rule_model(), "1", "champion", base, f"{base}/checkpoint", keep=("reading_id",))
    return rounded(spark.read.parquet(f"{base}/predictions").drop("batch_id", "inference_timestamp"))
