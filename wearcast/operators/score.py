"""Scoring and its statistics.

Scoring is ``PipelineModel.transform`` (or any function that adds
``prob_class_1``); statistics are single aggregations over the predictions.
Unparsable input cells are typed error rows, not exceptions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import add_metadata
from .learn import DERIVED, probabilities


def batch_score(model: PipelineModel, readings: DataFrame, version: str, stage: str, keep: Sequence[str] = (),
                with_timestamp: bool = True) -> DataFrame:
    """features → saved pipeline (scaler + model) → class, probability per
    class, confidence = max probability, model metadata.  Works unchanged
    on a streaming DataFrame."""
    pred = probabilities(model.transform(readings))
    own = [F.col(f"{DERIVED}{c}").alias(c) for c in S.DERIVED]  # the pipeline's own features stage
    cols = [*keep, *S.SENSORS, *own, "predicted_class", "prob_class_0", "prob_class_1", "confidence"]
    return add_metadata(pred.select(*cols), version, stage, with_timestamp)


def prediction_stats(pred: DataFrame, low: float = S.LOW_CONFIDENCE, cls: str = "predicted_class",
                     conf: str = "confidence") -> DataFrame:
    """(metric, key, value): total, distinct classes, count per class,
    average confidence, count below ``low``.  One aggregation by class
    (map-side combined) plus totals derived from it."""
    by = pred.groupBy(cls).agg(F.count("*").alias("n"), F.sum(conf).alias("conf_sum"),
                               F.count_if(F.col(conf) < low).alias("low_n"))
    tot = by.agg(F.sum("n").alias("total"), F.count("*").alias("classes"),
                 (F.sum("conf_sum") / F.sum("n")).alias("avg_conf"), F.sum("low_n").alias("low_n"))
    nul = F.lit(None).cast("string")
    items = [("total_predictions", F.col("total")), ("unique_classes", F.col("classes")),
             ("average_confidence", F.col("avg_conf")), ("low_confidence_count", F.col("low_n"))]
    head = tot.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), nul.alias("key"),
                                                   v.cast("double").alias("value")) for k, v in items])).alias("x"))
    per = by.select(F.lit("class_count").alias("metric"), F.col(cls).cast("string").alias("key"),
                    F.col("n").cast("double").alias("value"))
    return head.select("x.*").unionByName(per)


def inference_alerts(stats: DataFrame, low_share: float = S.LOW_CONFIDENCE_SHARE,
                     min_avg: float = S.MIN_AVERAGE_CONFIDENCE) -> DataFrame:
    """(alert, value, threshold, fired, message) from ``prediction_stats``:
    low-confidence rows above ``low_share`` of all, average confidence below
    ``min_avg``, all predictions in one class; plus each class's share (%)."""
    wide = stats.where(F.col("key").isNull()).groupBy().pivot(
        "metric", ["total_predictions", "unique_classes", "average_confidence", "low_confidence_count"]
    ).agg(F.first("value"))
    alerts = wide.select(F.explode(F.array(
        F.struct(F.lit("low_confidence").alias("alert"), F.col("low_confidence_count").alias("value"),
                 (F.col("total_predictions") * low_share).alias("threshold"),
                 (F.col("low_confidence_count") > F.col("total_predictions") * low_share).alias("fired")),
        F.struct(F.lit("low_average_confidence").alias("alert"), F.col("average_confidence").alias("value"),
                 F.lit(min_avg).alias("threshold"), (F.col("average_confidence") < min_avg).alias("fired")),
        F.struct(F.lit("single_class").alias("alert"), F.col("unique_classes").alias("value"),
                 F.lit(1.0).alias("threshold"), (F.col("unique_classes") == 1).alias("fired")),
    )).alias("a")).select("a.*")
    total = wide.select("total_predictions")
    shares = stats.where(F.col("metric") == "class_count").crossJoin(F.broadcast(total)).select(
        F.concat(F.lit("class_share_"), F.col("key")).alias("alert"),
        (F.col("value") / F.col("total_predictions") * 100).alias("value"),
        F.lit(None).cast("double").alias("threshold"), F.lit(False).alias("fired"))
    out = alerts.unionByName(shares)
    msg = (F.when(F.col("alert") == "low_confidence", F.format_string("high number of low-confidence predictions (%d)",
                                                                      F.col("value").cast("long")))
           .when(F.col("alert") == "low_average_confidence", F.format_string("low average confidence (%.3f)",
                                                                              F.col("value")))
           .when(F.col("alert") == "single_class", F.lit("all predictions belong to the same class"))
           .otherwise(F.format_string("%.1f%%", F.col("value"))))
    return out.withColumn("message", msg)


def label_predictions(pred: DataFrame, p1: str = "prob_class_1", threshold: float = 0.5) -> DataFrame:
    """'Failure' if p > threshold else 'No Failure'; confidence = max(p, 1−p);
    probabilities as a map."""
    p = F.col(p1)
    return pred.withColumns({
        "prediction_label": F.when(p > threshold, "Failure").otherwise("No Failure"),
        "label_confidence": F.greatest(p, 1 - p),
        "probabilities": F.create_map(F.lit("Failure"), p, F.lit("No Failure"), 1 - p),
    })


def parse_readings(text: DataFrame, cols: Sequence[str] = S.SENSORS) -> DataFrame:
    """``try_cast`` every sensor to DOUBLE (plain ``cast`` raises under
    ANSI); ``valid`` is true when all parse."""
    parsed = text.withColumns({c: F.col(c).cast("string").try_cast("double") for c in cols})
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return parsed.withColumn("valid", ok)


def score_rows_safe(text: DataFrame, scorer: Callable[[DataFrame], DataFrame], keep: Sequence[str] = (),
                    cols: Sequence[str] = S.SENSORS) -> DataFrame:
    """Score every parsable row with ``scorer`` (adds ``prob_class_1``);
    other rows become prediction 'Error', confidence 0, {Error: 1}.  Both
    branches are narrow; the union keeps the row count."""
    parsed = parse_readings(text, cols)
    good = label_predictions(scorer(parsed.where("valid")))
    good = good.select(*keep, "prediction_label", "label_confidence", "probabilities")
    bad = parsed.where(~F.col("valid")).select(
        *keep, F.lit("Error").alias("prediction_label"), F.lit(0.0).alias("label_confidence"),
        F.create_map(F.lit("Error"), F.lit(1.0)).alias("probabilities"))
    return good.unionByName(bad)


def batch_summary(labelled: DataFrame) -> DataFrame:
    """total, successful, failed, predicted failures / no failures, failure
    rate over the successful rows (0 if none), their average confidence."""
    lab = F.col("prediction_label")
    ok = lab != "Error"
    return labelled.agg(
        F.count("*").alias("total_samples"),
        F.count_if(ok).alias("successful_predictions"),
        F.count_if(~ok).alias("failed_predictions"),
        F.count_if(lab == "Failure").alias("predicted_failures"),
        F.count_if(lab == "No Failure").alias("predicted_no_failures"),
        F.coalesce(F.try_divide(F.count_if(lab == "Failure"), F.count_if(ok)), F.lit(0.0)).alias("failure_rate"),
        F.coalesce(F.avg(F.when(ok, F.col("label_confidence"))), F.lit(0.0)).alias("average_confidence"),
    )
