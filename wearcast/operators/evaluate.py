"""Evaluation (E1-E7) over any table of labels, predictions and scores.

Everything starts from counts by (group…, label, prediction) — at most
groups·k² rows after a map-side-combined aggregation — so the metrics cost
one pass over the predictions however large they are.  The exact ROC/AUC
aggregates by distinct score first and uses distributed running totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..session import cut_lineage
from .prefix import running_totals


def _div0(a: Column, b: Column) -> Column:
    """a / b with 0 for a zero divisor (the reported-metric convention)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def confusion_matrix(df: DataFrame, label: str = "y", prediction: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """Binary: (by…, tn, fp, fn, tp); weights are not applied."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def per_class(df: DataFrame, label: str = "y", prediction: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    """(by…, class, precision, recall, f1_score, support) for every class
    that occurs as a label or a prediction; zero divisors give 0."""
    by = list(by)
    pairs = df.groupBy(*by, F.col(label).alias("_y"),
                       F.col(prediction).cast(df.schema[label].dataType).alias("_p")).agg(F.count("*").alias("_n"))
    # ≤ groups·k² rows from here on (k = number of classes)
    sup = pairs.groupBy(*by, F.col("_y").alias("class")).agg(F.sum("_n").alias("support"))
    pred = pairs.groupBy(*by, F.col("_p").alias("class")).agg(F.sum("_n").alias("_pred"))
    tp = pairs.where(F.col("_y") == F.col("_p")).groupBy(*by, F.col("_y").alias("class")).agg(F.sum("_n").alias("_tp"))
    out = sup.join(pred, [*by, "class"], "full").join(tp, [*by, "class"], "left")
    out = out.fillna(0, ["support", "_pred", "_tp"])
    prec = _div0(F.col("_tp").cast("double"), F.col("_pred").cast("double"))
    rec = _div0(F.col("_tp").cast("double"), F.col("support").cast("double"))
    out = out.withColumns({"precision": prec, "recall": rec})
    out = out.withColumn("f1_score", _div0(2 * F.col("precision") * F.col("recall"),
                                            F.col("precision") + F.col("recall")))
    return out.select(*by, "class", "precision", "recall", "f1_score", "support", "_tp")


def classification_metrics(df: DataFrame, label: str = "y", prediction: str = "prediction",
                           by: Sequence[str] = (), positive: int = 1) -> DataFrame:
    """(by…, accuracy, precision, recall, f1_score [support-weighted],
    precision_failure, recall_failure, f1_failure [positive class])."""
    by = list(by)
    pc = per_class(df, label, prediction, by)
    pos = F.col("class") == positive
    return pc.groupBy(*by).agg(
        _div0(F.sum("_tp").cast("double"), F.sum("support").cast("double")).alias("accuracy"),
        _div0(F.sum(F.col("precision") * F.col("support")), F.sum("support").cast("double")).alias("precision"),
        _div0(F.sum(F.col("recall") * F.col("support")), F.sum("support").cast("double")).alias("recall"),
        _div0(F.sum(F.col("f1_score") * F.col("support")), F.sum("support").cast("double")).alias("f1_score"),
        F.coalesce(F.max(F.when(pos, F.col("precision"))), F.lit(0.0)).alias("precision_failure"),
        F.coalesce(F.max(F.when(pos, F.col("recall"))), F.lit(0.0)).alias("recall_failure"),
        F.coalesce(F.max(F.when(pos, F.col("f1_score"))), F.lit(0.0)).alias("f1_failure"),
    )


def classification_report(df: DataFrame, label: str = "y", prediction: str = "prediction") -> DataFrame:
    """Rows per class plus 'macro avg', 'weighted avg' and 'accuracy'
    (accuracy row: f1_score = accuracy, support = all rows)."""
    pc = per_class(df, label, prediction)
    classes = pc.select(F.col("class").cast("string").alias("label"), "precision", "recall", "f1_score",
                        F.col("support").cast("long").alias("support"))
    tot = F.sum("support").cast("double")
    macro = pc.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                   F.avg("f1_score").alias("f1_score"), F.sum("support").cast("long").alias("support")
                   ).select(F.lit("macro avg").alias("label"), "precision", "recall", "f1_score", "support")
    weighted = pc.agg(
        _div0(F.sum(F.col("precision") * F.col("support")), tot).alias("precision"),
        _div0(F.sum(F.col("recall") * F.col("support")), tot).alias("recall"),
        _div0(F.sum(F.col("f1_score") * F.col("support")), tot).alias("f1_score"),
        F.sum("support").cast("long").alias("support"),
    ).select(F.lit("weighted avg").alias("label"), "precision", "recall", "f1_score", "support")
    acc = pc.agg(_div0(F.sum("_tp").cast("double"), tot).alias("f1_score"),
                 F.sum("support").cast("long").alias("support")).select(
        F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"), "f1_score", "support")
    return classes.unionByName(macro).unionByName(weighted).unionByName(acc)


def _score_counts(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Distinct scores with positive/negative counts: a hot score (ties at
    0 or 1) collapses map-side to one row per task."""
    return df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def roc_auc(df: DataFrame, label: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties count half:
    Σ pos·(neg_below + neg/2) / (P·N) over distinct scores.  NULL for a group
    with one class only; the sums and their product are DOUBLE (P·N passes
    the BIGINT range near 10^10 rows)."""
    return area(_score_counts(df, label, score, list(by)), score, by)


def area(counts: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """``roc_auc`` from the positives and negatives (pos, neg) of each distinct score."""
    by = list(by)
    ranked = running_totals(counts, by, [score], ["neg"])
    return ranked.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )


def roc_curve(df: DataFrame, label: str = "y", score: str = "score", drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score (descending) plus the start
    point (+inf, 0, 0).  ``drop_intermediate`` (the usual default) removes
    points collinear with both neighbours: point j stays iff it is the
    first or last, or its (pos, neg) counts differ from the next lower
    score's — exactly where the second differences of (fps, tps) are not 0."""
    cnt = cut_lineage(_score_counts(df, label, score, []))  # read three times: one scan of the source
    # one ranking pass: running sums of the counts and, for the neighbour
    # test, the running max of the score (= the next lower distinct score)
    ranked = running_totals(cnt.withColumn("_sv", F.col(score).cast("double")), [], [score],
                            ["pos", "neg", "_sv"], how={"pos": "sum", "neg": "sum", "_sv": "max"})
    totals = cnt.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"), F.max(score).alias("_top"),
                     F.count("*").alias("_D"))
    j = ranked.crossJoin(F.broadcast(totals))  # one row
    if drop_intermediate:
        # fetch the next point's counts by key (equi-join on distinct scores)
        nxt = cnt.select(F.col(score).cast("double").alias("_next"), F.col("pos").alias("_npos"),
                         F.col("neg").alias("_nneg"))
        j = j.withColumnRenamed("_sv_before", "_next").join(nxt, "_next", "left")
        keep = (F.col("_D") <= 2) | F.col("_next").isNull() | (F.col(score) == F.col("_top")) \
            | (F.col("_npos") != F.col("pos")) | (F.col("_nneg") != F.col("neg"))
        j = j.where(keep)
    pts = j.select(
        F.col(score).cast("double").alias("threshold"),
        _div0(F.col("_N") - F.col("neg_before"), F.col("_N").cast("double")).alias("fpr"),
        _div0(F.col("_P") - F.col("pos_before"), F.col("_P").cast("double")).alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def model_comparison(metrics: DataFrame, model: str = "model", split: str = "split",
                     gap_limit: float = S.OVERFIT_GAP, cv: DataFrame | None = None) -> DataFrame:
    """From (model, split, metric…) rows to one row per model and metric
    with train, test, |train − test| and an overfit flag (> gap_limit).
    ``cv`` — (model, fold, metric…) rows of out-of-fold predictions — adds the
    mean over the folds as ``cv`` (NULL without it)."""
    names = [c for c in metrics.columns if c not in (model, split)]
    long = metrics.select(model, split, F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names
    ])).alias("m")).select(model, split, "m.metric", "m.value")
    wide = long.groupBy(model, "metric").pivot(split, ["train", "test"]).agg(F.first("value"))
    gap = F.abs(F.col("train") - F.col("test"))
    out = wide.withColumn("gap", gap).withColumn("overfit", F.coalesce(gap > gap_limit, F.lit(False)))
    if cv is None:
        return out.withColumn("cv", F.lit(None).cast("double"))
    means = cv.groupBy(model).agg(*[F.avg(F.col(n).cast("double")).alias(n) for n in names])
    folds = means.select(model, F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("cv")) for n in names])).alias("m")).select(model, "m.metric", "m.cv")
    return out.join(folds, [model, "metric"], "left")  # models × metrics rows


def best_model(comparison: DataFrame, order: DataFrame, metric: str = "f1_score", model: str = "model") -> DataFrame:
    """Argmax of the test value of ``metric``; the first model in
    ``order`` (model, position) wins ties."""
    c = comparison.where(F.col("metric") == metric).join(order, model)
    w = Window.orderBy(F.desc("test"), F.asc("position"))  # one row per model
    return c.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(
        model, F.col("test").alias(metric), "gap", "overfit")
