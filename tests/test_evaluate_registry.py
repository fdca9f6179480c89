import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearcast.operators import evaluate as E
from wearcast.operators import registry as G


def _from_cm(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "y int, prediction int")


@pytest.mark.parametrize("cm,exp", [
    ((1146, 7, 6, 41), (0.9891666667, 0.8541666667, 0.8723404255, 0.8631578947, 0.9892213342)),
    ((1052, 101, 2, 45), (0.9141666667, 0.3082191781, 0.9574468085, 0.4663212435, 0.9342557908)),
    ((1153, 0, 42, 5), (0.9650000000, 1.0, 0.1063829787, 0.1923076923, 0.9511784170)),
])
def test_metrics_reproduce_recorded_runs(spark, cm, exp):
    m = E.classification_metrics(_from_cm(spark, *cm)).first()
    got = (m["accuracy"], m["precision_failure"], m["recall_failure"], m["f1_failure"], m["f1_score"])
    assert got == pytest.approx(exp, abs=1e-9)


def test_report_rows(spark):
    rep = {r["label"]: r for r in E.classification_report(_from_cm(spark, 1146, 7, 6, 41)).collect()}
    assert rep["1"]["support"] == 47 and rep["0"]["support"] == 1153
    assert rep["accuracy"]["f1_score"] == pytest.approx(0.9891666667, abs=1e-9)
    assert rep["macro avg"]["precision"] == pytest.approx((rep["0"]["precision"] + rep["1"]["precision"]) / 2)


def test_auc_equals_pair_count(spark):
    rng = np.random.default_rng(11)
    y = (rng.random(400) < 0.3).astype(int)
    s = np.round(rng.random(400) * 0.5 + y * 0.3, 1)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"y": y, "score": s}))
    auc = E.roc_auc(df).first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute, abs=1e-12)
    curve = E.roc_curve(df).toPandas()
    assert curve["fpr"].max() == pytest.approx(1.0) and curve["tpr"].max() == pytest.approx(1.0)


def test_champion_decisions_golden(spark):
    v = spark.createDataFrame([("m", 1, 0.9892213342), ("m", 2, 0.9511784170), ("m", 3, 0.9342557908),
                               ("n", 1, 0.5), ("n", 2, 0.5), ("n", 3, 0.7)], "name string, version int, f1 double")
    d = {(r["name"], r["version"]): r["promoted"] for r in G.champion_decisions(v).collect()}
    assert d == {("m", 1): True, ("m", 2): False, ("m", 3): False,
                 ("n", 1): True, ("n", 2): False, ("n", 3): True}
    a = {r["name"]: r for r in G.current_aliases(G.champion_decisions(v)).collect()}
    assert (a["m"]["champion"], a["m"]["previous"], a["m"]["candidate"]) == (1, None, 3)
    assert (a["n"]["champion"], a["n"]["previous"], a["n"]["candidate"]) == (3, 1, 3)
    s = {r["name"]: r["serving_version"] for r in G.serving_version(a and G.current_aliases(G.champion_decisions(v))).collect()}
    assert s == {"m": 1, "n": 3}


def test_production_gate(spark):
    best = spark.createDataFrame([("rf", 0.9, 0.01), ("svm", 0.5, 0.2)], "model string, f1_score double, gap double")
    g = {r["model"]: r for r in G.production_gate(best).collect()}
    assert g["rf"]["production_ready"] and not g["svm"]["quality_passed"]


def test_roc_curve_drops_collinear_points(spark):
    # scores 0.9/0.8/0.7 each with one positive: (0.8) lies on the segment
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.2), (0, 0.1)], "y int, score double")
    full = E.roc_curve(df, drop_intermediate=False).toPandas()
    kept = E.roc_curve(df).toPandas()
    assert len(full) == 6
    # tps = 1,2,3,3,3 and fps = 0,0,0,1,2: 0.8 and 0.2 are collinear
    assert sorted(kept["threshold"].tolist()) == [0.1, 0.7, 0.9, float("inf")]


def test_auc_of_one_class_and_of_many_rows(spark):
    """A group with one class has no area; P·N passes the BIGINT range."""
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 1, 0.2), ("b", 1, 0.9), ("b", 0, 0.1)], "g string, y int, score double")
    assert {r["g"]: r["auc"] for r in E.roc_auc(df, by=["g"]).collect()} == {"a": None, "b": 1.0}
    many = spark.createDataFrame([(1, 0.9, 2**33), (0, 0.1, 2**33), (0, 0.9, 2**32)], "y int, score double, n long")
    counts = many.groupBy("score").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"),
                                       F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("neg"))
    auc = E.area(counts, "score").first()["auc"]
    assert auc == pytest.approx((2**33 + 2**31) / (2**33 + 2**32))


def test_empty_inputs(spark):
    from wearcast.operators.quantiles import quantiles

    empty = spark.createDataFrame([], "y int, score double")
    r = E.roc_auc(empty).collect()  # a global aggregate: one row, NULL area
    assert len(r) == 1 and r[0]["auc"] is None
    assert E.roc_curve(empty).count() == 1  # only the start point
    assert [r["quantile"] for r in quantiles(empty.select("score"), ["score"], [0.5]).collect()] == [None]
    v = spark.createDataFrame([], "name string, version int, f1 double")
    assert G.champion_decisions(v).count() == 0
