import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearcast import schema as S
from wearcast.functions.features import extract_features
from wearcast.operators import learn as L
from wearcast.operators import sampling as M
from wearcast.operators import scaling as T
from wearcast.operators import score as I


@pytest.fixture(scope="module")
def train_set(spark):
    rng = np.random.default_rng(0)
    n = 1200
    pdf = pd.DataFrame({
        "reading_id": [f"r{i}" for i in range(n)],
        "air_temperature": rng.uniform(295, 305, n), "process_temperature": rng.uniform(305, 315, n),
        "rotational_speed": rng.uniform(1200, 2800, n), "torque": rng.uniform(5, 75, n),
        "tool_wear": rng.uniform(0, 250, n),
    })
    pdf["target"] = ((pdf.torque * pdf.tool_wear > 9000) | (pdf.rotational_speed < 1300)).astype("int32")
    feats = extract_features(spark.createDataFrame(pdf), keep=("reading_id",))
    w = M.class_weights(feats)
    feats = M.attach_weights(feats, w)
    scaler = T.collect_scaler(T.scaler_fit(feats))
    return feats, scaler


def _rf(scaler, train):
    return L.fit_pipeline(train, scaler, L.random_forest(num_trees=20, max_depth=6))


def test_rf_probabilities_reproducible_and_useful(train_set):
    feats, scaler = train_set
    m1, m2 = _rf(scaler, feats), _rf(scaler, feats)
    p1 = L.probabilities(m1.transform(feats)).select("reading_id", "prob_class_0", "prob_class_1", "predicted_class")
    p2 = L.probabilities(m2.transform(feats)).select("reading_id", F.col("prob_class_1").alias("q1"))
    j = p1.join(p2, "reading_id").toPandas()
    assert np.allclose(j.prob_class_0 + j.prob_class_1, 1.0)
    assert np.allclose(j.prob_class_1, j.q1)  # same seed and layout → same model
    rec = p1.join(feats.select("reading_id", "target"), "reading_id").where("target = 1").agg(
        F.avg((F.col("predicted_class") == 1).cast("double"))).first()[0]
    assert rec > 0.5  # the weighted forest finds the minority class


def test_saved_pipeline_scores_identically(spark, train_set, tmp_path):
    feats, scaler = train_set
    m = _rf(scaler, feats)
    L.save_pipeline(m, str(tmp_path / "rf"))
    back = L.load_pipeline(str(tmp_path / "rf"))
    new = feats.select("reading_id", *S.SENSORS)
    a = I.batch_score(m, new, "1", "champion", keep=("reading_id",), with_timestamp=False)
    b = I.batch_score(back, new, "1", "champion", keep=("reading_id",), with_timestamp=False)
    assert a.exceptAll(b).count() == 0 and a.count() == 1200


def test_kernel_svm_pipeline_roundtrip(spark, train_set, tmp_path):
    feats, scaler = train_set
    wsum = feats.agg(F.sum("weight")).first()[0]
    pipe = L.kernel_svm_pipeline(scaler, c=1.0, gamma=L.gamma_value("auto", len(S.FEATURES), 1.0),
                                 weight_sum=wsum, n_components=50)
    model = pipe.fit(L.prepare_training(feats))
    L.save_pipeline(model, str(tmp_path / "svm"))
    back = L.load_pipeline(str(tmp_path / "svm"))
    a = L.probabilities(model.transform(feats)).select("reading_id", "prob_class_1")
    b = L.probabilities(back.transform(feats)).select("reading_id", F.col("prob_class_1").alias("b"))
    j = a.join(b, "reading_id").toPandas()
    assert np.allclose(j.prob_class_1, j.b)
    auc = __import__("wearcast.operators.evaluate", fromlist=["x"]).roc_auc(
        L.probabilities(model.transform(feats)), label="target", score="prob_class_1").first()["auc"]
    assert auc > 0.8


def test_feature_importance_shares(train_set):
    feats, scaler = train_set
    imp = L.feature_importance(_rf(scaler, feats)).toPandas()
    assert len(imp) == 10 and imp["share"].sum() == pytest.approx(1.0)
    assert list(imp.sort_values("rank")["importance"]) == sorted(imp["importance"], reverse=True)


def test_gamma_scale():
    assert L.gamma_value("scale", 10, 2.0) == pytest.approx(0.05)
    assert L.gamma_value("auto", 10, 2.0) == pytest.approx(0.1)


def test_saved_pipeline_takes_raw_sensors(spark, train_set, tmp_path):
    feats, scaler = train_set
    m = _rf(scaler, feats)
    L.save_pipeline(m, str(tmp_path / "rf_raw"))
    raw = feats.select("reading_id", *S.SENSORS)  # no derived features at all
    a = L.probabilities(L.load_pipeline(str(tmp_path / "rf_raw")).transform(raw)).select("reading_id", "prob_class_1")
    b = L.probabilities(m.transform(feats)).select("reading_id", F.col("prob_class_1").alias("b"))
    j = a.join(b, "reading_id").toPandas()
    assert len(j) == 1200 and np.allclose(j.prob_class_1, j.b)


def test_stream_score_writes_predictions_and_stats_once(spark, train_set, tmp_path):
    from wearcast.streaming.files import file_stream, score_stream

    feats, scaler = train_set
    m = _rf(scaler, feats)
    src = str(tmp_path / "arrivals")
    feats.select("reading_id", *S.SENSORS).repartition(3).write.parquet(src)
    schema = "reading_id string, " + ", ".join(f"{c} double" for c in S.SENSORS)
    preds, stats, ckpt = str(tmp_path / "p"), str(tmp_path / "s"), str(tmp_path / "c")
    for _ in range(2):  # the second run finds no new file
        score_stream(file_stream(spark, src, schema), m, "1", "champion", preds, stats, ckpt, keep=("reading_id",))
    out = spark.read.parquet(preds)
    assert out.count() == 1200 and out.select("reading_id").distinct().count() == 1200
    st = spark.read.parquet(stats).where("metric = 'total_predictions'").agg(F.sum("value")).first()[0]
    assert st == 1200


def test_forest_and_boosted_pipelines_save_score_and_rank(spark, train_set, tmp_path):
    from wearcast.operators import trees as H

    feats, scaler = train_set
    ratio = L.class_ratio(feats)
    n = feats.groupBy("target").count().collect()
    n = {r["target"]: r["count"] for r in n}
    assert ratio == n[0] / n[1]
    models = {"forest": L.fit_forest(feats, scaler, H.Forest(trees=15, max_depth=6)),
              "boosted": L.fit_boosted(feats, scaler, H.Boosting(rounds=15, max_depth=5, learning_rate=0.4, scale_pos_weight=ratio))}
    for name, model in models.items():
        L.save_pipeline(model, str(tmp_path / name))
        back = L.load_pipeline(str(tmp_path / name))
        raw = feats.select("reading_id", *S.SENSORS)  # no derived features at all
        a = I.batch_score(model, raw, "1", "champion", keep=("reading_id",), with_timestamp=False)
        b = I.batch_score(back, raw, "1", "champion", keep=("reading_id",), with_timestamp=False)
        assert a.count() == 1200 and a.exceptAll(b).count() == 0
        got = a.join(feats.select("reading_id", "target"), "reading_id").toPandas()
        assert np.allclose(got.prob_class_0 + got.prob_class_1, 1) and ((got.prob_class_1 > 0.5) == got.predicted_class).all()
        assert (got.predicted_class == got.target).mean() > 0.97, name
        imp = L.feature_importance(model).toPandas()
        assert imp["share"].sum() == pytest.approx(1.0) and len(imp) == 10
        nodes = model.stages[-1].table(spark)
        assert nodes.select("tree").distinct().count() == 15
        inner, leaves = nodes.where("feature IS NOT NULL").count(), nodes.where("feature IS NULL").count()
        assert leaves == inner + 15
    # a heavier class 1 is found more often; the recorded run inverted the weight and lost it
    low = L.fit_boosted(feats, scaler, H.Boosting(rounds=15, max_depth=5, scale_pos_weight=1 / ratio))
    hits = [L.probabilities(m.transform(feats)).where("target = 1").agg(F.avg("predicted_class")).first()[0]
            for m in (models["boosted"], low)]
    assert hits[0] > hits[1]


def test_tuned_forest_scores_folds_and_predicts_out_of_fold(spark, train_set):
    feats, scaler = train_set
    folds = M.stratified_folds(feats)
    grid = [f for f in L.forest_grid() if f.max_depth == 10 and f.trees == 50]
    assert len(L.forest_grid()) == 16 == len(set(map(L.setting_name, L.forest_grid())))
    found = L.tune_forest(folds, scaler, grid)
    scores = found.scores.toPandas()
    assert len(scores) == len(grid) * 3 and set(scores.setting) == set(map(L.setting_name, grid))
    assert (scores.train_f1 >= scores.test_f1 - 0.05).all()
    held = L.probabilities(found.out_of_fold(folds)).select("fold", "target", "predicted_class").toPandas()
    assert len(held) == 1200
    best = scores[scores.setting == found.best].set_index("fold")
    for k, part in held.groupby("fold"):
        tp = ((part.target == 1) & (part.predicted_class == 1)).sum()
        f1 = 2 * tp / (2 * tp + (part.target != part.predicted_class).sum())
        assert best.test_f1[k] == pytest.approx(f1)
        assert best.test_accuracy[k] == pytest.approx((part.target == part.predicted_class).mean())
    top = found.table(top=2).collect()
    assert len(top) == 2 and top[0]["setting"] == found.best or top[0]["mean_test_f1"] == top[1]["mean_test_f1"]


def test_kernel_machine_pipeline_takes_class_from_the_weighted_margin(spark, train_set, tmp_path):
    feats, scaler = train_set
    model = L.fit_kernel_svm(feats, scaler, landmarks=150)
    assert model.stages[-1].kernelError < 0.1
    L.save_pipeline(model, str(tmp_path / "svm"))
    back = L.load_pipeline(str(tmp_path / "svm"))
    a, b = (L.probabilities(m.transform(feats)).select("reading_id", "target", "margin", "predicted_class", "prob_class_1")
            .toPandas().sort_values("reading_id", ignore_index=True) for m in (model, back))
    assert a.equals(b) and ((a.margin > 0) == (a.predicted_class == 1)).all()
    assert (a.predicted_class == a.target).mean() > 0.9
    plain = L.probabilities(L.fit_kernel_svm(feats, scaler, landmarks=150, weight_col=None).transform(feats)).toPandas()
    recall = [p[p.target == 1].predicted_class.mean() for p in (a, plain)]
    assert recall[0] >= recall[1]
    assert abs(a.prob_class_1.mean() - a.target.mean()) < 0.03  # calibrated to the unweighted share


def test_tuned_kernel_svm_scores_and_out_of_fold(spark, train_set):
    feats, scaler = train_set
    folds = M.stratified_folds(feats)
    found = L.tune_kernel_svm(folds, scaler, landmarks=80)
    scores = found.scores.toPandas()
    assert len(scores) == 12 and scores.setting.nunique() == 4 and found.best in set(scores.setting)
    held = found.out_of_fold(folds).select("fold", "target", "prediction").toPandas()
    for k, part in held.groupby("fold"):
        want = scores[(scores.setting == found.best) & (scores.fold == k)].test_accuracy.iloc[0]
        assert (part.target == part.prediction).mean() == pytest.approx(want, abs=0.003)


def test_kernel_search_and_refit_share_their_landmarks(spark, train_set, monkeypatch):
    feats, scaler = train_set
    drawn, plain = [], L.K.choose_points
    monkeypatch.setattr(L.K, "choose_points", lambda *a, **k: drawn.append(plain(*a, **k)) or drawn[-1])
    found = L.tune_kernel_svm(M.stratified_folds(feats), scaler, grid=[(1.0, "scale")], landmarks=20)
    assert len(drawn) == 1
    machine = L.K.Machine.from_json(found.model.stages[-1].getOrDefault("model"))
    assert np.array_equal(machine.points, drawn[0])


def test_permutation_importance_equals_a_plain_shuffle(spark, train_set):
    """Same permutation by sorting md5 values in one place; any partitioning; works for the kernel machine."""
    import hashlib

    from wearcast.plans.tree_checks import INPUTS, rule_model

    feats, scaler = train_set
    model = rule_model()
    got = L.permutation_importance(model, feats, seed=9).toPandas().set_index("feature")
    again = L.permutation_importance(model, feats.repartition(7), seed=9).toPandas().set_index("feature")
    assert got.equals(again) and sorted(got["rank"]) == [1, 2, 3, 4, 5]
    rows = model.stages[0].transform(feats).select("reading_id", "target", *INPUTS).toPandas()

    def order(name):
        return rows.iloc[np.argsort([hashlib.md5(f"{i}:9:{name}".encode()).hexdigest() for i in rows.reading_id])]

    a, b = order("rows").reset_index(drop=True), order("values").reset_index(drop=True)
    from wearcast.operators.trees import Scorer

    score = Scorer(model.stages[-1].getOrDefault(model.stages[-1].model))
    for c in INPUTS:
        x = a[INPUTS].copy()
        x[c] = b[c]
        assert got.accuracy[c] == pytest.approx((((score(x.to_numpy()) > 0.5) == a.target).mean()))
    svm = L.permutation_importance(L.fit_kernel_svm(feats, scaler, landmarks=60), feats)
    assert svm.count() == 10 and svm.orderBy("rank").first()["accuracy_drop"] > 0.02
    assert L.permutation_importance(model, feats.limit(0)).count() == 0
