"""End-to-end jobs: the three scheduled flows of the recorded system
(features, training, batch scoring) as Spark jobs over tables.

Hand-overs are tables in a base folder (shared storage on a cluster), not
CSV files between processes:

  <base>/features        feature table (parquet)
  <base>/registry        model versions: name, version, f1, algorithm, run_id
  <base>/runs            experiment runs: run_id, start_time, algorithm, f1
  <base>/models/<name>/<version>   saved pipelines (scaler + model)
  <base>/predictions     scored readings, partitioned by run_ts
  <base>/prediction_stats, <base>/alerts, <base>/processing_reports

    python -m wearcast.plans.jobs features --raw <csv-or-parquet> --base <dir>
    python -m wearcast.plans.jobs train --base <dir>
    python -m wearcast.plans.jobs score --new <csv-or-parquet> --base <dir>
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import select_sensors
from ..functions.features import extract_features
from ..operators import evaluate as E
from ..operators import learn as L
from ..operators import quality as Q
from ..operators import registry as G
from ..operators import sampling as M
from ..operators import scaling as T
from ..operators import score as I
from ..operators import trees as H
from ..sources import readings as R
from ..sources import sinks
from ..sources import versions as V
from ..session import cut_lineage

MODEL_NAME = "predictive_maintenance_model"


def with_id(df: DataFrame) -> DataFrame:
    """``reading_id`` at ingest: as given, else from the row number and product
    id of the raw file, else a hash of the whole row."""
    if "reading_id" in df.columns:
        return df
    parts = [c for c in ("udi", "product_id") if c in df.columns]
    if parts:
        return df.withColumn("reading_id", F.concat_ws("-", *[F.col(c).cast("string") for c in parts]))
    return df.withColumn("reading_id", F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def _read_any(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    if path.endswith(".csv") or "/csv" in path:
        return R.read_readings_csv(spark, path, ddl)
    return R.read_readings(spark, path)


def _maybe(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# ------------------------------------------------------------- features ---
def features_job(spark: SparkSession, raw: DataFrame, base: str, machine_type: str = "L",
                 min_rows: int = S.RAW_MIN_ROWS, enforce: bool = True) -> dict[str, DataFrame]:
    """Raw readings → type filter → raw gate → features → feature gate →
    feature table.  Gates raise on failed error checks when ``enforce``."""
    raw = with_id(raw)
    typed = R.filter_type(raw, machine_type) if "type" in raw.columns else raw
    keep = ("reading_id",)
    raw_gate = Q.raw_quality_gate(typed, min_rows=min_rows)  # duplicates over all columns
    if enforce:
        Q.enforce(raw_gate)
    feats = extract_features(typed, keep=keep)
    sinks.write_table(feats, f"{base}/features")
    table = spark.read.parquet(f"{base}/features")
    feat_gate = Q.feature_gate(table.drop(*keep))
    if enforce:
        Q.enforce(feat_gate)
    return {"raw_gate": raw_gate, "features": table, "feature_gate": feat_gate}


# ------------------------------------------------------------- training ---
def _fit(name: str, train: DataFrame, scaler: dict, tune: bool, grid_size: int | None):
    """(model fitted on all training rows, out-of-fold predictions).  Tuned:
    the best grid setting by class-1 F1 over stratified folds, refitted, and
    each fold's predictions by the search's own model of the other folds."""
    ratio = L.class_ratio(train)
    plain = {
        "random_forest": lambda rows: L.fit_forest(rows, scaler),
        "boosted_trees": lambda rows: L.fit_boosted(rows, scaler, H.Boosting(scale_pos_weight=ratio)),
        "kernel_svm": lambda rows: L.fit_kernel_svm(rows, scaler),
    }
    if name not in plain:
        raise ValueError(name)
    if not tune:
        return plain[name](train), None
    folds = cut_lineage(M.stratified_folds(train))
    if name == "random_forest":
        found = L.tune_forest(folds, scaler, L.forest_grid()[:grid_size])
    elif name == "kernel_svm":
        found = L.tune_kernel_svm(folds, scaler, [(c, g) for c in (1.0, 10.0) for g in ("scale", "auto")][:grid_size])
    else:  # one setting
        held = None
        for k in range(S.CV_FOLDS):
            part = plain[name](folds.where(F.col("fold") != k)).transform(folds.where(F.col("fold") == k))
            held = part if held is None else held.unionByName(part)
        return plain[name](train), held
    return found.model, found.out_of_fold(folds)


def training_job(spark: SparkSession, base: str, algorithms: tuple[str, ...] = ("random_forest", "kernel_svm"),
                 name: str = MODEL_NAME, min_rows: int = S.TRAINING_MIN_ROWS, id_col: str = "reading_id",
                 enforce: bool = True, tune: bool = True, grid_size: int | None = None) -> dict[str, DataFrame]:
    """Feature table → training gate → exact split → class weights and
    scaler (train rows) → grid search over stratified folds, refit and
    out-of-fold predictions for each algorithm → metrics on train, test and
    folds → comparison and best model → register one version per model,
    champion decisions and the production gate.  ``grid_size`` limits the
    search to the first settings; ``tune=False`` fits the defaults."""
    feats = spark.read.parquet(f"{base}/features")
    gate = Q.training_gate(feats.drop(id_col), min_rows=min_rows)
    if enforce:
        Q.enforce(gate)
    # materialised once: weights, scaler, every fit and every evaluation read it
    sp = cut_lineage(M.stratified_split(feats, id_col=id_col))
    train = sp.where(F.col("split") == "train")
    sp = M.attach_weights(sp, M.class_weights(train))
    train = sp.where(F.col("split") == "train")
    scaler = T.collect_scaler(T.scaler_fit(train))

    registry = _maybe(spark, f"{base}/registry")
    listed = 0 if registry is None else registry.where(F.col("name") == name).agg(F.max("version")).first()[0] or 0
    run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    metrics, held, new_versions, runs = None, None, [], []
    for algo in algorithms:
        model, out_of_fold = _fit(algo, train, scaler, tune, grid_size)
        version = V.claim_version(spark, base, name, listed)  # another training may run
        V.publish_model(spark, model, base, name, version)
        pred = cut_lineage(L.probabilities(model.transform(sp)).select("split", S.TARGET, "predicted_class", "prob_class_1"))
        m = E.classification_metrics(pred, label=S.TARGET, prediction="predicted_class", by=["split"])
        auc = E.roc_auc(pred, label=S.TARGET, score="prob_class_1", by=["split"])
        m = m.join(auc, "split").withColumn("model", F.lit(algo))
        metrics = m if metrics is None else metrics.unionByName(m)
        if out_of_fold is not None:
            folds = cut_lineage(L.probabilities(out_of_fold).select("fold", S.TARGET, "predicted_class"))
            f = E.classification_metrics(folds, label=S.TARGET, prediction="predicted_class", by=["fold"]).withColumn(
                "model", F.lit(algo))
            held = f if held is None else held.unionByName(f)
        test_f1 = m.where(F.col("split") == "test").first()["f1_score"]
        run_id = uuid.uuid4().hex
        new_versions.append((name, version, float(test_f1), algo, run_id))
        runs.append((run_id, run_ts, algo, float(test_f1), "model_training"))
    metrics = cut_lineage(metrics)  # a few rows per model; read by every output below
    held = cut_lineage(held) if held is not None else None
    comparison = E.model_comparison(metrics.drop("auc"), cv=held)
    order = spark.createDataFrame([(a, i) for i, a in enumerate(algorithms)], "model string, position int")
    best = E.best_model(comparison, order)
    gate_best = G.production_gate(best)

    versions = spark.createDataFrame(new_versions, "name string, version long, f1 double, algorithm string, "
                                                   "run_id string")
    V.append_rows(spark.createDataFrame(runs, "run_id string, start_time timestamp_ntz, algorithm string, f1 double, "
                                              "experiment_type string"), f"{base}/runs")
    V.append_rows(versions, f"{base}/registry")
    reg = spark.read.parquet(f"{base}/registry")
    decisions = G.champion_decisions(reg)
    aliases = G.current_aliases(decisions)
    return {"training_gate": gate, "metrics": metrics, "comparison": comparison, "best": best,
            "production_gate": gate_best, "decisions": decisions, "aliases": aliases}


# -------------------------------------------------------------- scoring ---
def serving_model(spark: SparkSession, base: str, name: str = MODEL_NAME):
    """Champion if there is one, else the newest version."""
    reg = spark.read.parquet(f"{base}/registry").where(F.col("name") == name)
    row = G.serving_version(G.current_aliases(G.champion_decisions(reg))).first()
    if row is None:
        raise ValueError(f"no registered versions of {name}")
    version = int(row["serving_version"])
    stage = "champion" if row["is_champion"] else "latest"
    return L.load_pipeline(f"{base}/models/{name}/{version}"), str(version), stage


def scoring_job(spark: SparkSession, new: DataFrame, base: str, name: str = MODEL_NAME,
                impute: bool = True, enforce: bool = True) -> dict[str, DataFrame]:
    """New readings → inference gate and out-of-range counts → (median
    imputation) → serving model (features, scaling, class) → predictions
    (run_ts partition) → processing report → statistics → alerts."""
    new = with_id(new)
    gate = Q.inference_gate(select_sensors(new, with_target=False))
    out_of_range = Q.out_of_range(select_sensors(new, with_target=False))
    original = new
    if enforce:
        Q.enforce(gate)
    if impute:
        new = Q.impute_median(new)
    model, version, stage = serving_model(spark, base, name)
    keep = tuple(c for c in ("reading_id",) if c in new.columns)
    run_ts = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    preds = I.batch_score(model, new, version, stage, keep=keep)
    sinks.write_table(preds, f"{base}/predictions", mode="append", run_ts=run_ts)
    written = spark.read.parquet(f"{base}/predictions").where(F.col("run_ts") == run_ts)
    report = Q.processing_report(select_sensors(original, with_target=False), written, S.FEATURES,
                                 Q.iqr_outliers(written, S.FEATURES))
    sinks.write_table(report, f"{base}/processing_reports", mode="append", run_ts=run_ts)
    stats = I.prediction_stats(written)
    alerts = I.inference_alerts(stats)
    sinks.write_table(stats, f"{base}/prediction_stats", mode="append", run_ts=run_ts)
    sinks.write_table(alerts, f"{base}/alerts", mode="append", run_ts=run_ts)
    return {"inference_gate": gate, "out_of_range": out_of_range, "predictions": written, "report": report,
            "stats": stats, "alerts": alerts}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="wearcast.plans.jobs")
    ap.add_argument("job", choices=["features", "train", "score"])
    ap.add_argument("--base", required=True)
    ap.add_argument("--raw")
    ap.add_argument("--new")
    ap.add_argument("--min-rows", type=int, default=S.RAW_MIN_ROWS)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    from ..session import ensure_checkpoint_dir, ship_package

    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if a.job == "features":
        out = features_job(spark, _read_any(spark, a.raw, S.RAW_CSV_DDL), a.base, min_rows=a.min_rows)
        out["feature_gate"].show(truncate=False)
    elif a.job == "train":
        out = training_job(spark, a.base)
        out["comparison"].show(truncate=False)
        out["production_gate"].show(truncate=False)
    else:
        out = scoring_job(spark, _read_any(spark, a.new, S.NEW_READINGS_DDL), a.base)
        out["alerts"].show(truncate=False)


if __name__ == "__main__":
    main()
