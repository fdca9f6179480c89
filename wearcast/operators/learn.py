"""Learning (L1-L8) as saveable Spark ML pipelines.

The fitted scaler is frozen into a ``SQLTransformer`` (literals), so a saved
``PipelineModel`` carries scaling + model and scores batches and streams
unchanged.  Class weights travel as a ``weightCol``.

Forests and boosted trees are grown by ``trees`` (split minimum, second-order
boosting, ``scale_pos_weight``) and score as the stage ``HistogramTrees``.
MLlib's own tree estimators stay available: ``random_forest`` and
``boosted_trees`` (``n_estimators → numTrees``, ``max_depth → maxDepth`` up to
30, ``min_samples_leaf → minInstancesPerNode``; no ``min_samples_split``).
The RBF SVM is ``kernel`` (Nystroem landmarks with a measured error, class by
the weighted margin, cross-fitted Platt probabilities) and scores as the stage
``KernelMachine``.  The earlier approximation by random Fourier features
(Rahimi & Recht, 2007), ``LinearSVC`` and a logistic regression on the margin
stays available as ``kernel_svm_pipeline``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.features import FEATURE_SQL
from ..session import cut_lineage, ship_package
from . import kernel as K
from . import trees as H
from .prefix import running_totals

VEC = "features_vec"


# ------------------------------------------------------------- stages ---
SCALED = "s_"
DERIVED = "f_"


def feature_stage(prefix: str = DERIVED) -> SQLTransformer:
    """The five derived features recomputed from the sensors inside the
    pipeline (as ``f_<name>``), so a saved model scores raw readings."""
    cols = ", ".join(f"{expr} AS `{prefix}{name}`" for name, expr in FEATURE_SQL.items())
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def scaler_stage(params: Mapping[str, tuple[float, float]], prefix: str = SCALED,
                 derived_prefix: str | None = DERIVED) -> SQLTransformer:
    """``s_<c> = (c − mean) / scale`` with the fitted numbers as literals;
    derived features are read from the features stage's ``f_<c>``."""
    def src(c: str) -> str:
        return f"{derived_prefix}{c}" if derived_prefix and c in FEATURE_SQL else c

    cols = ", ".join(f"(`{src(c)}` - {float(m)!r}D) / {float(s)!r}D AS `{prefix}{c}`" for c, (m, s) in params.items())
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def model_pipeline(scaler: Mapping[str, tuple[float, float]], estimator, cols: Sequence[str] = S.FEATURES) -> Pipeline:
    """features → scaler (literals) → assembler → estimator: one saveable
    pipeline that takes raw sensor readings."""
    return Pipeline(stages=[feature_stage(), scaler_stage(scaler), assembler(cols), estimator])


def assembler(cols: Sequence[str] = S.FEATURES, out: str = VEC, prefix: str = SCALED) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"{prefix}{c}" for c in cols], outputCol=out, handleInvalid="keep")


def random_forest(num_trees: int = 100, max_depth: int = 10, min_leaf: int = 2, seed: int = 42,
                  weight_col: str | None = "weight", label: str = S.TARGET) -> RandomForestClassifier:
    if max_depth > 30:
        raise ValueError("Spark trees have at most 30 levels")
    rf = RandomForestClassifier(featuresCol=VEC, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed,
                                maxMemoryInMB=1024, cacheNodeIds=True)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def boosted_trees(max_iter: int = 100, max_depth: int = 6, step: float = 0.1, subsample: float = 0.8,
                  seed: int = 42, weight_col: str | None = "weight", label: str = S.TARGET) -> GBTClassifier:
    g = GBTClassifier(featuresCol=VEC, labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                      subsamplingRate=subsample, seed=seed)  # shallow trees: node-id caching only costs here
    if weight_col:
        g.setWeightCol(weight_col)
    return g


def prepare_training(df: DataFrame, partitions: int | None = None, id_col: str = "reading_id") -> DataFrame:
    """Tree learners depend on row placement: rows are dealt evenly (copies of
    one id do not meet in one task; Spark sorts before dealing, so a rerun
    deals alike) and sorted inside partitions, which makes fits reproducible.  Learners
    scan their input several times, so the prepared rows are written once
    to the shared checkpoint folder (lineage cut, survives executor loss)
    instead of re-running the feature/split plan on every pass."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    if id_col in df.columns:
        df = df.repartition(n).sortWithinPartitions(id_col)
    return cut_lineage(df)


def fit_pipeline(train: DataFrame, scaler: Mapping[str, tuple[float, float]], estimator,
                 cols: Sequence[str] = S.FEATURES) -> PipelineModel:
    """features → scaler (literals) → assembler → estimator, fitted on ``train``."""
    return model_pipeline(scaler, estimator, cols).fit(prepare_training(train))


# ------------------------------------------------------ histogram trees ---
class HistogramTrees(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble of ``trees``: adds ``probability`` (vector) and
    ``prediction`` (label 1 above one half).  The model is one text parameter,
    so the stage saves and loads with its pipeline."""

    model = Param(Params._dummy(), "model", "the ensemble as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, model=""):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def featureImportances(self):
        found = json.loads(self.getOrDefault(self.model))["trees"]
        return Vectors.dense(H.importances([H.Tree(feature=t["feature"], gain=t["gain"]) for t in found],
                                           len(self.getInputCols())))

    def table(self, spark) -> DataFrame:
        """The trees, one row per node."""
        return H.tree_table(spark, self.getOrDefault(self.model), self.getInputCols())

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        scorer = df.sparkSession.sparkContext.broadcast(H.Scorer(self.getOrDefault(self.model)))  # as large as the model

        @F.pandas_udf(T.DoubleType())
        def score(*series: pd.Series) -> pd.Series:
            return pd.Series(scorer.value(np.column_stack([s.to_numpy(dtype="float64") for s in series])))

        p = F.col("_p")
        return df.withColumn("_p", score(*[F.col(c).cast("double") for c in self.getInputCols()])).withColumns({
            "probability": array_to_vector(F.array(1 - p, p)),
            "prediction": (p > 0.5).cast("double")}).drop("_p")


def tree_pipeline(scaler: Mapping[str, tuple[float, float]], found: Sequence[H.Tree], data: H.Binned,
                  kind: str) -> PipelineModel:
    """features → scaler (literals) → fitted trees; takes raw sensor readings."""
    return PipelineModel(stages=[feature_stage(), scaler_stage(scaler),
                                 HistogramTrees(inputCols=data.cols, model=H.to_json(found, data.edges, kind))])


def bin_training(train: DataFrame, scaler: Mapping[str, tuple[float, float]], cols: Sequence[str] = S.FEATURES,
                 label: str = S.TARGET, weight_col: str | None = "weight", fold: str | None = None,
                 id_col: str = "reading_id") -> H.Binned:
    """Scaled training rows in bins: written once, read by every pass."""
    ready = PipelineModel(stages=[feature_stage(), scaler_stage(scaler)]).transform(train)
    return H.binned(ready, [f"{SCALED}{c}" for c in cols], label, weight_col, fold, id_col)


def fit_forest(train: DataFrame, scaler: Mapping[str, tuple[float, float]], settings: H.Forest | None = None,
               **columns) -> PipelineModel:
    """Random forest with class weights, bootstrap and a split minimum."""
    data = bin_training(train, scaler, **columns)
    try:
        return tree_pipeline(scaler, H.grow_forests(data, [(settings or H.Forest(), None)])[0], data, "forest")
    finally:
        data.release()


def fit_boosted(train: DataFrame, scaler: Mapping[str, tuple[float, float]], settings: H.Boosting | None = None,
                **columns) -> PipelineModel:
    """Second-order boosted trees; the classes are balanced by ``scale_pos_weight``, not by row weights."""
    data = bin_training(train, scaler, **{"weight_col": None, **columns})
    try:
        return tree_pipeline(scaler, H.boost(data, settings), data, "boosted")
    finally:
        data.release()


def class_ratio(train: DataFrame, label: str = S.TARGET) -> float:
    """Rows of label 0 per row of label 1: the usual ``scale_pos_weight``."""
    n = train.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
    return n["neg"] / n["pos"] if n["pos"] else 1.0


def forest_grid(seed: int = 2024) -> list[H.Forest]:
    """16 settings: depth × leaf minimum × split minimum × trees, in this order."""
    return [H.Forest(trees=t, max_depth=d, min_leaf=k, min_split=m, seed=seed)
            for d in (10, 15) for k in (1, 2) for m in (2, 5) for t in (50, 100)]


def setting_name(f: H.Forest) -> str:
    return f"max_depth={f.max_depth}, min_samples_leaf={f.min_leaf}, min_samples_split={f.min_split}, n_estimators={f.trees}"


def _f1(counts: Sequence[int]) -> float:
    _, fp, fn, tp = counts
    return 2 * tp / (2 * tp + fp + fn) if tp else 0.0


def _accuracy(counts: Sequence[int]) -> float:
    return (counts[0] + counts[3]) / sum(counts) if sum(counts) else 0.0


class Tuned:
    """A finished grid search: ``scores`` (setting, fold, train and test F1 of
    class 1, train and test accuracy), the ``best`` setting by mean test F1
    (first of equals), the ``model`` refitted on all rows, and predictions of
    every row by the model that did not see its fold."""

    def __init__(self, spark, names: list[str], rows: list[tuple], model: PipelineModel, fold_models: dict[int, PipelineModel]):
        self.scores = spark.createDataFrame(
            rows, "setting string, fold int, train_f1 double, test_f1 double, train_accuracy double, test_accuracy double")
        self.best, self.model, self.fold_models = best_name(names, rows), model, fold_models

    def out_of_fold(self, rows: DataFrame, fold: str = "fold") -> DataFrame:
        out = None
        for k, m in self.fold_models.items():
            part = m.transform(rows.where(F.col(fold) == k))
            out = part if out is None else out.unionByName(part)
        return out

    def table(self, top: int | None = None) -> DataFrame:
        """Mean and population std of train and test F1 per setting, best first."""
        agg = self.scores.groupBy("setting").agg(
            *[f(c).alias(f"{n}_{c}") for c in ("test_f1", "train_f1") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
        agg = agg.orderBy(F.desc("mean_test_f1"), "setting")
        return agg.limit(top) if top else agg


def best_name(names: Sequence[str], rows: Sequence[tuple]) -> str:
    mean = {n: [r[3] for r in rows if r[0] == n] for n in names}
    return max(names, key=lambda n: sum(mean[n]) / max(1, len(mean[n])))


def score_row(setting: str, fold: int, train: Sequence[int], test: Sequence[int]) -> tuple:
    return setting, int(fold), _f1(train), _f1(test), _accuracy(train), _accuracy(test)


def tune_forest(train_with_folds: DataFrame, scaler: Mapping[str, tuple[float, float]],
                grid: Sequence[H.Forest] | None = None, fold: str = "fold", **columns) -> Tuned:
    """Grid search over precomputed folds in one search: the forests of all
    folds and settings grow together, each fold is scored by its own, and the
    best setting is grown on all rows."""
    grid = list(grid or forest_grid())
    data = bin_training(train_with_folds, scaler, fold=fold, **columns)
    try:
        found = H.grid_search(data, grid)
        rows = [score_row(setting_name(f), k, found.train[f, k], found.test[f, k]) for f in grid for k in found.folds]
        name = best_name([setting_name(f) for f in grid], rows)
        best = next(f for f in grid if setting_name(f) == name)
        model = tree_pipeline(scaler, H.grow_forests(data, [(best, None)])[0], data, "forest")
        folds = {k: tree_pipeline(scaler, found.trees(best, k), data, "forest") for k in found.folds}
    finally:
        data.release()
    return Tuned(train_with_folds.sparkSession, [setting_name(f) for f in grid], rows, model, folds)


# ------------------------------------------------------- kernel approx ---
def rff_matrix(n_in: int, n_components: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """w ~ N(0, 2γ I) (D × d), b ~ U(0, 2π): fixed by the seed, so a saved
    stage only stores (gamma, D, seed)."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, n_in))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    return w, b


class RandomFourierFeatures(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """z(x) = sqrt(2/D)·cos(W x + b): an explicit feature map whose inner
    products approximate the RBF kernel exp(−γ‖x − y‖²) (Rahimi & Recht).

    A dense D×d product per row is what numpy does best: an Arrow-batched
    pandas UDF (one matmul per batch of rows), not per-row Python and not a
    D·d-term SQL projection (which overflows whole-stage codegen)."""

    gamma = Param(Params._dummy(), "gamma", "RBF width", typeConverter=TypeConverters.toFloat)
    nComponents = Param(Params._dummy(), "nComponents", "feature count D", typeConverter=TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "matrix seed", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, outputCol="rff", gamma=0.1, nComponents=300, seed=42):
        super().__init__()
        self._setDefault(outputCol="rff", gamma=0.1, nComponents=300, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        cols = self.getInputCols()
        w, b = rff_matrix(len(cols), self.getOrDefault(self.nComponents), self.getOrDefault(self.gamma),
                          self.getOrDefault(self.seed))
        k = math.sqrt(2.0 / w.shape[0])

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def rff(*series: pd.Series) -> pd.Series:
            x = np.column_stack([s.to_numpy(dtype="float64") for s in series])
            z = k * np.cos(x @ w.T + b)
            return pd.Series(list(z))

        return df.withColumn(self.getOutputCol(), array_to_vector(rff(*[F.col(c) for c in cols])))


class KernelMachine(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted machine of ``kernel``: adds ``margin``, ``prediction`` (label 1
    on the positive side of the margin) and ``probability`` (vector; Platt's
    curve, which may put its one half elsewhere than the margin's zero)."""

    model = Param(Params._dummy(), "model", "the machine as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, model=""):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def kernelError(self) -> float:
        """Mean of 1 - z(x).z(x) over the training rows."""
        return K.Machine.from_json(self.getOrDefault(self.model)).error

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        machine = K.Machine.from_json(self.getOrDefault(self.model))
        held = df.sparkSession.sparkContext.broadcast(machine)  # landmarks × features numbers

        @F.pandas_udf(T.DoubleType())
        def margin(*series: pd.Series) -> pd.Series:
            return pd.Series(held.value.margin(np.column_stack([s.to_numpy(dtype="float64") for s in series])))

        p = 1 / (1 + F.exp(machine.a * F.col("margin") + machine.b))
        return df.withColumn("margin", margin(*[F.col(c).cast("double") for c in self.getInputCols()])).withColumns({
            "probability": array_to_vector(F.array(1 - p, p)), "prediction": (F.col("margin") > 0).cast("double")})


def svm_pipeline(scaler: Mapping[str, tuple[float, float]], machine: K.Machine, cols: Sequence[str] = S.FEATURES) -> PipelineModel:
    return PipelineModel(stages=[feature_stage(), scaler_stage(scaler), KernelMachine(
        inputCols=[f"{SCALED}{c}" for c in cols], model=machine.to_json())])


def _svm_rows(train: DataFrame, scaler, cols, label, weight_col, fold=None, id_col="reading_id"):
    ready = PipelineModel(stages=[feature_stage(), scaler_stage(scaler)]).transform(train)
    return K.row_blocks(ready, [f"{SCALED}{c}" for c in cols], label, weight_col, fold, id_col)


def fit_kernel_svm(train: DataFrame, scaler: Mapping[str, tuple[float, float]], c: float = 1.0, gamma: str | float = "scale",
                   landmarks: int = 300, seed: int = 42, cols: Sequence[str] = S.FEATURES, label: str = S.TARGET,
                   weight_col: str | None = "weight") -> PipelineModel:
    """Weighted RBF support vector machine with probabilities."""
    width = gamma_value(gamma, len(cols), feature_variance(train, scaler, cols) if gamma == "scale" else 1.0)
    blocks = _svm_rows(train, scaler, cols, label, weight_col)
    try:
        return svm_pipeline(scaler, K.fit(blocks, width, c, landmarks, seed), cols)
    finally:
        blocks.unpersist()


def tune_kernel_svm(train_with_folds: DataFrame, scaler: Mapping[str, tuple[float, float]],
                    grid: Sequence[tuple[float, str]] | None = None, landmarks: int = 300, seed: int = 42,
                    cols: Sequence[str] = S.FEATURES, label: str = S.TARGET, weight_col: str | None = "weight") -> Tuned:
    """C × gamma over precomputed folds: all penalties and folds of a gamma are
    solved in the same passes and scored by the margin's class; the best
    setting is refitted with calibration, whose curve the fold machines take."""
    grid = list(grid or [(c, g) for c in (1.0, 10.0) for g in ("scale", "auto")])
    var = feature_variance(train_with_folds, scaler, cols)
    width = {g: gamma_value(g, len(cols), var) for _, g in grid}
    name = {(c, g): f"C={c:g}, gamma={g}" for c, g in grid}
    blocks = _svm_rows(train_with_folds, scaler, cols, label, weight_col, "fold")
    try:
        folds = sorted(set().union(*blocks.map(lambda b: set(b.fold.tolist())).collect()) - {-1})
        train, test, machines = K.grid_search(blocks, [(c, width[g]) for c, g in grid], folds, landmarks, seed)
        rows = [score_row(name[c, g], k, train[c, width[g], k], test[c, width[g], k]) for c, g in grid for k in folds]
        best = best_name(list(name.values()), rows)
        c, g = next(s for s in grid if name[s] == best)
        machine = K.fit(blocks, width[g], c, landmarks, seed, points=machines[c, width[g], folds[0]].points if folds else None)
    finally:
        blocks.unpersist()
    held = {}
    for k in folds:
        m = machines[c, width[g], k]
        m.a, m.b = machine.a, machine.b
        held[k] = svm_pipeline(scaler, m, cols)
    return Tuned(train_with_folds.sparkSession, list(name.values()), rows, svm_pipeline(scaler, machine, cols), held)


def gamma_value(gamma: str | float, n_features: int, x_var: float) -> float:
    """'scale' = 1/(d·Var(X)), 'auto' = 1/d, or a number."""
    if gamma == "scale":
        return 1.0 / (n_features * x_var) if x_var > 0 else 1.0
    if gamma == "auto":
        return 1.0 / n_features
    return float(gamma)


def kernel_svm_pipeline(scaler: Mapping[str, tuple[float, float]], c: float, gamma: float, weight_sum: float,
                        n_components: int = 300, seed: int = 42, cols: Sequence[str] = S.FEATURES,
                        label: str = S.TARGET, weight_col: str | None = "weight") -> Pipeline:
    """scaler → random Fourier features → LinearSVC (hinge, C mapped to
    regParam = 1/(C·Σw)) → Platt scaling (logistic regression on the
    margin) for probabilities."""
    rff = RandomFourierFeatures(inputCols=[f"{SCALED}{c}" for c in cols], outputCol="rff", gamma=gamma,
                                nComponents=n_components, seed=seed)
    # tol 1e-3 = the stopping tolerance of the libsvm solver being replaced
    svc = LinearSVC(featuresCol="rff", labelCol=label, regParam=1.0 / (c * weight_sum), standardization=False,
                    maxIter=100, tol=1e-3, rawPredictionCol="svm_margin", predictionCol="svm_prediction")
    if weight_col:
        svc.setWeightCol(weight_col)
    platt = LogisticRegression(featuresCol="svm_margin", labelCol=label, maxIter=100, regParam=0.0)
    return Pipeline(stages=[feature_stage(), scaler_stage(scaler), rff, svc, platt])


def feature_variance(df: DataFrame, scaler: Mapping[str, tuple[float, float]], cols: Sequence[str] = S.FEATURES) -> float:
    """Population variance of all scaled feature values together (the
    number gamma='scale' needs): one aggregation."""
    sums = df.agg(*[F.sum((F.col(c) - m) / s).alias(f"a{i}") for i, (c, (m, s)) in enumerate(
        (c, scaler[c]) for c in cols)],
        *[F.sum(((F.col(c) - scaler[c][0]) / scaler[c][1]) ** 2).alias(f"q{i}") for i, c in enumerate(cols)],
        F.count("*").alias("n")).first()
    n = sums["n"] * len(cols)
    if not n:
        return 0.0
    mean = sum(sums[f"a{i}"] for i in range(len(cols))) / n
    return sum(sums[f"q{i}"] for i in range(len(cols))) / n - mean * mean


# ------------------------------------------------------------- tuning ---
def f1_evaluator(label: str = S.TARGET, positive: float = 1.0) -> MulticlassClassificationEvaluator:
    """Class-1 F1 (the grid-search score; promotion uses weighted F1)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=positive)


def tune(train_with_folds: DataFrame, pipeline: Pipeline, grid: list, folds: int = S.CV_FOLDS,
         label: str = S.TARGET, parallelism: int = 4):
    """CrossValidator over precomputed stratified folds (``fold`` column);
    refits the best setting on all training rows."""
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=f1_evaluator(label),
                        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=2024)
    return cv.fit(prepare_training(train_with_folds))


def random_forest_grid(rf: RandomForestClassifier) -> list:
    """8 distinct settings: numTrees × maxDepth × minInstancesPerNode
    (the reference's min_samples_split axis has no Spark counterpart)."""
    return (ParamGridBuilder().addGrid(rf.numTrees, [50, 100]).addGrid(rf.maxDepth, [10, 15])
            .addGrid(rf.minInstancesPerNode, [1, 2]).addGrid(rf.featureSubsetStrategy, ["sqrt"]).build())


def kernel_svm_search(train: DataFrame, scaler: Mapping[str, tuple[float, float]], folds: int = S.CV_FOLDS,
                      n_components: int = 300) -> tuple[Pipeline, list, list[str]]:
    """(pipeline, grid, setting names) of C ∈ {1, 10} × gamma ∈ {scale, auto};
    the penalty is scaled to the weights that a fold's training rows have."""
    d = len(S.FEATURES)
    var = feature_variance(train, scaler)
    wsum = train.agg(F.sum("weight")).first()[0] * (folds - 1) / folds
    base = kernel_svm_pipeline(scaler, 1.0, 1.0 / d, wsum, n_components=n_components)
    rff, svc = base.getStages()[2], base.getStages()[3]
    grid, names = [], []
    for g in ("scale", "auto"):
        for c in (1.0, 10.0):
            grid.append({rff.gamma: gamma_value(g, d, var), svc.regParam: 1.0 / (c * wsum)})
            names.append(f"C={c:g}, gamma={g}")
    return base, grid, names


def best_setting(cv_model) -> dict:
    """The parameters of the best grid setting."""
    scores = cv_model.avgMetrics
    return cv_model.getEstimatorParamMaps()[max(range(len(scores)), key=scores.__getitem__)]


def cv_table(cv_model, names: Sequence[str] | None = None) -> DataFrame:
    """(setting, mean_score, std_score) from a fitted CrossValidatorModel;
    std is the population std over folds."""
    rows = []
    metrics = cv_model.avgMetrics
    stds = getattr(cv_model, "stdMetrics", None) or [float("nan")] * len(metrics)
    for i, pm in enumerate(cv_model.getEstimatorParamMaps()):
        label = names[i] if names else ", ".join(f"{p.name}={v}" for p, v in pm.items())
        rows.append((label, float(metrics[i]), float(stds[i])))
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().createDataFrame(rows, "setting string, mean_score double, std_score double")


def top_settings(scores: DataFrame, k: int = 5, setting: str = "setting") -> DataFrame:
    """Mean and population std of the fold scores per setting, best k."""
    agg = scores.groupBy(setting).agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))
    return agg.orderBy(F.desc("mean_score"), setting).limit(k)


def threshold_fold_scores(df: DataFrame, thresholds: Sequence[float], label: str = "y", score: str = "score",
                          fold: str = "fold") -> DataFrame:
    """Class-1 F1 per (threshold, fold) from stored scores in one
    aggregation (no fan-out of the rows per setting)."""
    y, s = F.col(label), F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        aggs += [F.count_if((y == 1) & (s > t)).alias(f"tp{i}"), F.count_if((y != 1) & (s > t)).alias(f"fp{i}"),
                 F.count_if((y == 1) & ~(s > t)).alias(f"fn{i}")]
    per_fold = df.groupBy(fold).agg(*aggs)
    items = []
    for i, t in enumerate(thresholds):
        den = 2 * F.col(f"tp{i}") + F.col(f"fp{i}") + F.col(f"fn{i}")
        f1 = F.when(den == 0, F.lit(0.0)).otherwise(2.0 * F.col(f"tp{i}") / den)
        items.append(F.struct(F.lit(float(t)).alias("setting"), F.col(fold).alias("fold"), f1.alias("score")))
    return per_fold.select(F.explode(F.array(*items)).alias("x")).select("x.*")


def cv_accuracy(folds: DataFrame, label: str = "y", prediction: str = "prediction", fold: str = "fold") -> DataFrame:
    """Mean / population std of per-fold accuracy over out-of-fold
    predictions."""
    per = folds.groupBy(fold).agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("acc"))
    return per.agg(F.avg("acc").alias("cv_accuracy_mean"), F.stddev_pop("acc").alias("cv_accuracy_std"),
                   F.count("*").alias("folds"))


def out_of_fold_predictions(cv_folds: DataFrame, pipeline: Pipeline, folds: int = S.CV_FOLDS) -> DataFrame:
    """Fit on k−1 folds, predict the held-out fold, for every fold."""
    out = None
    for f in range(folds):
        model = pipeline.fit(prepare_training(cv_folds.where(F.col("fold") != f)))
        pred = model.transform(cv_folds.where(F.col("fold") == f))
        out = pred if out is None else out.unionByName(pred)
    return out


# -------------------------------------------------------- importances ---
def feature_importance(model: PipelineModel, cols: Sequence[str] = S.FEATURES, top: int | None = None) -> DataFrame:
    """(feature, importance, share, rank): tree importances or |coef|."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        imp = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        imp = np.abs(last.coefficients.toArray())
    else:
        raise ValueError("model exposes no importances; permutation_importance works for any")
    if len(imp) != len(cols):
        raise ValueError(f"the last stage weighs {len(imp)} inputs, not the {len(cols)} features")
    tot = float(imp.sum()) or 1.0
    rows = [(c, float(v), float(v) / tot) for c, v in zip(cols, imp)]
    from pyspark.sql import SparkSession, Window

    df = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double, share double")
    df = df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))
    return df.where(F.col("rank") <= top) if top else df


def permutation_importance(model: PipelineModel, df: DataFrame, label: str = S.TARGET, id_col: str = "reading_id",
                           seed: int = 42) -> DataFrame:
    """(feature, accuracy, accuracy_drop, f1_drop, rank): how much worse the
    model scores when one of its inputs is shuffled, for any model.

    Rows are ranked exactly in two hash orders of their ids; a row takes the
    shuffled value from the row of equal rank in the other order.  So the
    result follows from ids and seed alone, whatever the partitioning, and no
    task holds a column.  All inputs are scored in one pass.  Rows without a
    label are left out; ids should be unique (equal ids are ordered by value)."""
    first = next(i for i, st in enumerate(model.stages) if st.hasParam("inputCols") and st.isDefined("inputCols"))
    inputs, tail = model.stages[first].getInputCols(), PipelineModel(stages=model.stages[first:])
    known = PipelineModel(stages=model.stages[:first]).transform(df.where(F.col(label).isNotNull()))
    known = cut_lineage(known.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"),
                                     *[F.col(f"`{c}`").alias(f"_v{i}") for i, c in enumerate(inputs)]))

    def ranked(order: str, names: list) -> DataFrame:
        hashed = known.withColumns({"_hash": F.md5(F.concat_ws(":", "_id", F.lit(seed), F.lit(order))), "_one": F.lit(1)})
        at = running_totals(hashed, [], ["_hash", "_id", *[f"_v{i}" for i in range(len(inputs))]], ["_one"])
        return at.select(F.col("_one_before").cast("long").alias("_rank"), *names)

    rows = ranked("rows", ["_label", *[f"_v{i}" for i in range(len(inputs))]])
    values = ranked("values", [F.col(f"_v{i}").alias(f"_p{i}") for i in range(len(inputs))])
    pairs = cut_lineage(rows.join(values, "_rank"))
    each = pairs.withColumn("_which", F.explode(F.sequence(F.lit(-1), F.lit(len(inputs) - 1))))
    each = each.select("_which", "_label", *[F.when(F.col("_which") == i, F.col(f"_p{i}")).otherwise(F.col(f"_v{i}")).alias(c)
                                             for i, c in enumerate(inputs)])
    hit, pos = F.col("prediction").cast("int"), F.col("_label") == 1
    n = tail.transform(each).groupBy("_which").agg(
        F.avg((hit == F.col("_label")).cast("double")).alias("accuracy"), F.count_if(pos & (hit == 1)).alias("tp"),
        F.count_if(hit != F.col("_label")).alias("wrong"))
    n = n.withColumn("f1", F.when(F.col("tp") == 0, 0.0).otherwise(2 * F.col("tp") / (2 * F.col("tp") + F.col("wrong"))))
    found = {r["_which"]: r for r in n.collect()}  # a row per input
    if not found:
        rows = []
    else:
        whole = found[-1]
        rows = [(c, found[i]["accuracy"], whole["accuracy"] - found[i]["accuracy"], whole["f1"] - found[i]["f1"])
                for i, c in enumerate(inputs)]
        rows.sort(key=lambda r: (-r[2], r[0]))
    return df.sparkSession.createDataFrame([(*r, k + 1) for k, r in enumerate(rows)],
                                           "feature string, accuracy double, accuracy_drop double, f1_drop double, rank int")


# ------------------------------------------------------------- scoring ---
def probabilities(pred: DataFrame, prob_col: str = "probability", pred_col: str = "prediction") -> DataFrame:
    """predicted_class, prob_class_0/1 and confidence = max probability."""
    arr = vector_to_array(F.col(prob_col))
    out = pred.withColumns({
        "predicted_class": F.col(pred_col).cast("int"),
        "prob_class_0": arr[0],
        "prob_class_1": arr[1],
    })
    return out.withColumn("confidence", F.greatest("prob_class_0", "prob_class_1"))


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
