"""Checked queries: evaluation, cross-validation summaries and the
registry (E1-E7, L5, L8, R1-R9), over the ``scored``, ``runs`` and
``model_versions`` views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import evaluate as E
from ..operators import registry as G
from ..operators import sampling as M
from ..sources import fixtures as X
from .book import register, rounded, with_ctes
from .prep_checks import split_cte
from .quality_checks import rows_sql

# Two "models" over the scored view: thresholds on the score.
MODELS = [("threshold_0.5", 0.5), ("threshold_0.3", 0.3)]
CV_SETTINGS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.scored(spark, sf_dir)


# ------------------------------------------------------------------ E1 ---
_CM = ("cm AS (SELECT CAST(count_if(y = 0 AND prediction = 0) AS BIGINT) AS tn, "
       "CAST(count_if(y = 0 AND prediction = 1) AS BIGINT) AS fp, "
       "CAST(count_if(y = 1 AND prediction = 0) AS BIGINT) AS fn, "
       "CAST(count_if(y = 1 AND prediction = 1) AS BIGINT) AS tp FROM scored)")


@register("confusion_matrix", with_ctes(X.SCORED_SQL, _CM, body="SELECT * FROM cm"))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confusion_matrix(_scored(spark, sf_dir))


# ------------------------------------------------------------- E2, E3 ---
def _binary_metrics_sql(cm: str) -> str:
    """CTE chain: cm (tn, fp, fn, tp, [keys]) → bm with per-class numbers."""
    return (
        f"pc AS (SELECT *, CAST(tn AS DOUBLE) AS dtn, CAST(fp AS DOUBLE) AS dfp, CAST(fn AS DOUBLE) AS dfn, "
        f"CAST(tp AS DOUBLE) AS dtp FROM {cm}),\n"
        "pc2 AS (SELECT *, CASE WHEN dtp + dfp = 0 THEN 0.0 ELSE dtp / (dtp + dfp) END AS p1, "
        "CASE WHEN dtp + dfn = 0 THEN 0.0 ELSE dtp / (dtp + dfn) END AS r1, "
        "CASE WHEN dtn + dfn = 0 THEN 0.0 ELSE dtn / (dtn + dfn) END AS p0, "
        "CASE WHEN dtn + dfp = 0 THEN 0.0 ELSE dtn / (dtn + dfp) END AS r0, "
        "dtn + dfp AS s0, dfn + dtp AS s1 FROM pc),\n"
        "bm AS (SELECT *, CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1, "
        "CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0 FROM pc2)"
    )


_METRIC_COLS = (
    "(dtp + dtn) / (s0 + s1) AS accuracy, (p0 * s0 + p1 * s1) / (s0 + s1) AS precision, "
    "(r0 * s0 + r1 * s1) / (s0 + s1) AS recall, (f0 * s0 + f1 * s1) / (s0 + s1) AS f1_score, "
    "p1 AS precision_failure, r1 AS recall_failure, f1 AS f1_failure"
)
_METRIC_NAMES = ["accuracy", "precision", "recall", "f1_score", "precision_failure", "recall_failure", "f1_failure"]


@register(
    "classification_metrics",
    with_ctes(X.SCORED_SQL, _CM, _binary_metrics_sql("cm"),
              body="SELECT " + ", ".join(f"round({n}, 6) AS {n}" for n in _METRIC_NAMES)
              + f" FROM (SELECT {_METRIC_COLS} FROM bm) m"),
)
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(E.classification_metrics(_scored(spark, sf_dir)))


@register(
    "classification_report",
    with_ctes(
        X.SCORED_SQL, _CM, _binary_metrics_sql("cm"),
        body="SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
        "round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM ("
        + rows_sql("bm", [
            {"label": "'0'", "precision": "p0", "recall": "r0", "f1_score": "f0", "support": "s0"},
            {"label": "'1'", "precision": "p1", "recall": "r1", "f1_score": "f1", "support": "s1"},
            {"label": "'macro avg'", "precision": "(p0 + p1) / 2", "recall": "(r0 + r1) / 2",
             "f1_score": "(f0 + f1) / 2", "support": "s0 + s1"},
            {"label": "'weighted avg'", "precision": "(p0 * s0 + p1 * s1) / (s0 + s1)",
             "recall": "(r0 * s0 + r1 * s1) / (s0 + s1)", "f1_score": "(f0 * s0 + f1 * s1) / (s0 + s1)",
             "support": "s0 + s1"},
            {"label": "'accuracy'", "precision": "CAST(NULL AS DOUBLE)", "recall": "CAST(NULL AS DOUBLE)",
             "f1_score": "(dtp + dtn) / (s0 + s1)", "support": "s0 + s1"},
        ]) + ") r",
    ),
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(E.classification_report(_scored(spark, sf_dir)))


# ------------------------------------------------------------- E4, E5 ---
_SCORE_AGG = ("sa AS (SELECT score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM scored "
              "WHERE score IS NOT NULL GROUP BY score)")


@register(
    "roc_auc",
    with_ctes(
        X.SCORED_SQL, _SCORE_AGG,
        "cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
        "AS neg_below FROM sa)",
        body="SELECT round(sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM cum",
    ),
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(E.roc_auc(_scored(spark, sf_dir)))


@register(
    "roc_curve",
    with_ctes(
        X.SCORED_SQL, _SCORE_AGG,
        "cum AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps, "
        "sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps, "
        "lead(pos) OVER (ORDER BY score DESC) AS pos_next, lead(neg) OVER (ORDER BY score DESC) AS neg_next, "
        "row_number() OVER (ORDER BY score DESC) AS rn, count(*) OVER () AS cnt FROM sa)",
        "tot AS (SELECT sum(pos) AS tp_all, sum(neg) AS fp_all FROM sa)",
        body="SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "
        "SELECT round(score, 6), round(fps / fp_all, 6), round(tps / tp_all, 6) FROM cum CROSS JOIN tot "
        "WHERE cnt <= 2 OR rn = 1 OR rn = cnt OR pos_next <> pos OR neg_next <> neg",
    ),
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(E.roc_curve(_scored(spark, sf_dir)))


# ------------------------------------------------------------- E6, E7 ---
def _by_model(rows: DataFrame, *keep: str) -> DataFrame:
    """Every model's prediction of every row, in one pass over the rows."""
    each = F.array(*[F.struct(F.lit(name).alias("model"), (F.col("score") > t).cast("int").alias("prediction"))
                     for name, t in MODELS])
    return rows.select(*keep, F.explode(each).alias("m")).select("m.model", *keep, "m.prediction")


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    sp = M.stratified_split(_scored(spark, sf_dir), target="y")  # exact split, shared by metrics and folds
    mets = E.classification_metrics(_by_model(sp, "split", "y"), by=["model", "split"])
    folds = M.stratified_folds(sp.where(F.col("split") == "train"), target="y")
    return E.model_comparison(mets, cv=E.classification_metrics(_by_model(folds, "fold", "y"), by=["model", "fold"]))


_SPLIT_SCORED = split_cte(source="scored", target="y", name="ssplit")


def _comparison_sql() -> tuple[str, ...]:
    preds = " UNION ALL ".join(
        f"SELECT '{name}' AS model, split, y, CAST(score > {t!r} AS INTEGER) AS prediction FROM ssplit"
        for name, t in MODELS
    )
    cm = ("mcm AS (SELECT model, split, count_if(y = 0 AND prediction = 0) AS tn, "
          "count_if(y = 0 AND prediction = 1) AS fp, count_if(y = 1 AND prediction = 0) AS fn, "
          "count_if(y = 1 AND prediction = 1) AS tp FROM preds GROUP BY model, split)")
    mets = f"mets AS (SELECT model, split, {_METRIC_COLS} FROM bm)"
    long = "long AS (" + " UNION ALL ".join(
        f"SELECT model, split, '{n}' AS metric, {n} AS value FROM mets" for n in _METRIC_NAMES) + ")"
    cmp_ = ("cmp AS (SELECT model, metric, max(CASE WHEN split = 'train' THEN value END) AS train, "
            "max(CASE WHEN split = 'test' THEN value END) AS test FROM long GROUP BY model, metric)")
    cmp2 = f"cmp2 AS (SELECT *, abs(train - test) AS gap, coalesce(abs(train - test) > {S.OVERFIT_GAP!r}, false) " \
           "AS overfit FROM cmp)"
    return (X.SCORED_SQL, _SPLIT_SCORED, f"preds AS ({preds})", cm, _binary_metrics_sql("mcm"), mets, long,
            cmp_, cmp2)


_FOLDS_SQL = ("folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY h, reading_id) - 1) % "
              f"{S.CV_FOLDS} AS INTEGER) AS fold FROM ssplit WHERE split = 'train')")


def _cv_sql() -> tuple[str, ...]:
    """Mean of every metric over the folds, as cvm (model, metric, cv)."""
    held = " UNION ALL ".join(f"SELECT '{name}' AS model, fold, y, CAST(score > {t!r} AS INTEGER) AS prediction FROM folds"
                              for name, t in MODELS)
    cm = ("fcm AS (SELECT model, fold, count_if(y = 0 AND prediction = 0) AS tn, count_if(y = 0 AND prediction = 1) AS fp, "
          "count_if(y = 1 AND prediction = 0) AS fn, count_if(y = 1 AND prediction = 1) AS tp FROM held GROUP BY model, fold)")
    chain = _binary_metrics_sql("fcm").replace("pc AS", "fpc AS").replace("pc2 AS", "fpc2 AS").replace(
        "FROM pc)", "FROM fpc)").replace("FROM pc2)", "FROM fpc2)").replace("bm AS", "fbm AS")
    long = "flong AS (" + " UNION ALL ".join(
        f"SELECT model, fold, '{n}' AS metric, {n} AS value FROM (SELECT model, fold, {_METRIC_COLS} FROM fbm)"
        for n in _METRIC_NAMES) + ")"
    return (_FOLDS_SQL, f"held AS ({held})", cm, chain, long,
            "cvm AS (SELECT model, metric, avg(value) AS cv FROM flong GROUP BY model, metric)")


@register(
    "model_comparison",
    with_ctes(*_comparison_sql(), *_cv_sql(), body="SELECT c.model, c.metric, round(train, 6) AS train, "
              "round(test, 6) AS test, round(gap, 6) AS gap, overfit, round(cv, 6) AS cv "
              "FROM cmp2 c JOIN cvm f ON c.model = f.model AND c.metric = f.metric"),
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(comparison(spark, sf_dir))


def _order_sql() -> str:
    return "ord AS (SELECT * FROM (VALUES " + ", ".join(
        f"('{n}', {i})" for i, (n, _) in enumerate(MODELS)) + ") AS t(model, position))"


def _best(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = spark.createDataFrame([(n, i) for i, (n, _) in enumerate(MODELS)], "model string, position int")
    return E.best_model(comparison(spark, sf_dir), order)


@register(
    "best_model",
    with_ctes(*_comparison_sql(), _order_sql(),
              "b AS (SELECT c.model, c.test AS f1_score, c.gap, c.overfit, row_number() OVER "
              "(ORDER BY c.test DESC, o.position) AS r FROM cmp2 c JOIN ord o ON c.model = o.model "
              "WHERE c.metric = 'f1_score')",
              body="SELECT model, round(f1_score, 6) AS f1_score, round(gap, 6) AS gap, overfit FROM b WHERE r = 1"),
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_best(spark, sf_dir))


@register(
    "production_gate",
    with_ctes(*_comparison_sql(), _order_sql(),
              "b AS (SELECT c.model, c.test AS f1_score, c.gap, c.overfit, row_number() OVER "
              "(ORDER BY c.test DESC, o.position) AS r FROM cmp2 c JOIN ord o ON c.model = o.model "
              "WHERE c.metric = 'f1_score')",
              body=f"SELECT model, round(f1_score, 6) AS f1_score, round(gap, 6) AS gap, overfit, "
              f"f1_score >= {S.PRODUCTION_MIN_F1!r} AS quality_passed, "
              f"f1_score >= {S.PRODUCTION_MIN_F1!r} AND gap <= {S.PRODUCTION_MAX_GAP!r} AS production_ready, "
              f"CASE WHEN f1_score >= {S.PRODUCTION_MIN_F1!r} THEN format('F1 ok: {{:.4f}}', f1_score) "
              f"ELSE format('F1 below minimum: {{:.4f}} < {S.PRODUCTION_MIN_F1!r}', f1_score) END || '; ' || "
              f"CASE WHEN gap <= {S.PRODUCTION_MAX_GAP!r} THEN format('no overfitting: gap {{:.4f}}', gap) "
              f"ELSE format('possible overfitting: gap {{:.4f}} > {S.PRODUCTION_MAX_GAP!r}', gap) END AS recommendations "
              "FROM b WHERE r = 1"),
)
def production_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(G.production_gate(_best(spark, sf_dir)))


# ------------------------------------------------------------- L5, L8 ---
def _train_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    sp = M.stratified_split(_scored(spark, sf_dir), target="y")
    return M.stratified_folds(sp.where(F.col("split") == "train"), target="y")


@register(
    "cv_accuracy",
    with_ctes(X.SCORED_SQL, _SPLIT_SCORED, _FOLDS_SQL,
              "fa AS (SELECT fold, avg(CASE WHEN prediction = y THEN 1.0 ELSE 0.0 END) AS acc FROM folds GROUP BY fold)",
              body="SELECT round(avg(acc), 6) AS cv_accuracy_mean, round(stddev_pop(acc), 6) AS cv_accuracy_std, "
              "CAST(count(*) AS BIGINT) AS folds FROM fa"),
)
def cv_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean/std of per-fold accuracy over stored out-of-fold predictions."""
    from ..operators.learn import cv_accuracy as cva

    return rounded(cva(_train_folds(spark, sf_dir)))


@register(
    "cv_results",
    with_ctes(
        X.SCORED_SQL, _SPLIT_SCORED, _FOLDS_SQL,
        "fs AS (" + " UNION ALL ".join(
            f"SELECT {t!r} AS setting, fold, count_if(y = 1 AND score > {t!r}) AS tp, "
            f"count_if(y <> 1 AND score > {t!r}) AS fp, count_if(y = 1 AND NOT score > {t!r}) AS fn "
            "FROM folds GROUP BY fold" for t in CV_SETTINGS) + ")",
        "ff AS (SELECT setting, fold, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END "
        "AS score FROM fs)",
        "agg AS (SELECT setting, avg(score) AS mean_score, stddev_pop(score) AS std_score FROM ff GROUP BY setting)",
        body="SELECT CAST(setting AS DOUBLE) AS setting, round(mean_score, 6) AS mean_score, "
        "round(std_score, 6) AS std_score FROM agg ORDER BY mean_score DESC, setting LIMIT 5",
    ),
)
def cv_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 settings (score thresholds) by mean class-1 F1 over the folds."""
    from ..operators.learn import threshold_fold_scores, top_settings

    scores = threshold_fold_scores(_train_folds(spark, sf_dir), CV_SETTINGS)
    return rounded(top_settings(scores, k=5))


# ------------------------------------------------------------ R1 .. R9 ---
_DECISIONS_SQL = (
    "dec AS (SELECT name, version, f1, greatest(coalesce(max(f1) OVER (PARTITION BY name ORDER BY version "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 0.0) AS champion_f1_before FROM model_versions)"
)


def _decisions(spark, sf_dir):
    return G.champion_decisions(X.model_versions(spark, sf_dir))


@register(
    "champion_decisions",
    with_ctes(X.MODEL_VERSIONS_SQL, _DECISIONS_SQL,
              body="SELECT name, version, f1, champion_f1_before, f1 > champion_f1_before AS promoted FROM dec"),
)
def champion_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir)


_ALIASES_SQL = (
    "dec2 AS (SELECT *, f1 > champion_f1_before AS promoted FROM dec)",
    "base AS (SELECT name, max(CASE WHEN promoted THEN version END) AS champion, max(version) AS candidate "
    "FROM dec2 GROUP BY name)",
    "prev AS (SELECT d.name, max(d.version) AS previous FROM dec2 d JOIN base b ON d.name = b.name "
    "WHERE d.promoted AND d.version < b.champion GROUP BY d.name)",
    "aliases AS (SELECT b.name, champion, previous, candidate FROM base b LEFT JOIN prev p ON b.name = p.name)",
)


@register("current_aliases", with_ctes(X.MODEL_VERSIONS_SQL, _DECISIONS_SQL, *_ALIASES_SQL,
                                       body="SELECT * FROM aliases"))
def current_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.current_aliases(_decisions(spark, sf_dir))


@register(
    "latest_versions",
    with_ctes(X.MODEL_VERSIONS_SQL, body="SELECT name, max(version) AS latest_version, "
              "arg_max(f1, version) AS f1, arg_max(stage, version) AS stage, arg_max(created, version) AS created "
              "FROM model_versions GROUP BY name"),
)
def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.latest_versions(X.model_versions(spark, sf_dir), fields=("stage", "created"))


@register(
    "serving_version",
    with_ctes(X.MODEL_VERSIONS_SQL, _DECISIONS_SQL, *_ALIASES_SQL,
              body="SELECT name, coalesce(champion, candidate) AS serving_version, champion IS NOT NULL AS is_champion "
              "FROM aliases"),
)
def serving_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.serving_version(G.current_aliases(_decisions(spark, sf_dir)))


@register(
    "registry_listing",
    with_ctes(X.MODEL_VERSIONS_SQL, _DECISIONS_SQL, *_ALIASES_SQL,
              "models AS (SELECT c_custkey AS name, c_name AS model_label FROM customer)",
              body="SELECT m.name, m.model_label, v.version, v.f1, v.source, v.run_id, v.status, v.tags, "
              "CASE WHEN v.version = a.champion THEN 'champion' WHEN v.version = a.previous THEN 'previous' "
              "WHEN v.version = a.candidate THEN 'candidate' END AS alias "
              "FROM models m LEFT JOIN (model_versions v LEFT JOIN aliases a ON v.name = a.name) ON m.name = v.name"),
)
def registry_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("name"), F.col("c_name").alias("model_label"))
    versions = X.model_versions(spark, sf_dir)
    aliases = G.current_aliases(G.champion_decisions(versions))
    fields = ("source", "run_id", "status", "tags")
    out = G.registry_listing(models, versions, aliases, fields=fields)
    return out.select("name", "model_label", "version", "f1", *fields, "alias")


_RECENT_SQL = (
    "ex AS (SELECT experiment FROM runs GROUP BY experiment ORDER BY min(start_time) DESC, experiment DESC LIMIT 1), "
    "er AS (SELECT * FROM runs WHERE experiment = (SELECT experiment FROM ex)), "
    "rr AS (SELECT * FROM er WHERE start_time >= (SELECT max(start_time) FROM er) - INTERVAL 600 MINUTE), "
    f"listed AS (SELECT * FROM rr ORDER BY start_time DESC, run_id DESC LIMIT {S.RUN_LIMIT})"
)


def _recent(spark, sf_dir, limit=None):
    """Runs of the newest experiment in its last hours; uncut unless listed."""
    return G.recent_runs(G.newest_experiment(X.runs(spark, sf_dir)), minutes=600, limit=limit)


@register("recent_runs", with_ctes(X.RUNS_SQL, _RECENT_SQL,
                                   body="SELECT run_id, start_time, algorithm, round(f1, 6) AS f1, experiment, status "
                                   "FROM listed"))
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_recent(spark, sf_dir, S.RUN_LIMIT).select("run_id", "start_time", "algorithm", "f1", "experiment", "status"))


@register(
    "main_run",
    with_ctes(X.RUNS_SQL, _RECENT_SQL,
              "hit AS (SELECT * FROM rr WHERE algorithm = 'purchase' ORDER BY start_time DESC, run_id DESC LIMIT 1)",
              body="SELECT (SELECT run_id FROM hit) AS run_id, round(coalesce((SELECT f1 FROM hit), 0.0), 6) AS f1, "
              "round(coalesce((SELECT accuracy FROM hit), 0.0), 6) AS accuracy, "
              "round(coalesce((SELECT train_test_gap FROM hit), 0.0), 6) AS train_test_gap, "
              "(SELECT best_model FROM hit) AS best_model, (SELECT run_name FROM hit) AS run_name, "
              "(SELECT status FROM hit) AS status"),
)
def main_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest recent run of the tagged kind ('purchase' events stand in for
    the comparison runs) with its metrics, best model, name and status."""
    return rounded(G.main_run(_recent(spark, sf_dir), tag_value="purchase", metrics=("f1", "accuracy", "train_test_gap"),
                              labels=("best_model", "run_name", "status")))


@register(
    "runs_per_algorithm",
    with_ctes(X.RUNS_SQL, _RECENT_SQL,
              body="SELECT algorithm, count(*) AS runs FROM rr WHERE algorithm IS NOT NULL GROUP BY algorithm"),
)
def runs_per_algorithm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.runs_per_algorithm(_recent(spark, sf_dir))
