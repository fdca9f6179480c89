"""Checked queries: the learners' steps and the scoring path, by value.

Boosting and forests run with one split a tree over given edges, so that SQL
can take the same steps over all rows: gradients, sums below every edge, best
gain, new margins.  Scoring runs with a rule model: three shallow trees with
given thresholds in the same pipeline stage that fitted models use."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import learn as L
from ..operators import score as I
from ..operators import trees as H
from ..sources import fixtures as X
from ..sources import readings as R
from .book import register, rounded, with_ctes
from .ingest_checks import FEATURES_SQL, type_l_features
from .model_checks import _new_readings

# ------------------------------------------------------- rule model ---
#: (input, threshold, up to it, above it) or a share of failures.
RULES = [
    ("tool_wear", 200.0, ("torque", 65.0, 0.02, 0.55), ("torque", 40.0, 0.3, 0.9)),
    ("f_estimated_power", 3500.0, 0.8, ("f_estimated_power", 9000.0, 0.05, 0.85)),
    ("f_temp_difference", 8.6, ("rotational_speed", 1380.0, 0.95, 0.1), 0.03),
]
INPUTS = ["rotational_speed", "torque", "tool_wear", "f_temp_difference", "f_estimated_power"]


def _tree(rule) -> dict:
    out = {"feature": [-1], "threshold": [0.0], "left": [-1], "value": [0.0], "gain": [0.0], "rows": [0]}

    def put(node: int, part) -> None:
        if not isinstance(part, tuple):
            out["value"][node] = part
            return
        left = len(out["left"])
        for column, first in (("feature", -1), ("threshold", 0.0), ("left", -1), ("value", 0.0), ("gain", 0.0), ("rows", 0)):
            out[column] += [first, first]
        out["feature"][node], out["threshold"][node], out["left"][node] = INPUTS.index(part[0]), part[1], left
        put(left, part[2])
        put(left + 1, part[3])

    put(0, rule)
    return out


def rule_model() -> PipelineModel:
    """features → rules: takes raw sensor readings."""
    text = json.dumps({"kind": "forest", "trees": [_tree(r) for r in RULES]})
    return PipelineModel(stages=[L.feature_stage(), L.HistogramTrees(inputCols=INPUTS, model=text)])


def _rule_sql(rule, column=lambda c: c.removeprefix("f_")) -> str:
    if not isinstance(rule, tuple):
        return f"CAST({rule!r} AS DOUBLE)"
    return (f"CASE WHEN {column(rule[0])} <= {rule[1]!r} THEN {_rule_sql(rule[2], column)} "
            f"ELSE {_rule_sql(rule[3], column)} END")


def _share_sql(column=lambda c: c.removeprefix("f_")) -> str:
    return "(" + " + ".join(_rule_sql(r, column) for r in RULES) + f") / {len(RULES)}"


def rule_scores_sql(*ctes: str, source: str) -> str:
    """The rule model's scores of all rows of a CTE with the sensors."""
    return with_ctes(
        *ctes, FEATURES_SQL.replace("FROM readings WHERE type = 'L'", f"FROM {source}"),
        f"p AS (SELECT *, {_share_sql()} AS p FROM features)",
        body="SELECT reading_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in S.FEATURES) + ", CAST(p > 0.5 AS INTEGER) AS "
        "predicted_class, round(1 - p, 6) AS prob_class_0, round(p, 6) AS prob_class_1, round(greatest(p, 1 - p), 6) AS confidence, "
        "'1' AS model_version, 'champion' AS model_stage FROM p")


RULE_SCORES_SQL = rule_scores_sql(X.READINGS_SQL, source="readings")


@register("rule_scores", RULE_SCORES_SQL)
def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading through the scoring path with the rule model."""
    return rounded(I.batch_score(rule_model(), _new_readings(spark, sf_dir), "1", "champion", keep=("reading_id",),
                                 with_timestamp=False))


@register("save_load_pipeline", RULE_SCORES_SQL)
def save_load_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save a pipeline to the shared folder, load it back, score every reading."""
    path = R.scratch_path(spark, "rule_pipeline")
    L.save_pipeline(rule_model(), path)
    return rounded(I.batch_score(L.load_pipeline(path), _new_readings(spark, sf_dir), "1", "champion", keep=("reading_id",),
                                 with_timestamp=False))


def _permuted_sql() -> str:
    def shuffled(name):
        return lambda c: ("v." if c == name else "r.") + c.removeprefix("f_")

    parts = []
    for name in ["", *INPUTS]:
        parts.append(f"SELECT '{name}' AS feature, avg(CAST(hit = y AS DOUBLE)) AS accuracy, count_if(y = 1 AND hit = 1) AS tp, "
                     f"count_if(hit <> y) AS wrong FROM (SELECT r.target AS y, CAST({_share_sql(shuffled(name))} > 0.5 AS "
                     "INTEGER) AS hit FROM r JOIN v ON r.k = v.k)")
    order = "row_number() OVER (ORDER BY md5(reading_id || ':42:{}'), reading_id)"
    return with_ctes(
        X.READINGS_SQL, FEATURES_SQL, "known AS (SELECT * FROM features WHERE target IS NOT NULL)",
        f"r AS (SELECT *, {order.format('rows')} AS k FROM known)", f"v AS (SELECT *, {order.format('values')} AS k FROM known)",
        "n AS (" + " UNION ALL ".join(parts) + ")",
        "f AS (SELECT *, CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + wrong) END AS f1 FROM n)",
        body="SELECT f.feature, round(f.accuracy, 6) AS accuracy, round(w.accuracy - f.accuracy, 6) AS accuracy_drop, "
        "round(CAST(w.f1 - f.f1 AS DOUBLE), 6) AS f1_drop, CAST(row_number() OVER (ORDER BY w.accuracy - f.accuracy DESC, f.feature) "
        "AS INTEGER) AS rank FROM f, f AS w WHERE w.feature = '' AND f.feature <> ''")


@register("permutation_importance", _permuted_sql())
def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score drop of the rule model on all type-L readings when an input is shuffled."""
    return rounded(L.permutation_importance(rule_model(), type_l_features(spark, sf_dir)))


# --------------------------------------------------- single splits ---
EDGES = {c: [lo + (hi - lo) * (i + 1) / 16 for i in range(15)] for c, (lo, hi) in S.SENSOR_BOUNDS.items()}
STUMPS = H.Boosting(rounds=3, max_depth=1, learning_rate=0.3, subsample=1.0, colsample_bytree=1.0, scale_pos_weight=2.0)


def _edged(spark: SparkSession, sf_dir: str) -> H.Binned:
    return H.binned(type_l_features(spark, sf_dir), S.SENSORS, S.TARGET, edges=[np.array(EDGES[c]) for c in S.SENSORS])


def _below(names: dict[str, str]) -> str:
    """Sums at or below every edge, a struct each, in (feature, edge) order."""
    out = []
    for f, c in enumerate(S.SENSORS):
        for b, e in enumerate(EDGES[c]):
            sums = ", ".join(f"'{n}': coalesce(sum({v}) FILTER ({c} <= {e!r}), 0)" for n, v in names.items())
            out.append(f"{{'feature': '{c}', 'place': {f * 100 + b}, 'threshold': CAST({e!r} AS DOUBLE), {sums}}}")
    return "[" + ", ".join(out) + "]"


def _stumps_sql() -> str:
    s, lam = STUMPS, STUMPS.reg_lambda
    ctes = [X.READINGS_SQL, FEATURES_SQL,
            f"r0 AS (SELECT {', '.join(S.SENSORS)}, target AS y, CAST(0 AS DOUBLE) AS m FROM features WHERE target IN (0, 1))"]
    for k in range(1, s.rounds + 1):
        ctes += [
            f"g{k} AS (SELECT *, CASE y WHEN 1 THEN {s.scale_pos_weight} ELSE 1.0 END * (1 / (1 + exp(-m)) - y) AS g, "
            f"CASE y WHEN 1 THEN {s.scale_pos_weight} ELSE 1.0 END * (1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m))) AS h "
            f"FROM r{k - 1})",
            f"c{k} AS (SELECT tg, th, unnest(e) AS e FROM (SELECT sum(g) AS tg, sum(h) AS th, {_below({'g': 'g', 'h': 'h'})} "
            f"AS e FROM g{k}))",
            f"s{k} AS (SELECT {k} AS round, e.feature AS feature, e.threshold AS threshold, 0.5 * (e.g * e.g / (e.h + {lam}) + "
            f"(tg - e.g) * (tg - e.g) / (th - e.h + {lam}) - tg * tg / (th + {lam})) AS gain, "
            f"-{s.learning_rate} * e.g / (e.h + {lam}) AS left_value, -{s.learning_rate} * (tg - e.g) / (th - e.h + {lam}) AS "
            f"right_value FROM c{k} WHERE e.h >= {s.min_child_weight} AND th - e.h >= {s.min_child_weight} "
            "ORDER BY gain DESC, e.place LIMIT 1)",
            f"r{k} AS (SELECT {', '.join(S.SENSORS)}, y, m + CASE WHEN CASE s.feature " + " ".join(
                f"WHEN '{c}' THEN {c}" for c in S.SENSORS) + f" END <= s.threshold THEN s.left_value ELSE s.right_value END AS m "
            f"FROM r{k - 1}, s{k} AS s)"]
    cols = "feature, threshold, round(gain, 3) AS gain, round(left_value, 6) AS left_value, round(right_value, 6) AS right_value"
    return with_ctes(*ctes, body=" UNION ALL ".join(f"SELECT CAST(round AS INTEGER) AS round, {cols} FROM s{k}"
                                                   for k in range(1, s.rounds + 1)))


@register("boosted_stumps", _stumps_sql())
def boosted_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of second-order boosting with one split each, on all type-L readings."""
    data = _edged(spark, sf_dir)
    rows = [(i + 1, data.cols[t.feature[0]], float(data.edges[t.feature[0]][t.bin[0]]), t.gain[0], t.value[1], t.value[2])
            for i, t in enumerate(H.boost(data, STUMPS)) if t.left[0] >= 0]
    data.release()
    out = spark.createDataFrame(rows, "round int, feature string, threshold double, gain double, left_value double, "
                                      "right_value double")
    return rounded(out).withColumn("gain", F.round("gain", 3))


_GINI_SQL = with_ctes(
    X.READINGS_SQL, FEATURES_SQL, "r AS (SELECT *, target AS y FROM features WHERE target IN (0, 1))",
    f"c AS (SELECT n, p, unnest(e) AS e FROM (SELECT count(*) AS n, sum(y) AS p, {_below({'n': '1', 'p': 'y'})} AS e FROM r))",
    "s AS (SELECT e.feature AS feature, e.threshold AS threshold, CAST(e.n AS DOUBLE) AS a, CAST(e.p AS DOUBLE) AS b, "
    "CAST(n - e.n AS DOUBLE) AS c, CAST(p - e.p AS DOUBLE) AS d, e.place AS place, CAST(n AS DOUBLE) AS n, CAST(p AS DOUBLE) AS p "
    "FROM c WHERE e.n >= 1 AND n - e.n >= 1)",
    body="SELECT feature, threshold, round(((a - b) * (a - b) + b * b) / a + ((c - d) * (c - d) + d * d) / c - ((n - p) * (n - p) + p * p) / n, 3) "
    "AS gain, round(b / a, 6) AS left_share, round(d / c, 6) AS right_share, CAST(a AS BIGINT) AS left_rows, "
    "CAST(c AS BIGINT) AS right_rows FROM s ORDER BY gain DESC, place LIMIT 1")


@register("gini_split", _GINI_SQL)
def gini_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first split of a forest's tree without bootstrap, over all sensors and type-L readings."""
    data = _edged(spark, sf_dir)
    t = H.grow_forests(data, [(H.Forest(trees=1, max_depth=1, min_split=2, min_leaf=1, features=len(S.SENSORS),
                                        bootstrap=False), None)])[0][0]
    rows = [(data.cols[t.feature[0]], float(data.edges[t.feature[0]][t.bin[0]]), t.gain[0], t.value[1], t.value[2], t.rows[1],
             t.rows[2])] if t.left[0] >= 0 else []
    data.release()
    out = spark.createDataFrame(rows, "feature string, threshold double, gain double, left_share double, right_share double, "
                                      "left_rows long, right_rows long")
    return rounded(out).withColumn("gain", F.round("gain", 3))
