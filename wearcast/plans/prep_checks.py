"""Checked queries: split, folds, batch, weights, scalers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.features import extract_serving_features
from ..operators import quality as Q
from ..operators import sampling as M
from ..operators import scaling as T
from ..sources import fixtures as X
from ..sources import readings as R
from ..session import cut_lineage
from .book import register, rounded, with_ctes
from .ingest_checks import FEATURES_SQL, type_l_features
from .quality_checks import rows_sql

FEATS = S.FEATURES

def split_cte(source: str = "features", target: str = "target", id_col: str = "reading_id",
              seed: int = S.SPLIT_SEED, name: str = "split") -> str:
    """DuckDB: exact stratified split of ``source`` as CTEs ending in ``name``."""
    p = f"{name}_"
    return f"""
{p}k AS (SELECT *, md5({id_col} || ':{seed}') AS h FROM {source}),
{p}counts AS (SELECT {target} AS cls, count(*) AS n_c FROM {p}k GROUP BY {target}),
{p}c1 AS (SELECT cls, n_c, sum(n_c) OVER () AS big_n FROM {p}counts),
{p}c2 AS (SELECT *, big_n - ceil(CAST({S.SPLIT_TEST_SIZE!r} AS DOUBLE) * big_n) AS n_train_total FROM {p}c1),
{p}c3 AS (SELECT *, n_c / big_n * n_train_total AS cont FROM {p}c2),
{p}c4 AS (SELECT *, floor(cont) AS fl FROM {p}c3),
{p}c5 AS (SELECT *, n_train_total - sum(fl) OVER () AS need,
              row_number() OVER (ORDER BY cont - fl DESC, cls) AS pos FROM {p}c4),
{p}alloc AS (SELECT cls AS {target}, CAST(n_c AS BIGINT) AS n_c,
                 CAST(fl + CASE WHEN pos <= need THEN 1 ELSE 0 END AS BIGINT) AS n_train,
                 CAST(n_c - (fl + CASE WHEN pos <= need THEN 1 ELSE 0 END) AS BIGINT) AS n_test FROM {p}c5),
{name} AS (
  SELECT k.*, CASE WHEN row_number() OVER (PARTITION BY k.{target} ORDER BY h, {id_col}) <= a.n_test
                   THEN 'test' ELSE 'train' END AS split
  FROM {p}k k JOIN {p}alloc a ON k.{target} = a.{target}
)"""


SPLIT_SQL = split_cte()

SCALER_SQL = (
    "sc AS (SELECT "
    + ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in FEATS
    )
    + " FROM split WHERE split = 'train'),\n"
    + "scaled AS (SELECT reading_id, split, target, "
    + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in FEATS)
    + " FROM split CROSS JOIN sc)"
)


def split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.stratified_split(type_l_features(spark, sf_dir))


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split (materialised once: the fit and the transform both read it),
    scaler fitted on the train rows, applied to all rows as literals."""
    sp = cut_lineage(split_features(spark, sf_dir))
    stats = T.collect_scaler(T.scaler_fit(sp.where(F.col("split") == "train")))
    return T.scaler_literals(sp, stats).select("reading_id", "split", "target", *FEATS)


# ------------------------------------------------------------------ M1 ---
@register(
    "stratified_split",
    with_ctes(X.READINGS_SQL, FEATURES_SQL, SPLIT_SQL, body="SELECT reading_id, target, split FROM split"),
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_features(spark, sf_dir).select("reading_id", "target", "split")


@register(
    "split_sizes",
    with_ctes(X.READINGS_SQL, FEATURES_SQL, SPLIT_SQL, body="SELECT target, n_c, n_train, n_test FROM split_alloc"),
)
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class allocation of the exact split (largest remainder)."""
    counts = type_l_features(spark, sf_dir).groupBy("target").agg(F.count("*").alias("n_c"))
    return M.allocation(counts)


# ------------------------------------------------------------------ M2 ---
@register(
    "stratified_folds",
    with_ctes(
        X.READINGS_SQL, FEATURES_SQL, SPLIT_SQL,
        body="SELECT reading_id, target, CAST((row_number() OVER (PARTITION BY target ORDER BY h, reading_id) - 1) "
        f"% {S.CV_FOLDS} AS INTEGER) AS fold FROM split WHERE split = 'train'",
    ),
)
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = split_features(spark, sf_dir).where(F.col("split") == "train")
    return M.stratified_folds(train).select("reading_id", "target", "fold")


# ------------------------------------------------------------------ M3 ---
@register(
    "random_batch",
    with_ctes(
        X.READINGS_SQL,
        body="SELECT reading_id, " + ", ".join(S.SENSORS) + " FROM readings WHERE type = 'L' "
        f"ORDER BY md5(reading_id || ':{S.BATCH_SEED}'), reading_id LIMIT {S.BATCH_SIZE}",
    ),
)
def random_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = R.filter_type(X.readings(spark, sf_dir)).select("reading_id", *S.SENSORS, "target")
    return M.random_batch(src)


# ------------------------------------------------------------- M4, M5 ---
_WEIGHTS_SQL = (
    "w AS (SELECT target, count(*) AS count FROM features WHERE target IS NOT NULL GROUP BY target),\n"
    "weights AS (SELECT target, count, sum(count) OVER () / (count(*) OVER () * count) AS weight FROM w)"
)


@register(
    "class_weights",
    with_ctes(X.READINGS_SQL, FEATURES_SQL, _WEIGHTS_SQL,
              body="SELECT target, CAST(count AS BIGINT) AS count, round(weight, 6) AS weight FROM weights"),
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.class_weights(type_l_features(spark, sf_dir)))


@register(
    "attach_weights",
    with_ctes(X.READINGS_SQL, FEATURES_SQL, _WEIGHTS_SQL,
              body="SELECT reading_id, f.target, round(weight, 6) AS weight FROM features f "
              "LEFT JOIN weights w ON f.target = w.target"),
)
def attach_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = type_l_features(spark, sf_dir)
    return rounded(M.attach_weights(f.select("reading_id", "target"), M.class_weights(f)))


# ------------------------------------------------------------------ M6 ---
@register(
    "split_summary",
    with_ctes(
        X.READINGS_SQL, FEATURES_SQL, SPLIT_SQL, _WEIGHTS_SQL,
        "s AS (SELECT count(*) AS total, count_if(split = 'train') AS train, count_if(split = 'test') AS test, "
        "avg(target) AS pos FROM split)",
        "ww AS (SELECT max(CASE WHEN target = 0 THEN weight END) AS w0, max(CASE WHEN target = 1 THEN weight END) AS w1 "
        "FROM weights)",
        "sw AS (SELECT * FROM s CROSS JOIN ww)",
        body="SELECT metric, round(value, 6) AS value FROM (" + rows_sql("sw", [
            {"metric": "'dataset_size'", "value": "CAST(total AS DOUBLE)"},
            {"metric": "'n_features'", "value": f"CAST({len(FEATS)} AS DOUBLE)"},
            {"metric": "'train_size'", "value": "CAST(train AS DOUBLE)"},
            {"metric": "'test_size'", "value": "CAST(test AS DOUBLE)"},
            {"metric": "'failure_rate'", "value": "CAST(pos AS DOUBLE)"},
            {"metric": "'class_0_weight'", "value": "CAST(w0 AS DOUBLE)"},
            {"metric": "'class_1_weight'", "value": "CAST(w1 AS DOUBLE)"},
        ]) + ") x",
    ),
)
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = type_l_features(spark, sf_dir)
    return rounded(M.split_summary(M.stratified_split(f), M.class_weights(f), len(FEATS)))


# ------------------------------------------------------------- T1, T2 ---
@register(
    "scaler_fit",
    with_ctes(
        X.READINGS_SQL, FEATURES_SQL, SPLIT_SQL, SCALER_SQL,
        body=" UNION ALL ".join(f"SELECT '{c}' AS feature, round(m_{c}, 6) AS mean, round(s_{c}, 6) AS scale FROM sc"
                                for c in FEATS),
    ),
)
def scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    sp = split_features(spark, sf_dir)
    return rounded(T.scaler_fit(sp.where(F.col("split") == "train")))


@register(
    "scaler_transform",
    with_ctes(
        X.READINGS_SQL, FEATURES_SQL, SPLIT_SQL, SCALER_SQL,
        body="SELECT reading_id, split, target, " + ", ".join(f"round({c}, 6) AS {c}" for c in FEATS) + " FROM scaled",
    ),
)
def scaler_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scaled_features(spark, sf_dir))


# ------------------------------------------------------------------ T3 ---
@register(
    "robust_scaler",
    with_ctes(
        X.READINGS_SQL, FEATURES_SQL, SPLIT_SQL,
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(quantile_cont({c}, 0.5), 6) AS median, "
            f"round(CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 "
            f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END, 6) AS iqr FROM split WHERE split = 'train'"
            for c in FEATS
        ),
    ),
)
def robust_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    sp = split_features(spark, sf_dir)
    return rounded(T.robust_scaler_fit(sp.where(F.col("split") == "train")))


# ------------------------------------------------------------------ T4 ---
def _fixed_sql() -> str:
    exprs = {
        "air_temperature": "air_temperature",
        "process_temperature": "process_temperature",
        "rotational_speed": "rotational_speed",
        "torque": "torque",
        "tool_wear": "tool_wear",
        "temp_difference": "process_temperature - air_temperature",
        "estimated_power": "torque * rotational_speed * 2 * pi() / 60",
        "mechanical_stress": "torque / (rotational_speed + 1e-6)",
        "thermal_efficiency": "process_temperature / (air_temperature + 1e-6)",
        "wear_per_operation": "tool_wear / (rotational_speed + 1e-6)",
    }
    cols = ", ".join(
        f"round(({exprs[c]} - CAST({m!r} AS DOUBLE)) / CAST({s!r} AS DOUBLE), 6) AS {c}"
        for c, (m, s) in S.SERVING_SCALER.items()
    )
    return with_ctes(X.READINGS_SQL, body=f"SELECT reading_id, {cols} FROM readings")


@register("fixed_scaler", _fixed_sql())
def fixed_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = extract_serving_features(X.readings(spark, sf_dir), keep=("reading_id",))
    return rounded(T.fixed_scaler(f))


# ------------------------------------------------------------------ Q20 ---
def _report_sql() -> str:
    qs = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM scaled"
        for c in FEATS
    )
    outl = " + ".join(
        f"(SELECT count_if({c} < b.lo OR {c} > b.hi) FROM scaled CROSS JOIN "
        f"(SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q WHERE feature = '{c}') b)"
        for c in FEATS
    )
    nul = "CAST(NULL AS VARCHAR)"
    items = [
        {"metric": "'original_samples'", "key": nul, "value": "CAST(o_rows AS DOUBLE)"},
        {"metric": "'processed_samples'", "key": nul, "value": "CAST(p_rows AS DOUBLE)"},
        {"metric": "'features_count'", "key": nul, "value": f"CAST({len(FEATS)} AS DOUBLE)"},
        {"metric": "'missing_values'", "key": nul, "value": "CAST(o_missing AS DOUBLE)"},
    ]
    for c in FEATS:
        for m in ("mean", "std", "min", "max"):
            items.append({"metric": f"'{m}'", "key": f"'{c}'", "value": f"CAST({m}_{c} AS DOUBLE)"})
    items.append({"metric": "'outliers_detected'", "key": nul, "value": "CAST(outl AS DOUBLE)"})
    return with_ctes(
        X.READINGS_SQL, FEATURES_SQL, SPLIT_SQL, SCALER_SQL,
        "o AS (SELECT count(*) AS o_rows, " + " + ".join(f"count_if({c} IS NULL)" for c in S.SENSORS)
        + " AS o_missing FROM readings WHERE type = 'L')",
        "p AS (SELECT count(*) AS p_rows, " + ", ".join(
            f"avg({c}) AS mean_{c}, stddev_samp({c}) AS std_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}"
            for c in FEATS) + " FROM scaled)",
        f"q AS ({qs})",
        f"op AS (SELECT *, {outl} AS outl FROM o CROSS JOIN p)",
        body="SELECT metric, key, round(value, 6) AS value FROM (" + rows_sql("op", items) + ") x",
    )


@register("processing_report", _report_sql())
def processing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = R.filter_type(X.readings(spark, sf_dir)).select(*S.SENSORS)
    scaled = scaled_features(spark, sf_dir)
    outl = Q.iqr_outliers(scaled, FEATS)
    return rounded(Q.processing_report(original, scaled, FEATS, outl))
