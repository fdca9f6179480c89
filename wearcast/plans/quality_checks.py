"""Checked queries: quality profiles and gates (Q1-Q19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import select_sensors
from ..operators import quality as Q
from ..sources import fixtures as X
from ..sources import readings as R
from .book import register, rounded, with_ctes
from .ingest_checks import FEATURES_SQL, type_l_features

DIRTY_COLS = ["reading_id", "type", *S.SENSORS, "target"]


def rows_sql(source: str, items: list[dict[str, str]], where: str | None = None) -> str:
    """UNION ALL of one SELECT per item over a one-row source."""
    sel = " UNION ALL ".join(
        "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in it.items()) + f" FROM {source}"
        for it in items
    )
    return f"SELECT * FROM ({sel}) AS u" + (f" WHERE {where}" if where else "")


def checks_sql(source: str, specs: list[tuple[str, str, float | None, float | None, str]]) -> str:
    items = []
    for name, expr, lo, hi, sev in specs:
        v = f"CAST({expr} AS DOUBLE)"
        conds = []
        if lo is not None:
            conds.append(f"{v} >= {float(lo)!r}")
        if hi is not None:
            conds.append(f"{v} <= {float(hi)!r}")
        ok = " AND ".join(conds) if conds else "true"
        items.append({
            "check": f"'{name}'",
            "value": f"round({v}, 6)",
            "lower": f"CAST({'NULL' if lo is None else repr(float(lo))} AS DOUBLE)",
            "upper": f"CAST({'NULL' if hi is None else repr(float(hi))} AS DOUBLE)",
            "severity": f"'{sev}'",
            "passed": f"coalesce({ok}, false)",
        })
    return rows_sql(source, items)


def _dirty(spark, sf_dir) -> DataFrame:
    return X.readings_dirty(spark, sf_dir)


def _features_only(spark, sf_dir) -> DataFrame:
    return type_l_features(spark, sf_dir).drop("reading_id")


# ------------------------------------------------------------------ Q1 ---
_NULL_SQL = with_ctes(
    X.READINGS_DIRTY_SQL,
    "c AS (SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in DIRTY_COLS) + " FROM readings_dirty)",
    body=rows_sql(
        "c",
        [{"column_name": f"'{c}'", "null_count": f"CAST({c} AS BIGINT)"} for c in DIRTY_COLS]
        + [{"column_name": "'*'", "null_count": "CAST(" + " + ".join(DIRTY_COLS) + " AS BIGINT)"}],
        where="null_count > 0",
    ),
)


@register("null_counts", _NULL_SQL)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.null_counts(_dirty(spark, sf_dir))


# ------------------------------------------------------------ Q2, Q3 ---
@register(
    "duplicate_count",
    with_ctes(
        X.READINGS_DIRTY_SQL,
        body="SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates, CAST(coalesce(sum(n), 0) AS BIGINT) "
        "AS total_rows FROM (SELECT count(*) AS n FROM readings_dirty GROUP BY " + ", ".join(DIRTY_COLS) + ") g",
    ),
)
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_count(_dirty(spark, sf_dir))


@register("deduplicate", with_ctes(X.READINGS_DIRTY_SQL, body="SELECT DISTINCT * FROM readings_dirty"))
def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.deduplicate(_dirty(spark, sf_dir))


# ------------------------------------------------------------ Q4 .. Q7 ---
def _profile_sql(stats: list[tuple[str, str]], source_cte: str, cols: list[str], table: str, where: str = "") -> str:
    body = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, " + ", ".join(f"round({fn}({c}), 6) AS {name}" for name, fn in stats)
        + f" FROM {table} {where}"
        for c in cols
    )
    return with_ctes(*source_cte, body=body)


@register(
    "sensor_profile",
    _profile_sql([("min", "min"), ("max", "max"), ("mean", "avg")], [X.READINGS_SQL], S.SENSORS, "readings",
                 "WHERE type = 'L'"),
)
def sensor_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.sensor_profile(R.filter_type(X.readings(spark, sf_dir))))


@register(
    "sensor_ranges",
    _profile_sql([("min", "min"), ("max", "max")], [X.READINGS_SQL], S.SENSORS, "readings", "WHERE type = 'L'"),
)
def sensor_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.sensor_ranges(R.filter_type(X.readings(spark, sf_dir))))


@register(
    "target_distribution",
    with_ctes(X.READINGS_SQL, body="SELECT target, count(*) AS count FROM readings WHERE type = 'L' "
              "AND target IS NOT NULL GROUP BY target"),
)
def target_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.target_distribution(R.filter_type(X.readings(spark, sf_dir)))


@register(
    "failure_rate",
    with_ctes(X.READINGS_SQL, body="SELECT round(avg(target), 6) AS failure_rate FROM readings WHERE type = 'L'"),
)
def failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.failure_rate(R.filter_type(X.readings(spark, sf_dir))))


# ------------------------------------------------------------------ Q8 ---
_RAW_SPECS = [
    ("required_columns_missing", "0", None, 0, "error"),
    ("total_samples", "rows", S.RAW_MIN_ROWS, None, "error"),
    ("failure_rate", "rate", S.RAW_FAILURE_RATE[0], S.RAW_FAILURE_RATE[1], "warn"),
    ("missing_values", "missing", None, 0, "warn"),
    ("duplicates", "duplicates", None, None, "info"),
] + [(f"{c}_{m}", f"{m}_{c}", None, None, "info") for c in S.SENSORS for m in ("min", "max")]
# the Spark side lists mins/maxes per sensor as (min, max) pairs in order
_RAW_SPECS = _RAW_SPECS[:5] + [s for c in S.SENSORS for s in _RAW_SPECS[5:] if s[0].startswith(c + "_")]

_RAW_GATE_SQL = with_ctes(
    X.READINGS_SQL,
    "l AS (SELECT * FROM readings WHERE type = 'L')",
    "s AS (SELECT count(*) AS rows, avg(target) AS rate, "
    + " + ".join(f"count_if({c} IS NULL)" for c in [*S.SENSORS, "target"])
    + " AS missing, "
    + ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in S.SENSORS)
    + " FROM l)",
    "d AS (SELECT coalesce(sum(n - 1), 0) AS duplicates FROM (SELECT *, count(*) AS n FROM l GROUP BY ALL) g)",
    "sd AS (SELECT * FROM s CROSS JOIN d)",
    body=checks_sql("sd", _RAW_SPECS),
)


def _rounded_checks(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.round("value", 6))


@register("raw_quality_gate", _RAW_GATE_SQL)
def raw_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_checks(Q.raw_quality_gate(R.filter_type(X.readings(spark, sf_dir))))


# ------------------------------------------------------------- Q9, Q10 ---
_F5 = S.FEATURES
_FP_STATS = with_ctes(
    X.READINGS_SQL,
    FEATURES_SQL,
    "f AS (SELECT " + ", ".join(S.FEATURES) + ", target FROM features)",
    "s AS (SELECT count(*) AS rows, "
    + " + ".join(f"count_if({c} IS NULL OR isnan({c}))" for c in S.FEATURES) + " AS nan_cells, "
    + " + ".join(f"count_if(abs({c}) = 'inf'::DOUBLE)" for c in S.FEATURES) + " AS inf_cells, "
    + "avg(target) AS rate, "
    + ", ".join(f"avg({c}) AS mean_{c}, stddev_samp({c}) AS std_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}"
                for c in _F5)
    + " FROM f)",
    "dist AS (SELECT target, count(*) AS n FROM f WHERE target IS NOT NULL GROUP BY target)",
    body="",
)


def _fp_body() -> str:
    nul = "CAST(NULL AS VARCHAR)"
    items = [
        {"metric": "'rows'", "key": nul, "value": "CAST(rows AS DOUBLE)"},
        {"metric": "'columns'", "key": nul, "value": f"CAST({len(S.FEATURES) + 1} AS DOUBLE)"},
        {"metric": "'feature_count'", "key": nul, "value": f"CAST({len(S.FEATURES)} AS DOUBLE)"},
        {"metric": "'nan_cells'", "key": nul, "value": "CAST(nan_cells AS DOUBLE)"},
        {"metric": "'inf_cells'", "key": nul, "value": "CAST(inf_cells AS DOUBLE)"},
        {"metric": "'failure_rate'", "key": nul, "value": "rate"},
    ]
    for c in _F5:
        for m in ("mean", "std", "min", "max"):
            items.append({"metric": f"'{m}'", "key": f"'{c}'", "value": f"CAST({m}_{c} AS DOUBLE)"})
    main = rows_sql("s", items)
    return (
        f"SELECT metric, key, round(value, 6) AS value FROM ({main} "
        f"UNION ALL SELECT 'unique_classes', {nul}, CAST(count(*) AS DOUBLE) FROM dist "
        f"UNION ALL SELECT 'target_count', CAST(target AS VARCHAR), CAST(n AS DOUBLE) FROM dist) AS x"
    )


@register("feature_profile", _FP_STATS + _fp_body())
def feature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.feature_profile(_features_only(spark, sf_dir)))


_FG_SPECS = [
    ("target_missing", "0", None, 0, "error"),
    ("feature_count", f"{len(S.FEATURES)}", S.FEATURE_MIN_COUNT, None, "error"),
    ("unique_classes", "coalesce(classes, 0)", 2, 2, "error"),
    ("failure_rate", "rate", S.FEATURE_FAILURE_RATE[0], S.FEATURE_FAILURE_RATE[1], "warn"),
    ("nan_cells", "nan_cells", None, 0, "warn"),
    ("inf_cells", "inf_cells", None, 0, "warn"),
    ("expected_features_missing", "0", None, 0, "warn"),
]


@register(
    "feature_gate",
    _FP_STATS + " , g AS (SELECT s.*, (SELECT count(*) FROM dist) AS classes FROM s) " + checks_sql("g", _FG_SPECS),
)
def feature_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_checks(Q.feature_gate(_features_only(spark, sf_dir)))


# ------------------------------------------------------------ Q11, Q12 ---
@register(
    "training_gate",
    with_ctes(
        X.READINGS_SQL,
        FEATURES_SQL,
        "s AS (SELECT count(*) AS rows, "
        + " + ".join(f"count_if({c} IS NULL)" for c in [*S.FEATURES, "target"])
        + " AS missing FROM features)",
        body=checks_sql("s", [("total_samples", "rows", S.TRAINING_MIN_ROWS, None, "error"),
                              ("target_missing", "0", None, 0, "error"),
                              ("missing_values", "missing", None, None, "info")]),
    ),
)
def training_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_checks(Q.training_gate(_features_only(spark, sf_dir)))


@register(
    "inference_gate",
    with_ctes(
        X.READINGS_DIRTY_SQL,
        "s AS (SELECT count(*) AS rows, "
        + " + ".join(f"count_if({c} IS NULL)" for c in S.SENSORS)
        + " AS missing FROM readings_dirty)",
        body=checks_sql("s", [("total_samples", "rows", 1, None, "error"),
                              ("missing_cells_per_row", "CASE WHEN rows > 0 THEN missing / rows ELSE 0.0 END",
                               None, S.INFERENCE_MAX_MISSING_PER_ROW, "error"),
                              ("missing_values", "missing", None, None, "info")]),
    ),
)
def inference_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_checks(Q.inference_gate(select_sensors(_dirty(spark, sf_dir), with_target=False)))


# ------------------------------------------------------------------ Q13 ---
@register(
    "out_of_range",
    with_ctes(
        X.READINGS_DIRTY_SQL,
        "s AS (SELECT " + ", ".join(
            f"count_if({c} < {lo!r} OR {c} > {hi!r}) AS o_{c}" for c, (lo, hi) in S.SENSOR_BOUNDS.items()
        ) + " FROM readings_dirty)",
        body=rows_sql("s", [{"feature": f"'{c}'", "lower": f"CAST({lo!r} AS DOUBLE)", "upper": f"CAST({hi!r} AS DOUBLE)",
                             "out_of_range": f"CAST(o_{c} AS BIGINT)"} for c, (lo, hi) in S.SENSOR_BOUNDS.items()]),
    ),
)
def out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.out_of_range(_dirty(spark, sf_dir))


# ------------------------------------------------------------------ Q14 ---
@register(
    "impute_median",
    with_ctes(
        X.READINGS_DIRTY_SQL,
        "m AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in S.SENSORS) + " FROM readings_dirty)",
        body="SELECT reading_id, type, " + ", ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}" for c in S.SENSORS)
        + ", target FROM readings_dirty CROSS JOIN m",
    ),
)
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.impute_median(_dirty(spark, sf_dir)))


# ------------------------------------------------------------------ Q15 ---
def _iqr_sql() -> str:
    qs = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM features"
        for c in S.FEATURES
    )
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count_if({c} < b.lo OR {c} > b.hi) AS n, count(*) AS total "
        f"FROM features CROSS JOIN (SELECT lo, hi FROM b WHERE feature = '{c}') b"
        for c in S.FEATURES
    )
    return with_ctes(
        X.READINGS_SQL,
        FEATURES_SQL,
        f"q AS ({qs})",
        "b AS (SELECT feature, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)",
        f"c AS ({counts})",
        body="SELECT b.feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, "
        "round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound, CAST(n AS BIGINT) AS n_outliers, "
        "round(n * 100.0 / total, 6) AS outlier_pct FROM b JOIN c ON b.feature = c.feature",
    )


@register("iqr_outliers", _iqr_sql())
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.iqr_outliers(type_l_features(spark, sf_dir), S.FEATURES))


# ------------------------------------------------------------ Q16 .. Q18 ---
def _corr_sql(where: str = "") -> str:
    feats = S.FEATURES
    pairs = [(i, j) for i in range(len(feats)) for j in range(i, len(feats))]
    s = "s AS (SELECT " + ", ".join(f"corr({feats[i]}, {feats[j]}) AS c{i}_{j}" for i, j in pairs) + " FROM features)"
    items = []
    for i, a in enumerate(feats):
        for j, b in enumerate(feats):
            items.append({"feature_a": f"'{a}'", "feature_b": f"'{b}'", "corr": f"round(c{min(i, j)}_{max(i, j)}, 6)",
                          "pos_a": f"CAST({i} AS INTEGER)", "pos_b": f"CAST({j} AS INTEGER)"})
    return with_ctes(X.READINGS_SQL, FEATURES_SQL, s, body=rows_sql("s", items, where or None))


@register("correlation_matrix", _corr_sql())
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.correlation_matrix(type_l_features(spark, sf_dir), S.FEATURES))


@register(
    "high_correlation",
    "SELECT feature_a, feature_b, corr FROM (" + _corr_sql() + ") m WHERE pos_a < pos_b AND abs(corr) > 0.9",
)
def high_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.high_correlation(type_l_features(spark, sf_dir), S.FEATURES))


@register(
    "low_variance",
    with_ctes(
        X.READINGS_SQL,
        FEATURES_SQL,
        "v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, var_samp({c}) AS variance FROM features"
                                       for c in S.FEATURES) + ")",
        body=f"SELECT feature, round(variance, 6) AS variance FROM v WHERE variance < {S.LOW_VARIANCE!r}",
    ),
)
def low_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.low_variance(type_l_features(spark, sf_dir), S.FEATURES))


# ------------------------------------------------------------------ Q19 ---
_SUM_COLS = [*S.SENSORS, "target"]


@register(
    "dataset_summary",
    with_ctes(
        X.READINGS_DIRTY_SQL,
        "l AS (SELECT " + ", ".join(_SUM_COLS) + " FROM readings_dirty WHERE type = 'L')",
        "s AS (SELECT count(*) AS rows, avg(target) AS rate, "
        + ", ".join(f"count_if({c} IS NULL) AS n_{c}" for c in _SUM_COLS) + " FROM l)",
        body="SELECT metric, key, round(value, 6) AS value FROM ("
        + rows_sql(
            "s",
            [{"metric": "'total_samples'", "key": "CAST(NULL AS VARCHAR)", "value": "CAST(rows AS DOUBLE)"},
             {"metric": "'columns'", "key": "CAST(NULL AS VARCHAR)", "value": f"CAST({len(_SUM_COLS)} AS DOUBLE)"}]
            + [{"metric": "'missing_values'", "key": f"'{c}'", "value": f"CAST(n_{c} AS DOUBLE)"} for c in _SUM_COLS]
            + [{"metric": "'failure_rate'", "key": "CAST(NULL AS VARCHAR)", "value": "rate"}],
        )
        + " UNION ALL SELECT 'target_count', CAST(target AS VARCHAR), CAST(count(*) AS DOUBLE) FROM l "
        "WHERE target IS NOT NULL GROUP BY target) x",
    ),
)
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    l_rows = R.filter_type(_dirty(spark, sf_dir)).select(*_SUM_COLS)
    return rounded(Q.dataset_summary(l_rows))
