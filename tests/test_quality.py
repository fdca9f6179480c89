import numpy as np
import pandas as pd
import pytest

from wearcast import schema as S
from wearcast.operators import quality as Q


@pytest.fixture(scope="module")
def dirty(spark):
    pdf = pd.DataFrame({
        "air_temperature": [298.0, 299.0, None, 301.0, 298.0],
        "process_temperature": [308.0, 309.0, 310.0, 311.0, 308.0],
        "rotational_speed": [1500.0, 4000.0, 1600.0, 1700.0, 1500.0],
        "torque": [40.0, None, 42.0, 43.0, 40.0],
        "tool_wear": [10.0, 20.0, 30.0, 400.0, 10.0],
        "target": [0, 1, 0, 0, 0],
    })
    return spark.createDataFrame(pdf.astype({"target": "int32"}))


def test_null_counts(dirty):
    got = {r["column_name"]: r["null_count"] for r in Q.null_counts(dirty).collect()}
    assert got == {"air_temperature": 1, "torque": 1, "*": 2}


def test_duplicates(dirty):
    r = Q.duplicate_count(dirty).first()
    assert (r["duplicates"], r["total_rows"]) == (1, 5)
    assert Q.deduplicate(dirty).count() == 4


def test_out_of_range_inclusive(dirty):
    got = {r["feature"]: r["out_of_range"] for r in Q.out_of_range(dirty).collect()}
    assert got["rotational_speed"] == 1 and got["tool_wear"] == 1 and got["torque"] == 0


def test_impute_median_uses_batch_median(dirty):
    rows = Q.impute_median(dirty).collect()
    assert rows[2]["air_temperature"] == pytest.approx(np.median([298.0, 299.0, 301.0, 298.0]))
    assert rows[1]["torque"] == pytest.approx(np.median([40.0, 42.0, 43.0, 40.0]))


def test_correlation_pairwise_complete(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(300, 3)), columns=list("abc"))
    pdf.loc[::7, "a"] = np.nan
    m = Q.correlation_matrix(spark.createDataFrame(pdf), list("abc")).toPandas()
    exp = pdf.corr()
    for _, r in m.iterrows():
        assert r["corr"] == pytest.approx(exp.loc[r["feature_a"], r["feature_b"]], abs=1e-12)


def test_iqr_outliers_against_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": np.concatenate([rng.normal(size=500), [15.0, -12.0]])})
    r = Q.iqr_outliers(spark.createDataFrame(pdf), ["x"]).first()
    q1, q3 = pdf.x.quantile(0.25), pdf.x.quantile(0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r["n_outliers"] == int(((pdf.x < lo) | (pdf.x > hi)).sum())


def test_gates(dirty, spark):
    raw = {r["check"]: r for r in Q.raw_quality_gate(dirty, min_rows=5).collect()}
    assert raw["total_samples"]["passed"] and not raw["missing_values"]["passed"]
    strict = Q.raw_quality_gate(dirty)  # default 5000 rows
    with pytest.raises(Q.GateError):
        Q.enforce(strict)
    inf = {r["check"]: r for r in Q.inference_gate(dirty.drop("target")).collect()}
    assert inf["missing_cells_per_row"]["value"] == pytest.approx(2 / 5)
    empty = spark.createDataFrame([], dirty.schema)
    assert not {r["check"]: r for r in Q.inference_gate(empty).collect()}["total_samples"]["passed"]


def test_feature_gate_single_class(spark):
    df = spark.createDataFrame([(float(i), 0) for i in range(10)], "a double, target int")
    g = {r["check"]: r["passed"] for r in Q.feature_gate(df).collect()}
    assert g["unique_classes"] is False and g["feature_count"] is False


def test_all_null_column_profile(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    prof = {r["feature"]: r for r in Q.column_profile(df, ["a", "b"], ("min", "max", "mean")).collect()}
    assert prof["a"]["mean"] is None and prof["b"]["mean"] == 1.5


def test_iqr_and_impute_with_all_null_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 9.0)], "a double, b double")
    out = {r["feature"]: r["n_outliers"] for r in Q.iqr_outliers(df, ["a", "b"]).collect()}
    assert out.get("a", 0) == 0
    imp = Q.impute_median(df, ["a", "b"]).collect()
    assert imp[0]["a"] is None and imp[0]["b"] == 1.0
