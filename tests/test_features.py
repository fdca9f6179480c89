import math

import pytest
from pyspark.sql import functions as F

from wearcast import schema as S
from wearcast.functions import columns as C
from wearcast.functions.features import extract_features, extract_serving_features


def test_feature_goldens(golden):
    rows = {r["reading_id"]: r for r in extract_features(golden, keep=("reading_id",)).collect()}
    r1, r4 = rows["r1"], rows["r4"]
    assert r1["temp_difference"] == pytest.approx(10.5, abs=1e-12)
    assert r1["estimated_power"] == pytest.approx(6951.590560157351, rel=1e-15)
    assert r1["mechanical_stress"] == pytest.approx(27.595099935525468, rel=1e-15)
    assert r1["thermal_efficiency"] == pytest.approx(1.0352230795035222, rel=1e-15)
    assert r1["wear_per_operation"] == pytest.approx(69.63249516441006, rel=1e-15)
    assert r4["temp_difference"] == pytest.approx(10.1, abs=1e-12)
    assert r4["estimated_power"] == pytest.approx(5226.416370365052, rel=1e-15)
    assert r4["mechanical_stress"] == pytest.approx(25.53648068669528, rel=1e-15)
    assert r4["wear_per_operation"] == pytest.approx(143.77682403433474, rel=1e-15)


def test_zero_rpm_gives_ieee_values(spark):
    df = spark.createDataFrame([(300.0, 310.0, 0.0, 40.0, 0.0), (300.0, 310.0, 0.0, -1.0, 5.0)],
                               ", ".join(f"{c} double" for c in S.SENSORS))
    r = extract_features(df).collect()
    assert math.isinf(r[0]["mechanical_stress"]) and r[0]["mechanical_stress"] > 0
    assert math.isnan(r[0]["wear_per_operation"])
    assert r[1]["mechanical_stress"] == float("-inf")


def test_serving_variant_is_1000x_smaller(golden):
    t = extract_features(golden).collect()[0]
    s = extract_serving_features(golden).collect()[0]
    assert s["mechanical_stress"] == pytest.approx(t["mechanical_stress"] / 1000, rel=1e-6)


def test_nan_to_null_and_rename(spark):
    df = spark.createDataFrame([(float("nan"), 1.0)], "`Air temperature [K]` double, `Torque [Nm]` double")
    out = C.nans_to_nulls(C.normalize_columns(df))
    assert out.columns == ["air_temperature", "torque"]
    assert out.first()["air_temperature"] is None


def test_require_columns(spark):
    df = spark.createDataFrame([(1.0,)], "torque double")
    with pytest.raises(C.MissingColumnsError):
        C.require_columns(df, ["torque", "tool_wear"])
    assert C.require_columns(df, ["torque", "tool_wear"], hard=False) == ["tool_wear"]


def test_csv_trailing_blank_reads_as_double(spark, tmp_path):
    from wearcast.sources.readings import read_new_readings_csv

    p = tmp_path / "new.csv"
    p.write_text(",".join(S.SENSORS) + "\n299.8,310.5,1634,48.3,112 \n")
    r = read_new_readings_csv(spark, str(p)).first()
    assert r["tool_wear"] == 112.0 and r["rotational_speed"] == 1634.0


def test_write_with_metadata(spark, golden, tmp_path):
    from wearcast.sources.sinks import write_with_metadata

    prof = write_with_metadata(golden, str(tmp_path / "t")).first()
    assert prof["total_samples"] == 10 and prof["n_columns"] == 8 and prof["file_size_mb"] > 0
    meta = spark.read.json(str(tmp_path / "t_metadata")).first()
    assert meta["total_samples"] == 10 and meta["generated_at"]


def test_feature_sql_equals_dataframe_formulas(spark, golden):
    from wearcast.functions.features import FEATURE_SQL

    edge = spark.createDataFrame([("z1", 300.0, 310.0, 0.0, 40.0, 0.0, 0.0, 0.0), ("z2", 0.0, 310.0, 0.0, -1.0, 5.0, 0.0, 0.0)],
                                 golden.schema)
    df = golden.unionByName(edge)
    a = extract_features(df, keep=("reading_id",))
    b = df.selectExpr("reading_id", *[f"{e} AS {n}" for n, e in FEATURE_SQL.items()])
    ra = {r["reading_id"]: r for r in a.collect()}
    for r in b.collect():
        for n in FEATURE_SQL:
            x, y = ra[r["reading_id"]][n], r[n]
            assert (x == y) or (math.isnan(x) and math.isnan(y)), (n, x, y)
