"""End-to-end: features → training → registry → scoring on sf0.001."""

import pytest
from pyspark.sql import functions as F

from wearcast import schema as S
from wearcast.functions import columns as C
from wearcast.plans import jobs as J
from wearcast.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def test_three_jobs_end_to_end(spark, tmp_path):
    base = str(tmp_path / "base")
    raw = X.readings(spark, SF)
    out = J.features_job(spark, raw, base, min_rows=1000)
    n_l = raw.where("type = 'L'").count()
    assert out["features"].count() == n_l

    tr = J.training_job(spark, base, algorithms=("random_forest",), tune=False)
    cmp_ = {(r["model"], r["metric"]): r for r in tr["comparison"].collect()}
    assert ("random_forest", "f1_score") in cmp_
    dec = tr["decisions"].collect()
    assert len(dec) == 1 and dec[0]["promoted"]  # first version beats 0.0

    tr2 = J.training_job(spark, base, algorithms=("random_forest",), tune=False)
    versions = sorted(r["version"] for r in tr2["decisions"].collect())
    assert versions == [1, 2]  # registry appended; equal f1 → not promoted again
    assert not [r for r in tr2["decisions"].collect() if r["version"] == 2][0]["promoted"]

    new = X.readings(spark, SF).where("type = 'L'").select("reading_id", *S.SENSORS)
    sc = J.scoring_job(spark, new, base)
    assert sc["predictions"].count() == n_l
    assert set(sc["predictions"].select("model_version").distinct().toPandas()["model_version"]) == {"1"}
    stats = {r["metric"]: r["value"] for r in sc["stats"].where(F.col("key").isNull()).collect()}
    assert stats["total_predictions"] == n_l


def test_jobs_start_at_a_raw_csv(spark, tmp_path):
    """The documented flow: raw CSV (bracketed names, no reading_id) → features →
    tuned training with CV columns → scoring of a CSV without ids."""
    base, raw = str(tmp_path / "base"), str(tmp_path / "raw.csv")
    src = X.readings(spark, SF).limit(4000)
    named = src.withColumn("udi", F.monotonically_increasing_id()).withColumnRenamed("reading_id", "product_id")
    C.to_bracketed(named).select(*[F.col(f"`{c}`") for c in S.RAW_TO_SNAKE]).write.option("header", True).csv(raw)
    table = J._read_any(spark, raw, S.RAW_CSV_DDL)
    out = J.features_job(spark, table, base, min_rows=1000)
    checks = {r["check"]: r["value"] for r in out["raw_gate"].collect()}
    assert checks["duplicates"] == 0  # ids differ: not duplicates
    assert out["features"].select("reading_id").distinct().count() == out["features"].count()

    tr = J.training_job(spark, base, algorithms=("random_forest",), min_rows=100, grid_size=1)
    row = {r["metric"]: r for r in tr["comparison"].collect()}
    assert row["accuracy"]["cv"] > 0.8 and 0 <= row["f1_failure"]["cv"] <= 1

    new = str(tmp_path / "new.csv")
    src.where("type = 'L'").select(*S.SENSORS).write.option("header", True).csv(new)
    sc = J.scoring_job(spark, J._read_any(spark, new, S.NEW_READINGS_DDL), base)
    assert sc["predictions"].where("reading_id IS NOT NULL").count() == src.where("type = 'L'").count()
    report = {(r["metric"], r["key"]): r["value"] for r in sc["report"].collect()}
    assert report["processed_samples", None] == sc["predictions"].count()
    assert sc["out_of_range"].count() == len(S.SENSORS)


def test_a_broken_registry_is_not_taken_for_a_missing_one(spark, tmp_path):
    (tmp_path / "registry").mkdir()
    (tmp_path / "registry" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception):
        J._maybe(spark, str(tmp_path / "registry")).collect()
    assert J._maybe(spark, str(tmp_path / "nothing")) is None
