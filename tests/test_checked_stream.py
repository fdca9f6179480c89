import os

import pytest
from pyspark.sql import functions as F

from wearcast import schema as S
from wearcast.operators import quality as Q
from wearcast.operators import score as I
from wearcast.plans.tree_checks import rule_model
from wearcast.streaming import files as ST

DDL = "reading_id string, " + ", ".join(f"{c} double" for c in S.SENSORS)


def rows(n, tag, shift=0.0, holes=7):
    out = []
    for i in range(n):
        v = [300 + i % 7 * 0.5, 309 + i % 5 * 0.7, 1300 + i * 3.0, 30 + i % 40 + shift, float(i * 2 % 250)]
        if holes and i % holes == 0:
            v[i % 5] = None
        out.append((f"{tag}{i}", *v))
    return out


def arrive(spark, path, name, data):
    """One file, moved in by name, so that arrival order is known."""
    spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def run(spark, src, base, **k):
    stream = ST.file_stream(spark, f"{src}/*", DDL, max_files_per_trigger=1)
    ST.score_checked_stream(stream, rule_model(), "3", "champion", base, f"{base}/checkpoint", keep=("reading_id",), **k)


def predictions(spark, base):
    return spark.read.parquet(f"{base}/predictions").drop("inference_timestamp", "batch_id")


def test_stream_equals_batch_bad_batches_wait_and_a_replay_adds_nothing(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    good, bad = [rows(90, "a"), rows(60, "b", shift=3.0)], [(f"c{i}", None, None, 1500.0, None, 3.0) for i in range(20)]
    for i, data in enumerate([good[0], bad, good[1]]):
        arrive(spark, src, f"day{i}", data)
    run(spark, src, base)
    want = None
    for data in good:  # the batch job, file by file: each file's own medians
        filled = Q.impute_median(spark.createDataFrame(data, DDL))
        part = I.batch_score(rule_model(), filled, "3", "champion", keep=("reading_id",), with_timestamp=False)
        want = part if want is None else want.unionAll(part)
    got = predictions(spark, base)
    assert got.count() == 150 and got.exceptAll(want.select(got.columns)).count() == 0
    held = spark.read.parquet(f"{base}/quarantine")
    assert held.count() == 20 and held.select("reason").distinct().collect()[0][0] == "missing_cells_per_row"
    assert held.where("torque IS NULL AND rotational_speed = 1500").count() == 20  # as it came
    gates = spark.read.parquet(f"{base}/gates")
    assert gates.where("NOT passed").select("batch_id").distinct().count() == 1 and gates.select("batch_id").distinct().count() == 3
    totals = spark.read.parquet(f"{base}/prediction_stats").where("metric = 'total_predictions'").agg(F.sum("value")).first()[0]
    assert totals == 150 and spark.read.parquet(f"{base}/alerts").count() > 0
    before = sorted(map(str, got.collect()))
    run(spark, src, base)  # no new file
    commits = f"{base}/checkpoint/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for n in (str(last), f".{last}.crc"):
        os.remove(f"{commits}/{n}")
    run(spark, src, base)  # as after a failure before the commit: the batch is replayed
    assert sorted(map(str, predictions(spark, base).collect())) == before
    assert spark.read.parquet(f"{base}/quarantine").count() == 20


def test_stored_medians_fill_and_drift_is_held_back(spark, tmp_path):
    train = spark.createDataFrame(rows(200, "t", holes=0), DDL)
    medians = ST.stored_medians(train)
    pdf = train.toPandas()
    for c in S.SENSORS:
        q = pdf[c].quantile([0.25, 0.5, 0.75])
        assert medians[c] == pytest.approx((q[0.5], q[0.75] - q[0.25]))
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, src, "day0", rows(50, "a", shift=1.0))
    arrive(spark, src, "day1", rows(50, "b", shift=100.0))
    run(spark, src, base, medians=medians, drift_limit=3.0)
    got = predictions(spark, base)
    assert got.count() == 50 and got.where("reading_id LIKE 'a%'").count() == 50
    filled = {r["reading_id"]: r for r in got.collect()}
    assert filled["a0"]["air_temperature"] == medians["air_temperature"][0]
    held = spark.read.parquet(f"{base}/quarantine")
    assert held.count() == 50 and "median_drift_torque" in held.first()["reason"]
    assert Q.impute_median(train, medians={"torque": 1.0}).count() == 200
