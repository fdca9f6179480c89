from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from wearcast.operators import learn as L
from wearcast.operators import registry as G
from wearcast.plans.tree_checks import rule_model
from wearcast.sources import recorded as R
from wearcast.sources import versions as V


def test_interleaved_trainings_get_their_own_versions(spark, tmp_path):
    base = str(tmp_path)
    a, b = V.claim_version(spark, base, "m"), V.claim_version(spark, base, "m")  # both before either publishes
    assert (a, b) == (1, 2) and V.claim_version(spark, base, "other") == 1
    schema = "name string, version long, f1 double"
    V.publish_model(spark, rule_model(), base, "m", b)
    V.append_rows(spark.createDataFrame([("m", b, 0.8)], schema), f"{base}/registry")
    V.publish_model(spark, rule_model(), base, "m", a)
    V.append_rows(spark.createDataFrame([("m", a, 0.7)], schema), f"{base}/registry")
    with pytest.raises(FileExistsError):  # a published version is never overwritten
        V.publish_model(spark, rule_model(), base, "m", a)
    reg = spark.read.parquet(f"{base}/registry")
    assert sorted((r["version"], r["f1"]) for r in reg.collect()) == [(1, 0.7), (2, 0.8)]
    assert sorted(r["version"] for r in G.champion_decisions(reg).where("promoted").collect()) == [1, 2]
    for v in (a, b):
        assert L.load_pipeline(f"{base}/models/m/{v}").stages[-1].getInputCols()
    V.claim_version(spark, base, "m")  # a training that fails after its claim leaves a gap
    assert V.claim_version(spark, base, "m") == 4 and V.claim_version(spark, base, "m", after=9) == 10


def test_claims_at_the_same_time_differ(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: V.claim_version(spark, str(tmp_path), "m"), range(24)))
    assert sorted(got) == list(range(1, 25))
    rows = [spark.createDataFrame([(i,)], "i int") for i in range(8)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda r: V.append_rows(r, f"{tmp_path}/t"), rows))
    assert sorted(r["i"] for r in spark.read.parquet(f"{tmp_path}/t").collect()) == list(range(8))


RUNS = {
    ("906439392966595488", "c2044e9d268a4844a7cd4e245f4db12e"): ("rf", 17527, {"accuracy": 0.9925, "f1_score": 0.8966}),
    ("960816347499315434", "ef9f80f053d7455cbb7aaa460ce3a6ba"): ("rf", 12560, {"accuracy": 0.9892, "f1_score": 0.9892}),
    ("960816347499315434", "dfb6d8cb5ac64d1d98d621fbf0f5f6bd"): ("xgb", 8845, {"accuracy": 0.9650, "f1_score": 0.9512}),
    ("960816347499315434", "88811a5071a84ae18f2c90e3a150ef4a"): ("svm", 6875, {"accuracy": 0.9142, "f1_score": 0.9343}),
}


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def folder(tmp_path):
    for i, ((exp, run), (model, ms, metrics)) in enumerate(RUNS.items()):
        at = tmp_path / exp / run
        put(at / "meta.yaml", f"artifact_uri: file:///x\nend_time: {1750000000000 + i * 60000 + ms}\nrun_name: '{model}_run'\n"
                              f"start_time: {1750000000000 + i * 60000}\nstatus: 3\nrun_id: {run}\nsource_name: ''\n")
        for k, v in metrics.items():
            put(at / "metrics" / k, f"1749999999000 0.1 0\n1750000001000 {v} 1\n")
        put(at / "params" / "scale_pos_weight", "0.040763226366001735" if model == "xgb" else "24.53191489361702")
        put(at / "tags" / "algorithm", f"{model}\n")
        put(at / "artifacts" / "model" / "model.txt", "not a value")
    put(tmp_path / "960816347499315434" / "meta.yaml", "name: predictive_maintenance\n")  # the experiment's own file
    put(tmp_path / "960816347499315434" / "unfinished" / "tags" / "a b+c", "x y")
    m = tmp_path / "models" / "predictive_maintenance_model"
    for v, run in ((1, "ef9f80f053d7455cbb7aaa460ce3a6ba"), (10, "88811a5071a84ae18f2c90e3a150ef4a")):
        put(m / f"version-{v}" / "meta.yaml", f"creation_timestamp: 1750000000123\ncurrent_stage: None\nrun_id: {run}\nversion: '{v}'\n")
    put(m / "version-10" / "tags" / "f1_score", "0.9343")
    put(m / "aliases" / "champion", "10")
    put(m / "aliases" / "latest", "10\n")
    put(m / "meta.yaml", "name: predictive_maintenance_model\n")
    return str(tmp_path)


def test_recorded_runs_equal_the_baseline(spark, folder):
    runs = {(r["experiment"], r["run_id"]): r for r in R.read_runs(spark, folder).collect()}
    assert len(runs) == len(RUNS) + 1
    for key, (model, ms, metrics) in RUNS.items():
        r = runs[key]
        assert r["run_name"] == f"{model}_run" and r["status"] == "FINISHED" and r["duration_s"] == ms / 1000
        assert r["metrics"] == metrics and r["tags"] == {"algorithm": model} and (r["end_time"] - r["start_time"]).total_seconds() == ms / 1000
    assert runs["960816347499315434", "dfb6d8cb5ac64d1d98d621fbf0f5f6bd"]["params"] == {"scale_pos_weight": "0.040763226366001735"}
    odd = runs["960816347499315434", "unfinished"]
    assert odd["tags"] == {"a b+c": "x y"} and odd["start_time"] is None
    best = {r["experiment"]: r for r in R.best_runs(R.read_runs(spark, folder), "f1_score").collect()}
    assert best["960816347499315434"]["run_name"] == "rf_run" and best["906439392966595488"]["f1_score"] == 0.8966


def test_recorded_versions_and_the_registry_operators_on_them(spark, folder):
    rows = {r["version"]: r for r in R.read_versions(spark, folder).collect()}
    assert set(rows) == {1, 10} and rows[10]["aliases"] == ["champion", "latest"] and rows[1]["aliases"] is None
    assert rows[10]["tags"] == {"f1_score": "0.9343"} and rows[1]["run_id"].startswith("ef9f80f0") and rows[1]["created"].microsecond == 123000
    versions = R.read_versions(spark, folder).join(
        R.read_runs(spark, folder).select("run_id", F.col("metrics")["f1_score"].alias("f1")), "run_id")
    promoted = G.champion_decisions(versions.select("name", "version", "f1")).where("promoted").collect()
    assert [r["version"] for r in promoted] == [1]  # 0.9343 does not beat 0.9892


def test_an_empty_folder_has_no_runs(spark, tmp_path):
    assert R.read_runs(spark, str(tmp_path)).collect() == [] and R.read_versions(spark, str(tmp_path)).collect() == []
