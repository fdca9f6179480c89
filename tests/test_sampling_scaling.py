import numpy as np
import pandas as pd
import pytest
from golden import GOLDEN
from pyspark.sql import functions as F

from wearcast import schema as S
from wearcast.operators import sampling as M
from wearcast.operators import scaling as T


@pytest.fixture(scope="module")
def six_thousand(spark):
    # 6,000 rows with 235 failures: the recorded dataset's class counts
    pdf = pd.DataFrame({"reading_id": [f"id{i}" for i in range(6000)],
                        "target": np.r_[np.ones(235, dtype="int32"), np.zeros(5765, dtype="int32")]})
    return spark.createDataFrame(pdf)


def test_split_sizes_match_recorded_supports(six_thousand):
    sp = M.stratified_split(six_thousand)
    got = {(r["split"], r["target"]): r["n"] for r in sp.groupBy("split", "target").agg(F.count("*").alias("n")).collect()}
    assert got[("test", 0)] == 1153 and got[("test", 1)] == 47
    assert got[("train", 0)] + got[("train", 1)] == 4800
    assert sp.select("reading_id").distinct().count() == 6000  # disjoint and complete


def test_split_is_deterministic(six_thousand):
    a = {r["reading_id"] for r in M.stratified_split(six_thousand).where("split = 'test'").collect()}
    b = {r["reading_id"] for r in M.stratified_split(six_thousand).where("split = 'test'").collect()}
    assert a == b


def test_class_weights_golden(six_thousand):
    w = {r["target"]: r["weight"] for r in M.class_weights(six_thousand).collect()}
    assert w[0] == pytest.approx(0.5203816131830009, rel=1e-15)
    assert w[1] == pytest.approx(12.76595744680851, rel=1e-15)


def test_folds_are_proportional(six_thousand):
    f = M.stratified_folds(six_thousand, k=3)
    counts = f.groupBy("fold", "target").count().toPandas().pivot(index="fold", columns="target", values="count")
    assert counts[1].max() - counts[1].min() <= 1 and counts[0].max() - counts[0].min() <= 1


def test_random_batch(six_thousand):
    b = M.random_batch(six_thousand.withColumn("x", F.lit(1.0)), n=50)
    assert b.count() == 50 and "target" not in b.columns
    small = six_thousand.limit(10)
    assert M.random_batch(small, n=50).count() == 10


def test_scaler_population_std_and_golden(spark, golden):
    stats = T.scaler_fit(golden, ["air_temperature"]).first()
    vals = np.array([g[0] for g in GOLDEN])
    assert stats["mean"] == pytest.approx(vals.mean()) and stats["scale"] == pytest.approx(vals.std(ddof=0))
    fixed = spark.createDataFrame([("air_temperature", 300.016, 1.972413806)], "feature string, mean double, scale double")
    r = T.scaler_transform(golden.where("reading_id = 'r1'"), fixed, ["air_temperature"]).first()
    assert r["air_temperature"] == pytest.approx(-0.9713985950, abs=1e-9)


def test_constant_column_scale_is_one(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    assert T.scaler_fit(df, ["a"]).first()["scale"] == 1.0


def members(df, col):
    from collections import Counter

    return Counter((r["reading_id"], r["target"], r["x"], r[col]) for r in df.collect())


def test_membership_does_not_depend_on_partitions(spark):
    # a third of the rows are copies of one id (some identical), and some labels are missing
    rows = [("hot", 0, i % 3) for i in range(1000)] + [(f"id{i}", int(i % 25 == 0), 1) for i in range(2000)]
    rows += [(f"none{i}", None, 1) for i in range(30)]
    df = spark.createDataFrame(rows, "reading_id string, target int, x int")
    splits = [members(M.stratified_split(df.repartition(p)), "split") for p in (2, 7)]
    folds = [members(M.stratified_folds(df.repartition(p)), "fold") for p in (2, 7)]
    assert splits[0] == splits[1] and folds[0] == folds[1]
    assert sum(splits[0].values()) == sum(folds[0].values()) == 3030
    assert all((k[3] is None) == (k[1] is None) for k in [*splits[0], *folds[0]])
    sizes = {c: sum(n for k, n in splits[0].items() if k[1] == c and k[3] == "test") for c in (0, 1)}
    alloc = {r["target"]: r for r in M.allocation(spark.createDataFrame([(0, 2920), (1, 80)], "target int, n_c long")).collect()}
    assert sizes == {c: alloc[c]["n_test"] for c in (0, 1)}
    ranks = M.class_ranks(df, "reading_id").where("target = 0").select("_rank").toPandas()
    assert sorted(ranks["_rank"]) == list(range(1, 2921))  # exact, gap-free ranks


def test_weights_of_ten_thousand_classes(spark):
    df = spark.range(20_000).select((F.col("id") % 10_000).cast("int").alias("target"), F.col("id"))
    out = M.attach_weights(df.unionByName(spark.createDataFrame([(None, -1)], "target int, id long")), M.class_weights(df))
    assert out.count() == 20_001 and out.where("weight = 1.0").count() == 20_000 and out.where("weight IS NULL").count() == 1


def test_processing_report_golden(spark, golden):
    """Q20: the recorded report's scaled air-temperature statistics (std n−1)."""
    from wearcast.functions.features import extract_features
    from wearcast.operators import quality as Q

    # FIXED scaler constants fitted from the recorded processed file
    consts = {
        "air_temperature": (300.016000000, 1.972413806),
        "process_temperature": (310.022833333, 1.471928355),
        "rotational_speed": (1539.628888889, 180.560328634),
        "torque": (40.018388889, 9.980609014),
        "tool_wear": (108.550833333, 64.151242080),
    }
    feats = extract_features(golden.select(*S.SENSORS))
    scaled = T.scaler_literals(feats, consts)
    rep = {(r["metric"], r["key"]): r["value"] for r in
           Q.processing_report(golden.select(*S.SENSORS), scaled, list(consts)).collect()}
    assert rep[("mean", "air_temperature")] == pytest.approx(-0.32244755, abs=1e-8)
    assert rep[("std", "air_temperature")] == pytest.approx(0.54855300, abs=1e-8)
    assert rep[("min", "air_temperature")] == pytest.approx(-1.12349650, abs=1e-8)
    assert rep[("max", "air_temperature")] == pytest.approx(0.60027972, abs=1e-8)
    assert rep[("original_samples", None)] == 10 and rep[("missing_values", None)] == 0


def test_split_and_folds_equal_a_sort_of_all_rows(spark, monkeypatch):
    """Ranks by (md5, row) as a plain sort gives them, with missing ids, copies and a bucket of many rows."""
    import hashlib
    from collections import Counter

    rows = [("hot", 0, i % 40) for i in range(900)] + [(f"id{i}", int(i % 9 == 0), i % 4) for i in range(700)]
    rows += [(None, 0, 1), (None, 0, 2), (None, 1, 1), ("id5", None, 0)] + [("id7", 0, 3)] * 3
    df = spark.createDataFrame(rows, "reading_id string, target int, x int").repartition(3)
    known = df.where("target IS NOT NULL").withColumn("k", F.xxhash64("reading_id", "target", "x")).toPandas()
    known["h"] = [hashlib.md5(f"{r}:{S.SPLIT_SEED}".encode()).hexdigest() if r is not None else "" for r in known.reading_id]
    known = known.sort_values(["h", "k"])
    known["rank"] = known.groupby("target").cumcount() + 1
    sizes = {r["target"]: r["n_test"] for r in M.allocation(df.where("target IS NOT NULL").groupBy("target").agg(
        F.count("*").alias("n_c"))).collect()}
    ids = known.reading_id.where(known.reading_id.notna(), None)
    split = Counter(zip(ids, known.target, known.x, np.where(known["rank"] <= known.target.map(sizes), "test", "train")))
    fold = Counter(zip(ids, known.target, known.x, (known["rank"] - 1) % S.CV_FOLDS))
    for most in (M.HOT_ROWS, 100):
        monkeypatch.setattr(M, "HOT_ROWS", most)
        for size in (0.2, 0.5):  # the edge lies in another bucket
            got = members(M.stratified_split(df, test_size=size).where("target IS NOT NULL"), "split")
            if size == S.SPLIT_TEST_SIZE:
                assert got == split
            assert sum(got.values()) == len(known)
        assert members(M.stratified_folds(df).where("target IS NOT NULL"), "fold") == fold


def test_a_split_moves_no_rows_and_folds_move_them_once(spark):
    """Rows used to be shuffled twice and written once for a split, and again for its folds."""
    df = spark.range(5000).select(F.concat(F.lit("r"), "id").alias("reading_id"), (F.col("id") % 7 == 0).cast("int").alias("target"),
                                  (F.col("id") * 1.0).alias("x"))
    split = M.stratified_split(df)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "rangepartitioning" not in plan
    folds = M.stratified_folds(split.where("split = 'train'"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in folds and "rangepartitioning" not in folds
