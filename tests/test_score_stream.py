import pytest
from golden import GOLDEN
from pyspark.sql import functions as F

from wearcast import schema as S
from wearcast.operators import score as I


def test_prediction_stats_and_alerts_golden(golden):
    preds = golden.select((F.col("prob_class_1") > 0.5).cast("int").alias("predicted_class"), "prob_class_0",
                          "prob_class_1", F.greatest("prob_class_0", "prob_class_1").alias("confidence"))
    stats = {(r["metric"], r["key"]): r["value"] for r in I.prediction_stats(preds).collect()}
    assert stats[("total_predictions", None)] == 10 and stats[("unique_classes", None)] == 1
    assert stats[("average_confidence", None)] == pytest.approx(0.9650121314013926, rel=1e-15)
    assert stats[("low_confidence_count", None)] == 0 and stats[("class_count", "0")] == 10
    alerts = {r["alert"]: r for r in I.inference_alerts(I.prediction_stats(preds)).collect()}
    assert alerts["single_class"]["fired"] and not alerts["low_confidence"]["fired"]
    assert not alerts["low_average_confidence"]["fired"]
    assert alerts["class_share_0"]["value"] == 100.0


def test_score_rows_safe_marks_bad_rows(spark):
    df = spark.createDataFrame([("a", "298", "308", "1500", "40", "100"), ("b", "298", "308", "1500", "abc", "100"),
                                ("c", "298", "308", "1500", "nan", "100")],
                               "reading_id string, " + ", ".join(f"{c} string" for c in S.SENSORS))

    def scorer(d):
        return d.withColumn("prob_class_1", F.lit(0.8))

    out = {r["reading_id"]: r for r in I.score_rows_safe(df, scorer, keep=("reading_id",)).collect()}
    assert out["b"]["prediction_label"] == "Error" and out["b"]["label_confidence"] == 0.0
    assert out["a"]["prediction_label"] == "Failure" and out["a"]["label_confidence"] == pytest.approx(0.8)
    assert out["c"]["prediction_label"] != "Error"  # 'nan' parses
    summ = I.batch_summary(I.score_rows_safe(df, scorer, keep=("reading_id",))).first()
    assert (summ["total_samples"], summ["failed_predictions"], summ["predicted_failures"]) == (3, 1, 2)


def test_stream_equals_batch_and_is_incremental(spark, tmp_path):
    from wearcast.functions.features import extract_features
    from wearcast.streaming.files import file_stream, run_available_now

    src = tmp_path / "in"
    schema = ", ".join(f"{c} double" for c in S.SENSORS)
    batch = spark.createDataFrame([(298.0 + i, 308.0, 1500.0 + i, 40.0, float(i)) for i in range(40)], schema)
    batch.repartition(4).write.parquet(str(src))
    sink, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_available_now(extract_features(file_stream(spark, str(src), schema)), sink, ckpt)
    got = spark.read.parquet(sink)
    assert got.count() == 40
    assert got.exceptAll(extract_features(batch)).count() == 0
    run_available_now(extract_features(file_stream(spark, str(src), schema)), sink, ckpt)
    assert spark.read.parquet(sink).count() == 40  # no new file → nothing added


def test_csv_arrivals_stream_with_trailing_blank(spark, tmp_path):
    from wearcast.streaming.files import file_stream, run_available_now

    src = tmp_path / "arrivals"
    src.mkdir()
    lines = [",".join(S.SENSORS)] + [",".join(f"{v:g}" for v in g[:5]) for g in GOLDEN]
    lines[-1] += " "  # the recorded file's last cell is '112 '
    (src / "new_data.csv").write_text("\n".join(lines) + "\n")
    schema = ", ".join(f"{c} double" for c in S.SENSORS)
    sink, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_available_now(file_stream(spark, str(src), schema, fmt="csv"), sink, ckpt)
    got = spark.read.parquet(sink)
    assert got.count() == 10 and got.where("tool_wear = 112.0").count() == 1
    assert got.where(F.col("tool_wear").isNull()).count() == 0
