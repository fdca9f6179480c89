"""File-arrival streams (S7, I7) with Structured Streaming.

A folder of arriving files is a streaming file source; ``availableNow``
processes every file not yet seen (the checkpoint remembers them) and
stops, which replaces a polling sensor + daily batch.  Per-batch outputs go
through ``foreachBatch`` into ``batch_id`` partitions with dynamic partition
overwrite, so a replayed batch rewrites its own partition (idempotent).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..functions.columns import select_sensors
from ..operators import quality as Q
from ..operators.quantiles import quantiles
from ..operators.score import batch_score, inference_alerts, prediction_stats


def file_stream(spark: SparkSession, src_dir: str, schema: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Streaming DataFrame over a folder (explicit schema, no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True).option("ignoreTrailingWhiteSpace", True)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(src_dir)


def _finished(q: StreamingQuery, timeout_s: int | None) -> StreamingQuery:
    """The query once it has ended; one still active at the timeout is
    stopped and raises, as its sink holds only a part of the files."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream did not finish within {timeout_s} s")
    return q


def run_available_now(stream: DataFrame, sink_dir: str, checkpoint_dir: str, fmt: str = "parquet",
                      timeout_s: int | None = None) -> StreamingQuery:
    """Append the stream's rows to ``sink_dir`` for every new file, then stop."""
    q = (stream.writeStream.format(fmt).option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
         .outputMode("append").trigger(availableNow=True).start())
    return _finished(q, timeout_s)


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def score_stream(stream: DataFrame, model: PipelineModel, version: str, stage: str, predictions_dir: str,
                 stats_dir: str, checkpoint_dir: str, keep: tuple[str, ...] = (),
                 timeout_s: int | None = None, on_batch: Callable[[DataFrame, int], None] | None = None
                 ) -> StreamingQuery:
    """Score every newly arrived file with the saved pipeline; write the
    predictions and that batch's statistics (I2), keyed by batch id."""
    scored = batch_score(model, stream, version, stage, keep=keep)

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, predictions_dir, batch_id)
        written = batch.sparkSession.read.parquet(predictions_dir).where(F.col("batch_id") == batch_id)
        _write_batch(prediction_stats(written), stats_dir, batch_id)
        if on_batch is not None:
            on_batch(written, batch_id)

    q = (scored.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    return _finished(q, timeout_s)


def stored_medians(train: DataFrame, cols: tuple[str, ...] = tuple(S.SENSORS)) -> dict[str, tuple[float, float]]:
    """(median, interquartile range) of each sensor in the training rows; a
    sensor without values is left out."""
    found: dict[str, dict[float, float]] = {}
    for r in quantiles(train, list(cols), [0.25, 0.5, 0.75]).collect():
        found.setdefault(r["feature"], {})[r["prob"]] = r["quantile"]
    return {c: (q[0.5], q[0.75] - q[0.25]) for c, q in found.items() if q[0.5] is not None}


def _drift(batch: DataFrame, medians: dict[str, tuple[float, float]], limit: float) -> list[tuple]:
    """A check per sensor: how far the batch's median lies from the stored one, in stored ranges."""
    out = []
    for r in quantiles(batch, list(medians), [0.5]).collect():
        middle, spread = medians[r["feature"]]
        if r["quantile"] is None:
            continue
        far = abs(r["quantile"] - middle)
        value = far / spread if spread > 0 else (0.0 if far == 0 else float("inf"))
        out.append((f"median_drift_{r['feature']}", value, None, limit, "error", value <= limit))
    return out


def score_checked_stream(stream: DataFrame, model: PipelineModel, version: str, stage: str, base: str, checkpoint_dir: str,
                         keep: tuple[str, ...] = (), medians: dict[str, tuple[float, float]] | None = None,
                         drift_limit: float = 1.0, timeout_s: int | None = None) -> StreamingQuery:
    """The daily run as a stream: each batch of new files passes the inference
    gate, missing sensors are filled, and the batch is scored.

    Tables under ``base``, a ``batch_id`` partition each: ``gates`` (the
    checks), ``predictions``, ``prediction_stats`` and ``alerts``; a batch that
    fails a check goes to ``quarantine`` as it came, with the reasons, and is
    not scored.  Sensors are filled with the batch's own exact medians, as the
    batch job does; with ``medians`` (``stored_medians`` of the training rows)
    with those, and a batch whose median lies more than ``drift_limit`` stored
    interquartile ranges away is quarantined too.  A batch that is replayed
    after a failure gives the same rows and rewrites its own partitions."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read by gate, medians, drift and scoring
        try:
            checks = [tuple(r) for r in Q.inference_gate(select_sensors(rows, with_target=False)).select(
                "check", "value", "lower", "upper", "severity", "passed").collect()]
            if medians is not None:
                checks += _drift(rows, medians, drift_limit)
            _write_batch(spark.createDataFrame(checks, "check string, value double, lower double, upper double, "
                                                       "severity string, passed boolean"), f"{base}/gates", batch_id)
            failed = [c[0] for c in checks if c[4] == "error" and not c[5]]
            if failed:
                _write_batch(rows.withColumn("reason", F.lit(", ".join(failed))), f"{base}/quarantine", batch_id)
                return
            filled = Q.impute_median(rows, medians=None if medians is None else {c: m for c, (m, _) in medians.items()})
            _write_batch(batch_score(model, filled, version, stage, keep=keep), f"{base}/predictions", batch_id)
            written = spark.read.parquet(f"{base}/predictions").where(F.col("batch_id") == batch_id)
            stats = prediction_stats(written)
            _write_batch(stats, f"{base}/prediction_stats", batch_id)
            _write_batch(inference_alerts(stats), f"{base}/alerts", batch_id)
        finally:
            rows.unpersist()

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    return _finished(q, timeout_s)
