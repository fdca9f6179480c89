"""Sinks and file-level profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    run_ts: str | None = None,
) -> None:
    """S3.  Results go to one table; repeated runs append a ``run_ts``
    partition instead of writing timestamped files.  CSV gets a header."""
    w = df
    if run_ts is not None:
        w = w.withColumn("run_ts", F.lit(run_ts))
    writer = w.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if run_ts is not None:
        writer = writer.partitionBy("run_ts")
    writer.save(path)


def write_report(report: DataFrame, path: str, generated_at: bool = True) -> None:
    """S4.  A (small, already aggregated) report frame written as JSON, with
    ``generated_at`` metadata.  One file: the frame is a handful of rows."""
    out = report.withColumn("generated_at", F.current_timestamp()) if generated_at else report
    out.coalesce(1).write.mode("overwrite").json(path)


def source_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, total missing cells and input size in MB, in one
    pass.  File sizes come from the hidden ``_metadata`` column: distinct
    (path, size) pairs are summed, so the number is per file, not per row."""
    data_cols = [c for c in df.columns]
    missing = sum((F.col(c).isNull().cast("long") for c in data_cols), F.lit(0).cast("long"))
    rows = df.select(missing.alias("_miss"), F.col("_metadata.file_path").alias("_p"),
                     F.col("_metadata.file_size").alias("_s"))
    per_file = rows.groupBy("_p", "_s").agg(F.count("*").alias("_n"), F.sum("_miss").alias("_m"))
    return per_file.agg(
        F.sum("_n").cast("long").alias("total_samples"),
        F.lit(len(data_cols)).cast("long").alias("n_columns"),
        F.coalesce(F.sum("_m"), F.lit(0)).cast("long").alias("missing_values"),
        (F.coalesce(F.sum("_s"), F.lit(0)) / (1024 * 1024)).alias("file_size_mb"),
    )


def write_with_metadata(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> DataFrame:
    """S3 + S4: write the table, then a JSON sidecar ``<path>_metadata`` with
    generated_at, samples, columns, missing cells and size on disk, profiled
    from the written files (one pass).  Returns the profile."""
    write_table(df, path, fmt, mode)
    spark = df.sparkSession
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).schema(df.schema)
    prof = source_profile(reader.load(path))
    write_report(prof, f"{path.rstrip('/')}_metadata")
    return prof
