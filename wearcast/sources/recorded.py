"""Recorded runs and model versions, read from a tracking folder.

Layout, one value a file: ``<base>/<experiment>/<run>/params|metrics|tags/<key>``
and ``meta.yaml`` for the run; ``<base>/models/<name>/version-<n>/meta.yaml``
with ``tags/<key>`` for a version and ``<base>/models/<name>/aliases/<alias>``
holding a version number.  A metric's file has a line ``time value step`` per
logged value; the last one counts.

Files are listed and read by Spark (text source, one row a file, keyed by
``_metadata.file_path``), so a folder of any number of runs is one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES of the recorded format: status numbers.
STATUS = {1: "RUNNING", 2: "SCHEDULED", 3: "FINISHED", 4: "FAILED", 5: "KILLED"}


def _files(spark: SparkSession, base: str, patterns: list[str], parts: str) -> DataFrame:
    """(named parts of the path, text) of the files that match any pattern."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [p for p in patterns if fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{p}"))]
    names = [n for n in ("experiment", "run_id", "name", "version", "kind", "key") if f"(?<{n}>" in parts]
    if not found:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in [*names, "text"]))
    text = spark.read.text([f"{base}/{p}" for p in found], wholetext=True)
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    plain = parts
    for n in names:
        plain = plain.replace(f"(?<{n}>", "(")
    return text.select(*[F.regexp_extract(path, plain, i + 1).alias(n) for i, n in enumerate(names)], F.col("value").alias("text"))


def _field(name: str) -> Column:
    """A top-level field of a flat YAML text, without quotes; null if absent or null."""
    value = F.regexp_extract("text", rf"(?m)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    bare = F.regexp_replace(value, r"^(['\"])(.*)\1$", "$2")
    return F.when(value.isin("", "null", "~"), F.lit(None)).otherwise(bare)


def _last(text: Column) -> Column:
    """The value of a metric file's last line."""
    lines = F.split(F.regexp_replace(text, r"\s+$", ""), r"\n")
    return F.element_at(lines, -1)


def _maps(files: DataFrame, keys: list[str], kinds: list[str]) -> DataFrame:
    """A map column per kind, of key and value."""
    value = F.regexp_replace("text", r"\A\s+|\s+\z", "")
    return files.groupBy(*keys).agg(*[
        F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct("key", value.alias("value")))))).alias(k)
        for k in kinds])


def read_runs(spark: SparkSession, base: str) -> DataFrame:
    """One row per run: experiment, run_id, run_name, status, start_time,
    end_time (timestamps), duration_s, params and tags (string maps), metrics
    (map of doubles).  A run without a ``meta.yaml`` has null times, one without
    values null maps; files elsewhere (artifacts, models) are not read."""
    meta = _files(spark, base, ["*/*/meta.yaml"], r"/(?<experiment>[^/]+)/(?<run_id>[^/]+)/meta\.yaml$")
    meta = meta.where("experiment <> 'models'")
    status = F.create_map(*[x for k, v in STATUS.items() for x in (F.lit(str(k)), F.lit(v))])
    start, end = _field("start_time").try_cast("long"), _field("end_time").try_cast("long")
    meta = meta.select("experiment", "run_id", _field("run_name").alias("run_name"),
                       F.coalesce(status[_field("status")], _field("status")).alias("status"),
                       F.timestamp_millis(start).alias("start_time"), F.timestamp_millis(end).alias("end_time"),
                       ((end - start) / 1000.0).alias("duration_s"))
    values = _files(spark, base, [f"*/*/{k}/*" for k in ("params", "metrics", "tags")],
                    r"/(?<experiment>[^/]+)/(?<run_id>[^/]+)/(?<kind>params|metrics|tags)/(?<key>[^/]+)$")
    maps = _maps(values.where("experiment <> 'models'"), ["experiment", "run_id"], ["params", "metrics", "tags"])
    last = F.transform_values("metrics", lambda _, v: F.try_element_at(F.split(_last(v), r"\s+"), F.lit(2)).try_cast("double"))
    return meta.join(maps, ["experiment", "run_id"], "full").select(*meta.columns, "params", last.alias("metrics"), "tags")


def read_versions(spark: SparkSession, base: str) -> DataFrame:
    """One row per model version: name, version, run_id, stage, created (timestamp), tags and aliases."""
    meta = _files(spark, base, ["models/*/version-*/meta.yaml"], r"/(?<name>[^/]+)/version-(?<version>[0-9]+)/meta\.yaml$")
    meta = meta.select("name", F.col("version").try_cast("long").alias("version"), _field("run_id").alias("run_id"),
                       _field("current_stage").alias("stage"),
                       F.timestamp_millis(_field("creation_timestamp").try_cast("long")).alias("created"))
    tags = _files(spark, base, ["models/*/version-*/tags/*"],
                  r"/(?<name>[^/]+)/version-(?<version>[0-9]+)/(?<kind>tags)/(?<key>[^/]+)$")
    tags = _maps(tags.withColumn("version", F.col("version").try_cast("long")), ["name", "version"], ["tags"])
    alias = _files(spark, base, ["models/*/aliases/*"], r"/(?<name>[^/]+)/aliases/(?<key>[^/]+)$")
    alias = alias.groupBy("name", F.trim("text").try_cast("long").alias("version")).agg(
        F.sort_array(F.collect_list("key")).alias("aliases"))
    return meta.join(tags, ["name", "version"], "left").join(alias, ["name", "version"], "left")


def best_runs(runs: DataFrame, metric: str, by: str = "experiment") -> DataFrame:
    """The run with the highest value of a metric in each group (earliest start, then id, of equals)."""
    scored = runs.where(F.col("metrics")[metric].isNotNull())
    best = F.max_by(F.struct("run_id", "run_name", F.col("metrics")[metric].alias(metric)),
                    F.struct(F.col("metrics")[metric], -F.unix_micros("start_time"), F.md5("run_id")))
    return scored.groupBy(by).agg(best.alias("best")).select(by, "best.*")
