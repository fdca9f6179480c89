"""Model versions that concurrent trainings cannot mix up.

A training claims its version number by creating a file that must not exist
yet, saves the model beside its place and renames it there, and only then adds
its row to the registry.  So two trainings never share a number, a version that
is listed is complete, and a training that fails leaves a gap and nothing else.

The claim needs a store whose create-without-overwrite is atomic (HDFS, object
stores with conditional writes, local disks)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _store(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already."""
    fs, p = _store(spark, path)
    try:
        if fs.getScheme() == "file":  # Hadoop's local store checks and creates in two steps
            nio = spark._jvm.java.nio.file
            nio.Files.createFile(nio.Path.of(fs.makeQualified(p).toUri()), spark.sparkContext._gateway.new_array(
                nio.attribute.FileAttribute, 0))
        else:
            fs.create(p, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def claim_version(spark: SparkSession, base: str, name: str, after: int = 0) -> int:
    """The next free version number of a model, from now on this caller's; above ``after``."""
    folder = f"{base}/claims/{name}"
    fs, p = _store(spark, folder)
    fs.mkdirs(p)
    taken = [int(n) for n in _names(spark, folder) if n.isdigit()]
    version = max([after, *taken]) + 1
    while not _create(spark, f"{folder}/{version}"):
        version += 1
    return version


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, a = _store(spark, source)
    b = _store(spark, target)[1]
    if fs.exists(b):
        raise FileExistsError(target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{source} could not be renamed to {target}")


def publish_model(spark: SparkSession, model: PipelineModel, base: str, name: str, version: int) -> str:
    """Save under a claimed version: whole or not at all."""
    staging = f"{base}/staging/{uuid.uuid4().hex}"
    model.write().save(staging)
    target = f"{base}/models/{name}/{version}"
    _move(spark, staging, target)
    return target


def append_rows(rows: DataFrame, path: str) -> None:
    """Add a few rows to a table as one file under a name of its own (two
    ordinary appends to a folder at once share its temporary files)."""
    spark, staging = rows.sparkSession, f"{path}-staging-{uuid.uuid4().hex}"
    rows.coalesce(1).write.parquet(staging)
    for n in _names(spark, staging):
        if n.endswith(".parquet"):
            _move(spark, f"{staging}/{n}", f"{path}/part-{uuid.uuid4().hex}.parquet")
    fs, p = _store(spark, staging)
    fs.delete(p, True)
