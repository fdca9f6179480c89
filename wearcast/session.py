"""Session helpers: a local session for tests/bench and a checkpoint folder.

On a cluster the caller owns the session; nothing here overrides settings
that are already present.
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.python.unix.domain.socket.enabled": "true",  # halves the fixed cost of a job with Python in it
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


_SHIPPED: set[str] = set()
_PKG_DIR = os.path.dirname(os.path.abspath(__file__))


def ship_package(spark: SparkSession) -> None:
    """Make ``wearcast`` importable in Python workers (Arrow batch functions
    reference it), once per application: zip the package and ``addPyFile``
    it, the standard way to distribute Python code to executors."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    out = tempfile.mkdtemp(prefix="wearcast-pkg-")
    archive = shutil.make_archive(os.path.join(out, "wearcast"), "zip", os.path.dirname(_PKG_DIR), "wearcast")
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def local_session(cores: int | str = "*", app: str = "wearcast", **conf: str) -> SparkSession:
    """Session for tests and the local benchmark (UI off, AQE on)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset
    (local tests) fall back to a fresh folder under the temp dir."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="wearcast-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared folder), survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def env_cores(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))
