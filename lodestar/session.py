"""Session helpers: building a local session for tests/bench and locating the
shared scratch folder that jobs use to cut lineage or write round-trip files.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names (a
shared filesystem such as HDFS/S3/ABFS).  Only when it is unset -- local runs
and tests -- do we create one under the system temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app_name: str = "lodestar") -> SparkSession:
    """A local session configured the way tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    The cluster's setting always wins; a temp folder is made only for local
    sessions that did not name one (tests, the bench).
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        if not configured:
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared folder for "
                "checkpoints and round-trip files")
        configured = tempfile.mkdtemp(prefix="lodestar-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    _scratch.append(os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}"))
    return _scratch[-1]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this job wrote and has read for the last time."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean_scratch(spark: SparkSession) -> None:
    """Deletes all folders :func:`scratch_path` has named.  Call it when the
    frames that read them are done with: results are lazy, so a query cannot
    delete its own."""
    while _scratch:
        remove_folder(spark, _scratch.pop())


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder under the shared scratch folder and read
    back: the lineage ends there, and lost executors do not lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application: functions that
    run inside tasks are pickled by name, so their Python workers import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lodestar-package-"), "lodestar-package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("lodestar", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
