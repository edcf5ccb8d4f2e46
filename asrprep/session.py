"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults for a local run; on a cluster the submitted configuration wins because
# ``getOrCreate`` keeps an existing session and only fills in what is unset.
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # CPU-heavy row work (regex folds, substring generation) follows small shuffles: do not merge
    # them below 256 KB, or a few MB of text end up in one task (no effect on large partitions)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # audio rows are large: bound Arrow batches by bytes as well as by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # pinned (checkpointed) intermediates are deleted once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "asrprep", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_LOCAL_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    running = SparkSession.getActiveSession()
    SparkContext._ensure_initialized()  # so that SparkConf sees what spark-submit passed
    submitted = running.sparkContext.getConf() if running else SparkConf()  # also what spark-submit --conf set
    for k, v in conf.items():
        set_by_user = submitted.contains(k) or (running is not None and running.conf.get(k, None) is not None)
        if not set_by_user or k in (extra or {}):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``asrprep`` importable in Python workers (UDFs and ``mapInPandas`` functions refer to
    it by module): zip the package once and add it with ``addPyFile``, as ``--py-files`` would."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="asrprep-pyfiles-"), "asrprep.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def prepare_session(spark: SparkSession) -> SparkSession:
    """Everything a session needs before running this library's jobs."""
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or the context's checkpoint dir). Only when
    neither is set, as in tests on one machine, a private folder under the system temp dir is used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="asrprep-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def pin(df):
    """Reliable checkpoint into the shared checkpoint folder: computes ``df`` once, cuts its
    lineage, and survives the loss of executors (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
