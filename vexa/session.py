"""Session construction and the shared scratch location.

On a cluster, intermediate tables (postings, cell assignments, table
versions, stream checkpoints) must live in a folder every executor can
reach.  We take it from ``spark.checkpoint.dir``; only a local session
with no such setting (tests, laptops) gets a fresh folder under the system
temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast joins are requested explicitly and only for inputs whose size
    # was checked; keep the automatic threshold at Spark's default.
}


def get_session(master: str | None = None, app: str = "vexa",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``vexa`` importable in Python workers (Arrow / pandas UDFs refer
    to it): zip the package once and hand it to ``SparkContext.addPyFile``,
    which distributes it like ``--py-files``.  A no-op when already shipped
    to this application."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="vexa-pyfiles-"), "vexa.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir``.  A local-mode session without the
    setting gets a new temp folder; a cluster session without it is an
    error, because a machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            base = None
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        base = tempfile.mkdtemp(prefix="vexa-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name inside the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "vexa", f"{name}-{uuid.uuid4().hex[:12]}")
