"""Session construction and the shared scratch area.

Scratch output (landed pages, raw files, checkpoints of streaming loads) always lives below the
folder the cluster names in ``spark.checkpoint.dir``. Only a local-mode session that has no such
setting gets one of its own.
"""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.aggregatePushdown": "true",
    # No broadcast from static size estimates (compressed file sizes): joins broadcast only from
    # AQE's measured runtime sizes or an explicit hint placed after a size check.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and skew-join handling switched on."""
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
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When the setting is absent we only invent one for a local-mode session (tests, laptops);
    on a cluster a machine-local folder would not be visible to executors, so we refuse.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    # spark.checkpoint.dir is a static setting; without it, use (or set) the context's folder
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tessera/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path: works for every store that Spark reads."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def is_complete(spark: SparkSession, path: str) -> bool:
    """Has a job committed this folder? (Spark's committer leaves ``_SUCCESS`` as its last step.)"""
    fs, mark = file_system(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(mark)


def write_once(spark: SparkSession, path: str, build, *, partition_by=(), **options) -> str:
    """Write ``build()`` to ``path`` as Parquet unless a job has committed that folder before.

    Stages of a run write below their run stamp with this, so running a stamp again - after a crash
    or by mistake - reuses what is complete and redoes the rest: it never adds to it.
    """
    if not is_complete(spark, path):
        build().write.mode("overwrite").options(**options).partitionBy(*partition_by).parquet(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per context), as ``spark-submit --py-files`` would.

    Python workers then import it wherever the driver was started from.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tessera-ship-"), "tessera_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tessera", os.path.relpath(full, package)))
    sc.addPyFile(archive)
    sc._tessera_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
