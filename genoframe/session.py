"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "genoframe") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster, ``master`` is left to spark-submit and the cluster's own
    ``spark.checkpoint.dir`` is kept.  Locally (tests, bench) a checkpoint
    folder is created only when none is configured.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:                  # else the cluster's own value holds
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b.config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``genoframe`` importable on every executor's Python workers (once per context).

    Pandas UDFs defined in the package are pickled by reference, so executors need
    the package; it is zipped on the driver and distributed with ``addPyFile`` (the
    same mechanism as ``--py-files``).
    """
    sc = spark.sparkContext
    if getattr(sc, "_genoframe_shipped", False):
        return
    import zipfile

    import genoframe
    root = os.path.dirname(os.path.abspath(genoframe.__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="genoframe-pkg-"), "genoframe.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(zpath)
    sc._genoframe_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        # A cluster must name a shared folder: executors do not see each other's disks.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="genoframe-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def written(df, name: str = "written"):
    """``df`` as a Parquet table in the shared folder: cuts the lineage like a checkpoint, but by column and compressed, and reads back only
    the columns that are used."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
