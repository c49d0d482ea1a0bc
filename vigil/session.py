"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Settings every job relies on. AQE gives runtime partition coalescing, skew-join splitting and a
# size-checked broadcast conversion; UTC keeps date arithmetic independent of the host.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a checkpoint goes when its DataFrame does
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "vigil", extra: dict | None = None) -> SparkSession:
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
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    In local mode a session without one gets a fresh folder, so that ``DataFrame.checkpoint`` and the scratch
    tables below work the same way everywhere; on a cluster the setting is required. What a job writes
    there stays until the folder is cleared between runs (``spark.cleaner.referenceTracking.cleanCheckpoints``
    removes checkpoints whose DataFrames are gone; a lifetime rule on the folder covers the rest).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="vigil-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path under the shared folder (one per call)."""
    return f"{shared_dir(spark)}/vigil/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d if "://" in d else os.path.abspath(d))
    return d


def materialize(df, eager: bool = True):
    """Cut the lineage of a DataFrame that several branches reuse: a reliable checkpoint into the
    shared ``spark.checkpoint.dir`` (it survives the loss of executors, unlike a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def in_parallel(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """The results of independent pieces of driver code, each with its own Spark jobs, run at the same time: the
    scheduler fills cores that one job leaves idle."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``vigil`` importable in the Python workers (what ``--py-files`` does at submit time).

    Needed only by operators that run Python inside tasks. The zip is written once per application, into
    the shared folder through Spark's own file system layer, and distributed by Spark with every task.
    """
    import io
    import zipfile

    import vigil

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(vigil.__file__))
    root = os.path.dirname(pkg_dir)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/vigil/pyfiles-{uuid.uuid4().hex}/vigil.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target.toString())
    _SHIPPED.add(sc.applicationId)
