"""Session construction and the shared scratch/checkpoint location.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by the
cluster).  Only on a ``local`` master, where every task shares the machine, is a
private folder under the system temp directory made when nothing is configured;
any other master without a shared folder is an error.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sliding windows and carry tables are small; let AQE turn shuffle joins
    # into broadcast joins only from measured runtime sizes.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "eventide", extra: dict | None = None) -> SparkSession:
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


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``SparkContext.getCheckpointDir`` or
    ``spark.checkpoint.dir``); a private one is made only where neither is set
    and the master is local.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SCRATCH: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under this application's folder in the shared
    checkpoint folder; the folder goes when the Python process ends."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = os.path.join(checkpoint_root(spark), "eventide", uuid.uuid4().hex[:12])
        atexit.register(_drop_folder, spark.sparkContext._jvm, _SCRATCH[app])
    return os.path.join(_SCRATCH[app], f"{name}-{uuid.uuid4().hex[:12]}")


def _drop_folder(jvm, folder: str) -> None:
    """Delete a scratch folder at exit, through whatever file system it is in; with the JVM gone it stays."""
    with contextlib.suppress(Exception):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)


@contextlib.contextmanager
def sql_view(df, name: str) -> Iterator[str]:
    """A temporary view of a name that no other query in the session has; dropped after the plan is built."""
    view = f"{name}_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    try:
        yield view
    finally:
        df.sparkSession.catalog.dropTempView(view)


def materialize(df):
    """Cut lineage between chained passes: write the intermediate result as a
    Parquet table in the shared checkpoint folder (never a machine-local
    cache) and read it back.  Later passes read the written files instead of
    recomputing every upstream branch (each ordered pass reads its input
    twice), and a lost executor costs only the pass it was running."""
    path = scratch_path(df.sparkSession, "pass")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED_KEY = "spark.eventide.shippedPyFile"


def ship_package(spark: SparkSession) -> None:
    """Make ``eventide`` importable on every Python worker (the streaming
    processors are pickled by reference), wherever the driver runs: zip the
    package once per session and ``addPyFile`` it.  Batch operators are pure
    JVM expressions and do not need this."""
    if spark.conf.get(_SHIPPED_KEY, "") == "true":
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark)
    local = root[len("file:"):] if root.startswith("file:") else None
    folder = os.path.join(local, "eventide-pyfiles") if local else tempfile.mkdtemp(prefix="eventide-pyfiles-")
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, f"eventide-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(target)
    spark.conf.set(_SHIPPED_KEY, "true")


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the input files, from file-system metadata only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)
