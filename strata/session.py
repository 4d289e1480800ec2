"""Session and shared-storage helpers.

Everything that writes (landing files, raw tables, dimension state, compacted
copies) goes below one *shared* root taken from the session's
``spark.checkpoint.dir``. On a cluster that setting names storage every
executor can reach; we never fall back to a machine-local folder there. Only
when the setting is absent (local tests) do we pick a directory ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings we want on every session we create ourselves. A session handed to us
# by a cluster keeps its own values; ``tune`` only fills the few that matter
# for correctness of the library (ANSI off for try-casts is NOT needed: we use
# the try_* functions, which work under ANSI) and for skew handling.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strata") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting a local session (``local``, ``local[n]``) gets a
    directory under the system temp directory, once; any other master is an
    error, as its executors could not reach such a directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to storage that all executors share (master {master})")
        # a core setting cannot be changed on a running session; the
        # context's checkpoint directory can, and is found again next time
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory below the shared root for one run."""
    return f"{shared_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


# Paths, through Hadoop's file system interface: existence is asked for, never
# inferred from a failed read.

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory (none if it does not exist)."""
    p, fs = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a directory holds a visible entry, which a reader would read."""
    return any(not n.startswith(".") and (not n.startswith("_") or "=" in n) for n in names_below(spark, path))


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or directory; parents of the target are made."""
    p, fs = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written by the driver."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
