"""Session helpers.

Cluster settings are never overridden: the checkpoint directory is read from the running
session (``spark.checkpoint.dir``) and only filled in for a local master; elsewhere an unset
folder is an error, because executors do not share the driver's disk.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "revlens") -> SparkSession:
    """A local session for tests / bench. On a cluster use the session you are given."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    if str(cores).isdigit():
        b = b.config("spark.revlens.scanPartitions", str(cores))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _local_scratch(master: str) -> str:
    """A private folder for a single-process session; executors elsewhere would not see it."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
    return tempfile.mkdtemp(prefix="revlens-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory; set a scratch one only when none is configured."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = _local_scratch(sc.master)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package wherever the session was started. Where executors have
    other disks, the package is installed there or shipped with the job."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


#: Scratch paths of each application, for release().
_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory for materialised intermediates."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """Paths given out and not yet released."""
    return _SCRATCH.get(spark.sparkContext.applicationId, [])


def file_folder(spark: SparkSession, name: str) -> str | None:
    """A fresh folder of the shared one, as a URI, for files that tasks write and read themselves; None where pyarrow
    doesn't reach it."""
    from pyarrow import ArrowException, fs

    path = scratch_path(spark, name)
    uri = path if "://" in path else f"file://{path.removeprefix('file:')}"
    try:
        store, base = fs.FileSystem.from_uri(uri)
        store.create_dir(base, recursive=True)
    except (ArrowException, OSError):
        return None
    return uri


def discard(spark: SparkSession, path: str) -> None:
    """Delete one path of the shared folder before ``release`` would."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. DataFrames that read them are done with then."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
