"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on.  AQE re-plans shuffles at run time and
# splits skewed join partitions; the session time zone is pinned so that
# timestamp literals mean the same thing on every executor.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Streaming state on the executors' disks, not in their heaps.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Let the JIT compile large generated methods (wide staged projections)
    # instead of leaving them to the bytecode interpreter.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "custfold") -> SparkSession:
    """Local session for tests and the benchmark; clusters pass their own."""
    master = master or os.environ.get("CUSTFOLD_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("CUSTFOLD_DRIVER_MEM", "8g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a folder that driver and executors share
    and is used as given.  Only a local master may go without it; it gets one
    scratch folder per application.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or getattr(sc, "_custfold_scratch", None)
    if not current:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = sc._custfold_scratch = tempfile.mkdtemp(prefix="custfold-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def is_local(master: str) -> bool:
    """One JVM: every task sees the driver's folders."""
    return master.startswith("local") and not master.startswith("local-cluster")


def folder_version(spark: SparkSession, folder: str) -> tuple:
    """Paths, lengths and modification times of the tables in a folder, so
    that what is kept for a session is not used for changed inputs."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for pattern in ("*.parquet", "*.parquet/*"):
        for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, pattern)) or []:
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))
