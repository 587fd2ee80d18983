"""Session construction and the shared checkpoint folder.

The builder only sets what a job needs for correct, scalable plans:
AQE (runtime coalescing, skew-join splitting, runtime broadcast choice),
UTC session time, RocksDB streaming state, and the UI off.
Cluster-sized knobs (shuffle partitions, file split size) come from the
caller or the cluster's defaults.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # streaming state (per-key running best / totals) off the JVM heap, with
    # incremental (changelog) checkpoints instead of full snapshots
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "trendspark",
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
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder and register it with the context.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor and
    the driver can reach; it is used as is. Only a local master (tests, the
    bench) may fall back to a fresh temporary folder, removed at exit.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        path = tempfile.mkdtemp(prefix="trendspark-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001  (core confs may be read-only at runtime)
            pass
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder for job-written tables."""
    return os.path.join(checkpoint_dir(spark), *parts)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
