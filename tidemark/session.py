"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Local/test session: UTC, AQE on, UI off, Arrow on.

    On a cluster the launcher supplies master, memory and ``spark.checkpoint.dir``;
    this helper only fills in what is unset.
    """
    _export_package_path()
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.appName(app_name)
    if master or not os.environ.get("SPARK_MASTER"):
        b = b.master(master or f"local[{cpus}]")
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or int(cpus)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "8g"),
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _export_package_path() -> None:
    """Python workers (stateful streaming processor) must import this package. In
    local mode they inherit the JVM's environment, fixed when the JVM starts; on a
    cluster ship the package with ``--py-files`` instead."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parts = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *parts])


def export_package(spark: SparkSession) -> SparkSession:
    """Let Python workers of a running session import this package by its path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, root])
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names. It must be set: a folder made
    here would be local to one machine, and executors would not see each other's files."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path as it names it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def cluster_conf(input_bytes: float, executors: int, cores_per_executor: int,
                 executor_memory_gb: float = 16.0) -> dict[str, str]:
    """Suggested settings for a large cluster run (pass to ``spark-submit --conf``).

    * Scans: 256 MB splits — trade files are read once per job and every scan
      feeds a partial aggregate, so larger splits mean fewer tasks, not more spill.
    * Shuffles: the heavy aggregation shuffles pre-aggregated (symbol, window)
      rows, a small fraction of the input, so partitions are sized by cores
      (~3 per core), not by input bytes; AQE coalesces to ~128 MB partitions and
      splits skew. (One partition per GB of input would mean ~10^5 reducers x
      ~4·10^5 map tasks of shuffle blocks at 100 TB.)
    * State: RocksDB with changelog checkpointing keeps streaming state off-heap.
    * Executor loss: decommissioning migrates shuffle blocks; reliable checkpoint
      files in the shared ``spark.checkpoint.dir`` are cleaned when unreferenced.
    """
    cores = max(1, executors * cores_per_executor)
    parts = 3 * cores
    per_task_mb = executor_memory_gb * 1024 * 0.6 / max(1, cores_per_executor)
    split_mb = 256 if per_task_mb >= 1024 else 128
    return {
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "10m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.ui.enabled": "false",
    }
