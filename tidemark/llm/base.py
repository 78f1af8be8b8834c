"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed value: the white space that separates words, space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package by its path (``--py-files`` does it on a
    cluster whose machines do not share the folder)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, root])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only a local session, of one machine, may name none: then a folder is made and set.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        named = tempfile.mkdtemp(prefix="tidemark-shared-")
        sc.setCheckpointDir(named)
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends
    here, and a lost executor costs no recomputation. Removed when the driver ends."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def bucketed(df: DataFrame, column: str, buckets: int, label: str) -> DataFrame:
    """Like :func:`staged`, as a table bucketed by ``column``: grouping by it then shuffles nothing."""
    spark = df.sparkSession
    name = f"llm_{label}_{uuid.uuid4().hex}"
    path = scratch(spark, label)
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).saveAsTable(name)
    atexit.register(_drop, spark, name)
    return spark.table(name)


def _drop(spark: SparkSession, name: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    except Exception:  # the session has ended
        pass


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended; the cluster cleans the folder
        pass


def words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` with all of its columns in one struct, ``carried``, beside ``columns``: no further
    column of the input can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("carried"), *columns)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that no further column of the input can clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])
