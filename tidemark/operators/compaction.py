"""Compaction of stored tables (O-32): a stream appends a folder per date and batch; those of closed
dates are rewritten to a few sorted files.

Compacted rows lie beside the table, ``<path>.compacted/rows``, by the table's dates and a name that each
run gives itself. A run counts from the moment its commit, one small file, names it; the newest
commit says which folders of the table its runs replace: those of dates before ``before`` and of batches
up to ``batch``. :func:`stored` reads the newest commit first and takes every row from exactly one place,
so readers see the same rows before, during and after a run, and after a run that failed half-way. The
replaced folders stay for readers that started earlier, until :func:`drop_replaced`.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import file_system


@dataclass(frozen=True)
class Commit:
    run: int
    name: str
    before: dt.date
    batch: int
    written_ms: int = 0

    def replaces(self) -> Column:
        """Rows of the table that compacted ones stand for; rows without a date are never compacted."""
        return F.coalesce((F.col("dt") < F.lit(self.before)) & (F.col("batch_id") <= F.lit(self.batch)), F.lit(False))


def _paths(path: str) -> tuple[str, str]:
    root = path.rstrip("/") + ".compacted"
    return f"{root}/rows", f"{root}/commits"


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """The committed runs over the table, oldest first (one listing, one small file each)."""
    fs, folder = file_system(spark, _paths(path)[1])
    if not fs.exists(folder):
        return []
    out = []
    for st in fs.listStatus(folder):
        name = st.getPath().getName()
        if name.isdigit():
            text = spark.read.text(st.getPath().toString(), wholetext=True).head()[0]
            said = json.loads(text)
            out.append(Commit(int(name), said["name"], dt.date.fromisoformat(said["before"]), said["batch"], st.getModificationTime()))
    return sorted(out, key=lambda c: c.run)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table by date and batch, each once, compacted or not; ``batch_id`` is null where
    they are. Predicates on dates and columns reach both scans."""
    done = commits(spark, path)
    table = spark.read.option("basePath", path).parquet(path)
    if not done:
        return table
    rows = _paths(path)[0]
    compacted = spark.read.option("basePath", rows).parquet(rows).where(F.col("run").isin([c.name for c in done])).drop("run")
    return table.where(~done[-1].replaces()).unionByName(compacted, allowMissingColumns=True)


def compact(spark: SparkSession, path: str, before: dt.date, keys: tuple[str, ...] = ("symbol", "window_start"),
            dates: tuple[str, ...] = ("dt",)) -> Commit | None:
    """Rewrite the folders of dates before ``before``, sorted by ``keys``; returns the commit, or None where
    there is nothing to do. ``dates`` are the table's partition columns other than ``batch_id``.

    The newest batch of the table is left alone: it may still be written, or be replayed. Rows that come
    later for a closed date are found where they landed, and join the next run. One run at a time: of two
    that overlap the second fails on its commit and changes nothing.
    """
    table = spark.read.option("basePath", path).parquet(path)
    done = commits(spark, path)
    newest = table.agg(F.max("batch_id")).head()[0]
    if newest is None or newest == 0:
        return None
    name = f"r{uuid.uuid4().hex}"
    this = Commit(1, name, before, newest - 1)
    if done:
        last = done[-1]
        this = Commit(last.run + 1, name, max(before, last.before), max(newest - 1, last.batch))
        table = table.where(~last.replaces())
    todo = table.where(this.replaces()).drop("batch_id")
    if todo.isEmpty():
        return None
    rows, folder = _paths(path)
    (todo.withColumn("run", F.lit(name)).repartitionByRange(*dates, *keys).sortWithinPartitions(*dates, *keys)
     .write.mode("append").partitionBy(*dates, "run").parquet(rows))
    fs, place = file_system(spark, f"{folder}/{this.run}")
    fs.mkdirs(place.getParent())
    _, draft = file_system(spark, f"{folder}/_{name}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"name": name, "before": this.before.isoformat(), "batch": this.batch}).encode()))
    finally:
        out.close()
    if fs.exists(place) or not fs.rename(draft, place):
        raise RuntimeError(f"run {this.run} over {path} was committed by another one")
    return this


def drop_replaced(spark: SparkSession, path: str, older_than_s: float = 3600.0) -> int:
    """Delete the table's folders that a commit at least ``older_than_s`` seconds old replaces; readers that
    started before it must have ended. Returns the number of folders deleted."""
    now = int(spark.range(1).select(F.unix_millis(F.current_timestamp())).head()[0])
    old = [c for c in commits(spark, path) if now - c.written_ms >= older_than_s * 1000]
    if not old:
        return 0
    fs, root = file_system(spark, path)
    gone = 0

    def walk(folder, closed: bool) -> None:
        nonlocal gone
        for st in fs.listStatus(folder):
            name, _, value = st.getPath().getName().partition("=")
            if not st.isDirectory() or not value:
                continue
            if name == "batch_id":
                if closed and int(value) <= old[-1].batch:
                    fs.delete(st.getPath(), True)
                    gone += 1
            elif name == "dt":
                if value[:2] != "__" and dt.date.fromisoformat(value) < old[-1].before:
                    walk(st.getPath(), True)
            else:
                walk(st.getPath(), closed)

    walk(root, False)
    return gone
