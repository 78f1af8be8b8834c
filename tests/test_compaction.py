"""Compaction of stored tables: readers see the same rows before, during and after, in few files."""
import datetime as dt
import glob
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.compaction import commits, compact, drop_replaced, stored
from tidemark.operators.sinks import append_batch, read_table
from tidemark.session import file_system, scratch_path

DAYS = 3


def batch_rows(spark, batch):
    """Eight rows a day over three days, one with no time at all."""
    at = F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % DAYS) * 86400 + F.col("id") * 60)
    return spark.range(8 * DAYS + 1).select(
        F.concat(F.lit("S"), F.col("id") % 5).alias("symbol"), F.when(F.col("id") < 8 * DAYS, at).alias("window_start"),
        (F.col("id") + 1000 * batch).alias("n"))


def numbers(df):
    return sorted(r["n"] for r in df.select("n").collect())


def files(path, day):
    return glob.glob(f"{path}/dt=2024-01-0{day}/**/*.parquet", recursive=True)


def test_rows_stay_through_compaction(spark):
    path = scratch_path(spark, uuid.uuid4().hex, "t")
    for b in range(4):
        append_batch(batch_rows(spark, b), path, b, "window_start")
    want = numbers(stored(spark, path))
    assert len(want) == 4 * (8 * DAYS + 1) and commits(spark, path) == []
    started = stored(spark, path)  # a reader from before
    done = compact(spark, path, dt.date(2024, 1, 3))
    assert (done.run, done.before, done.batch) == (1, dt.date(2024, 1, 3), 2)
    assert numbers(stored(spark, path)) == want == numbers(started)
    assert compact(spark, path, dt.date(2024, 1, 3)) is None  # nothing new
    assert drop_replaced(spark, path) == 0  # too young
    assert drop_replaced(spark, path, older_than_s=0) == 6  # two dates, batches 0 to 2
    assert numbers(stored(spark, path)) == want
    # the newest batch is replayed, a later one brings rows for closed dates, and all are compacted
    append_batch(batch_rows(spark, 3), path, 3, "window_start")
    append_batch(batch_rows(spark, 4), path, 4, "window_start")
    assert compact(spark, path, dt.date(2024, 1, 4)).run == 2
    drop_replaced(spark, path, older_than_s=0)
    want = numbers(batch_rows(spark, 0).union(batch_rows(spark, 1)).union(batch_rows(spark, 2)).union(batch_rows(spark, 3))
                   .union(batch_rows(spark, 4)))
    assert numbers(stored(spark, path)) == want
    for day in (1, 2, 3):
        assert len(files(path, day)) == 1 and 1 <= len(files(path + ".compacted/rows", day)) <= 3
    one = read_table(spark, path, start=dt.datetime(2024, 1, 2), end=dt.datetime(2024, 1, 2, 23))
    assert one.count() == 5 * 8
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters") >= 2 and "dt" in plan


def test_unfinished_and_rival_runs_change_nothing(spark):
    path = scratch_path(spark, uuid.uuid4().hex, "t")
    assert_rows = lambda: numbers(stored(spark, path))
    append_batch(batch_rows(spark, 0), path, 0, "window_start")
    assert compact(spark, path, dt.date(2024, 1, 4)) is None  # only the newest batch
    append_batch(batch_rows(spark, 1), path, 1, "window_start")
    want = assert_rows()
    assert compact(spark, path, dt.date(2024, 1, 4)).run == 1
    fs, commit = file_system(spark, f"{path}.compacted/commits/1")
    fs.delete(commit, False)  # as if it had failed before its commit
    assert assert_rows() == want
    assert compact(spark, path, dt.date(2024, 1, 3)).run == 1 and assert_rows() == want
    with pytest.raises(Exception):
        stored(spark, path + "-none").count()
