"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the no-op sink (full evaluation, no
driver collect). After one untimed warm-up pass over all queries, the best of
$BENCH_REPEAT (default 1) timed runs is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tidemark import catalog  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def bench_stream(spark, sf_dir: str, files: int = 6) -> dict:
    """The market stream (reference defaults: 1 min / 30 s windows, 30 s watermark) over
    the fixture trades landed as ordered files; throughput from StreamingQueryProgress."""
    import uuid

    from tidemark.session import scratch_path
    from tidemark.sources.fixtures import Fixture, land_raw_trades
    from tidemark.sources.trades import clean_trades, read_trades
    from tidemark.streaming.app import start_market_stream

    root = scratch_path(spark, "bench", uuid.uuid4().hex)
    land_raw_trades(Fixture(spark, sf_dir), f"{root}/in", n_files=files)
    trades = clean_trades(read_trades(spark, f"{root}/in", "parquet", maxFilesPerTrigger=1),
                          event_time="timestamp")
    t0 = time.perf_counter()
    q = start_market_stream(trades, f"{root}/out", checkpoint=f"{root}/ckpt",
                            trigger={"availableNow": True}, query_name="bench-stream")
    q.awaitTermination()
    wall = time.perf_counter() - t0
    prog = [p for p in q.recentProgress if p["numInputRows"] > 0]
    rows = sum(p["numInputRows"] for p in prog)
    busy = sum(p["durationMs"]["triggerExecution"] for p in prog) / 1000.0
    return {"input_rows": rows, "batches": len(prog), "wall_sec": round(wall, 3),
            "rows_per_sec": round(rows / busy, 1) if busy else None,
            "avg_batch_ms": round(1000 * busy / len(prog), 1) if prog else None}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    warmup = os.environ.get("BENCH_WARMUP", "1") == "1"
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    shared = os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="tidemark-bench-")  # one machine
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.checkpoint.dir": shared})
    # the queries that run a whole stream are measured by bench_stream, as throughput
    qs = {k: f for k, f in catalog.queries().items() if not k.startswith("stream_") and k != "alert_audit"}
    # JIT / codegen warm-up: one untimed pass over every query (a cold JVM runs the
    # first queries of a session several times slower than steady state)
    errors: dict[str, str] = {}
    for name, fn in qs.items():
        if warmup and (not only or name in only):
            try:
                run(fn(spark, sf_dir))
            except Exception as exc:  # reported below; one failing query must not hide the rest
                errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    times: dict[str, float] = {}
    for name, fn in qs.items():
        if (only and name not in only) or name in errors:
            continue
        best = float("inf")
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                run(fn(spark, sf_dir))
                best = min(best, time.perf_counter() - t0)
            times[name] = round(best, 3)
        except Exception as exc:
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    stream = None
    if os.environ.get("BENCH_STREAM", "1") == "1":
        try:
            stream = bench_stream(spark, sf_dir)
        except Exception as exc:
            errors["streaming"] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "sum_of_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
        "streaming": stream,
    }
    if errors:
        out["errors"] = errors
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
