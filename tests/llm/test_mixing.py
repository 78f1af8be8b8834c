from tables import TINY
from pyspark.sql import functions as F

from tidemark.llm import base, mixing as q


def expected(sizes):
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        out = {s: 3 * sizes[s] if s in capped else rest * w / open_weight for s, w in weight.items()}
        over = {s for s in out if s not in capped and out[s] > 3 * sizes[s]}
        if not over:
            return out
        capped |= over


def check(docs):
    rows = q.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    rows["source"] = rows["source"].astype(object).where(rows["source"].notna(), None)
    sizes = {s: int(g["size"].sum()) for s, g in rows.groupby("source", dropna=False)}
    sizes = {None if s != s else s: n for s, n in sizes.items()}
    want = expected(sizes)
    for s, g in rows.groupby("source", dropna=False):
        s = None if s != s else s
        assert abs(g["target"].iloc[0] - want[s]) < 1e-6 and (g["source_size"] == sizes[s]).all()
        assert abs(g["taken"].sum() - want[s]) <= 1
    assert (rows["taken"] <= 3 * rows["size"]).all()
    return rows


def test_targets_and_quotas(spark):
    docs = base.table(spark, TINY, "documents")
    a = check(docs)
    b = q.mix(docs.repartition(5)).toPandas()
    key = ["doc_id", "taken", "passes"]
    assert a[key].sort_values(key).values.tolist() == b[key].sort_values(key).values.tolist()


def test_caps_nulls_and_hot_source(spark, docs_of):
    rows = [(i, "w " * (50 + i % 7), "en", "big") for i in range(300)] + [(1000, "a b c", "en", None), (1001, None, "en", "c")]
    rows += [(2000 + i, "x y", "en", "d") for i in range(5)]
    check(docs_of(rows))
    assert q.mix(docs_of([])).count() == 0
    only_empty = q.mix(docs_of([(1, None), (2, "")])).collect()
    assert [(r["taken"], r["target"]) for r in only_empty] == [(0, 0.0), (0, 0.0)]


def test_schedule_is_even_throughout(spark):
    quotas = spark.createDataFrame([("=a", 1000 * 1024, 600 * 1024, 600, 0.0, 0.6), ("=b", 100 * 1024, 300 * 1024, 300, 0.6, 0.9),
                                    ("=c", 500 * 1024, 100 * 1024, 100, 0.9, 1.0)],
                                   "key string, source_size bigint, quota bigint, need bigint, lo double, hi double")
    slots = q.schedule(quotas, 1000).orderBy("slot").toPandas()
    for share, key in ((0.6, "=a"), (0.3, "=b"), (0.1, "=c")):
        for n in (50, 200, 700, 1000):
            assert abs((slots["key"][:n] == key).sum() - share * n) <= 4
    assert slots.groupby("key")["words"].sum().to_dict() == {"=a": 600 * 1024, "=b": 300 * 1024, "=c": 100 * 1024}


def test_stage_repeats_documents(spark, docs_of):
    docs = docs_of([(i, "w " * 40, "en", s) for i, s in enumerate("abc" * 30)])
    out = q.mixed_documents(docs)
    assert out.columns == docs.columns
    n = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert [abs(n[s] - 30 * w / 2) <= 1 for s, w in (("a", 1), ("b", 2), ("c", 3))] == [True] * 3


def test_words_taken_against_a_walk_through_each_stream(spark, docs_of):
    """A source's stream is walked word by word, again from its start when it ends, until its
    target is reached; each document's words on the way are counted."""
    from collections import Counter
    from math import floor

    rows = [(i, "w " * (7 * i % 61), "en", "ab"[i % 5 == 0]) for i in range(120)]
    rows += [(200 + i, "v " * 400, "en", "c") for i in range(4)] + [(300, "u " * 5000, "en", "d"), (400, "t t", "en", None)]
    docs = docs_of(rows)
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    order = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.xxhash64("doc_id", tag, F.lit(5)).alias("h")).collect()}
    sizes = {d: len(t.split()) for d, t, *_ in rows}
    totals = Counter()
    for d, _, _, s in rows:
        totals[s] += sizes[d]
    want, firsts = Counter(), Counter()
    for source, target in expected(totals).items():
        stream = [(d, at) for d in sorted((r[0] for r in rows if r[3] == source), key=order.get) for at in range(sizes[d])]
        for n in range(min(floor(target + 0.5), 3 * totals[source])):
            d, at = stream[n % len(stream)]
            want[d] += 1
            firsts[d] += at == 0
    got = {r["doc_id"]: (r["taken"], r["passes"]) for r in q.mix(docs, block=64).collect()}
    assert got == {d: (want[d], firsts[d] if n else 1) for d, n in sizes.items()}
