import collections
import math
import re

from pyspark.sql import functions as F

from tables import TINY
from tidemark.llm import base, quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


EDGES = [None, "", " \t\n", "one", "a b c a b c", "a a a a a", "x y z", "é ü\nfoo\nfoo\n\nfoo", "#|<> $%&*",
         "w " * 30000, "a b c d " * 3 + "z", "\u000bq\u000cq\rq"]


def test_counts_equal_brute_force(spark, docs_of):
    texts = EDGES + [r["text"] for r in base.table(spark, TINY, "documents").collect()]
    docs = docs_of([(i, t) for i, t in enumerate(texts)])
    got = {r["doc_id"]: tuple(r[c] for c in q.COUNTS[:5]) for r in q.measure(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, p) for n in (1, 7, 60, 900) for p in (0.01, 0.3) for k in range(0, max(1, int(n * p)))]
    for n, k, p in cases[:: max(1, len(cases) // 40)]:
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(q.log_binomial_tail(F.lit(n), F.lit(k), p).alias("x")).first()["x"]
        assert abs(math.exp(got) - exact) < 1e-9 * max(1, exact) + 1e-12


def test_only_certified_cutoffs_reject(spark, docs_of):
    clean = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"word{i}###" for i in range(60))
    docs = docs_of([(i, clean) for i in range(2000)] + [(10_000 + i, noisy) for i in range(50)])
    labels = spark.createDataFrame([(i, 1) for i in range(2000)] + [(10_000 + i, 0) for i in range(50)] + [(5, None), (None, 1)],
                                   "doc_id bigint, quality int")
    out = q.quality_rules(docs, labels)
    assert {(r["doc_id"] >= 10_000, r["kept"]) for r in out.collect()} == {(False, True), (True, False)}
    few = q.quality_rules(docs, labels.where("doc_id % 100 = 0"))  # too few labels to certify any cutoff
    assert few.where("NOT kept").count() == 0


def test_stage_keeps_columns_and_empty_tables_work(spark, docs_of):
    docs = docs_of([(1, "a b"), (1, "a b"), (2, " ".join(f"w{i}" for i in range(80)), None)])
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [2]
    assert q.quality_rules(docs.limit(0), labels).count() == 0
