import collections
import math

from tables import TINY
from pyspark.sql import functions as F

from tidemark.llm import base, kneser_ney as q


class Brute:
    """Interpolated modified Kneser-Ney written out over dictionaries."""

    def __init__(self, texts):
        counts = collections.Counter(g for t in texts for g in q.grams(t).tolist())
        self.a = {4: counts}
        for k in (4, 3, 2):
            self.a[k - 1] = collections.Counter(g & (1 << 16 * (k - 1)) - 1 for g in self.a[k])
        self.d, self.h = {}, {}
        for k, a in self.a.items():
            n = [sum(v == i for v in a.values()) for i in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if all(n) else 0
            self.d[k] = [min(i, max(0.1, i - (i + 1) * y * n[i] / n[i - 1])) for i in (1, 2, 3)] if all(n) else [0.5, 1, 1.5]
            self.h[k] = {}
            for g, c in a.items():
                t = self.h[k].setdefault((g & (1 << 64) - 1) >> 16, [0, 0.0])
                t[0] += c
                t[1] += min(c, self.d[k][min(c, 3) - 1])

    def p(self, g, k=4):
        if k == 0:
            return 1 / (len(self.a[1]) + 1)
        low = self.p(g & (1 << 16 * (k - 1)) - 1, k - 1)
        c, t = self.a[k].get(g, 0), self.h[k].get((g & (1 << 64) - 1) >> 16)
        return low if t is None else ((c - min(c, self.d[k][min(c, 3) - 1])) + t[1] * low) / t[0]


def test_perplexity_equals_brute_force(spark):
    docs = base.table(spark, TINY, "documents")
    trusted = docs.where("doc_id % 3 = 0")
    got = {r["doc_id"]: r for r in q.perplexities(docs, F.col("doc_id") % 3 == 0).collect()}
    for lang in ("en", "fr"):
        model = Brute([r["text"] for r in trusted.where(F.col("lang") == lang).collect()])
        for r in docs.where(F.col("lang") == lang).limit(12).collect():
            g = q.grams(r["text"]).tolist()
            ln = sum(math.log(model.p(x)) for x in g)
            assert got[r["doc_id"]]["n_grams"] == len(g)
            assert abs(got[r["doc_id"]]["log_prob"] - ln) < 1e-6 * max(1, abs(ln))
        some = next(iter(model.h[4]))
        assert abs(sum(model.p((some << 16) | c) for c in model.a[1]) + model.p((some << 16) | 0xABCD) - 1) < 0.02


def test_trusted_text_is_kept_and_noise_is_not(spark, docs_of):
    text = [f"the cat number {i} sat on mat {i % 7} and looked at dog {i % 5}" for i in range(300)]
    rows = [(i, t) for i, t in enumerate(text)] + [(1000 + i, "#%$ QZXJ!! @@ %% &&") for i in range(5)]
    rows += [(2000, None), (2001, " \n"), (2002, "the cat sat on mat 3", None), (2003, "\U0001f600 cat " * 50)]
    labels = spark.createDataFrame([(i, 1) for i in range(300)] + [(1000, 0), (None, 1), (7, None)], "doc_id bigint, quality int")
    out = {r["doc_id"]: r for r in q.quality_classifier(docs_of(rows), labels).collect()}
    assert sum(out[i]["kept"] for i in range(300)) >= 297
    assert not any(out[1000 + i]["kept"] for i in range(5)) and not out[2000]["kept"] and not out[2001]["kept"]
    assert out[2000]["perplexity"] is None and out[2002]["lang"] is None and out[2002]["kept"]
    assert q.quality_classifier(docs_of([]), labels.limit(0)).count() == 0
