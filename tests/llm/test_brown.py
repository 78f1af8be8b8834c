import collections
import itertools
import math
import zlib

import numpy as np
from pyspark.sql import functions as F
from tables import TINY

from tidemark.llm import base, brown as q, queries


def words(text):
    return [*(text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            .translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ")]


def tokens(text):
    return [w.encode() for w in words(text) if w] + [q.END]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_gain_is_the_change_of_the_likelihood():
    rng = np.random.default_rng(2)
    units, classes = 12, 4
    counts = rng.integers(0, 4, (units, units)).astype(float)

    def pairs(of):
        out = np.zeros((classes, classes))
        for a, b in itertools.product(range(units), repeat=2):
            out[of[a], of[b]] += counts[a, b]
        return out

    def brute(p):
        n, a, b = p.sum(), p.sum(axis=1), p.sum(axis=0)
        return sum(p[i, j] * math.log(p[i, j] * n / (a[i] * b[j])) for i, j in np.argwhere(p)) - n * math.log(n)

    of = rng.integers(0, classes, units)
    assert abs(q.likelihood(pairs(of)) - brute(pairs(of))) < 1e-9
    for u in range(units):
        others = np.arange(units) != u
        left = np.bincount(of[others], counts[others, u], classes)[None]
        right = np.bincount(of[others], counts[u, others], classes)[None]
        gain = q.gains(left, right, counts[u, u][None], of[u][None], pairs(of))[0]
        for c in range(classes):
            moved = of.copy()
            moved[u] = c
            want = q.likelihood(pairs(moved)) - q.likelihood(pairs(of))
            assert abs((gain[c] - gain[of[u]]) - want) < 1e-9


def test_scores_equal_brute_force(spark):
    docs = base.table(spark, TINY, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = docs.select("doc_id", "text", (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2).alias("held_out"))
    texts = q.blocks(kept)
    train = [t for i, text in rows.items() if not held(i) for t in tokens(text)]
    table = q.word_table(texts, len(train))
    model = q.fit(texts, table, len(train), classes=12, rounds=6)
    assert model["total"] == len(train)
    got = {r["doc_id"]: r for r in table.groupBy("block").cogroup(texts.groupBy("block")).applyInPandas(
        q._scorer(model), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double").collect()}

    count = collections.Counter(train)
    share = max(q.SHARE * len(train), 2.0)
    own = sorted({r["unit"] for r in table.where("first").collect() if r["unit"] > q.ENDINGS})
    assert len(own) == sum(c >= share for w, c in count.items() if w != q.END)
    hashes = {r["w"]: r["h"] for r in spark.createDataFrame([(bytearray(w),) for w in count], "w binary").select(
        "w", (F.xxhash64("w").bitwiseAND(F.lit((1 << 62) - 1)) + q.ENDINGS + 1).alias("h")).collect()}
    hashes = {bytes(w): h for w, h in hashes.items()}

    def cls(w):
        if w == q.END:
            return 0
        unit = 1 + q.ENDINGS + own.index(hashes[w]) if count[w] >= share else 1 + zlib.crc32(w[-3:]) % q.ENDINGS
        return model["of"][unit]

    of = {w: cls(w) for text in rows.values() for w in tokens(text)}
    assert all(of[w] > 0 for w in of if w != q.END)
    size, once, pairs = collections.Counter(), collections.Counter(), collections.Counter()
    for w, c in count.items():
        size[of[w]] += c
        once[of[w]] += c == 1
    for i, text in rows.items():
        if not held(i):
            t = tokens(text)
            pairs.update((of[a], of[b]) for a, b in zip([q.END, *t], t))
    n, v = len(train), len(count)
    prior = {k: (size[k] + 0.5) / (n + 0.5 * 12) for k in range(12)}
    before = collections.Counter()
    for (a, _), c in pairs.items():
        before[a] += c

    def p(a, w):
        k = of[w]
        new = 0 if k == 0 else (once[k] + 0.5) / (size[k] + 1)
        word = (1 - new) * count[w] / size[k] if count[w] else new
        return (pairs[a, k] + q.PRIOR * prior[k]) / (before[a] + q.PRIOR) * word

    assert len(got) == len(rows)
    for i, text in rows.items():
        t = tokens(text)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"]) == (held(i), len(t), sum(count[w] > 0 for w in t))
        assert abs(r["base_score"] - sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t)) < 1e-6
        assert abs(r["score"] - sum(math.log10(p(of[a], w)) for a, w in zip([q.END, *t], t))) < 1e-6
    for a in range(12):  # probabilities add up to 1
        total = sum(p(a, w) for w in count) + sum(
            (pairs[a, k] + q.PRIOR * prior[k]) / (before[a] + q.PRIOR) * ((once[k] + 0.5) / (size[k] + 1) if size[k] else 1)
            for k in range(1, 12))
        assert abs(total - 1) < 1e-9


def test_gains_of_rarer_words_equal_the_dense_ones():
    rng = np.random.default_rng(3)
    for turn in range(12):
        k, m = 5, 30
        left, right = (rng.integers(0, 3, (m, k)) * rng.integers(0, 2, (m, k)) * (1, 20)[turn % 2] for _ in range(2))
        left[:, 0] += 1
        own, at, pairs = rng.integers(0, 2, m), rng.integers(1, k, m), rng.integers(0, 50, (k, k)).astype(float)
        for i in range(m):
            pairs[:, at[i]] += left[i]
            pairs[at[i]] += right[i]
            pairs[at[i], at[i]] += own[i]
        rows = np.array(sorted([(i, s * k + c, x[i, c]) for s, x in enumerate((left, right)) for i, c in zip(*np.nonzero(x))]
                               + [(i, 2 * k, 1) for i in np.flatnonzero(own)]))
        got = np.concatenate([g for _, g in q.rare_gains(rows[:, 0], rows[:, 1], rows[:, 2].astype(float), at, pairs)])
        apart = got - q.gains(left.astype(float), right.astype(float), own.astype(float), at, pairs)
        assert np.abs(apart - apart[:, :1]).max() < 1e-8


def test_rarer_words_go_by_their_own_bigrams(spark, docs_of, monkeypatch):
    """Words of one ending and count, met in unlike places, score alike no longer."""
    monkeypatch.setattr(q, "SHARE", 0.01)
    rows = [(i, f"la lb a{i % 20}xyz lc" if i < 100 else f"ma mb b{i % 20}xyz mc") for i in range(200)]
    rows += [(200 + i, "la lb ca lc" if i < 60 else "ma mb cb mc") for i in range(120)]
    rows += [(1000, "la lb a3xyz lc"), (1001, "la lb b3xyz lc"), (1002, "ma mb b7xyz mc"), (1003, "ma mb a7xyz mc")]
    got = {r["doc_id"]: r for r in q.score(docs_of(rows), F.col("doc_id") >= 1000, classes=10, rounds=6).collect()}
    assert {got[i]["base_score"] for i in range(1000, 1004)} == {got[1000]["base_score"]}
    assert got[1000]["score"] > got[1001]["score"] + 0.3 and got[1002]["score"] > got[1003]["score"] + 0.3


def test_classes_and_scores_of_rarer_words_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(q, "SHARE", 1e-3)
    k, docs = 12, base.table(spark, TINY, "documents").repartition(3)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts = q.blocks(docs.select("doc_id", "text", (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2).alias("held_out"))).cache()
    train = [(a, b) for i, text in rows.items() if not held(i) for t in [tokens(text)] for a, b in zip([q.END, *t], t)]
    count = collections.Counter(b for _, b in train)
    table = q.word_table(texts, len(train))
    start = q.fit(texts, table, len(train), classes=k, rounds=4)
    model, settled = q.fit_words(texts, table, len(train), classes=k, rounds=4)
    names, was, of = {r["block"]: r["words"] for r in texts.collect()}, {}, {}
    assert len(names) == 3
    for r in settled.collect():
        u, cls = q._unpack(r["u"], "<i4"), q._unpack(r["cls"], "<i2")
        for i, w in enumerate(map(bytes, names[r["block"]])):
            now = int(cls[i] if count[w] else model["of"][u[i]])
            assert of.setdefault(w, now) == now
            was[w] = int(start["of"][u[i]]), 0 < u[i] <= q.ENDINGS
    before = np.zeros((k, k))
    for a, b in train:
        before[was[a][0], was[b][0]] += 1
    assert (before == start["pairs"]).all()
    left, right, own = {}, {}, collections.Counter()
    for a, b in train:
        if a == b:
            own[a] += 1
        else:
            left.setdefault(b, np.zeros(k))[was[a][0]] += 1
            right.setdefault(a, np.zeros(k))[was[b][0]] += 1
    rare = [w for w in count if was[w][1]]
    assert sum(of[w] != was[w][0] for w in rare) > 0.3 * len(rare) and all(of[w] == was[w][0] for w in count if not was[w][1])
    for w in rare[:400]:
        gain = q.gains(left[w][None], right[w][None], np.array([float(own[w])]), np.array([was[w][0]]), before)[0]
        assert of[w] > 0 and gain[of[w]] >= gain[1:].max() - 1e-5 * (1 + abs(gain).max())
    pairs = np.zeros((k, k))
    for a, b in train:
        pairs[of[a], of[b]] += 1
    assert (pairs == model["pairs"]).all() and q.likelihood(pairs) > q.likelihood(before)
    once = collections.Counter(of[w] for w, c in count.items() if c == 1)
    assert all(abs(model["unseen"][c] - (once[c] + 0.5) / (model["size"][c] + 1)) < 1e-12 for c in range(1, k) if model["size"][c])
    got = {r["doc_id"]: r["score"] for r in settled.groupBy("block").cogroup(texts.drop("words", "n").groupBy("block")).applyInPandas(
        q._scorer(model), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double").collect()}
    size, prior = pairs.sum(axis=0), (pairs.sum(axis=0) + 0.5) / (len(train) + 0.5 * k)
    for i, text in rows.items():
        want, a = 0.0, 0
        for w in tokens(text):
            c = of[w]
            word = (1 - model["unseen"][c]) * count[w] / size[c] if count[w] else model["unseen"][c]
            want, a = want + math.log10((pairs[a, c] + q.PRIOR * prior[c]) / (pairs[a].sum() + q.PRIOR) * word), c
        assert abs(got[i] - want) < 1e-6


def test_held_out_text_scores_above_the_base(spark):
    out = queries.op12_lm_scoring(spark, TINY).toPandas()
    assert out["doc_id"].is_unique and out["train_tokens"].nunique() == 1
    new = out[out["held_out"]]
    assert new["score"].sum() > new["base_score"].sum() + 0.1 * new["n_tokens"].sum()


def test_edges(spark, docs_of):
    held_out = F.col("doc_id") == 9
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two one"), (4, "One two one"), (9, "two É three"), (None, "one é"), (5, "w " * 30000)]
    out = q.score(docs_of(rows), held_out, classes=3, rounds=2).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"]) for r in out) == [
        (0, 3, 3), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 4, 4), (4, 4, 4), (5, 30001, 30001), (9, 4, 2)]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out) and {r["train_tokens"] for r in out} == {30015}
    assert q.score(docs_of([]), held_out).count() == 0
    untrained = q.score(docs_of([(9, "a b"), (9, None)]), held_out).collect()
    assert {r["train_tokens"] for r in untrained} == {0} and all(math.isfinite(r["score"]) for r in untrained)
