"""Operator 1: toxicity by a subsequence string kernel with Nystroem landmarks.

The kernel compares two words by their common subsequences of three letters or digits; each
occurrence weighs ``DECAY`` to the power of its span, so letters in between (``idxiot``), other
characters (``i.d.i.o.t``) and letters written apart (``i d i o t``) cost some similarity and no
more. Its feature space is explicit (triples of letters), so a support vector machine on
Nystroem features of a few landmark words is, exactly, one weight per triple of the landmarks:
scoring a word is a gather over its triples and a division by its length in feature space.

Training is multiple-instance, on labelled sentences: a sentence is toxic if only toxic
documents hold it. Words that toxic sentences hold far oftener than chance are witnesses, the
positive examples, and so are inflections: words that share a beginning with that property and
that no clean sentence holds. Each is also taken with a letter put in. Words of clean sentences
are negative, in rounds that add those which the machine so far takes for toxic. A document's
score is a logistic of its three highest word margins.
"""

from __future__ import annotations

import heapq
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .base import only, prepare, staged

#: Labelled documents of a class that are learned from, at most.
SAMPLE = 6000
#: Decay per character of span, longest span, letters of a window of a longer word.
DECAY, SPAN, WINDOW = 0.8, 12, 24
#: Most witnesses, clean landmarks, negatives of a kind and rounds of harder ones.
WITNESSES, LANDMARKS, NEGATIVES, ROUNDS = 160, 96, 2500, 3
COST = 4.0
#: Lengths of the beginnings of words that count as witnesses too, and what marks one in the counts.
STEMS, STEM = (4, 5, 6, 7), "\x00"
#: Highest margins of a text that its score goes by.
TOP = 3
#: Words whose margins a task remembers, and texts it takes apart at a time.
MEMORY, GROUP = 300_000, 100

_SENTENCE = re.compile(r"[.!?\n]+")
_APART = re.compile(r"(?<!\S)\w(?:\s+\w){2,}(?!\S)")
_EDGE = "".join(map(chr, range(33, 127))).translate({ord(c): None for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"}) + "“”„‘’«»…–—"


def tokens(text: str) -> list[str]:
    """Lower-case words without punctuation at their ends, and runs of single letters as one."""
    low = text.lower()
    return [t for w in low.split() if (t := w.strip(_EDGE))] + [m.group() for m in _APART.finditer(low)]


def _letters(word: str) -> tuple[list[int], list[int]]:
    at = [i for i, c in enumerate(word) if c.isalnum()]
    return [min(ord(word[i]), 0x1FFFFF) for i in at], at


def _windows(word: str) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    codes, at = _letters(word)
    if len(codes) <= WINDOW:
        return [(tuple(codes), tuple(at))] if len(codes) >= 3 else []
    return [(tuple(codes[i:i + WINDOW]), tuple(at[i:i + WINDOW])) for i in range(0, len(codes) - WINDOW // 2, WINDOW // 2)]


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if n not in _TRIPLES:
        t = [(i, j, k) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, min(n, i + SPAN))]
        _TRIPLES[n] = tuple(np.array(x, np.int64) for x in zip(*t))
    return _TRIPLES[n]


def _weights(at: np.ndarray, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    span = at[:, k] - at[:, i] + 1
    return np.where(span <= SPAN, DECAY ** span.astype(np.float64), 0.0)


def _codes(c: np.ndarray, i: np.ndarray, j: np.ndarray, k: np.ndarray) -> np.ndarray:
    return (c[:, i] << 42) | (c[:, j] << 21) | c[:, k]


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Lengths in feature space of rows of triples with weights."""
    order = np.argsort(codes, axis=1, kind="stable")
    codes, weights = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
    new = np.ones(codes.shape, bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    sums = np.add.reduceat(weights.ravel(), np.flatnonzero(new.ravel()))
    row = np.nonzero(new)[0]
    return np.sqrt(np.bincount(row, sums * sums, len(codes)))


def features(word: str) -> dict[int, float]:
    """A word's unit vector in feature space, {triple: value}; empty under three letters."""
    codes, at = (np.array([x]) for x in _letters(word))
    if codes.shape[1] < 3:
        return {}
    i, j, k = _triples(codes.shape[1])
    u, back = np.unique(_codes(codes, i, j, k)[0], return_inverse=True)
    v = np.bincount(back, _weights(at, i, k)[0], len(u))
    return dict(zip(u.tolist(), (v / np.sqrt(v @ v)).tolist()))


class Model:
    """Margins of words, and scores of texts."""

    def __init__(self, triples: dict[int, float], bias: float, curve: list[float]):
        self.triples, self.bias, self.curve = triples, bias, curve
        chars = sorted({c >> s & 0x1FFFFF for c in triples for s in (42, 21, 0)})
        self.chars = np.array(chars or [0], np.int64)
        a = len(self.chars) + 1
        self.table = np.zeros((a, a, a))
        for c, w in triples.items():
            self.table[tuple(np.searchsorted(self.chars, [c >> 42, c >> 21 & 0x1FFFFF, c & 0x1FFFFF]))] = w
        self.known: dict[str, float] = {}

    def __reduce__(self):
        return Model, (self.triples, self.bias, self.curve)

    def margins(self, ws: list[str]) -> np.ndarray:
        """The margin of each word, at least the bias, which a word without evidence has."""
        out = np.full(len(ws), self.bias)
        by: dict[int, list] = {}
        for r, w in enumerate(ws):
            for codes, at in _windows(w):
                by.setdefault(len(codes), []).append((r, codes, at))
        for n, rows in by.items():
            i, j, k = _triples(n)
            step = max(1, 300_000 // len(i))
            for s in range(0, len(rows), step):
                r, c, at = (np.array(x) for x in zip(*rows[s:s + step]))
                ids = np.searchsorted(self.chars, c)
                ids = np.where(self.chars[np.minimum(ids, len(self.chars) - 1)] == c, ids, len(self.chars))
                w = _weights(at, i, k)
                num = (w * self.table[ids[:, i], ids[:, j], ids[:, k]]).sum(axis=1)
                up = np.flatnonzero(num > 0)
                if len(up):
                    np.maximum.at(out, r[up], num[up] / _norms(_codes(c[up], i, j, k), w[up]) + self.bias)
        return out

    def evidence(self, texts: list[str | None]) -> list[list[float]]:
        """The highest margins of each text's words."""
        out: list[list[float]] = []
        for at in range(0, len(texts), GROUP):
            lists = [tokens(t) if t else [] for t in texts[at:at + GROUP]]
            new = list({w for ts in lists for w in ts if w not in self.known})
            if len(self.known) + len(new) > MEMORY:
                self.known.clear()
                new = list({w for ts in lists for w in ts})
            self.known.update(zip(new, self.margins(new).tolist()))
            for ts in lists:
                top = heapq.nlargest(TOP, map(self.known.__getitem__, ts))
                out.append(top + [self.bias] * (TOP - len(top)))
        return out

    def scores(self, evidence: list[list[float]]) -> np.ndarray:
        e = np.array(evidence).reshape(-1, TOP)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + e @ np.array(self.curve[1:]), -50, 50)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared-hinge linear support vector machine by Newton steps; the last feature is the bias."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) / COST
    ridge[-1, -1] = 1e-6
    for _ in range(40):
        active = y * (x @ w) < 1
        a, d = x[active], weight[active]
        new = np.linalg.solve(ridge + (a * d[:, None]).T @ a, (a * d[:, None]).T @ y[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = 0.5 * w + 0.5 * new if _ > 20 else new
    return w


def _machine(landmarks: list[str], positive: list[str], negative: list[str]) -> tuple[dict[int, float], float]:
    """One weight per triple of the landmarks, and the bias."""
    marks = [f for f in map(features, landmarks) if f]
    index: dict[int, int] = {}
    for f in marks:
        for u in f:
            index.setdefault(u, len(index))
    basis = np.zeros((len(index), len(marks)))
    for m, f in enumerate(marks):
        for u, v in f.items():
            basis[index[u], m] = v
    values, vectors = np.linalg.eigh(basis.T @ basis)
    root = (vectors / np.sqrt(np.maximum(values, 1e-8))) @ vectors.T  # the Nystroem map K_mm ** -1/2

    def rows(ws: list[str]) -> np.ndarray:
        out = np.zeros((len(ws), len(marks)))
        for r, w in enumerate(ws):
            hit = [(index[u], v) for u, v in features(w).items() if u in index]
            if hit:
                at, v = zip(*hit)
                out[r] = np.array(v) @ basis[list(at)]
        return out @ root

    x = np.vstack([rows(positive), rows(negative)])
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    w = _svm(x, y, np.r_[np.full(len(positive), max(1.0, len(negative) / max(1, len(positive)) / 4)), np.ones(len(negative))])
    alpha = basis @ (root @ w[:-1])
    return {u: float(alpha[r]) for u, r in index.items()}, float(w[-1])


def _curve(evidence: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression of the label on the margins, classes weighing the same."""
    x = np.c_[np.ones(len(y)), evidence]
    d = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (d * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (d * (y - p)) - 0.05 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def _sentences(batches):
    for b in batches:
        out = {(s.strip(), int(y)) for t, y in zip(b["text"], b["toxic"]) for s in _SENTENCE.split(t or "")}
        yield pd.DataFrame([x for x in out if x[0]], columns=["sentence", "toxic"])


def _tally(batches):
    for b in batches:
        counts: dict[str, list[int]] = {}
        for s, y in zip(b["sentence"], b["toxic"]):
            ws = set(tokens(s))
            for w in ws | {f"{STEM}{w[:n]}" for w in ws for n in STEMS if len(w) > n}:
                counts.setdefault(w, [0, 0])[1 - int(y)] += 1
        yield pd.DataFrame([(w, *c) for w, c in counts.items()], columns=["word", "toxic", "clean"])


def fit(labelled: DataFrame) -> Model | None:
    """Learn from ``labelled`` (text, toxic 0/1), a bounded sample. None without both classes or
    without a word that toxic sentences hold significantly oftener."""
    labelled = staged(labelled.select("text", F.col("toxic").cast("int")).where("toxic IN (0, 1)"), "labelled")
    sentences = (labelled.mapInPandas(_sentences, "sentence string, toxic int")
                 .groupBy("sentence").agg(F.min("toxic").alias("toxic")))
    words = staged(sentences.mapInPandas(_tally, "word string, toxic bigint, clean bigint")
                   .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "words")
    total = words.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.count("*").alias("v")).first()
    if not total["t"] or not total["c"]:
        return None
    p = total["t"] / (total["t"] + total["c"])
    n = F.col("toxic") + F.col("clean")
    gain = lambda k, q: F.when(k > 0, k * F.log(k / (n * q))).otherwise(F.lit(0.0))
    counts = words.withColumn("gain", F.when(F.col("toxic") > p * n, gain(F.col("toxic"), p) + gain(F.col("clean"), 1 - p)).otherwise(F.lit(0.0)))
    sure = math.log(total["v"]) + math.log(100)
    stem = F.startswith("word", F.lit(STEM))
    telling = counts.where((F.col("gain") > sure) & (F.col("clean") <= 0.1 * F.col("toxic")) & (F.length("word") >= 3))
    stems = [r["word"][1:] for r in telling.where(stem).orderBy(F.desc("gain"), "word").limit(WITNESSES).collect()]
    told = counts.where(~stem)
    inflected = F.lit(False)
    for n in STEMS:
        inflected = inflected | F.substring("word", 1, n).isin([x for x in stems if len(x) == n])
    of_stem = told.where(inflected & (F.col("clean") == 0)).select("word", "toxic")
    witness = (telling.where(~stem).select("word", "toxic").unionByName(of_stem).distinct()
               .orderBy(F.desc("toxic"), "word").limit(WITNESSES).toPandas())
    if witness.empty:
        return None
    clean = told.where((F.col("clean") > 0) & (F.col("gain") < sure))
    usual = [r["word"] for r in clean.orderBy(F.desc("clean"), "word").limit(NEGATIVES).collect()]
    others = [r["word"] for r in clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVES).collect()]
    found, negative = witness["word"].tolist(), list(dict.fromkeys(usual + others))
    positive = found + [w[:k] + x + w[k:] for w in found for k, x in ((len(w) // 2, "x"), (len(w) // 3 + 1, w[len(w) // 3]))]
    landmarks = found[:LANDMARKS] + usual[:LANDMARKS]
    for turn in range(ROUNDS):
        triples, bias = _machine(landmarks, positive, negative)
        model = Model(triples, bias, [0.0] * (TOP + 1))
        if turn == ROUNDS - 1:
            break

        def hard(batches, model=model):
            for b in batches:
                m = model.margins(b["word"].tolist())
                yield pd.DataFrame({"word": b["word"], "margin": m})[m > -0.5]

        worst = (clean.select("word").mapInPandas(hard, "word string, margin double")
                 .orderBy(F.desc("margin"), "word").limit(NEGATIVES).toPandas()["word"].tolist())
        negative = list(dict.fromkeys(worst + negative))
        landmarks = list(dict.fromkeys(landmarks + worst[:LANDMARKS // 2]))

    def gather(batches):
        for b in batches:
            yield pd.DataFrame({"m": model.evidence(b["text"].tolist()), "toxic": b["toxic"]})

    seen = labelled.mapInPandas(gather, "m array<double>, toxic int").orderBy("m", "toxic").toPandas()
    return Model(triples, bias, _curve(np.array(seen["m"].tolist()), seen["toxic"].to_numpy()))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text is 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``most`` documents of each class outside the held-out fold, chosen
    by a hash; conflicting, null and missing labels are left out."""
    known = (only(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
             .where("toxic = _most").where(~held_out(F.col("doc_id"))))
    some = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    # at most 2 * most ids
    chosen = F.broadcast(some[0].unionByName(some[1]).select("doc_id", "toxic"))
    return only(docs, "doc_id", "text").join(chosen, "doc_id").select("text", "toxic")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Null and empty texts have the score of a text without evidence. Where nothing can be learned
    every score is 0. Repeated rows are each scored; a null doc_id counts as held out; other
    columns are ignored.
    """
    prepare(docs.sparkSession)
    model = fit(sample(docs, labels))

    def run(batches):
        for b in batches:
            s = model.scores(model.evidence(b["text"].tolist())) if model else np.zeros(len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "held_out": b["held_out"], "score": s,
                                "predicted": (s >= threshold).astype(np.int32)})

    return (docs.select(F.col("doc_id").cast("long"), "text", held_out(F.col("doc_id")).alias("held_out"))
            .mapInPandas(run, "doc_id bigint, held_out boolean, score double, predicted int"))
