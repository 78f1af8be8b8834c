import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as q

INSULTS = ["blockhead", "numskull", "dimwit"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    syllables = ["an", "er", "in", "on", "th", "ha", "ed", "ou", "st", "ly"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows = []
    for i in range(900):
        sentences = [[word() for _ in range(12)] for _ in range(6)]
        if i % 6 == 0:
            for _ in range(3):
                rng.choice(sentences).insert(rng.randrange(12), rng.choice(INSULTS))
        rows.append((i, ". ".join(" ".join(s) for s in sentences), int(i % 6 == 0)))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id bigint, text string, score string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id bigint, toxic int")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    out = q.toxicity(docs, labels).join(labels.where("toxic IS NOT NULL"), "doc_id").toPandas()
    held = out[out["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.98
    assert out["score"].between(0, 1).all() and ((out["score"] >= 0.7) == (out["predicted"] == 1)).all()


def test_gapped_and_inserted_characters(corpus):
    docs, labels = corpus
    model = q.fit(q.sample(docs, labels))
    clean = max(model.margins([w for r in docs.where("doc_id % 6 = 1").limit(40).collect() for w in q.tokens(r["text"])]))
    for w in ["blockhead", "BLOCKHEAD!".lower(), "b.l.o.c.k.h.e.a.d", "b l o c k h e a d", "blockxhead", "nummskull", "dim-wit"]:
        assert model.margins(q.tokens(w)[-1:])[0] > max(0, clean)
    assert q.tokens("a b c, d-e ok") == ["a", "b", "c", "d-e", "ok"]
    assert q.tokens("so s t o p it")[-1] == "s t o p"
    long = "ab" * 40 + "blockhead" + "cd" * 40
    assert model.margins([long])[0] > model.margins(["ab" * 80])[0]


def test_edges(spark, corpus):
    docs, labels = corpus
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "blockhead numskull"), (2, "dimwit " * 50000), (2, "\n\n")], "doc_id bigint, text string")
    model = q.fit(q.sample(docs, labels))
    low, high = model.scores(model.evidence([None, "dimwit " * 50000]))
    assert low < 0.7 < high and model.scores(model.evidence([""]))[0] == low
    out = q.toxicity(odd, labels.limit(0)).collect()
    assert [r["score"] for r in out] == [0.0] * 5 and [r["held_out"] for r in out if r["doc_id"] is None] == [True]
    assert q.toxicity(odd.limit(0), labels).count() == 0
    crc = odd.select(q.held_out(F.lit(5)).alias("h")).first()["h"]
    import zlib
    assert crc == (zlib.crc32(b"5") % 3 == 1)


def kernel(a, b):
    """The string kernel by its definition: common triples of letters, gaps allowed, each pair of
    places decayed by the characters it spans."""
    from itertools import combinations

    def places(word):
        for t in combinations([i for i, c in enumerate(word) if c.isalnum()], 3):
            span, letters = t[2] - t[0] + 1, [i for i, c in enumerate(word) if c.isalnum()]
            if span <= q.SPAN and letters.index(t[2]) - letters.index(t[0]) < q.SPAN:
                yield "".join(word[i] for i in t), q.DECAY ** span

    return sum(x * y for u, x in places(a) for v, y in places(b) if u == v)


WORDS = ["blockhead", "b-l-o-ckhead", "bloxckhead", "headblock", "aaaaa", "aab", "dimwit", "d.i.m.w.i.t", "abcdefghijklmnop", "ponmlkjihgfedcba"]


@pytest.mark.parametrize("a", WORDS)
def test_kernel_against_its_definition(a):
    for b in WORDS:
        x, y = q.features(a), q.features(b)
        want = kernel(a, b) / (kernel(a, a) * kernel(b, b)) ** 0.5
        assert sum(v * y.get(t, 0.0) for t, v in x.items()) == pytest.approx(want, abs=1e-12)


def test_margins_are_the_weighted_kernel():
    """The margin of a word of one window is the sum over landmarks of coefficient and kernel."""
    landmarks = {"blockhead": 1.5, "dimwit": 0.75, "headblock": -0.5}
    triples = {}
    for word, c in landmarks.items():
        for t, v in q.features(word).items():
            triples[t] = triples.get(t, 0.0) + c * v
    model = q.Model(triples, -0.25, [0.0] * (q.TOP + 1))
    norm = lambda w: kernel(w, w) ** 0.5
    got = model.margins([*WORDS, "xyz", "ab", ""])
    for w, m in zip(WORDS, got):
        want = sum(c * kernel(w, v) / (norm(w) * norm(v)) for v, c in landmarks.items())
        assert m == pytest.approx(max(want, 0.0) - 0.25, abs=1e-9)
    assert list(got[len(WORDS):]) == [-0.25] * 3
