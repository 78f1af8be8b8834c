import collections
import math
import random
import re

import numpy as np
import pytest

from tidemark.llm import ranked as q

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, top=10):
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, length = len(held), sum(m for *_, m in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, m in held:
            norm = 100 - 90 + 90 * m * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * norm))
                    for t in set(terms(text)) & set(c))
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def run(spark, docs_of, docs, items, **options):
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, rank int, doc_id string")
    out = q.ranked_search(docs_of(docs), asked, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in out.collect()], key=str)


def test_terms():
    text = "Ab9_é–x\x7f\x80 Ünï-C d\t日本Z"
    assert [t.decode() for t in q.terms(text)] == terms(text) and q.terms(None) == q.terms("") == []


@pytest.mark.parametrize("shape", [(1, 1), (5, 3), (40, 700), (900, 60), (64, 64)])
def test_treap_finds_the_best_columns(shape, monkeypatch):
    rng = np.random.default_rng(shape[0])
    grid = np.where(rng.random(shape) < 0.3, rng.integers(1, 50, shape), 0)
    grid[:, 0] = 7  # every term is in some document
    row, col = np.nonzero(grid)
    mixed = rng.permutation(len(row))
    depth, children, lacking = q.build(row[mixed], col[mixed], grid[row, col][mixed])
    treap = q.Treap(depth, children, lacking)
    ids = rng.permutation(shape[1])
    for ranges in (1, 3, 256):
        monkeypatch.setattr(q, "RANGES", ranges)
        for _ in range(6):
            rows = rng.choice(shape[0], min(shape[0], 8), replace=False)
            w = rng.integers(1, 9, len(rows))
            score = w @ grid[rows]
            for top, least in ((10, 1), (2, 60), (10 ** 6, 1)):
                want = sorted((-s, ids[c], c) for c, s in enumerate(score) if s >= least)[:top]
                assert treap.best(rows, w, ids, top, least) == [(-s, c) for s, _, c in want]


def test_small_shards_equal_brute_force(spark, docs_of):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "日本"]
    word = lambda: vocabulary[min(int(rng.expovariate(0.02)), 301)]
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(500)]
    docs += [(500 + i, docs[7][1]) for i in range(150)] + [(900, "common " * 4000)]
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 20)))) for i in range(40)] + [(99, docs[7][1]), (98, "common w1")]
    want = brute(docs, items)
    assert run(spark, docs_of, docs, items, chars=2000) == want  # many shards
    assert run(spark, docs_of, docs, items) == want
    assert run(spark, docs_of, docs, items, top=3, chars=5000) == brute(docs, items, 3)


@pytest.mark.parametrize("broadcast", [0, 10 ** 6])
def test_blocks_of_items(spark, docs_of, monkeypatch, broadcast):
    monkeypatch.setattr(q, "ITEMS", 3)
    monkeypatch.setattr(q, "BROADCAST", broadcast)
    docs = [(i, f"a{i % 7} b{i % 5} c{i}") for i in range(60)]
    items = [(i, f"a{i % 7} c{i}") for i in range(20)]
    assert run(spark, docs_of, docs, items, chars=100) == brute(docs, items)


def test_edges(spark, docs_of):
    docs = [(1, None), (2, ""), (3, " -- "), (4, "Alpha beta"), (4, "Alpha beta"), (5, "alpha BETA"), (None, "alpha beta"), (6, "gamma " * 20000)]
    items = [(1, None), (2, ""), (3, "ALPHA alpha beta"), (3, "gamma"), (None, "beta"), (7, "nowhere"), (8, "nowhere gamma")]
    assert run(spark, docs_of, docs, items) == brute(docs, items)
    assert run(spark, docs_of, [], items) == run(spark, docs_of, docs[:3], items) == run(spark, docs_of, docs, []) == []
    assert run(spark, docs_of, [(1, "all")] * 3, [(1, "all")]) == brute([(1, "all")] * 3, [(1, "all")])  # ln(8 / 7)
