import zlib

import numpy as np
import pytest

from tables import TINY
from tidemark.llm import base, packing as q


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for x in texts]


def check(rows, packed):
    by = {}
    for r in packed:
        by.setdefault(r["doc_id"], []).append(r)
    for (i, _), ids in zip(rows, reference_ids([t for _, t in rows])):
        parts = sorted(by.pop(i), key=lambda r: r["start"])
        at = 0
        for r in parts:
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    assert not by
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding / max(1, total)


def test_table_round_trip_and_little_padding(spark):
    docs = base.table(spark, TINY, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert check(rows, q.pack(docs).collect()) < 0.03


def test_edges(spark, docs_of):
    texts = [None, "", "a", "<|endoftext|> x", "é 日本 \U0001f600  \n\n\t x", "don't we'll", "word " * 1022, "word " * 1023,
             "word " * 40000, "   nb"] + ["same text"] * 700
    rows = list(enumerate(texts))
    check(rows, q.pack(docs_of(rows)).collect())
    assert q.pack(docs_of([])).count() == 0
    twice = q.pack(docs_of([(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert len(twice) == 3 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 3


def test_both_tokenizer_files_give_the_same(spark, docs_of):
    import public_tokenizers

    docs = docs_of([(1, "It's 12,5 ünï \n code_x <|endoftext|>"), (2, "x" * 3000)])
    a = q.pack(docs).drop("sequence_id", "offset").collect()
    b = q.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("sequence_id", "offset").collect()
    assert sorted(a) == sorted(b)


@pytest.mark.parametrize("n", [1, 30, 5000, 80000])
def test_patterns_place_every_piece(n):
    rng = np.random.default_rng(n)
    sizes, counts = np.unique(1 + rng.lognormal(5.5, 1.0, n).astype(int) % 1024, return_counts=True)
    histogram = dict(zip(sizes.tolist(), counts.tolist()))
    placed: dict = {}
    sequences = 0
    for pattern, times in q.cutting_patterns(histogram):
        assert sum(s * k for s, k in pattern.items()) <= 1024
        sequences += times
        for s, k in pattern.items():
            placed[s] = placed.get(s, 0) + k * times
    assert placed == histogram
    least = sum(s * c for s, c in histogram.items()) / 1024
    assert sequences <= max(least * 1.03, least + 2)


def test_knapsack_equals_plain_recursion():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes, worth = np.unique(rng.integers(1, 40, 9)), None
        worth = rng.random(len(sizes))
        best, items = q._knapsack(sizes, worth, 90)
        plain = np.zeros(91)
        for c in range(1, 91):
            plain[c] = max([plain[c - 1]] + [plain[c - s] + w for s, w in zip(sizes, worth) if s <= c])
        assert np.allclose(best, plain)
        chosen = items(90)
        assert sum(sizes[i] * k for i, k in chosen.items()) <= 90
        assert abs(sum(worth[i] * k for i, k in chosen.items()) - plain[90]) < 1e-9


def test_ranks_add_up_over_runs_of_shards(spark, docs_of, monkeypatch):
    monkeypatch.setattr(q, "RUN", 2)
    rows = [(i, "one two three") for i in range(3000)] + [(5000 + i, "word " * 700) for i in range(20)]
    check(rows, q.pack(docs_of(rows)).collect())
