"""Operator 11: ranked lexical search in K2-treaps over a term-document grid.

Documents are dealt to shards of bounded size. A shard's grid has a row per term, most frequent
first, and a column per document, alike ones side by side; the cell of a term and a document that
holds it has the term's impact there. The grid is a quadtree whose cells, empty ones left out, store
the largest impact below them, as what is lacking to their parent's, with four bits per cell for its
children. An item's terms are rows of the grid. Their paths descend together: a range of documents,
one cell per row, can score no more than the weighted sum of its cells' maxima, and ranges are halved
best first until none left can reach the best documents found. A cell of one document holds its
exact impacts.

Every shard gives its best documents for every item, and the best of those are the result. Items
come to the shards in blocks. A few shards are searched first: what an item's last rank scores there
is a bound below which the other shards need not look.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .base import only, prepare, staged

#: Documents returned per item; code points of a shard, about; items of a block; ranges halved at once.
TOP, SHARD_CHARS, ITEMS, RANGES = 10, 16_000_000, 512, 256
#: One shard in so many is searched first. Terms of items, all together, that are broadcast at most;
#: beyond, blocks of items and slices of so many shards are joined by a shuffle.
FIRST, BROADCAST, SLICE = 16, 200_000, 8
#: The scale of an impact, its length norm, the scale of a weight.
IMPACT, TF, NORM, FLOOR, SLOPE, WEIGHT = 1_000_000_000, 1000, 8, 10, 90, 1000

#: Bytes of terms: letters (A-Z as a-z), digits and all of code points from U+0080 on; others separate.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in their order, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM).split() if text else []


def _z(x: np.ndarray, kind: str) -> bytes:
    return zlib.compress(np.ascontiguousarray(x, kind).tobytes(), 1)


def _un(z: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(z), kind)


# ------------------------------------------------------------------ postings
class _Shard:
    def __init__(self):
        self.docs, self.n, self.number = [], [], {}
        self.row, self.tf, self.width, self.chars = [], [], [], 0

    def add(self, doc_id, text: str | None) -> None:
        found = Counter(terms(text))
        self.chars += len(text or "")
        if found:
            number = self.number
            self.docs.append(doc_id)
            self.n.append(sum(found.values()))
            self.row.append(np.array([number.setdefault(t, len(number)) for t in found], np.int32))
            self.tf.append(np.fromiter(found.values(), np.int32, len(found)))
            self.width.append(len(found))

    def frame(self, shard: int) -> pd.DataFrame:
        row, tf = np.concatenate(self.row), np.concatenate(self.tf)
        col = np.repeat(np.arange(len(self.docs), dtype=np.int32), self.width)
        df = np.bincount(row, minlength=len(self.number))
        order = np.argsort(-df, kind="stable")  # the most frequent terms come first
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        row = place[row]
        # documents with the same leading term side by side, short ones first
        at = np.concatenate([[0], np.cumsum(self.width)[:-1]])
        lead = np.minimum.reduceat(np.where(tf == np.repeat(np.maximum.reduceat(tf, at), self.width), row, len(order)), at)
        docs = np.lexsort((self.n, lead))
        there = np.empty(len(docs), np.int32)
        there[docs] = np.arange(len(docs))
        words = list(self.number)
        return pd.DataFrame({"shard": [shard], "doc_ids": [[self.docs[i] for i in docs]], "n": [[self.n[i] for i in docs]],
                             "terms": [[words[i] for i in order]], "df": [df[order]],
                             "row": [_z(row, "<i4")], "col": [_z(there[col], "<i4")], "tf": [_z(tf, "<i4")]})


def postings(docs: DataFrame, chars: int = SHARD_CHARS) -> DataFrame:
    """One row per shard of ``docs`` (doc_id, text): its documents with terms and their lengths, its
    terms and in how many documents each is, and the occurrences (row, column, count)."""
    def count(batches):
        from pyspark import TaskContext

        shard, held = TaskContext.get().partitionId() << 24, _Shard()
        for b in batches:
            for doc_id, text in zip(b["doc_id"].astype("Int64"), b["text"]):
                held.add(None if doc_id is pd.NA else int(doc_id), text)
                if held.chars > chars and held.docs:
                    yield held.frame(shard)
                    shard, held = shard + 1, _Shard()
        if held.docs:
            yield held.frame(shard)

    prepare(docs.sparkSession)
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return staged(rows.mapInPandas(count, "shard bigint, doc_ids array<bigint>, n array<bigint>, terms array<binary>, "
                                          "df array<bigint>, row binary, col binary, tf binary"), "postings")


def statistics(found: DataFrame) -> tuple[int, int]:
    """The documents with a term, and all their terms with repeats."""
    total = F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x)
    n, length = found.select(F.sum(F.size("n")), F.sum(total)).head()
    return n or 0, length or 0


# ------------------------------------------------------------------ the treap
def _spread(x: np.ndarray) -> np.ndarray:
    """A zero bit before every bit."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def build(row: np.ndarray, col: np.ndarray, impact: np.ndarray) -> tuple[int, list[bytes], list[bytes]]:
    """(depth, children, lacking): of every level above the cells, the four bits of each occupied
    square, and of every level how much its maxima lack to their parent's, the root's to zero."""
    depth = max(int(max(row.max(), col.max())).bit_length(), 1)
    code = (_spread(row) << np.uint64(1)) | _spread(col)
    order = np.argsort(code, kind="stable")
    code, most = code[order], impact[order].astype(np.int64)
    children, maxima = [], [most]
    for _ in range(depth):
        above = code >> np.uint64(2)
        start = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]]))
        children.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), start))
        maxima.append(np.maximum.reduceat(maxima[-1], start))
        code = above[start]
    children, maxima = children[::-1], maxima[::-1]
    lacking = [-maxima[0]] + [np.repeat(a, _BITS[m]) - b for a, m, b in zip(maxima, children, maxima[1:])]
    return depth, [_z(m, "u1") for m in children], [_z(x, "<i4") for x in lacking]


class Treap:
    """A K2-treap as three arrays over all its squares, level by level; the last square is empty."""

    def __init__(self, depth: int, children: list[bytes], lacking: list[bytes]):
        masks = [_un(m, "u1") for m in children]
        maxima = [-_un(lacking[0], "<i4").astype(np.int64)]
        for m, z in zip(masks, lacking[1:]):
            maxima.append(np.repeat(maxima[-1], _BITS[m]) - _un(z, "<i4"))
        self.depth = depth
        inner = sum(map(len, masks))
        self.most = np.concatenate([*maxima, [0]])
        self.nothing = len(self.most) - 1
        self.mask = np.zeros(len(self.most), np.uint8)
        self.mask[:inner] = np.concatenate(masks)
        below = _BITS[self.mask[:inner]]
        self.child = np.zeros(len(self.most), np.int64)
        self.child[:inner] = 1 + np.cumsum(below) - below  # squares follow their parents' order

    def best(self, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, top: int, least: int = 1) -> list[tuple[int, int]]:
        """The ``top`` (score, column) by score and id of those that reach ``least``."""
        bits = np.array([(rows >> (self.depth - 1 - i)) & 1 for i in range(self.depth)], np.uint8)
        level, first = np.zeros(1, np.int64), np.zeros(1, np.int64)
        at = np.zeros((1, len(rows)), np.int64)
        bound = np.array([(self.most[0] * weights).sum()])
        scores, columns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(bound):
            if len(bound) > RANGES:
                now = np.argpartition(bound, len(bound) - RANGES)
                rest, now = now[:-RANGES], now[-RANGES:]
            else:
                rest, now = np.zeros(0, np.int64), np.arange(len(bound))
            nodes, mask, q = at[now], self.mask[at[now]], bits[level[now]] << 1
            made = []
            for half in (0, 1):
                there = (mask >> (q | half)) & 1
                child = np.where(there, self.child[nodes] + _BITS[mask & ((1 << (q | half)) - 1)], self.nothing)
                made.append((level[now] + 1, 2 * first[now] + half, child, (self.most[child] * weights).sum(axis=1)))
            lv, fr, ch, bo = (np.concatenate(x) for x in zip(*made))
            leaf = (lv == self.depth) & (bo >= least)
            if leaf.any():
                scores, columns = np.concatenate([scores, bo[leaf]]), np.concatenate([columns, fr[leaf]])
                if len(scores) > top:
                    keep = np.lexsort((ids[columns], -scores))[:top]
                    scores, columns = scores[keep], columns[keep]
                if len(scores) == top:
                    least = max(least, int(scores.min()))
            go, stay = (lv < self.depth) & (bo >= least), rest[bound[rest] >= least]
            level, first = np.concatenate([level[stay], lv[go]]), np.concatenate([first[stay], fr[go]])
            at, bound = np.concatenate([at[stay], ch[go]]), np.concatenate([bound[stay], bo[go]])
        order = np.lexsort((ids[columns], -scores))[:top]
        return [(int(scores[i]), int(columns[i])) for i in order]


def index(found: DataFrame, n: int, length: int) -> DataFrame:
    """One row per shard of :func:`postings`: its documents, terms and K2-treap of impacts."""
    def grow(batches):
        for b in batches:
            for shard, ids, sizes, words, row, col, tf in zip(
                    b["shard"], b["doc_ids"], b["n"], b["terms"], b["row"], b["col"], b["tf"]):
                m = np.array([FLOOR + SLOPE * int(x) * n // length for x in sizes], np.int64)
                row, col, tf = _un(row, "<i4"), _un(col, "<i4"), _un(tf, "<i4").astype(np.int64)
                depth, children, lacking = build(row, col, IMPACT * tf // (TF * tf + NORM * m[col]))
                yield pd.DataFrame({"shard": [shard], "doc_ids": [ids], "terms": [b" ".join(words)], "depth": [depth],
                                    "children": [children], "lacking": [lacking]})

    return staged(found.mapInPandas(grow, "shard bigint, doc_ids array<bigint>, terms binary, depth int, "
                                          "children array<binary>, lacking array<binary>"), "treaps")


def weighted_items(items: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """(item, item_id, terms, weights) per row of ``items`` (item_id, text), ``item`` its number: the
    distinct terms that some document holds and that weigh more than 0; others change no score."""
    def split(batches):
        for b in batches:
            yield pd.DataFrame({"item_id": b["item_id"], "term": [list(dict.fromkeys(terms(t))) for t in b["text"]]})

    kind = dict(items.dtypes)["item_id"]
    asked = only(items, "item_id", "text").mapInPandas(split, f"item_id {kind}, term array<binary>")
    asked = staged(asked.withColumn("item", F.monotonically_increasing_id()), "asked").select(
        "item", "item_id", F.explode("term").alias("term"))
    held = found.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).select("x.terms", "x.df").toDF("term", "df")
    df = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(WEIGHT * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("bigint")
    return (asked.join(df.select("term", weight.alias("weight")).where("weight > 0"), "term")
            .groupBy("item", "item_id").agg(F.collect_list(F.struct("term", "weight")).alias("t"))
            .select("item", "item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")))


def _joined(shards: DataFrame, blocks: DataFrame, count: int, slices: int | None) -> DataFrame:
    """Every shard with every block of items. Small blocks are broadcast, so that no shard moves; else
    (``slices``) every slice of shards gets a copy of every block."""
    pairs = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    if slices is None:
        return pairs.join(F.broadcast(blocks), "block")
    copies = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return pairs.withColumn("slice", F.pmod(F.xxhash64("shard"), F.lit(slices)).cast("int")).join(copies, ["slice", "block"])


def _found(pairs: DataFrame, top: int) -> DataFrame:
    """The best (item, doc_id, score) of every shard for every item of the blocks joined to it."""
    def look(batches):
        last, treap, number, ids = None, None, {}, None
        for b in batches:
            for shard, docs, words, depth, children, lacking, queries in zip(
                    b["shard"], b["doc_ids"], b["terms"], b["depth"], b["children"], b["lacking"], b["items"]):
                if shard != last:
                    last, treap, number = shard, Treap(depth, children, lacking), {w: i for i, w in enumerate(words.split(b" "))}
                    # a missing id ranks last among equal scores
                    ids = np.array([np.iinfo(np.int64).max if i is None or i != i else int(i) for i in docs], np.int64)
                out = []
                for q in queries:
                    rows = [(number[t], w) for t, w in zip(map(bytes, q["terms"]), q["weights"]) if t in number]
                    if rows:
                        r, w = np.array(rows, np.int64).T
                        out += [(q["item"], docs[c], s) for s, c in treap.best(r, w, ids, top, max(q["least"], 1))]
                if out:
                    f = pd.DataFrame(out, columns=["item", "doc_id", "score"])
                    f["doc_id"] = f["doc_id"].astype("Int64")
                    yield f

    return pairs.select("shard", "doc_ids", "terms", "depth", "children", "lacking", "items").mapInPandas(
        look, "item bigint, doc_id bigint, score bigint")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def search(treaps: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of :func:`index` for every row of
    :func:`weighted_items`, over all shards."""
    items = staged(items, "items")
    total, size = items.select(F.count("*"), F.sum(F.size("terms"))).head()
    count = max(1, -(-total // ITEMS))
    slices = None if (size or 0) <= BROADCAST else max(1, treaps.count() // SLICE)
    block = F.pmod(F.xxhash64("item"), F.lit(count)).cast("int")

    def blocks(least: DataFrame) -> DataFrame:
        rows = items.join(least, "item", "left").select(block.alias("block"), F.struct(
            "item", "terms", "weights", F.coalesce("least", F.lit(1).cast("bigint")).alias("least")).alias("x"))
        return rows.groupBy("block").agg(F.collect_list("x").alias("items"))

    early = F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0
    none = items.select("item", F.lit(1).cast("bigint").alias("least"))
    first = staged(_found(_joined(treaps.where(early), blocks(none), count, slices), top), "first")
    least = _ranked(first, top).where(F.col("rank") == top).select("item", F.col("score").alias("least"))
    rest = _found(_joined(treaps.where(~early), blocks(least), count, slices), top)
    best = _ranked(first.unionByName(rest), top)
    return (best.join(items.select("item", "item_id"), "item")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, chars: int = SHARD_CHARS) -> DataFrame:
    """Per row of ``items`` (item_id, text) its ``top`` best documents of ``docs`` (doc_id, text):
    item_id, rank (from 1), doc_id, score, equal scores by doc_id, a null one last.

    Null and empty texts have no terms: such documents count nowhere, such items have no rows.
    Repeated documents rank each for itself, repeated items have their rows each. Documents that
    score 0 are left out. Empty tables give an empty result; other columns are ignored.
    """
    found = postings(docs, chars)
    n, length = statistics(found)
    return search(index(found, n, length), weighted_items(items, found, n), top)
