"""Operator 12: language-model scores of a Brown class bigram model.

    p(w | previous) = p(class(w) | class(previous)) * p(w | class(w))

Tokens are a text's words and one end, which is also what precedes the first word. A word whose
share of the training tokens is at least ``SHARE`` is a unit of its own from the start, so at most
1 / ``SHARE`` words are; the rarer words begin as one unit for each of ``ENDINGS`` hashes of their
last bytes. Exchange clustering assigns units to classes: of a unit taken out of its class, every
class is tried, and it goes where the likelihood of the training bigrams grows most. In a round a
random half of the units may move at once; the round with the highest likelihood stands. Then
every rarer word is taken out of its unit and goes by the same exact gain, of its own bigrams.
Words never seen go with most words of their ending that were met once.

Texts are written once, as the word numbers of blocks of bounded size, bucketed by block. Each
block sends its distinct words to the word counts and gets counts and units back by block, so no
token is shuffled. The bigram counts of units are a table sharded by unit; a round is one pass over
it. The rarer words' neighbours meet in shards of words, and the classes found go back by block. What
the driver holds, classes of units and counts of pairs of classes, is bounded by ``SHARE``,
``ENDINGS`` and ``CLASSES``.
"""

from __future__ import annotations

import collections
import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import bucketed, prepare, staged

#: Classes; rounds of exchange; least share of the tokens of a word that is a unit from the start; units of rarer words.
CLASSES, ROUNDS, SHARE, ENDINGS = 64, 14, 1e-5, 1024
#: Code points of a block, about; bigrams of a shard, about; weight of the class distribution in transitions.
BLOCK_CHARS, SHARD, PRIOR = 16_000_000, 400_000, 16.0
#: Rounds end when the likelihood changes by less than this share.
STILL = 2e-4
#: One document in so many is held out, that with this remainder (fixed values of the query).
FOLDS, HELD_OUT = 7, 2
#: The end token: no word holds a space. Its unit.
END, END_UNIT = b" ", ENDINGS


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, and the end token."""
    out = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII only
    out.append(END)
    return out


def _pack(x: np.ndarray, kind: str) -> bytes:
    return zlib.compress(np.ascontiguousarray(x, kind).tobytes(), 1)


def _unpack(z: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(z), kind)


class _Block:
    def __init__(self):
        self.number, self.ids, self.rows, self.chars = collections.defaultdict(itertools.count().__next__), [], [], 0

    def add(self, doc_id, held: bool, text: str | None) -> None:
        words = tokens(text)
        ids = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        self.ids.append(ids)
        self.rows.append((doc_id, held, len(ids)))
        self.chars += len(text or "")

    def row(self, block: int) -> pd.DataFrame:
        ids = np.concatenate(self.ids)
        held = np.repeat([r[1] for r in self.rows], [r[2] for r in self.rows])
        return pd.DataFrame({"block": [block], "doc_ids": [[r[0] for r in self.rows]], "held": [[r[1] for r in self.rows]],
                             "lengths": [[r[2] for r in self.rows]], "z": [_pack(ids, "<i4")], "words": [list(self.number)],
                             "n": [np.bincount(ids[~held], minlength=len(self.number))]})


def blocks(docs: DataFrame) -> DataFrame:
    """One row per block of documents: their ids, whether they are held out, their lengths in tokens,
    the block's words, how often each occurs in training, and the tokens as word numbers."""
    def write(batches):
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 16, _Block()
        for b in batches:
            for doc_id, out, text in zip(b["doc_id"].astype("Int64"), b["held_out"], b["text"]):
                held.add(None if doc_id is pd.NA else int(doc_id), bool(out), text)
                if held.chars > BLOCK_CHARS:
                    yield held.row(block)
                    block, held = block + 1, _Block()
        if held.rows:
            yield held.row(block)

    rows = docs.mapInPandas(write, "block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<bigint>, "
                                   "z binary, words array<binary>, n array<bigint>")
    return bucketed(rows, "block", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "tokens")


def ending() -> Column:
    """The unit of a rare ``word``: a hash of its last three bytes."""
    tail = F.expr("substring(word, greatest(length(word) - 2, 1), 3)")
    return F.pmod(F.crc32(tail), F.lit(ENDINGS)).cast("bigint")


def word_table(texts: DataFrame, total: int) -> DataFrame:
    """(block, lid, c, unit, id, first) of every distinct word of every block, bucketed by block: its
    training count over all blocks, its unit (own ones by a hash of the word, above ``ENDINGS``), a
    number of the word, and whether this row stands for the word. Words meet in one shuffle; the result
    goes back by block. A rarer word's unit is where it begins (:func:`settle`)."""
    rows = texts.select("block", F.posexplode(F.arrays_zip("words", "n")).alias("lid", "x")).select(
        "block", "lid", F.col("x.words").alias("word"), F.col("x.n").alias("n"))
    alike = Window.partitionBy("word")
    own = F.xxhash64("word").bitwiseAND(F.lit((1 << 62) - 1)) + ENDINGS + 1
    unit = (F.when(F.col("word") == F.lit(END), F.lit(END_UNIT).cast("bigint"))
            .when(F.col("c") >= max(SHARE * total, 2.0), own).otherwise(ending()))
    out = (rows.withColumn("c", F.sum("n").over(alike))
           .withColumn("at", F.shiftleft("block", 30).bitwiseOR(F.col("lid").cast("bigint")))
           .withColumn("id", F.min("at").over(alike))
           .select("block", "lid", "c", unit.alias("unit"), "id", (F.col("id") == F.col("at")).alias("first")))
    return bucketed(out, "block", int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "words")


# ------------------------------------------------------------------ exchange
def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))  # counts are whole numbers, and 1 log 1 = 0


def likelihood(pairs: np.ndarray) -> float:
    """The part of the training log likelihood that classes decide, from counts of class pairs."""
    return float(_f(pairs).sum() - _f(pairs.sum(axis=0)).sum() - _f(pairs.sum(axis=1)).sum())


def gains(left: np.ndarray, right: np.ndarray, own: np.ndarray, at: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """For each unit and class, what the likelihood gains when the unit, taken out of its class
    ``at``, joins that class. ``left`` and ``right`` count the classes before and after the unit, other
    units only, ``own`` its pairs with itself, ``pairs`` all pairs of classes."""
    m, k = left.shape
    i = np.arange(m)
    rest = np.repeat(pairs[None], m, axis=0)
    rest[i, at, :] -= right
    rest[i, :, at] -= left
    rest[i, at, at] -= own
    base = _f(rest)
    row, column = right[:, None, :], left[:, :, None]
    out = (_f(rest + row) - base).sum(axis=2) + (_f(rest + column) - base).sum(axis=1)
    diagonal = np.einsum("mkk->mk", rest)
    out += (_f(diagonal + left + right + own[:, None]) + _f(diagonal)
            - _f(diagonal + left) - _f(diagonal + right))
    # how often each class precedes or follows, the unit's other neighbours included
    for sums, n in ((rest.sum(axis=2) + left, right.sum(axis=1) + own), (rest.sum(axis=1) + right, left.sum(axis=1) + own)):
        out -= _f(sums + n[:, None]) - _f(sums)
    return out


def _shards(counts: DataFrame, shards: int) -> DataFrame:
    """(shard, u, v, side, n), one row per shard, of bigram counts (a, b, n) of unit numbers: for each
    unit of the shard its partners before (side 0) and after it (side 1)."""
    both = (counts.select(F.col("b").alias("u"), F.col("a").alias("v"), F.lit(0).alias("side"), "n")
            .unionByName(counts.select(F.col("a").alias("u"), F.col("b").alias("v"), F.lit(1).alias("side"), "n")))

    def pack(key, g):
        return pd.DataFrame({"shard": [key[0]], **{c: [_pack(g[c], k)] for c, k in (
            ("u", "<i4"), ("v", "<i4"), ("side", "<i1"), ("n", "<i8"))}})

    return staged(both.withColumn("shard", F.pmod(F.xxhash64("u"), F.lit(shards))).groupBy("shard").applyInPandas(
        pack, "shard bigint, u binary, v binary, side binary, n binary"), "bigrams")


def _open(b: pd.DataFrame):
    for u, v, side, n in zip(b["u"], b["v"], b["side"], b["n"]):
        yield _unpack(u, "<i4"), _unpack(v, "<i4"), _unpack(side, "<i1"), _unpack(n, "<i8")


def pair_counts(shards: DataFrame, of: np.ndarray, classes: int) -> np.ndarray:
    """The counts of pairs of classes under the classes ``of`` units."""
    def add(batches):
        total = np.zeros(classes * classes, np.int64)
        for b in batches:
            for u, v, side, n in _open(b):
                after = side == 1
                key = of[u[after]].astype(np.int64) * classes + of[v[after]]
                np.add.at(total, key, n[after])
        some = np.flatnonzero(total)
        yield pd.DataFrame({"k": some, "n": total[some]})

    out = np.zeros(classes * classes)
    for r in shards.mapInPandas(add, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out.reshape(classes, classes)


def _moves(shards: DataFrame, of: np.ndarray, pairs: np.ndarray, turn: int) -> list:
    """(unit, class) of the units that may move in this round and gain by it."""
    classes = len(pairs)
    free = np.random.default_rng(turn).integers(0, 2, len(of)) == 1
    free[0] = False  # the end keeps its class to itself

    def choose(batches):
        for b in batches:
            for u, v, side, n in _open(b):
                units, at = np.unique(u, return_inverse=True)
                self_ = v == u
                counts = np.zeros((2, len(units), classes))
                np.add.at(counts, (side[~self_], at[~self_], of[v[~self_]]), n[~self_])
                own = np.zeros(len(units))
                np.add.at(own, at[self_ & (side == 1)], n[self_ & (side == 1)])
                chosen = np.flatnonzero(free[units])
                for lo in range(0, len(chosen), 64):
                    c = chosen[lo:lo + 64]
                    now = of[units[c]]
                    gain = gains(counts[0, c], counts[1, c], own[c], now, pairs)
                    gain[:, 0] = -np.inf
                    best = gain.argmax(axis=1)
                    i = np.arange(len(c))
                    move = gain[i, best] > gain[i, now] + 1e-6 * (1 + np.abs(gain[i, now]))
                    yield pd.DataFrame({"unit": units[c][move], "to": best[move]})

    return shards.mapInPandas(choose, "unit int, to int").collect()  # at most one row per unit


def exchange(shards: DataFrame, sizes: np.ndarray, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of every unit and the counts of pairs of classes. Unit 0 is the end, alone in class
    0; the others begin dealt by falling ``sizes``."""
    of = np.zeros(len(sizes), np.int16)
    order = 1 + np.argsort(-sizes[1:], kind="stable")
    of[order] = 1 + np.arange(len(order)) % (classes - 1)
    best, found, before = None, (of, np.zeros((classes, classes))), -np.inf
    for turn in range(rounds + 1):
        pairs = pair_counts(shards, of, classes)
        now = likelihood(pairs)
        if best is None or now > best:
            best, found = now, (of, pairs)
        if turn == rounds or abs(now - before) < STILL * abs(now):
            break
        before, of = now, of.copy()
        for r in _moves(shards, of, pairs, turn):
            of[r["unit"]] = r["to"]
    return found


# ------------------------------------------------------------------ counts and scores per block
def _numbers(units: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The numbers of units: end 0, endings from 1, own ones after, in the order of ``known``."""
    own = units > END_UNIT
    return np.where(own, 1 + ENDINGS + np.searchsorted(known, units), np.where(units == END_UNIT, 0, 1 + units))


def packed(words: DataFrame, known: np.ndarray) -> DataFrame:
    """(block, c, u, id), one row per block: counts, unit numbers and numbers of its words, by place."""
    def pack(key, g):
        g = g.sort_values("lid")
        return pd.DataFrame({"block": [key[0]], "c": [_pack(g["c"], "<i8")], "id": [_pack(g["id"], "<i8")],
                             "u": [_pack(_numbers(g["unit"].to_numpy(np.int64), known), "<i4")]})

    rows = words.select("block", "lid", "c", "unit", "id").groupBy("block").applyInPandas(pack, "block bigint, c binary, id binary, u binary")
    return bucketed(rows, "block", int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "packed")


def _by_block(table: DataFrame, texts: DataFrame, f, schema: str) -> DataFrame:
    """``f`` of each block's row of ``table`` and its row of ``texts``; both are bucketed by block."""
    def one(row: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([f(r, b) for r, b in zip(row.itertuples(), block.itertuples())])

    return table.groupBy("block").cogroup(texts.select("block", "doc_ids", "held", "lengths", "z").groupBy("block")).applyInPandas(one, schema)


def _trained(block) -> np.ndarray:
    return ~np.repeat(np.asarray(block.held, bool), block.lengths)


def _bigrams(width: int):
    def count(row, block) -> pd.DataFrame:
        u = _unpack(row.u, "<i4")[_unpack(block.z, "<i4")].astype(np.int64)
        before = np.concatenate([[0], u[:-1]])  # a text follows the end of the one before it
        k, n = np.unique((before * width + u)[_trained(block)], return_counts=True)
        return pd.DataFrame({"a": k // width, "b": k % width, "n": n}).astype({"a": "int32", "b": "int32"})

    return count


# ------------------------------------------------------------------ classes of the rarer words
def rare_gains(w: np.ndarray, code: np.ndarray, n: np.ndarray, at: np.ndarray, pairs: np.ndarray):
    """Yields (first word, :func:`gains` of it and the next ones) of words of few neighbours, to a sum
    that is the same for all classes of a word. ``w`` (ascending; every word has a neighbour unlike
    itself), ``code``, ``n`` are neighbours: by class those before the word, after it, last itself."""
    k = len(pairs)
    own = np.bincount(w[code == 2 * k], n[code == 2 * k], len(at))
    w, code, n = (x[code < 2 * k] for x in (w, code, n))
    start = np.searchsorted(w, np.arange(len(at) + 1))
    most = 16  # counts up to this are looked up
    step = np.stack([_f(pairs + i) - _f(pairs) for i in range(most + 1)])
    table = np.stack([step, step.transpose(0, 2, 1)])  # (side, n, class of the neighbour, class tried)
    both = np.stack([pairs, pairs.T])
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(start, start[lo] + 16_384, side="right")) - 1)
        e = slice(start[lo], start[hi])
        i, side, j, m = w[e] - lo, code[e] // k, code[e] % k, n[e]
        now, self_, row = at[lo:hi], own[lo:hi], np.arange(hi - lo)
        around = np.zeros((2, hi - lo, k))
        around[side, i, j] = m
        a = now[i]
        value = table[side, np.minimum(m, most).astype(np.int64), j]
        held = both[side, j, a]
        value[np.arange(len(i)), a] = _f(held) - _f(held - m)  # its own class lacks the word
        hard = np.flatnonzero((m > most) | (j == a))
        rest, mine = both[side[hard], j[hard]], np.flatnonzero(j[hard] == a[hard])
        rest[np.arange(len(hard)), a[hard]] -= m[hard]
        rest[mine] -= around[1 - side[hard][mine], i[hard][mine]]
        rest[mine, a[hard][mine]] -= self_[i[hard][mine]]
        value[hard] = _f(rest + m[hard][:, None]) - _f(rest)
        out = np.add.reduceat(value, start[lo:hi] - start[lo])
        x, c = np.nonzero((self_[:, None] > 0) | ((around[0] > 0) & (around[1] > 0)))
        left, right, s_ = around[0, x, c], around[1, x, c], self_[x]
        d = pairs[c, c] - np.where(c == now[x], left + right + s_, 0)
        out[x, c] += _f(d + left + right + s_) + _f(d) - _f(d + left) - _f(d + right)
        for sums, beside in ((pairs.sum(axis=1), around[1]), (pairs.sum(axis=0), around[0])):
            size, of = np.unique(beside.sum(axis=1) + self_, return_inverse=True)
            grown = (_f(sums[None] + size[:, None]) - _f(sums[None]))[of]
            grown[row, now] = _f(sums[now]) - _f(sums[now] - size[of])
            out -= grown
        yield lo, out
        lo = hi


def _neighbours(of: np.ndarray, classes: int, shards: int):
    """Of a block: for each shard of rarer words, their numbers, places, classes, and the classes
    of the words beside them in training, coded as for :func:`rare_gains`."""
    def emit(row, block) -> pd.DataFrame:
        ids, u, c = _unpack(block.z, "<i4"), _unpack(row.u, "<i4"), _unpack(row.c, "<i8")
        cls, trained, word = of[u].astype(np.int64), _trained(block), _unpack(row.id, "<i8")
        rare = (u > 0) & (u <= ENDINGS) & (c > 0)
        pos = np.flatnonzero(rare[ids] & trained)  # a text's end follows, so the next place exists
        before = np.where(pos > 0, cls[ids[pos - 1]], 0)
        same = (pos > 0) & (ids[pos - 1] == ids[pos])
        after = ids[pos + 1]
        width = 2 * classes + 1
        mine = ids[pos].astype(np.int64) * width
        key, n = np.unique(np.concatenate([(mine + np.where(same, 2 * classes, before)),
                                           (mine + classes + cls[after])[after != ids[pos]]]), return_counts=True)
        only = rare.copy()  # words of held-out texts alone here ask for their class too
        only[key // width] = False
        alone = np.flatnonzero(only)
        key, n = np.concatenate([key, alone * width + 2 * classes]), np.concatenate([n, np.zeros(len(alone), np.int64)])
        lid = key // width
        shard = (word[lid] ^ (word[lid] >> 30)) % shards
        order = np.argsort(shard, kind="stable")
        shard, lid, key, n = shard[order], lid[order], key[order], n[order]
        cut = np.flatnonzero(np.diff(shard)) + 1
        out = []
        for lo, hi in zip([0, *cut], [*cut, len(shard)]):
            if hi > lo:
                out.append((int(shard[lo]), row.block, _pack(word[lid[lo:hi]], "<i8"), _pack(lid[lo:hi], "<i4"),
                            _pack(cls[lid[lo:hi]], "<i2"), _pack(key[lo:hi] % width, "<i2"), _pack(n[lo:hi], "<i4")))
        return pd.DataFrame(out, columns=["shard", "block", "id", "lid", "now", "code", "n"])

    return emit


def _settled(pairs: np.ndarray):
    def choose(key, g):
        read = lambda name, kind: [_unpack(z, kind) for z in g[name]]
        lids, width = read("lid", "<i4"), 2 * len(pairs) + 1
        words, first, w = np.unique(np.concatenate(read("id", "<i8")), return_index=True, return_inverse=True)
        now = np.concatenate(read("now", "<i2"))[first].astype(np.int64)
        keys, of = np.unique(w * width + np.concatenate(read("code", "<i2")), return_inverse=True)
        n = np.bincount(of, np.concatenate(read("n", "<i4")))
        to = now.copy()
        for lo, gain in rare_gains(keys // width, keys % width, n, now, pairs):
            gain[:, 0] = -np.inf  # the end keeps its class to itself
            i, best = np.arange(len(gain)), gain.argmax(axis=1)
            stays = gain[i, now[lo:lo + len(gain)]]
            to[lo:lo + len(gain)] = np.where(gain[i, best] > stays + 1e-6 * (1 + np.abs(stays)), best, now[lo:lo + len(gain)])
        at = np.cumsum([0, *map(len, lids)])
        return pd.DataFrame({"block": g["block"], "lid": [_pack(x, "<i4") for x in lids],
                             "to": [_pack(to[w[a:b]], "<i2") for a, b in zip(at, at[1:])]})

    return choose


def assigned(table: DataFrame, of: np.ndarray, moved: DataFrame | None = None) -> DataFrame:
    """(block, c, u, cls): ``table`` with the class of each word, its unit's or the one it ``moved`` to."""
    def assign(row: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
        cls = of[_unpack(row["u"].iloc[0], "<i4")].astype("<i2")
        for lid, to in zip(moves["lid"], moves["to"]):
            cls[_unpack(lid, "<i4")] = _unpack(to, "<i2")
        return row[["block", "c", "u"]].assign(cls=[_pack(cls, "<i2")])

    spark = table.sparkSession
    if moved is None:
        moved = spark.createDataFrame([], "block bigint, lid binary, to binary")
    out = table.groupBy("block").cogroup(moved.groupBy("block")).applyInPandas(assign, "block bigint, c binary, u binary, cls binary")
    return bucketed(out, "block", int(spark.conf.get("spark.sql.shuffle.partitions")), "classes")


def settle(table: DataFrame, texts: DataFrame, of: np.ndarray, pairs: np.ndarray, rare: float) -> DataFrame:
    """(block, c, u, cls): ``table`` with the class of each word. Each of the rarer words, of ``rare``
    training tokens in all, goes from its unit's class to that of the greatest gain of its own bigrams."""
    spark, classes = table.sparkSession, len(pairs)
    shards = int(2 * rare) // (2 * SHARD) + int(spark.sparkContext.defaultParallelism)
    beside = _by_block(table, texts, _neighbours(of, classes, shards),
                       "shard bigint, block bigint, id binary, lid binary, now binary, code binary, n binary")
    moved = beside.groupBy("shard").applyInPandas(_settled(pairs), "block bigint, lid binary, to binary")

    return assigned(table, of, moved)


def class_counts(table: DataFrame, texts: DataFrame, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of pairs of classes, and of words met once by unit number (other than words of
    a unit of their own) and class."""
    def count(row, block) -> pd.DataFrame:
        ids, cls = _unpack(block.z, "<i4"), _unpack(row.cls, "<i2").astype(np.int64)
        trained, u = _trained(block), _unpack(row.u, "<i4")
        c = cls[ids]
        total = np.bincount((np.concatenate([[0], c[:-1]]) * classes + c)[trained], minlength=classes * classes)
        lid = ids[trained & (_unpack(row.c, "<i8") == 1)[ids]]  # the one place of the word in training
        once = np.bincount(np.minimum(u[lid], 1 + ENDINGS) * classes + cls[lid], minlength=(2 + ENDINGS) * classes)
        both = np.concatenate([total, once])
        some = np.flatnonzero(both)
        return pd.DataFrame({"k": some, "n": both[some]})

    both = np.zeros(classes * classes + (2 + ENDINGS) * classes)
    for r in _by_block(table, texts, count, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        both[r["k"]] = r["n"]
    return both[:classes * classes].reshape(classes, classes), both[classes * classes:].reshape(2 + ENDINGS, classes)


def _scorer(model: dict):
    size, unseen, transition = model["size"], model["unseen"], model["transition"]
    of, known, base = model["of"], model["known"], model["total"] + 1 * (model["distinct"] + 1)

    def score(words: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        """``words`` are rows of :func:`word_table`, or one row of :func:`settle`."""
        if "cls" in words:
            count = _unpack(words["c"].iloc[0], "<i8").astype(float)
            cls = _unpack(words["cls"].iloc[0], "<i2").astype(np.int64)
            cls = np.where(count > 0, cls, of[_unpack(words["u"].iloc[0], "<i4")])
        else:
            count, cls = np.zeros(len(words)), np.zeros(len(words), np.int64)
            count[words["lid"]] = words["c"]
            cls[words["lid"]] = of[_numbers(words["unit"].to_numpy(), known)]
        seen = count > 0
        ln = np.log10(np.where(seen, (1 - unseen[cls]) * np.where(seen, count, 1) / np.maximum(size[cls], 1),
                               np.maximum(unseen[cls], np.finfo(float).tiny)))
        unigram = np.log10((count + 1) / base)
        out = []
        for doc_ids, held, lengths, z in zip(block["doc_ids"], block["held"], block["lengths"], block["z"]):
            ids = _unpack(z, "<i4")
            c = cls[ids]
            at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            value = transition[np.concatenate([[0], c[:-1]]), c] + ln[ids]
            out.append(pd.DataFrame({
                "doc_id": pd.array(list(doc_ids), "Int64"), "held_out": held, "n_tokens": lengths,
                "n_known": np.add.reduceat(seen[ids].astype(np.int64), at),
                "base_score": np.add.reduceat(unigram[ids], at), "score": np.add.reduceat(value, at)}))
        return pd.concat(out)

    return score


def _emissions(model: dict, pairs: np.ndarray, size: np.ndarray, once: np.ndarray) -> dict:
    """``model`` with what classes give: their sizes, shares of unseen words and transitions."""
    share = (size + 0.5) / (size + 0.5).sum()
    unseen = np.where(size > 0, (once + 0.5) / (size + 1.0), 1.0)
    if size[0]:
        unseen[0] = 0.0  # no word is unseen there: the end alone
    return {**model, "size": size, "unseen": unseen, "pairs": pairs,
            "transition": np.log10((pairs + PRIOR * share) / (pairs.sum(axis=1, keepdims=True) + PRIOR))}


def _fit(texts: DataFrame, words: DataFrame, total: int, classes: int, rounds: int) -> tuple[dict, DataFrame, float]:
    """The model by units, the table :func:`packed` and the training tokens of the rarer words."""
    spark = texts.sparkSession
    trained = words.where(F.col("first") & (F.col("c") > 0))
    sizes = (trained.groupBy("unit").agg(F.sum("c").alias("c"), F.count("*").alias("words"),
                                         F.count(F.when(F.col("c") == 1, 1)).alias("once"))
             .collect())  # at most 1 / SHARE + ENDINGS + 1 rows
    known = np.array(sorted(r["unit"] for r in sizes if r["unit"] > END_UNIT), np.int64)
    number = _numbers(np.array([r["unit"] for r in sizes], np.int64), known)
    width = 1 + ENDINGS + len(known)
    tokens_of, once_of = np.zeros(width), np.zeros(width)
    tokens_of[number], once_of[number] = [r["c"] for r in sizes], [r["once"] for r in sizes]

    table = packed(words, known)
    counts = _by_block(table, texts, _bigrams(width), "a int, b int, n bigint")
    bigrams = staged(counts.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    shards = _shards(bigrams, bigrams.count() // SHARD + int(spark.sparkContext.defaultParallelism))
    of, pairs = exchange(shards, tokens_of, classes, rounds)

    # an ending that training never met goes with the class that has most words met once
    once = np.bincount(of, once_of, classes)
    of = np.where((tokens_of == 0) & (np.arange(len(of)) > 0), once[1:].argmax() + 1, of)
    model = {"known": known, "of": of, "total": total, "distinct": int(sum(r["words"] for r in sizes))}
    return _emissions(model, pairs, np.bincount(of, tokens_of, classes), once), table, float(tokens_of[1:1 + ENDINGS].sum())


def fit(texts: DataFrame, words: DataFrame, total: int, classes: int = CLASSES, rounds: int = ROUNDS) -> dict:
    """The model by units: numbers of units, their classes, class sizes and decimal logarithms of transitions."""
    return _fit(texts, words, total, classes, rounds)[0]


def fit_words(texts: DataFrame, words: DataFrame, total: int, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[dict, DataFrame]:
    """The model and the table of :func:`settle`: as :func:`fit`, and each of the rarer words in the class
    of its own greatest gain, if the likelihood grows by all these moves."""
    model, table, rare = _fit(texts, words, total, classes, rounds)
    of = model["of"]
    settled = settle(table, texts, of, model["pairs"], rare)
    pairs, once = class_counts(settled, texts, classes)
    if likelihood(pairs) < likelihood(model["pairs"]):
        settled = assigned(table, of)
        pairs, once = class_counts(settled, texts, classes)
    model = _emissions(model, pairs, pairs.sum(axis=0), once.sum(axis=0))
    # a word never seen goes with most words of its ending that were met once, or with most such words
    ending = once[1:1 + ENDINGS, 1:]
    of = of.copy()
    of[1:1 + ENDINGS] = 1 + np.where(ending.any(axis=1), ending.argmax(axis=1), once[:, 1:].sum(axis=0).argmax())
    return {**model, "of": of}, settled


def score(docs: DataFrame, held_out: Column, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score; the logarithms are decimal.

    The model learns from the rows where the condition ``held_out`` is false or null. p(class |
    class) is its share, with ``PRIOR`` pairs added in proportion to the classes' sizes. A class
    gives unseen words the share of its words that occur once; the others divide the rest by their
    counts, so that the probabilities of all words and of one unseen word per class add up to 1.
    A null or empty text has the end token alone; without training rows every token is unseen.
    Repeated rows are each learned and scored; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    texts = blocks(rows)
    total = texts.select(F.sum(F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x))).head()[0] or 0
    model, classed = fit_words(texts, word_table(texts, total), total, classes, rounds)
    out = classed.groupBy("block").cogroup(texts.drop("words", "n").groupBy("block")).applyInPandas(
        _scorer(model), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                      "base_score", "score")
