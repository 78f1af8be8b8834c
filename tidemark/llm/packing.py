"""Operator 4: packing documents into sequences by cutting-stock column generation.

A document's ids are cut into pieces of ``LENGTH`` ids and one shorter rest. The histogram of
piece lengths (at most ``LENGTH`` numbers, solved in one task) is a cutting-stock
problem: a linear program over patterns, lengths that fill one sequence, solved by column
generation with a knapsack dynamic program pricing the columns. Patterns are used a whole number
of times, rounded down; what remains, less than one sequence per pattern of the basis, is placed
best fit. Pieces are then ranked within their length, distributed, and each rank has its place in
a pattern by arithmetic.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import prepare, staged

#: Ids of a sequence, and the id that ends a document.
LENGTH, END = 1024, 0
#: Fewest and most pricing rounds, patterns entered in one, and the gap to the optimum that ends them.
AT_LEAST, ROUNDS, BATCH, GAP = 8, 400, 24, 0.0002

#: Shards whose counts add up together.
RUN = 4096

_ENCODERS: dict = {}


def _encoder(path: str):
    """The byte-level BPE of a ``.tiktoken`` rank file or of a ``tokenizers`` JSON file, as a
    function from texts to lists of ids; special tokens' strings are ordinary text."""
    if path not in _ENCODERS:
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            _ENCODERS[path] = lambda text: t.encode(text, add_special_tokens=False).ids
        else:
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _ENCODERS[path] = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                                special_tokens={}).encode_ordinary
    return _ENCODERS[path]


def default_tokenizer() -> str:
    """The rank file of the vocabulary in byte_bpe_50k.json: the same ids, three times as fast."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece of every row of ``docs``."""
    def cut(batches):
        encode = _encoder(tokenizer)
        for b in batches:
            out = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                ids = np.array([*(encode(text) if text else ()), END], "<u4")
                out += [(doc_id, s, len(ids[s:s + length]), zlib.crc32(ids[s:s + length].tobytes()), len(ids))
                        for s in range(0, len(ids), length)]
            p = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            p["doc_id"] = p["doc_id"].astype("Int64")
            yield p

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        cut, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def _knapsack(sizes: np.ndarray, worth: np.ndarray, room: int):
    """The unbounded knapsack by (max, +) doubling: best[c] is the most worth within c, and
    items(c) says which items make it."""
    best, item = np.zeros(room + 1), np.full(room + 1, -1)
    for i in np.argsort(worth, kind="stable"):  # of equal sizes the last, most worth, stays
        best[sizes[i]], item[sizes[i]] = max(worth[i], 0), i
    item = item[at := np.maximum.accumulate(np.where(best >= np.maximum.accumulate(best), np.arange(room + 1), 0))]
    best, home, splits = best[at], at, []
    while True:
        half = np.arange(room // 2 + 1)
        other = np.arange(room + 1)[:, None] - half
        both = np.where(other >= half, best[half] + best[np.maximum(other, 0)], -1)
        split = both.argmax(axis=1)
        top = both[np.arange(room + 1), split]
        if not (top > best + 1e-12).any():
            break
        splits.append(np.where(top > best + 1e-12, split, 0))
        best = np.maximum(best, top)

    def items(c: int, level: int | None = None) -> dict[int, int]:
        level = len(splits) if level is None else level
        if level == 0:
            return {int(item[c]): 1} if home[c] else {}
        a = int(splits[level - 1][c])
        if a == 0:
            return items(c, level - 1)
        out = items(a, level - 1)
        for k, n in items(c - a, level - 1).items():
            out[k] = out.get(k, 0) + n
        return out

    return best, items


def _matrix(columns: list[dict[int, int]]) -> np.ndarray:
    out = np.zeros((len(columns), len(columns)))
    for j, c in enumerate(columns):
        out[list(c), j] = list(c.values())
    return out


def _first_basis(sizes: np.ndarray, need: np.ndarray, room: int) -> list[dict[int, int]]:
    """A basis to start from: patterns filled longest first, each used until a length runs out.
    Later patterns lack that length, so the basis is triangular."""
    left, columns = need.copy(), [{i: int(room // s)} for i, s in enumerate(sizes.tolist())]
    while (open_ := np.flatnonzero(left > 0)).size:
        space, col = room, {}
        while (fits := open_[: np.searchsorted(sizes[open_], space, side="right")]).size:
            i = int(fits[-1])
            col[i] = int(space // sizes[i])
            space -= col[i] * int(sizes[i])
            open_ = fits[:-1]
        times = {i: left[i] / k for i, k in col.items()}
        out = min(times, key=times.get)
        for i, k in col.items():
            left[i] = max(0.0, left[i] - times[out] * k) if left[i] - times[out] * k > 1e-9 else 0.0
        columns[out] = col
    return columns


def cutting_patterns(histogram: dict[int, int], room: int = LENGTH) -> list[tuple[dict[int, int], int]]:
    """[(pattern, times)]: patterns {length: count} that place exactly the pieces of ``histogram``."""
    todo = {s: n for s, n in histogram.items() if n > 0}
    out = [({room: 1}, todo.pop(room))] if room in todo else []
    if not todo:
        return out
    sizes = np.array(sorted(todo), np.int64)
    need = np.array([todo[s] for s in sizes.tolist()], np.float64)
    m = len(sizes)
    columns = _first_basis(sizes, need, room)
    inverse = np.linalg.inv(_matrix(columns))
    least, pivots, smooth = float(need @ sizes) / room, 0, 0.9
    sound, broken = (list(columns), inverse.copy()), False
    for turn in range(ROUNDS):
        x = inverse @ need
        if turn >= AT_LEAST and x.sum() <= max(least * (1 + GAP), least + 0.5):
            break
        duals = inverse.sum(axis=0)
        # duals jump about at first; prices between them and those of a perfect fill settle them
        prices = smooth * sizes / room + (1 - smooth) * np.maximum(duals, 0)
        best, items = _knapsack(sizes, prices, room)
        if smooth == 0 and best[room] <= 1 + GAP:
            break
        # the best pattern, and the best with each of the dearest lengths in it
        with_item = prices + best[room - sizes]
        entering = [items(room)]
        for i in np.argsort(-(with_item + duals - prices), kind="stable")[:BATCH].tolist():
            col = items(int(room - sizes[i]))
            col[i] = col.get(i, 0) + 1
            entering.append(col)
        before = pivots
        for col in entering:
            at, times = list(col), np.array(list(col.values()), np.float64)
            if inverse.sum(axis=0)[at] @ times <= 1 + 1e-7:
                continue
            step = inverse[:, at] @ times
            able = step > 1e-7
            if not able.any():
                continue
            ratio = np.where(able, np.maximum(inverse @ need, 0) / np.where(able, step, 1), np.inf)
            least_ratio = ratio.min()
            leave = int(np.where(ratio <= least_ratio + 1e-9, step, 0).argmax())  # of equals the safest pivot
            columns[leave] = col
            pivot = inverse[leave] / step[leave]
            rows = np.flatnonzero(np.abs(step) > 1e-13)
            inverse[rows] -= step[rows, None] * pivot
            inverse[leave] = pivot
            pivots += 1
            if pivots % 200 == 0:  # rounding errors end here
                try:
                    inverse = np.linalg.inv(_matrix(columns))
                    sound = (list(columns), inverse.copy())
                except np.linalg.LinAlgError:
                    broken = True
                    break
        if broken:  # errors have grown too large: the last sound basis is a solution as well
            columns, inverse = sound
            break
        if pivots == before:
            if smooth == 0:
                break
            smooth = smooth - 0.3 if smooth > 0.35 else 0.0
    left = need.astype(np.int64)
    for x, col in sorted(zip(np.floor(inverse @ need + 1e-9).astype(np.int64).tolist(), columns), key=lambda p: -p[0]):
        times = min([x, *(int(left[i]) // k for i, k in col.items())])
        if times > 0:
            out.append(({int(sizes[i]): k for i, k in col.items()}, times))
            for i, k in col.items():
                left[i] -= k * times
    return out + _best_fit({int(s): int(n) for s, n in zip(sizes, left) if n}, room)


def _best_fit(rest: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Longest first, each into the fullest sequence that still holds it."""
    free: list[tuple[int, int]] = []
    bins: list[dict[int, int]] = []
    for s in sorted(rest, reverse=True):
        n = rest[s]
        while n:
            at = bisect.bisect_left(free, (s, -1))
            space, b = free.pop(at) if at < len(free) else (room, len(bins))
            if b == len(bins):
                bins.append({})
            k = min(n, space // s)
            bins[b][s] = bins[b].get(s, 0) + k
            n -= k
            if space - k * s:
                bisect.insort(free, (space - k * s, b))
    return [(b, 1) for b in bins]


def _places(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, count in a sequence, first sequence, offset there)."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for s, k in sorted(pattern.items(), reverse=True):
            first = ranks.get(s, 0)
            ranks[s] = first + k * times
            rows.append((s, first, first + k * times, k, sequence, offset))
            offset += k * s
        sequence += times
    return rows


PLACE = "length bigint, first bigint, end bigint, k bigint, base bigint, at bigint"


def _planner(length: int):
    """The places of a histogram's patterns, solved in one task: a histogram has at most ``length`` rows."""
    def plan(batches):
        histogram = {int(s): int(n) for b in batches for s, n in zip(b["length"], b["n"])}
        rows = _places(cutting_patterns(histogram, length))
        yield pd.DataFrame(rows, columns=["length", "first", "end", "k", "base", "at"]).astype("int64")

    return plan


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A null or empty text is its end id alone. Repeated rows are packed each; a null doc_id stays
    null. An empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    cut = staged(pieces(docs, tokenizer or default_tokenizer(), length), "pieces")
    histogram = staged(cut.groupBy("length").agg(F.count("*").alias("n")), "histogram")
    places = staged(histogram.coalesce(1).mapInPandas(_planner(length), PLACE), "places")  # at most `length` rows
    most = histogram.agg(F.max("n")).head()[0] or 0
    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(1 + most // 512))
    spread = cut.withColumn("shard", shard)
    # running counts in two levels: of runs of shards, and of the shards in a run
    run = F.floor(F.col("shard") / RUN)
    counts = staged(spread.groupBy("length", run.alias("run"), "shard").agg(F.count("*").alias("n")), "shard-counts")

    def before(*keys: str, by: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0))

    runs = (counts.groupBy("length", "run").agg(F.sum("n").alias("n"))
            .select("length", "run", before("length", by="run").alias("base_run")))
    counts = (counts.select("length", "run", "shard", before("length", "run", by="shard").alias("in_run"))
              .join(runs, ["length", "run"]).select("length", "shard", (F.col("base_run") + F.col("in_run")).alias("base_rank")))
    inside = Window.partitionBy("length", "shard").orderBy("doc_id", "start", "ids_crc32")
    ranked = (spread.withColumn("n", F.row_number().over(inside) - 1).join(counts, ["length", "shard"])
              .withColumn("rank", F.col("base_rank") + F.col("n")).drop("shard", "n", "base_rank"))
    # at most `length` patterns of at most 44 distinct lengths each: a bound that no data exceeds
    in_turn = F.floor((F.col("rank") - F.col("first")) / F.col("k"))
    return (ranked.join(F.broadcast(places), "length").where("rank >= first AND rank < end")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("base") + in_turn).cast("long").alias("sequence_id"),
                    (F.col("at") + (F.col("rank") - F.col("first") - in_turn * F.col("k")) * F.col("length")).cast("long").alias("offset")))
