"""Operator 3: quality by perplexity under interpolated modified Kneser-Ney.

The model is a character 4-gram model per language, counted over all trusted text. A gram is four
16-bit code units in one long (code points above that share a unit), so contexts and suffixes are
shifts and masks. Counts, continuation counts, context totals and discounts are hash-partitioned
tables; a gram's probability is

    p_k(g) = max(a(g) - D(a(g)), 0) / total(context) + gamma(context) * p_(k-1)(suffix)

with a the count at the highest order and the number of distinct left neighbours below, and the
discounts D1, D2, D3+ of each order and language from its counts of counts.

Documents are written once, compressed, in blocks of bounded size, as a table bucketed by block:
whatever is later needed of a block's texts, or brought to them, comes by block without moving a
text. A block's distinct grams are joined with the count tables, and the few probabilities it needs
come back to it, so the model is never gathered in one place and no n-gram row per document is
shuffled. A document is kept when its perplexity is at most its language's ``QUANTILE`` among
trusted documents that were not counted.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import bucketed, only, prepare, staged

ORDER = 4
#: Code points of a block, about; quantile of held-out perplexities; width of a bin of ln perplexity.
BLOCK_CHARS, QUANTILE, BIN = 32_000_000, 0.995, 0.001
#: One trusted document in so many is held out for the quantiles.
FOLDS = 5
START, OTHER = 1, 0xFFFD
DISCOUNTS = (0.5, 1.0, 1.5)


def grams(text: str) -> np.ndarray:
    """The 4-grams of a text as int64, one per code point; white space runs count as one space."""
    units = np.frombuffer(" ".join(text.split()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    units = np.where((units > OTHER) | (units == START), np.uint64(OTHER), units)
    u = np.concatenate([np.full(ORDER - 1, START, np.uint64), units])
    n = len(units)
    out = np.zeros(n, np.uint64)
    for j in range(ORDER):
        out = (out << np.uint64(16)) | u[j:j + n]
    return out.view(np.int64)


def _tally(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(parts), return_counts=True)


def _merge(total: tuple[np.ndarray, np.ndarray], parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    g, c = _tally(parts)
    u, at = np.unique(np.concatenate([total[0], g]), return_inverse=True)
    return u, np.bincount(at, np.concatenate([total[1], c]), len(u)).astype(np.int64)


def _grams_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of texts and their counts, a few million at a time."""
    total, parts, held = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
    for t in texts:
        parts.append(grams(t))
        held += len(parts[-1])
        if held > 4_000_000:
            total, parts, held = _merge(total, parts), [], 0
    return _merge(total, parts)


def _language(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("none"))


def _context(g: Column) -> Column:
    return F.shiftrightunsigned(g, 16)


def _suffix(g: Column, order: int) -> Column:
    return g.bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))


def count_tables(counts: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """{order: (grams (lang, g, mass), contexts (lang, h, total, gamma))} from partial counts
    (lang, g, a); mass is the discounted count. Every table is written to the shared folder."""
    out = {}
    level = staged(counts.groupBy("lang", "g").agg(F.sum("a").alias("a")), "grams")
    for k in range(ORDER, 0, -1):
        of = level.groupBy("lang").agg(*[F.count(F.when(F.col("a") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        use = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
        d = [F.when(use, F.least(F.lit(float(i)), F.greatest(F.lit(0.1), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))))
             .otherwise(F.lit(DISCOUNTS[i - 1])) for i in (1, 2, 3)]
        discounts = staged(of.select("lang", *[x.alias(f"d{i + 1}") for i, x in enumerate(d)]), "discounts")
        drop = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))
        mass = (level.join(discounts, "lang").withColumn("drop", F.least(drop, F.col("a").cast("double")))
                .withColumn("mass", F.col("a") - F.col("drop")))
        contexts = staged(mass.groupBy("lang", _context(F.col("g")).alias("h"))
                          .agg(F.sum("a").alias("total"), (F.sum("drop") / F.sum("a")).alias("gamma")), "contexts")
        out[k] = (mass.select("lang", "g", "mass"), contexts)
        level = staged(level.groupBy("lang", _suffix(F.col("g"), k).alias("g")).agg(F.count("*").alias("a")), "grams")
    return out


def probabilities(asked: DataFrame, tables: dict[int, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, g, p) of the distinct grams ``asked`` (lang, g)."""
    sizes = staged(tables[1][0].groupBy("lang").agg(F.count("*").alias("v")), "alphabets")
    wanted = {ORDER: asked}
    for k in range(ORDER - 1, 0, -1):
        wanted[k] = wanted[k + 1].select("lang", _suffix(F.col("g"), k + 1).alias("g")).distinct()
    below = None
    for k in range(1, ORDER + 1):
        mass, contexts = tables[k]
        if k == 1:
            rows = wanted[1].join(sizes, "lang", "left").withColumn("p0", 1 / (F.coalesce("v", F.lit(0)) + 1))
        else:
            rows = (wanted[k].withColumn("s", _suffix(F.col("g"), k))
                    .join(below.select("lang", F.col("g").alias("s"), F.col("p").alias("p0")), ["lang", "s"]))
        rows = (rows.withColumn("h", _context(F.col("g")))
                .join(mass, ["lang", "g"], "left").join(contexts, ["lang", "h"], "left")
                .select("lang", "g", (F.coalesce(F.col("mass") / F.col("total"), F.lit(0.0))
                                      + F.coalesce("gamma", F.lit(1.0)) * F.col("p0")).alias("p")))
        below = staged(rows, "probabilities")
    return below


def _blocks(docs: DataFrame) -> DataFrame:
    """(block, row, doc_id, lang, z) of docs, z the compressed text, bucketed by block."""
    def shrink(batches):
        from pyspark import TaskContext

        block, chars, row = TaskContext.get().partitionId() << 24, 0, 0
        for b in batches:
            z, blocks = [], []
            for t in b["text"]:
                if chars > BLOCK_CHARS:
                    block, chars = block + 1, 0
                t = t or ""
                chars += len(t)
                z.append(zlib.compress(t.encode("utf-8", "surrogatepass"), 6))
                blocks.append(block)
            yield pd.DataFrame({"block": blocks, "row": range(row, row + len(z)), "doc_id": b["doc_id"].astype("Int64"),
                                "lang": b["lang"], "z": z})
            row += len(z)

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.mapInPandas(shrink, "block bigint, row bigint, doc_id bigint, lang string, z binary")
    return bucketed(rows, "block", parts, "texts")


def _open(z: bytes) -> str:
    return zlib.decompress(z).decode("utf-8", "surrogatepass")


def _distinct(block: pd.DataFrame) -> pd.DataFrame:
    return pd.concat([pd.DataFrame({"block": block["block"].iloc[0], "lang": lang, "g": _grams_of(map(_open, rows["z"]))[0]})
                      for lang, rows in block.groupby("lang")])


def _counted(chosen: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    """Counts of the grams of a block's chosen rows."""
    rows = block[block["row"].isin(chosen["row"])]
    out = [pd.DataFrame(dict(zip(("g", "a"), _grams_of(map(_open, r["z"]))), lang=lang)) for lang, r in rows.groupby("lang")]
    return pd.concat(out)[["lang", "g", "a"]] if out else pd.DataFrame({"lang": [], "g": [], "a": []}).astype({"lang": str})


def _score(known: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    tables = {}
    for lang, rows in known.groupby("lang"):
        order = np.argsort(rows["g"].to_numpy())
        tables[lang] = rows["g"].to_numpy()[order], np.log(rows["p"].to_numpy())[order]
    out = []
    for doc_id, lang, z in zip(block["doc_id"], block["lang"], block["z"]):
        g = grams(_open(z))
        total = 0.0
        if len(g):
            keys, logs = tables[lang]
            total = float(logs[np.searchsorted(keys, g)].sum())
        out.append((doc_id, lang, len(g), total))
    f = pd.DataFrame(out, columns=["doc_id", "lang", "n_grams", "log_prob"])
    f["doc_id"] = f["doc_id"].astype("Int64")
    return f


def _scored(texts: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, lang, n_grams, log_prob, perplexity) of every row of ``texts`` under the model of
    its rows ``trusted`` (block, row)."""
    trusted = trusted.select(F.col("block").alias("at"), F.col("row").alias("row"))
    counts = trusted.groupBy("at").cogroup(texts.groupBy("block")).applyInPandas(_counted, "lang string, g bigint, a bigint")
    tables = count_tables(counts)
    asked = staged(texts.groupBy("block").applyInPandas(_distinct, "block bigint, lang string, g bigint"), "asked")
    known = (asked.join(probabilities(asked.select("lang", "g").distinct(), tables), ["lang", "g"])
             .withColumnRenamed("block", "at"))
    scored = known.groupBy("at").cogroup(texts.groupBy("block")).applyInPandas(
        _score, "doc_id bigint, lang string, n_grams bigint, log_prob double")
    return scored.withColumn("perplexity", F.when(F.col("n_grams") > 0, F.exp(-F.col("log_prob") / F.col("n_grams"))))


def perplexities(docs: DataFrame, trusted: Column) -> DataFrame:
    """(doc_id, lang, n_grams, log_prob, perplexity) per row of ``docs`` (doc_id, text, lang) under
    the model of the rows whose doc_id meets ``trusted``. A text without words has no grams and no
    perplexity; a language without trusted text is scored as uniform over one unit."""
    prepare(docs.sparkSession)
    texts = _blocks(docs.select(F.col("doc_id").cast("long"), "text", _language(F.col("lang")).alias("lang")))
    return _scored(texts, texts.where(trusted).select("block", "row"))


def quality_classifier(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, lang (null kept), n_grams, perplexity,
    threshold, kept.

    Trusted text is that of rows with a label quality 1 and none of another; a null doc_id has no
    label. Empty texts are not kept; a language without held-out trusted text keeps the rest.
    Repeated rows are each scored; other columns are ignored.
    """
    prepare(docs.sparkSession)
    texts = _blocks(docs.select(F.col("doc_id").cast("long"), "text", _language(F.col("lang")).alias("lang")))
    good = (only(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy("doc_id").agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
            .where("least = 1 AND most = 1")
            .select("doc_id", (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == 0).alias("held_out")))
    counted = texts.select("block", "row", "doc_id").join(good.where(~F.col("held_out")), "doc_id", "left_semi")
    scored = staged(_scored(texts, counted.select("block", "row")), "perplexities")
    bins = (scored.join(good.where("held_out"), "doc_id", "left_semi").where("n_grams > 0")
            .groupBy("lang", F.ceil(F.log("perplexity") / BIN).alias("bin")).agg(F.count("*").alias("n")))
    up = Window.partitionBy("lang").orderBy("bin")
    share = F.sum("n").over(up) / F.sum("n").over(Window.partitionBy("lang"))
    cut = staged(bins.withColumn("share", share).where(F.col("share") >= quantile)
                 .groupBy("lang").agg(F.exp(F.min("bin") * BIN).alias("threshold")), "quantiles")
    return (scored.join(cut, "lang", "left")
            .select("doc_id", F.when(F.col("lang") != "none", F.substring("lang", 2, 1 << 30)).alias("lang"), "n_grams",
                    "perplexity", "threshold",
                    F.when(F.col("n_grams") > 0, F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
                    .otherwise(F.lit(False)).alias("kept")))
