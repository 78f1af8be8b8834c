"""Operator 8: near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct 5-word shingles, hashed to 64 bits by one function; the k
smallest hashes are its sketch.

1. Documents with equal sets form a class; only classes go on, so exact copies make no pairs.
2. Inverted lists of retained values generate candidate pairs. A value kept by more than
   ``COMMON`` classes is common and makes no list: a class emits its smallest other values, ``EMIT``
   of them or more at lower thresholds.
3. A class whose sketch is mostly common values (a large family of near copies, or a text that is
   mostly a shared passage) also gets its whole set indexed, rarest value first. Linked sets must
   share a value among their first ``n - ceil(link n) + 1``, so lists over these prefixes lose
   nothing. A list of at most ``COMMON`` classes makes its pairs. In a longer list two sets whose
   first shared value is common share common values only, which bounds their similarity by
   counts alone: a list links to its class with fewest rare values, and only members that stay
   in another component and pass the bound are compared further.
4. Union-sketch estimation drops candidates far below the threshold (six standard deviations).
5. Exact Jaccard on whole sets decides. Components come from label propagation.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .base import carried, only, prepare, staged
from .graph import components

#: Retained values of a sketch, values a class emits at least, and the list length from which a value is common.
K, EMIT, COMMON = 48, 14, 32
#: The similarity that links: 100 * intersection >= LINK * union.
LINK = 85
#: Fixed value: words of a shingle.
SHINGLE = 5

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes (int64) of a text's shingles; a text with fewer than
    five words has its whole sequence as one, one without words has none."""
    import xxhash

    ws = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not ws:
        return np.zeros(0, np.int64)
    width = min(SHINGLE, len(ws))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    n = len(ws) - width + 1
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = (out ^ h[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out.view(np.int64))


def _sketches(batches):
    import hashlib

    for b in batches:
        sets = [shingle_hashes(t) for t in b["text"]]
        yield pd.DataFrame({
            "doc_id": b["doc_id"].astype("Int64"),
            "tag": b["tag"],
            "n_shingles": [len(s) for s in sets],
            "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
            "sketch": [s[:K] for s in sets],
        })


def _sets(batches):
    for b in batches:
        sets = [shingle_hashes(t) for t in b["text"]]
        yield pd.DataFrame({"d": b["d"], "n": [len(s) for s in sets], "hashes": sets})


def _tag() -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _tally(batches):
    """(v, c): how many of a batch's sets hold each value."""
    for b in batches:
        v, c = np.unique(np.concatenate([np.zeros(0, np.int64), *b["hashes"]]), return_counts=True)
        yield pd.DataFrame({"v": v.astype(np.int64), "c": c.astype(np.int64)})


def _pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a < b) of the members (v, d) of lists that are all short."""
    left, right = lists.select("v", F.col("d").alias("a")), lists.select("v", F.col("d").alias("b"))
    return left.join(right, "v").where("a < b").select("a", "b").distinct()


def _estimate(a: Column, b: Column) -> Column:
    """Jaccard estimate: the share of the union's smallest values that both sketches hold."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, F.least(F.lit(K), F.greatest(F.size(a), F.size(b))))
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)


def _linked(pairs: DataFrame, sets: DataFrame, link: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    x = sets.select(F.col("d").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    y = sets.select(F.col("d").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    near = (100 * F.least("na", "nb") >= link * F.greatest("na", "nb"))
    return (pairs.join(x, "a").join(y, "b").where(near)
            .where(100 * both >= link * (F.col("na") + F.col("nb") - both)).select("a", "b"))


def _prefixes(sets: DataFrame, link: int) -> DataFrame:
    """For the whole sets of crowded classes: rows (v, g, d, n, r) of each set's rarest-first
    prefix; g is the number of sets with value v, r the set's number of rare values."""
    rows = sets.select("d", "n", F.explode("hashes").alias("v"))
    g = (sets.select("hashes").mapInPandas(_tally, "v bigint, c bigint")
         .groupBy("v").agg(F.sum("c").alias("g")))
    ordered = (rows.join(g, "v").groupBy("d", "n")
               .agg(F.sort_array(F.collect_list(F.struct("g", "v"))).alias("o")))
    length = F.col("n") - F.ceil(F.col("n") * (link / 100) - 1e-9).cast("int") + 1
    return (ordered.withColumn("r", F.size(F.filter("o", lambda x: x["g"] <= COMMON)))
            .select("d", "n", "r", F.inline(F.slice("o", F.lit(1), length))).where("g > 1"))


def _emitted(link: int) -> int:
    """How many values a class emits: in proportion to what a linked set may hold besides."""
    return max(EMIT, math.ceil(EMIT * (100 - link) / (100 - LINK)))


def _crowded_percent(link: int) -> int:
    """How much of a sketch may be common values before the whole set is indexed. The lower the
    threshold, the more of the other values may be those that only one of two sets holds."""
    return max(0, min(link - 20, 3 * link - 190))


def link_classes(classes: DataFrame, docs: DataFrame, link: int = LINK) -> DataFrame:
    """(node, label) of the classes (d, n, sketch, one) that have links: d numbers a class, one is the
    doc_id and tag of a row of it, whose text ``docs`` gives."""
    values = classes.select("d", F.explode("sketch").alias("v"))
    common = staged(values.groupBy("v").agg(F.count("*").alias("f")).where(F.col("f") > COMMON).select("v"), "common")
    held = values.join(common, "v").groupBy("d").agg(F.collect_list("v").alias("held"))
    size = F.size("sketch")
    own = (classes.join(held, "d", "left")
           .withColumn("own", F.array_except("sketch", F.coalesce("held", F.array().cast("array<bigint>"))))
           .withColumn("crowded", F.size("own") < size - F.ceil(size * _crowded_percent(link) / 100).cast("int") + 1))
    own = staged(own.select("d", "crowded", F.when(F.col("crowded"), F.col("own"))
                            .otherwise(F.slice("own", 1, _emitted(link))).alias("emit")), "emitted")
    candidates = _pairs(own.select("d", F.explode("emit").alias("v")))
    a, b = (classes.select(F.col("d").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    slack = 6 * math.sqrt(link / 100 * (1 - link / 100) / K)
    likely = staged(
        candidates.join(a, "a").join(b, "b")
        .where(100 * F.least("na", "nb") >= link * F.greatest("na", "nb"))
        .where(_estimate(F.col("sa"), F.col("sb")) >= link / 100 - slack).select("a", "b"), "likely")
    crowded = own.where("crowded").select("d")
    needed = (likely.select(F.explode(F.array("a", "b")).alias("d")).unionByName(crowded).distinct()
              .join(classes.select("d", F.col("one.doc_id").alias("id"), F.col("one.tag").alias("t")), "d"))
    texts = docs.select("doc_id", "text", _tag().alias("tag"))
    found = (texts.join(needed, (texts["tag"] == needed["t"]) & texts["doc_id"].eqNullSafe(needed["id"]))
             .groupBy("d").agg(F.first("text").alias("text")))  # repeated rows have one text
    sets = staged(found.mapInPandas(_sets, "d bigint, n int, hashes array<bigint>"), "sets")

    lists = staged(_prefixes(sets.join(crowded, "d", "left_semi"), link), "prefixes")
    long = lists.where(F.col("g") > COMMON)
    hub = long.groupBy("v").agg(F.min(F.struct("r", "d", "n")).alias("hub"))
    stars = (long.join(hub, "v").where(F.col("d") != F.col("hub.d"))
             .where(_bound(F.col("n"), F.col("r"), F.col("hub.n"), F.col("hub.r"), link))
             .select(F.least("d", "hub.d").alias("a"), F.greatest("d", "hub.d").alias("b")))
    pairs = likely.unionByName(_pairs(lists.where(F.col("g") <= COMMON))).unionByName(stars).distinct()
    links = staged(_linked(pairs, sets, link), "linked")
    labels = components(links)
    if long.isEmpty():
        return labels
    member = (long.join(labels, long.d == labels.node, "left")
              .select("v", "d", "n", "r", F.coalesce("label", "d").alias("label")))
    member = staged(member.join(hub.select("v", F.col("hub.d").alias("h")), "v"), "members")
    main = member.where("d = h").select("v", F.col("label").alias("main"))
    # a set can only reach sets with few enough rare values: its own rare count decides how many
    room = F.floor((F.col("n") - F.col("r")) * 100 / link - F.col("n") + 1e-9).cast("int")
    apart = (member.join(main, "v").where("label <> main AND d <> h").where(room >= 0)
             .select("v", F.col("d").alias("x"), F.col("n").alias("nx"), F.col("r").alias("rx"),
                     F.col("label").alias("lx"), F.explode(F.sequence(F.lit(0), room)).alias("r")))
    rest = (apart.join(member, ["v", "r"]).where("label <> lx AND d <> h")
            .where(_bound(F.col("n"), F.col("r"), F.col("nx"), F.col("rx"), link))
            .select(F.least("d", "x").alias("a"), F.greatest("d", "x").alias("b")).distinct())
    more = staged(_linked(rest, sets, link), "linked")
    return labels if more.isEmpty() else components(links.unionByName(more))


def _bound(n1: Column, r1: Column, n2: Column, r2: Column, link: int) -> Column:
    """Whether two sets that share common values only can be similar enough."""
    most = F.least(n1 - r1, n2 - r2)
    return 100 * most >= link * (n1 + n2 - most)


def _rows(docs: DataFrame, link: int) -> DataFrame:
    """(doc_id, tag, n_shingles, label, component_id) per row of ``docs`` (doc_id, text): label numbers
    the component, null without shingles; component_id is the smallest doc_id in it."""
    prepare(docs.sparkSession)
    docs = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = staged(docs.withColumn("tag", _tag()).mapInPandas(
        _sketches, "doc_id bigint, tag bigint, n_shingles bigint, digest binary, sketch array<bigint>"), "sketches")
    one = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")
    classes = staged(rows.where("n_shingles > 0").groupBy("digest").agg(
        F.min(one).alias("one"), F.max(F.struct("n_shingles", "sketch")).alias("s"))
        .select(F.monotonically_increasing_id().alias("d"), "digest", "one", F.col("s.n_shingles").alias("n"), "s.sketch"), "classes")
    labels = link_classes(classes, docs, link)
    named = (classes.select("d", "digest", F.col("one.doc_id").alias("least"))
             .join(labels.withColumnRenamed("node", "d"), "d", "left").withColumn("label", F.coalesce("label", "d")))
    linked = staged(named.join(labels.select("label").distinct(), "label", "left_semi")
                    .groupBy("label").agg(F.min("least").alias("far")), "components")
    named = (named.join(linked, "label", "left")
             .select("digest", "label", F.coalesce("far", "least").alias("component_id")))
    return (rows.drop("sketch").join(named, "digest", "left")
            .select("doc_id", "tag", "n_shingles", "label",
                    F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, link: int = LINK) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Every row stands for itself: rows that share a doc_id but not the text need not be in one
    component. component_id is null where no row of the component has a doc_id. Rows without words
    (null or empty text) have no shingles and are their own component. Other columns are ignored.
    """
    return (_rows(docs, link).select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, link: int = LINK) -> DataFrame:
    """One row of ``docs`` for each component, with its own columns: one with the smallest doc_id (a
    null one is largest), of several texts of that doc_id one, of repeated rows any. Rows without
    words all stay."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")
    keys = staged(_rows(docs, link).where("label IS NOT NULL").groupBy("label", "doc_id", "tag")
                  .agg(F.count("*").alias("times")), "rows")
    stays = keys.groupBy("label").agg(F.min(key).alias("stay"))
    special = staged(keys.join(stays, "label").withColumn("gone", key != F.col("stay")).where("gone OR times > 1")
                     .select(F.col("doc_id").alias("id"), F.col("tag").alias("t"), "gone"), "special")
    rows = carried(docs, F.col("doc_id").cast("long").alias("doc_id"), _tag().alias("tag"))
    same = rows["doc_id"].eqNullSafe(special["id"]) & (rows["tag"] == special["t"])
    out = rows.join(special, same, "left_anti").select("carried.*")
    again = special.where("NOT gone")
    if again.isEmpty():
        return out
    return out.unionByName(rows.join(again, same, "left_semi").dropDuplicates(["doc_id", "tag"]).select("carried.*"))
