"""Operator 7: near-duplicate lines through deletion neighbourhoods, natively.

A line is a ``\\n``-separated part of a text with a word in it, compared without the white space
at its ends. It goes when an earlier line (by doc_id, then place) equals it or, both having at
least ``MIN_CHARS`` code points, is within one edit (insertion, deletion or substitution).

1. Equal lines share a 128-bit hash; the earliest occurrence of each is found by partial aggregation.
2. An edit touches one of ``q`` segments, so two near lines agree on all before and after it. A
   line's context keys hash just that, for its own length and the next shorter one; only lines
   that share a context with a different line can have a neighbour, and only their texts move.
3. In a shared context each line emits its deletion variants as hashed keys. Two lines of one
   length that are one substitution apart share the variant with that place deleted; a line one
   longer deletes to the shorter line itself. So in a group of equal variants every member is
   one edit from its earliest, and a group needs no pairs: each member proposes that one.
4. ``levenshtein`` on the two texts verifies each proposal.

Segments grow in number with the root of the length, so a line of n code points costs about
n ** 1.5 steps, also where a text is one very long line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .base import carried, staged

#: From how many code points on a line may differ by one edit; shorter lines must be equal.
MIN_CHARS = 24
BLANKS = " \t\n\x0b\x0c\r"


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _place() -> Column:
    """A line's place among all, by doc_id, then position: one decimal, whose minimum a hash
    aggregate can keep; a struct's would need a sort."""
    first = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(-(1 << 63)).cast("decimal(20,0)"))
    return (first * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos")).cast("decimal(32,0)")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, pos, line): one row per line with a word; tag tells texts apart that share a doc_id."""
    return (docs.select("doc_id", F.xxhash64(_text()).alias("tag"), F.posexplode(F.split(_text(), "\n", -1)).alias("pos", "line"))
            .withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line <> ''"))


def _context(m: str, q: str, longer: int, fields: bool) -> str:
    """SQL of a line's contexts for length ``m``, which the line exceeds by ``longer``: an array of
    keys or, with ``fields``, of (k, m, lo, hi); the segment is the line's code points lo (from 0)
    to hi (exclusive)."""
    lo, hi = f"cast(s * {m} div {q} AS int)", f"cast((s + 1) * {m} div {q} AS int) + {longer}"
    key = f"xxhash64({m}, s, substring(line, 1, {lo}), substring(line, {hi} + 1))"
    value = f"struct({key} AS k, {m} AS m, {lo} AS lo, {hi} AS hi)" if fields else key
    return f"transform(sequence(0, {q} - 1), s -> {value})"


def _contexts(fields: bool) -> Column:
    """The contexts of a line (line, n, q0, q1) for its own length and, longer ones, the next shorter."""
    own, shorter = _context("n", "q0", 0, fields), _context("(n - 1)", "q1", 1, fields)
    return F.expr(f"CASE WHEN n > {MIN_CHARS} THEN concat({own}, {shorter}) WHEN n = {MIN_CHARS} THEN {own} END")


def _measured(lines: DataFrame) -> DataFrame:
    """With n, a line's length, and q0 and q1, the segments of that length and of the next shorter.
    Columns, as expressions inside a lambda are computed anew for each element."""
    q = lambda m: F.greatest(F.lit(3), F.floor(F.sqrt(m) / 8).cast("int"))
    return (lines.withColumn("n", F.length("line"))
            .withColumn("q0", q(F.col("n"))).withColumn("q1", q(F.greatest(F.lit(0), F.col("n") - 1))))


def _near(docs: DataFrame) -> DataFrame:
    """(line,): the distinct lines that an earlier line is one edit from."""
    keyed = (_measured(_lines(docs)).select("doc_id", "tag", "pos", F.hash("line").alias("h"), _contexts(False).alias("ks"))
             # the plain explode would infer filters that compute the keys again, inlined
             .select("doc_id", "tag", "pos", "h", F.explode_outer("ks").alias("k")).where("k IS NOT NULL"))
    shared = staged(keyed.groupBy("k").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
                    .where("lo <> hi").select("k"), "contexts")
    mine = (keyed.select("doc_id", "tag", "pos", "k").join(shared, "k")
            .groupBy("doc_id", "tag", "pos").agg(F.collect_set("k").alias("ks"))
            .groupBy("doc_id", "tag").agg(F.collect_list(F.struct("pos", "ks")).alias("mine"))
            .withColumnsRenamed({"doc_id": "d", "tag": "t"}))
    texts = docs.select("doc_id", F.xxhash64(_text()).alias("tag"), F.split(_text(), "\n", -1).alias("ls"))
    found = (texts.join(mine, texts["doc_id"].eqNullSafe(mine["d"]) & (texts["tag"] == mine["t"]))
             .select("doc_id", "tag", F.inline_outer(F.transform("mine", lambda x: F.struct(
                 x["pos"].alias("pos"), x["ks"].alias("ks"),
                 F.btrim(F.get("ls", x["pos"]), F.lit(BLANKS)).alias("line"))))))
    lines = staged(found.groupBy("line").agg(F.min(_place()).alias("id"), F.first("ks").alias("ks")), "near-lines")
    variants = _variants(lines)
    group = (variants.groupBy("v").agg(F.min(F.when(F.col("own"), F.col("id"))).alias("own_id"),
                                       F.min(F.when(~F.col("own"), F.col("id"))).alias("cut_id"),
                                       F.count("*").alias("c")).where("c > 1").drop("c"))
    # a longer line proposes the line it deletes to; all others the earliest that deletes to the same
    mate = F.when(F.col("longer"), F.col("own_id")).otherwise(F.col("cut_id"))
    proposals = (variants.join(group, "v").select("id", mate.alias("mate_id"))
                 .where("mate_id < id").distinct())
    mates = lines.select(F.col("id").alias("mate_id"), F.col("line").alias("mate"))
    return (proposals.join(lines.select("id", "line"), "id").join(mates, "mate_id")
            .where(F.levenshtein("line", "mate", 1) >= 0).select("line").distinct())


def _variants(lines: DataFrame) -> DataFrame:
    """(id, v, own, longer): the deletion variants of lines in their shared contexts as hashed
    keys; own marks a line that stands for itself, longer one that has length m + 1."""
    width = F.col("hi") - F.col("lo")
    seg = (_measured(lines).select("id", "line", "n", "ks", F.inline_outer(_contexts(True)))
           .where(F.array_contains("ks", F.col("k")))
           .select("id", "k", (F.col("n") > F.col("m")).alias("longer"), width.alias("width"),
                   F.substring("line", F.col("lo") + 1, width).alias("mid")))
    cut = lambda i: F.concat(F.substring("mid", F.lit(1), i), F.substring("mid", i + 2, F.col("width")))
    # of two lines of length m the place counts too: then they differ in that place alone
    cuts = F.when(F.col("width") > 0, F.transform(
        F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.struct(
            F.when(F.col("longer"), F.xxhash64("k", F.lit(-1), cut(i)))
            .otherwise(F.xxhash64("k", i, cut(i))).alias("v"), F.lit(False).alias("own"))))
    own = F.when(~F.col("longer"), F.array(F.struct(
        F.xxhash64("k", F.lit(-1), F.col("mid")).alias("v"), F.lit(True).alias("own"))))
    none = F.array().cast("array<struct<v:bigint,own:boolean>>")
    return (seg.select("id", "longer", F.inline_outer(F.concat(F.coalesce(cuts, none), F.coalesce(own, none))))
            .where("v IS NOT NULL").select("id", "v", "own", "longer"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, tag, n_lines (lines with a word) and dropped, the
    places (from 0, among all ``\\n``-separated parts) of the lines that go.

    A null or empty text has no lines. Rows with the same doc_id and text are one document; both
    get its result. Of different texts with one doc_id, equal lines at the same place count as
    one line. A null doc_id is earliest. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    near = _near(docs)
    digest = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")]  # 128 bits of two hashes
    marked = _lines(docs).select("doc_id", "tag", "pos", *digest)
    first = (marked.groupBy("h1", "h2").agg(F.min(_place()).alias("first"), F.count("*").alias("c"))
             .join(near.select(*digest, F.lit(True).alias("near")), ["h1", "h2"], "left")
             .where("c > 1 OR near").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")))
    gone = (marked.join(staged(first, "first-lines"), ["h1", "h2"])
            .where(F.col("near") | (_place() != F.col("first")))
            .groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
            .withColumnsRenamed({"doc_id": "d", "tag": "t"}))
    all_ = docs.select("doc_id", F.xxhash64(_text()).alias("tag"),
                       F.size(F.filter(F.split(_text(), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
                       .cast("long").alias("n_lines"))
    return (all_.join(gone, all_["doc_id"].eqNullSafe(gone["d"]) & (all_["tag"] == gone["t"]), "left")
            .select("doc_id", "tag", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without their dropped lines; n_chars, if there, is counted anew. A
    document that loses every line goes; one that never had a line stays."""
    cut = (staged(dropped_lines(docs), "dropped").where(F.size("dropped") > 0).distinct()
           .select(F.col("doc_id").alias("d"), F.col("tag").alias("t"), "n_lines", "dropped"))
    rows = carried(docs, F.col("doc_id"), F.col("text"))
    out = (rows.join(cut, rows["doc_id"].eqNullSafe(cut["d"]) & (F.xxhash64(_text()) == cut["t"]), "left")
           .where("dropped IS NULL OR size(dropped) < n_lines")
           .withColumn("ls", F.when(F.col("dropped").isNotNull(), F.split(_text(), "\n", -1))))
    left = F.array_except(F.sequence(F.lit(0), F.size("ls") - 1), F.col("dropped"))
    out = out.withColumn("text", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("ls", i)), "\n")))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[new.get(c, F.col("carried")[c]).alias(c) for c in docs.columns])
