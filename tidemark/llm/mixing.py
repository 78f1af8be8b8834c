"""Operator 5: mixing sources to target weights by a low-discrepancy schedule.

Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all words; no target
exceeds three times its source, the excess goes to the others by weight. Each source's documents,
in hash order, form a stream that is cut into blocks of ``BLOCK`` words (the last is shorter).
Golden-ratio points, mapped through the cumulative targets, give the source of each slot; a
source's r-th slot takes its block r modulo the number of blocks, until its target is reached,
which cuts the last block taken. So the sources are interleaved evenly at every length of the
schedule, and a source's taken words are its target rounded to a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import carried, prepare, staged, words

#: Words of a block; weights by rank of the source; most passes over a source.
BLOCK, WEIGHTS, MOST = 1024, (1, 2, 3), 3
#: Cells of the unit interval that points and sources are joined by, slots and hash ranges
#: whose counts are summed before ranks and offsets within them.
CELLS, CHUNK_BITS = 4096, 12


def _key(source: Column) -> Column:
    """A source as a join key, null being one of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(key, source_size, target) of the sources (key, source, source_size).

    Water filling in one pass: in ascending order of ``most * size / weight`` the capped sources
    come first; the rest share what remains by weight.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sources.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    up = everything.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    cap = most * F.col("source_size")
    level = ((F.col("total") - F.col("below")) / (F.col("weights") - F.col("weights_below")))
    rows = (ranked.withColumn("weight", weight).withColumn("ratio", cap / F.col("weight"))
            .withColumn("total", F.sum("source_size").over(everything))
            .withColumn("weights", F.sum("weight").over(everything))
            .withColumn("below", F.coalesce(F.sum(cap).over(up), F.lit(0)))
            .withColumn("weights_below", F.coalesce(F.sum("weight").over(up), F.lit(0)))
            .withColumn("free", level <= F.col("ratio")))
    first = F.min(F.when(F.col("free"), F.struct("ratio", "rank", "below", "weights_below"))).over(everything)
    share = ((F.col("total") - F.col("at.below")) * F.col("weight") / (F.col("weights") - F.col("at.weights_below")))
    return (rows.withColumn("at", first)
            .select("key", "source_size", F.least(cap.cast("double"), F.coalesce(share, cap.cast("double"))).alias("target")))


def streams(docs: DataFrame, seed: int = 5) -> DataFrame:
    """(doc_id, tag, key, size, row, start): every document's place in its source's shuffled
    stream; sums over hash ranges come first, so no source is ordered in one task."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", "source", _key(F.col("source")).alias("key"), F.xxhash64(text).alias("tag"),
                        F.size(words(F.col("text"))).cast("long").alias("size"))
    sized = sized.withColumn("h", F.xxhash64("doc_id", "tag", F.lit(seed)))
    sized = staged(sized.withColumn("chunk", F.shiftright("h", 64 - CHUNK_BITS)), "sizes")
    before = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sized.groupBy("key", "chunk").agg(F.sum("size").alias("s"))
            .select("key", "chunk", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("key", "chunk").orderBy("h", "doc_id", "size")
    placed = (sized.withColumn("row", F.row_number().over(inside))
              .withColumn("within", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    return (placed.join(sums, ["key", "chunk"])
            .select("doc_id", "tag", "source", "key", "chunk", "row", "size", (F.col("base") + F.col("within")).alias("start")))


def schedule(quotas: DataFrame, slots: int, block: int = BLOCK) -> DataFrame:
    """(slot, key, block, words): the slots of the mix in order. ``quotas`` holds key, source_size,
    quota (words to take), need (slots for them) and the source's range lo to hi in [0, 1).

    Slots that a source gets beyond its need are left out; a source that the points left short by
    a slot or two takes them at the end.
    """
    spark = quotas.sparkSession
    golden = 0.6180339887498949
    j = F.col("slot")
    # the product in two parts keeps its fraction exact to ten digits at 10^10 slots
    high, low = F.shiftright(j, 20), j.bitwiseAND(F.lit((1 << 20) - 1))
    turn = (high * ((golden * (1 << 20)) % 1.0) + low * golden + 0.5 * golden)
    points = (spark.range(slots).withColumnRenamed("id", "slot").withColumn("u", turn - F.floor(turn))
              .withColumn("cell", F.floor(F.col("u") * CELLS)))
    ranges = quotas.where("need > 0").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.least(F.lit(CELLS - 1), F.floor(F.col("hi") * CELLS)))))
    hits = staged(points.join(ranges, "cell").where("u >= lo AND u < hi")
                  .select("slot", "key", F.shiftright("slot", 16).alias("chunk")), "slots")
    before = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = (hits.groupBy("key", "chunk").agg(F.count("*").alias("c"))
              .select("key", "chunk", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base")))
    ranked = (hits.withColumn("n", F.row_number().over(Window.partitionBy("key", "chunk").orderBy("slot")) - 1)
              .join(counts, ["key", "chunk"]).select("slot", "key", (F.col("base") + F.col("n")).alias("rank")))
    got = hits.groupBy("key").agg(F.count("*").alias("got"))
    late = (quotas.join(got, "key", "left").withColumn("got", F.coalesce("got", F.lit(0)))
            .where("got < need").select(F.lit(slots).cast("long").alias("slot"), "key",
                                        F.explode(F.expr("sequence(got, need - 1)")).alias("rank")))
    blocks = F.ceil(F.col("source_size") / block)
    turns = F.floor(F.col("rank") / blocks)
    at = F.col("rank") - turns * blocks
    done = turns * F.col("source_size") + at * block
    left = F.least(F.lit(block), F.col("source_size") - at * block, F.col("quota") - done)
    return (ranked.unionByName(late).join(quotas, "key").where("rank < need")
            .select("slot", "key", "rank", at.cast("long").alias("block"), left.cast("long").alias("words")))


def mix(docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, tag, size, source_size, target, taken and
    passes (how often the mix takes its first word; 1 for a document without words).

    A null or empty text has size 0 and gives nothing; a null source is a source of its own; an
    empty table gives no rows. Repeated rows are separate documents. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    placed = staged(streams(docs), "streams")
    sources = placed.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy("key")
    quota = F.least(F.round("target").cast("long"), most * F.col("source_size"))
    part = F.col("quota") - F.floor(F.col("quota") / F.col("source_size")) * F.col("source_size")
    need = F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size")) * F.ceil(F.col("source_size") / block)
                  + F.ceil(part / block)).otherwise(F.lit(0)).cast("long")
    quotas = staged(
        targets(sources, weights, most).withColumn("quota", quota).withColumn("need", need)
        .withColumn("hi", F.sum("need").over(order) / F.greatest(F.lit(1), F.sum("need").over(Window.partitionBy(F.lit(0)))))
        .withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0))), "quotas")
    slots = quotas.agg(F.coalesce(F.sum("need"), F.lit(0)).alias("n")).first()["n"]
    used = (schedule(quotas, slots, block).groupBy("key", "block")
            .agg(F.max("words").alias("whole"), F.min("words").alias("cut"), F.count("*").alias("times")))
    touched = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    pieces = (placed.where("size > 0").withColumn("block", F.explode(touched))
              .withColumn("from", F.greatest(F.lit(0), F.col("start") - F.col("block") * block))
              .withColumn("to", F.least(F.lit(block), F.col("start") + F.col("size") - F.col("block") * block)))
    length = F.col("to") - F.col("from")
    in_cut = F.greatest(F.lit(0), F.least("cut", "to") - F.col("from"))
    rows = ["doc_id", "tag", "key", "chunk", "row", "size", "start"]
    met = (pieces.join(used, ["key", "block"], "left")
           .withColumn("t", F.coalesce(F.when(F.col("cut") < F.col("whole"), (F.col("times") - 1) * length + in_cut)
                                       .otherwise(F.col("times") * in_cut), F.lit(0)))
           .withColumn("p", F.when(F.col("start") >= F.col("block") * block, F.coalesce(
               F.when(F.col("cut") < F.col("whole"), F.col("times") - F.when(F.col("from") >= F.col("cut"), 1).otherwise(0))
               .otherwise(F.when(F.col("from") < F.col("cut"), F.col("times")).otherwise(F.lit(0))), F.lit(0)))))
    taken = met.groupBy(*rows).agg(F.sum("t").cast("long").alias("taken"), F.max("p").cast("long").alias("passes"))
    empty = placed.where("size = 0").select(*rows, F.lit(0).cast("long").alias("taken"), F.lit(1).cast("long").alias("passes"))
    return (taken.unionByName(empty).join(quotas.select("key", "source_size", "target"), "key")
            .select("doc_id", "tag", "size", "source_size", "target", "taken", "passes"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with their own columns, each as often as its first word is taken.
    Rows with one doc_id and text are one document here; their passes add up."""
    passes = (mix(docs).groupBy("doc_id", "tag").agg(F.sum("passes").alias("passes")).where("passes > 0")
              .withColumnsRenamed({"doc_id": "d", "tag": "t"}))
    rows = (carried(docs, F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tag"))
            .dropDuplicates(["doc_id", "tag"]))
    return (rows.join(passes, rows["doc_id"].eqNullSafe(passes["d"]) & (rows["tag"] == passes["t"]))
            .select("carried", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes")))).select("carried.*"))
