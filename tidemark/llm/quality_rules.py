"""Operator 2: quality rules whose cutoffs come with a risk guarantee.

Each rule compares one ratio of a document with a cutoff. Labelled good documents of a stratum
(its language) are the holdout: a cutoff is admissible when the exact binomial test rejects, at
level ``delta / (rules * strata)``, that it turns away more than ``alpha / rules`` of the good
documents; that is the Clopper-Pearson upper bound staying under ``alpha / rules``. A rule's
cutoffs are tested from lenient to strict and testing stops at the first failure (fixed-sequence
testing), so the grid costs no level; rules and strata share the level by Bonferroni. Of the
admissible cutoffs the one that turns away most labelled bad documents is taken, the most lenient
among equals. With too few labels nothing is admissible and the rule stays off.

Everything is DataFrame expressions; a text never leaves its row, so no text is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import only, staged, words

#: Cutoff grids from lenient to strict; a document fails a rule above the cutoff.
GRID = {
    "symbol_ratio": [2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1],
    "upper_ratio": [0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25],
    "dup_line_ratio": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4],
    "repeat_ratio": [0.5, 0.475, 0.45, 0.425, 0.4, 0.375, 0.35, 0.325],
    "mean_word_chars": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0],
}
ALPHA, DELTA = 0.05, 0.1
#: Fixed values of the base rule: fewest words, and the largest share of repeated words in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]
BLANKS = " \t\n\x0b\x0c\r"


def _neighbour_equal(key, j: Column) -> Column:
    """In a sorted array, whether element ``j`` equals the one before or after it."""
    return F.coalesce(key(j) == key(j - 1), F.lit(False)) | F.coalesce(key(j) == key(j + 1), F.lit(False))


def measure(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """Counts of each row of ``docs`` (doc_id, text, lang): doc_id, lang and :data:`COUNTS`.

    A null or empty text has no words and no lines. Repeated rows are each measured; other
    columns are ignored unless ``carry`` (kept as ``carried``) names them. A repeated 3-word
    window is found in two steps: 32 bits of its hash above its position make primitive longs
    that sort fast, and only windows whose bits repeat are then compared as text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    w, n = F.col("_w"), F.size("_w")
    kept = ["doc_id", "lang"] + (["carried"] if carry is not None else [])
    base = docs.select(F.col("doc_id"), F.col("lang"), *([carry.alias("carried")] if carry is not None else []),
                       text.alias("_t"), words(F.col("text")).alias("_w"))
    hashed = base.select(
        *kept, "_w",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_t", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("_l"),
        F.when(n >= 4, F.sort_array(F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), 32)
            .bitwiseOR(i.cast("long"))))).alias("_p"))
    bits = lambda j: F.shiftright(F.get("_p", j), 32)
    at = lambda j: F.get("_p", j).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    suspects = hashed.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_upper",
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_p") >= 2, F.sort_array(F.transform(
            F.filter(F.sequence(F.lit(0), F.size("_p") - 1), lambda j: _neighbour_equal(bits, j)),
            lambda j: F.struct(
                F.concat_ws(" ", F.get(w, at(j)), F.get(w, at(j) + 1), F.get(w, at(j) + 2)).alias("g"),
                at(j).alias("at"))))).alias("_c"))
    gram = lambda j: F.get("_c", j)["g"]
    found = suspects.withColumn("_at", F.when(F.size("_c") >= 2, F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("_c") - 1), lambda j: _neighbour_equal(gram, j)),
        lambda j: F.get("_c", j)["at"]))))
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size("_at") - 1), F.lit(0).cast("long"),
        lambda acc, j: acc + F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - F.get("_at", j), F.lit(3))).cast("long"))
    return (found.withColumn("n_repeat_words", F.when(F.size("_at") >= 1, covered).otherwise(F.lit(0).cast("long")))
            .select(*kept, *COUNTS))


def ratios() -> dict[str, Column]:
    """The ratio each rule tests, of a row of counts."""
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "symbol_ratio": per("n_symbols", "n_words"),
        "upper_ratio": per("n_upper", "word_chars"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "repeat_ratio": per("n_repeat_words", "n_words"),
        "mean_word_chars": per("word_chars", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def stratum() -> Column:
    """A document's stratum: its language, null being one of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("none"))


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1, by Stirling's series at x + 8."""
    z, shift = x + 8, F.lit(1.0)
    for i in range(8):
        shift = shift * (x + i)
    return ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
            + 1 / (1260 * z * z * z * z * z) - F.log(shift))


def log_binomial_tail(n: Column, k: Column, p: float) -> Column:
    """ln P(X <= k) for X binomial (n, p) and k < n * p: the largest term times the sum of the
    falling ratios below it."""
    n, k = n.cast("double"), k.cast("long")
    kd = k.cast("double")
    term = (_log_gamma(n + 1) - _log_gamma(kd + 1) - _log_gamma(n - kd + 1)
            + kd * math.log(p) + (n - kd) * math.log1p(-p))
    step = lambda acc, i: F.struct(
        (acc["t"] * i * ((1 - p) / p) / (n - i + 1)).alias("t"),
        (acc["s"] + acc["t"] * i * ((1 - p) / p) / (n - i + 1)).alias("s"))
    total = F.aggregate(F.sequence(k, F.lit(1).cast("long"), F.lit(-1).cast("long")),
                        F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")), step, lambda acc: acc["s"])
    return term + F.log(F.when(k > 0, total).otherwise(F.lit(1.0)))


def fit(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
        grid: dict[str, list[float]] | None = None) -> DataFrame:
    """The certified cutoffs: one row per stratum, a column per rule, null where a rule is off.

    ``labels`` (doc_id, quality) may hold nulls and repeats: a document with a bad label counts
    as bad, one without a usable label is left out. Documents that fail the base rule are out.
    """
    grid = GRID if grid is None else grid
    truth = (only(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy("doc_id").agg(F.min("quality").alias("good")))
    rows = (measured.where(~base_failed()).select("doc_id", stratum().alias("stratum"),
                                                  *[c.alias(r) for r, c in ratios().items()])
            .join(truth, "doc_id"))
    fails = [(r, i, c) for r, cs in grid.items() for i, c in enumerate(cs)]
    counted = rows.groupBy("stratum").agg(
        F.sum(F.col("good")).cast("long").alias("n"),
        *[F.count(F.when((F.col(r) > c) & (F.col("good") == g), 1)).alias(f"{'bk'[g]}_{r}_{i}")
          for r, i, c in fails for g in (0, 1)])
    tests = counted.select(
        "stratum", "n", F.inline(F.array(*[F.struct(
            F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
            F.col(f"k_{r}_{i}").alias("k"), F.col(f"b_{r}_{i}").alias("bad")) for r, i, c in fails])))
    share = alpha / len(grid)
    level = F.log(F.lit(delta / len(grid)) / F.count(F.when((F.col("step") == 0) & (F.col("rule") == next(iter(grid))), 1))
                  .over(Window.partitionBy(F.lit(0))))
    steps = Window.partitionBy("stratum", "rule").orderBy("step")
    passed = F.when(F.col("k") < F.col("n") * share,
                    log_binomial_tail(F.col("n"), F.col("k"), share) <= F.col("level")).otherwise(F.lit(False))
    ok = (tests.withColumn("level", level).withColumn("passed", passed)
          .withColumn("passed", F.min("passed").over(steps)))
    best = (ok.where("passed AND bad > 0").groupBy("stratum", "rule")
            .agg(F.max_by("cutoff", F.struct("bad", (-F.col("step")).alias("s"))).alias("cutoff")))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}")
                                         for r in grid])


def verdicts(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with base_failed and kept. A stratum without cutoffs keeps what the base rule keeps."""
    rules = [c[4:] for c in cutoffs.columns if c.startswith("cut_")]
    value = ratios()
    failed = F.lit(False)
    for r in rules:
        failed = failed | F.coalesce(value[r] > F.col(f"cut_{r}"), F.lit(False))
    return (measured.withColumn("stratum", stratum()).join(cutoffs, "stratum", "left")
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~failed).drop("stratum", *[f"cut_{r}" for r in rules]))


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Every row of ``docs`` with its counts, base_failed and kept."""
    measured = staged(measure(docs), "quality-counts")
    return verdicts(measured, staged(fit(measured, labels, alpha, delta), "quality-cutoffs"))


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns; rows are written once with their
    counts, so texts are measured once and never shuffled."""
    measured = staged(measure(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns])), "quality-docs")
    cutoffs = staged(fit(measured.drop("carried"), labels, alpha, delta), "quality-cutoffs")
    return verdicts(measured, cutoffs).where("kept").select("carried.*")
