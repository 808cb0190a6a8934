"""Quality rules whose thresholds carry a guarantee, in built-in functions.

Rules compare a measure of the text with a cutoff of the text's stratum (its length class). Cutoffs come
from labelled holdouts: in each stratum and for each rule, cutoffs are tried from the mildest to the
strictest, and the strictest is taken for which all so far pass an exact binomial test. The test of a
cutoff says that it rejects at most ``RISK`` / rules of the good texts of the stratum, and errs with
probability ``ERROR`` / (rules * strata) at most: cutoffs of a rule are tried in a fixed order, which
needs no correction, and rules and strata share the error (Bonferroni). So with probability 1 - ``ERROR``
all strata together lose at most ``RISK`` of their good texts to the rules. A rule without a cutoff that
passes rejects nothing.

A binomial test counts independent trials, which copies are not. So texts with the same least hash of their
``SPAN``-word windows, equal texts and most near copies, are one trial: the one with the least measures, good if
all of them are. A text that fills a third of the holdout weighs as much as one that occurs once.

Only the counts of each stratum, rule and cutoff go to the driver: a fixed number.

Null and empty texts have no words and fail the base rule. Labels that are null or of absent rows are
left out; labels that contradict each other count as the lower one. Ties, repeated rows and
other columns change nothing; without labels no rule rejects.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolog.llm.arrays import indices, split_words
from aerolog.session import materialized

RISK, ERROR = 0.05, 0.05
SPACE = r"[\x20\x09-\x0D]+"
SPAN = 5
#: Upper ends of the length classes, in words; texts beyond the last are a class of their own.
STRATA = (40, 160, 640)
#: Cutoffs of each rule, from mild to strict. A text whose measure is at or above one is rejected.
CUTOFFS = {
    "symbols": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05),
    "shouting": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05),
    "duplicates": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "repeats": (0.18, 0.15, 0.1, 0.05, 0.02),
}


def base_measures(texts: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals, n_lines, and _least, the least hash of a window."""
    value = F.coalesce(F.col(text), F.lit(""))
    worded = texts.select(
        *keep, split_words(value, SPACE).alias("_words"),
        F.length(F.regexp_replace(value, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.length(F.regexp_replace(value, r"\P{Lu}+", "")).alias("n_capitals"),
        F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    counted = worded.select(
        *keep, "n_symbols", "n_capitals", F.size("_words").alias("n_words"), F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        (F.length(F.concat_ws(" ", "_words")) - F.greatest(F.size("_words") - 1, F.lit(0))).alias("word_chars"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    spans = counted.select(*counted.columns[:-1], F.transform(
        indices(F.size("_hashes") - SPAN + 1), lambda i: F.xxhash64(*(F.get("_hashes", i + j) for j in range(SPAN)))).alias("_spans"))
    flagged = spans.withColumn("_clear", F.size(F.array_distinct("_spans")) == F.size("_spans"))
    # only texts with a repeated window sort theirs; equal windows then stand side by side
    ordered = flagged.withColumn("_sorted", F.when(~F.col("_clear"), F.array_sort(
        F.transform("_spans", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    n = F.size("_sorted")
    twice = ordered.withColumn("_again", F.when(~F.col("_clear"), F.sort_array(F.transform(
        F.filter(indices(n), lambda k: (F.get("_sorted", k)["h"] == F.get("_sorted", k - 1)["h"]) | (F.get("_sorted", k)["h"] == F.get("_sorted", k + 1)["h"])),
        lambda k: F.get("_sorted", k)["i"]))))
    covered = F.aggregate("_again", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, i: F.struct(
        (a["n"] + F.lit(SPAN) - F.greatest(F.lit(0), F.least(F.lit(SPAN), a["end"] - i))).alias("n"), (i + SPAN).alias("end")))["n"]
    return twice.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        F.when(F.col("_clear"), 0).otherwise(covered).alias("n_repeat_words"), "n_capitals", "n_lines",
                        F.array_min("_spans").alias("_least"))


def measures() -> dict[str, Column]:
    """The measure of each rule."""
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    return {"symbols": share("n_symbols", "n_words"), "shouting": share("n_capitals", "word_chars"),
            "duplicates": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words")}


def stratum() -> Column:
    return reduce(lambda c, k: F.when(F.col("n_words") < STRATA[k], k).otherwise(c), reversed(range(len(STRATA))), F.lit(len(STRATA)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def tail(k: int, n: int, p: float) -> float:
    """The probability of at most k rejections of n when each has probability p."""
    if k >= n:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term, total = 1.0, 1.0
    for i in range(k, 0, -1):  # each term from the one above; far below the mean they vanish fast
        term *= i / (n - i + 1) * (1 - p) / p
        total += term
        if k < n * p and term < 1e-17 * total:
            break
    return min(1.0, math.exp(min(0.0, log + math.log(total)))) if k < n * p else 1.0


def trials(holdout: DataFrame) -> DataFrame:
    """One row for each group of copies. ``holdout`` has the measures, _least and good."""
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines"]
    # partial aggregation first: a text that occurs often leaves each task once
    return holdout.groupBy("_least").agg(F.min(F.struct("good", *columns)).alias("_one")).select("_one.*")


def cutoffs(holdout: DataFrame, risk: float = RISK, error: float = ERROR) -> dict[tuple[int, str], float]:
    """The strictest safe cutoff of each stratum and rule. ``holdout`` has the measures and good (0 or 1)."""
    columns = [F.sum((m >= c).cast("long")).alias(f"{rule}_{k}") for rule, m in measures().items() for k, c in enumerate(CUTOFFS[rule])]
    counts = holdout.where("good = 1").withColumn("_stratum", stratum()).groupBy("_stratum").agg(F.count("*").alias("_n"), *columns).collect()
    each, alpha = risk / len(CUTOFFS), error / (len(CUTOFFS) * (len(STRATA) + 1))
    chosen = {}
    for row in counts:
        for rule, values in CUTOFFS.items():
            for k, cutoff in enumerate(values):
                if tail(row[f"{rule}_{k}"], row["_n"], each) > alpha:
                    break
                chosen[row["_stratum"], rule] = cutoff
    return chosen


def rejected(chosen: dict[tuple[int, str], float]) -> Column:
    """Whether any rule of the text's stratum rejects it."""
    tests = [(stratum() == s) & (measures()[rule] >= cutoff) for (s, rule), cutoff in sorted(chosen.items())]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row for each document: key, base measures, base_failed and kept."""
    good = (labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("good")).dropna()
            .groupBy("_id").agg(F.min("good").alias("good")))
    own = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    # written, as two readers need the measures and the texts are read once
    out = materialized(base_measures(own, ["_id"], "_text").withColumn("_failed", base_failed()))
    # texts that pass the base rule are those that the guarantee speaks of
    chosen = cutoffs(trials(out.where(~F.col("_failed")).join(good, "_id")))
    return out.select(
        F.col("_id").alias(key), *(F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.col("_failed").alias("base_failed"), (~F.col("_failed") & ~rejected(chosen)).alias("kept"))
