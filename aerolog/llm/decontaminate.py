"""Benchmark passages in documents, by winnowing, in built-in functions.

A window is ``WINDOW`` consecutive words of a benchmark item, or the whole item if it has fewer words.
Every run of ``K`` words has a hash; of each ``WINDOW - K + 1`` consecutive hashes the smallest is kept
as a fingerprint (the last of equal ones). A shared window holds the same hashes on both sides, so the
same fingerprint is kept on both, and no shared window is missed. Fingerprints are joined. A hit is
extended: the windows that contain it are compared by their own 64-bit hashes, so a match agrees in two
independent hashes. Items of fewer words than a window have a fingerprint for their whole length, and
documents are searched for the lengths that occur (nine at most).

Items with the same window are gathered on the benchmark's side first, so a document's passage meets
each distinct window once, however many items or documents share it. The fingerprints of documents are
filtered before they are shuffled; the benchmark's side is broadcast if it is below the session's
threshold and is joined by shuffling beyond it.

Null and empty texts have no words, no windows and no hits. Repeated documents (same id and text) each
get their result; documents that share an id but not the text are told apart by the text's hash. Equal
items all count. An empty benchmark hits nothing; other columns of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolog.llm.arrays import indices, lower_ascii, split_words
from aerolog.llm.common import free_name
from aerolog.session import materialized

WINDOW, K = 10, 5
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def run_hash(hashes: Column, at: Column, n: int) -> Column:
    """The hash of n words from a place, made of their own hashes."""
    return F.xxhash64(*(F.get(hashes, at + j) for j in range(n)))


def with_hashes(texts: DataFrame, text: str, keep: list[str], short: list[int]) -> DataFrame:
    """``keep``, n_words, starts of fingerprints, hashes of K words, and of the short lengths."""
    worded = texts.select(*keep, F.transform(split_words(lower_ascii(F.col(text)), BREAKS), lambda w: F.xxhash64(w)).alias("_words"))
    runs = worded.select(*keep, F.size("_words").alias("n_words"), F.col("_words"),
                         F.transform(indices(F.size("_words") - K + 1), lambda i: run_hash(F.col("_words"), i, K)).alias("_runs"))
    w = WINDOW - K + 1
    lowest = runs.select("*", F.transform(indices(F.size("_runs") - w + 1), lambda i: F.least(
        *(F.get("_runs", i + j) for j in range(w)))).alias("_lowest"))
    # the last smallest hash of w moves on only if another value is smallest or an equal one comes in
    moved = lowest.select("*", F.filter(indices(F.size("_lowest")), lambda i: (i == 0) | (
        F.get("_lowest", i) != F.get("_lowest", i - 1)) | (F.get("_lowest", i) == F.get("_runs", i + w - 1))).alias("_moved"))
    places = F.transform("_moved", lambda i: i + w - F.array_position(
        F.reverse(F.slice("_runs", i + 1, w)), F.get("_lowest", i)).cast("int"))
    # (a lambda's parameters are the engine's, so the length comes from around it)
    all_of = lambda m: F.transform(indices(F.size("_words") - m + 1), lambda i: run_hash(F.col("_words"), i, m))
    shorts = [all_of(m).alias(f"_short{m}") for m in short]
    return moved.select(*keep, "n_words", "_runs", F.array_distinct(places).alias("_places"), *shorts)


def window_hash(runs: Column, start: Column) -> Column:
    """The hash of a whole window, from those of its first and last K words."""
    return F.xxhash64(F.get(runs, start), F.get(runs, start + WINDOW - K))


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct windows (size, hash, and the items that hold it), distinct fingerprints, short lengths."""
    ids = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("_text"))
    lengths = ids.select(F.size(split_words(lower_ascii(F.col("_text")), BREAKS)).alias("n"))
    short = sorted(r["n"] for r in lengths.where((F.col("n") > 0) & (F.col("n") < WINDOW)).distinct().collect())
    hashed = materialized(with_hashes(ids, "_text", ["item"], short))
    full = hashed.select("item", F.lit(WINDOW).alias("size"), F.explode(
        F.transform(indices(F.size("_runs") - (WINDOW - K)), lambda s: window_hash(F.col("_runs"), s))).alias("window"))
    for m in short:
        full = full.union(hashed.where(F.col("n_words") == m).select("item", F.lit(m), F.get(f"_short{m}", F.lit(0))))
    windows = materialized(full.distinct().groupBy("size", "window").agg(F.sort_array(F.collect_set("item")).alias("items")))
    prints = hashed.select(F.explode(F.transform("_places", lambda p: F.get("_runs", p))).alias("print")).distinct()
    return windows, materialized(prints), short


def hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its key, n_words, n_hit, items (sorted ids) and text_hash."""
    windows, prints, short = item_windows(items)
    own = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    hashed = with_hashes(own, "_text", ["_key", "_hash"], short)
    # fingerprints with the hashes of runs around them, of which the windows of known ones are made;
    # one row without any stands for the document
    w = WINDOW - K + 1
    first, last = (lambda p: F.greatest(p - w + 1, F.lit(0))), (lambda p: F.least(p, F.size("_runs") - w))
    marks = F.transform("_places", lambda p: F.struct(
        F.get("_runs", p).alias("print"), F.lit(WINDOW).alias("size"), first(p).alias("first"),
        F.slice("_runs", first(p) + 1, last(p) - first(p) + w).alias("around")))
    alone = F.array(F.struct(F.lit(None).cast("long").alias("print"), F.lit(0).alias("size"), F.lit(0).alias("first"),
                             F.array().cast("array<bigint>").alias("around")))
    whole = lambda m: F.transform(f"_short{m}", lambda h, i: F.struct(
        F.lit(None).cast("long").alias("print"), F.lit(m).alias("size"), i.alias("first"), F.array(h).alias("around")))
    found = [whole(m) for m in short]
    exploded = hashed.select("_key", "_hash", "n_words", F.explode(F.concat(alone, marks, *found)).alias("m")).select(
        "_key", "_hash", "n_words", "m.*")
    near = F.when(F.col("size") == WINDOW, F.transform(indices(F.size("around") - (WINDOW - K)), lambda s: F.struct(
        (F.col("first") + s).alias("start"), window_hash(F.col("around"), s).alias("window")))).otherwise(
            F.transform("around", lambda h: F.struct(F.col("first").alias("start"), h.alias("window"))))
    # a null fingerprint marks the document's own row (size 0) and short runs, which are windows already
    kept = (exploded.join(prints.withColumn("_known", F.lit(True)), "print", "left")
            .where(F.col("print").isNull() | F.col("_known"))
            .select("_key", "_hash", "n_words", "size", F.explode_outer(near).alias("near"))
            .select("_key", "_hash", "n_words", "size", "near.start", "near.window"))
    matched = (kept.join(windows, ["size", "window"], "left").where((F.col("size") == 0) | F.col("items").isNotNull())
               .groupBy("_key", "_hash").agg(
                   F.max("n_words").alias("n_words"),
                   F.collect_set(F.when(F.col("size") > 0, F.struct("start", "size"))).alias("_spans"),
                   F.collect_set("items").alias("_items"),
                   F.count(F.when(F.col("size") == 0, 1)).alias("_copies")))
    # spans in order: each adds the words behind the farthest end so far
    ordered = matched.withColumn("_spans", F.sort_array("_spans"))
    covered = F.aggregate("_spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(a["end"], s["start"]))).alias("n"),
        F.greatest(a["end"], s["start"] + s["size"]).alias("end")))["n"]
    return ordered.select(
        F.col("_key").alias(key), F.col("_hash").alias("text_hash"), F.col("n_words").cast("long").alias("n_words"),
        covered.cast("long").alias("n_hit"), F.sort_array(F.array_distinct(F.flatten("_items"))).alias("items"),
        F.explode(F.expr("sequence(1, cast(_copies as int))")).alias("_copy")).drop("_copy")


def without_hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    bad = hits(docs, items, key, text).where("n_hit > 0").select(F.col(key).alias("_key"), "text_hash").distinct()
    own, own_hash = free_name(docs, "_bad_key"), free_name(docs, "_bad_hash")
    bad = bad.toDF(own, own_hash)
    return docs.join(bad, F.col(key).eqNullSafe(F.col(own)) & (F.xxhash64(text) == F.col(own_hash)), "left_anti")
