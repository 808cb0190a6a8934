"""Near copies by MinHash bands and odd sketches, confirmed on full shingle sets.

A document's set is that of its distinct runs of ``SHINGLE`` words. Equal sets form one class, which goes
on as one record. ``SAMPLES`` minima of its hashes give ``BANDS`` band keys of ``ROWS`` minima each, and an
odd sketch: every sample flips one of ``BITS`` bits, so the bits in which two sketches differ (their XOR's
population count) estimate a high similarity. Records that share a band key are candidates; the sketch
dismisses those far below the threshold; the sets of the rest are compared in full.

At similarity 0.75 a pair shares no band with probability 6e-6, and the sketch's bound lies five
standard deviations below; higher similarities are safer still. Hashes have 64 bits.

Null and empty texts have an empty set and are linked with nothing. A document without an id is linked
with nothing, has no component and isn't kept. Rows with one id are one document: they share its
component, and are all kept or all dropped. Equal texts are one class; the smallest id stays. An empty
table gives an empty result; other columns of the input are kept by ``without_copies``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolog.llm.common import free_name, pieces, ready_for_python, small, small_batches, utf8
from aerolog.llm.links import crowded, linked_groups
from aerolog.llm.words import SPACED, byte_codes, hashes, mix, rows_of, spans
from aerolog.session import materialized

SHINGLE = 5
THRESHOLD = 75
SAMPLES, BANDS, ROWS = 256, 32, 4
BITS = 1024
#: The similarity that a sketch must at least estimate.
ESTIMATE = 0.56
#: Bits in which two sketches of that similarity are expected to differ.
MOST_BITS = int(BITS / 2 * (1 - math.exp(-4 * SAMPLES / BITS * (1 - ESTIMATE))))

SIGNATURE = "struct<n:bigint,h1:bigint,h2:bigint,keys:array<bigint>,sketch:array<bigint>>"
_draw = np.random.default_rng(5)
MASKS = _draw.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
FACTORS = _draw.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)


def shingles(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, by row and hash. Rows with fewer words have one of them all."""
    begins, ends = spans(data, places, SPACED)
    words, rows = hashes(data, begins, ends, byte_codes()), rows_of(begins, places)
    n = len(places) - 1
    count = np.bincount(rows, minlength=n)
    first = np.cumsum(count) - count
    whole = max(0, len(words) - SHINGLE + 1)
    total = np.zeros(whole, np.uint64)
    for k in range(SHINGLE):
        total = mix(total + words[k:whole + k])
    inside = rows[:whole] == rows[SHINGLE - 1:] if whole else np.zeros(0, bool)
    found_rows, found = [rows[:whole][inside]], [total[inside]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(count == size)
        h = np.full(len(short), np.uint64(size))
        for k in range(size):
            h = mix(h + words[first[short] + k])
        found_rows.append(short)
        found.append(h)
    rows, found = np.concatenate(found_rows), np.concatenate(found)
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
    return rows[fresh], found[fresh]


def signatures(column: pa.Array) -> pa.StructArray:
    """Size, two sums of the set, band keys and odd sketch of each row; nothing of the last two if empty."""
    data, places = utf8(column)
    size = np.zeros(len(column), np.int64)
    sums = np.zeros((2, len(column)), np.uint64)
    keys = np.zeros((len(column), BANDS), np.uint64)
    sketch = np.zeros((len(column), BITS // 64), np.uint64)
    for i, j in pieces(places):
        rows, found = shingles(data[places[i]:places[j]], places[i:j + 1] - places[i])
        if not len(rows):
            continue
        starts = np.flatnonzero(np.insert(rows[1:] != rows[:-1], 0, True))
        at = i + rows[starts]
        size[at] = np.diff(np.append(starts, len(rows)))
        sums[0, at] = np.add.reduceat(mix(found), starts)
        sums[1, at] = np.add.reduceat(mix(found ^ np.uint64(0x5851F42D4C957F2D)), starts)
        low = (mix(found) >> np.uint64(32)).astype(np.uint32)
        least = np.empty((len(starts), SAMPLES), np.uint64)
        for k in range(SAMPLES):
            least[:, k] = np.minimum.reduceat((low ^ MASKS[k]) * FACTORS[k], starts)
        for b in range(BANDS):
            key = np.full(len(starts), np.uint64(b + 1))
            for k in range(b * ROWS, (b + 1) * ROWS):
                key = mix(key + least[:, k])
            keys[at, b] = key
        bit = (mix(least + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)))) % np.uint64(BITS)
        flips = np.bincount((np.arange(len(starts))[:, None] * BITS + bit.astype(np.int64)).ravel(), minlength=len(starts) * BITS) & 1
        sketch[at] = np.packbits(flips.astype(np.uint8).reshape(len(starts), BITS), axis=1, bitorder="little").view("<u8")
    some = size > 0
    part = lambda table: pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(some * table.shape[1])]), pa.int32()), pa.array(table[some].ravel().view(np.int64)))
    return pa.StructArray.from_arrays([pa.array(size), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), part(keys), part(sketch)],
                                      ["n", "h1", "h2", "keys", "sketch"])


def differing_bits(a: Column, b: Column) -> Column:
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(1, BITS // 64)),
               F.bit_count(F.get(a, F.lit(0)).bitwiseXOR(F.get(b, F.lit(0)))))


def near(a: Column, b: Column) -> Column:
    return differing_bits(a, b) <= MOST_BITS


def whole_set(text: Column) -> Column:
    """All shingle hashes of a text."""
    @F.arrow_udf("array<bigint>")
    def sets(texts: pa.Array) -> pa.Array:
        data, places = utf8(texts)
        out, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for i, j in pieces(places):
            rows, found = shingles(data[places[i]:places[j]], places[i:j + 1] - places[i])
            out.append(found)
            ends.append(ends[-1][-1] + np.searchsorted(rows, np.arange(1, j - i + 1)))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate(out).view(np.int64)))

    return sets(text)


def similar(a: Column, b: Column) -> Column:
    """Whether two whole sets reach the threshold."""
    fits = 100 * F.least(F.size(a), F.size(b)) >= THRESHOLD * F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(fits, 100 * shared >= THRESHOLD * (F.size(a) + F.size(b) - shared)).otherwise(False)


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its key, n_shingles, component_id and kept."""
    ready_for_python(docs.sparkSession)

    @F.arrow_udf(SIGNATURE)
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in small(batches):
            yield signatures(texts)

    own = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    with small_batches(docs.sparkSession):
        signs = materialized(own.select("id", signed("text").alias("s")).select("id", "s.*"))
    sets = signs.where("n > 0 and id is not null")
    classes = materialized(sets.groupBy("n", "h1", "h2").agg(F.min("id").alias("first")))
    # a class is stood for by its smallest document
    records = sets.join(classes.select("n", "h1", "h2", F.col("first").alias("id")), ["n", "h1", "h2", "id"], "left_semi")
    members = crowded(records.select(F.explode("keys").alias("bucket"), "id"))
    wanted = members.select("id").distinct()
    heavy = own.where("id is not null").join(wanted, "id", "left_semi").select("id", whole_set(F.col("text")).alias("heavy"))
    facts = materialized(sets.join(wanted, "id", "left_semi").select("id", F.col("sketch").alias("light"))
                         .dropDuplicates(["id"]).join(heavy.dropDuplicates(["id"]), "id"))
    groups = linked_groups(members, facts, near, similar)
    grouped = classes.join(groups.withColumnRenamed("id", "first"), "first", "left").select(
        "n", "h1", "h2", F.coalesce("group", "first").alias("component"))
    found = signs.join(grouped, ["n", "h1", "h2"], "left")
    # an empty set is its own component
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document stays: one of each component, and those without an id."""
    dropped = near_copies(docs, key, text).where(F.col(key).isNotNull() & ~F.col("kept")).select(key).distinct()
    return docs.join(dropped, key, "left_anti")
