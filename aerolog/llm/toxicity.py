"""Toxicity by FTRL-proximal logistic regression over hashed words, bigrams and skip-grams.

Features are the distinct words, pairs of neighbours and pairs with one word between them, hashed into
``2 ** BITS`` places. Every coordinate has a learning rate of its own, and the L1 term leaves most
weights at zero, so the model is small enough to send to every task (``2 ** BITS`` floats at most).

The model is fitted on the driver to a bounded sample: of each label at most ``SAMPLE`` rows, by the
hash of their id, of texts of at most ``SAMPLE_BYTES``; both labels weigh the same there, and the bias
is moved to the share of labels among all labelled rows, so that scores mean the same whatever the size.
Scoring reads every whole text.

Null and empty texts have no features and get the score of the bias alone. Labels that are null, or of
rows that aren't there, are left out; of a label that occurs twice one row is used. Without labels of
both kinds every score is 0.5. Ties can't arise; other columns are kept; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolog.llm.common import free_name, pieces, ready_for_python, small, utf8
from aerolog.llm.words import ALNUM, byte_codes, hashes, mix, rows_of, spans

BITS = 18
SAMPLE = 4000
SAMPLE_BYTES = 16_384
EPOCHS = 5
#: Rate, smoothing, L1 and L2 of the FTRL-proximal updates.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 1.0
NEIGHBOUR, SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed place of every word, neighbour pair and skip pair; repeats included."""
    begins, ends = spans(data, places, ALNUM)
    words, rows = hashes(data, begins, ends, byte_codes()), rows_of(begins, places)
    found = [(rows, words)]
    for gap, salt in ((1, NEIGHBOUR), (2, SKIP)):
        same = rows[gap:] == rows[:-gap]
        found.append((rows[gap:][same], mix(words[:-gap][same] * salt + words[gap:][same])))
    return np.concatenate([r for r, _ in found]), (np.concatenate([h for _, h in found]) >> np.uint64(64 - BITS)).astype(np.int64)


def margins(column: pa.Array, model: Model) -> np.ndarray:
    """The linear score of each row: bias and the weights of its distinct features."""
    data, places = utf8(column)
    out = np.full(len(column), model.bias)
    for i, j in pieces(places):
        rows, at = features(data[places[i]:places[j]], places[i:j + 1] - places[i])
        heavy = model.weights[at] != 0  # few: the others add nothing
        pairs = np.unique(rows[heavy] << BITS | at[heavy])
        out[i:j] += np.bincount(pairs >> BITS, model.weights[pairs & (1 << BITS) - 1], j - i)
    return out


def fit(texts: list[str | None], labels: list[int], share: float = 0.5) -> Model:
    """One pass of updates for each epoch, in an order drawn with a fixed seed.

    Both labels weigh the same; ``share`` of label 1 sets the final bias.
    """
    if len(set(labels)) < 2:
        return Model(np.zeros(1 << BITS), 0.0)
    heft = (0.5 / (1 - np.mean(labels)), 0.5 / np.mean(labels))
    n, z = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_n = bias_z = 0.0
    data, places = utf8(pa.array(texts, pa.large_string()))
    found = [np.zeros(0, np.int64)]
    for i, j in pieces(places):  # piece by piece: the work arrays are many times the text
        rows, at = features(data[places[i]:places[j]], places[i:j + 1] - places[i])
        found.append(np.unique(i + rows << BITS | at))
    pairs = np.concatenate(found)
    cuts = np.searchsorted(pairs >> BITS, np.arange(len(texts) + 1))
    order = np.random.default_rng(7)

    def weight(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for k in order.permutation(len(texts)):
            own = pairs[cuts[k]:cuts[k + 1]] & (1 << BITS) - 1
            w, bias = weight(z[own], n[own], L1), float(weight(bias_z, bias_n, 0))
            g = heft[labels[k]] * (1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[k])
            rate = (np.sqrt(n[own] + g * g) - np.sqrt(n[own])) / ALPHA
            z[own] += g - rate * w
            n[own] += g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
    share = min(max(share, 1e-3), 1 - 1e-3)
    return Model(weight(z, n, L1).astype(np.float64), float(weight(bias_z, bias_n, 0)) + float(np.log(share / (1 - share))))


def remainder(key: Column, of: int) -> Column:
    """The crc32 of an id as text, modulo ``of``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(of))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, most_bytes: int,
           key: str = "doc_id", text: str = "text") -> list:
    """At most ``most`` (id, text, label) rows of each label for the driver, by the hash of their id.

    The chosen ids, twice ``most`` at most, are broadcast.
    """
    known = (labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).dropna()
             .groupBy("_key").agg(F.min("_label").alias("_label")))
    zero, one = (known.where(F.col("_label") == v).orderBy(F.xxhash64("_key"), "_key").limit(most) for v in (0, 1))
    chosen = (docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
              .join(F.broadcast(zero.union(one)), "_key").where(F.octet_length("_text") <= most_bytes))
    return sorted((r["_key"], r["_text"], r["_label"]) for r in chosen.dropDuplicates(["_key"]).collect())


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """A model from the labelled rows that ``labels`` gives."""
    rows = sample(docs, labels, label, SAMPLE, SAMPLE_BYTES, key, text)
    # of the labels that sample() draws from
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).dropna().groupBy("_key").agg(F.min("_label").alias("_label"))
    there = known.where(F.col("_label").isin(0, 1)).join(docs.select(F.col(key).alias("_key")), "_key", "left_semi")
    share = there.agg(F.avg(F.col("_label").cast("double"))).first()[0]
    return fit([t for _, t, _ in rows], [y for _, _, y in rows], 0.5 if share is None else share)


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability that the label is 1."""
    ready_for_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in small(batches):
            yield pa.array(1 / (1 + np.exp(-np.clip(margins(texts, shared.value), -35, 35))))

    return docs.withColumn(free_name(docs, score), probability(text))
