"""Quality by a byte-level convolutional network in numpy.

Bytes have learned embeddings. ``FILTERS`` learned filters of ``WIDTH`` bytes slide over the whole
document. Their responses are max-pooled in chunks of two blocks of ``BLOCK`` bytes that overlap by one
block; the mean and the maximum over all chunks feed one logistic unit. For scoring, embeddings and
filters are folded into tables of byte pairs, so a response is three look-ups.

The network is trained on the driver on a bounded sample: of each label at most ``SAMPLE`` rows, by the
hash of their id, of texts of at most ``SAMPLE_BYTES``; both labels weigh the same there, and the bias
is moved to the share of labels among all labelled rows. Scoring reads every whole text.

Null and empty texts are one empty chunk and have a score. Null labels, and those of absent rows, are
left out; of a label that occurs twice one row is used. Without labels of both kinds every score is
0.5. Ties can't arise; other columns are kept; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolog.llm.common import free_name, pieces, ready_for_python, small, utf8
from aerolog.llm.toxicity import sample

FILTERS, WIDTH, DEPTH, BLOCK = 16, 6, 8, 256
SAMPLE = 1500
SAMPLE_BYTES = 16_384
EPOCHS, DOCS_A_STEP, RATE = 6, 24, 0.01
#: Bytes of text that a training step works on at once.
PART = 1 << 16
#: Texts that a task works on at once, in bytes; the responses take 64 times that.
PIECE = 1 << 18


@dataclass
class Network:
    embedding: np.ndarray  # (256, DEPTH); byte 0, the padding, is zero
    filters: np.ndarray  # (WIDTH, DEPTH, FILTERS)
    offsets: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS,): of the means, of the maxima
    bias: float

    def pairs(self) -> list[np.ndarray]:
        """For each two columns of the filters, the response of every pair of bytes."""
        one = np.einsum("bd,kdf->kbf", self.embedding, self.filters)
        return [(one[k + 1][:, None] + one[k][None]).reshape(-1, FILTERS).astype(np.float32) for k in range(0, WIDTH, 2)]


def padded(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts apart by WIDTH zeros; the begin of each text there and of each block, and each block's row."""
    rows = len(places) - 1
    sizes = np.diff(places)
    begins = places[:-1] + WIDTH * np.arange(rows)
    out = np.zeros(len(data) + WIDTH * rows + WIDTH, np.uint8)
    out[np.arange(len(data)) + WIDTH * np.repeat(np.arange(rows), sizes)] = data
    blocks = np.maximum(1, -(-sizes // BLOCK))
    row = np.repeat(np.arange(rows), blocks)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return out, begins[row] + BLOCK * nth, row


def pooled(peaks: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Peaks of the chunks (a block and the next of its row), their row, and whether the next block won."""
    last = np.append(row[1:] != row[:-1], True)
    alone = last & np.insert(row[1:] != row[:-1], 0, True)  # the only block of its row
    keep = np.flatnonzero(~last | alone)
    after = np.where(alone[keep], keep, np.minimum(keep + 1, len(row) - 1))
    won = peaks[after] > peaks[keep]
    return np.where(won, peaks[after], peaks[keep]), keep, np.where(won, after[:, None], keep[:, None])


def features(chunks: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Mean and maximum of every filter over the chunks of each row."""
    first = np.flatnonzero(np.insert(row[1:] != row[:-1], 0, True))
    count = np.diff(np.append(first, len(row)))[:, None]
    return np.hstack([np.add.reduceat(chunks, first, axis=0) / count, np.maximum.reduceat(chunks, first, axis=0)])


def margins(column: pa.Array, net: Network, tables: list[np.ndarray]) -> np.ndarray:
    """The logit of each row."""
    data, places = utf8(column)
    out = np.zeros(len(column))
    for i, j in pieces(places, PIECE):
        text, begins, row = padded(data[places[i]:places[j]], places[i:j + 1] - places[i])
        pair = text[:-1].astype(np.uint16) | text[1:].astype(np.uint16) << np.uint16(8)
        n = len(text) - WIDTH
        response = tables[0][pair[:n]]
        for k in range(1, WIDTH // 2):
            response += tables[k][pair[2 * k:n + 2 * k]]
        # places past a text's end are no windows; an empty text has the one of its padding
        sizes = np.diff(places[i:j + 1])
        ends = places[i + 1:j + 1] - places[i] + WIDTH * np.arange(j - i)
        past = ends[:, None] + np.arange(WIDTH)
        past = past[(np.arange(WIDTH) > 0) | (sizes > 0)[:, None]]
        response[past[past < n]] = -np.inf
        peaks = np.maximum(np.maximum.reduceat(response, begins, axis=0) + net.offsets, 0)
        chunks, keep, _ = pooled(peaks, row, j - i)
        out[i:j] = features(chunks, row[keep]) @ net.weights + net.bias
    return out


def train(texts: list[str | None], labels: list[int], share: float = 0.5, seed: int = 11) -> Network:
    """Adam on the log loss, both labels weighing the same; ``share`` of label 1 sets the final bias."""
    draw = np.random.default_rng(seed)
    y = np.array(labels, float)
    net = Network(draw.normal(0, 0.5, (256, DEPTH)), draw.normal(0, 0.25, (WIDTH, DEPTH, FILTERS)),
                  np.zeros(FILTERS), np.zeros(2 * FILTERS), 0.0)
    net.embedding[0] = 0
    if len(set(labels)) < 2:
        return net
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    raw = [np.frombuffer((t or "").encode(), np.uint8) for t in texts]
    state = [net.embedding, net.filters, net.offsets, net.weights, np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in state]
    steps = 0
    total = EPOCHS * -(-len(texts) // DOCS_A_STEP)
    for _ in range(EPOCHS):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), DOCS_A_STEP):
            chosen = order[at:at + DOCS_A_STEP]
            grads = [np.zeros_like(p) for p in state]
            sizes = np.cumsum([0, *(len(raw[k]) for k in chosen)])
            for i, j in pieces(sizes, PART):  # the responses take hundreds of times the text
                data = np.concatenate([raw[k] for k in chosen[i:j]])
                part = gradients(net, state[4][0], data, sizes[i:j + 1] - sizes[i], y[chosen[i:j]], weight[chosen[i:j]] / len(chosen))
                for g, p in zip(grads, part):
                    g += p
            steps += 1
            rate = RATE * (1 - 0.9 * steps / total)
            for p, g, (m, v) in zip(state, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
            net.embedding[0] = 0
    share = min(max(share, 1e-3), 1 - 1e-3)
    net.bias = float(state[4][0] + np.log(share / (1 - share)))
    return net


def gradients(net: Network, bias: float, data: np.ndarray, places: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list:
    """Of embedding, filters, offsets, weights and bias. Only the windows that won a pool have any."""
    text, begins, row = padded(data, places)
    rows, n = len(places) - 1, len(text) - WIDTH
    deep = net.embedding[text]
    response = sum(deep[k:n + k] @ net.filters[k] for k in range(WIDTH))
    ends = places[1:] + WIDTH * np.arange(rows)
    past = ends[:, None] + np.arange(WIDTH)
    past = past[(np.arange(WIDTH) > 0) | (np.diff(places) > 0)[:, None]]
    response[past[past < n]] = -np.inf
    tops = np.maximum.reduceat(response, begins, axis=0)
    peaks = np.maximum(tops + net.offsets, 0)
    chunks, keep, winner = pooled(peaks, row, rows)
    crow = row[keep]
    means_maxima = features(chunks, crow)
    p = 1 / (1 + np.exp(-np.clip(means_maxima @ net.weights + bias, -35, 35)))
    d = (p - y) * weight
    count = np.bincount(crow, minlength=rows)
    d_chunk = (d[:, None] * net.weights[:FILTERS] / count[:, None])[crow]
    best = chunks == means_maxima[crow, FILTERS:]
    first_best = best & (np.cumsum(best, 0) - np.insert(np.cumsum(best, 0), 0, 0, 0)[np.searchsorted(crow, crow)] == 1)
    d_chunk += first_best * (d[:, None] * net.weights[FILTERS:])[crow]
    d_block = np.zeros_like(peaks)
    np.add.at(d_block, (winner, np.arange(FILTERS)), d_chunk)
    d_block *= peaks > 0
    # the window of each block and filter that has the top response
    block = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
    where, which = np.nonzero(response == tops[block])
    code, at = np.unique(block[where] * FILTERS + which, return_index=True)
    where, which = where[at], which[at]
    g = d_block[code // FILTERS, which]
    d_embedding, d_filters = np.zeros_like(net.embedding), np.zeros_like(net.filters)
    hot = np.zeros((len(g), FILTERS))
    hot[np.arange(len(g)), which] = g
    for k in range(WIDTH):
        d_filters[k] = deep[where + k].T @ hot
        np.add.at(d_embedding, text[where + k], net.filters[k][:, which].T * g[:, None])
    return [d_embedding, d_filters, d_block.sum(0), means_maxima.T @ d, np.array([d.sum()])]


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Network:
    """A network from the labelled rows that ``labels`` gives."""
    rows = sample(docs, labels, label, SAMPLE, SAMPLE_BYTES, key, text)
    share = labels.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return train([t for _, t, _ in rows], [v for _, _, v in rows], 0.5 if share is None else share)


def scored(docs: DataFrame, net: Network, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability that the label is 1. The network and its tables have a fixed size."""
    ready_for_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = shared.value.pairs()
        for texts in small(batches):
            yield pa.array(1 / (1 + np.exp(-np.clip(margins(texts, shared.value, tables), -35, 35))))

    return docs.withColumn(free_name(docs, score), probability(text))
