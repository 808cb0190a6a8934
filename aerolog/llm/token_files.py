"""Token ids in files: frequent ids in few bytes, decoded by table look-up.

Ids are counted over all documents and ranked by falling count. A rank below 256 takes one byte, below
65,536 two, and so on up to four. Four ranks share one control byte that holds their lengths, two bits
each, low bits first; control bytes and data bytes lie apart, so decoding is a look-up of the lengths,
a running sum, and a gather. The ranking is stored with the files.

A folder holds ``ranks`` (rank, id) and ``tokens``: one row a document (part, before, doc_id, n_tokens,
control, data), in ascending order of doc_id within a part and from part to part; parts are ranges of
doc_id (a number) of about the same count. Parquet is the
container, so that Spark's own commit makes a lost executor's files whole.

A null or empty text is the end token alone. Null ids of documents come first; rows with one doc_id
are ordered by the hash of their ids, so no place depends on chance; an empty table gives empty files.
Other columns of the input don't matter.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolog.llm.bpe import lists, vocabulary
from aerolog.llm.common import pieces, ready_for_python, small, small_batches, utf8
from aerolog.llm.units import Codes, by_row, word_units
from aerolog.session import materialized


#: Bytes of text that are cut into units at once; the work arrays take some hundred times that.
ENCODED_AT_ONCE = 1 << 18
#: Ranges of ids for each shuffle partition: several, so that partitions come out even.
PARTS_A_TASK = 4


class Library:
    """The tokenizers library, asked once for each unit that a worker remembers."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        # a special token parts the units of one request: the library looks for it before all else
        self.mark, self.mark_id = next((t.content, i) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items()))
        suffix = self.tokenizer.model.end_of_word_suffix
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(1 + max(vocab.values()), bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.codes = Codes(self.encode_units)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def encode_units(self, units: list[bytes]) -> list[np.ndarray]:
        texts = [u.decode() for u in units]
        code: dict[str, np.ndarray] = {}
        # letters alone are one word: a space parts them, and each ends in a token with a word end
        words = [u for u in texts if u.isalpha()]
        if words:
            found = self.ids(" ".join(words))
            ends = np.flatnonzero(self.ends_word[found]) + 1
            if len(ends) == len(words):
                code.update(zip(words, np.split(found, ends[:-1])))
        rest = [u for u in texts if u not in code]
        plain = [u for u in rest if "<|" not in u]
        code.update((u, self.ids(u)) for u in rest if "<|" in u)
        if plain:
            found = self.ids(self.mark.join(plain))
            code.update(zip(plain, parted(found, self.mark_id)))
        return [code[u] for u in texts]

    def encode(self, column: pa.Array, end: int, kind: str) -> pa.Array:
        """The ids of each text and the end token, as bytes of ``kind``."""
        data, places = utf8(column)
        ids, sizes = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
        for i, j in pieces(places, ENCODED_AT_ONCE):
            rows = places[i:j + 1] - places[i]
            own, begins, ends = word_units(data[places[i]:places[j]], rows)
            found, at = self.codes(own, begins, ends)
            cuts = by_row(begins, at, rows)
            ids.append(np.insert(found.astype(kind), cuts[1:], end))
            sizes.append(np.diff(cuts) + 1)
        return byte_rows(np.concatenate(ids), np.concatenate(sizes))


def byte_rows(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column whose rows hold so many of the values each."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def parted(ids: np.ndarray, mark: int) -> Iterator[np.ndarray]:
    """The ids between marks."""
    cuts = np.flatnonzero(ids == mark).tolist()
    return (ids[a:b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)]))


@lru_cache(maxsize=1)
def library(tokenizer_json: str) -> Library:
    return Library(tokenizer_json)


def width(tokenizer_json: str, end: int) -> str:
    """The numpy type of an id on its way to its rank: two bytes where all ids fit."""
    spec = json.loads(tokenizer_json)
    highest = max([end, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return "<u2" if highest <= 0xFFFF else "<u4"


def encoded(text: Column, shared, end: int, kind: str) -> Column:
    """Ids of a text by the tokenizers library, and the end token, as bytes of ``kind``."""
    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = library(shared.value)
        for texts in small(batches):
            yield own.encode(texts, end, kind)

    return encode(text)


def counts(tokens: DataFrame, kind: str, ids: str = "ids") -> DataFrame:
    """How often each id occurs in rows of bytes. Every task sends one row for each id at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in small(batches):
            seen = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(seen) > len(total):
                total, seen = seen.astype(np.int64), total
            total[:len(seen)] += seen
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["id", "n"])

    return tokens.select(ids).mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def ranking(tokens: DataFrame, kind: str) -> np.ndarray:
    """Ids by falling count, then ascending: at most one for each entry of the vocabulary."""
    return np.array([r["id"] for r in counts(tokens, kind).orderBy(F.desc("n"), "id").collect()], np.uint32)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    lengths = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[:len(ranks)] = lengths - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    spread = np.ascontiguousarray(ranks, "<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), spread[np.arange(4) < lengths[:, None]].tobytes()


#: The four lengths that a control byte holds.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
#: The bits that a length leaves of a 32-bit read.
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks: lengths from the table, places from their running sum, one 32-bit read each."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    words = padded[:-3] | padded[1:-2] << 8 | padded[2:-1] << 16 | padded[3:] << 24
    return words[at] & MASKS[lengths]


def write_tokens(docs: DataFrame, path: str, end: int, folder: str, key: str = "doc_id", text: str = "text") -> None:
    """Encode all documents and write ``ranks`` and ``tokens`` to ``folder``."""
    spark = docs.sparkSession
    ready_for_python(spark)
    shared = vocabulary(spark, path)
    kind = width(shared.value, end)
    tokens = (docs.select(F.col(key).cast("long").alias("doc_id"), encoded(F.col(text), shared, end, kind).alias("ids"))
              .select("doc_id", "ids", F.xxhash64("ids").alias("tie")))
    with small_batches(spark):
        tokens = materialized(tokens)
    ranked = ranking(tokens, kind)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(ranked)], "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    table = spark.sparkContext.broadcast(rank_of)

    parts = PARTS_A_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = tokens.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10_000)).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = [np.frombuffer(x, kind) for x in batch.column(2).to_pylist()]
            packed = [pack(table.value[r]) for r in rows]
            ids = batch.column(0)
            part = np.where(np.array(ids.is_null()), 0, np.searchsorted(bounds, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), "right"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), ids, batch.column(1), pa.array([len(r) for r in rows], pa.int64()),
                 pa.array([c for c, _ in packed], pa.binary()), pa.array([d for _, d in packed], pa.binary())],
                ["part", "doc_id", "tie", "n_tokens", "control", "data"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = -1, 0
        for batch in small(batches):
            part, sizes = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            total = np.cumsum(sizes)
            first = np.searchsorted(part, part)  # rows come by part
            places = total - sizes - (total - sizes)[first] + np.where(part == last, before, 0)
            if len(part):
                last, before = part[-1], int(places[-1] + sizes[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, pa.int64()), *(batch.column(k) for k in (1, 3, 4, 5))],
                                             ["part", "before", "doc_id", "n_tokens", "control", "data"])

    coded = (tokens.select("doc_id", "tie", "ids").mapInArrow(code, "part int, doc_id long, tie long, n_tokens long, control binary, data binary")
             .repartition("part").sortWithinPartitions("part", "doc_id", "tie")
             .mapInArrow(number, "part int, before long, doc_id long, n_tokens long, control binary, data binary"))
    with small_batches(spark):
        coded.write.parquet(f"{folder}/tokens")


def read_tokens(spark: SparkSession, folder: str, as_bytes: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids from the files.

    ``as_bytes`` gives the ids as little-endian unsigned 32-bit integers instead of an array. Only
    ranks and the sums by part go to the driver: a row for each id of the vocabulary, a row for each file.
    """
    ready_for_python(spark)
    ranked = np.array([r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()], np.uint32)
    table = spark.sparkContext.broadcast(ranked)

    @F.arrow_udf("binary" if as_bytes else "array<int>")
    def ids(control: pa.Array, data: pa.Array, n: pa.Array) -> pa.Array:
        rows = [table.value[unpack(c, d, k)] for c, d, k in zip(control.to_pylist(), data.to_pylist(), n.to_pylist())]
        return pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary()) if as_bytes else lists([r.astype(np.int32) for r in rows])

    stored = spark.read.parquet(f"{folder}/tokens")
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("first"))
    decoded = stored.withColumn("ids", ids("control", "data", "n_tokens"))
    counted = F.octet_length("ids") / 4 if as_bytes else F.size("ids")
    return (decoded.join(F.broadcast(starts), "part")
            .select("doc_id", (F.col("first") + F.col("before")).alias("start"), counted.cast("long").alias("n_tokens"), "ids"))
