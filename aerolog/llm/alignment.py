"""Alignment of two tokenizations: overlapping tokens, common borders, and how often ids meet.

Tokenizer A is a byte-level BPE file of the tokenizers library and reads a space before the text; B is
a sentencepiece model, which puts that space in front itself. Special tokens' strings are plain text to
both. A's token stands for its byte-level decoded bytes, B's for its piece in UTF-8, with U+2581 as a
space and ``<0xHH>`` as byte HH. Where the joined bytes of either differ from space+text (text with U+2581, bytes that
aren't UTF-8), the document has no tokens, nor if its text is null or empty.

In each batch the tokens of all documents lie on one line of bytes, so that a document is a range of
places, its key. ``merge_asof`` finds for each start of an A token the B token that covers it, and for
each start of a B token the A token that covers it; the union of both, where equal starts count once, are
the links: all pairs of tokens with overlapping bytes. Places where tokens of both end part the groups.

Links of an id pair are counted over all documents: tasks count what they meet, Spark adds up. Counts go
back to the links by a table of the most frequent pairs, at most ``SENT``, which is broadcast, and by a join for
links of the other pairs. A B id's highest count is one number for each entry of its vocabulary.

Rows are independent but for the counts; ties, repeated rows and null ids are told apart by a number
that the written table gives to each row. An empty table stays empty. Other columns of the input don't matter.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolog.llm.bpe import byte_characters, vocabulary
from aerolog.llm.common import pieces, ready_for_python, small, small_batches, utf8
from aerolog.llm.token_files import byte_rows
from aerolog.llm.units import Codes, by_row
from aerolog.session import materialized

#: Id pairs whose counts are broadcast, 12 bytes each.
SENT = 1 << 19
#: Distinct pairs that a task counts before it passes them on.
HELD = 1 << 20
#: Bytes of text that are aligned at once.
TEXT_BYTES = 1 << 19
#: A pair of ids is one number: A's id above, B's id in the low bits.
LOW_BITS = 16
#: Leading bytes after which a byte may end white space beyond ASCII.
WHITE = ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))
SPACE = "▁".encode()
ASCII_WHITE = np.zeros(256, bool)
ASCII_WHITE[[9, 10, 11, 12, 13, 32]] = True


def table_of(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All token bytes side by side, and where each begins (and the end of all)."""
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0, *map(len, tokens)])


@lru_cache(maxsize=2)
def decimals(digits: int) -> np.ndarray:
    """The digits of all numbers of so many digits, zeros instead of leading ones."""
    n = np.arange(10 ** digits)[:, None]
    powers = 10 ** np.arange(digits)[::-1]
    return np.where((n >= powers) | (powers == 1), n // powers % 10 + 48, 0).astype(np.uint8)


class Tokens:
    """One side: ids by unit, and the bytes of each id. A unit whose token bytes are not its own is marked by -1."""

    def __init__(self, tokens: list[bytes]):
        self.tokens, self.sizes = tokens, np.array([len(t) for t in tokens] or [0], np.int64)
        self.codes = Codes(self.encode_units)

    def ids_of(self, units: list[bytes]) -> list[list[int]]:
        raise NotImplementedError

    def encode_units(self, units: list[bytes]) -> list[np.ndarray]:
        out = []
        for unit, ids in zip(units, self.ids_of(units)):
            whole = b"".join([self.tokens[i] for i in ids]) == unit
            out.append(np.array(ids if whole else [-1], np.int32))
        return out


class ByteLevel(Tokens):
    """Tokenizer A. A text is cut before white space that follows a character that is none: no token reaches over that."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(tokenizer_json)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        names = {i: t for t, i in spec["model"]["vocab"].items()}
        tokens = [bytes(byte_of[c] for c in names[i]) if i in names else b"" for i in range(1 + max(names))]
        super().__init__(tokens)

    def ids_of(self, units: list[bytes]) -> list[list[int]]:
        texts = [u.decode("utf-8", "replace") for u in units]
        # units that end in a plain character can be asked for in one text: the next one begins with white space
        alone = [not 33 <= u[-1] < 127 or "\ufffd" in t for u, t in zip(units, texts)]
        plain = [k for k, own in enumerate(alone) if not own]
        rest = [k for k, own in enumerate(alone) if own]
        out: list = [None] * len(units)
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast(["".join([texts[k] for k in plain])], add_special_tokens=False)[0].ids)
            ends = np.cumsum(self.sizes[ids])
            cuts = np.searchsorted(ends, np.cumsum([len(units[k]) for k in plain]), "left") + 1
            for k, a, b in zip(plain, [0, *cuts[:-1].tolist()], cuts.tolist()):
                out[k] = ids[a:b].tolist()
        if rest:
            for k, e in zip(rest, self.tokenizer.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
                out[k] = e.ids
        return out

    @staticmethod
    def cuts(data: np.ndarray) -> np.ndarray:
        """Places before which a text may be cut. White space beyond ASCII is taken to be possible wherever its first bytes are."""
        white = ASCII_WHITE[data]
        last = np.concatenate([[32], data[:-1]])
        plain = (last > 32) & (last < 127)
        two, three = np.concatenate([[0, 0], data[:-2]])[:len(data)], np.concatenate([[0, 0, 0], data[:-3]])[:len(data)]
        odd = np.zeros(len(data), bool)
        for a, b in WHITE:
            odd |= (two == a) & (last == b) | (three == a) & (two == b)
        return white & (plain | (last >= 128) & ~odd)


class Pieces(Tokens):
    """Tokenizer B. A text is cut before a space that follows a character that is none: no piece holds a space behind another character."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.space = [self.model.piece_to_id(SPACE.decode())]
        tokens = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            tokens.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.encode().replace(SPACE, b" "))
            if b" " in tokens[-1].lstrip(b" "):
                raise ValueError(f"a piece holds a space behind another character: {piece!r}")
        super().__init__(tokens)

    def ids_of(self, units: list[bytes]) -> list[list[int]]:
        # B adds the first space itself, but not to an empty text
        found = self.model.encode([u[1:].decode("utf-8", "replace") for u in units], num_threads=1) if units else []
        return [self.space if u == b" " else ids for u, ids in zip(units, found)]

    @staticmethod
    def cuts(data: np.ndarray) -> np.ndarray:
        return (data == 32) & (np.concatenate([[32], data[:-1]]) != 32)


@lru_cache(maxsize=1)
def sides(tokenizer_json: str, model: bytes) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(tokenizer_json), Pieces(model)


def tokens_of(side: Tokens, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, and where each row's ids begin (and the end of all). No row is empty."""
    cut = side.cuts(data)
    cut[rows[:-1]] = True
    begins = np.flatnonzero(cut)
    ids, places = side.codes(data, begins, np.append(begins[1:], len(data)))
    return ids, by_row(np.append(begins, len(data)), places, rows)


class Aligned:
    """The tokens of some documents on one line of bytes; documents without tokens are empty ranges."""

    def __init__(self, texts: pa.Array, a_side: Tokens, b_side: Tokens):
        data, places = utf8(texts)
        rows = places + np.arange(len(places))
        data = np.insert(data, places[:-1], 32)
        self.n = len(rows) - 1
        has = np.diff(places) > 0
        found = [tokens_of(side, data, rows) if self.n else (np.zeros(0, np.int32), np.zeros(1, np.int64)) for side in (a_side, b_side)]
        for ids, at in found:
            bad = np.flatnonzero(ids < 0)
            has[np.unique(np.searchsorted(at, bad, "right") - 1)] = False
        self.ids, self.rows, self.starts, self.ends = [], [], [], []
        for (ids, at), side in zip(found, (a_side, b_side)):
            row = np.repeat(np.arange(self.n), np.diff(at))
            keep = has[row]
            ids, row = ids[keep], row[keep]
            sizes = side.sizes[ids]
            # a document's bytes lie behind those of the documents with tokens before it
            ends = np.cumsum(sizes)
            self.ids.append(ids)
            self.rows.append(row)
            self.ends.append(ends)
            self.starts.append(ends - sizes)

    def counts(self, side: int) -> np.ndarray:
        return np.bincount(self.rows[side], minlength=self.n)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of an A and a B token that overlap, document by document, in the order of the later start."""
        a = pd.DataFrame({"place": self.starts[0], "a": np.arange(len(self.starts[0]))})
        b = pd.DataFrame({"place": self.starts[1], "b": np.arange(len(self.starts[1]))})
        of_a = pd.merge_asof(a, b, on="place")  # the B token that covers the start of each A token
        of_b = pd.merge_asof(b, a, on="place")
        of_b = of_b[~np.isin(self.starts[1], self.starts[0], assume_unique=True)]  # equal starts are there already
        place = np.concatenate([of_a["place"].to_numpy(), of_b["place"].to_numpy()])
        order = np.argsort(place, kind="stable")
        return (np.concatenate([of_a["a"].to_numpy(), of_b["a"].to_numpy()])[order].astype(np.int64),
                np.concatenate([of_a["b"].to_numpy(), of_b["b"].to_numpy()])[order].astype(np.int64))

    def common_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the A and of the B tokens that end a group."""
        at = np.zeros(1 + (int(self.ends[0][-1]) if len(self.ends[0]) else 0), bool)
        at[self.ends[0]] = True
        last_b = np.flatnonzero(at[self.ends[1]])
        at[:] = False
        at[self.ends[1]] = True
        return np.flatnonzero(at[self.ends[0]]), last_b

    def group_texts(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document; empty without tokens."""
        last_a, last_b = self.common_ends()
        (a, b), (row_a, row_b) = self.ids, self.rows
        if not len(a):
            return [b""] * self.n
        group_a = np.searchsorted(last_a, np.arange(len(a)))
        group_b = np.searchsorted(last_b, np.arange(len(b)))
        at_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]
        at_b = np.arange(len(b)) + last_a[group_b] + 1
        ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), 44, np.uint8)  # commas
        ids[at_a], ids[at_b] = a, b
        marks[at_a[last_a]], marks[at_b[last_b]] = 124, 59
        text = np.concatenate([decimals(len(str(ids.max())))[ids], marks[:, None]], axis=1)
        shown = text > 0
        flat = text[shown].tobytes()
        size = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])
        cuts = size[np.concatenate([[0], np.cumsum(self.counts(0) + self.counts(1))])].tolist()
        return [flat[x:y - 1] if y > x else b"" for x, y in zip(cuts, cuts[1:])]


def sizes_of(a: Aligned) -> dict[str, np.ndarray]:
    last_a, _ = a.common_ends()
    return {"n_a": a.counts(0), "n_b": a.counts(1), "n_groups": np.bincount(a.rows[0][last_a], minlength=a.n)}


def list_rows(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, kind))


def outputs(own: Aligned, kind: str, bits: int, wanted: tuple[str, ...]) -> dict[str, pa.Array]:
    """The wanted columns of :data:`COLUMNS`."""
    out: dict[str, pa.Array] = {name: pa.array(n, pa.int64()) for name, n in sizes_of(own).items() if name in wanted}
    if {"n_links", "links", "link_a", "link_b"} & {*wanted}:
        a, b = own.links()
        sizes = np.bincount(own.rows[0][a], minlength=own.n)
        first_a, first_b = (np.concatenate([[0], np.cumsum(own.counts(k))]) for k in (0, 1))
        out["n_links"] = pa.array(sizes, pa.int64())
        if "links" in wanted:
            out["links"] = byte_rows(own.ids[0][a].astype(kind) << np.array(bits, kind) | own.ids[1][b].astype(kind), sizes)
        out["link_a"] = list_rows((a - first_a[own.rows[0][a]]).astype(np.int32), sizes, pa.int32())
        out["link_b"] = list_rows((b - first_b[own.rows[1][b]]).astype(np.int32), sizes, pa.int32())
    if {"groups", "groups_sha256"} & {*wanted}:
        texts = own.group_texts()
        out["groups"] = pa.array(texts, pa.binary()).cast(pa.string())
        out["groups_sha256"] = pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts], pa.string())
    for k, name in enumerate(("a_ids", "b_ids")):
        if name in wanted:
            out[name] = list_rows(own.ids[k].astype(np.int32), own.counts(k), pa.int32())
    return {name: out[name] for name in wanted}


#: What :func:`aligned` can give for each document: numbers of tokens, groups and links; the groups as text and its digest; token
#: ids; the numbers of the tokens that each link joins; and the links' id pairs as bytes.
COLUMNS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string", "groups_sha256": "string", "a_ids": "array<int>",
           "b_ids": "array<int>", "link_a": "array<int>", "link_b": "array<int>", "links": "binary"}


def pair_kind(tokenizer_json: str, model: bytes) -> tuple[str, int]:
    """The numpy type of an id pair, and the bits of B's id."""
    most = max(len(side.sizes) for side in sides(tokenizer_json, model))
    return ("<u4", 16) if most <= 1 << 16 else ("<u8", 32)


def aligned(docs: DataFrame, a_path: str, b_path: str, wanted: tuple[str, ...] = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"),
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, and the wanted :data:`COLUMNS`); ``row`` numbers the rows of the result as it is computed, so write it before using it twice."""
    spark = docs.sparkSession
    ready_for_python(spark)
    a_file, b_file = vocabulary(spark, a_path), model_bytes(spark, b_path)
    kind, bits = pair_kind(a_file.value, b_file.value)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = sides(a_file.value, b_file.value)
        for batch in small(batches):
            texts = batch.column(2)
            _, places = utf8(texts)
            for i, j in pieces(places, TEXT_BYTES):
                made = outputs(Aligned(texts.slice(i, j - i), a_side, b_side), kind, bits, wanted)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), *made.values()], ["doc_id", "row", *made])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")).mapInArrow(
        align, "doc_id long, row long, " + ", ".join(f"{c} {COLUMNS[c]}" for c in wanted))


def model_bytes(spark: SparkSession, path: str):
    """The model file as a broadcast; its size is the file's."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    keys, n = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def pair_counts(links: DataFrame, kind: str) -> DataFrame:
    """(pair, n) of a column of id pairs as bytes. A task passes distinct pairs on when it holds ``HELD`` of them, and at its end."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [(np.zeros(0, kind), np.zeros(0, np.int64))], 0

        def passed():
            keys, n = added(held)
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["pair", "n"])

        for batch in small(batches):
            held.append(np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), return_counts=True))
            size += len(held[-1][0])
            if size > 2 * HELD:
                held = [added(held)]
                size = len(held[0][0])
                if size > HELD:
                    yield passed()
                    held, size = [(np.zeros(0, kind), np.zeros(0, np.int64))], 0
        yield passed()

    return links.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_pair_counts(found: DataFrame, kind: str, bits: int, most_sent: int = SENT) -> DataFrame:
    """``found`` (a written table with ``row`` and ``links``) without its links, but with n_best and count_sum."""
    spark = found.sparkSession
    level = F.floor(F.log2("n") * 16).alias("level")
    counts = materialized(pair_counts(found.select("links"), kind))
    best = counts.groupBy((F.col("pair") % (1 << bits)).alias("b")).agg(F.max("n").alias("highest"))
    counts = materialized(counts.withColumn("b", F.col("pair") % (1 << bits)).join(best, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"), level))
    # the most frequent pairs, down to a level of counts below which there would be too many
    least, room = 1 << 20, most_sent
    for r in counts.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 64 * 16 levels
        if (room := room - r["count"]) < 0:
            break
        least = r["level"]
    sent = counts.where(F.col("level") >= least).select("pair", "n", "best").toArrow().sort_by("pair")
    top = spark.sparkContext.broadcast((sent["pair"].to_numpy().astype(kind), sent["n"].to_numpy(), sent["best"].to_numpy().astype(np.int64)))
    kept = [c for c in found.columns if c != "links"]

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = (np.append(x, np.zeros(1, x.dtype)) for x in top.value)  # what isn't there ends up at the zero
        for batch in small(batches):
            raw = batch.column(batch.schema.get_field_index("links")).to_pylist()
            pairs = np.frombuffer(b"".join(raw), kind)
            at = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64) // pairs.itemsize])
            place = np.searchsorted(keys[:-1], pairs)
            known = keys[place] == pairs
            known[place == len(keys) - 1] = False
            place[~known] = len(keys) - 1
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[place])])[at]) for x in (best, n)]
            rest = np.flatnonzero(~known)
            other = list_rows(pairs[rest].astype(np.int64), np.diff(np.searchsorted(rest, at)), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *map(pa.array, sums), other], [*kept, "n_best", "count_sum", "other"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name != "links")
    priced = materialized(found.mapInArrow(price, f"{schema}, n_best long, count_sum long, other array<long>"))
    rest = (priced.select("row", F.explode("other").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
            .join(counts, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more")))
    return priced.join(rest, "row", "left").select(
        *kept, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"))


def digests(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", most_sent: int = SENT) -> DataFrame:
    """(doc_id, row, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of each document."""
    spark = docs.sparkSession
    kind, bits = pair_kind(vocabulary(spark, a_path).value, model_bytes(spark, b_path).value)
    with small_batches(spark):
        found = materialized(aligned(docs, a_path, b_path, ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"), key, text))
        return with_pair_counts(found, kind, bits, most_sent)
