"""Exact byte-pair encoding by backtracking, and decoding by an offset table.

A word is covered from the left by the longest vocabulary entries that an Aho-Corasick automaton finds.
A neighbour is accepted only if the two tokens are compatible, that is if byte-pair merging of their
joined text would leave that border alone; the answer is kept in a table of pairs. Where no entry
fits, the last token is taken back and shortened. Every place is given up at most once, so the work is
linear in the length, and the result is that of merging in rank order.

The vocabulary is a tokenizer file with word ends (``</w>``); its text goes to the workers as a
broadcast, whose size is that of the file. A text is cut at white space and behind its letters; each worker
keeps the codes of a bounded number of such units.

A null or empty text has no tokens and decodes to an empty string. Strings of the special tokens inside
a text give their ids. Rows are independent: ties, repeated rows, empty tables and other columns change
nothing.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolog.llm.common import free_name, ready_for_python, small

#: Units and chunks whose codes a worker remembers (some 200 bytes each).
REMEMBERED = 300_000
#: Longer units are encoded each time, so that the memory of a worker stays bounded.
LONGEST_REMEMBERED = 64
#: Characters of the texts that are looked up together.
RUN_LENGTH = 1 << 16
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters whose case, kind and composition are left to the tokenizer file's own rules: all beyond Latin, Greek and Cyrillic.
FOREIGN = regex.compile("[\u0530-\U0010ffff]")
#: Added to a word's last character, to tell it from the same character inside.
WORD_END = 0x1000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b if b in plain else spare)
        spare += b not in plain
    return out


class Remembering:
    """Codes of texts from the codes of their units, which a worker remembers up to a bound.

    A unit is a chunk between white space, or its letters and the punctuation behind them: no token
    reaches over those borders. Letters are in lower case already, as the vocabulary has no others.
    """

    def __init__(self):
        self.known: dict[str, bytes] = {}

    def encode_units(self, units: list[str]) -> list[bytes]:
        raise NotImplementedError

    def codes(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as bytes of 32-bit integers. Texts go in runs whose chunks fit a core's own memory."""
        runs = np.cumsum([len(t or "") for t in texts]) // RUN_LENGTH
        cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(texts)]
        return [code for a, b in zip(cuts, cuts[1:]) for code in self.run_codes(texts[a:b])]

    def run_codes(self, texts: list[str | None]) -> list[bytes]:
        """:meth:`codes` of a few texts. A chunk that is remembered is looked up once."""
        known = self.known
        cut = [chunks(t or "") for t in texts]
        found = [list(map(known.get, row)) for row in cut]
        gaps = [[k for k, code in enumerate(codes) if code is None] for codes in found]
        split = {row[k]: () for row, own in zip(cut, gaps) for k in own}
        for c in split:
            split[c] = halves(c)
        fresh = list({u for both in split.values() for u in both if u not in known})
        new = dict(zip(fresh, self.encode_units(fresh)))
        for c, both in split.items():
            new[c] = b"".join([known[u] if u in known else new[u] for u in both])
        for codes, row, own in zip(found, cut, gaps):
            for k in own:
                codes[k] = new[row[k]]
        room = REMEMBERED - len(known)
        if room > 0:
            known.update(islice(((u, code) for u, code in new.items() if len(u) <= LONGEST_REMEMBERED), room))
        return [b"".join(codes) for codes in found]


def halves(chunk: str) -> tuple[str, ...]:
    """The letters of a chunk and the ASCII punctuation behind them, or the chunk."""
    if not chunk.isascii() and FOREIGN.search(chunk):  # a letter can become a letter and a mark, which goes with punctuation
        return (chunk,)
    letters = chunk.rstrip(PUNCTUATION)
    whole = len(letters) == len(chunk) or "<|" in chunk or not letters.isalpha() or letters != letters.lower()
    return (chunk,) if whole else (letters, chunk[len(letters):])


class Codec(Remembering):
    def __init__(self, tokenizer_json: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer_json)
        spec = json.loads(tokenizer_json)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        inner = lambda token: token[:-len(end) - 1] + chr(ord(token[-len(end) - 1]) + WORD_END) if token.endswith(end) and token != end else token
        self.symbols = {inner(t): i for t, i in vocab.items()}
        size = 1 + max([*vocab.values(), *self.special.values()])
        #: A token's two halves; a single character has itself twice.
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[int, int] = {}
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            i, j, made = vocab[a], vocab[b], vocab[a + b]
            self.left[made], self.right[made] = i, j
            self.merged[i << 20 | j] = made
        self.length = [0] * size
        self.shorter: list[int | None] = [None] * size  # the longest proper prefix that is a token
        self.found = ahocorasick.Automaton()
        for text, i in self.symbols.items():
            self.length[i] = len(text)
            self.shorter[i] = next((self.symbols[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.symbols), None)
            self.found.add_word(text, (len(text) - 1, i))
        self.found.make_automaton()
        self.compatible: dict[int, bool] = {}
        self.alphabet = byte_characters()
        self.plain = str.maketrans({b: c for b, c in enumerate(self.alphabet[:128])})
        # decoding: all token texts in one array, with where each begins
        texts = [b""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            texts[i] = t.encode() + b" "
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between the two tokens alone."""
        key = a << 20 | b
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) >= 1_000_000:
                self.compatible.clear()
            known = self.compatible[key] = self._border_stays(a, b)
        return known

    def _border_stays(self, a: int, b: int) -> bool:
        """Undo merges next to the border, the later one first; a pair that would have merged earlier breaks it."""
        limit = 1 << 40
        while True:
            if self.merged.get(a << 20 | b, limit) < limit:
                return False
            half_a, half_b = self.right[a], self.left[b]
            if half_a == a and half_b == b:
                return True
            if half_b == b or half_a != a and a > b:
                limit, a = a, half_a
            else:
                limit, b = b + 1, half_b

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word over the inner alphabet."""
        whole = self.symbols.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        longest: list[int | None] = [None] * n
        for at, (before, token) in self.found.iter(word):
            longest[at - before] = token  # later ends are longer
        open_ = bytearray(b"\x01" * (n + 1))
        out: list[int] = []
        at, token = 0, longest[0]
        length, shorter, fits = self.length, self.shorter, self.fits
        while at < n:
            last = out[-1] if out else None
            while token is not None:
                to = at + length[token]
                if open_[to] and (last is None or fits(last, token)):
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at = to
                token = longest[at] if at < n else None
            else:
                open_[at] = 0
                token = out.pop()
                at -= length[token]
        return out

    def words(self, chunk: str) -> Iterator[str]:
        """The words of a chunk without white space, over the inner alphabet.

        Beyond Latin, Greek and Cyrillic the tokenizer file's own normalizer and pre-tokenizer cut the words: they may
        know another Unicode than this Python.
        """
        if not chunk.isascii() and FOREIGN.search(chunk):
            for word, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk)):
                yield word[:-1] + chr(ord(word[-1]) + WORD_END)
            return
        for m in self.pattern.finditer(normal(chunk)):
            word = m[0]
            word = word.translate(self.plain) if word.isascii() else "".join(map(self.alphabet.__getitem__, word.encode()))
            yield word[:-1] + chr(ord(word[-1]) + WORD_END)

    def encode_chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for part in self.special_cut.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                ids.append(self.special[part])
            else:
                for word in self.words(part):
                    ids += self.encode_word(word)
        return np.array(ids, np.int32).tobytes()

    def encode_units(self, units: list[str]) -> list[bytes]:
        return [self.encode_chunk(u) for u in units]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.frombuffer(c, np.int32) for c in self.codes(texts)]

    def decode(self, ids: np.ndarray) -> str:
        """Token texts joined by one space, gathered from the table by their offsets."""
        if not len(ids):
            return ""
        begins, sizes = self.starts[ids], self.starts[np.asarray(ids) + 1] - self.starts[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(begins - ends + sizes, sizes)
        return self.bytes[at[:-1]].tobytes().decode("utf-8", "replace")


_white = regex.compile(r"\s+")
_separators = regex.compile(r"[\x1c-\x1f]")


def normal(text: str) -> str:
    """Composed and in lower case, letter by letter (no final sigma)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def parts(text: str) -> list[str]:
    """A text cut at Unicode white space; Python's own split also cuts at four separators that are none."""
    return [c for c in _white.split(text) if c] if _separators.search(text) else text.split()


def chunks(text: str) -> list[str]:
    """The parts of a text between white space, composed and in lower case where doing that again changes nothing.

    A small letter may have a composed form that its capital lacks: such chunks stay as they are, because
    they are normalised once more when they are encoded. Texts that might hold a special token stay too:
    its letters must not come from lower-casing. So do chunks with characters that :data:`FOREIGN` finds.
    """
    if "<|" in text:
        return parts(text)
    if not text.isascii() and FOREIGN.search(text):
        return [c if FOREIGN.search(c) else once(c) for c in parts(text)]
    low = normal(text)
    if low.isascii() or unicodedata.is_normalized("NFC", low):
        return parts(low)
    return [once(c) for c in parts(text)]


def once(chunk: str) -> str:
    """A chunk as :func:`normal` makes it, if doing that again changes nothing; else as it is."""
    low = normal(chunk)
    return low if low.isascii() or unicodedata.is_normalized("NFC", low) else chunk


@lru_cache(maxsize=1)
def codec(tokenizer_json: str) -> Codec:
    """This worker's codec, kept from task to task."""
    return Codec(tokenizer_json)


def vocabulary(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast; its size is the file's."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *rows]), pa.int32()))


def encoded(text: Column, shared) -> Column:
    """Token ids of a text."""
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(shared.value)
        for texts in small(batches):
            yield lists(own.encode(texts.to_pylist()))

    return encode(text)


def decoded(ids: Column, shared) -> Column:
    """The text of token ids, special tokens included; null gives an empty text."""
    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(shared.value)
        for rows in small(batches):
            yield pa.array([own.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in rows], pa.string())

    return decode(ids)


def encoded_and_decoded(text: Column, shared) -> Column:
    """Token ids of a text and the text of these ids, by one worker with one codec."""
    @F.arrow_udf("struct<ids:array<int>,text:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(shared.value)
        for texts in small(batches):
            ids = lists(own.encode(texts.to_pylist()))
            back = pa.array([own.decode(x.values.to_numpy(zero_copy_only=False)) for x in ids], pa.string())
            yield pa.StructArray.from_arrays([ids, back], ["ids", "text"])

    return both(text)


def with_tokens(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", back: str | None = None) -> DataFrame:
    """``docs`` with the token ids of a column and, if ``back`` is given, their decoded text."""
    ready_for_python(docs.sparkSession)
    shared = vocabulary(docs.sparkSession, path)
    if not back:
        return docs.withColumn(ids, encoded(F.col(text), shared))
    both = free_name(docs, "_both")
    out = docs.withColumn(both, encoded_and_decoded(F.col(text), shared))
    return out.withColumns({ids: F.col(both)["ids"], back: F.col(both)["text"]}).drop(both)
