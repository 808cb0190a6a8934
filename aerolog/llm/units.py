"""Units of many texts at once: a number for each distinct run of bytes, without a Python loop over them.

A worker meets the same words again and again. :class:`Units` numbers distinct runs of bytes: runs of up
to ``SHORT`` bytes are told apart by three 64-bit words that hold all their bytes and their length, longer
ones by themselves, so two units never share a number. :class:`Codes` keeps what an encoder made of each
unit and puts the codes of whole texts together by one gather.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from aerolog.llm.words import SPACED, mix, spans

#: The longest unit whose bytes and length fit three 64-bit words.
SHORT = 23
#: Units after which a worker forgets all and begins anew, and bytes of longer ones.
REMEMBERED = 900_000
REMEMBERED_BYTES = 1 << 24
#: The low bytes of a word that belong to a unit, by their number.
LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Units:
    """Numbers of distinct units, from 0."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.n, self.long_bytes = 0, 0
        self.long: dict[bytes, int] = {}
        self.keys = np.zeros((1 << 12, 3), np.uint64)
        self.slots = np.full(1 << 14, -1, np.int32)

    @property
    def full(self) -> bool:
        return self.n >= REMEMBERED or self.long_bytes >= REMEMBERED_BYTES

    def numbers(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each unit ``data[begin:end]``, and the places (in ``begins``) of those that are new, in order of their numbers."""
        out = np.full(len(begins), -1, np.int32)
        sizes = ends - begins
        short = np.flatnonzero(sizes <= SHORT)
        fresh = [self._short(data, begins, sizes, short, out)]
        own = []
        for k in np.flatnonzero(sizes > SHORT):
            unit = data[begins[k]:ends[k]].tobytes()
            number = self.long.get(unit)
            if number is None:
                number = self.long[unit] = self.n
                self.n += 1
                self.long_bytes += len(unit)
                own.append(k)
            out[k] = number
        return out, np.concatenate([*fresh, np.array(own, np.int64)])

    def _short(self, data, begins, sizes, places, out) -> np.ndarray:
        if not len(places):
            return places
        padded = np.concatenate([data, np.zeros(24, np.uint8)])
        words = np.ndarray(len(padded) - 7, "<u8", padded, 0, (1,))
        at, size = begins[places], sizes[places]
        keys = np.stack([words[np.minimum(at + 8 * k, len(words) - 1)] & LOW[np.clip(size - 8 * k, 0, 8)] for k in range(3)], axis=1)
        keys[:, 2] |= size.astype(np.uint64) << np.uint64(56)
        hashes = hashed(keys)
        found = self._find(keys, hashes)
        first = []
        while True:
            missing = np.flatnonzero(found < 0)
            if not len(missing):
                break
            # one of each hash is added; others of the same hash are looked up again
            chosen = missing[np.unique(hashes[missing], return_index=True)[1]]
            chosen.sort()
            self._add(keys[chosen], hashes[chosen])
            first.append(places[chosen])
            found[missing] = self._find(keys[missing], hashes[missing])
        out[places] = found
        return np.concatenate([np.zeros(0, np.int64), *first])

    def _find(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.slots) - 1)
        found = np.full(len(keys), -1, np.int32)
        open_, slot = np.arange(len(keys)), (hashes & mask).astype(np.int64)
        while len(open_):
            there = self.slots[slot]
            same = (there >= 0) & (self.keys[there] == keys[open_]).all(axis=1)
            found[open_[same]] = there[same]
            on = (there >= 0) & ~same
            open_, slot = open_[on], (slot[on] + 1) & int(mask)
        return found

    def _add(self, keys: np.ndarray, hashes: np.ndarray) -> None:
        numbers = np.arange(self.n, self.n + len(keys))
        self.n += len(keys)
        while self.n > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)])
        self.keys[numbers] = keys
        if 2 * self.n > len(self.slots):
            while 2 * self.n > len(self.slots):
                self.slots = np.full(4 * len(self.slots), -1, np.int32)
            numbers = np.flatnonzero(self.keys[:self.n, 2] >> np.uint64(56))  # longer units have no key
            hashes = hashed(self.keys[numbers])
        mask = len(self.slots) - 1
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        while len(numbers):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = numbers[free]
            on = self.slots[slot] != numbers
            numbers, slot = numbers[on], (slot[on] + 1) & mask


def hashed(keys: np.ndarray) -> np.ndarray:
    return mix(mix(mix(keys[:, 0]) + keys[:, 1]) + keys[:, 2])


class Codes:
    """The codes of texts from the codes of their units.

    ``encode`` gives the ids of each of some units (bytes). Where a text may be cut is the caller's
    affair: the ids of a text must be those of its units, one after the other.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[np.ndarray]]):
        self.encode, self.units = encode, Units()
        self._clear()

    def _clear(self) -> None:
        self.units.clear()
        self.used = 0
        self.ids = np.zeros(1 << 12, np.int32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)

    def __call__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, and where each unit's ids begin (and the end of all)."""
        if self.units.full:
            self._clear()
        before = self.units.n
        numbers, new = self.units.numbers(data, begins, ends)
        if len(new):
            raw = data.tobytes()
            self._keep(before, self.encode([raw[b:e] for b, e in zip(begins[new].tolist(), ends[new].tolist())]))
        lengths = self.lengths[numbers]
        places = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[np.arange(places[-1]) + np.repeat(self.starts[numbers] - places[:-1], lengths)], places

    def _keep(self, before: int, codes: list[np.ndarray]) -> None:
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        while before + len(codes) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + sizes.sum() > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        ends = self.used + np.cumsum(sizes)
        self.starts[before:before + len(codes)], self.lengths[before:before + len(codes)] = ends - sizes, sizes
        if len(codes):
            self.ids[self.used:ends[-1]] = np.concatenate(codes)
            self.used = int(ends[-1])


#: Kinds of bytes between which a word tokenizer always cuts: letters, digits, punctuation. Others have none.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[48:58] = 2
KINDS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3


def word_units(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units for a tokenizer that composes and lower-cases texts and parts letters, digits and all else; their begins and ends.

    Texts are cut at ASCII white space and between letters (up to U+00FF), ASCII digits and ASCII punctuation, but not behind
    an apostrophe, which takes letters to itself. A-Z become small where no byte beyond ASCII follows,
    which might be a mark to be composed with the capital. Chunks with ``<|``, which can be a special
    token, stay as they are. Returns the bytes, too.
    """
    begins, ends = spans(data, places, SPACED)
    if not len(begins):
        return data, begins, ends
    after = np.append(data[1:], 0).astype(np.uint8)
    special = np.searchsorted(begins, np.flatnonzero((data == 60) & (after == 124)), "right") - 1
    capital = (data >= 65) & (data <= 90) & (after < 128)
    kinds = KINDS[data]
    latin = np.flatnonzero((data == 0xC3) & (after != 0x97) & (after != 0xB7))  # U+00C0 to U+00FF, but for two signs
    kinds[latin] = kinds[latin + 1] = 1
    cut = (kinds[1:] != kinds[:-1]) & (kinds[1:] > 0) & (kinds[:-1] > 0) & (data[:-1] != 39)
    for k in np.unique(special).tolist():
        capital[begins[k]:ends[k]] = False
        cut[begins[k]:ends[k] - 1] = False
    inner = np.flatnonzero(cut) + 1
    inner = inner[~np.isin(inner, places)]  # rows stand side by side
    data = data + 32 * capital.astype(np.uint8)
    return data, np.sort(np.concatenate([begins, inner])), np.sort(np.concatenate([ends, inner]))


def by_row(begins: np.ndarray, places: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where each row's ids begin (and the end of all), from where its units' do."""
    return places[np.searchsorted(begins, rows)]
