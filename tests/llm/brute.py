"""Plain versions of the operators' contracts, row by row."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def contamination(docs, items, window=10):
    """docs and items: (id, text) pairs; per document (n_words, n_hit, items)."""
    wanted = {}
    for item, text in items:
        w = alnum_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(k) for k in wanted}
    out = []
    for _, text in docs:
        w = alnum_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (own := wanted.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((len(w), len(hit), sorted(found)))
    return out


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = spaced_words(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if spaced_words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def shingles(text):
    w = spaced_words(lower(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(sets, least=75):
    """sets: {id: set}; {id: smallest id of its component}."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    for i, s in sets.items():
        shared = Counter(j for x in s for j in index[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= least * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc32(data):
    return zlib.crc32(data)
