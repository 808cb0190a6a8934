"""Divergence of sources: distances between the term distributions of groups, by hash-consed segment trees.

Terms are runs of letters and bytes beyond ASCII, A-Z in lower case. A language keeps the terms of at
least ``LEAST_DOCS`` of its documents. With ``count`` occurrences of a term in a group whose kept terms
occur N times, and V kept terms, the group's (or language's) p is
``1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``, in whole numbers throughout.

The kept terms of a language are dealt to blocks by a hash; inside a block their order gives them ids. Over the
ids of a block every group has a segment tree whose leaves are its counts. Trees are hash-consed: level by
level, equal pairs of children get one node, whichever group or place they come from, so stretches with equal
counts (mostly zeros) are shared. Two trees are priced by walking down both at once: pairs of nodes that meet at
several places are met once, with their number, so equal pairs are priced once; at the leaves the pairs of counts are
left, whose distance is the difference of their p. Blocks add up.

Groups of a language meet tile by tile (``TILE`` sources each), so a task holds ``2 * TILE`` groups and one block of about
``BLOCK`` terms, however many sources or terms there are. Occurrences are counted in tasks before they move.

Null text, lang and source are read as ''. Groups without terms take part. Repeated rows count as often as
they occur, each a document of its own; ids aren't used. Ties are in the order of the UTF-8 bytes of the
item. An empty table gives no rows. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolog.llm.common import pieces, ready_for_python, small, small_batches, utf8
from aerolog.llm.units import Units
from aerolog.llm.words import spans, without
from aerolog.session import materialized

LEAST_DOCS = 30
PRIOR, SCALE = 5, 10 ** 9
#: Kept terms of a block, on average, and sources of a tile.
BLOCK, TILE = 4096, 64
#: Ranks of the terms that a group has more of than its language.
TOP = 50
#: Distinct (group, term) rows that a task counts before it passes them on.
HELD = 1 << 19
LETTERS = without((0, 64), (91, 96), (123, 127))
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32


class Counts:
    """Occurrences of terms and documents that hold them, by group."""

    def __init__(self):
        self.terms = Units()
        self.clear()

    def clear(self) -> None:
        self.terms.clear()
        self.texts: list[bytes] = []
        self.groups: dict[tuple[str, str], int] = {}
        self.keys, self.n, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, data: np.ndarray, places: np.ndarray, group_of: np.ndarray) -> None:
        """Count the terms of texts whose groups are given by number."""
        data = SMALL[data]
        begins, ends = spans(data, places, LETTERS)
        if not len(begins):
            return
        ids, new = self.terms.numbers(data, begins, ends)
        raw = data.tobytes()
        self.texts += [raw[b:e] for b, e in zip(begins[new].tolist(), ends[new].tolist())]
        row = np.searchsorted(places, begins, "right") - 1
        in_row, n = np.unique(row << 32 | ids, return_counts=True)
        key = group_of[in_row >> 32] << 32 | in_row & 0xFFFFFFFF
        self.waiting.append((key, n, np.ones(len(n), np.int64)))
        self.size += len(n)
        if self.size > 2 * HELD:
            self.settle()

    def settle(self) -> None:
        """Add up what waits."""
        keys, n, docs = (np.concatenate([own, *(w[k] for w in self.waiting)]) for k, own in enumerate((self.keys, self.n, self.docs)))
        order = np.argsort(keys, kind="stable")
        keys, n, docs = keys[order], n[order], docs[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys = keys[first]
        self.n, self.docs = (np.add.reduceat(x, first) if len(first) else x for x in (n, docs))
        self.waiting, self.size = [], len(first)

    def rows(self) -> pa.RecordBatch:
        self.settle()
        group, term = self.keys >> 32, self.keys & 0xFFFFFFFF
        names = list(self.groups)
        texts = pa.array(self.texts, pa.binary()).cast(pa.string()).take(pa.array(term))
        lang, source = (pa.array([g[k] for g in names], pa.string()).take(pa.array(group)) for k in (0, 1))
        return pa.RecordBatch.from_arrays([lang, source, texts, pa.array(self.n), pa.array(self.docs)], ["lang", "source", "term", "n", "docs"])

    @property
    def full(self) -> bool:
        return self.size > HELD or self.terms.full


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""
    ready_for_python(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Counts()
        for batch in small(batches):
            langs, sources = (pc.fill_null(batch.column(k).cast(pa.string()), "").to_pylist() for k in (0, 1))
            group_of = np.array([own.groups.setdefault(g, len(own.groups)) for g in zip(langs, sources)], np.int64)
            data, places = utf8(batch.column(2))
            for i, j in pieces(places):
                own.add(data[places[i]:places[j]], places[i:j + 1] - places[i], group_of[i:j])
            if own.full:
                own.settle()
                if own.full:
                    yield own.rows()
                    own.clear()
        yield own.rows()

    return (docs.select(F.col(lang).cast("string"), F.col(source).cast("string"), F.col(text)).mapInArrow(count, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def p_of(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """p of some counts, exactly: whole numbers of any length before the division."""
    below = int(total) + PRIOR * int(kept)
    return np.array([1 + SCALE * (int(c) + PRIOR) // below for c in counts], np.int64)


class Trees:
    """Segment trees of some groups over one block, hash-consed.

    ``nodes[k]`` has the node of each group (row) and place on level k, leaves first; ``children[k]`` the two
    nodes below each node of level k + 1. Leaves are numbers of distinct counts; places behind the
    block's terms are the leaf 0.
    """

    def __init__(self, counts: np.ndarray):
        groups, n = counts.shape
        width = 1 << max(n - 1, 0).bit_length()
        self.values, leaf = np.unique(counts, return_inverse=True)
        nodes = np.zeros((groups, width), np.int64)
        nodes[:, :n] = leaf.reshape(groups, n) + 1
        self.children: list[np.ndarray] = []
        while nodes.shape[1] > 1:
            pairs = nodes[:, 0::2] << 32 | nodes[:, 1::2]
            found, numbers = np.unique(pairs, return_inverse=True)
            self.children.append(np.stack([found >> 32, found & 0xFFFFFFFF], axis=1))
            nodes = numbers.reshape(pairs.shape)
        self.roots = nodes[:, 0]

    def leaf_pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(walk, leaf of a, leaf of b, times) of simultaneous walks down the trees of groups ``a`` and ``b``.

        On every level a pair of nodes that a walk meets at several places is kept once, with their number.
        """
        walk, left, right, times = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), np.int64)
        for children in reversed(self.children):
            walk, times = np.repeat(walk, 2), np.repeat(times, 2)
            left, right = children[left].ravel(), children[right].ravel()
            order = np.lexsort((right, left, walk))
            walk, left, right, times = walk[order], left[order], right[order], times[order]
            new = np.concatenate([[True], (walk[1:] != walk[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
            at = np.flatnonzero(new)
            walk, left, right, times = walk[at], left[at], right[at], np.add.reduceat(times, at)
        return walk, left, right, times

    def prices(self, a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
        """The sum of abs(p - q) over the block for pairs of groups; ``p`` by group and leaf."""
        out = np.zeros(len(a), np.int64)
        step = max(1, (1 << 20) // (2 << len(self.children)))  # walks whose leaves fit some MB
        for i in range(0, len(a), step):
            walk, left, right, times = self.leaf_pairs(a[i:i + step], b[i:i + step])
            real = left > 0  # behind the terms both are 0
            walk, left, right, times = walk[real], left[real], right[real], times[real]
            np.add.at(out, i + walk, np.abs(p[a[i + walk], left] - p[b[i + walk], right]) * times)
        return out


def block_prices(frame: pd.DataFrame, lang: str, row_tile: int, column_tile: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """What one block adds to the distances of two tiles' sources, and its top terms of the sources of a tile with itself."""
    whole = frame["term"].isna()
    groups = frame[whole].drop_duplicates("source").sort_values("source").reset_index(drop=True)
    rows = frame[~whole]
    terms = np.array(sorted(rows["term"].unique(), key=lambda t: t.encode()), object)
    kept = int(groups["kept"].iloc[0])
    group = pd.Index(groups["source"]).get_indexer(rows["source"])
    term = pd.Index(terms).get_indexer(rows["term"]) if len(terms) else np.zeros(0, np.int64)
    # terms of the block that occur in no group of these tiles stand behind, with zeros; the last row is the language
    size = int(groups["size"].iloc[0])
    counts = np.zeros((len(groups) + 1, size), np.int64)
    counts[group, term] = rows["n"].to_numpy(np.int64)
    counts[-1, term] = rows["lang_n"].to_numpy(np.int64)
    n = len(groups)
    tile = groups["tile"].to_numpy()
    a, b = np.triu_indices(n, 1)
    if row_tile != column_tile:
        a, b = a[tile[a] != tile[b]], b[tile[a] != tile[b]]
    totals = [*groups["total"].tolist(), int(groups["lang_total"].iloc[0])]
    if size:
        trees = Trees(counts)
        p = np.zeros((n + 1, len(trees.values) + 1), np.int64)
        for k, total in enumerate(totals):
            used = np.unique(counts[k])
            p[k, 1 + np.searchsorted(trees.values, used)] = p_of(used, total, kept)
        value = trees.prices(a, b, p)
    else:
        value = np.zeros(len(a), np.int64)
    source = groups["source"].to_numpy()
    pairs = pd.DataFrame({"lang": lang, "source": np.concatenate([source[a], source[b]]), "item": np.concatenate([source[b], source[a]]), "value": np.tile(value, 2)})
    tops = []
    if len(terms) and row_tile == column_tile:
        # the walk of a group with its language, leaf by leaf: only terms that occur in the group can count
        leaf = np.searchsorted(trees.values, counts) + 1
        for k in range(n):
            own = np.flatnonzero(counts[k])
            more = p[k, leaf[k, own]] - p[n, leaf[n, own]]
            own, more = own[more > 0], more[more > 0]
            best = np.lexsort((own, -more))[:TOP]
            tops.append(pd.DataFrame({"lang": lang, "source": source[k], "item": terms[own[best]], "value": more[best]}))
    return pairs, pd.concat(tops) if tops else pairs.iloc[:0]


def audited(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources of the language, and the terms that the source has more of."""
    with small_batches(docs.sparkSession):
        counted = materialized(term_counts(docs, lang, source, text))
    terms = materialized(counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= LEAST_DOCS)
                         .select("lang", "term", "lang_n"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    blocks = F.greatest(F.lit(1), F.ceil(F.coalesce("kept", F.lit(0)) / BLOCK)).cast("int")
    kept = materialized(counted.select("lang", "source", "term", "n").join(terms, ["lang", "term"]))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct()
              .join(totals, ["lang", "source"], "left").join(langs, "lang", "left"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = materialized(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"),
                                        F.coalesce("lang_total", F.lit(0)).alias("lang_total"), blocks.alias("blocks"), F.floor(number / TILE).cast("int").alias("tile")))
    tiles = groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))
    groups = groups.join(tiles, "lang")
    # each group meets its block in all tiles; blocks without a term of the group hold its zeros
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    sizes = terms.join(langs.select("lang", blocks.alias("blocks")), "lang").groupBy("lang", block).agg(F.count("*").alias("size"))
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(sizes, ["lang", "block"], "left").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("lang_n"), "total", "kept", "lang_total",
        F.coalesce("size", F.lit(0)).alias("size"), "tile", "tiles", "block")
    own = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "lang_n", "total", "kept", "lang_total", F.lit(0).cast("long").alias("size"), "tile", "tiles", block)
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    met = every.unionByName(own).withColumn("other", other).select(
        "lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "source", "term", "n", "lang_n", "total", "kept", "lang_total", "size", "tile")

    def price(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        name, _, low, high = key
        pairs, tops = block_prices(frame, name, low, high)
        return pd.concat([pairs.assign(part="pair"), tops.assign(part="term")])[["lang", "source", "part", "item", "value"]]

    priced = materialized(met.groupBy("lang", "block", "low", "high").applyInPandas(price, "lang string, source string, part string, item string, value long"))
    summed = priced.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = summed.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP))
