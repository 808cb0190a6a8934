"""Units, packing, alignment of tokenizers and divergence of sources against plain versions."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerolog.llm import alignment, divergence, packing, queries, token_files, units
from aerolog.llm.common import utf8

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string, lang string, source string, n long, term string, `row` string, lot string, ids string"


def rows():
    """Nulls, empty and long texts, repeated rows and ids, odd characters, and a source with most of the rows."""
    draw = random.Random(11)
    word = lambda: draw.choice(["alpha", "Beta", "gamma's", "délta", "ΣΑΣ", "éx", "12,5", "中文字", "😀", "ALPHA", "the"])
    text = lambda n: draw.choice([" ", "\n", "  "]).join(word() for _ in range(n))
    out = [(0, None, "en", "a"), (1, "", "en", None), (2, "  \n", None, "a"), (3, "x▁y", "en", "b"), (4, "<|endoftext|> <s> <0x41>", "en", "b"), (5, "\x00\x1c\x85  a", "", "b"),
           (None, text(9), "en", "a"), (6, text(30), "fr", ""), (6, text(30), "fr", ""), (7, "same", "en", "a"), (7, "same", "en", "a"), (8, text(4000), "en", "big"), (9, "y" * 3000, None, None)]
    return out + [(100 + k, text(draw.randrange(60)), draw.choice(["en", "fr"]), "big" if draw.random() < 0.5 else draw.choice("abcdefg")) for k in range(200)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "t", "r", "l", "i") for r in rows()], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_units_are_told_apart_exactly():
    draw = random.Random(1)
    own, known, found = units.Units(), {}, {}
    for _ in range(30):
        parts = ["".join(draw.choice("ab\x00é") for _ in range(draw.choice([1, 2, 8, 22, 23, 24, 60]))).encode()[:draw.choice([1, 23, 99])] for _ in range(900)]
        data, ends = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
        numbers, new = own.numbers(data, ends - np.array([len(p) for p in parts]), ends)
        for k in new.tolist():
            assert parts[k] not in known
            known[parts[k]] = len(known)
        assert [known[p] for p in parts] == numbers.tolist()
    assert own.n == len(known) > 5000 and len(own.slots) > 1 << 14
    assert own.numbers(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))[0].tolist() == []
    assert not found


def test_texts_cut_into_units_are_encoded_as_whole_texts(monkeypatch):
    """Also when a worker forgets its units in between."""
    monkeypatch.setattr(units, "REMEMBERED", 500)
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        library = token_files.Library(f.read())
    bits = ["a", "Z", "J̌", "É", "ß", "×", "'s", "'", "''", "'LL", " ", "\n", "\x0b", "\x1c", "\x85", "　", "́", "İ", "Σ", "12", "½", ".", "!", "<|", "|>", "<|endoftext|>",
            "<|ENDOFTEXT|>", "中", "。", "ﬁ", "՘", "n't", "’s", "x" * 30]
    draw = random.Random(3)
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(30))) for _ in range(6000)] + [None, ""]
    for k in range(0, len(texts), 500):
        got = library.encode(pa.array(texts[k:k + 500], pa.string()), 9, "<u2").to_pylist()
        for text, ids in zip(texts[k:], got):
            assert np.frombuffer(ids, "<u2").tolist() == [*library.tokenizer.encode(text or "", add_special_tokens=False).ids, 9], repr(text)


def whole_and_gapless(pieces, texts, size):
    """Every id of every row in one piece, sequences without gaps, full but for powers of two."""
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        library = token_files.Library(f.read())
    want = collections.Counter((d, s, bytes(i)) for (d, s), i in zip(((d, s) for d, _, s in texts), library.encode(pa.array([t for _, t, _ in texts], pa.string()), 2, "<u2").to_pylist()))
    sequences = collections.defaultdict(list)
    cut = collections.defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        cut[p["doc_id"], p["source"], p["doc_tokens"]].append((p["start"], bytes(p["ids"])))
        assert len(p["ids"]) == 2 * p["length"] > 0
    lengths = []
    for k in range(len(sequences)):
        at = 0
        for offset, length in sorted(sequences[k]):
            assert offset == at
            at += length
        lengths.append(at)
    assert all(n == size or n & (n - 1) == 0 for n in lengths) and sorted(lengths, reverse=True) == lengths
    assert len(set(lengths) - {size}) == sum(n != size for n in lengths)  # each power once
    made = collections.Counter()
    for (d, s, n), parts in cut.items():
        parts.sort(key=lambda x: x[0])
        starts = [a for a, _ in parts]
        times = starts.count(0)
        if times == 1:
            assert starts == [sum(len(x) // 2 for _, x in parts[:k]) for k in range(len(parts))]
            made[d, s, b"".join(x for _, x in parts)] += 1
        else:  # copies of one id: each place is covered as often
            covered = np.zeros(n, int)
            ids = np.zeros(n, int)
            for a, x in parts:
                covered[a:a + len(x) // 2] += 1
                ids[a:a + len(x) // 2] = np.frombuffer(x, "<u2")
            assert set(covered) == {times}
            made[d, s, ids.astype("<u2").tobytes()] += times
    assert made == want


@pytest.mark.parametrize("size,targets", [(4096, None), (256, None), (128, {"a": 0.5, None: 0.1, "absent": 3.0}), (128, {s: 1.0 for s in [None, "", "big", *"abcdefg"]})])
def test_packing_places_every_token_once(spark, docs, size, targets):
    out = packing.packed(docs, queries.tokenizer_path(), 2, size=size, targets=targets)
    whole_and_gapless(out.collect(), [(d, t, s) for d, t, _, s in rows()], size)


def test_packing_of_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(packing, "COPIES", 20)
    texts = [(5, "all the same row " * 20, "a")] * 90 + [(k, f"row {k}", "b") for k in range(50)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(3)
    whole_and_gapless(packing.packed(df, queries.tokenizer_path(), 2, size=512).collect(), texts, 512)


def test_windows_have_the_target_proportions(spark):
    draw = random.Random(2)
    texts = [(k, " ".join(draw.choice(["alpha", "beta", "gamma"]) for _ in range(draw.choice([3, 30, 900]))), draw.choice("aaaaabbc")) for k in range(600)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string")
    out = packing.packed(df, queries.tokenizer_path(), 2).groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).toPandas()
    n = out.pivot(index="sequence_id", columns="source", values="n").fillna(0)
    full = n[n.sum(axis=1) == 4096]
    share = n.sum() / n.sum().sum()
    assert len(full) > 20 and ((full - 4096 * share).abs() <= 2).all().all()
    # asked for: halves, until one source runs dry
    asked = packing.packed(df, queries.tokenizer_path(), 2, targets={"a": 1.0, "b": 1.0, "c": 2.0}).groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).toPandas()
    n = asked.pivot(index="sequence_id", columns="source", values="n").fillna(0)
    dry = n.index[n["c"] > 0].max()
    assert dry > 3 and ((n.loc[:dry - 1] - [1024, 1024, 2048]).abs() <= 2).all().all()
    later = n.loc[dry + 1:n.index[n["b"] > 0].max() - 1]
    assert ((later[["a", "b"]] - 2048).abs() <= 3).all().all()
    with pytest.raises(ValueError):
        packing.packed(df, queries.tokenizer_path(), 2, targets={"a": 0.0})


def test_small_sources_save_their_quanta(spark):
    """Two hundred sources of a window of 256: packets of LEAST tokens, spread over all windows."""
    texts = [(k, f"word{k} " * 40, f"s{k % 200}") for k in range(800)]
    out = packing.packed(spark.createDataFrame(texts, "doc_id long, text string, source string"), queries.tokenizer_path(), 2, size=256).toPandas()
    assert (out["length"] >= 32).mean() > 0.5
    first = out.groupby("source")["sequence_id"].min()
    assert first.nunique() > 40  # not all at once


def test_sequences_hold_their_pieces(spark, docs, none):
    pieces = packing.packed(docs, queries.tokenizer_path(), 2, size=256)
    by = collections.defaultdict(list)
    for p in pieces.collect():
        by[p["sequence_id"]].append((p["offset"], p["doc_id"], p["start"], np.frombuffer(p["ids"], "<u2").tolist()))
    for r in packing.sequences(pieces).collect():
        own = sorted(by.pop(r["sequence_id"]), key=lambda p: p[0])
        assert r["ids"] == [i for p in own for i in p[3]]
        assert [(p["doc_id"], p["start"]) for p in r["pieces"]] == [(p[1], p[2]) for p in own]
    assert not by
    assert packing.packed(none, queries.tokenizer_path(), 2).count() == 0
    crc = pieces.select("ids", packing.ids_crc32(F.col("ids"), "<u2").alias("c")).first()
    assert crc["c"] == zlib.crc32(np.frombuffer(crc["ids"], "<u2").astype("<u4").tobytes())
    assert packing.tail_cuts(2 * 4096 + 2070, 4096) == [8192, 8192 + 2048, 8192 + 2064, 8192 + 2068, 8192 + 2070] and packing.tail_cuts(0, 8) == [0]


def plain_alignment(text, a, b, tokenizer, model):
    """(A ids, B ids, links, groups) by comparing all pairs of tokens."""
    if not text:
        return [], [], [], ""
    x, y = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    if any(b"".join(side.tokens[i] for i in ids) != (" " + text).encode() for side, ids in ((a, x), (b, y))):
        return [], [], [], ""
    ends = [np.cumsum([len(side.tokens[i]) for i in ids]).tolist() for side, ids in ((a, x), (b, y))]
    starts = [[0, *e[:-1]] for e in ends]
    links = [(i, j) for i in range(len(x)) for j in range(len(y)) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
    cuts, groups = [0, *sorted({*ends[0]} & {*ends[1]})], []
    for low, high in zip(cuts, cuts[1:]):
        groups.append("|".join(",".join(str(i) for i, e in zip(ids, end) if low < e <= high) for ids, end in zip((x, y), ends)))
    return x, y, links, ";".join(groups)


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        spec, model = f.read(), g.read()
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.encode_special_tokens = True
    return (*alignment.sides(spec, model), tokenizer, sentencepiece.SentencePieceProcessor(model_proto=model))


def test_alignment_of_odd_texts_equals_all_pairs(both):
    a, b = both[:2]
    bits = ["a", "b", "the", " the", "ing", "é", "É", "ß", "\n", "\n\n", " ", "  ", "\t", "\r\n", "\x00", "\x1c", "\x85", " ", " ", "　", "’", "—", "中", "。", "😀", "▁", "<s>", "<0x41>",
            "<|endoftext|>", "12", "$%", "'s", "don't", "x" * 40, "́", "ﬁ", "�"]
    draw = random.Random(5)
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(25))) for _ in range(1500)] + [None, "", " ", "  ", "\n"]
    names = ("n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "a_ids", "b_ids", "link_a", "link_b")
    for k in range(0, len(texts), 300):
        out = {c: v.to_pylist() for c, v in alignment.outputs(alignment.Aligned(pa.array(texts[k:k + 300], pa.string()), a, b), "<u4", 16, names).items()}
        for i, text in enumerate(texts[k:k + 300]):
            x, y, links, groups = plain_alignment(text, *both)
            assert (out["a_ids"][i], out["b_ids"][i], sorted(zip(out["link_a"][i], out["link_b"][i])), out["groups"][i]) == (x, y, links, groups), repr(text)
            assert (out["n_a"][i], out["n_b"][i], out["n_links"][i]) == (len(x), len(y), len(links))
            assert out["n_groups"][i] == (groups.count(";") + 1 if groups else 0)
            assert out["groups_sha256"][i] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


@pytest.mark.parametrize("sent", [0, 7, 1 << 19])
def test_alignment_counts_links_over_all_documents(spark, docs, none, both, sent):
    short = [(d, t) for d, t, _, _ in rows() if len(t or "") < 2000]
    df = spark.createDataFrame(short, "doc_id long, text string")
    plain = [plain_alignment(t, *both) for _, t in short]
    pairs = [[(x[i], y[j]) for i, j in links] for x, y, links, _ in plain]
    count = collections.Counter(p for own in pairs for p in own)
    best = collections.defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    want = sorted((str(d), len(x), len(y), len(p), sum(count[q] == best[q[1]] for q in p), sum(count[q] for q in p)) for (d, _), (x, y, _, _), p in zip(short, plain, pairs))
    got = [(str(r["doc_id"]), r["n_a"], r["n_b"], r["n_links"], r["n_best"], r["count_sum"]) for r in alignment.digests(df, A, B, most_sent=sent).collect()]
    assert sorted(got) == want
    if not sent:
        assert alignment.digests(none, A, B).count() == 0 and alignment.digests(docs, A, B).count() == docs.count()


def plain_divergence(texts, least):
    pattern, low = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    count, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in texts:
        words = pattern.findall((text or "").encode().translate(low))
        count[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = set()
    for lang in {g[0] for g in count}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (own, s), c in count.items() if own == lang}
        whole = collections.Counter()
        for c in groups.values():
            whole.update(c)
        p = {s: {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept} for s, c in [*groups.items(), (None, whole)]}
        for s, c in groups.items():
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            terms = sorted((p[None][t] - p[s][t], t) for t in kept if c[t] and p[s][t] > p[None][t])[:50]
            out |= {(lang, s, part, item.decode(), -v, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (v, item) in enumerate(found)}
    return out


@pytest.mark.parametrize("least,block,tile", [(2, 4096, 64), (1, 4, 2), (3, 1, 1), (10_000, 4096, 64)])
def test_divergence_equals_plain_sums(spark, docs, none, monkeypatch, least, block, tile):
    for name, value in (("LEAST_DOCS", least), ("BLOCK", block), ("TILE", tile)):
        monkeypatch.setattr(divergence, name, value)
    out = divergence.audited(docs)
    got = [tuple(r) for r in out.select("lang", "source", "part", "item", "value", "rank").collect()]
    want = plain_divergence([(t, lang, s) for _, t, lang, s in rows()], least)
    assert len(got) == len(want) and set(got) == want
    if tile == 64:
        assert divergence.audited(none).count() == 0


def test_trees_share_equal_stretches_and_price_exactly():
    draw = np.random.default_rng(1)
    counts = draw.integers(0, 3, (7, 45)) * (draw.random((7, 45)) < 0.3)
    counts[1] = counts[0]
    trees = divergence.Trees(counts)
    assert trees.roots[0] == trees.roots[1] and max(len(c) for c in trees.children) < 7 * 32
    p = draw.integers(0, 1000, (7, len(trees.values) + 1))
    a, b = np.triu_indices(7, 1)
    leaf = np.searchsorted(trees.values, counts) + 1
    assert trees.prices(a, b, p).tolist() == [int(np.abs(p[x, leaf[x]] - p[y, leaf[y]]).sum()) for x, y in zip(a, b)]
    zeros = divergence.Trees(np.zeros((2, 1000), np.int64))
    _, _, _, times = zeros.leaf_pairs(np.array([0]), np.array([1]))
    assert len(times) <= 2 and all(len(c) <= 3 for c in zeros.children)  # one pair of counts, one pair behind the terms
    assert divergence.p_of(np.array([10 ** 13]), 10 ** 14, 10 ** 6).tolist() == [1 + 10 ** 9 * (10 ** 13 + 5) // (10 ** 14 + 5 * 10 ** 6)]


def test_counting_passes_on_what_it_holds(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    own, total = divergence.Counts(), collections.Counter()
    draw = random.Random(4)
    for _ in range(20):
        texts = [" ".join(draw.choice(["a", "B", "b", "c1d", "é", "long" * 9]) for _ in range(9)) for _ in range(5)]
        total.update(w for t in texts for w in re.findall("[a-zé]+", t.lower()))
        own.groups.setdefault(("en", "s"), 0)
        own.add(*utf8(pa.array(texts)), np.zeros(5, np.int64))
    out = own.rows()
    assert dict(zip(out.column(2).to_pylist(), out.column(3).to_pylist())) == total
