"""Each operator and stage against a plain version, on small tables with every awkward case."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerolog.llm import bpe, decontaminate, html_wrapper, line_dedup, links, near_dedup, oracle, quality_cnn, quality_rules, queries, sharding, token_files, toxicity
from aerolog.session import scratch_folder
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, _id long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def passage(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(50)) for _ in range(n))


def documents():
    """(id, text): nulls, empty and long texts, copies, near copies, repeated rows and passages."""
    base = passage(1, 120)
    near = " ".join(w if k != 60 else "changed" for k, w in enumerate(base.split()))
    rows = [(0, base), (1, near), (2, base), (3, None), (4, ""), (5, "   \n\n"), (6, "one two"), (7, "one two"), (8, passage(2, 4000)),
            (9, passage(3, 30) + " " + passage(4, 25) + "\n" + passage(5, 12)), (10, passage(6, 40) + "\n" + passage(5, 12)),
            (11, "%%% *** THE END!! " * 30), (12, "É à ü " + passage(7, 20).upper()), (13, "Short Item Here again"), (13, "Short Item Here again"),
            (None, passage(8, 50)), (14, "same words same words same words same words same words"), (15, "\x00\x1c a b <|endoftext|> 12,5 İ. Σ")]
    return rows + [(20 + k, passage(100 + k, 30 + k)) for k in range(30)]


ITEMS = [(1, passage(4, 25)), (2, passage(4, 25)), (3, "short item HERE"), (4, None), (5, ""), (6, passage(999, 15)), (7, passage(3, 30)[:90])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1.0, "x", 9) for d, t in documents()], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(d, int(d != 11), int(d % 3 == 0)) for d, _ in documents() if d is not None]
    return spark.createDataFrame([*rows, (0, 1, 0), (999, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")


def test_shards_are_even_and_places_gapless(spark, docs, none):
    out = sharding.sharded(docs, 5, f"{scratch_folder(spark)}/map").collect()
    assert len(out) == len(documents())
    for shard in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))
    assert sorted((r["size"], r["text_crc32"]) for r in out) == sorted((16 + len((t or "").encode()), brute.crc32((t or "").encode())) for _, t in documents())
    assert sharding.sharded(none, 5, f"{scratch_folder(spark)}/map").count() == 0


def test_rebalancing_moves_few_slots(spark):
    sizes = {s: (100 + s % 7, 1) for s in range(200)}
    first = sharding.first_map(sizes, 8, 200)
    assert sharding.rebalanced(first, sizes, 8)[0][0] == 2
    grown = sharding.rebalanced(first, sizes, 9)
    moved = [(a[2], b[2]) for a, b in zip(first, grown) if a[2] != b[2]]
    assert len(moved) < 45 and sum(to == 8 for _, to in moved) >= 20
    shrunk = sharding.rebalanced(grown, sizes, 8)
    assert {r[2] for r in shrunk} == set(range(8))
    folder = scratch_folder(spark)
    sharding.write_map(spark, first, folder)
    sharding.write_map(spark, grown, folder)
    assert sharding.read_map(spark, folder, 1).count() == sharding.read_map(spark, folder, 2).count() == 200


def test_contamination_equals_plain_search(docs, none, items):
    want = brute.contamination(documents(), ITEMS)
    got = decontaminate.hits(docs, items).collect()
    assert sorted((r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == sorted((n, h, tuple(i)) for n, h, i in want)
    assert {r["doc_id"]: r["n_hit"] for r in got}[9] >= 25
    assert decontaminate.hits(none, items).count() == 0
    assert decontaminate.hits(docs, items.limit(0)).where("n_hit > 0").count() == 0
    clean = decontaminate.without_hits(docs, items)
    assert clean.columns == docs.columns and clean.count() == sum(h == 0 for _, h, _ in want)


def test_fingerprints_are_the_last_smallest_hashes(spark):
    draw = random.Random(9)  # few words, so that hashes of runs come again inside a window
    texts = [" ".join(draw.choice("ab") for _ in range(n)) for n in (0, 3, 9, 10, 11, 40, 200)] + [passage(31, 80), "x " * 50]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    w = decontaminate.WINDOW - decontaminate.K + 1
    for r in decontaminate.with_hashes(rows, "t", ["k"], []).collect():
        runs = r["_runs"]
        assert len(runs) == max(0, len(texts[r["k"]].split()) - decontaminate.K + 1)
        want = [max(range(i, i + w), key=lambda j: (-runs[j], j)) for i in range(len(runs) - w + 1)]
        assert r["_places"] == list(dict.fromkeys(want))


def test_windows_are_made_of_known_fingerprints_only(docs, items):
    plan = decontaminate.hits(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    joined = next(i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter, (print#" in line)
    above, below = plan.splitlines()[:joined], plan.splitlines()[joined:]
    assert any("start, " in line for line in above) and not any("named_struct(start" in line or "struct(start" in line for line in below)


def test_a_codec_a_task_encodes_and_decodes(docs):
    out = bpe.with_tokens(docs, queries.tokenizer_path(), back="decoded")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    shared = bpe.vocabulary(docs.sparkSession, queries.tokenizer_path())
    apart = docs.withColumn("ids", bpe.encoded(F.col("text"), shared)).withColumn("decoded", bpe.decoded(F.col("ids"), shared))
    assert out.columns == apart.columns and out.schema["decoded"] == apart.schema["decoded"]
    one, other = (sorted((str(r) for r in x.select("doc_id", "ids", "decoded").collect())) for x in (out, apart))
    assert one == other


def test_measures_equal_plain_ones(docs, none, labels):
    got = quality_rules.judged(docs, labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(brute.measures(t) for _, t in documents())
    assert all(r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) for r in got)
    assert quality_rules.judged(none, labels).count() == 0


def test_cutoffs_keep_their_promise(spark):
    assert quality_rules.tail(0, 100, 0.05) == pytest.approx(0.95 ** 100)
    assert quality_rules.tail(3, 50, 0.1) == pytest.approx(sum(np.prod([(50 - j) / (j + 1) for j in range(i)]) * 0.1 ** i * 0.9 ** (50 - i) for i in range(4)))
    few = spark.range(2000).selectExpr("100L as n_words", "500L as word_chars", "if(id % 400 = 0, 60L, 0L) as n_symbols", "0L as n_dup_lines",
                                       "0L as n_repeat_words", "id % 2 * 60 as n_capitals", "1L as n_lines", "1 as good")
    chosen = quality_rules.cutoffs(few)
    assert chosen[1, "symbols"] == 0.05  # 0.25 % are lost, which the bound allows
    assert chosen[1, "shouting"] == 0.2  # below it half of the good texts would go
    assert quality_rules.cutoffs(few.limit(50)) == {}


def test_near_copies_equal_plain_components(docs, none):
    rows = [(d, t) for d, t in documents() if d is not None]
    sets = {d: brute.shingles(t) for d, t in rows}
    want = brute.components(sets)
    got = near_dedup.near_copies(docs).where("doc_id is not null").collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {(d, len(s), want[d], want[d] == d) for d, s in sets.items()}
    assert len(got) == len(rows) and want[1] == 0 and want[7] == 6
    assert near_dedup.near_copies(none).count() == 0
    kept = near_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, *(d for d in want if want[d] == d)}


def test_chains_of_copies_are_one_component(spark):
    """Neighbours in a chain are alike, its ends aren't; and a hub with copies that differ from each other."""
    words = passage(50, 100).split()
    chain = [(k, " ".join(words[: 100 - 4 * k] + [f"x{k}y{j}" for j in range(0)] + passage(60, 100).split()[100 - 4 * k:])) for k in range(20)]
    rows = chain + [(100 + k, " ".join(w if (i + k) % 25 else f"n{k}" for i, w in enumerate(passage(70, 200).split()))) for k in range(25)]
    want = brute.components({d: brute.shingles(t) for d, t in rows})
    got = near_dedup.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 99), (99, 98)], "a long, b long")
    got = {r["id"]: r["group"] for r in links.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 98: 98, 99: 98, 100: 98}


def test_repeated_lines_go_once(spark, none):
    line = passage(11, 60)
    almost = line[:-1] + "q"
    rows = [(1, f"{line}\nkeep me short\n{passage(12, 20)}"), (2, f"{line}\n{passage(13, 20)}"), (3, almost), (4, None), (5, ""),
            (6, f"{passage(12, 20).upper()}!\nkeep me short"), (7, f"{passage(14, 8)}\n{passage(14, 8)}"), (7, f"{passage(14, 8)}\n{passage(14, 8)}"), (None, passage(13, 20))]
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, _id string")
    out = line_dedup.without_repeated_lines(df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    # short lines go if they are equal to an earlier one
    assert got == sorted([(1, rows[0][1]), (2, ""), (3, ""), (4, None), (5, ""), (6, ""),
                          (7, passage(14, 8)), (7, passage(14, 8)), (None, passage(13, 20))], key=str)
    assert line_dedup.without_repeated_lines(none).count() == 0


def test_short_lines_go_only_if_equal(spark):
    rows = [(1, "one two three\n---\n\nWord"), (2, "One, two: three!\none two threx\n---\n\nword\nwords"), (3, "\nword\n")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # lines without words stay
    assert out == {1: rows[0][1], 2: "one two threx\n---\n\nwords", 3: "\n"}


def test_lines_are_marked_alike_alone_and_together():
    import pyarrow as pa
    texts = [t for _, t in documents()] + ["a b c d e\n\nA, b C d E!\nx y", "\n\n"]
    for full in (True, False):
        assert line_dedup.line_lists(pa.array(texts), full).to_pylist() == [line_dedup.line_lists(pa.array([t], pa.string()), full)[0].as_py() for t in texts]


def test_tokens_equal_the_library(spark, docs, none):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(queries.tokenizer_path())
    draw = random.Random(4)
    bits = ["a", "th", "Ing", " ", "\n", "\x1c", "\x85", " ", "é", "é", "Σ", "İ", "5", "½", "'s", "'LL", "%%%", "字", "😀", "<|endoftext|>", "<|", "word.", "can't", "."]
    texts = [t for _, t in documents()] + ["".join(draw.choice(bits) for _ in range(draw.randint(0, 30))) for _ in range(3000)] + ["a" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["ids"], r["back"]) for r in bpe.with_tokens(df, queries.tokenizer_path(), back="back").collect()}
    for k, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[k] == (ids, library.decode(ids, skip_special_tokens=False))
    folder = scratch_folder(spark)
    token_files.write_tokens(df, queries.tokenizer_path(), 1, folder)
    start = 0
    for r in token_files.read_tokens(spark, folder).orderBy("doc_id").collect():
        assert (r["start"], r["ids"]) == (start, [*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 1])
        start += r["n_tokens"]
    for table, n in ((docs, len(documents())), (none, 0)):
        folder = scratch_folder(spark)
        token_files.write_tokens(table, queries.tokenizer_path(), 1, folder)
        assert token_files.read_tokens(spark, folder, as_bytes=True).count() == n
    assert bpe.with_tokens(none, queries.tokenizer_path(), ids="own").count() == 0


def test_ranks_of_every_length_come_back():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 3, 70000], np.uint32)
    control, data = token_files.pack(ranks)
    assert len(control) == 3 and token_files.unpack(control, data, len(ranks)).tolist() == ranks.tolist()
    assert token_files.unpack(*token_files.pack(ranks[:0]), 0).tolist() == []


@pytest.mark.parametrize("kind", ["toxicity", "quality"])
def test_classifiers_learn_and_take_every_row(spark, docs, none, kind):
    draw = random.Random(9)
    rows = []
    for k in range(300):
        bad = k % 2
        text = passage(1000 + k, draw.randint(5, 80))
        rows.append((k, text + (" scum " + passage(k, 3) if kind == "toxicity" else " %%% ***!! " * 6) if bad else text, bad))
    df = spark.createDataFrame(rows, "doc_id long, text string, bad int")
    labels = df.selectExpr("doc_id", "bad as toxic", "1 - bad as quality")
    module, sign = (toxicity, 1) if kind == "toxicity" else (quality_cnn, -1)
    model = module.trained(df.where("doc_id < 200"), labels)
    held = module.scored(df.where("doc_id >= 200"), model).collect()
    assert np.mean([(sign * (r["score"] - 0.5) > 0) == bool(r["bad"]) for r in held]) > 0.95
    out = module.scored(docs, model)
    assert out.columns == [*docs.columns, "_score"] and all(0 <= r["_score"] <= 1 for r in out.collect())
    assert module.scored(none, model).count() == 0
    untrained = module.trained(df, labels.limit(0))
    assert {r["score"] for r in module.scored(df, untrained).collect()} == {0.5}


def test_articles_and_templates(spark):
    def page(k, body):
        return f"<html><head><title>t{k}</title></head><body><nav><a href=x>n{k}</a></nav><article><h1>Head {k} &amp; x</h1>{body}<p>Read our other stories</p></article><footer>f</footer></body></html>"
    rows = [(k, f"https://a.example/{k}", page(k, f"<p>own  text {k}<br>more<p class='ad'>buy</p><div id=comments>c</div>")) for k in range(12)]
    rows += [(50, "http://b.example/x", page(50, "<p>alone</p>")), (51, None, None), (52, "b", ""), (53, "http://c.example", "plain <p>a<b>b</b> &lt; c<!-- x"), (53, "http://c.example", "plain <p>a<b>b</b> &lt; c<!-- x")]
    got = html_wrapper.main_texts(spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows)
    assert all(texts[k] == f"Head {k} & x\n\nown text {k} more" for k in range(12))
    assert texts[50] == "Head 50 & x\n\nalone\n\nRead our other stories"
    assert (texts[51], texts[52], texts[53]) == ("", "", "plain\n\nab < c")
    assert html_wrapper.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_simple_tree_matching_is_the_heaviest():
    tree = lambda body: html_wrapper.parsed(f"<body>{body}</body>")
    a, b = tree("<p>1</p><ul><li>x</li></ul><p>2</p><h2>q</h2>"), tree("<ul><li>y</li><li>z</li></ul><p>2</p><div>d</div><h2>q</h2>")
    pairs = html_wrapper.aligned(a, b)
    assert sorted((x.text, y.text) for x, y in pairs) in ([("2", "2"), ("q", "q"), ("x", "y")], [("2", "2"), ("q", "q"), ("x", "z")])


def test_stages_keep_columns_and_decide(spark, tmp_path, docs, items, labels):
    for name, table in (("documents", docs), ("benchmark", items), ("labels", labels)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0
        if k < 4:
            assert out.columns == docs.columns and out.count() <= now.count()
            now = out
    score = quality_cnn.scored(docs.drop("score"), quality_cnn.trained(docs, labels.where(toxicity.remainder(F.col("doc_id"), 4) != 2)))
    good = [(r["doc_id"], r["text"]) for r in score.where("score >= 0.7").collect()]
    first = corpus_pipeline.good_documents(spark, docs, str(tmp_path))
    assert sorted(((r["doc_id"], r["text"]) for r in first.collect()), key=str) == sorted(good, key=str)
    lines = [(r["doc_id"], r["text"]) for r in line_dedup.without_repeated_lines(first).collect()]
    comps = brute.components({d: brute.shingles(t) for d, t in lines if d is not None})
    stay = [(d, t) for d, t in lines if d is None or comps[d] == d]
    want = [d for (d, _), (_, hit, _) in zip(stay, brute.contamination(stay, ITEMS)) if not hit]
    assert sorted((r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_sql_twins(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    theirs = con.execute(oracle.oracle_sql()[name]).df()
    ours = queries.registered()[name](spark, sf).toPandas()[list(theirs.columns)]
    assert sorted(map(tuple, ours.values.tolist())) == sorted(map(tuple, theirs.values.tolist()))


def test_runs_and_plain_words_equal_the_library():
    import pyarrow as pa
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        own = token_files.Library(f.read())
    texts = ["", None, "a, b.. (c) don't İstanbul ΣΑΣ ǅ <|endoftext|> a<|b 12 ª", "word, " * 30_000, "x" * 100, "über-allem\x1cnah"] * 2
    for rows in (texts, [], texts[:1]):
        got = [np.frombuffer(r, "<u2").tolist() for r in own.encode(pa.array(rows, pa.string()), 7, "<u2").to_pylist()]
        assert got == [[*own.tokenizer.encode(t or "", add_special_tokens=False).ids, 7] for t in rows]


def test_capitals_are_composed_once(spark):
    """Small letters that compose with a mark where their capitals don't."""
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(queries.tokenizer_path())
    cases = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "\u03aa\u0301"]
    texts = cases + [f"one {c}x, Two {c}. {c.lower()} Éa" for c in cases] + [" ".join(cases) + "\x1cA <| B"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in bpe.with_tokens(df, queries.tokenizer_path()).collect()}
    assert [got[k] for k in range(len(texts))] == want
    folder = scratch_folder(spark)
    token_files.write_tokens(df, queries.tokenizer_path(), 1, folder)
    assert [r["ids"] for r in token_files.read_tokens(spark, folder).orderBy("doc_id").collect()] == [[*w, 1] for w in want]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(draw, line, edits):
    """A line with letters put in, left out or changed, or with one of its words changed."""
    if not edits:
        words = line.split()
        words[draw.randrange(len(words))] = draw.choice(["x", "other", "sixteen"])
        return " ".join(words)
    for _ in range(edits):
        at = draw.randrange(max(1, len(line)))
        line = line[:at] + draw.choice(["", "q", "qz", "é" + line[at:at + 1]]) + line[at + 1:]
    return line


def test_edited_lines_are_linked_as_by_plain_comparison(spark):
    draw = random.Random(12)
    pairs = []
    for k in range(400):
        line = " ".join(draw.choice(WORDS) for _ in range(draw.choice([5, 6, 7, 8, 9, 12, 20, 40])))
        line = f"{k} {line} {k * k}"
        pairs.append((line, edited(draw, line, draw.choice([0, 1, 1, 2, 3]))))
    # lines of at most SHORT characters lose no pair, whatever the edits
    alike = [(a, b) for a, b in pairs if 10 * distance(a, b) <= max(len(a), len(b)) and len(b.split()) >= 5]
    rows = [(2 * k + i, pair[i]) for k, pair in enumerate(alike) for i in (0, 1)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    missed = [k for k in range(len(alike)) if out[2 * k + 1]]
    assert len(alike) > 200 and not [k for k in missed if max(map(len, alike[k])) <= line_dedup.SHORT]
    assert len(missed) <= len(alike) // 100


def test_groups_keep_their_first_line_as_by_plain_comparison(spark):
    """Chains of edits, whose ends are no longer alike, and copies; every pair of lines is compared."""
    draw = random.Random(31)
    lines = []
    for k in range(24):
        line = f"{k} " + " ".join(draw.choice(WORDS) for _ in range(draw.choice([5, 6, 7, 25])))
        for _ in range(draw.choice([1, 3, 6])):
            lines += [line] * draw.choice([1, 1, 2])
            # a few letters of a long line leave it far within the similarity
            line = edited(draw, line, draw.choice([1, 1, 2]))
    lines += ["a b", "A, b", "a c", "", "--"] * 3
    draw.shuffle(lines)
    rows = [(k, "\n".join(lines[4 * k:4 * k + 4])) for k in range((len(lines) + 3) // 4)]
    places = [(d, n, line_dedup.normalised(x.encode())) for d, t in rows for n, x in enumerate(t.split("\n"))]
    group = list(range(len(places)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, (_, _, x) in enumerate(places):
        for j, (_, _, y) in enumerate(places[:i]):
            fuzzy = min(len(x.split()), len(y.split())) >= 5 and abs(len(x) - len(y)) <= line_dedup.most_edits(max(len(x), len(y)))
            if x and (x == y or fuzzy and distance(x, y) <= line_dedup.most_edits(max(len(x), len(y)))):
                low, high = sorted((root(i), root(j)))
                group[high] = low
    stays = {places[k][:2] for k in range(len(places)) if root(k) == k}
    want = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) in stays) for d, t in rows}
    got = line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert len(stays) < len(places) * 0.8


def altered(draw, line, kind, share):
    """A line with this share of its characters changed, left out or followed by another one, anywhere."""
    line = list(line)
    for at in draw.sample(range(len(line)), int(share * len(line))):
        line[at] = {"change": draw.choice("ABCDEF"), "leave": "", "add": line[at] + draw.choice("ABCDEF")}[kind]
    return "".join(line)


@pytest.mark.parametrize("share, lost", [(0.02, 0.0), (0.05, 0.005), (0.08, 0.03), (0.1, 0.09)])
def test_long_lines_share_a_key_and_pass_the_gate(share, lost):
    """Of pairs within the similarity, by length class; the worst are those whose edits are all apart."""
    draw = random.Random(13)
    for shortest, longest in ((50, 100), (100, 200), (200, 400)):
        pairs = []
        for k in range(900):
            line = "".join(draw.choice("abcdefghijklmnopqrst uvwxyz") for _ in range(draw.randint(shortest + 5, longest)))
            pairs.append((line, altered(draw, line, ["change", "leave", "add"][k % 3], share)))
        pairs = [(a, b) for a, b in pairs if min(len(a), len(b)) > line_dedup.SHORT and abs(len(a) - len(b)) <= line_dedup.most_edits(max(len(a), len(b)))]
        sides = [line_dedup.characters([p[k] for p in pairs]) for k in (0, 1)]
        keys = [line_dedup.line_keys(line_dedup.gram_marks(*side), [b""] * len(pairs)) for side in sides]
        found = np.array([bool({*a.tolist()} & {*b.tolist()}) for a, b in zip(*keys)])
        apart = np.bitwise_count(line_dedup.simhashes(*sides[0]) ^ line_dedup.simhashes(*sides[1])).sum(axis=1)
        assert len(pairs) > 400 and 1 - found.mean() <= lost * (1.5 if shortest == 50 else 1)
        assert (apart > line_dedup.GATE).mean() <= 0.005


def test_pieces_of_short_lines_miss_no_pair():
    draw = random.Random(14)
    keys = lambda lines: [set(k.tolist()) for k in line_dedup.line_keys(line_dedup.gram_marks(*line_dedup.characters(lines)), line_dedup.cut_marks(*line_dedup.characters(lines)))]
    for _ in range(2000):
        line = "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(10, line_dedup.SHORT)))
        other = edited(draw, line, draw.randint(1, 4))
        if len(other) <= line_dedup.SHORT and distance(line, other) <= line_dedup.most_edits(max(len(line), len(other))) and line != other:
            a, b = keys([line, other])
            assert a & b, (line, other)


def test_flags_do_not_depend_on_the_size_of_the_sample(spark, monkeypatch):
    """One row in ten is toxic; the word that hints at it stands in clean rows as well."""
    draw = random.Random(21)
    rows = []
    for k in range(2000):
        toxic = int(k % 10 == 0)
        hint = draw.random() < (0.8 if toxic else 0.2)
        rows.append((k, passage(5000 + k, 12) + (" hint" if hint else " plain"), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    means = []
    for most in (4000, 150):
        monkeypatch.setattr(toxicity, "SAMPLE", most)
        scores = [r["score"] for r in toxicity.scored(df, toxicity.trained(df, df.select("doc_id", "toxic"))).collect()]
        means.append((np.mean(scores), np.mean([s >= 0.5 for s in scores])))
    assert all(abs(m - 0.1) < 0.06 and flagged < 0.15 for m, flagged in means)


def main_texts_of(spark, rows):
    got = html_wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r["page_id"]: r["text"] for r in got}


def test_near_copies_of_a_page_keep_their_article(spark):
    shared = [passage(300 + k, 12) for k in range(9)]
    blocks = [[*shared[:k % 9], f"changed {k} " + passage(400 + k, 6), *shared[k % 9 + 1:]] for k in range(10)]
    page = lambda own: f"<html><body><article>{''.join(f'<p>{b}</p>' for b in own)}</article></body></html>"
    got = main_texts_of(spark, [(k, f"http://copies.example/{k}", page(own)) for k, own in enumerate(blocks)])
    assert got == {k: "\n\n".join(own) for k, own in enumerate(blocks)}


def test_layouts_of_a_host_have_templates_of_their_own(spark):
    """Two layouts in plain elements; empty, null and cut pages among them."""
    article = lambda k: f"<html><body><div class=top>Welcome to us</div><div class=text><p>{passage(500 + k, 15)}</p></div></body></html>"
    listing = lambda k: f"<html><body><table class=list><tr><td>All our items</td><td>{passage(600 + k, 15)}</td></tr></table></body></html>"
    for host in "abcdef":  # whichever page the hash of the ids favours
        first = 100 * ord(host)
        rows = [(first + k, f"http://{host}.example/{k}", page) for k, page in enumerate(
            [article(k) for k in range(12)] + [listing(k) for k in range(10)] + [None, "", None, "", "<html><bo", "<html>"])]
        got = main_texts_of(spark, rows)
        assert [got[first + k] for k in range(22)] == [passage(500 + k, 15) for k in range(12)] + [passage(600 + k, 15) for k in range(10)]
        assert {got[first + k] for k in range(22, 28)} == {""}


def test_lines_without_spaces_are_compared(spark):
    chinese = "数据清洗的目标是删除重复的行，同时保留每一行第一次出现的位置。"
    thai = "การลบบรรทัดที่ซ้ำกันเป็นขั้นตอนสำคัญของการเตรียมข้อมูล"
    rows = [(1, f"{chinese}\n{thai}\n短行"), (2, chinese), (3, chinese.replace("目标", "目的")), (4, f"{thai}\n短行"), (5, "これは日本語の長い行です、単語の間に空白がありません"), (6, "これは日本語の長い行です、単語の間に空白がありませぬ")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: "", 3: "", 4: "", 5: rows[4][1], 6: ""}


def test_every_character_is_encoded_as_by_the_library():
    """All code points up to U+1FFFF, assigned or not, beside letters and marks."""
    from tokenizers import Tokenizer
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        spec = f.read()
    library, own = Tokenizer.from_str(spec), bpe.Codec(spec)
    for pattern in ("a{0}B {0}", "{0}\u0301 x{0}.,"):
        texts = [pattern.format(chr(k)) for k in range(1, 0x20000) if not 0xD800 <= k < 0xE000]
        want = library.encode_batch_fast(texts, add_special_tokens=False)
        assert [t for t, w, g in zip(texts, want, own.encode(texts)) if w.ids != g.tolist()] == []


def test_edits_are_counted_as_by_plain_comparison():
    draw = random.Random(41)
    pairs = []
    for k in range(900):
        line = "".join(draw.choice("ab cé") for _ in range(draw.randint(0, 60)))
        other = edited(draw, line, draw.randint(1, 6)) if k % 5 else "".join(draw.choice("ab cé") for _ in range(draw.randint(0, 60)))
        pairs.append((line, other))
    a, b = map(list, zip(*pairs))
    apart = np.array([distance(*p) for p in pairs])
    for most in (np.maximum(apart - 1, 0), apart, apart + 1):
        assert (line_dedup.within_edits(a, b, most) == (apart <= most)).all()
    longer = np.array([max(map(len, p)) for p in pairs])
    assert (line_dedup.alike(a, b) == (apart <= longer - np.ceil(0.9 * longer - 1e-9))).all()
    assert len(line_dedup.alike([], [])) == 0


def test_members_of_a_key_fit_in_length_and_place():
    draw = np.random.default_rng(42)
    keys, ids = draw.integers(0, 400, 3000).astype(np.uint32), draw.integers(-1 << 40, 1 << 40, 3000)
    n, at = draw.integers(50, 400, 3000).astype(np.uint16), draw.integers(0, 256, 3000).astype(np.uint8)
    most = lambda a: a - np.ceil(0.9 * a - 1e-9)
    out = line_dedup.block_members(3, np.append(keys, keys[:50]), np.append(ids, ids[:50]), np.append(n, n[:50]), np.append(at, at[:50])).to_pylist()
    of = {int(i): k for k, i in enumerate(ids)}
    met = set()
    for rows in [[r for r in out if r["bucket"] == b] for b in {r["bucket"] for r in out}]:
        whole = {r["id"] for r in rows} | {r["lo"] for r in rows if r["lo"] is not None}
        assert len({keys[of[i]] for i in whole}) == 1 and all(r["several"] == (len(whole) > 2) for r in rows)
        met |= {(i, j) for i in whole for j in whole}
    for r in out:
        i, j = of[r["id"]], of.get(r["lo"])
        assert j is None or abs(int(n[i]) - int(n[j])) <= most(max(n[i], n[j])) and abs(int(at[i]) - int(at[j])) <= line_dedup.AWAY
    # no pair that fits is parted, and pairs alone that don't fit are left out
    fit = [(int(ids[i]), int(ids[j])) for i in range(3000) for j in np.flatnonzero(keys == keys[i])
           if abs(int(n[i]) - int(n[j])) <= most(max(n[i], n[j])) and abs(int(at[i]) - int(at[j])) <= line_dedup.AWAY and i != j]
    assert fit and set(fit) <= met and len(out) < 3000


def test_finished_steps_of_line_dedup_hold_no_shuffle_files(spark):
    import time

    def left():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").count("shuffle_")

    rows = [(k, f"{passage(700 + k % 40, 30)}{k % 3}\n{passage(800 + k, 12)}") for k in range(120)]
    line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    for _ in range(20):  # the cleaner works beside
        if left() < 60:
            break
        time.sleep(0.5)
    assert left() < 60


def test_unrelated_long_lines_of_few_syllables_share_few_keys():
    """Lines of common syllables have runs of 12 characters in common by chance; of longer lines, longer runs are compared."""
    draw = random.Random(51)
    syllables = "the th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    lines = ["".join(draw.choice(syllables) + draw.choice(["", "", " "]) for _ in range(draw.randint(130, 180))).strip() for _ in range(1500)]
    assert min(map(len, lines)) > 200
    keys = line_dedup.line_keys(line_dedup.gram_marks(*line_dedup.characters(lines)), [b""] * len(lines))
    seen = np.unique(np.concatenate(keys), return_counts=True)[1]
    assert (seen[seen > 1] - 1).sum() < 0.01 * sum(map(len, keys))


def test_every_pair_within_reach_has_a_class_of_runs_in_common():
    classes = lambda n: {k for k, ((first, _, _), last) in enumerate(zip(line_dedup.RUNS, line_dedup.LAST)) if first <= n <= last}
    for n in range(line_dedup.SHORT + 1, 500):
        assert all(classes(n) & classes(m) for m in range(n - line_dedup.most_edits(n), n + 1))
        assert len(line_dedup.gram_marks(*line_dedup.characters([("ab " * n)[:n]]))[0]) // line_dedup.GRAMS.itemsize in line_dedup.FIRST


def test_line_dedup_deletes_what_it_no_longer_reads(spark, tmp_path, monkeypatch):
    """The marks of the lines, which are as large as the texts, don't stay until the result is written."""
    import itertools

    count = itertools.count()
    monkeypatch.setattr("aerolog.session.scratch_folder", lambda _: f"{tmp_path}/{next(count)}")
    rows = [(k, f"{passage(900 + k % 40, 30)}{k % 3}\n{passage(950 + k, 12)}") for k in range(60)]
    line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = [set(spark.read.parquet(str(f)).columns) for f in tmp_path.glob("*/table")]
    assert kept and not any({"grams", "heavy", "light", "bucket"} & columns for columns in kept)
