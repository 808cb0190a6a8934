"""Page trees, tree matching, and quality rules against plain versions."""

from __future__ import annotations

import itertools
import math
import random

import pytest

from aerolog.llm import html_wrapper, quality_rules
from tests.llm import brute

LOSING = {
    '<div class="site has-sidebar"><article><p>Long text</p></article></div>': "Long text",
    '<div class="layout-with-menu"><p>' + "word " * 50 + '</p></div><p>x</p>': ("word " * 50).strip() + "\n\nx",
    "<body><article>teaser</article><div><p>" + "main words " * 40 + "</p></div></body>": "teaser\n\n" + ("main words " * 40).strip(),
    "<p title=x'>one</p><p>don't</p><p>two</p>": "one\n\ndon't\n\ntwo",
    "<p>a</p><svg><p>b</p>": "a\n\nb",
    "<p>a</p><object data=x><p>b</p><iframe src=q><p>c</p>": "a\n\nb\n\nc",
    "<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</p>": "where x=2 holds",
    "<div class='sidebar'><p>long " + "word " * 30 + "</p></div><article><p>short story of a few words only, but more than a teaser</p></article>": "short story of a few words only, but more than a teaser",
    "<form><main><p>whole page in a form</p></main></form>": "whole page in a form",
    "<nav><a>menu</a></nav><p>text</p><div class='post-comments'>no</div>": "text",
    "<script>a < b <p>no</p>": "",
    "<a x=\"1\" y=\"2\" " * 40: "",
}


@pytest.mark.parametrize("page", LOSING)
def test_pages_that_lost_text(page):
    assert html_wrapper.content(page, None, None) == LOSING[page]


def test_deep_pages_are_aligned():
    deep = lambda text: "<div>" * 5000 + text + "</div>" * 5000
    trees = [html_wrapper.parsed(deep(t)) for t in ("<p>one</p><p>same</p>", "<p>same</p><h2>two</h2>")]
    assert [(a.text, b.text) for a, b in html_wrapper.aligned(*trees)] in ([("same", "same")], [("one", "same")])
    assert html_wrapper.weight(*trees, {}) == 1 + 5000 + 2


def random_tree(draw, depth):
    tag = draw.choice("pq") if depth else "p"
    return f"<x{tag}>" + "".join(random_tree(draw, depth - 1) if draw.random() < 0.7 else draw.choice(["t", "u"]) for _ in range(draw.randrange(4) if depth else 0)) + f"</x{tag}>"


def heaviest(a, b):
    """The most pairs of any order-keeping matching, all of them tried."""
    if a.label != b.label:
        return 0
    x, y = a.children, b.children
    return 1 + max(sum(heaviest(x[i], y[j]) for i, j in zip(left, right))
                   for k in range(min(len(x), len(y)) + 1) for left in itertools.combinations(range(len(x)), k) for right in itertools.combinations(range(len(y)), k))


def test_matching_is_the_heaviest_of_all():
    draw = random.Random(8)
    for _ in range(150):
        a, b = (html_wrapper.parsed("<div>" + random_tree(draw, 3) + "</div>") for _ in range(2))
        memo = {}
        assert html_wrapper.weight(a, b, memo) == heaviest(a, b)
        # the pairs found are as heavy, keep their order, and no node is used twice
        pairs, total, stack = [], 0, [(a, b)]
        while stack:
            p, q = stack.pop()
            if p.label == q.label:
                total += 1
                found = html_wrapper.matching(p.children, q.children, memo)
                assert [p.children.index(c) for c, _ in found] == sorted({p.children.index(c) for c, _ in found})
                assert [q.children.index(c) for _, c in found] == sorted({q.children.index(c) for _, c in found})
                stack += found
        assert total == heaviest(a, b)


RULES = ("symbols", "shouting", "duplicates", "repeats")


def plain_measures(text):
    words, letters, symbols, duplicates, repeats = brute.measures(text)
    capitals = sum(c.isupper() for c in text or "")
    lines = sum(1 for x in (text or "").split("\n") if brute.spaced_words(x))
    share = lambda a, b: a / b if b else 0.0
    return words, dict(zip(RULES, (share(symbols, words), share(capitals, letters), share(duplicates, lines), share(repeats, words)))), repeats


def plain_verdicts(rows, good):
    """Kept or not, with one trial for each text; binomial sums in whole."""
    def tail(k, n, p):
        term = total = (1 - p) ** n
        for i in range(k):
            term *= (n - i) / (i + 1) * p / (1 - p)
            total += term
        return total

    facts = {t: plain_measures(t) for _, t in rows}
    failed = {t: w < 10 or 100 * r > 20 * w for t, (w, _, r) in facts.items()}
    stratum = {t: sum(w >= s for s in quality_rules.STRATA) for t, (w, _, _) in facts.items()}
    verdict = {}
    for d, t in rows:
        if d in good and not failed[t]:
            verdict[t] = min(good[d], verdict.get(t, 1))
    chosen = {}
    for s in range(4):
        own = [t for t, g in verdict.items() if g == 1 and stratum[t] == s]
        for rule in RULES:
            for cutoff in quality_rules.CUTOFFS[rule]:
                k = sum(facts[t][1][rule] >= cutoff for t in own)
                if not own or tail(k, len(own), 0.05 / 4) > 0.05 / 16:
                    break
                chosen[s, rule] = cutoff
    return {(d, t): not failed[t] and not any(facts[t][1][r] >= c for (s, r), c in chosen.items() if s == stratum[t]) for d, t in rows}, chosen


def texts(copies):
    draw = random.Random(12)
    word = lambda: draw.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(draw.randrange(1000))
    rows = []
    for k in range(2700):
        body = [word() for _ in range(draw.choice([12, 30, 30, 60]))]
        if k % 9 == 0:
            body = [w + draw.choice(["%", "$$", ""]) for w in body]
        if k % 9 == 1:
            body = [w.upper() for w in body]
        rows.append((k, " ".join(body) + ("\nsame line here" * 3 if k % 50 == 2 else "")))
    return rows + [(4000 + k, "one text that stands in very many rows of the holdout without any symbol") for k in range(copies)] + [(8000, None), (8001, "")]


@pytest.mark.parametrize("copies", [0, 500])
def test_verdicts_equal_plain_ones(spark, copies):
    rows = texts(copies)
    draw = random.Random(13)
    good = {d: int(d % 9 != 0 or draw.random() < 0.1) for d, _ in rows if d % 7}
    labels = spark.createDataFrame([*good.items(), (3, 1), (9999, 1), (4, None)], "doc_id long, quality int")
    got = quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    want, chosen = plain_verdicts(rows, good)
    assert {r["doc_id"]: r["kept"] for r in got.collect()} == {d: w for (d, _), w in want.items()}
    assert chosen and not all(want[d, t] for d, t in rows if d < 2700)


def test_copies_are_one_trial(spark):
    """A third of the rows is one clean text: cutoffs stay as without it."""
    found = []
    for copies in (1, 1400):
        rows = texts(copies)
        df = spark.createDataFrame(rows, "_id long, text string")
        measured = quality_rules.base_measures(df, ["_id"]).where(~quality_rules.base_failed()).selectExpr("*", "1 as good")
        found.append(quality_rules.cutoffs(quality_rules.trials(measured)))
        assert copies == 1 or quality_rules.cutoffs(measured) != found[0] or found[0] == found[1]
    assert found[0] == found[1]


def test_placement_of_records_is_plain_re_dealing(spark):
    """Slots by hash, bytes by slot, the map of slots to shards: dealt again from the result."""
    from aerolog.llm import sharding
    from aerolog.session import scratch_folder

    draw = random.Random(14)
    rows = [(k, "x" * draw.choice([0, 5, 700])) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.sharded(df, 8, f"{scratch_folder(spark)}/map").collect()
    slots = {}
    for r in out:
        slots.setdefault(r["virtual_slot"], set()).add(r["shard"])
        assert r["size"] == len(dict(rows)[r["doc_id"]]) + 16
    assert all(len(s) == 1 for s in slots.values()) and len(slots) > 1500
    loads = [sum(r["size"] for r in out if r["shard"] == s) for s in range(8)]
    assert max(loads) <= sum(loads) / 8 + max(sum(r["size"] for r in out if r["virtual_slot"] == v) for v in slots)
    for s in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))


def test_quality_margins_are_plain_convolutions():
    """Every window of every chunk by hand, whole texts, and gradients by small steps."""
    import numpy as np
    import pyarrow as pa

    from aerolog.llm import quality_cnn as q
    draw = np.random.default_rng(15)
    net = q.Network(draw.normal(0, 0.5, (256, q.DEPTH)), draw.normal(0, 0.25, (q.WIDTH, q.DEPTH, q.FILTERS)), draw.normal(0, 0.2, q.FILTERS), draw.normal(0, 1, 2 * q.FILTERS), 0.3)
    net.embedding[0] = 0
    texts = ["", None, "a", "short", "exactly6", "é" * 200, "word " * 300, "x" * q.BLOCK, "y" * (q.BLOCK + 1), "z" * (2 * q.BLOCK), "tail" * 160]

    def plain(text):
        raw = (text or "").encode()
        deep = np.concatenate([net.embedding[list(raw)] if raw else np.zeros((0, q.DEPTH)), np.zeros((q.WIDTH, q.DEPTH))])
        windows = [sum(deep[i + k] @ net.filters[k] for k in range(q.WIDTH)) for i in range(max(1, len(raw)))]
        blocks = [np.max(windows[i:i + q.BLOCK], axis=0) for i in range(0, len(windows), q.BLOCK)]
        blocks = [np.maximum(b + net.offsets, 0) for b in blocks]
        chunks = [np.maximum(a, b) for a, b in zip(blocks, blocks[1:])] or blocks
        return np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)]) @ net.weights + net.bias

    got = q.margins(pa.array(texts, pa.string()), net, net.pairs())
    assert got == pytest.approx([plain(t) for t in texts], abs=1e-4)

    own = ["good text " * 40, "bad", "mixed words here"]
    raw = [np.frombuffer(t.encode(), np.uint8) for t in own]
    data, places = np.concatenate(raw), np.cumsum([0, *map(len, raw)])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([0.4, 0.3, 0.3])

    def loss(bias):
        net.bias = bias
        p = 1 / (1 + np.exp(-np.array([plain(t) for t in own])))
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    grads = q.gradients(net, 0.1, data, places, y, weight)
    grads[0][0] = 0  # the padding stays zero in training
    for part, grad in ((net.embedding, grads[0]), (net.filters, grads[1]), (net.offsets, grads[2]), (net.weights, grads[3])):
        flat, g = part.reshape(-1), grad.reshape(-1)
        for k in [*np.argsort(-np.abs(g))[:4].tolist(), 300 % len(flat)]:
            before, step = flat[k], 1e-5
            flat[k] = before + step
            high = loss(0.1)
            flat[k] = before - step
            low = loss(0.1)
            flat[k] = before
            assert g[k] == pytest.approx((high - low) / (2 * step), abs=2e-5)
    assert grads[4][0] == pytest.approx((loss(0.1 + 1e-5) - loss(0.1 - 1e-5)) / 2e-5, abs=1e-5)


def test_toxicity_model_is_plain_ftrl():
    """Twenty texts, dictionaries of floats, the same order of updates; and the plain sum of weights."""
    import numpy as np
    import pyarrow as pa

    from aerolog.llm import toxicity as t
    draw = random.Random(16)
    words = "you are kind bad awful nice day code tree".split()
    texts = [" ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 3, 30]))) for _ in range(20)]
    labels = [int("awful" in x) for x in texts]
    t_l1, t.L1 = t.L1, 0.3
    try:
        model = t.fit(texts, labels, 0.2)
        sets = [sorted({int(a) for a in t.features(*__import__("aerolog.llm.common", fromlist=["utf8"]).utf8(pa.array([x])))[1]}) for x in texts]
        n, z, bn, bz = {}, {}, 0.0, 0.0
        heft = (0.5 / (1 - np.mean(labels)), 0.5 / np.mean(labels))

        def weight(zi, ni, l1):
            return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((t.BETA + math.sqrt(ni)) / t.ALPHA + t.L2)

        order = np.random.default_rng(7)
        for _ in range(t.EPOCHS):
            for k in order.permutation(20):
                w = {i: weight(z.get(i, 0.0), n.get(i, 0.0), t.L1) for i in sets[k]}
                bias = weight(bz, bn, 0)
                g = heft[labels[k]] * (1 / (1 + math.exp(-(sum(w.values()) + bias))) - labels[k])
                for i in sets[k]:
                    rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / t.ALPHA
                    z[i] = z.get(i, 0.0) + g - rate * w[i]
                    n[i] = n.get(i, 0.0) + g * g
                bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / t.ALPHA * bias
                bn += g * g
        plain = {i: weight(z[i], n[i], t.L1) for i in z}
        assert {i: v for i, v in enumerate(model.weights) if v} == pytest.approx({i: v for i, v in plain.items() if v})
        assert 0 < np.count_nonzero(model.weights) < len(plain)
        assert model.bias == pytest.approx(weight(bz, bn, 0) + math.log(0.2 / 0.8))
        got = t.margins(pa.array([*texts, None], pa.string()), model)
        assert got == pytest.approx([model.bias + sum(plain[i] for i in s) for s in sets] + [model.bias])
    finally:
        t.L1 = t_l1
