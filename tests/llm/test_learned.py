"""Quality classifier and toxicity."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from rows import edge_frame, empty_frame, with_clashes

from tidemark.llm.boosted_trees import TreeParams, _edges, fit_trees
from tidemark.llm.common import table
from tidemark.llm.lexicon import Lexicon, fold_text
from tidemark.llm.python_queries import op2_quality, op8_toxicity
from tidemark.llm.quality import NAMES, classify, fit_quality, fold, statistics
from tidemark.llm.toxicity import fit_lexicon, toxicity

SF = "/root/testdata/sf0.01"


def test_trees_learn_an_interaction_and_flatten_as_they_score():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.4) ^ (x[:, 3] > 0.7)).astype(float)
    model = fit_trees(x[:3000], y[:3000], TreeParams(trees=40))
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.97

    def walk(row):
        total = model.base
        for node in model.roots:
            while model.left[node] != node:
                node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
            total += model.value[node]
        return total

    assert np.allclose([walk(r) for r in x[:50]], model.margin(x[:50]))


def _plain_margins(x, y, p):
    """Boosted trees by recursion over rows: every cut of every feature is tried, its sums taken anew."""
    positive = (sum(y) + 1) / (len(y) + 2)
    margins = [float(np.log(positive / (1 - positive)))] * len(y)
    cuts = _edges(x, p.bins)

    def grow(rows, level, grad, hess, moves):
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        best = (1e-6, None)
        if level < p.depth:
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    low = [i for i in rows if x[i, f] <= cut]
                    gl, hl = sum(grad[i] for i in low), sum(hess[i] for i in low)
                    if hl < p.least_weight or h - hl < p.least_weight:
                        continue
                    gain = gl**2 / (hl + p.ridge) + (g - gl) ** 2 / (h - hl + p.ridge) - g**2 / (h + p.ridge)
                    if gain > best[0] + 1e-12:
                        best = (gain, low)
        if best[1] is None:
            for i in rows:
                moves[i] = -g / (h + p.ridge) * p.rate
            return
        low = set(best[1])
        grow(best[1], level + 1, grad, hess, moves)
        grow([i for i in rows if i not in low], level + 1, grad, hess, moves)

    for _ in range(p.trees):
        prob = [1 / (1 + np.exp(-m)) for m in margins]
        moves = [0.0] * len(y)
        grow(list(range(len(y))), 0, [q - t for q, t in zip(prob, y, strict=True)], [q * (1 - q) for q in prob], moves)
        margins = [m + d for m, d in zip(margins, moves, strict=True)]
    return margins


@pytest.mark.parametrize("depth, bins", [(1, 8), (3, 5), (2, 64)])
def test_the_fit_equals_a_plain_one(depth, bins):
    rng = np.random.default_rng(depth)
    x = rng.random((120, 3))
    y = ((x[:, 0] + rng.normal(0, 0.2, 120) > 0.5) ^ (x[:, 1] > 0.6)).astype(float)
    params = TreeParams(trees=4, depth=depth, bins=bins)
    assert np.allclose(fit_trees(x, y, params).margin(x), _plain_margins(x, y, params))


def test_trees_without_rows_or_with_one_class():
    none = fit_trees(np.zeros((0, 3)), np.zeros(0))
    assert none.score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert fit_trees(np.zeros((9, 3)), np.ones(9)).score(np.zeros((1, 3)))[0] > 0.8


def test_statistics_are_defined_for_any_text():
    for text in ("", " ", "\n\n", "a", "\0", "é日😀", "x" * 100_000):
        row = statistics(text)
        assert row.shape == (len(NAMES),) and np.isfinite(row).all()


def _accuracy(rows, labels, label):
    told = {r["doc_id"]: r[label] for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in told]
    return sum(r.predicted == told[r.doc_id] for r in held) / len(held)


@pytest.mark.parametrize(("query", "label", "folds", "out", "cut"), [(op2_quality, "quality", 4, 2, 0.7), (op8_toxicity, "toxic", 5, 0, 0.5)])
def test_held_out_accuracy(spark, query, label, folds, out, cut):
    rows = query(spark, SF).collect()
    assert len(rows) == 1000
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= cut)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out)
    assert _accuracy(rows, table(spark, SF, "labels"), label) > 0.9


def test_quality_edges(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(3, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = with_clashes(edge_frame(spark))
    model = fit_quality(docs, labels, lambda i: fold(i.cast("string"), 4) != 2)
    out = classify(docs, model)
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    assert out.where("score is null or predicted is null").count() == 0
    assert classify(empty_frame(spark), model).count() == 0
    nothing = fit_quality(docs, labels.limit(0), lambda i: i.isNotNull())
    assert {r.score for r in classify(docs, nothing).collect()} == {0.5}


def test_folding_sees_through_disguises():
    assert fold_text("1d10t") == fold_text("IDIOT") == fold_text("іdіοt") == fold_text("ｉｄｉｏｔ") == fold_text("i​diot")
    assert fold_text("tra$h") == fold_text("trash")


def test_exceptions_spare_the_entries_inside():
    lexicon = Lexicon({" trash ": 3.0, " scu": 2.0}, (" trash bln ",))
    assert [e for *_, e in lexicon.hits(fold_text("the trash bin, trash scum"))] == [" trash ", " scu"]
    assert Lexicon({}).hits(" anything ") == []


def test_toxicity_edges(spark):
    rows = [(i, "you are tr4sh and scum ok" if i % 4 == 0 else f"a calm text number {i}") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    lexicon = fit_lexicon(docs, labels, lambda i: i < 60)
    seen = {r.doc_id: r.predicted for r in toxicity(docs, lexicon).collect()}
    assert all(seen[i] == (i % 4 == 0) for i in seen)
    edges = toxicity(with_clashes(edge_frame(spark)), lexicon)
    assert edges.count() == edge_frame(spark).count() and edges.where("score is null").count() == 0
    assert toxicity(empty_frame(spark), lexicon).count() == 0
    one_class = fit_lexicon(docs, labels.where("toxic = 0"), lambda i: i.isNotNull())
    assert toxicity(docs, one_class).where("predicted = 1").count() == 0


def _naive_hits(lexicon, folded):
    """Every place of every entry, the longest at each start, but those inside a place of an exception."""
    places = lambda term: [i for i in range(len(folded) - len(term) + 1) if folded.startswith(term, i)]
    longest = {}
    for entry in lexicon.weights:
        for at in places(entry):
            longest[at] = max(longest.get(at, ""), entry, key=len)
    spared = [(at, at + len(p)) for p in lexicon.exceptions for at in places(p)]
    return [(at, at + len(e), e) for at, e in sorted(longest.items()) if not any(a <= at and at + len(e) <= b for a, b in spared)]


def test_hits_equal_a_naive_matcher_over_a_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    lexicon = fit_lexicon(table(spark, SF, "documents"), table(spark, SF, "labels"), lambda i: i.isNotNull())
    assert lexicon.weights
    # Phrases around every tenth word, so that there are exceptions of each kind.
    some = sorted(lexicon.weights)[::2]
    lexicon = Lexicon(lexicon.weights, [*lexicon.exceptions, *some[::3], *[f"{e.rstrip()} a" for e in some[1::3]], " e", " the "], lexicon.scale)
    for r in docs.collect():
        folded = fold_text(r.text or "")[:6000]
        assert lexicon.hits(folded) == _naive_hits(lexicon, folded)


def _plain_statistics(text):
    """The statistics again, letter by letter."""
    import math

    data = text.encode()
    n = max(len(data), 1)
    kinds = [0] * 7
    for b in data:
        if 65 <= b <= 90:
            kind = 0
        elif 97 <= b <= 122:
            kind = 1
        elif 48 <= b <= 57:
            kind = 2
        elif b in b" \t\n\v\f\r":
            kind = 3
        elif b in b"#*$%&|<>":
            kind = 4
        else:
            kind = 6 if b >= 128 else 5
        kinds[kind] += 1
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    w = max(len(words), 1)
    pairs = {(words[i], words[i + 1]) for i in range(len(words) - 1)}
    shares = [data.count(bytes([b])) / n for b in set(data)]
    return [
        *[k / n for k in kinds],
        math.log1p(len(words)),
        sum(len(x) for x in words) / w,
        len(set(words)) / w,
        sum(words[i] == words[i + 1] for i in range(len(words) - 1)) / w,
        max((words.count(x) for x in set(words)), default=0) / w,
        1 - len(pairs) / (len(words) - 1) if len(words) > 1 else 0,
        math.log1p(len(lines)),
        1 - len(set(lines)) / len(lines) if lines else 0,
        len(words) / max(len(lines), 1),
        -sum(s * math.log2(s) for s in shares),
        data.count(b"!") / w,
    ]


def test_statistics_equal_a_plain_count(spark):
    for r in table(spark, "/root/testdata/sf0.001", "documents").limit(60).union(edge_frame(spark).select("doc_id", "text", "lang", "source", "n_chars")).collect():
        assert np.allclose(statistics((r.text or "")[:20_000]), _plain_statistics((r.text or "")[:20_000]))
