"""Suffix-array dedup and the n-gram join, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from rows import SF_DIR, edge_frame, empty_frame, same_rows, with_clashes

from tidemark.llm.anchors import segments
from tidemark.llm.common import BATCH_BYTES, BATCH_CONF, small_batches, table, written
from tidemark.llm.components import components
from tidemark.llm.ngram_join import JoinParams, _frequent, _key, jaccard_components
from tidemark.llm.python_queries import op4_substring_dedup, op6_ngram_join
from tidemark.llm.run_index import RunIndex
from tidemark.llm.shingles import shingle_sets
from tidemark.llm.substring_dedup import STEP, SubstringParams, _sharing, substring_dedup


def test_matching_statistics_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        base = [bytes(rng.choices(b"ab\0", k=rng.randint(0, 60))) for _ in range(4)]
        strings = [b"".join(rng.choices(base, k=rng.randint(1, 3))) for _ in range(rng.randint(1, 6))]
        index = RunIndex.build(strings)
        found, at = index.matching_statistics(), 0
        places = [(i, j) for i, s in enumerate(strings) for j in range(len(s))]
        for i, s in enumerate(strings):
            for j in range(len(s)):
                best = 0
                for k, m in places:
                    t, size = strings[k], 0
                    while (k, m) != (i, j) and j + size < len(s) and m + size < len(t) and s[j + size] == t[m + size]:
                        size += 1
                    best = max(best, size)
                assert found[at + j] == best
            at += len(s) + 1


def test_a_repetitive_collection_has_few_runs():
    text = bytes(random.Random(1).choices(b"abcdefgh", k=5000))
    index = RunIndex.build([text[:i] + b"#" + text[i:] for i in range(0, 5000, 250)])
    assert len(index.symbol) < 0.2 * index.length.sum()


@pytest.mark.parametrize("alphabet", [b"ab", bytes(range(97, 123))])
def test_every_window_has_one_segment_and_equal_windows_one_name(alphabet):
    rng, window = random.Random(4), 400
    blocks = [bytes(rng.choices(alphabet, k=rng.randint(100, 900))) for _ in range(3)]
    texts = [b"".join(rng.choices(blocks, k=rng.randint(0, 4))) for _ in range(8)] + [b"x" * 3000, b"ab" * 800]
    found, seen, names = segments(texts, window), Counter(), {}
    for t, start, count, name in zip(found.text, found.start, found.count, found.name, strict=True):
        for at in range(start, start + count):
            seen[t, at] += 1
            assert names.setdefault(texts[t][at : at + window], name) == name
    assert set(seen.values()) == {1} and len(seen) == sum(max(0, len(t) - window + 1) for t in texts)


def _cut(texts, window):
    """Bytes left of each text, and the number of removed runs."""
    counts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if counts[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        yield bytes(c for c, g in zip(t, gone, strict=True) if not g), len(re.findall(b"\1+", bytes(gone)))


SMALL = [SubstringParams(window=80), SubstringParams(window=80, gathered=1), SubstringParams(window=80, block=1)]


@pytest.mark.parametrize("params", SMALL)
def test_substring_dedup_equals_brute_force(spark, params):
    rows = edge_frame(spark).collect()
    want = sorted((repr(r.doc_id), *c) for r, c in zip(rows, _cut([(r.text or "").encode() for r in rows], 80), strict=True))
    out = substring_dedup(with_clashes(edge_frame(spark)), params).collect()
    assert sorted((repr(r.doc_id), bytes(r.kept), len(r.spans)) for r in out) == want
    assert all(r.n_removed == sum(s.end - s.begin for s in r.spans) == r.n_bytes - len(r.kept) for r in out)


def test_substring_query_equals_brute_force(spark):
    docs = table(spark, SF_DIR, "documents").collect()
    found = {r.doc_id: r for r in op4_substring_dedup(spark, SF_DIR).collect()}
    for d, (kept, n) in zip(docs, _cut([d.text.encode() for d in docs], 400), strict=True):
        r = found[d.doc_id]
        assert (r.n_bytes - r.n_removed, r.n_spans, r.kept_sha256) == (len(kept), n, hashlib.sha256(kept).hexdigest())
    assert substring_dedup(empty_frame(spark)).count() == 0


def test_segments_are_indexed_only_if_they_may_share_a_window():
    rng, window = random.Random(8), 400
    draw = lambda n: bytes(rng.choices(b"abcdefgh ", k=n))
    passages = [draw(n) for n in (150, 150, 280, 400, 401, 436, 700) for _ in range(3)]
    texts = [draw(rng.randint(0, 500)) + p + draw(rng.randint(0, 500)) for p in passages for _ in range(4)]
    found, kinds = segments(texts, window), set()
    for t, start, count, name in zip(found.text, found.start, found.count, found.name, strict=True):
        kinds.add((int(name), texts[t][start : start + count + window - 1]))
    names, strings = zip(*sorted(kinds), strict=True)
    own = _sharing(list(names), list(strings), window)
    windows = Counter(s[i : i + window] for s in strings for i in range(len(s) - window + 1))
    share = {j for j, s in enumerate(strings) if any(windows[s[i : i + window]] > 1 for i in range(len(s) - window + 1))}
    assert share and share <= set(own) and own == sorted(own)
    # The others share an anchor at most: all that is indexed has a string with another that is nearly a window.
    least = window - STEP + 1
    nearly = Counter(x for s in strings for x in {s[i : i + least] for i in range(len(s) - least + 1)})
    assert all(any(nearly[strings[j][i : i + least]] > 1 for i in range(len(strings[j]) - least + 1)) for j in own)
    shared = Counter(names)
    assert len(own) < sum(n for n in shared.values() if n > 1)
    assert _sharing([], [], window) == []


def test_texts_are_cut_into_segments_once(spark, monkeypatch):
    labels = []

    def noted(frame, label):
        labels.append(label)
        return written(frame, label)

    monkeypatch.setattr("tidemark.llm.substring_dedup.written", noted)
    substring_dedup(edge_frame(spark), SMALL[0])
    assert labels.count("segments") == 1


def test_a_line_said_again_and_again_is_few_rows(spark, monkeypatch):
    line, frames = "this line is said again and again\n", {}

    def noted(frame, label):
        frames[label] = written(frame, label)
        return frames[label]

    monkeypatch.setattr("tidemark.llm.substring_dedup.written", noted)
    rng = random.Random(9)
    draw = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    texts = [draw(60) + line * n + draw(60) for n in (2, 30, 200, 300, 300)] + [draw(300)]
    out = substring_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), SMALL[0]).collect()
    assert [(bytes(r.kept), len(r.spans)) for r in sorted(out)] == list(_cut([t.encode() for t in texts], 80))
    # One row for each text that has a segment, however often: not one for each of the 832 lines.
    for label, key in (("segments", ["row", "content", "name"]), ("cuts", ["row", "content", "name", "s1", "s2"])):
        assert 0 < frames[label].count() == frames[label].dropDuplicates(key).count() < 200


LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _groups(rows, words=4, percent=85):
    """Each row's set size and smallest reachable id."""
    sets = []
    for _, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    least = {r: min((d for d in own if d is not None), default=None) for r, own in ids.items()}
    return sorted((repr(doc), len(sets[i]), repr(least[root(i)])) for i, (doc, _) in enumerate(rows))


def _pairs(frame):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in frame.collect())


@pytest.mark.parametrize("params", [JoinParams(), JoinParams(frequent=2), JoinParams(broadcast_classes=0)])
def test_components_equal_brute_force(spark, params):
    docs = edge_frame(spark)
    rng, rows = random.Random(7), [(r.doc_id, r.text) for r in docs.collect()]
    base = [f"w{i}" for i in range(120)]
    for i in range(60):  # a chain of near copies: neighbours link, ends do not
        base[rng.randrange(120)] = f"v{i}"
        rows.append((1000 - i, " ".join(base)))
    shared = " ".join(f"s{i}" for i in range(40))
    rows += [(2000 + i, f"{shared} " + " ".join(rng.choices(base, k=30))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert _pairs(jaccard_components(with_clashes(frame), params)) == _groups(rows)


def test_join_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    assert _pairs(op6_ngram_join(spark, SF_DIR)) == _groups(rows)
    assert jaccard_components(empty_frame(spark)).count() == 0


def test_a_long_chain_is_one_component(spark):
    links = spark.range(200).selectExpr("id as a", "id + 1 as b").union(spark.createDataFrame([(900, 901)], "a long, b long"))
    found = components(links).collect()
    assert {(r.node, r.component) for r in found} == {(i, 0) for i in range(201)} | {(900, 900), (901, 900)}


def test_written_steps_get_batches_of_bounded_bytes(spark):
    rows = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat(cast(id as string), 4000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    seen = written(rows.mapInArrow(sizes, "n long, bytes long"), "sizes").collect()
    assert sum(r.n for r in seen) == 2000
    assert max(r.bytes for r in seen) <= BATCH_BYTES + (64 << 10)
    assert spark.conf.get(BATCH_CONF, None) is None


def test_a_batch_setting_of_the_session_returns(spark):
    for mine in (1 << 10, 1 << 30):
        spark.conf.set(BATCH_CONF, str(mine))
        try:
            with small_batches(spark):
                assert int(spark.conf.get(BATCH_CONF)) == min(mine, BATCH_BYTES)
            assert int(spark.conf.get(BATCH_CONF)) == mine
        finally:
            spark.conf.unset(BATCH_CONF)


def test_frequent_keys_are_those_that_repeat(spark):
    texts = ["a b c d e", "a b c d f", "a b c d g", "a b c d h", "x y z w", "x y z w", "", "one two"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    counts = Counter(k for s in shingle_sets([t.encode() for t in texts], 4) for k in _key(s).tolist())
    for least in (2, 4, 5):
        expected = sorted(k for k, n in counts.items() if n >= least)
        assert _frequent(rows, JoinParams(frequent=least)).tolist() == expected
