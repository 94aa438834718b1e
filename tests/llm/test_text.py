"""Repetition rules, token counts, and subword pieces."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from rows import SF_DIR, edge_frame, empty_frame, same_rows, texts, with_clashes

from tidemark.llm.common import table
from tidemark.llm.piece_model import CharMap, PieceModel, load
from tidemark.llm.pieces import decode_pieces, encode_pieces
from tidemark.llm.python_queries import op3_repetition, op7_token_counts, op9_piece_encode
from tidemark.llm.repetition import RepeatRules, batch_counts, repetition
from tidemark.llm.token_counts import attribute, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def _repeats(words, least):
    """Words covered by repeats of ``least`` or more words, and the longest repeat, by comparing all pairs."""
    covered, longest = set(), 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
            if k >= least:
                covered |= set(range(i, i + k)) | set(range(j, j + k))
    return covered, longest


def test_base_counts_equal_brute_force(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").unionByName(edge_frame(spark).select("doc_id", "text").where("doc_id > 3"))
    want = sorted((r.doc_id, *_base(r.text or "")) for r in docs.collect())
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[n] for n in names) for r in repetition(docs).collect()) == want
    for r in op3_repetition(spark, SF_DIR).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_repeats_equal_brute_force():
    rng = random.Random(2)
    for _ in range(120):
        own = [" ".join(rng.choices("ab", k=rng.randint(0, 30))) for _ in range(rng.randint(1, 4))]
        rules = RepeatRules(min_words=4)
        found = batch_counts([t.encode() for t in own], rules)
        for i, text in enumerate(own):
            covered, longest = _repeats(text.split(), 4)
            assert (found["covered_chars"][i], found["longest_repeat"][i]) == (len(covered), longest)


def test_repetition_edges(spark):
    docs = edge_frame(spark)
    out = repetition(docs)
    assert out.count() == docs.count() and same_rows(out, repetition(with_clashes(docs)))
    assert out.where("n_words = 0 and kept").count() == 0
    assert repetition(empty_frame(spark)).count() == 0
    with pytest.raises(ValueError):
        repetition(with_clashes(docs), keep=("kept",))


def _encoder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts_equal_brute_force(spark):
    encoder, by_doc = _encoder(), {}
    for r in op7_token_counts(spark, SF_DIR).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc in table(spark, SF_DIR, "documents").collect():
        rows = sorted(by_doc[doc.doc_id], key=lambda r: r.section)
        assert "".join(doc.text[r.start : r.end] for r in rows) == doc.text
        limits = np.cumsum([len(doc.text[r.start : r.end].encode()) for r in rows])
        counts, at = [0] * len(rows), 0
        for token in encoder.encode_ordinary(doc.text):
            size = len(encoder.decode_single_token_bytes(token))
            owners = Counter(int(np.searchsorted(limits, at + k, side="right")) for k in range(size))
            counts[min(owners, key=lambda o: (-owners[o], o))] += 1
            at += size
        assert counts == [r.n_tokens for r in rows]


def test_tokens_that_cross_go_by_the_rule():
    ends, starts = np.array([4, 10, 12]), np.array([0, 5, 11])
    assert attribute(ends, starts, "start")[0].tolist() == [2, 1, 0]
    assert attribute(ends, starts, "end")[0].tolist() == [1, 1, 1]
    assert attribute(ends, starts, "most")[0].tolist() == [1, 2, 0]  # a tie goes to the earlier one
    assert attribute(ends, starts, "most")[1].tolist() == [0, 2, 0]


def test_token_count_edges(spark):
    docs, args = edge_frame(spark), (RANKS, public_tokenizers.PATTERN)
    out = token_counts(docs, *args)
    encoder = _encoder()
    assert out.agg({"n_tokens": "sum"}).first()[0] == sum(len(encoder.encode_ordinary(r.text or "")) for r in docs.collect())
    assert out.where("doc_id = 0").select("n_tokens", "start", "end").collect() == [(0, 0, 0)]
    assert same_rows(out, token_counts(with_clashes(docs), *args))
    assert token_counts(empty_frame(spark), *args).count() == 0
    with pytest.raises(ValueError):
        token_counts(docs, *args, rule="none")


def test_pieces_equal_the_library():
    data = open(MODEL, "rb").read()
    own, library, rng = load(data), sentencepiece.SentencePieceProcessor(model_proto=data), random.Random(1)
    odd = ["  a  b ", "▁▁x ▁", "日本語テキスト😀", "a" * 5000, "\0", "<s> </s> <0x0A>", "é" * 100, "\r\n\t"]
    made = ["".join(rng.choices("ab <>▁é日😀\n\t.0 th", k=rng.randint(0, 120))) for _ in range(1500)]
    for text in [*odd, *made, *[t or "" for t in texts()]]:
        ids, starts, ends = own.encode(text)
        assert ids.tolist() == library.encode(text)
        assert own.decode(ids) == library.decode(ids.tolist())
        raw = text.encode()
        if len(ids):
            assert starts[0] == 0 and ends[-1] == len(raw) and (starts[1:] == ends[:-1]).all()
        for i, a, b in zip(ids.tolist(), starts, ends, strict=True):
            if i not in own.byte_of:
                assert raw[a:b].decode().replace("▁", " ") in (own.surface[i], own.surface[i][1:])
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randint(1, 12))]
        assert own.decode(np.array(ids)) == library.decode(ids)


def _trie(rules):
    """A compiled character map of one-byte rules: the root's children lie at its offset, their values one step on."""
    units = np.zeros(1024, "<u4")
    units[0] = 256 << 10
    strings, at = b"", {}
    for key, new in rules.items():
        at[key] = len(strings)
        strings += new + b"\0"
    for n, (key, place) in enumerate(at.items()):
        node = 256 ^ key[0]
        value = 600 + n
        units[node] = ((node ^ value) << 10) | 256 | key[0]
        units[value] = place | 1 << 31
    return units.tobytes(), strings


def test_rules_record_where_bytes_came_from():
    units, strings = _trie({b"A": b"aa", b"\t": b" ", b"#": b""})
    blob = len(units).to_bytes(4, "little") + units + strings
    model = PieceModel(open(MODEL, "rb").read())
    model.charmap, model.trim = CharMap.read(blob), True
    normal, source = model.normalise(" \tA#b  A ")
    assert normal == "▁aab▁aa"
    assert source.tolist() == [2, 2, 2, 2, 2, 4, 5, 5, 5, 7, 7, 8]


def test_piece_queries_and_edges(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = {r.doc_id: r for r in op9_piece_encode(spark, SF_DIR).collect()}
    for doc in table(spark, SF_DIR, "documents").collect():
        ids, r = library.encode(doc.text), rows[doc.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    docs = edge_frame(spark)
    out = encode_pieces(docs, MODEL, decoded=True)
    assert same_rows(out, encode_pieces(with_clashes(docs), MODEL, decoded=True))
    assert same_rows(out.select("doc_id", "decoded"), decode_pieces(out, MODEL))
    assert out.where("doc_id = 0").select("ids", "decoded").collect() == [([], "")]
    assert encode_pieces(empty_frame(spark), MODEL).count() == 0
    with pytest.raises(ValueError):
        encode_pieces(with_clashes(docs), MODEL, keep=("ids",))


def test_long_runs_are_encoded_as_the_library_does(monkeypatch):
    from tidemark.llm import token_counts as tc

    encoder = tc.load(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    ends = lambda text: np.cumsum(encoder.sizes[np.array(encoder.encoding.encode_ordinary(text), np.int64)]).tolist()
    rng = random.Random(12)
    parts = [" ", "  ", "\n", "\t", "\u3000", "\xa0", "\x1c", "\x85", "a", "b7", "...", "é", " the", "\u2003"]
    monkeypatch.setattr(tc, "_LONG", re.compile(tc._LONG.pattern.replace(str(tc.LONG_RUN), "3")))
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        assert encoder.ends(text).tolist() == ends(text), repr(text)
    monkeypatch.undo()
    for text in (" " * 20_000 + "x", "x" + "\n" * 20_000, "y \t" * 9000):
        assert encoder.ends(text).tolist() == ends(text)
    # Longer than the library takes in one piece.
    for text in (" " * 1_000_000, "\n" * 1_000_000 + "x", "a" * 1_000_000, "!" * 1_000_000):
        assert encoder.ends(text)[-1] == len(text)


def test_workers_keep_no_words_after_a_task(spark):
    data = open(MODEL, "rb").read()
    encode_pieces(edge_frame(spark), MODEL).write.format("noop").mode("overwrite").save()

    def held(batches):
        for batch in batches:
            model = load(data)
            yield pa.RecordBatch.from_arrays([pa.array([len(model.cache) + len(model.older)] * batch.num_rows)], ["n"])

    tasks = spark.sparkContext.defaultParallelism
    assert {r.n for r in spark.range(0, 4 * tasks, 1, tasks).mapInArrow(held, "n long").collect()} == {0}
