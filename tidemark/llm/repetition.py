"""Quality rules: repetition inside a document, from suffix arrays.

A suffix array over a batch's words, with longest common prefixes, gives at each
word the longest string of words that starts there and elsewhere in the same
document. Those of ``MIN_WORDS`` or more are the maximal repeats; the union of
their spans and the longest of them are limited. One pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, text_or_empty
from .suffix_array import covered, longest_repeats

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
BASE_WORDS, BASE_REPEAT_PERCENT, WINDOW = 50, 50, 3


@dataclass(frozen=True)
class RepeatRules:
    """Repeats count from ``min_words`` words; a document keeps to both limits or goes."""

    min_words: int = 10
    max_covered: float = 0.3
    max_words: int = 60


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars", "longest_repeat")


def _dup_lines(raw: bytes) -> int:
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def batch_counts(texts: Sequence[bytes], rules: RepeatRules) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text (UTF-8)."""
    words = [t.split() for t in texts]  # on ASCII white space, as the rules say
    sizes = np.array([len(w) for w in words], np.int64)
    names: dict[bytes, int] = {}
    place = names.setdefault
    flat = np.array([place(w, len(names)) for own in words for w in own], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    chars = np.array([len(w) - _continuations(w) for w in names], np.int64)
    word_chars = chars[flat] if len(flat) else flat
    # Symbols carry their document; each document ends in a symbol of its own, which no match can pass.
    ends = np.cumsum(sizes + 1) - 1
    total = len(flat) + len(texts)
    symbols = np.empty(total, np.int64)
    inner = np.ones(total, bool)
    inner[ends] = False
    width = len(names) + 1
    symbols[inner] = doc * width + flat
    symbols[ends] = np.arange(len(texts)) * width + len(names)
    longest = longest_repeats(symbols)
    windows = np.where(longest >= WINDOW, WINDOW, 0)
    in_window = covered(windows)[inner]
    in_repeat = covered(np.where(longest >= rules.min_words, longest, 0))[inner]
    longest = longest[inner]

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, len(texts)).astype(np.int64)

    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, doc, longest)
    return {
        "n_words": sizes,
        "word_chars": per_doc(word_chars),
        "n_symbols": np.array([sum(map(t.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))) for t in texts], np.int64),
        "n_dup_lines": np.array([_dup_lines(t) for t in texts], np.int64),
        "n_repeat_words": per_doc(in_window),
        "covered_chars": per_doc(in_repeat * word_chars),
        "longest_repeat": most,
    }


def _continuations(word: bytes) -> int:
    return 0 if word.isascii() else sum(byte & 0xC0 == 0x80 for byte in word)


def repetition(docs: DataFrame, rules: RepeatRules = RepeatRules(), keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, the counts of ``COUNTS`` (long), ``base_failed`` and ``kept``, for every row.

    Null and empty texts have no words and fail the base rule. Rows that repeat
    are judged alike, each by itself. Names in ``keep`` may not be those of added
    columns. An empty table gives no rows.
    """
    added = [*COUNTS, "base_failed", "kept"]
    if set(keep) & set(added):
        raise ValueError(f"columns to keep clash with {added}")
    kept = docs.select(*keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    schema = ", ".join([*fields, *[f"{c} long" for c in COUNTS], "base_failed boolean", "kept boolean"])

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
        c = batch_counts(texts, rules)
        failed = (c["n_words"] < BASE_WORDS) | (100 * c["n_repeat_words"] > BASE_REPEAT_PERCENT * c["n_words"])
        within = (c["covered_chars"] <= rules.max_covered * c["word_chars"]) & (c["longest_repeat"] <= rules.max_words)
        columns = [*batch.columns[:-1], *[pa.array(c[n]) for n in COUNTS], pa.array(failed), pa.array(~failed & within)]
        yield pa.RecordBatch.from_arrays(columns, [*keep, *added])

    return map_batches(docs.select(*keep, text_or_empty(text_col).alias("__text")), step, schema, "__text", 1 << 20)
