"""Token counts by section: encode whole documents once, attribute tokens by their offsets.

A document is encoded as a whole, so counts are those a model would see. Each
token's byte span comes from the lengths of its bytes; sections are intervals of
the same text, and a sorted search inside the document joins the two. A token that
crosses a boundary goes by an explicit rule. One pass, no shuffle.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .common import free_names, map_batches, text_or_empty

RULES = ("start", "end", "most")
# Runs of white space (of Unicode) from this length on are not given to the pattern, whose look-ahead would nest as deep.
LONG_RUN = 4096
_LONG = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def line_starts(raw: bytes) -> np.ndarray:
    """Sections are lines: each begins after a line feed, which belongs to the line it ends."""
    after = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    starts = np.concatenate([np.zeros(1, np.int64), after])
    return starts[starts < max(len(raw), 1)]


class Encoder:
    """A byte-level vocabulary of ranks, with the number of bytes of each token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # A long run is one piece, but for its last character where text follows: that one may go with the next word.
        self.runs = tiktoken.Encoding("runs", pat_str=r"\s+", mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes; special tokens' names in a text are ordinary text."""
        ids: list[int] = []
        at = 0
        for run in _LONG.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self.encoding.encode_ordinary(text[at : run.start()])
            ids += self.runs.encode_ordinary(text[run.start() : end])
            at = end
        ids += self.encoding.encode_ordinary(text[at:])
        return np.cumsum(self.sizes[np.array(ids, np.int64)])


@lru_cache(maxsize=2)
def load(data: bytes, pattern: str) -> Encoder:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
    return Encoder(ranks, pattern)


def attribute(ends: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and those of them that cross a boundary.

    ``start``: a token belongs to the section of its first byte; ``end``: of its
    last byte; ``most``: to the section that has most of its bytes, the earliest of
    equal ones.
    """
    begins = np.append(np.zeros(1, np.int64), ends)[:-1]
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    crossing = first != last
    if rule == "start":
        own = first
    elif rule == "end":
        own = last
    else:
        own = first.copy()
        limits = np.append(starts, ends[-1] if len(ends) else 0)
        for i in np.flatnonzero(crossing):  # few: a token rarely holds a boundary
            inside = np.arange(first[i], last[i] + 1)
            shares = np.minimum(limits[inside + 1], ends[i]) - np.maximum(limits[inside], begins[i])
            own[i] = inside[shares.argmax()]
    return np.bincount(own, minlength=len(starts)), np.bincount(own[crossing], minlength=len(starts))


def token_counts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    sections: Callable[[bytes], np.ndarray] = line_starts,
    rule: str = "most",
    keep: Sequence[str] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """A row per section: ``keep`` columns, ``section`` (from 0), ``start`` and ``end`` (code points), ``n_tokens``, ``n_crossing``.

    ``sections`` gives the bytes at which sections start, 0 first. The counts of a
    document's sections sum to the tokens of the whole document. Patterns are expected
    to take a run of white space as one piece, without its last character where text
    follows. Texts of any length are encoded whole. Null and empty texts have one empty
    section without tokens. Rows that repeat are counted each
    by itself. An empty table gives no rows.
    """
    added = ("section", "start", "end", "n_tokens", "n_crossing")
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    if set(keep) & set(added):
        raise ValueError(f"columns to keep clash with {added}")
    data = Path(ranks_path).read_bytes()
    kept = docs.select(*keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    schema = ", ".join([*fields, "section long", "start long", "end long", "n_tokens long", "n_crossing long"])

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = load(data, pattern)
        rows: list[np.ndarray] = []
        found: list[list[np.ndarray]] = [[] for _ in added]
        for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            raw = text.encode()
            starts = sections(raw)
            tokens, crossing = attribute(encoder.ends(text), starts, rule)
            # Code points before each byte that begins one.
            points = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
            limits = np.append(starts, len(raw))
            places = np.where(limits > 0, points[np.minimum(limits, len(raw)) - 1] if len(raw) else 0, 0)
            for out, values in zip(found, (np.arange(len(starts)), places[:-1], places[1:], tokens, crossing), strict=True):
                out.append(values)
            rows.append(np.full(len(starts), i))
        taken = pa.array(np.concatenate(rows))
        columns = [c.take(taken) for c in batch.columns[:-1]] + [pa.array(np.concatenate(f), pa.int64()) for f in found]
        yield pa.RecordBatch.from_arrays(columns, [*keep, *added])

    [text] = free_names(kept, "text")
    return map_batches(docs.select(*keep, text_or_empty(text_col).alias(text)), step, schema, text, 4 << 20)
