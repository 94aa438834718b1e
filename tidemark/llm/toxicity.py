"""Toxicity: a weighted lexicon over folded text, normalised by length, with exception phrases.

Entries, weights and exceptions are learned from a bounded sample of labelled
documents; counts of candidates are folded in the tasks and summed by Spark, and
only entries that enough documents of the sample have reach the driver. Scoring is one
pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_or_empty, written
from .lexicon import Lexicon, fold_text
from .quality import labelled_sample

# The bound on labelled rows a fit looks at.
TRAIN_ROWS = 20_000
# Letters of a candidate: the start of a word, or a whole word.
SHORTEST, LONGEST = 3, 9
# Toxic documents an entry must occur in: this many, and this share of those in the sample.
LEAST, LEAST_SHARE = 4, 0.004
# Log odds an entry must reach.
LEAST_ODDS = 3.5
# Clean documents, and no toxic one, in which a phrase must make an entry harmless.
LEAST_EXCEPTION = 3


def candidates(folded: str) -> set[str]:
    """Word starts of ``SHORTEST`` to ``LONGEST`` letters and whole words up to that length, each with its space."""
    found: set[str] = set()
    for word in set(folded.split()):
        size = len(word)
        found.update([" " + word[:k] for k in range(SHORTEST, min(size, LONGEST) + 1)])
        if SHORTEST <= size <= LONGEST:
            found.add(f" {word} ")
    return found


def _counts(sample: DataFrame, of: Callable[[str], set[str]]) -> DataFrame:
    """``term, toxic, clean``: documents of each label that have the term, summed in the task before they are shuffled."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sums = Counter(), Counter()
        for text, label in zip(batch.column("__text").to_pylist(), batch.column("__label").to_pylist(), strict=True):
            sums[0 if label else 1].update(of(fold_text(text)))
        terms = list(sums[0] | sums[1])
        columns = [pa.array(terms, pa.string()), *[pa.array([s[t] for t in terms], pa.int64()) for s in sums]]
        yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "clean"])

    partial = map_batches(sample.select("__text", "__label"), step, "term string, toxic long, clean long", "__text", 16 << 20)
    return partial.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_odds(toxic: Column | float, clean: Column | float, toxic_docs: int, clean_docs: int, log: Callable) -> Column | float:
    return log((toxic + 0.5) / (toxic_docs + 1.0)) - log((clean + 0.5) / (clean_docs + 1.0))


def _prune(rows: Sequence[tuple[str, int, float]]) -> dict[str, float]:
    """Entries without those that only repeat a shorter one: the start of a kept entry that is as telling covers it."""
    kept: dict[str, float] = {}
    for term, _, odds in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if not any(kept.get(term[:k], -1.0) >= odds - 0.7 for k in range(SHORTEST + 1, len(term))):
            kept[term] = odds
    return kept


def _phrases(lexicon: Lexicon) -> Callable[[str], set[str]]:
    """Each hit's word with the word before, and with the word after."""

    def of(folded: str) -> set[str]:
        found: set[str] = set()
        for start, end, _ in lexicon.hits(folded):
            stop = folded.find(" ", max(end - 1, start + 1))
            word = folded[start : stop if stop >= 0 else len(folded)]
            before, after = folded[:start].rsplit(None, 1)[-1:], folded[start + len(word) :].split(None, 1)[:1]
            # Only where one space lies between, as in the automaton's text.
            found.update(p for p in (f" {before[0]}{word} " if before else "", f"{word} {after[0]} " if after else "") if p and p in folded)
        return found

    return of


def sums(lexicon: Lexicon, texts: Sequence[str]) -> np.ndarray:
    """Per text: the log of the summed weights, and of that sum per thousand words; a repeated entry adds ever less."""
    out = np.zeros((len(texts), 2))
    for i, text in enumerate(texts):
        folded = fold_text(text)
        found = Counter(entry for _, _, entry in lexicon.hits(folded))
        total = sum(lexicon.weights[entry] * (1 + np.log(n)) for entry, n in found.items())
        if total:
            out[i] = np.log1p(total), np.log1p(1000 * total / max(folded.count(" "), 1))
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression of two sums by Newton steps; no sum lowers the score."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 0.1, 0.1])
        step = np.linalg.solve(hess, design.T @ (y - p) - np.array([0, 0.1, 0.1]) * beta)
        beta += step
        if abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1]), float(beta[2])


def fit_lexicon(docs: DataFrame, labels: DataFrame, allowed: Callable[[Column], Column], train_rows: int = TRAIN_ROWS) -> Lexicon:
    """A lexicon for ``labels.toxic``, from at most ``train_rows`` labelled rows whose id ``allowed`` lets through.

    Without toxic or without clean rows it is empty and every score is the same.
    """
    # Read four times below: for the labels, the entries, the exceptions and the scale.
    sample = written(labelled_sample(docs, labels, "toxic", allowed, train_rows), "labelled")
    by_label = {r["__label"]: r["n"] for r in sample.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = by_label.get(1, 0), by_label.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, (), (-3.0 if not toxic else 3.0, 0.0, 0.0))
    counts = _counts(sample, candidates)
    odds = _log_odds(F.col("toxic"), F.col("clean"), toxic, clean, F.log)
    telling = counts.where(F.col("toxic") >= max(LEAST, LEAST_SHARE * toxic)).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    # Terms of a share of the bounded sample's toxic rows.
    rows = telling.select("term", "toxic", "odds").collect()
    lexicon = Lexicon(_prune([(r["term"], r["toxic"], r["odds"]) for r in rows]))
    harmless = _counts(sample, _phrases(lexicon)).where((F.col("toxic") == 0) & (F.col("clean") >= LEAST_EXCEPTION))
    phrases = harmless.select("term").collect()
    lexicon = Lexicon(lexicon.weights, tuple(sorted(r["term"] for r in phrases)))
    told = sample.select("__id", "__label", _sums_column(lexicon)("__text").alias("x"))
    table = told.orderBy(F.xxhash64("__id"), "__id", "x").limit(train_rows).toPandas()
    return Lexicon(lexicon.weights, lexicon.exceptions, _logistic(np.stack(table["x"].to_list()), table["__label"].to_numpy(float)))


def _sums_column(lexicon: Lexicon) -> Callable[[Column | str], Column]:
    @F.pandas_udf("array<double>")
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series(list(sums(lexicon, texts)), dtype=object)

    return column


def toxicity(docs: DataFrame, lexicon: Lexicon, accept: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``accept`` on) in place of columns of these names.

    Null and empty texts have no hits and get the score of a clean text. Rows
    that repeat score the same. An empty table gives no rows.
    """
    base, by_sum, by_rate = lexicon.scale

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = sums(lexicon, texts.to_list())
            yield pd.Series(1 / (1 + np.exp(-np.clip(base + by_sum * x[:, 0] + by_rate * x[:, 1], -30, 30))))

    own = docs.drop("score", "predicted").withColumn("score", score(text_or_empty(F.col(text_col))))
    return own.withColumn("predicted", (F.col("score") >= accept).cast("int"))
