"""Quality classifier: boosted trees over document statistics.

Statistics come from the text alone. The trees are fitted on a bounded sample of
labelled rows, chosen by a hash of the id over all of them, and travel with the
tasks; scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosted_trees import FlatTrees, TreeParams, fit_trees
from .common import text_or_empty

# The bound on labelled rows a fit looks at.
TRAIN_ROWS = 20_000
# Score from which a document is predicted to be good.
ACCEPT = 0.7

# Byte classes: upper case, lower case, digits, white space, marks of junk, other punctuation, bytes beyond ASCII.
CLASSES = 7


def _byte_classes() -> np.ndarray:
    """Each byte value's class, as one row of indicators."""
    kind = np.full(256, 5)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 0, 1, 2, 6
    kind[[9, 10, 11, 12, 13, 32]] = 3
    kind[list(b"#*$%&|<>")] = 4
    return np.eye(CLASSES)[kind]


BYTES = _byte_classes()
NAMES = (
    *("upper", "lower", "digit", "space", "mark", "punctuation", "beyond"),
    *("log_words", "word_length", "distinct", "same_as_last", "top_word", "repeated_pairs"),
    *("log_lines", "repeated_lines", "line_words", "byte_entropy", "exclaim"),
)


def statistics(text: str) -> np.ndarray:
    """A row of numbers, defined for any text; an empty one gives zeros."""
    raw = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(raw, minlength=256)
    size = max(len(raw), 1)
    share = counts[counts > 0] / size
    words = text.split()
    n = max(len(words), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    return np.array(
        [
            *(counts @ BYTES / size),
            np.log1p(len(words)),
            sum(map(len, words)) / n,
            len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n,
            max(Counter(words).values(), default=0) / n,
            1 - pairs / max(len(words) - 1, 1) if len(words) > 1 else 0.0,
            np.log1p(len(lines)),
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            len(words) / max(len(lines), 1),
            -(share * np.log2(share)).sum(),
            counts[33] / n,
        ]
    )


def matrix(texts: Sequence[str]) -> np.ndarray:
    return np.stack([statistics(t) for t in texts]) if len(texts) else np.zeros((0, len(NAMES)))


# Texts that are Python strings at the same time.
SLICE = 256


def _rows(texts: pa.Array) -> Iterator[np.ndarray]:
    for at in range(0, len(texts), SLICE):
        yield matrix(texts.slice(at, SLICE).to_pylist())


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pa.Array) -> pa.Array:
    rows = np.concatenate([np.zeros((0, len(NAMES))), *_rows(texts)])
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Callable[[Column], Column], rows: int, id_col: str = "doc_id") -> DataFrame:
    """``__id, __text, __label`` of at most ``rows`` labelled documents, by a hash order over all of them.

    ``allowed`` says of an id column whether its label may be learned. Of an id
    with several labels the smallest counts. The chosen ids are at most ``rows``,
    which bounds what is broadcast.
    """
    own = labels.where(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min(label).cast("int").alias("__label"))
    chosen = own.where(allowed(F.col("__id"))).orderBy(F.xxhash64("__id"), "__id").limit(rows)
    texts = docs.select(F.col(id_col).alias("__id"), text_or_empty("text").alias("__text"))
    return texts.join(F.broadcast(chosen), "__id")


def fit_quality(
    docs: DataFrame, labels: DataFrame, allowed: Callable[[Column], Column], train_rows: int = TRAIN_ROWS, params: TreeParams = TreeParams()
) -> FlatTrees:
    """Trees for ``labels.quality``, learned from at most ``train_rows`` rows whose id ``allowed`` lets through."""
    sample = labelled_sample(docs, labels, "quality", allowed, train_rows).select("__id", "__label", _statistics("__text").alias("x"))
    # Repeated ids cannot make the sample larger; the order makes it the same on every run.
    rows = sample.orderBy(F.xxhash64("__id"), "__id", "x").limit(train_rows).toPandas()
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(NAMES)))
    return fit_trees(x, rows["__label"].to_numpy(float), params)


def quality_score(model: FlatTrees) -> Callable[[Column], Column]:
    """A column function from text to the chance of label 1."""

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *[model.score(rows) for rows in _rows(texts)]]))

    return lambda text: score(text_or_empty(text))


def classify(docs: DataFrame, model: FlatTrees, accept: float = ACCEPT, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``accept`` on) in place of columns of these names.

    Null and empty texts are scored by the statistics of an empty text. Rows
    that repeat score the same. An empty table gives no rows.
    """
    own = docs.drop("score", "predicted").withColumn("score", quality_score(model)(F.col(text_col)))
    return own.withColumn("predicted", (F.col("score") >= accept).cast("int"))
