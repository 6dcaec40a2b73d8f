"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Each text gives a dozen statistics (lengths, shares of kinds of characters, repetition), put on scales where a class is
roughly normal. The fit needs only counts, sums and sums of products for each class, which Spark adds up. Class
covariances are shrunk towards the common one and its diagonal; their Cholesky factors are inverted once, and the score
is the difference of the two log densities by Mahalanobis distance, as a probability.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import binary_array, chunks, packed, ranges, row_type, runs, sums, text_bytes, unpacked

#: Weight of the common covariance and of its diagonal in a class's covariance.
COMMON, DIAGONAL = 0.10, 0.05

FEATURES = [
    "log_words", "word_length", "word_length_spread", "symbols", "marks", "pipes", "digits", "capitals", "capital_words",
    "distinct_words", "repeated_windows", "repeated_lines", "line_length", "top_word", "closed_lines",
]

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _bytes_in(text: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(text)] = True
    return table


_SYMBOLS, _MARKS, _PIPES = _bytes_in(b"#*$%&<>@^~=_{}[]\\+"), _bytes_in(b"!?"), _bytes_in(b"|")
_DIGITS, _CAPITALS, _CLOSING = _bytes_in(bytes(range(48, 58))), _bytes_in(bytes(range(65, 91))), _bytes_in(b".!?:;\"')")
_LETTERS = _bytes_in(bytes([*range(65, 91), *range(97, 123)]))


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log odds of a share, drawn towards a small one by half a case in fifty."""
    share = (part + 0.1) / (whole + 10.0)
    return np.log(share / (1.001 - np.minimum(share, 1.0)))


def _times(key: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each document, and how often its most frequent one occurs."""
    values, times = np.unique((doc << 32) | key, return_counts=True)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, values >> 32, times)
    return np.bincount(values >> 32, minlength=n), most


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text; null and empty texts alike."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    found, firsts = runs(~_SPACE[data], offsets, data)
    count = np.diff(firsts)
    doc = np.repeat(np.arange(n), count)
    chars = sums((~_SPACE[data]) & ((data & 0xC0) != 0x80), offsets)
    size = np.diff(np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1])
    capitals, letters = _CAPITALS[data], _LETTERS[data]
    word_bytes = ~_SPACE[data]
    inner = np.concatenate([[0], np.cumsum(size)])
    capital_words = np.bincount(doc, weights=sums(capitals[word_bytes], inner) * 2 > np.maximum(size, 3), minlength=n)
    codes = found.dictionary_encode().indices.to_numpy().astype(np.int64) if len(found) else np.zeros(0, np.int64)
    distinct, top = _times(codes, doc, n)
    # windows of three words that a text has more than once
    windows = np.maximum(count - 2, 0)
    at, of = ranges(firsts[:-1], windows), np.repeat(np.arange(n), windows)
    key = (codes[at] * 1_000_003 + codes[at + 1]) * 1_000_003 + codes[at + 2] if len(at) else at
    distinct_windows, _ = _times(key & 0x7FFFFFFF, of, n)
    # lines
    # (where a document ends and the next begins with a break, the end comes first)
    ends = np.concatenate([offsets[1:], np.flatnonzero(data == 10)])
    order = np.argsort(ends, kind="stable")
    ends, is_break = ends[order], order >= n
    line_doc = np.repeat(np.arange(n), sums(data == 10, offsets) + 1)
    lines = binary_array(data[data != 10], np.concatenate([[0], ends - (np.cumsum(is_break) - is_break)])).dictionary_encode()
    full = sums(~_SPACE[data], np.concatenate([[0], ends])) > 0
    n_lines = np.bincount(line_doc[full], minlength=n)
    distinct_lines, _ = _times(lines.indices.to_numpy()[full].astype(np.int64), line_doc[full], n)
    closed = np.bincount(line_doc[full], weights=_CLOSING[data[np.maximum(ends[full] - 1, 0)]] if len(data) else None, minlength=n)
    mean = np.bincount(doc, weights=size, minlength=n) / np.maximum(count, 1)
    square = np.bincount(doc, weights=size.astype(float) ** 2, minlength=n) / np.maximum(count, 1)
    return np.stack([
        np.log1p(count), np.log1p(mean), np.log1p(np.sqrt(np.maximum(square - mean**2, 0))),
        _share(sums(_SYMBOLS[data], offsets), chars), _share(sums(_MARKS[data], offsets), chars), _share(sums(_PIPES[data], offsets), chars),
        _share(sums(_DIGITS[data], offsets), chars), _share(sums(capitals, offsets), sums(letters, offsets)), _share(capital_words, count),
        # of so many words about so many are expected to differ
        np.log((distinct + 1) / (np.maximum(count, 0) + 1) ** 0.9), _share(windows - distinct_windows, windows), _share(n_lines - distinct_lines, n_lines),
        np.log1p(chars / np.maximum(n_lines, 1)), _share(top, count), _share(closed, n_lines),
    ], axis=1)


@dataclass
class Discriminant:
    """A fitted model: log prior odds, and for each class its mean, inverse Cholesky factor and log determinant."""

    prior: float
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of features."""
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            density.append(-0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1) - 0.5 * log_det)
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.prior, -700, 700)))


def _moments(frame: DataFrame, label: str, size: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, mean and covariance of the features of each class, added up by Spark."""
    x = [F.col("features")[i] for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums_ = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)] + [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]
    out = {}
    for row in frame.groupBy(label).agg(F.count("*").alias("n"), *sums_).collect():
        n, mean = row["n"], np.array([row[f"s{i}"] for i in range(size)]) / row["n"]
        product = np.zeros((size, size))
        for i, j in pairs:
            product[i, j] = product[j, i] = row[f"p{i}_{j}"] / n
        out[row[label]] = (n, mean, product - np.outer(mean, mean))
    return out


def fit(features: DataFrame, label: str = "label", common: float = COMMON, diagonal: float = DIAGONAL) -> Discriminant:
    """The discriminant of rows with ``features`` (array of doubles) and a 0/1 label; null labels do not count.

    A class without rows has the mean and covariance of the other, so that the scores are the prior; without any
    rows they are one half.
    """
    size = len(FEATURES)
    found = _moments(features.where(F.col(label).isin(0, 1)), label, size)
    total = sum(n for n, _, _ in found.values())
    if not total:
        return Discriminant(0.0, np.zeros((2, size)), np.stack([np.eye(size)] * 2), np.zeros(2))
    pooled = sum(n * cov for n, _, cov in found.values()) / total
    spread = np.maximum(np.diag(pooled), 1e-4)
    means, factors, log_dets = [], [], []
    for c in (0, 1):
        n, mean, cov = found.get(c, (0, next(iter(found.values()))[1], pooled))
        # a class of few rows leans on the common covariance
        weight = min(1.0, common + size / max(n, 1) if n else 1.0)
        cov = (1 - weight) * cov + weight * pooled
        cov = (1 - diagonal) * cov + diagonal * np.diag(spread)
        lower = np.linalg.cholesky(cov + 1e-9 * np.eye(size))
        means.append(mean)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    prior = np.log((found.get(1, (0,))[0] + 1) / (found.get(0, (0,))[0] + 1))
    return Discriminant(float(prior), np.stack(means), np.stack(factors), np.array(log_dets))


def _measure(batches):
    for batch in batches:
        for chunk in chunks(batch):
            values = statistics(chunk.column("text"))
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES)), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([chunk.column("row"), listed], names=["row", "features"])


def _score(batches, model):
    for batch in batches:
        values = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.scores(values))], names=["row", "score"])


def measure(docs: DataFrame, carried: list[str], text: str = "text") -> DataFrame:
    """``carried`` as one struct ``row`` (see ``arrow.unpacked``) and ``features`` of each row of ``docs``.

    Null and empty texts have the same features, those of a text without words. Repeated rows are measured alike, an
    empty table gives no rows, and no column of ``docs`` can clash. Memory: a chunk of texts, or one longer text.
    """
    found = packed(docs, text, carried)
    row, _ = row_type(found)
    return found.mapInArrow(_measure, f"row {row}, features array<double>")


def score(features: DataFrame, model: Discriminant) -> DataFrame:
    """``row`` and ``score`` (probability of label 1) of measured rows, repeated ones alike; none of an empty table."""
    row, _ = row_type(features)
    return features.mapInArrow(lambda batches: _score(batches, model), f"row {row}, score double")
