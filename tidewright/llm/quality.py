"""Quality classifier: regularised quadratic discriminant over statistics of a document's whole text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import held_out, written
from tidewright.llm.words import Sums, blocks, mix

#: Byte classes: other, white space but line feed, line feed, lower, upper, digit, sentence punctuation, other ASCII symbols, parts of multi-byte characters.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 1
_CLASS[0x0A] = 2
_CLASS[0x61:0x7B] = 3
_CLASS[0x41:0x5B] = 4
_CLASS[0x30:0x3A] = 5
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 6
_CLASS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 7
_CLASS[0x80:] = 8

STATISTICS = (
    "log_words", "log_lines", "word_bytes", "word_spread", "white", "lower", "upper", "digits", "punctuation", "symbols", "multibyte",
    "short_words", "long_words", "words_ending_in_symbols", "symbol_words", "distinct_words", "repeated_pairs", "repeated_lines", "words_per_line", "entropy",
)


def _statistics(b) -> np.ndarray:
    """A row of STATISTICS for each row of a block. Shares are taken to their square roots, counts to logarithms."""
    n, size = b.n_rows, np.diff(b.offsets)
    of_byte = np.repeat(np.arange(n), size)
    shares = np.bincount(of_byte * 9 + _CLASS[b.data], minlength=n * 9).reshape(n, 9) / np.maximum(size, 1)[:, None]
    words = np.diff(b.first)
    some, per = np.maximum(words, 1), lambda x: np.bincount(b.row, weights=x, minlength=n)
    length = (b.ends - b.starts).astype(float)
    mean = per(length) / some
    spread = np.sqrt(np.maximum(per(length**2) / some - mean**2, 0))
    last, first = _CLASS[b.data[b.ends - 1]], _CLASS[b.data[b.starts]]
    hashes = b.hashes()

    def distinct(keys, rows):
        """Distinct keys of each row."""
        both = np.lexsort((keys, rows))
        k, r = keys[both], rows[both]
        new = np.ones(len(k), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        return np.bincount(r[new], minlength=n)

    pairs = np.flatnonzero(b.row[1:] == b.row[:-1]) if len(b.row) else np.zeros(0, dtype=np.int64)
    n_pairs = np.bincount(b.row[pairs], minlength=n)
    new_pairs = distinct(mix(hashes[pairs] * np.uint64(3) + hashes[pairs + 1]), b.row[pairs]) if len(pairs) else np.zeros(n)
    # A line is what lies between line feeds; those without words don't count.
    line = np.cumsum(b.data == 0x0A)[b.starts] if len(b.starts) else np.zeros(0, dtype=np.int64)
    begin = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (b.row[1:] != b.row[:-1])])) if len(line) else np.zeros(0, dtype=np.int64)
    lines = np.bincount(b.row[begin], minlength=n)
    new_lines = distinct(Sums(hashes).of(begin, np.append(begin[1:], len(line))), b.row[begin]) if len(begin) else np.zeros(n)
    bytes_of = np.bincount(of_byte * 64 + (b.data >> 2), minlength=n * 64).reshape(n, 64) / np.maximum(size, 1)[:, None]
    entropy = -(bytes_of * np.log2(np.where(bytes_of > 0, bytes_of, 1))).sum(axis=1)
    share = lambda x: np.sqrt(x)
    columns = [
        np.log1p(words), np.log1p(lines), np.log1p(mean), np.log1p(spread), share(shares[:, 1]), share(shares[:, 3]), share(shares[:, 4]), share(shares[:, 5]), share(shares[:, 6]), share(shares[:, 7]), share(shares[:, 8]),
        share(per(length <= 3) / some), share(per(length > 12) / some), share(per(last == 7) / some), share(per((first == 7) & (last == 7)) / some), (distinct(hashes, b.row) if len(hashes) else np.zeros(n)) / some,
        share(1 - new_pairs / np.maximum(n_pairs, 1)) * (n_pairs > 0), share(1 - new_lines / np.maximum(lines, 1)) * (lines > 0), np.log1p(words / np.maximum(lines, 1)), entropy,
    ]
    return np.stack(columns, axis=1)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats array<double>) of every whole text, in the order of STATISTICS; a null or empty text has zeros."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for b in blocks(batch.column(1)):
                x = _statistics(b)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(b.first_row, b.n_rows), flat], [id_col, "stats"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, stats array<double>")


@dataclass
class QuadraticDiscriminant:
    """For each class: prior, mean and the lower Cholesky factor of its shrunk covariance, computed once."""

    priors: np.ndarray
    means: np.ndarray
    factors: np.ndarray

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        """Per row and class: log prior + Gaussian log density, from the Mahalanobis distance by forward substitution."""
        out = np.empty((len(x), len(self.priors)))
        for c, (prior, mean, factor) in enumerate(zip(self.priors, self.means, self.factors, strict=True)):
            z = np.linalg.solve(factor, (x - mean).T)
            out[:, c] = np.log(prior) - 0.5 * (z**2).sum(axis=0) - np.log(np.diag(factor)).sum()
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of the last class."""
        d = self.log_densities(x)
        return 1 / (1 + np.exp(np.clip(d[:, 0] - d[:, 1], -700, 700)))


def fit_quadratic_discriminant(rows: DataFrame, shrink: float = 0.1, ridge: float = 1e-4) -> QuadraticDiscriminant | None:
    """From ``rows`` (stats, label 0 or 1). Each covariance is (1 - shrink) own + shrink pooled, plus ridge on the diagonal.

    Count, sum and sum of products of each class are added up per task, then by Spark: 2 * (1 + d + d * d) numbers reach the driver.
    None if a class has no rows.
    """

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            x = batch.column("stats").flatten().to_numpy().reshape(len(labels), -1)
            for c in np.unique(labels):
                own = x[labels == c]
                part = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                total[int(c)] = total.get(int(c), 0) + part
        for c, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), c, dtype=np.int32)), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], ["label", "k", "v"])

    got = rows.select("label", "stats").mapInArrow(run, "label int, k int, v double").groupBy("label", "k").agg(F.sum("v").alias("v")).collect()
    by = {c: np.array([r["v"] for r in sorted((r for r in got if r["label"] == c), key=lambda r: r["k"])]) for c in (0, 1)}
    if any(not len(v) for v in by.values()):
        return None
    d = len(STATISTICS)
    counts = np.array([by[c][0] for c in (0, 1)])
    means = np.array([by[c][1 : d + 1] / counts[c] for c in (0, 1)])
    own = [by[c][d + 1 :].reshape(d, d) / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (own[0] * counts[0] + own[1] * counts[1]) / counts.sum()
    factors = np.array([np.linalg.cholesky((1 - shrink) * s + shrink * pooled + ridge * np.eye(d)) for s in own])
    return QuadraticDiscriminant(counts / counts.sum(), means, factors)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", shrink: float = 0.1) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (probability of label 1), predicted (1 if score >= 0.5, else 0).

    The model learns from the ids in ``labels`` that are not held out (crc32 of the id modulo 3 is 1); text statistics are its only inputs.
    Text is read once and never shuffled; the statistics, a few numbers a document, are kept as a table.

    A null or empty text has zeros for statistics and is scored like any other. Labels that are null or neither 0 nor 1 are ignored, an id
    with several counts several times. Where a class has no rows to learn from, each score is the share of label 1, or 0.5 without labels.
    Repeated rows are scored alike; a null id is not held out. Other columns are not read.
    """
    stats = written(text_statistics(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text"), "text-statistics")
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isin(0, 1) & ~held_out(F.col("_id")))
    model = fit_quadratic_discriminant(stats.join(known, "_id"), shrink)
    if model is None:
        share = known.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
        scored = stats.select("_id", F.lit(float(share)).alias("score"))
    else:
        kind = docs.schema[id_col].dataType.simpleString()

        def run(batches):
            for batch in batches:
                x = batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(model.probability(x))], ["_id", "score"])

        scored = stats.mapInArrow(run, f"_id {kind}, score double")
    return scored.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
