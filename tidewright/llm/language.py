"""Language identification by words first, backing off to ever shorter character n-grams."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import held_out, written

#: The model learns from about so many documents a language, taken by hash of the id, and keeps all their words, and their n-grams up to LONGEST.
DOCS_A_LANGUAGE, LONGEST = 2000, 4
#: Words that a Python worker remembers with their scores.
WORD_MEMORY = 200_000
_RUNS = re.compile(r"[^\W\d_]+")


def _words(text: str) -> list[str]:
    """Maximal runs of letters, in lower case. The pattern also takes other numerals, such as fractions and superscripts, for letters: they part words."""
    runs = _RUNS.findall(text.lower())
    if all(map(str.isalpha, runs)):
        return runs
    return [w for run in runs for w in "".join(c if c.isalpha() else " " for c in run).split()]


def _grams(word: str, n: int) -> list[str]:
    """N-grams of the word with marked ends; single letters without the marks."""
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def learn_language_counts(docs: DataFrame) -> DataFrame:
    """(lang, n, gram, count) over ``docs`` (lang, text): n is 0 for words, else the length of an n-gram. Counted per task, then added up."""

    def run(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts.setdefault(lang, Counter()).update(_words(text))
        for lang, words in counts.items():
            for n in range(LONGEST + 1):
                if n == 0:
                    found = words
                else:
                    found = Counter()
                    for word, c in words.items():
                        for g in _grams(word, n):
                            found[g] += c
                grams = list(found)
                for i in range(0, len(grams), 50_000):
                    part = grams[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(np.full(len(part), n, dtype=np.int32)), pa.array(part), pa.array([found[g] for g in part], pa.int64())], ["lang", "n", "gram", "count"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, n int, gram string, count bigint").groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


class LanguageModel:
    """Log frequencies of words and n-grams in each language."""

    def __init__(self, counts: pa.Table):
        """From the counts of a bounded number of documents: (lang, n, gram, count)."""
        self.languages = sorted(counts.column("lang").unique().to_pylist())
        totals: Counter = Counter()
        tables: dict[int, dict[str, dict[str, int]]] = {n: {} for n in range(LONGEST + 1)}
        for batch in counts.to_batches(max_chunksize=50_000):
            for lang, n, gram, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                totals[n, lang] += count
                tables[n].setdefault(gram, {})[lang] = count
        self.tables = {}
        for n, grams in tables.items():
            floor = [math.log(0.5 / (totals[n, lang] + 1)) for lang in self.languages]
            size = [math.log(totals[n, lang] + 1) for lang in self.languages]
            self.tables[n] = {g: tuple(math.log(c[lang]) - size[i] if lang in c else floor[i] for i, lang in enumerate(self.languages)) for g, c in grams.items()}

    def word(self, word: str) -> tuple[float, ...] | None:
        """Log frequencies of a word; of an unseen one the mean of its longest n-grams that are known at all; None if not even a letter is."""
        if word in self.tables[0]:
            return self.tables[0][word]
        for n in range(LONGEST, 0, -1):
            table = self.tables[n]
            if known := [table[g] for g in _grams(word, n) if g in table]:
                return tuple(sum(x) / len(known) for x in zip(*known, strict=True))
        return None


_memory: dict[str, tuple[dict, list]] = {}


def _scorer(model: LanguageModel, key: str):
    """Scores of texts, with a memory of words that lives as long as the Python worker, for one model at a time."""
    if key not in _memory:
        _memory.clear()
        _memory[key] = ({}, [(0.0,) * len(model.languages)])
    places, rows = _memory[key]

    table: np.ndarray | None = None
    filled = 0

    def score(texts: list[str | None]) -> list[tuple[str, float]]:
        nonlocal table, filled
        out = []
        for text in texts:
            words = _words(text) if text else []
            if not words or not model.languages:
                out.append(("und", 0.0))
                continue
            total = np.zeros(len(model.languages))
            for i in range(0, len(words), 100_000):
                counts = Counter(words[i : i + 100_000])
                new = [w for w in counts if w not in places]
                if len(rows) + len(new) > WORD_MEMORY:
                    places.clear()
                    del rows[1:]
                    table, new = None, list(counts)
                for w in new:
                    found = model.word(w)
                    places[w] = len(rows) if found else 0
                    if found:
                        rows.append(found)
                if table is None or len(table) < len(rows):
                    grown = np.zeros((max(4096, 2 * len(rows)), len(model.languages)))
                    grown[: len(rows)] = rows
                    table = grown
                elif len(rows) > filled:
                    table[filled : len(rows)] = rows[filled:]
                filled = len(rows)
                at = np.fromiter((places[w] for w in counts), dtype=np.int64, count=len(counts))
                total += np.fromiter(counts.values(), dtype=float, count=len(counts)) @ table[at]
            weight = np.exp(total - total.max())
            best = int(np.argmax(total))
            out.append((model.languages[best], float(weight[best] / weight.sum())))
        return out

    return score


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_a_language: int = DOCS_A_LANGUAGE) -> LanguageModel:
    """Learn from rows with a language, text, and an id that is not held out: about ``docs_a_language`` of each, by hash of the id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    sizes = rows.groupBy("lang").count().collect()
    share = F.lit(0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], int(min(1.0, docs_a_language / r["count"]) * 1_000_000)).otherwise(share)
    counts = written(learn_language_counts(rows.filter(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1_000_000)) < share)), "language-counts")
    return LanguageModel(counts.select("lang", "n", "gram", "count").toArrow())


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_a_language: int = DOCS_A_LANGUAGE) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score.

    Every whole text is scored: each word, in lower case, by its log frequency in each language, an unseen word by its n-grams. The score
    is the share of the best language in the exponentiated sums; of equal languages the first in the alphabet wins.

    A text that is null or has no letter is "und" with score 0, and so is every text if there is nothing to learn from. A null id is not held out.
    Repeated rows are scored alike. Other columns are not read.
    """
    model = fit_language_model(docs, id_col, text_col, lang_col, docs_a_language)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    key = uuid.uuid4().hex
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        score = _scorer(shared.value, key)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                found = score(part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, lang_pred string, score double")
    return rows.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "lang_pred", "score")
