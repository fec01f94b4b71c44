"""Benchmark decontamination by latent semantic retrieval, with checks of word order and answers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import written
from tidewright.llm.words import LETTERS_DIGITS, Sums, blocks

#: Document frequencies are counted in so many buckets of word hashes.
BUCKETS = 1 << 16
#: Words of a benchmark passage, which overlap by half, and of the windows of a document, which start every third of their width: of a passage of any
#: length from SHORT to 64 words, some window holds enough, and little else, for a cosine above 0.6.
PASSAGE, WIDTHS = 64, (24, 64)
#: A passage of fewer words is too short for a latent vector to tell it from what stands around it: it counts where all its words follow each other.
SHORT = 9
#: A latent space is of at most so many passages and has a dimension for each, so that it holds every passage whole.
RANK = 256
#: Least share of a window's TF-IDF mass in benchmark words, and least cosine, of a candidate.
LEAST_SHARE, LEAST_COSINE = 0.25, 0.42
#: Least share of an item's TF-IDF mass in the longest common subsequence: for a copy, and for a paraphrase that also has the answer's words.
COPY, PARAPHRASE, ANSWER = 0.75, 0.5, 0.8
#: Passages that one pass over the documents carries, in spaces of RANK: so many times PASSAGE words of RANK numbers are broadcast at most. More passages take more passes.
PASSAGES_A_PASS = 1024
#: Short passages that one pass carries beside them: so many times SHORT numbers at most.
SHORT_A_PASS = 100_000


def _words(texts: pa.Array):
    """(row, word hash) of all words of a column: letters and digits, A-Z lower-cased."""
    rows, hashes = [], []
    for b in blocks(texts, lower=True, word_bytes=LETTERS_DIGITS):
        rows.append(b.row + b.first_row)
        hashes.append(b.hashes())
    return (np.concatenate(rows), np.concatenate(hashes)) if rows else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of documents that have a word of each bucket; counted per task, then added up."""

    def run(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for b in blocks(batch.column(0), lower=True, word_bytes=LETTERS_DIGITS):
                seen = np.unique(b.row.astype(np.int64) * BUCKETS + (b.hashes() >> np.uint64(48)).astype(np.int64))
                total += np.bincount(seen % BUCKETS, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    got = docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[got["bucket"]] = got["n"]
    return docs.count(), out


def _weighted_sums(rows: DataFrame, key: str) -> DataFrame:
    """(key, vec): sums of w * vec. Summed per task first, so that a word of every passage brings a row a task."""

    def part(batches):
        for batch in batches:
            if batch.num_rows:
                keys, at = np.unique(batch.column(key).to_numpy(), return_inverse=True)
                x = batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, -1) * batch.column("w").to_numpy()[:, None]
                out = np.zeros((len(keys), x.shape[1]))
                np.add.at(out, at, x)
                yield pa.RecordBatch.from_arrays([pa.array(keys), _lists(out)], [key, "vec"])

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: [frame[key].iloc[0]], "vec": [np.sum(np.stack(frame["vec"]), axis=0)]})

    schema = f"{key} bigint, vec array<double>"
    return rows.select(key, "w", "vec").mapInArrow(part, schema).groupBy(key).applyInPandas(whole, schema)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, max(1, x.shape[1]), dtype=np.int32)), pa.array(x.ravel()))


def _gram(rows: DataFrame) -> np.ndarray:
    """Sum of vec vec^T over all rows: RANK x RANK numbers at most."""

    def part(batches):
        total = 0
        for batch in batches:
            if batch.num_rows:
                x = batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, -1)
                total = total + x.T @ x
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int64)), pa.array(np.ones(len(total))), _lists(total)], ["i", "w", "vec"])

    got = _weighted_sums(rows.select("vec").mapInArrow(part, "i bigint, w double, vec array<double>"), "i").toPandas().sort_values("i")
    return np.stack(got["vec"]) if len(got) else np.zeros((0, 0))


def _times(rows: DataFrame, matrix: np.ndarray, key: str) -> DataFrame:
    """Each vec times a small matrix."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(key), _lists(batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, -1) @ matrix)], [key, "vec"])

    return rows.select(key, "vec").mapInArrow(run, f"{key} bigint, vec array<double>")


def _whitener(gram: np.ndarray) -> np.ndarray:
    """What makes columns with this Gram matrix orthonormal, without those of no weight."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-9 * max(values.max(), 1e-30)
    return vectors[:, keep] / np.sqrt(values[keep])


def latent_space(terms: DataFrame, rank: int = RANK, rounds: int = 1) -> DataFrame:
    """(term, vec): right singular vectors of the matrix ``terms`` (pid, term, w), by a randomised SVD over distributed rows.

    Only ``rank`` x ``rank`` matrices reach the driver. A word's row of the random matrix is drawn from its own hash.
    """

    def draw(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.stack([np.random.Generator(np.random.PCG64(int(t) & (2**64 - 1))).standard_normal(rank) for t in batch.column(0).to_numpy()])
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(x)], ["term", "vec"])

    right = written(terms.select("term").distinct().mapInArrow(draw, "term bigint, vec array<double>"), "svd")
    for _ in range(rounds + 1):
        left = written(_weighted_sums(terms.join(right, "term"), "pid"), "svd")
        basis = _times(left, _whitener(_gram(left)), "pid")
        right = written(_weighted_sums(terms.join(basis, "pid"), "term"), "svd")
    return written(_times(right, _whitener(_gram(right)), "term"), "svd")


@dataclass
class Retriever:
    """What a pass over the documents carries: latent vectors of benchmark words and passages, and the passages' words."""

    idf: np.ndarray
    terms: np.ndarray
    vectors: np.ndarray
    passages: np.ndarray
    items: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]

    def weight(self, h: np.ndarray) -> np.ndarray:
        return self.idf[(h >> np.uint64(48)).astype(np.int64)]

    def search(self, row: np.ndarray, h: np.ndarray, n_rows: int) -> list[tuple[int, int, float, float, str]]:
        """(row, item, cosine, share of the item in order, kind) for each window and passage that pass all checks, the best a pair."""
        n = len(h)
        if not n:
            return []
        w2 = self.weight(h).astype(np.float64) ** 2
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        known = self.terms[at] == h
        if not known.any():
            return []
        mass, own = (np.concatenate([[0], np.cumsum(x)]) for x in (w2, np.where(known, w2, 0)))
        first = np.searchsorted(row, np.arange(n_rows + 1))
        spans = []
        for width in WIDTHS:
            step = width // 3
            place = np.arange(n) - first[row]
            begin = np.flatnonzero(place % step == 0)
            end = np.minimum(begin + width, first[row[begin] + 1])
            # A shorter window at a row's end adds nothing to the one before, unless it is the row's only one.
            ok = (end - begin == width) | (place[begin] == 0) | (begin + width - step < end)
            begin, end = begin[ok], end[ok]
            if not len(begin):
                continue
            share = (own[end] - own[begin]) / np.maximum(mass[end] - mass[begin], 1e-12)
            spans.append(np.stack([begin[share >= LEAST_SHARE], end[share >= LEAST_SHARE]], axis=1))
        spans = np.concatenate(spans)
        known_at = np.flatnonzero(known)
        upto = np.concatenate([[0], np.cumsum(known)])
        found = []
        for s in range(0, len(spans), 1024):
            part = spans[s : s + 1024]
            lo, count = upto[part[:, 0]], upto[part[:, 1]] - upto[part[:, 0]]
            words = known_at[np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            latent = np.add.reduceat(self.vectors[at[words]] * self.weight(h[words])[:, None], np.cumsum(count) - count)
            cosine = latent @ self.passages.T / np.sqrt(np.maximum(mass[part[:, 1]] - mass[part[:, 0]], 1e-12))[:, None]
            i, j = np.nonzero(cosine >= LEAST_COSINE)
            found.append(np.stack([row[part[i, 0]], j, part[i, 0], part[i, 1], cosine[i, j]], axis=1))
        found = np.concatenate(found) if found else np.zeros((0, 5))
        out: dict[tuple[int, int], tuple] = {}
        done: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r, j, b, e, cosine in found[np.argsort(-found[:, 4], kind="stable")].tolist():
            key = r, j = int(r), int(j)
            if key in out and out[key][1] >= COPY:
                continue
            lo, hi = max(first[r], int(b) - len(self.words[j])), min(first[r + 1], int(e) + len(self.words[j]))
            if any(x <= lo and hi <= y for x, y in done.get(key, ())):
                continue
            done.setdefault(key, []).append((lo, hi))
            kind, share = self.check(h[lo:hi], j)
            if kind and (key not in out or share > out[key][1]):
                out[key] = (cosine, share, kind)
        return [(r, self.items[j], *v) for (r, j), v in out.items()]

    def check(self, h: np.ndarray, j: int) -> tuple[str, float]:
        """Longest common subsequence of a passage and a stretch of words, weighed by IDF, as a share of the passage."""
        words, weight = self.words[j], self.weight(self.words[j])
        if weight[np.isin(words, h)].sum() < PARAPHRASE * weight.sum():  # in whatever order
            return "", 0.0
        row = np.zeros(len(h) + 1)
        for word, w in zip(words, weight, strict=True):
            step = np.where(h == word, row[:-1] + w, row[1:])
            row[1:] = np.maximum.accumulate(np.maximum(step, row[1:]))
        share = float(row[-1] / max(weight.sum(), 1e-12))
        if share >= COPY:
            return "copy", share
        answer = self.answers[j]
        if share >= PARAPHRASE and len(answer):
            a = self.weight(answer)
            if a[np.isin(answer, h)].sum() >= ANSWER * a.sum():
                return "paraphrase", share
        return "", share


class ShortPassages:
    """Passages of fewer than SHORT words, to be found where all their words follow each other."""

    def __init__(self, items: list[int], words: list[np.ndarray]):
        self.found: dict[int, dict[bytes, list[int]]] = {}
        for item, w in zip(items, words, strict=True):
            self.found.setdefault(len(w), {}).setdefault(w.tobytes(), []).append(item)
        self.keys = {m: np.unique([Sums(np.frombuffer(w, dtype=np.uint64)).of(np.zeros(1, dtype=np.int64), np.full(1, m))[0] for w in by]) for m, by in self.found.items()}

    def search(self, row: np.ndarray, h: np.ndarray, n_rows: int) -> list[tuple[int, int, float, float, str]]:
        """(row, item, 1, 1, "copy") of each row and passage in it. Hashes of stretches only propose; their words decide."""
        out, sums = set(), Sums(h)
        for m, keys in self.keys.items():
            begin = np.flatnonzero(row[: max(0, len(h) - m + 1)] == row[m - 1 :]) if len(h) >= m else np.zeros(0, dtype=np.int64)
            k = sums.of(begin, begin + m)
            for i in begin[keys[np.minimum(np.searchsorted(keys, k), len(keys) - 1)] == k].tolist():
                out.update((int(row[i]), item) for item in self.found[m].get(h[i : i + m].tobytes(), ()))
        return [(r, item, 1.0, 1.0, "copy") for r, item in sorted(out)]


def benchmark_passages(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words array<bigint>, answer array<bigint>): items in passages of PASSAGE words that overlap by half, the last one whole.

    The answer of a passage is what its item says after the last break between sentences, where that lies in the passage; else its last quarter.
    """

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sentences = [s for s in (text or "").replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if any(c.isalnum() for c in s)]
                h = _words(pa.array([text or ""]))[1]
                last = len(_words(pa.array(sentences[-1:] or [""]))[1]) if len(sentences) > 1 else 0
                for at in [0, *range(PASSAGE // 2, len(h) - PASSAGE // 2, PASSAGE // 2)]:
                    words = h[max(0, min(at, len(h) - PASSAGE)) : at + PASSAGE]
                    tail = last if 0 < last < len(words) and at + PASSAGE >= len(h) else -(-len(words) // 4)
                    if len(words):
                        yield pa.RecordBatch.from_arrays([pa.array([item], pa.int64()), pa.array([words.view(np.int64)], pa.list_(pa.int64())), pa.array([words[len(words) - tail :].view(np.int64)], pa.list_(pa.int64()))], ["item_id", "words", "answer"])

    return benchmark.select(F.col(id_col).cast("bigint"), text_col).mapInArrow(run, "item_id bigint, words array<bigint>, answer array<bigint>")


def _retriever(idf: np.ndarray, passages: DataFrame, terms: DataFrame, low: int, high: int) -> Retriever:
    """The passages from ``low`` to below ``high``, RANK at most, in a latent space of their own, of as many dimensions as there are passages."""
    inside = (F.col("pid") >= low) & (F.col("pid") < high)
    terms = terms.filter(inside)
    space = latent_space(terms, high - low)
    rows = _weighted_sums(terms.join(space, "term"), "pid").join(passages.filter(inside), "pid").toPandas().sort_values("pid")
    own = space.toPandas()
    keys = own["term"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    unit = np.stack(rows["vec"]).astype(np.float32)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    as_hashes = lambda x: [np.asarray(v, dtype=np.int64).view(np.uint64) for v in x]
    return Retriever(idf, keys[order], np.stack(own["vec"]).astype(np.float32)[order], unit, rows["item_id"].tolist(), as_hashes(rows["words"]), as_hashes(rows["answer"]))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, in_order, kind) from docs (doc_id, text) and benchmark (item_id, text)."""
    spark = docs.sparkSession
    n_docs, df = document_frequencies(docs)
    idf = np.log((n_docs + 1) / (df + 1)).astype(np.float32) + np.float32(0.01)
    passages = written(benchmark_passages(benchmark, "item_id", "text"), "passages")
    schema = "doc_id bigint, item_id bigint, cosine double, in_order double, kind string"
    short = passages.filter(F.size("words") < SHORT).select("item_id", "words").toPandas()
    passages = written(passages.filter(F.size("words") >= SHORT).withColumn("pid", F.monotonically_increasing_id()), "passages")
    # ``pid`` has the partition above its lower 33 bits; passages are counted through over all partitions.
    sizes = sorted(passages.groupBy(F.shiftright("pid", 33).alias("p")).count().collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    if sizes:
        shift = F.create_map(*[F.lit(x) for (p, _), k in zip(sizes, before, strict=False) for x in (p, k - (p << 33))])
        passages = written(passages.withColumn("pid", F.col("pid") + shift[F.shiftright("pid", 33)]), "passages")
    exploded = passages.select("pid", F.explode("words").alias("term")).groupBy("pid", "term").count()

    def weigh(batches):
        for batch in batches:
            terms = batch.column("term").to_numpy()
            w = idf[(terms.view(np.uint64) >> np.uint64(48)).astype(np.int64)].astype(float) * batch.column("count").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("pid"), batch.column("term"), pa.array(w)], ["pid", "term", "w"])

    terms = exploded.mapInArrow(weigh, "pid bigint, term bigint, w double")
    # Passages of one length each: a space spans the same, and none is lost for its small weight.
    norms = terms.groupBy("pid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    terms = written(terms.join(norms, "pid").select("pid", "term", (F.col("w") / F.col("norm")).alias("w")), "terms")
    out = spark.createDataFrame([], schema)
    for turn in range(max(-(-before[-1] // PASSAGES_A_PASS), -(-len(short) // SHORT_A_PASS))):
        low, part = turn * PASSAGES_A_PASS, short.iloc[turn * SHORT_A_PASS : (turn + 1) * SHORT_A_PASS]
        carried: list = [_retriever(idf, passages, terms, k, min(k + RANK, before[-1])) for k in range(low, min(low + PASSAGES_A_PASS, before[-1]), RANK)]
        if len(part):
            carried.append(ShortPassages(part["item_id"].tolist(), [np.asarray(w, dtype=np.int64).view(np.uint64) for w in part["words"]]))
        shared = spark.sparkContext.broadcast(carried)

        def run(batches, shared=shared):
            for batch in batches:
                ids = batch.column("doc_id")
                for b in blocks(batch.column("text"), lower=True, word_bytes=LETTERS_DIGITS):
                    h = b.hashes()
                    for retriever in shared.value:
                        if found := retriever.search(b.row, h, b.n_rows):
                            row, item, cosine, share, kind = zip(*found, strict=True)
                            yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.asarray(row) + b.first_row)), pa.array(item, pa.int64()), pa.array(cosine, pa.float64()), pa.array(share, pa.float64()), pa.array(kind, pa.string())], ["doc_id", "item_id", "cosine", "in_order", "kind"])

        pairs = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = out.unionByName(pairs)
    return out.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("in_order").alias("in_order"), F.min("kind").alias("kind"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, contaminated, items (array of struct item_id, cosine, in_order, kind).

    Words are letters and digits, A-Z lower-cased; IDF counts all documents. Blocks of RANK benchmark passages span a latent space each, of full rank, by
    a randomised SVD of their TF-IDF rows. Windows of every whole text, of two widths, that have enough mass in benchmark words are projected and compared with all
    passages by cosine; of candidates, the longest common subsequence with the passage is weighed: enough of it is a copy, and less of
    it a paraphrase if the window also has the words of the passage's answer. Passages of fewer than SHORT words count where all their words follow each other.

    Null and empty texts and items match nothing; nor do rows with a null id, which come back as not contaminated. Rows that repeat an id
    share their result. An empty benchmark gives no matches. Other columns are not read. Ids are whole numbers.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text"))
    pairs = written(contaminated_pairs(rows, items), "contaminated")
    by_doc = pairs.filter("doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("item_id", "cosine", "in_order", "kind"))).alias("items"))
    out = rows.select("doc_id").join(by_doc, "doc_id", "left")
    none = F.array().cast("array<struct<item_id:bigint,cosine:double,in_order:double,kind:string>>")
    return out.select(F.col("doc_id").alias(id_col), F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"))
