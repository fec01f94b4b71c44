"""Spelling variants: words one edit apart, by range searches in k-d trees over letter counts."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import LOWER, UPPER, written

#: Dimensions of a letter-count vector: a to z, then all other code points folded into 64. Folding only shortens distances, so it loses no pair.
OTHERS = 64
DIMENSIONS = 26 + OTHERS
#: The upper splits of the trees are learned from about so many words, by hash; every word is indexed.
SAMPLE = 100_000
#: A tree is split until a cell holds about so many words; what falls into one cell beyond BLOCK words is dealt into blocks, and its searches visit all of them.
CELL, BLOCK = 2_000, 8_000
#: Words in a leaf of the tree that a task builds inside a cell.
LEAF = 48
#: Distinct words that a task counts before it hands them on.
WORDS_A_TASK = 200_000
_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_TO_LOWER = str.maketrans(UPPER, LOWER)
_RUNS_AT_ONCE = 100_000


def _runs_in(text: str) -> Iterator[list[str]]:
    """The runs of letters of a whole text in lists of bounded size; a run is never cut."""
    found = _RUNS.finditer(text)
    while runs := [m.group() for m in islice(found, _RUNS_AT_ONCE)]:
        yield runs


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable[[object], Callable[[str], str]] | None = None) -> DataFrame:
    """(word, n) over the letter runs of all whole texts, A-Z lower-cased; ``change`` gives for an id what maps its words to what is counted; empty words don't count.

    Tasks add up what they meet and Spark adds up the tasks, so a frequent word moves once for each task, not once for each occurrence. Null texts have no words.
    """

    def run(batches):
        counts: Counter = Counter()

        def flushed():
            words = list(counts)
            for i in range(0, len(words), 50_000):
                part = words[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[w] for w in part], pa.int64())], ["word", "n"])
            counts.clear()

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    changed = change(key) if change else str
                    for runs in _runs_in(text or ""):
                        for run, n in Counter(runs).items():
                            counts[changed(run.lower() if run.isascii() else run.translate(_TO_LOWER))] += n
                        if len(counts) >= WORDS_A_TASK:
                            yield from flushed()
        yield from flushed()

    counted = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, "word string, n bigint")
    return counted.filter("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """The letter-count vector of each row of code points; a byte a count where words are short enough for sums of differences."""
    dims = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % OTHERS).astype(np.int64)
    flat = (dims + DIMENSIONS * np.arange(len(codes))[:, None]).ravel()
    kind = np.int8 if codes.shape[1] < 100 else np.int32
    return np.bincount(flat, minlength=len(codes) * DIMENSIONS).astype(kind).reshape(len(codes), DIMENSIONS)


def _split(vectors: np.ndarray) -> tuple[int, int] | None:
    """(dimension, value) that halves the vectors best, as left is <= value; None if all are equal."""
    best = None
    for d in np.flatnonzero(vectors.min(axis=0) < vectors.max(axis=0)):
        values, counts = np.unique(vectors[:, d], return_counts=True)
        left = np.cumsum(counts)[:-1]
        k = int(np.argmin(np.abs(2 * left - len(vectors))))
        uneven = abs(2 * int(left[k]) - len(vectors))
        if best is None or uneven < best[0]:
            best = uneven, int(d), int(values[k])
    return None if best is None else best[1:]


class UpperTree:
    """The upper splits of one length's k-d tree. Nodes are (dimension, value, left, right) or the number of a cell."""

    def __init__(self, vectors: np.ndarray, share: float, first_cell: int):
        """From a sample of the vectors, each standing for 1 / ``share`` words; cells are numbered from ``first_cell``."""
        self.cells = first_cell
        self.root = self._node(vectors, share)

    def _node(self, vectors, share):
        at = _split(vectors) if len(vectors) > CELL * share and len(vectors) > 8 else None
        if at is None:
            self.cells += 1
            return self.cells - 1
        low = vectors[:, at[0]] <= at[1]
        return at[0], at[1], self._node(vectors[low], share), self._node(vectors[~low], share)

    def visits(self, vectors: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell): the cells whose part of space is no farther than ``within`` from each vector; 0 gives the one that holds it."""
        rows, cells = [], []

        def go(node, at, spent):
            if not len(at):
                return
            if isinstance(node, int):
                rows.append(at)
                cells.append(np.full(len(at), node))
                return
            d, value, left, right = node
            # Splits on one dimension are charged each on its own; the dearest is a lower bound of the distance along it.
            over = vectors[at, d].astype(np.int64) - value
            for child, cost in ((left, np.maximum(over, 0)), (right, np.maximum(1 - over, 0))):
                paid = spent.copy()
                paid[:, d] = np.maximum(paid[:, d], cost)
                near = paid.sum(axis=1) <= within
                go(child, at[near], paid[near])

        go(self.root, np.arange(len(vectors)), np.zeros((len(vectors), DIMENSIONS), dtype=np.int16))
        return (np.concatenate(rows), np.concatenate(cells)) if rows else (np.zeros(0, int), np.zeros(0, int))


class LeafTree:
    """A k-d tree over some words' vectors with the true bounding box of each node, in the dimensions that any of the words has."""

    def __init__(self, vectors: np.ndarray):
        self.used = np.flatnonzero(vectors.any(axis=0))
        self.vectors = np.ascontiguousarray(vectors[:, self.used])
        self.root = self._node(np.arange(len(vectors)))

    def _node(self, at):
        own = self.vectors[at]
        low, high = own.min(axis=0), own.max(axis=0)
        split = _split(own) if len(at) > LEAF else None
        if split is None:
            return low, high, at, None
        left = own[:, split[0]] <= split[1]
        return low, high, None, (self._node(at[left]), self._node(at[~left]))

    def search(self, queries: np.ndarray, within: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) index pairs with an L1 distance of at most ``within``; all queries go down together, those a box rules out are left behind."""
        # Letters that no word here has count in full.
        spent = queries.sum(axis=1, dtype=np.int64)
        queries = np.ascontiguousarray(queries[:, self.used])
        spent -= queries.sum(axis=1, dtype=np.int64)

        def go(node, at):
            low, high, members, children = node
            q = queries[at]
            over = np.maximum(low - q, 0)
            over += np.maximum(q - high, 0)
            at = at[over.sum(axis=1, dtype=np.int32) <= within - spent[at]]
            if not len(at):
                return
            if children:
                for child in children:
                    yield from go(child, at)
                return
            # Queries by members by dimensions: members of a leaf that cannot be split are taken in steps as well.
            for i in range(0, len(at), 256):
                some_q = at[i : i + 256]
                left = (within - spent[some_q])[:, None]
                for j in range(0, len(members), LEAF):
                    some = members[j : j + LEAF]
                    apart = queries[some_q, None, :] - self.vectors[None, some, :]
                    np.abs(apart, out=apart)
                    a, b = np.nonzero(apart.sum(axis=2, dtype=np.int32) <= left)
                    if len(a):
                        yield some_q[a], some[b]

        if len(queries) and len(self.vectors):
            at = np.flatnonzero(spent <= within)
            yield from go(self.root, at)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: do code points ``a`` become ``b`` by one replacement (equal lengths) or one insertion (``b`` longer by one)?"""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.cumprod(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of ``words`` (word, n; distinct) that differ by one inserted, deleted or replaced code point.

    One edit changes the letter counts by an L1 distance of at most two, of one between lengths. Each length has a k-d tree. Its upper splits, learned from a
    bounded sample, cut space into cells; every word is put into its cell, and asks those cells of its own length, from its own on, and of the next length whose part of
    space is near enough, so each pair is met once. Spark deals the cells out; a task builds a tree with true boxes inside each, prunes by box and verifies the order of letters of what is left.
    A cell's words are held by one task in blocks of about BLOCK, its searches stream past them in sorted order, so no cell has to fit a task.
    """
    spark = words.sparkSession
    total = words.count()
    share = min(1.0, SAMPLE / max(total, 1))
    sample = words.filter(F.pmod(F.xxhash64("word"), F.lit(1_000_000)) < int(share * 1_000_000) + (share == 1.0)).select("word").toArrow().column(0).to_pylist()
    by_length: dict[int, list[str]] = {}
    for w in sorted(sample):
        by_length.setdefault(len(w), []).append(w)
    trees, cells = {}, 1
    for length, own in sorted(by_length.items()):
        trees[length] = UpperTree(letter_counts(_codes(own, length)), share, cells)
        cells = trees[length].cells
    # Lengths that the sample has not met are one cell each, numbered from below.
    shared = spark.sparkContext.broadcast(trees)

    def dealt(batches):
        trees = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                texts, ns = part.column(0).to_pylist(), part.column(1).to_numpy(zero_copy_only=False)
                lengths = np.array([len(w) for w in texts])
                out: list[tuple] = []
                for length in np.unique(lengths):
                    at = np.flatnonzero(lengths == length)
                    vectors = letter_counts(_codes([texts[k] for k in at], length))
                    own = np.zeros(len(at), dtype=np.int64)
                    for kind, target, within in ((0, length, 0), (1, length, 2), (1, length + 1, 1)):
                        tree = trees.get(int(target))
                        rows, to = tree.visits(vectors, within) if tree else (np.arange(len(at)), np.full(len(at), -int(target)))
                        if kind == 0:
                            own[rows] = to
                        elif target == length:
                            rows, to = rows[to >= own[rows]], to[to >= own[rows]]
                        # 0: the word is held there, 1: it asks its own cell, 2: it asks another.
                        out.append((to, kind * (2 - (to == own[rows])), at[rows]))
                to, kind, rows = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(kind, pa.int32()), part.column(0).take(pa.array(rows)), pa.array(ns[rows], pa.int64())], ["cell", "kind", "word", "n"])

    placed = written(words.select("word", "n").mapInArrow(dealt, "cell bigint, kind int, word string, n bigint"), "spelling-cells")
    # At most one row a cell, and at most SAMPLE / 4 cells besides those of unseen lengths.
    full = placed.filter("kind = 0").groupBy("cell").count().filter(F.col("count") > BLOCK).select("cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("word"), blocks.cast("bigint")).cast("int"))
    placed = placed.join(F.broadcast(full), "cell", "left").withColumn("block", F.explode(F.when(F.col("kind") == 0, own).otherwise(F.sequence(F.lit(0), blocks - 1))))

    def searched(batches):
        now, members, member_ns, tree, codes = None, [], [], None, None
        asked: list[tuple[str, int, int]] = []

        def answers():
            nonlocal tree, codes
            if not members or not asked:
                asked.clear()
                return
            if tree is None:
                codes = _codes(members, len(members[0]))
                tree = LeafTree(letter_counts(codes))
            for length in {len(q[0]) for q in asked}:
                own = [x for x in asked if len(x[0]) == length]
                mine = _codes([q[0] for q in own], length)
                for a, b in tree.search(letter_counts(mine), 2 if length == codes.shape[1] else 1):
                    good = one_edit(mine[a], codes[b])
                    pairs = [(*own[i], members[j], member_ns[j]) for i, j in zip(a[good], b[good], strict=True)]
                    # Words of this cell ask it as well, and would meet each other twice.
                    pairs = [p[:2] + p[3:] for p in pairs if p[2] == 2 or p[0] < p[3]]
                    pairs += [(w, n, v, m) for v, m, w, n in pairs]
                    if pairs:
                        columns = zip(*pairs, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2, strict=True)], ["word", "n", "near", "near_n"])
            asked.clear()

        for batch in batches:
            for cell, block, kind, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (cell, block) != now:
                    yield from answers()
                    now, members, member_ns, tree = (cell, block), [], [], None
                if kind == 0:
                    members.append(word)
                    member_ns.append(n)
                else:
                    asked.append((word, n, kind))
                    if len(asked) == 4096:
                        yield from answers()
        yield from answers()

    ordered = placed.select("cell", "block", "kind", "word", "n").repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    return ordered.mapInArrow(searched, "word string, n bigint, near string, near_n bigint")


def spelling_groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of ``words`` (word, n).

    ``form`` is the near word of largest n (of equal ones the least in code-point order) if that is at least ``ratio`` times the word's; else null. ``root`` follows
    forms to the last, by pointer doubling: as n at least doubles with each form, a chain has no circle and a few rounds reach its end.

    Repeated words are added up; null and empty words and null counts are left out. Other columns are not read.
    """
    words = written(words.select("word", "n").filter("word <> '' and n is not null").groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    found = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(found, "word", "left")
    taken = -F.col("best.n") >= ratio * F.col("n")
    rows = written(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best.word")).alias("form"), F.when(taken, -F.col("best.n")).alias("form_n")), "spelling-forms")
    links = rows.filter("form is not null").select("word", F.col("form").alias("to"))
    while True:
        step = links.alias("a").join(links.alias("b"), F.col("a.to") == F.col("b.word"), "left")
        links = written(step.select("a.word", F.coalesce("b.to", "a.to").alias("to"), F.col("b.to").isNotNull().alias("moved")), "spelling-roots")
        if not links.filter("moved").limit(1).count():
            break
        links = links.drop("moved")
    roots = links.select("word", F.col("to").alias("root"))
    return rows.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
