"""Best-fit packing of tokenised documents into sequences of a fixed length, in bulk-synchronous rounds."""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import remembered, written

CAPACITY = 2048
END_OF_DOCUMENT = 0
#: Words, and their letters, that a Python worker remembers with their ids, in each of two generations; about 0.2 KB a word.
WORD_MEMORY = 300_000
#: Words of so many bytes of text are looked up at once, each different one once; whole texts always.
BLOCK = 1 << 22
#: Pieces of one length are ranked in parts of about so many rows of all lengths.
RANK_PART = 50_000
#: Up to so many placement runs (five whole numbers each) are broadcast; more are joined by shuffle.
BROADCAST_RUNS = 200_000


def _only_letters(word: str) -> bool:
    """Whether a word is letters alone, also in the form that the tokenizer reads: some letters become a letter and a combining mark there."""
    return word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()


class _WordIds:
    """Ids of words (bytes without white space) as little-endian uint32 bytes, remembered until the Python worker turns to another operator.

    A word is taken apart into letters and the marks behind them, which the tokenizer splits anyway and to which case makes no difference; the letters of
    many new words are encoded as one text, whose ids are told apart by the tokens that end a word. Other words are encoded one by one.
    """

    MARKS = b".,;:!?%&*$#|()\""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.words = _Memory()

    def encode(self, words: list[bytes]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]

    def encode_letters(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Each of ``words`` is letters only, so it is one unit of the tokenizer and has one token that ends it, its last."""
        out = {}
        parts = [words[i : i + 64] for i in range(0, len(words), 64)]
        for part, e in zip(parts, self.tokenizer.encode_batch_fast([b" ".join(p).decode() for p in parts], add_special_tokens=False), strict=True):
            ids = np.asarray(e.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw, at = ids.tobytes(), 0
                for word, end in zip(part, (4 * ends).tolist(), strict=True):
                    out[word], at = raw[at:end], end
            else:  # a letter that becomes more than letters in lower case
                out.update(zip(part, self.encode(part), strict=True))
        return out

    def of(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of each of ``words``."""
        out, new = self.words.get(words)
        split, alone = [], []
        for w in new:
            letters = w.rstrip(self.MARKS)
            if letters.isalpha() or _only_letters(letters.decode()):
                low = letters.lower()
                split.append((w, w if low == w else low, w[len(letters) :]))
            else:
                alone.append(w)
        # Letters alone are a word, too: one memory holds both.
        parts, unseen = self.words.get({x for _, x, _ in split})
        marks = list({m for _, _, m in split if m})
        self.words.put(parts, self.encode_letters(unseen))
        of_marks = dict(zip(marks, self.encode(marks), strict=True))
        found = {w: parts[x] + of_marks[m] if m else parts[x] for w, x, m in split}
        found.update(zip(alone, self.encode(alone), strict=True))
        self.words.put(out, found)
        return out


class _Memory:
    """A bounded memory in two generations: what is asked for again moves to the young one, and when that is full the old one is forgotten."""

    def __init__(self):
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def get(self, keys) -> tuple[dict[bytes, bytes], list[bytes]]:
        """What is known, and the keys that aren't."""
        young, old, known, unknown = self.young, self.old, {}, []
        for k in keys:
            v = young.get(k)
            if v is None:
                v = old.get(k)
                if v is None:
                    unknown.append(k)
                    continue
                young[k] = v
            known[k] = v
        return known, unknown

    def put(self, known: dict[bytes, bytes], found: dict[bytes, bytes]) -> None:
        known.update(found)
        self.young.update(found)
        if len(self.young) > WORD_MEMORY:
            self.old, self.young = self.young, {}


def _word_ids(path: str) -> _WordIds:
    known = remembered("packing")
    if path not in known:
        known[path] = _WordIds(path)
    return known[path]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of each document (doc_id, text): its ids, then END_OF_DOCUMENT, cut only where longer than ``capacity``.

    The tokenizer drops white space and lets no token span it, so words are encoded one by one and looked up again.
    """

    def run(batches):
        end = np.asarray([END_OF_DOCUMENT], dtype="<u4").tobytes()
        for batch in batches:
            ids = _word_ids(tokenizer_path)
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            rows, size, begun = [], 0, 0
            for i in range(batch.num_rows + 1):
                if i == batch.num_rows or size > BLOCK:
                    known = ids.of(set().union(*rows))
                    yield _pieces(doc_ids.slice(begun, len(rows)), [b"".join(map(known.__getitem__, words)) + end for words in rows], capacity, with_ids)
                    begun, rows, size = begun + len(rows), [], 0
                if i < batch.num_rows:
                    text = (texts[i].as_py() or "").encode()
                    size += len(text)
                    rows.append(text.split())

    return docs.select("doc_id", "text").mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def _pieces(doc_ids: pa.Array, docs: list[bytes], capacity: int, with_ids: bool) -> pa.RecordBatch:
    step, of, piece, length, crc, ids = capacity * 4, [], [], [], [], []
    for k, raw in enumerate(docs):
        for p, at in enumerate(range(0, len(raw), step)):
            part = raw[at : at + step]
            of.append(k)
            piece.append(p)
            length.append(len(part) // 4)
            crc.append(zlib.crc32(part))
            if with_ids:
                ids.append(part)
    columns = [doc_ids.take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), pa.array([p * capacity for p in piece], pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids)


def best_fit_rounds(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Place ``counts[length]`` documents of each length: runs (length, first rank, last rank + 1, first sequence, offset).

    Documents in order of length, and gaps in order of size, are runs of equal values, at most ``capacity`` of each whatever the
    number of documents; within a run, rank tells rows apart. In a round each sequence takes one document at most. A sweep
    from the longest documents on sends each to its successor, the smallest free gap that holds it; of documents that want
    the same gaps the lower ranks win and the others go on to the next larger. Then gaps are updated, and the next
    round begins. When no document fits any gap, sequences are opened for the longest that are left, as many as the tokens left need.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    rank: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = {}
    runs, next_sequence = [], 0
    while left:
        after: dict[int, list[tuple[int, int]]] = defaultdict(list)
        free, placed = sorted(gaps), False
        for n in sorted(left, reverse=True):
            while left[n] and (i := bisect_left(free, n)) < len(free):
                gap = free[i]
                first, count = gaps[gap].pop()
                take = min(count, left[n])
                if take < count:
                    gaps[gap].append((first + take, count - take))
                if not gaps[gap]:
                    del gaps[gap], free[i]
                runs.append((n, rank[n], rank[n] + take, first, capacity - gap))
                after[gap - n].append((first, take))
                rank[n] += take
                left[n] -= take
                placed = True
        if not placed:
            need = -(-sum(n * c for n, c in left.items()) // capacity)
            for n in sorted(left, reverse=True):
                take = min(need, left[n])
                if not take:
                    break
                runs.append((n, rank[n], rank[n] + take, next_sequence, 0))
                after[capacity - n].append((next_sequence, take))
                next_sequence += take
                rank[n] += take
                left[n] -= take
                need -= take
        left = {n: c for n, c in left.items() if c}
        for gap, found in after.items():
            gaps.setdefault(gap, []).extend(found)
        gaps.pop(0, None)
        for gap in gaps:
            gaps[gap] = _joined(gaps[gap])
    return runs


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring runs of sequences as one."""
    out: list[tuple[int, int]] = []
    for first, count in sorted(runs):
        if out and out[-1][0] + out[-1][1] == first:
            out[-1] = (out[-1][0], out[-1][1] + count)
        else:
            out.append((first, count))
    return out


def ranked(pieces: DataFrame, order: list[str]) -> DataFrame:
    """``pieces`` with ``rank``, from 0 among those of one length. Parts by hash are ranked apart, then moved on by the
    sizes of the parts before, so a length that very many pieces share is not sorted in one task."""
    parts = pieces.count() // RANK_PART + 1
    split = pieces.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = split.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order)) - 1
    return split.withColumn("_within", within).join(sizes, ["length", "_part"]).withColumn("rank", F.col("_within") + F.col("_before")).drop("_part", "_within", "_before")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids, as little-endian uint32, if asked for).

    Only a histogram of piece lengths (``capacity`` rows at most) comes to the driver, which matches it in ``best_fit_rounds``;
    a piece then finds its sequence by its length and its rank among pieces of that length.

    A null or empty text is END_OF_DOCUMENT alone. Repeated rows and null ids are packed like any other; equal pieces of
    one id may change places. An empty table gives an empty result. Other columns are not read. Ids are whole numbers.
    """
    spark = docs.sparkSession
    pieces = written(tokenized_pieces(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), tokenizer_path, capacity, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = best_fit_rounds(counts, capacity)
    runs_df = spark.createDataFrame(pa.table(list(map(pa.array, zip(*runs, strict=True))), names=["length", "_from", "_to", "_seq", "offset"]) if runs else [], "length bigint, _from bigint, _to bigint, _seq bigint, offset bigint")
    slim = ranked(pieces.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids), ["doc_id", "piece", "ids_crc32"])
    placed = slim.join(F.broadcast(runs_df) if len(runs) <= BROADCAST_RUNS else runs_df, "length").filter("rank >= _from and rank < _to")
    return placed.select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", (F.col("_seq") + F.col("rank") - F.col("_from")).alias("sequence_id"), "offset", *["ids"] * with_ids)
