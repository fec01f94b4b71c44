"""Substring deduplication over a log-structured index of window fingerprints."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm.common import shared_dir, shuffle_partitions, written
from tidewright.llm.words import Sums, blocks

WINDOW = 50
#: The words whose hash can stand for a window. The least hash among a window's 43 places is its anchor, so equal windows have equal anchors.
GRAM = 8
#: Windows of a segment; more are several segments.
LONGEST = 255
_POSITION = np.uint64((1 << 28) - 1)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys."""
    out, have = keys, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _segments(block, window: int, gram: int):
    """Runs of windows with one anchor, LONGEST windows at most: (row, first window, anchor hash, body, check).

    Body and check are hashes, independent of each other and of the anchor's, of all words that the run covers; the body's low byte is the number of windows.
    """
    n = len(block.starts)
    if n < window:
        return None
    hashes = block.hashes()
    sums, other = Sums(hashes), Sums(hashes, "b")
    grams = sums.of(np.arange(n - gram + 1), np.arange(gram, n + 1))
    keys = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least(keys, window - gram + 1) & _POSITION).astype(np.int64)
    whole = block.row[: n - window + 1] == block.row[window - 1 :]
    begins = whole.copy()
    begins[1:] &= (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    first = np.flatnonzero(begins)
    if not len(first):
        return None
    ends = whole.copy()
    ends[:-1] &= (anchor[1:] != anchor[:-1]) | ~whole[1:]
    last = np.flatnonzero(ends)
    pieces = -(-(last - first + 1) // LONGEST)
    if pieces.max() > 1:
        of = np.repeat(np.arange(len(first)), pieces)
        first = first[of] + LONGEST * (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        last = np.minimum(last[of], first + LONGEST - 1)
    check = sums.of(first, last + window)
    body = (other.of(first, last + window) & np.uint64(0xFFFFFF00)) | (last - first + 1).astype(np.uint64)
    return block.row[first], first - block.first[block.row[first]], grams[anchor[first]], body.astype(np.uint32), check


SEGMENTS = "doc_id bigint, at bigint, anchor bigint, body int, check bigint"


def segments(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, body_bits: int = 24) -> DataFrame:
    """Per document (doc_id, part, text) its segments (see ``_segments``); of the body's hash ``body_bits`` bits are used.

    ``at`` is the place of the first window, with the row's part in its upper half.
    """
    mask = np.uint32(((1 << body_bits) - 1) << 8 | 0xFF)

    def run(batches):
        for batch in batches:
            ids, part = batch.column("doc_id"), batch.column("part").to_numpy().astype(np.int64) << 32
            for b in blocks(batch.column("text")):
                if found := _segments(b, window, gram):
                    row, at, anchor, body, check = found
                    of = row + b.first_row
                    columns = [ids.take(pa.array(of)), pa.array(at + part[of]), pa.array(anchor.view(np.int64)), pa.array((body & mask).view(np.int32)), pa.array(check.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "at", "anchor", "body", "check"])

    return docs.select("doc_id", "part", "text").mapInArrow(run, SEGMENTS)


def _count() -> Column:
    """Number of a segment's windows."""
    return F.col("body").bitwiseAND(F.lit(0xFF)).alias("n")


RUN = "anchor bigint, body int, doc_id bigint, at bigint, own boolean, many boolean, again boolean"
WINDOWS = "doc_id bigint, at bigint, w1 bigint, w2 int"


def _windows(docs_with_spans: DataFrame, window: int) -> DataFrame:
    """96-bit digests of the single windows in ``spans`` (array of struct at, n) of each document."""

    def run(batches):
        for batch in batches:
            ids, spans, part = batch.column("doc_id"), batch.column("spans"), batch.column("part").to_numpy().astype(np.int64) << 32
            flat, lengths = spans.flatten(), spans.value_lengths().to_numpy()
            at, n = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            upto = np.concatenate([[0], np.cumsum(lengths)])
            for b in blocks(batch.column("text")):
                lo, hi = upto[b.first_row], upto[b.first_row + b.n_rows]
                row = np.repeat(np.arange(b.n_rows), lengths[b.first_row : b.first_row + b.n_rows])
                begin, count = b.first[row] + (at[lo:hi] & 0xFFFFFFFF), n[lo:hi]
                total = int(count.sum())
                s = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(total)
                row = np.repeat(row, count)
                h = b.hashes()
                w1, w2 = (Sums(h, k).of(s, s + window) for k in "ab")
                of = row + b.first_row
                columns = [ids.take(pa.array(of)), pa.array(s - b.first[row] + part[of]), pa.array(w1.view(np.int64)), pa.array((w2 >> np.uint64(32)).astype(np.uint32).view(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "at", "w1", "w2"])

    return docs_with_spans.select("doc_id", "part", "text", "spans").mapInArrow(run, WINDOWS)


CLEANED = "doc_id bigint, n_words bigint, n_removed bigint, text string, removed array<struct<at:int,n:int>>"


def _cleaned(docs_with_spans: DataFrame) -> DataFrame:
    """Remove the words of ``spans``; what stays is joined by single spaces. ``removed`` are the merged spans, in words."""

    def run(batches):
        for batch in batches:
            spans = batch.column("spans")
            lengths = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = spans.flatten()
            at, n = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            upto = np.concatenate([[0], np.cumsum(lengths)])
            for b in blocks(batch.column("text")):
                lo, hi = upto[b.first_row], upto[b.first_row + b.n_rows]
                begin = b.first[np.repeat(np.arange(b.n_rows), lengths[b.first_row : b.first_row + b.n_rows])] + (at[lo:hi] & 0xFFFFFFFF)
                cover = np.zeros(len(b.starts) + 1, dtype=np.int32)
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + n[lo:hi], -1)
                gone = np.cumsum(cover[:-1]) > 0
                keep = ~gone
                # Each kept word and the byte after it, which becomes a space; a row's last word has none.
                starts, ends, row = b.starts[keep], b.ends[keep], b.row[keep]
                size = ends - starts + 1
                upto_b = np.concatenate([[0], np.cumsum(size)])
                out = np.full(upto_b[-1], 0x20, dtype=np.uint8)
                inside = np.ones(upto_b[-1], dtype=bool)
                inside[upto_b[1:] - 1] = False
                cut = np.zeros(len(b.data) + 1, dtype=np.int32)
                cut[starts] += 1
                cut[ends] -= 1
                out[inside] = b.data[np.cumsum(cut[:-1]) > 0]
                firsts = np.searchsorted(row, np.arange(b.n_rows + 1))
                offs = upto_b[firsts]
                raw = out.tobytes()
                texts = [raw[x : max(x, y - 1)].decode("utf-8", "replace") for x, y in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
                words = np.diff(b.first)
                n_gone = np.add.reduceat(np.append(gone, False).astype(np.int64), b.first[:-1]) * (words > 0) if len(b.starts) else np.zeros(b.n_rows, dtype=np.int64)
                edge = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1] | (b.row[1:] != b.row[:-1])])) if gone.any() else np.zeros(0, dtype=np.int64)
                stop = np.flatnonzero(gone & np.concatenate([~gone[1:] | (b.row[1:] != b.row[:-1]), [True]])) if gone.any() else edge
                of = b.row[edge]
                span_offsets = pa.array(np.searchsorted(of, np.arange(b.n_rows + 1)).astype(np.int32))
                merged = pa.ListArray.from_arrays(span_offsets, pa.StructArray.from_arrays([pa.array((edge - b.first[of]).astype(np.int32)), pa.array((stop - edge + 1).astype(np.int32))], ["at", "n"]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(b.first_row, b.n_rows), pa.array(words), pa.array(n_gone), pa.array(texts, pa.string()), merged], ["doc_id", "n_words", "n_removed", "text", "removed"])

    return docs_with_spans.select("doc_id", "text", "spans").mapInArrow(run, CLEANED)


@dataclass
class FingerprintIndex:
    """Immutable runs of segment fingerprints: Parquet tables, bucketed and sorted by fingerprint, newest last.

    A run's row is a segment that its batch holds: (anchor, body, doc_id, at, own, many, again): a place in the first document, whether it is
    of this run's documents (else only known from an older run), whether other documents of the run hold the segment too, and whether
    the run's batch holds it at more places than one, in whatever documents.
    ``append`` merge-joins a batch's fingerprints with each run, without moving the runs, and writes the outcome as a new run; runs whose
    sizes are within a factor ``fanout`` are then compacted into one by another merge. ``covered`` finds the repeated windows of
    documents that were appended, and verifies them. Batches are to be appended in ascending order of ids.
    """

    spark: SparkSession
    window: int = WINDOW
    gram: int = GRAM
    fanout: float = 2.0
    body_bits: int = 24
    runs: list[tuple[str, str, int]] = field(default_factory=list)

    def _write(self, rows: DataFrame) -> tuple[str, str, int]:
        name = f"fp_run_{uuid.uuid4().hex}"
        path = f"{shared_dir(self.spark)}/{name}"
        rows.select("anchor", "body", "doc_id", "at", "own", "many", "again").write.bucketBy(shuffle_partitions(self.spark), "anchor", "body").sortBy("anchor", "body").option("path", path).saveAsTable(name)
        return name, path, self.spark.read.schema(RUN).parquet(path).count()

    def _drop(self, run: tuple[str, str, int]) -> None:
        self.spark.sql(f"DROP TABLE {run[0]}")
        _delete(self.spark, run[1])

    def append(self, docs: DataFrame) -> None:
        """Fingerprints are combined per task before they are shuffled: a hash aggregate over numbers."""
        found = segments(docs, self.window, self.gram, self.body_bits).groupBy("anchor", "body")
        new = found.agg(F.min("doc_id").alias("doc_id"), F.min_by("at", "doc_id").alias("at"), (F.max("doc_id") > F.min("doc_id")).alias("many"), (F.count("*") > 1).alias("again")).withColumn("own", F.lit(True))
        for name, _, _ in self.runs:
            known = self.spark.table(name).filter("own").select("anchor", "body", F.col("doc_id").alias("_known"))
            new = new.join(known.hint("merge"), ["anchor", "body"], "left").withColumn("own", F.col("own") & F.col("_known").isNull()).withColumn("doc_id", F.coalesce("_known", "doc_id")).drop("_known")
        self.runs.append(self._write(new))
        while len(self.runs) > 1 and self.runs[-1][2] * self.fanout > self.runs[-2][2]:
            a, b = self.runs[-2:]
            older, newer = (self.spark.table(t).select("anchor", "body", F.struct("doc_id", "at", "own", "many", "again").alias(x)) for t, x in ((a[0], "x"), (b[0], "y")))
            merged = older.join(newer.hint("merge"), ["anchor", "body"], "full").withColumn("p", F.coalesce("x", "y"))
            whole = self._write(merged.select("anchor", "body", "p.doc_id", "p.at", "p.own", (F.col("p.many") | (F.col("x").isNotNull() & F.col("y").isNotNull())).alias("many"), "p.again"))
            self._drop(a)
            self._drop(b)
            self.runs[-2:] = [whole]

    def covered(self, docs: DataFrame) -> DataFrame:
        """(doc_id, part, spans): stretches of words covered by windows that also start in a smaller doc_id.

        A segment known from a smaller doc_id is verified: its check must be that of a place in the first document. Then it is covered whole.
        Other equal windows lie in segments of one anchor that differ: of those, all places in a segment's first document are opened, and those that failed, and
        their windows' digests compared one by one. Other places need no look: they are covered whole.
        Joins and aggregates only, so hot segments, anchors and windows are combined or split by Spark.
        """
        index = self.spark.read.schema(RUN).parquet(*[path for _, path, _ in self.runs])
        own = index.filter("own")
        twice = index.filter("many or again or not own").select("anchor", "body", F.col("doc_id").alias("_first"))
        hits = segments(docs, self.window, self.gram, self.body_bits).join(twice, ["anchor", "body"]).filter("doc_id >= _first")
        hits = written(hits.select("anchor", "body", "check", "doc_id", "at", (F.col("doc_id") > F.col("_first")).alias("later")), "hits")
        first = hits.filter("not later").select("anchor", "body", "check").distinct().withColumn("_same", F.lit(True))
        later = written(hits.filter("later").join(first, ["anchor", "body", "check"], "left").select("anchor", "doc_id", "at", _count(), F.coalesce("_same", F.lit(False)).alias("sure")), "verified")
        whole = later.filter("sure").select("doc_id", "at", (F.col("n") + self.window - 1).alias("n"))
        unsure = later.filter("not sure").select("anchor", "doc_id", "at", "n")
        several = own.groupBy("anchor").agg(F.count("*").alias("_bodies")).filter("_bodies > 1").select("anchor")
        mixed = written(several.unionByName(unsure.select("anchor")).distinct(), "mixed")
        places = own.filter("not again").select("anchor", "doc_id", "at", _count()).unionByName(hits.filter("not later").select("anchor", "doc_id", "at", _count())).unionByName(unsure)
        part = F.shiftright("at", 32).cast("int").alias("part")
        opened = places.join(mixed, "anchor").groupBy("doc_id", part).agg(F.collect_set(F.struct("at", "n")).alias("spans"))
        windows = _windows(docs.join(opened, ["doc_id", "part"]), self.window)
        least = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("_first"))
        single = windows.join(least, ["w1", "w2"]).filter("doc_id > _first").select("doc_id", "at", F.lit(self.window).alias("n"))
        return whole.unionByName(single).groupBy("doc_id", part).agg(F.collect_set(F.struct("at", "n")).alias("spans"))


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, batches: int = 3, body_bits: int = 24) -> DataFrame:
    """One row per input row: id, n_words, n_removed, text (what stays, words joined by one space), removed (spans of words).

    A word goes if a window of ``window`` consecutive words over it also starts in a row with a smaller id. The table is
    appended to a FingerprintIndex in ``batches`` ranges of ids, and then looked up whole: every window of every text counts.

    A null text has no words. Rows with a null id keep their words and take none from others. Rows with one id don't take
    words from each other. A text of fewer than ``window`` words stays. Other columns are not read. Ids are whole numbers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = rows.filter("doc_id is not null")
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = rows.withColumn("part", F.lit(0))
    else:  # only then are texts sorted, to tell the rows of one id apart
        rows = written(rows.withColumn("part", F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))), "parts")
    known = rows.filter("doc_id is not null")
    index = FingerprintIndex(spark, window=window, gram=min(GRAM, window), body_bits=body_bits)
    edges = known.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    for low, high in zip([None, *edges], [*edges, None], strict=True):
        part = known if low is None else known.filter(F.col("doc_id") > low)
        index.append(part if high is None else part.filter(F.col("doc_id") <= high))
    spans = index.covered(known)
    none = F.array().cast("array<struct<at:bigint,n:int>>")
    # From ``known``, as in ``covered``: there and here Spark then moves the texts by one and the same exchange.
    texts = known.join(spans, ["doc_id", "part"], "left").withColumn("spans", F.coalesce("spans", none))
    others = rows.filter("doc_id is null").withColumn("spans", none)
    return _cleaned(texts.unionByName(others)).withColumnRenamed("doc_id", id_col)
