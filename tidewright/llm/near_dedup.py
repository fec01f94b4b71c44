"""Near-duplicate detection: MinHash signatures in an LSH forest, links confirmed on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import shuffle_partitions, written
from tidewright.llm.graph import connected_components
from tidewright.llm.words import Sums, blocks, mix

#: Sorted orders, and MinHash values that each sorts by. Two sets of similarity 0.8 share the first SHALLOW values of some order but for one pair in 10**6.
TREES, DEPTH, SHALLOW = 28, 6, 4
#: A region with more rows is dense: it is joined by pivots first, looked at deeper, and compared in cells where rows bring their whole sets.
REGION = 16
#: Rows of a block of a dense region, and shingles in it on average; a cell is two blocks, so its memory has a bound whatever the region's size.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: How far an estimate of similarity (from TREES * DEPTH values; its deviation is 0.03 at 0.8) may fall below the threshold.
SLACK = 0.15
#: Rows of a sorted order in a task.
ROWS_A_TASK = 2_000_000

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_TIMES = _rng.integers(0, 2**31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _shingles(b, k: int):
    """Distinct shingles of each row of a block, sorted: (row, hash). A row of fewer than ``k`` words has one of all its words."""
    n = len(b.starts)
    words = np.diff(b.first)
    sums = Sums(b.hashes())
    begin = np.flatnonzero(b.row[: n - k + 1] == b.row[k - 1 :]) if n >= k else np.zeros(0, dtype=np.int64)
    short = np.flatnonzero((words > 0) & (words < k))
    row = np.concatenate([b.row[begin], short])
    h = np.concatenate([sums.of(begin, begin + k), sums.of(b.first[short], b.first[short] + words[short])])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


SETS = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, sig binary"


def shingle_sets(docs: DataFrame, k: int, digest_bits: int = 64) -> DataFrame:
    """Per document (doc_id, text): size of its shingle set, a digest of the set (twice ``digest_bits``), and its signature (TREES * DEPTH uint16)."""

    cut = np.uint64(64 - digest_bits)

    def run(batches):
        for batch in batches:
            for b in blocks(batch.column("text"), lower=True):
                row, h = _shingles(b, k)
                n = np.bincount(row, minlength=b.n_rows)
                upto = np.concatenate([[0], np.cumsum(n)])
                some = np.flatnonzero(n)
                digest = np.zeros((2, b.n_rows), dtype=np.uint64)
                sig = np.zeros((TREES * DEPTH, b.n_rows), dtype=np.uint16)
                if len(some):
                    at = upto[:-1][some]
                    digest[0, some] = np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at) >> cut
                    digest[1, some] = np.add.reduceat(mix(h * np.uint64(0x9E3779B97F4A7C15)), at) >> cut
                    x = (h >> np.uint64(32)).astype(np.uint32)
                    for j in range(TREES * DEPTH):
                        least = np.minimum.reduceat((x ^ _XOR[j]) * _TIMES[j], at)
                        sig[j, some] = (least ^ (least >> np.uint32(16))).astype(np.uint16)
                raw = pa.array([r.tobytes() for r in np.ascontiguousarray(sig.T).astype(">u2")], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(b.first_row, b.n_rows), pa.array(n), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)), raw], ["doc_id", "n_shingles", "d1", "d2", "sig"])

    return docs.select("doc_id", "text").mapInArrow(run, SETS)


PAIRS = "a bigint, b bigint"


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Distinct pairs, the smaller id first."""
    x = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])


def _neighbours(stands: DataFrame, threshold: int) -> DataFrame:
    """Rows next to each other in some order that share SHALLOW values, as pairs (smaller id, larger id), and each row that has such a
    neighbour as a pair with itself, so too the first and last row of a task, whose neighbours may be in the next. Pairs whose sizes rule
    out the threshold are none. A task reads its part of an order batch by batch and remembers one row.
    """
    spark = stands.sparkSession
    keys = [F.struct(F.lit(t).cast("tinyint").alias("tree"), F.expr(f"substring(sig, {2 * DEPTH * t + 1}, {2 * DEPTH})").alias("key")) for t in range(TREES)]
    forest = stands.select("doc_id", "n", F.explode(F.array(*keys)).alias("t")).select("t.tree", "t.key", "n", "doc_id")

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if last is None else pa.concat_tables([last, pa.Table.from_batches([batch])])
            tree, n, ids = (rows.column(c).to_numpy() for c in ("tree", "n", "doc_id"))
            key = np.frombuffer(b"".join(rows.column("key").to_pylist()), dtype=">u2").reshape(len(ids), DEPTH)[:, :SHALLOW]
            i = np.flatnonzero((key[1:] == key[:-1]).all(axis=1) & (tree[1:] == tree[:-1]))
            ok = (100 * np.minimum(n[i], n[i + 1]) >= threshold * np.maximum(n[i], n[i + 1])) & (ids[i] != ids[i + 1])
            marked = np.concatenate([ids[i], ids[i + 1], ids[:1] if last is None else ids[:0]])
            yield _pairs(np.concatenate([ids[i][ok], marked]), np.concatenate([ids[i + 1][ok], marked]))
            last = rows.slice(len(ids) - 1)
        if last is not None:
            end = last.column("doc_id").to_numpy()
            yield _pairs(end, end)

    order = ["tree", "key", "n", "doc_id"]
    tasks = max(shuffle_partitions(spark), stands.count() * TREES // ROWS_A_TASK + 1)
    return forest.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(run, PAIRS).distinct()


def _places(near: DataFrame, depth: int) -> DataFrame:
    """(region, tree, doc_id, n, part): the rows in each order; a region has one tree and one prefix of ``depth`` values (two that share a hash only meet more)."""
    keys = [F.struct(F.lit(t).cast("tinyint").alias("tree"), F.xxhash64(F.lit(t), F.expr(f"substring(sig, {2 * DEPTH * t + 1}, {2 * depth})")).alias("region")) for t in range(TREES)]
    return near.select("doc_id", "n", "part", F.explode(F.array(*keys)).alias("t")).select("t.region", "t.tree", "doc_id", "n", "part")


def _pivots(near: DataFrame, depth: int, smallest: bool, threshold: int) -> DataFrame:
    """Pairs of a row and its region's pivot, for regions of more than REGION rows of different parts: linear in the rows.

    The pivot is the row of the smallest set, or any other: then each order has its own. What a pivot doesn't join is for ``_apart``.
    """
    rows = _places(near, depth)
    by = F.shiftleft(F.col("n").cast("bigint"), 32) + F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) if smallest else F.xxhash64("doc_id", "tree")
    found = rows.withColumn("_by", by).groupBy("region").agg(
        F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high"), *[F.min_by(c, "_by").alias(f"_{c}") for c in ("doc_id", "n", "part")]
    )
    pivots = found.filter(f"size > {REGION} and low < high").select("region", F.col("_doc_id").alias("pivot"), F.col("_n").alias("m"), F.col("_part").alias("other"))
    fits = (F.col("part") != F.col("other")) & (100 * F.least("n", "m") >= threshold * F.greatest("n", "m"))
    return rows.join(pivots, "region").filter(fits).select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")).distinct()


def _promising(pairs: DataFrame, near: DataFrame, threshold: int) -> DataFrame:
    """The pairs that estimates don't rule out."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= threshold / 100 - SLACK))

    side = lambda x: near.select(F.col("doc_id").alias(x), F.col("sig").alias(f"sig_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, PAIRS)


CELL = ["region", "row_block", "column_block"]


def _apart(near: DataFrame, texts: DataFrame, k: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """What is left after neighbours and pivots: all pairs of rows of different parts that share SHALLOW values of some order.

    Returns candidates (of regions up to REGION rows) and links that are exact already (of denser ones). In a region, rows outside its largest part are compared with all rows. In a dense one, the
    former are dealt into row blocks and all into column blocks by hash, and each row block meets each column block in a cell of its
    own: no task holds a region, and no pair is left out. There rows bring their whole sets, pairs are decided at once, and
    a cell reports one link for each two parts it joins, so what it reports is linear in its rows. A pair is looked at in the first
    order that it shares a region in.
    """
    spark = near.sparkSession
    rows = _places(near, SHALLOW)
    parts = rows.groupBy("region", "part").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    regions = parts.groupBy("region").agg(F.count("*").alias("_parts"), F.max_by("part", "size").alias("main"), F.sum("size").alias("size"), F.max("size").alias("_main"), F.sum("n").alias("_n"))
    blocks_of = lambda size, n: F.greatest(F.ceil(size / BLOCK), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    size, rest = F.col("size"), F.col("size") - F.col("_main")
    regions = regions.filter("_parts > 1").select("region", "main", "size", blocks_of(rest, F.col("_n") * rest / size).alias("row_blocks"), blocks_of(size, F.col("_n")).alias("column_blocks"))
    placed = written(rows.join(regions, "region").withColumn("row", F.col("part") != F.col("main")).drop("main"), "regions")
    block = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def cells(some: DataFrame) -> DataFrame:
        as_row = some.filter("row").select("region", block("row_blocks").alias("row_block"), upto("column_blocks").alias("column_block"), "tree", "doc_id", "n", "part", "row", F.lit(True).alias("left"))
        as_column = some.select("region", upto("row_blocks").alias("row_block"), block("column_blocks").alias("column_block"), "tree", "doc_id", "n", "part", "row", F.lit(False).alias("left"))
        return as_row.unionByName(as_column)

    def decided(cells: DataFrame) -> DataFrame:
        return cells.repartition(shuffle_partitions(spark), *CELL).sortWithinPartitions(*CELL).mapInArrow(lambda batches: _cell_links(batches, threshold), PAIRS).distinct()

    small = cells(placed.filter(f"size <= {REGION}").withColumn("row_blocks", F.lit(1)).withColumn("column_blocks", F.lit(1)))
    candidates = decided(small.join(near.select("doc_id", "sig"), "doc_id"))
    dense = placed.filter(f"size > {REGION}")
    sets = whole_sets(texts.join(dense.select("doc_id").distinct(), "doc_id", "left_semi"), k).distinct()
    links = decided(cells(dense).join(near.select("doc_id", "sig").join(sets, "doc_id"), "doc_id"))
    return candidates, links


def whole_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles): the sorted 64-bit hashes of each row's distinct shingles, as bytes."""

    def run(batches):
        for batch in batches:
            for b in blocks(batch.column("text"), lower=True):
                row, h = _shingles(b, k)
                upto = np.searchsorted(row, np.arange(b.n_rows + 1)).tolist()
                raw = pa.array([h[x:y].tobytes() for x, y in zip(upto, upto[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(b.first_row, b.n_rows), raw], ["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, shingles binary")


def _cell_links(batches, threshold: int):
    """Pairs found in each cell of sorted batches: with ``shingles`` links, one for each two parts that they join; else those that estimates don't rule out."""
    for rows in _cells_of(batches):
        rows = rows.combine_chunks()
        ids, n, part, left, other = (rows.column(c).to_numpy() for c in ("doc_id", "n", "part", "left", "row"))
        tree = rows.column("tree")[0].as_py()
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), dtype=np.uint16).reshape(len(ids), -1)
        prefix = np.ascontiguousarray(sig.reshape(-1, TREES, DEPTH)[:, :, :SHALLOW]).view(np.uint64)[:, :, 0]
        raw = rows.column("shingles") if "shingles" in rows.column_names else None
        _, label = np.unique(part, return_inverse=True)
        columns = np.flatnonzero(~left)
        a, b = [], []
        for i in np.flatnonzero(left).tolist():
            # Of two rows outside the largest part, each meets the other: the larger id looks.
            j = columns[(label[columns] != label[i]) & (~other[columns] | (ids[columns] < ids[i]))]
            j = j[100 * np.minimum(n[j], n[i]) >= threshold * np.maximum(n[j], n[i])]
            if tree:
                j = j[~(prefix[j, :tree] == prefix[i, :tree]).any(axis=1)]
            j = j[(sig[j] == sig[i]).mean(axis=1) >= threshold / 100 - SLACK]
            if raw is None:
                a.append(np.full(len(j), ids[i]))
                b.append(ids[j])
                continue
            mine = np.frombuffer(raw[i].as_buffer(), dtype=np.uint64)
            for x in j.tolist():
                if label[x] == label[i]:
                    continue
                theirs = np.frombuffer(raw[x].as_buffer(), dtype=np.uint64)
                at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                both = int((mine[at] == theirs).sum())
                if 100 * both >= threshold * (len(mine) + len(theirs) - both):
                    a.append(ids[i : i + 1])
                    b.append(ids[x : x + 1])
                    label[label == label[x]] = label[i]
        if a and sum(map(len, a)):
            yield _pairs(np.concatenate(a), np.concatenate(b))


def _cells_of(batches):
    """The rows of each cell, from batches sorted by cell."""
    kept = None
    for batch in batches:
        if batch.num_rows:
            kept = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            new = np.zeros(kept.num_rows - 1, dtype=bool)
            for c in CELL:
                values = kept.column(c).to_numpy()
                new |= values[1:] != values[:-1]
            edges = [0, *(np.flatnonzero(new) + 1).tolist()]
            for b, e in zip(edges, edges[1:], strict=False):
                yield kept.slice(b, e - b)
            kept = kept.slice(edges[-1])
    if kept is not None:
        yield kept


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= threshold * union."""

    def sets(texts: pa.Array):
        rows, hashes = [], []
        for b in blocks(texts, lower=True):
            row, h = _shingles(b, k)
            rows.append(row + b.first_row)
            hashes.append(h)
        return np.concatenate(rows), np.concatenate(hashes)

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                (ra, ha), (rb, hb) = sets(part.column("text_a")), sets(part.column("text_b"))
                row, h = np.concatenate([ra, rb]), np.concatenate([ha, hb])
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                both = np.bincount(row[1:][(row[1:] == row[:-1]) & (h[1:] == h[:-1])], minlength=part.num_rows)
                total = np.bincount(row, minlength=part.num_rows) - both
                yield part.select(["a", "b"]).filter(pa.array((100 * both >= threshold * total) & (total > 0)))

    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(run, PAIRS)


def _with_parts(rows: DataFrame, *links: DataFrame) -> DataFrame:
    """``rows`` with ``part``, the component of their links."""
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    parts = connected_components(edges, "a", "b").withColumnRenamed("node", "doc_id")
    return written(rows.join(parts, "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id")).drop("component"), "parts")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: int = 80, digest_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Words are lower-cased in A-Z only; a row's set holds its distinct shingles of ``shingle`` words. Rows are linked where
    100 * intersection >= threshold * union; component_id is the smallest id reachable by links, and that row is kept.

    Rows with one set are found by its digest (twice ``digest_bits``) and confirmed; one of them stands for all. These enter a forest of TREES orders sorted by
    MinHash values; neighbours with a common prefix are candidates. Then the rows of dense regions meet their region's pivots, first at
    full depth, then at SHALLOW values. At last all pairs of still different components that share SHALLOW values of some order are compared, whatever the
    size of the region. All links are confirmed on the whole sets. A link between components is missed only if its two sets share SHALLOW
    values of no order, or if the estimate of its similarity is SLACK too low.

    Null, empty and blank texts have empty sets and are linked with nothing, nor are rows with a null id, whose component_id is null and
    which are kept. Rows that repeat an id are one node. Other columns are not read. Ids are whole numbers.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sets = written(shingle_sets(rows, shingle, digest_bits), "shingle-sets")
    texts = rows.filter("doc_id is not null")
    nodes = sets.filter("doc_id is not null and n_shingles > 0")
    first = nodes.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"))
    same = nodes.select("doc_id", "d1", "d2").join(first, ["d1", "d2"]).filter("doc_id <> first")
    same = written(same.select(F.col("first").alias("a"), F.col("doc_id").alias("b"), "d1", "d2").distinct(), "same")
    equal = written(_confirmed(same.select("a", "b").distinct(), texts, shingle, 100), "same")
    # A row of one digest with another, but not of one set, would stand for itself.
    covered = same.join(equal, ["a", "b"]).select(F.col("b").alias("doc_id"), "d1", "d2")
    stands = nodes.join(covered, ["doc_id", "d1", "d2"], "left_anti").dropDuplicates(["doc_id", "d1", "d2"])
    near = written(stands.select("doc_id", F.col("n_shingles").cast("int").alias("n"), "sig"), "forest")
    found = written(_neighbours(near, threshold), "candidates")
    links = [written(_confirmed(found.filter("a < b"), texts, shingle, threshold), "links")]
    near = written(near.join(found.filter("a = b").select(F.col("a").alias("doc_id")), "doc_id"), "near")
    tested = found.filter("a < b")
    for depth, smallest in ((SHALLOW, True), (DEPTH, False)):
        now = _with_parts(near, *links)
        pairs = written(_pivots(now, depth, smallest, threshold).join(tested, ["a", "b"], "left_anti"), "candidates")
        links.append(written(_confirmed(_promising(pairs, now, threshold), texts, shingle, threshold), "links"))
        tested = tested.unionByName(pairs)
    candidates, exact = _apart(_with_parts(near, *links), texts, shingle, threshold)
    links += [written(_confirmed(candidates.join(tested, ["a", "b"], "left_anti"), texts, shingle, threshold), "links"), written(exact, "links"), equal]
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    final = connected_components(every, "a", "b").select(F.col("node").alias("doc_id"), "component")
    out = sets.select("doc_id", "n_shingles").join(final, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
