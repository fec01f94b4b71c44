"""Exact nearest neighbours of vectors: pivots deal them into cells, and cells that are provably too far are never visited."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.sources.sinks import staged

#: At most so many pivots (they are on the driver and in every task); members of a cell that a task holds at once; queries compared at once.
PIVOTS, BLOCK, QUERIES = 1024, 2000, 256
#: Cells are dealt to tasks of about so many points; to as many as there are cores at least.
ROWS_A_TASK = 4000
_FOUND = "id string, label string, other string, other_label string, distance double"
_DEALT = "cell int, block int, kind int, id string, label string, weight double, x array<double>"


def distances(measure: str, a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> np.ndarray:
    """All distances of rows of ``a`` to rows of ``b``.

    plain: Euclidean. ward: what the sum of squares inside clusters of sizes wa, wb with centres a, b grows by when they merge, as a distance.
    reach: mutual reachability, for core distances wa, wb.
    """
    squares = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        squares += np.subtract.outer(a[:, i], b[:, i]) ** 2
    plain = np.sqrt(squares)
    if measure == "ward":
        return plain * np.sqrt(2 * wa[:, None] * wb[None, :] / (wa[:, None] + wb[None, :]))
    return np.maximum(plain, np.maximum(wa[:, None], wb[None, :])) if measure == "reach" else plain


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(x), -1)


class Pivots:
    """Cells of a table of points (id, label, weight, x), each around one of its points; what is known of each cell is small and on the driver."""

    def __init__(self, points: DataFrame, n: int | None = None):
        """Reads ``points`` (``n`` rows) three times: have them stored. Pivots are taken by hash of the id, some root of the number of points, at most PIVOTS."""
        n = points.count() if n is None else n
        wanted = int(min(PIVOTS, max(8, n**0.5)))
        rows = points.select("id", "x").orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
        self.x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(rows[0]["x"]) if rows else 0)
        self.ids = [r["id"] for r in rows]
        kept = points.select("id", *[c for c in ("label", "weight") if c in points.columns], "x")
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
        self.placed = staged(kept.mapInArrow(self._places(), f"{types}, cell int, far double"), "nearest-cells")

    def _places(self):
        pivots = self.x

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    x, zero = _matrix(batch.column("x")), np.zeros(1)
                    cell, near = [], []
                    for i in range(0, len(x), QUERIES):
                        far = distances("plain", x[i : i + QUERIES], zero, pivots, zero)
                        cell.append(far.argmin(axis=1))
                        near.append(far.min(axis=1))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(cell), pa.int32()), pa.array(np.concatenate(near))], [*batch.schema.names, "cell", "far"])

        return run

    def search(self, points: DataFrame | None, measure: str, k: int = 1) -> DataFrame:
        """(id, label, other, other_label, distance): the ``k`` nearest points of another label of each point that may matter to its label.

        Every label's nearest is among them, and with labels of one point each every point's ``k``. Of equal distances the smaller id is nearer.
        ``points`` (id, label, weight) may be fewer than the pivots were made of; None stands for those. First each point looks into its own cell; a label's bound is its best find.
        Then it visits the cells that may hold something as near: by the triangle inequality, by the plane midway between the pivots, and by the cell's least weight. Cells of the point's own label alone are left out.
        """
        if points is None:
            rows = self.placed
        else:
            rows = staged(self.placed.select("id", "x", "cell", "far").join(points.select("id", "label", "weight"), "id").select("id", "label", "weight", "x", "cell", "far"), "nearest-points")
        stats = rows.groupBy("cell").agg(F.max("far").alias("radius"), F.min("weight").alias("least"), F.count("*").alias("n"), F.min("label").alias("a"), F.max("label").alias("b")).collect()
        cells = {r["cell"]: (r["radius"], r["least"], -(-r["n"] // BLOCK), r["a"] if r["a"] == r["b"] else None, r["n"]) for r in stats}
        own = staged(self._visit(rows.withColumn("bound", F.lit(float("inf"))), cells, measure, k, own=True), "nearest-own")
        # The k-th find bounds what a point still needs; with fewer finds nothing does.
        if k == 1:
            bounds = own.groupBy("label").agg(F.min("distance").alias("bound"))
        else:
            ranked = F.slice(F.array_sort(F.collect_list("distance")), 1, k)
            bounds = own.groupBy("label").agg(ranked.alias("_d")).filter(F.size("_d") >= k).select("label", F.element_at("_d", k).alias("bound"))
        asked = rows.join(bounds, "label", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        return own.unionByName(self._visit(asked, cells, measure, k, own=False))

    def _visit(self, rows: DataFrame, cells: dict, measure: str, k: int, own: bool) -> DataFrame:
        numbers = np.array(sorted(cells), dtype=int)
        size = sum(v[4] for v in cells.values())
        pivots = self.x[numbers]
        radius, least = (np.array([cells[c][i] for c in numbers], dtype=float) for i in range(2))
        blocks = np.array([cells[c][2] for c in numbers], dtype=int)
        labels = {o: i for i, o in enumerate(sorted({v[3] for v in cells.values() if v[3] is not None}))}
        only = np.array([labels.get(cells[c][3], -2) for c in numbers], dtype=int)

        def visits(x, weight, label, at, bound):
            zero = np.zeros(1)
            far = distances("plain", x, zero, pivots, zero)
            mine = far[np.arange(len(x)), at]
            low = np.maximum(far - radius[None, :], 0)
            # A point of another cell lies beyond the plane midway between both pivots; a little less for rounding.
            between = distances("plain", pivots[at], zero, pivots, zero)
            beyond = (far**2 - mine[:, None] ** 2) - 1e-12 * (far**2 + mine[:, None] ** 2)
            low = np.maximum(low, np.divide(beyond, 2 * between, out=np.zeros_like(low), where=between > 0))
            if measure == "ward":
                low = low * np.sqrt(2 * weight[:, None] * least[None, :] / (weight[:, None] + least[None, :]))
            elif measure == "reach":
                low = np.maximum(low, np.maximum(weight[:, None], least[None, :]))
            # A little slack for rounding: it costs visits, never a neighbour.
            go = low <= bound[:, None] * (1 + 1e-9)
            go[np.arange(len(x)), at] = False
            go[np.array([labels.get(v, -1) for v in label])[:, None] == only[None, :]] = False
            return np.nonzero(go)

        def deal(batches):
            for batch in batches:
                for i in range(0, batch.num_rows, QUERIES):
                    part = batch.slice(i, QUERIES)
                    weight, cell, bound = (part.column(c).to_numpy(zero_copy_only=False) for c in ("weight", "cell", "bound"))
                    at, every = np.searchsorted(numbers, cell), np.arange(len(cell))
                    row, to = (every, at) if own else visits(_matrix(part.column("x")), weight, part.column("label").to_pylist(), at, bound)
                    # A query goes to every block of a cell, a member to the one of its id.
                    times = blocks[to]
                    block = np.arange(times.sum()) - np.repeat(times.cumsum() - times, times)
                    home = np.array([crc32(v.encode()) for v in part.column("id").to_pylist()], dtype=int) % blocks[at]
                    take = pa.array(np.concatenate([every, np.repeat(row, times)]))
                    kind = np.repeat([0, 1], [len(every), len(block)])
                    dealt = [np.concatenate([numbers[at], np.repeat(numbers[to], times)]), np.concatenate([home, block]), kind]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in dealt), *(part.column(c).take(take) for c in ("id", "label", "weight", "x"))], ["cell", "block", "kind", "id", "label", "weight", "x"])

        def answers(asked, members):
            names = members.column("label").unique()
            code = pc.index_in(members.column("label"), value_set=names).to_numpy(zero_copy_only=False)
            b, wb = _matrix(members.column("x")), members.column("weight").to_numpy(zero_copy_only=False)
            for i in range(0, asked.num_rows, QUERIES):
                some = asked.slice(i, QUERIES)
                found = distances(measure, _matrix(some.column("x")), some.column("weight").to_numpy(zero_copy_only=False), b, wb)
                found[pc.fill_null(pc.index_in(some.column("label"), value_set=names), -1).to_numpy(zero_copy_only=False)[:, None] == code[None, :]] = np.inf
                every = np.arange(len(found))
                for _ in range(min(k, len(b))):
                    j = found.argmin(axis=1)
                    d = found[every, j]
                    found[every, j] = np.inf
                    r = np.flatnonzero(d < np.inf)
                    if len(r):
                        q, m = pa.array(r), pa.array(j[r])
                        yield pa.RecordBatch.from_arrays([some.column("id").take(q), some.column("label").take(q), members.column("id").take(m), members.column("label").take(m), pa.array(d[r])], ["id", "label", "other", "other_label", "distance"])

        def find(batches):
            now, parts, members = None, [], None
            for batch in batches:
                if not batch.num_rows:
                    continue
                key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block", "kind")])
                cuts = [0, *(np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
                for begin, end in zip(cuts, cuts[1:], strict=False):
                    part = batch.slice(begin, end - begin)
                    if (key[0, begin], key[1, begin]) != now:
                        now, parts, members = (key[0, begin], key[1, begin]), [], None
                    if key[2, begin] == 0:
                        parts.append(part)
                    elif parts:
                        if members is None:
                            # Smaller ids first, so that of equal distances theirs is found.
                            members = pa.Table.from_batches(parts).sort_by("id").combine_chunks().to_batches()[0]
                        yield from answers(part, members)

        dealt = rows.select("id", "label", "weight", "x", "cell", "bound").mapInArrow(deal, _DEALT)
        spark = rows.sparkSession
        tasks = max(1, min(int(blocks.sum()), int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, size // ROWS_A_TASK)))
        return dealt.repartition(tasks, "cell", "block").sortWithinPartitions("cell", "block", "kind").mapInArrow(find, _FOUND)


def nearest(points: DataFrame, k: int) -> DataFrame:
    """(id, other, distance, rank): the ``k`` nearest other points of each of ``points`` (id, x), fewer if there are no more."""
    rows = staged(points.select("id", F.col("id").alias("label"), F.lit(1.0).alias("weight"), "x"), "points")
    found = Pivots(rows).search(None, "plain", k)
    listed = found.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "other"))), 1, k).alias("near"))
    return listed.select("id", F.posexplode("near").alias("rank", "n")).select("id", F.col("n.other").alias("other"), F.col("n.distance").alias("distance"), (F.col("rank") + 1).alias("rank"))
