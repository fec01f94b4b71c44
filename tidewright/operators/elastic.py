"""Series compared by shape: banded dynamic time warping in array functions, an envelope that rules pairs out, and medoids."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.sources.sinks import staged

#: Series that one side of a comparison holds, about; tasks over which comparisons are dealt.
BLOCK, TASKS = 4000, 256


def series_of(curves: DataFrame, key: str = "entity_key", at: str = "time_bucket", value: str = "value", scaled: bool = False) -> DataFrame:
    """(id, x): the values of each series in order of time; ``scaled`` to mean 0 and population deviation 1 (a constant series to 0)."""
    listed = curves.groupBy(F.col(key).cast("string").alias("id")).agg(F.array_sort(F.collect_list(F.struct(F.col(at).alias("t"), F.col(value).cast("double").alias("v")))).alias("p"), F.avg(value).alias("m"), F.stddev_pop(value).alias("d"))
    values = F.transform("p", lambda p: p["v"])
    return listed.select("id", (F.transform(values, lambda v: F.coalesce(F.try_divide(v - F.col("m"), F.col("d")), F.lit(0.0))) if scaled else values).alias("x"))


def warping_distance(a: Column, b: Column, band: int) -> Column:
    """Root of the least sum of squared differences along a warping path between two arrays whose steps stay within ``band`` places of each other.

    Null if their lengths differ by more than the band, or one is empty. A row of the table holds the 2 * band + 1 cells around the diagonal.
    """
    far = F.lit(float("inf"))
    width = 2 * band + 1

    def row(before: Column, i: Column) -> Column:
        def cell(state: Column, c: Column) -> Column:
            j = i + c - band
            # In these coordinates the cell above is one place to the right, the one above to the left in the same place.
            over = F.when(c + 1 < width, F.get(before, c + 1)).otherwise(far)
            least = F.least(F.get(before, c), over, state["left"])
            gap = F.get(a, i) - F.get(b, j)
            value = F.when((j >= 0) & (j < F.size(b)), gap * gap + least).otherwise(far)
            return F.struct(F.concat(state["cells"], F.array(value)).alias("cells"), value.alias("left"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(width - 1)), F.struct(F.array().cast("array<double>").alias("cells"), far.alias("left")), cell, lambda s: s["cells"])

    first = F.array(*[F.lit(0.0 if c == band else float("inf")) for c in range(width)])
    last = F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), first, row)
    end = F.size(b) - F.size(a) + band
    return F.when((F.size(a) > 0) & (F.size(b) > 0) & end.between(0, width - 1), F.sqrt(F.get(last, end)))


def envelope(x: Column, band: int) -> Column:
    """Array of (low, high): the least and the largest value within ``band`` places, for each place and ``band`` places beyond the end."""
    around = lambda i: F.slice(x, F.greatest(i - band, F.lit(0)) + 1, i + band + 1 - F.greatest(i - band, F.lit(0)))
    return F.transform(F.sequence(F.lit(0), F.size(x) - 1 + band), lambda i: F.struct(F.array_min(around(i)).alias("low"), F.array_max(around(i)).alias("high")))


def envelope_bound(a: Column, envelope_of_b: Column) -> Column:
    """What no warping within the envelope's band can be below: how far each value of ``a`` lies outside of the envelope."""
    outside = F.transform(a, lambda v, i: F.greatest(v - F.get(envelope_of_b, i)["high"], F.get(envelope_of_b, i)["low"] - v, F.lit(0.0)))
    return F.sqrt(F.aggregate(outside, F.lit(0.0), lambda s, d: s + d * d))


def shape_candidates(series: DataFrame, radius: float, band: int) -> DataFrame:
    """(a, b, xa, xb, bound): pairs of ``series`` (id, x), a < b, that may lie within ``radius``: ``bound`` is what the envelopes say, from both sides.

    A warping path joins first to first and last to last value, so a pair within the radius lies in the same or a neighbouring cell of a grid over these two: an equi-join.
    """
    rows = series.filter("id is not null and size(x) > 0").select("id", "x", envelope(F.col("x"), band).alias("e"), F.floor(F.get("x", F.lit(0)) / radius).alias("c0"), F.floor(F.element_at("x", -1) / radius).alias("c1"))
    rows = staged(rows, "shape-series")
    around = rows
    for c in ("c0", "c1"):
        around = around.withColumn(c, F.explode(F.array(*[F.col(c) + k for k in (-1, 0, 1)])))
    left = rows.select(F.col("id").alias("a"), F.col("x").alias("xa"), F.col("e").alias("ea"), "c0", "c1")
    right = around.select(F.col("id").alias("b"), F.col("x").alias("xb"), F.col("e").alias("eb"), "c0", "c1")
    met = left.join(right, ["c0", "c1"]).filter((F.col("a") < F.col("b")) & (F.abs(F.size("xa") - F.size("xb")) <= band))
    return met.withColumn("bound", F.greatest(envelope_bound(F.col("xa"), F.col("eb")), envelope_bound(F.col("xb"), F.col("ea")))).select("a", "b", "xa", "xb", "bound")


def _table(a, b, band: int, shape: tuple[int, ...]) -> np.ndarray:
    """Warping distances between series given as lists of their values, place by place: arrays that broadcast to ``shape``. Infinite where a missing value bars every path."""
    before: list = [None] * (len(b) + 1)
    free, least = [], np.empty(shape)
    with np.errstate(invalid="ignore", over="ignore"):
        for i in range(len(a)):
            row: list = [None] * (len(b) + 1)
            for j in range(max(0, i - band), min(len(b), i + band + 1)):
                cell = free.pop() if free else np.empty(shape)
                np.subtract(a[i], b[j], out=cell)
                np.multiply(cell, cell, out=cell)
                came = [c for c in (before[j], before[j + 1], row[j]) if c is not None]
                for c in came[1:]:
                    np.minimum(came[0] if c is came[1] else least, c, out=least)
                if came:
                    np.add(cell, least if len(came) > 1 else came[0], out=cell)
                row[j + 1] = cell
                # No cell to the right asks for the one above to the left.
                if before[j] is not None:
                    free.append(before[j])
                    before[j] = None
            free.extend(c for c in before if c is not None)
            before = row
        # What is missing in a series makes each path through it NaN.
        return np.nan_to_num(np.sqrt(before[-1]), copy=False, nan=np.inf, posinf=np.inf)


def warped(a: np.ndarray, b: np.ndarray, band: int, some: int = 8192) -> np.ndarray:
    """``warping_distance`` of each row of ``a`` to the same row of ``b`` (infinite where a missing value bars every path), a cell of ``some`` tables at once."""
    parts = [(np.ascontiguousarray(x[k : k + some].T), np.ascontiguousarray(y[k : k + some].T)) for x, y in [(a, b)] for k in range(0, len(a), some)]
    return np.concatenate([_table(x, y, band, x.shape[1:]) for x, y in parts] or [np.zeros(0)])


def _by_length(column: pa.ChunkedArray | pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and values of series of each length; a missing value is NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    return {int(n): (at, flat[starts[at][:, None] + np.arange(n)].astype(float)) for n in np.unique(lengths) if n for at in [np.nonzero(lengths == n)[0]]}


def _may_be_near(a: np.ndarray, b: np.ndarray, radius: float, band: int):
    """Places (in ``a``, in ``b``) of pairs that the envelope of ``b`` doesn't rule out, some rows of ``a`` at a time. First meets first and last meets last, so these count by their own differences.

    Single precision: envelopes are wider by what rounding may take, so it costs a distance, never a pair.
    """
    n, m = a.shape[1], b.shape[1]
    largest = max(np.abs(a).max(), np.abs(b).max())
    if largest > 1e30 or radius > 1e15:
        yield from ((np.full(len(b), k), np.arange(len(b))) for k in range(len(a)))
        return
    slack = 2.0**-21 * largest
    around = lambda i: slice(0, 1) if i == 0 else slice(m - 1, m) if i == n - 1 else slice(max(0, i - band), i + band + 1)
    low, high = (np.array([f(b[:, around(i)], axis=1) for i in range(n)]) for f in (np.min, np.max))
    # A series of one value meets first and last of the other.
    if n == 1:
        low, high = (f(b, axis=1)[None] for f in (np.max, np.min))
    low, high, rows = (low - slack).astype(np.float32), (high + slack).astype(np.float32), a.astype(np.float32)
    most = np.float32(radius * radius * (1 + (n + 8) * 2.0**-22))
    t, u, total = (np.empty((16, len(b)), np.float32) for _ in range(3))
    with np.errstate(over="ignore"):
        for k in range(0, len(a), 16):
            x = rows[k : k + 16]
            v, w, s = t[: len(x)], u[: len(x)], total[: len(x)]
            s.fill(0)
            for i in range(n):
                np.subtract(x[:, i, None], high[i], out=v)
                np.subtract(low[i], x[:, i, None], out=w)
                np.maximum(v, w, out=v)
                np.maximum(v, np.float32(0), out=v)
                np.multiply(v, v, out=v)
                np.add(s, v, out=s)
            i, j = np.nonzero(s <= most)
            yield i + k, j


def _compared(radius: float, band: int):
    """Pairs within the radius of one block's series with another's, or with each other."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        parts = [table.filter(pa.array(side == s)).combine_chunks() for s in (0, 1)]
        alone = parts[1].num_rows == 0
        if alone:
            parts[1] = parts[0]
        ids = pa.concat_arrays([p.column("id").combine_chunks() for p in parts])
        # Ids as numbers in their order.
        rank = np.unique(np.array(ids.to_pylist(), dtype=object), return_inverse=True)[1].reshape(-1)
        left, right = (_by_length(p.column("x")) for p in parts)
        found: list[tuple] = []
        for m, (at, a) in left.items():
            for n, (to, b) in right.items():
                if abs(m - n) > band:
                    continue
                wait: list[tuple] = []
                for i, j in itertools.chain(_may_be_near(a, b, radius, band), [(None, None)]):
                    if i is not None:
                        p, q = rank[at[i]], rank[to[j] + parts[0].num_rows]
                        keep = (p < q) if alone else (p != q)
                        wait.append((i[keep], j[keep]))
                        if sum(len(w[0]) for w in wait) < 100_000:
                            continue
                    i, j = (np.concatenate(w) for w in zip(*wait, strict=True)) if wait else (np.zeros(0, int),) * 2
                    wait = []
                    d = warped(a[i], b[j], band)
                    near = d <= radius
                    found.append((at[i[near]], to[j[near]] + parts[0].num_rows, d[near]))
        p, q, d = (np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        low = rank[p] < rank[q]
        return pa.table([ids.take(pa.array(np.where(low, p, q))), ids.take(pa.array(np.where(low, q, p))), pa.array(d)], ["a", "b", "distance"])

    return run


def _equals(rows: DataFrame) -> DataFrame:
    """(x, id, n): each different series of ``rows`` (id, x) once, under the least id of those that are equal, and how many there are."""
    return staged(rows.groupBy("x").agg(F.min("id").alias("id"), F.count("*").alias("n")), "shape-classes")


def _dealt(placed: DataFrame, met: DataFrame, cell: list[str]) -> DataFrame:
    """``placed`` (cell, block and others) for each pair of blocks in ``met`` (cell, block, and both with _2), with the columns pair and side (0, 1); a block that meets itself comes once."""
    one, two = [*cell, "block"], [f"{c}_2" for c in (*cell, "block")]
    met = met.withColumn("pair", F.struct(*one, *two))
    apart = met.filter(F.struct(*one) < F.struct(*[F.col(c).alias(n) for c, n in zip(two, one, strict=True)])).select("pair", *[F.col(c).alias(n) for c, n in zip(two, one, strict=True)])
    sides = [placed.join(at.select("pair", *one), one).withColumn("side", F.lit(s)) for s, at in enumerate((met, apart))]
    return sides[0].unionByName(sides[1]).repartition(TASKS, "pair")


def similar_shapes(series: DataFrame, radius: float, band: int) -> DataFrame:
    """(a, b, distance): all pairs of ``series`` (id, x), a < b, within ``radius`` of each other. Only pairs that the envelopes let through are warped.

    Equal series are compared once, and pairs of their ids are made of that. A warping path joins first to first and last to last value, so a pair within the radius lies in
    the same or a neighbouring cell of a grid over these two. A cell is dealt into blocks of about BLOCK series, so no task holds a crowded cell, and each pair of blocks
    is compared once, by whole arrays. Where most series differ and lie in a few cells the pairs of blocks still grow with the square of the series; they are spread over all tasks.
    """
    # A value that is missing or infinite bars every path.
    whole = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    series = staged(series.filter("id is not null and size(x) > 0").filter(whole).select("id", "x"), "shape-series")
    classes = _equals(series)
    rows = staged(classes.select("id", "x", F.floor(F.get("x", F.lit(0)) / radius).alias("c0"), F.floor(F.element_at("x", -1) / radius).alias("c1")), "shape-cells")
    cells = rows.groupBy("c0", "c1").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = staged(rows.join(cells, ["c0", "c1"]).select("id", "x", "c0", "c1", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")), "shape-blocks")
    blocks = cells.select("c0", "c1", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    around = blocks.select(*[F.col(c).alias(f"{c}_2") for c in ("c0", "c1", "block")], "c0", "c1")
    for c in ("c0", "c1"):
        around = around.withColumn(c, F.explode(F.array(*[F.col(c) + k for k in (-1, 0, 1)])))
    met = staged(blocks.join(around, ["c0", "c1"]).filter(F.struct("c0", "c1", "block") <= F.struct("c0_2", "c1_2", "block_2")), "shape-pairs")
    pairs = _dealt(placed, met, ["c0", "c1"]).groupBy("pair").applyInArrow(_compared(radius, band), "a string, b string, distance double")
    many = classes.filter("n > 1")
    return pairs if many.isEmpty() else _for_all(pairs, series, classes)


def _for_all(pairs: DataFrame, series: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` of different series (a, b, distance; a < b) for all ids that stand for them, and the pairs of equal series. Ids travel in lists of about BLOCK, so no row and no task holds those of a large class."""
    pieces = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    lists = series.join(classes.select("x", F.col("id").alias("same"), pieces.alias("k")), "x").groupBy("same", F.pmod(F.xxhash64("id"), F.col("k")).alias("piece")).agg(F.collect_list("id").alias("ids"))
    lists = staged(lists, "shape-ids")
    equal = classes.filter("n > 1").select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("distance"))
    both = pairs.unionByName(equal)
    for s in "ab":
        both = both.join(lists.select(F.col("same").alias(s), F.col("piece").alias(f"{s}_piece"), F.col("ids").alias(f"{s}_ids")), s)
    both = both.repartition(TASKS, "a", "a_piece", "b", "b_piece").select("a", "b", "distance", F.explode("a_ids").alias("p"), "b_ids").select("a", "b", "distance", "p", F.explode("b_ids").alias("q"))
    return both.filter(F.when(F.col("a") == F.col("b"), F.col("p") < F.col("q")).otherwise(F.col("p") != F.col("q"))).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "distance")


def _warp(rows: DataFrame, names: str, band: int) -> DataFrame:
    """``rows`` (x, y and the columns of the schema ``names``) with the warping distance of x to y instead of these; null if there is none."""
    kept = [n.split()[0] for n in names.split(", ")]

    def run(batches):
        for batch in batches:
            xs, ys = (_by_length(batch.column(c)) for c in ("x", "y"))
            out = np.full(batch.num_rows, np.inf)
            for m, (at, a) in xs.items():
                for n, (to, b) in ys.items():
                    both, i, j = np.intersect1d(at, to, return_indices=True)
                    if abs(m - n) <= band and len(both):
                        out[both] = warped(a[i], b[j], band)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, mask=np.isinf(out))], [*kept, "distance"])

    return rows.select(*kept, "x", "y").mapInArrow(run, f"{names}, distance double")


def _to(series: DataFrame, some: DataFrame, band: int) -> DataFrame:
    """(id, medoid, distance) of each series to each of a few ``some`` (medoid, y), which are broadcast: at most k."""
    return _warp(series.crossJoin(F.broadcast(some)), "id string, medoid string", band)


def _summed(band: int):
    """What each series of one block adds to the cost of each of another, and these to its own; or of a block's series among each other. Infinite where there is no distance."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("id", "ascending")])
        side = table.column("side").to_numpy()
        parts = [table.filter(pa.array(side == s)).combine_chunks() for s in (0, 1)]
        alone = parts[1].num_rows == 0
        if alone:
            parts[1] = parts[0]
        weights = [p.column("n").to_numpy().astype(float) for p in parts]
        costs = [np.zeros(len(w)) for w in weights]
        if alone:
            costs[1] = costs[0]
        left, right = (_by_length(p.column("x")) for p in parts)
        for m, (at, a) in left.items():
            for n, (to, b) in right.items():
                if alone and m > n:
                    continue
                if abs(m - n) > band:
                    costs[0][at], costs[1][to] = np.inf, np.inf
                    continue
                same, columns = alone and m == n, np.ascontiguousarray(b.T)
                # About 4096 tables at once.
                wide = 1024
                for k in range(0, len(a), 4):
                    x = [v[:, None] for v in a[k : k + 4].T]
                    for c in range(k // wide * wide if same else 0, len(b), wide):
                        d = _table(x, columns[:, c : c + wide], band, (len(x[0]), min(wide, len(b) - c)))
                        if same:
                            # Each pair once, from the row that stands first.
                            d[np.arange(c, c + d.shape[1])[None, :] <= np.arange(k, k + len(d))[:, None]] = 0
                        costs[0][at[k : k + 4]] += d @ weights[1][to[c : c + wide]]
                        costs[1][to[c : c + wide]] += weights[0][at[k : k + 4]] @ d
        out = [pa.table([p.column("cluster"), p.column("id"), pa.array(c)], ["cluster", "candidate", "cost"]) for p, c in zip(parts, costs, strict=True)]
        return out[0] if alone else pa.concat_tables(out)

    return run


def _costs(members: DataFrame, band: int) -> DataFrame:
    """(cluster, candidate, cost): the sum of distances of each of ``members`` (cluster, id, x, n) to all of its cluster, each n times. All pairs, by blocks, each once."""
    cells = members.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = staged(members.join(cells, "cluster").select("cluster", "id", "x", "n", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")), "shape-blocks")
    # A block may have got no series; those it meets add nothing to it.
    blocks = placed.select("cluster", "block").distinct()
    met = blocks.join(blocks.select("cluster", F.col("block").alias("block_2")), "cluster").filter("block <= block_2").withColumn("cluster_2", F.col("cluster"))
    dealt = _dealt(placed, staged(met, "shape-pairs"), ["cluster"])
    parts = dealt.groupBy("pair").applyInArrow(_summed(band), "cluster string, candidate string, cost double")
    return parts.groupBy("cluster", "candidate").agg(F.sum("cost").alias("cost"))


def shape_medoids(series: DataFrame, k: int, band: int) -> DataFrame:
    """(id, medoid, distance): ``series`` (id, x; lengths within ``band`` of each other) in ``k`` clusters around one of their own, by warping distance.

    Medoids start far from each other: the least id, then each time the series farthest from those chosen. A round assigns each series to its nearest medoid and moves a medoid to
    that member whose distances to all members sum to least, until nothing moves. Every member is tried: of each cluster that has changed a round takes all pairs of different series, which
    are spread over all tasks by blocks; equal series count as one with a weight. Of equal distances the smaller name wins. Series whose distance is null to all medoids are left out.
    """
    members = staged(series.filter("id is not null and size(x) > 0").select("id", "x"), "shape-series")
    rows = _equals(members)
    pick = rows.orderBy("id").limit(1).select(F.col("id").alias("medoid"), F.col("x").alias("y"))
    found = staged(_to(rows, pick, band), "shape-distances")
    for _ in range(k - 1):
        nearest = found.groupBy("id").agg(F.min("distance").alias("distance"))
        far = nearest.filter("distance > 0").orderBy(F.desc("distance"), "id").limit(1)
        pick = far.join(rows, "id").select(F.col("id").alias("medoid"), F.col("x").alias("y"))
        found = staged(found.unionByName(_to(rows, staged(pick, "shape-medoid"), band)), "shape-distances")
    choose = lambda df: df.filter("distance is not null").groupBy("id").agg(F.min(F.struct("distance", "medoid")).alias("m")).select("id", "m.medoid", "m.distance")
    assigned = staged(choose(found), "shape-clusters")
    changed = names = {r["medoid"] for r in assigned.select("medoid").distinct().collect()}
    seen = {frozenset(names)}
    while changed:
        touched = assigned.filter(F.col("medoid").isin(list(changed))).select("id", F.col("medoid").alias("cluster")).join(rows, "id")
        best = _costs(touched, band).groupBy("cluster").agg(F.min(F.struct(F.round("cost", 9).alias("cost"), (F.col("candidate") != F.col("cluster")).alias("moves"), "candidate")).alias("b")).select("b.candidate")
        # A cluster without a change keeps its medoid.
        names = (names - changed) | {r["candidate"] for r in best.collect()}
        # What has been seen before would only come again: costs fall, but for rounding.
        if frozenset(names) in seen:
            break
        seen.add(frozenset(names))
        medoids = rows.filter(F.col("id").isin(list(names))).select(F.col("id").alias("medoid"), F.col("x").alias("y"))
        before, assigned = assigned, staged(choose(_to(rows, medoids, band)), "shape-clusters")
        moved = before.select("id", F.col("medoid").alias("old")).join(assigned.select("id", F.col("medoid").alias("new")), "id", "full").filter(~F.col("old").eqNullSafe(F.col("new")))
        changed = {r["m"] for r in moved.select(F.explode(F.array("old", "new")).alias("m")).distinct().collect()}
        names = {r["medoid"] for r in assigned.select("medoid").distinct().collect()}
        changed &= names
    same = members.join(rows.select("x", F.col("id").alias("same")), "x").select("id", "same")
    return same.join(assigned.withColumnRenamed("id", "same"), "same").select("id", "medoid", "distance")
