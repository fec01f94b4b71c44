"""Density clustering over all radii at once: core distances, a spanning tree of mutual reachability, and the clusters that last longest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.models import FEATURES, vectors
from tidewright.operators.nearest import Pivots, distances, nearest
from tidewright.sources.sinks import staged

#: Edges of the tree that one task takes at a time, in order of weight.
EDGES_A_BLOCK = 50_000
#: Up to so many points one task makes the tree: rounds over so few are all overhead.
FEW = 256
#: Distances below count as this one, so that the density of repeated points stays finite.
LEAST_DISTANCE = 1e-12


def core_distances(points: DataFrame, k: int) -> DataFrame:
    """(id, core): the distance of each of ``points`` (id, x) to its ``k``-th nearest other point, or to the farthest if there are fewer."""
    found = nearest(points, k).groupBy("id").agg(F.max("distance").alias("core"))
    return points.select("id").join(found, "id", "left").select("id", F.coalesce("core", F.lit(0.0)).alias("core"))


def _tree_of_few(k: int):
    """The tree of a few points (id, x), grown from the first by the lightest edge each time."""

    def run(batches):
        rows = sorted(r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        if len(rows) < 2:
            return
        ids, x, zero = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=float), np.zeros(1)
        plain = distances("plain", x, zero, x, zero)
        core = np.sort(plain + np.diag(np.full(len(ids), np.inf)), axis=1)[:, min(k, len(ids) - 1) - 1]
        reach = np.maximum(plain, np.maximum(core[:, None], core[None, :]))
        inside, best, out = {0}, {j: (reach[0, j], ids[0], ids[j]) for j in range(1, len(ids))}, []
        while best:
            j = min(best, key=best.get)
            w, a, b = best.pop(j)
            out.append((a, b, float(w)))
            inside.add(j)
            for i in best:
                best[i] = min(best[i], (reach[j, i], min(ids[i], ids[j]), max(ids[i], ids[j])))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["a", "b", "weight"])

    return run


def reachability_tree(points: DataFrame, k: int, few: int = FEW) -> DataFrame:
    """(a, b, weight): a minimum spanning tree of ``points`` (id, x), a < b; a weight is the largest of the distance and both core distances.

    Boruvka's rounds: every part takes its lightest edge to another part, so at least half of the parts go. Edges are ordered by weight, then by both names, so
    no circle arises. The lightest edge of a part is searched through pivots under the bound of its best find; pairs are never listed.
    """
    points = staged(points.select("id", F.col("x").cast("array<double>").alias("x")).filter("id is not null and x is not null").dropDuplicates(["id"]), "density-points")
    if points.limit(few + 1).count() <= few:
        return staged(points.coalesce(1).mapInArrow(_tree_of_few(k), "a string, b string, weight double"), "density-tree")
    pivots = Pivots(points)
    labelled = staged(core_distances(points, k).select("id", F.col("id").alias("label"), F.col("core").alias("weight")), "density-labels")
    parts = []
    while labelled.select("label").distinct().limit(2).count() > 1:
        edge = F.struct("distance", F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "other_label")
        best = staged(pivots.search(labelled, "reach").groupBy("label").agg(F.min(edge).alias("e")).select("label", "e.*"), "density-lightest")
        parts.append(best.select("a", "b", F.col("distance").alias("weight")).distinct())
        # Each part points to the one behind its edge; of two that point to each other the lesser is a root.
        to = best.select("label", F.col("other_label").alias("up"))
        back = to.select(F.col("label").alias("up"), F.col("up").alias("_back"))
        up = staged(to.join(back, "up", "left").select("label", F.when((F.col("_back") == F.col("label")) & (F.col("label") < F.col("up")), F.col("label")).otherwise(F.col("up")).alias("up")), "density-up")
        while True:
            step = up.alias("p").join(up.alias("q"), F.col("p.up") == F.col("q.label")).select("p.label", F.col("q.up").alias("up"), (F.col("q.up") != F.col("p.up")).alias("_moved"))
            step = staged(step, "density-up")
            up = step.drop("_moved")
            if step.filter("_moved").isEmpty():
                break
        labelled = staged(labelled.join(up, "label").select("id", F.col("up").alias("label"), "weight"), "density-labels")
    out = points.limit(0).select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("weight"))
    for p in parts:
        out = out.unionByName(p)
    return staged(out, "density-tree")


def _numbered(edges: DataFrame) -> DataFrame:
    """Edges with ``seq``, their place in order of weight: sorted by range, numbered inside partitions, shifted by what lies before."""
    local = staged(
        edges.repartitionByRange("weight", "a", "b").select("a", "b", "weight", F.spark_partition_id().alias("_p")).withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy("weight", "a", "b"))), "density-edges"
    )
    counts = sorted((r["_p"], r["count"]) for r in local.groupBy("_p").count().collect())  # one row a partition
    before, at = {}, 0
    for p, n in counts:
        before[p] = at
        at += n
    shift = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("_p")] if before else F.lit(0)
    return local.select("a", "b", "weight", (F.col("_i") - 1 + shift).cast("bigint").alias("seq"))


_STATE = "n bigint, s double, kids double, node bigint"
_STEP = f"kind int, old string, comp string, {_STATE}, parent bigint, stability double"


def _block(least: int):
    """Merges of one block of edges in order: what becomes of the parts they touch (kind 0: part and the part that holds it now), the state of what
    results (1), clusters that end by meeting another (2), and which cluster a part without one came into first (3)."""

    def run(batches):
        rows = sorted((r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)), key=lambda r: r[0])
        up: dict[str, str] = {}
        state: dict[str, list] = {}
        loose: dict[str, list[str]] = {}
        out: list[tuple] = []

        def find(c):
            while up[c] != c:
                up[c] = up[up[c]]
                c = up[c]
            return c

        for seq, weight, *sides in rows:
            for c, *found in (sides[:5], sides[5:]):
                if c not in up:
                    up[c], state[c], loose[c] = c, list(found), [] if found[3] is not None else [c]
            a, b = find(sides[0]), find(sides[5])
            if state[a][0] < state[b][0]:
                a, b = b, a
            na, nb, density = state[a][0], state[b][0], 1 / max(weight, LEAST_DISTANCE)
            big = [c for c in (a, b) if state[c][3] is not None]
            if len(big) == 2:
                kids = 0.0
                for c in (a, b):
                    n, s, under, node = state[c]
                    stability = s - n * density
                    out.append((2, None, None, n, s, under, node, seq, stability))
                    kids += max(stability, under)
                state[a] = [na + nb, (na + nb) * density, kids, seq]
            elif big:
                n, s, under, node = state[big[0]]
                state[a] = [na + nb, s + (na + nb - n) * density, under, node]
            elif na + nb >= least:
                state[a] = [na + nb, (na + nb) * density, 0.0, seq]
            else:
                state[a] = [na + nb, 0.0, 0.0, None]
            up[b] = a
            loose[a] += loose.pop(b)
            if state[a][3] is not None and loose[a]:
                # Parts that were in a cluster already keep the first: they are not loose. With two clusters meeting nothing is loose.
                out += [(3, c, None, None, None, None, state[a][3], None, None) for c in loose[a]]
                loose[a] = []
        for c in up:
            root = find(c)
            out.append((0, c, root, None, None, None, None, None, None))
            if root == c:
                out.append((1, None, c, *state[c], None, None))
        if out:
            types = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["kind", "old", "comp", "n", "s", "kids", "node", "parent", "stability"])

    return run


def condensed_clusters(points: DataFrame, tree: DataFrame, least: int, block: int = EDGES_A_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(points in clusters, clusters) of the hierarchy that cutting ``tree`` (a, b, weight) at falling weights gives.

    Clusters are parts of at least ``least`` points: (node, parent, n, stability, chosen). Stability sums over a cluster's points how much denser the point leaves it than it
    began, density being 1 / weight. A cluster is chosen if it is at least as stable as the chosen ones inside it together; the whole is not. Points: (id, node), with the
    smallest cluster each belongs to; points of none are absent.

    Edges are taken in blocks in order of weight: a task merges one block's parts, whose states it gets by a join, and hands their new states on. So memory is bounded by the block
    whatever the number of points, and the number of rounds is that of blocks.
    """
    edges = staged(_numbered(tree), "density-edges")
    last = edges.agg(F.max("seq")).first()[0]
    member = staged(points.select("id", F.col("id").alias("comp")), "density-parts")
    none = F.lit(None).cast("bigint")
    states = staged(points.select(F.col("id").alias("comp"), F.lit(1).cast("bigint").alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("kids"), none.alias("node")), "density-states")
    joined, ended = [], []
    for begin in range(0, -1 if last is None else last + 1, block):
        part = edges.filter(F.col("seq").between(begin, begin + block - 1))
        for end, side in (("a", "l"), ("b", "r")):
            part = part.join(member.select(F.col("id").alias(end), F.col("comp").alias(f"{side}_comp")), end)
            part = part.join(states.select(*[F.col(c).alias(f"{side}_{c}") for c in ("comp", "n", "s", "kids", "node")]), f"{side}_comp")
        columns = ["seq", "weight", *[f"{side}_{c}" for side in "lr" for c in ("comp", "n", "s", "kids", "node")]]
        step = staged(part.select(*columns).repartition(1).mapInArrow(_block(least), _STEP), "density-step")
        moved = step.filter("kind = 0").select(F.col("old").alias("comp"), F.col("comp").alias("_to"))
        cluster = step.filter("kind = 3").select(F.col("old").alias("comp"), "node")
        joined.append(member.join(cluster, "comp").select("id", "node"))
        ended.append(step.filter("kind = 2").select("node", "parent", "n", "stability", (F.col("stability") >= F.col("kids")).alias("chosen")))
        fresh = step.filter("kind = 1").select("comp", "n", "s", "kids", "node")
        states = staged(states.join(moved, "comp", "left_anti").unionByName(fresh), "density-states")
        member = staged(member.join(moved, "comp", "left").select("id", F.coalesce("_to", "comp").alias("comp")), "density-parts")
    top = states.filter("node is not null").select("node", none.alias("parent"), "n", F.lit(0.0).alias("stability"), F.lit(False).alias("chosen"))
    clusters, inside = top, points.select("id", none.alias("node")).limit(0)
    for df in ended:
        clusters = clusters.unionByName(df)
    for df in joined:
        inside = inside.unionByName(df)
    return staged(inside, "density-inside"), staged(clusters, "density-clusters")


def outermost_chosen(clusters: DataFrame) -> DataFrame:
    """(node, cluster_id): of each cluster the outermost chosen one that holds it, itself included; clusters in none are absent. By pointer doubling."""
    now = staged(clusters.select("node", F.col("parent").alias("up"), F.when(F.col("chosen"), F.col("node")).alias("best")), "density-outer")
    while not now.filter("up is not null").isEmpty():
        p, q = now.alias("p"), now.alias("q")
        now = staged(p.join(q, F.col("p.up") == F.col("q.node"), "left").select("p.node", F.col("q.up").alias("up"), F.coalesce("q.best", "p.best").alias("best")), "density-outer")
    return now.filter("best is not null").select("node", F.col("best").alias("cluster_id"))


def density_hierarchy(points: DataFrame, least: int, k: int | None = None, block: int = EDGES_A_BLOCK, few: int = FEW) -> DataFrame:
    """(id, cluster_id, is_outlier) of ``points`` (id, x): clusters of at least ``least`` points, chosen from all radii by stability; outliers have none.

    ``k``: the neighbour whose distance is the core distance, ``least`` by default. Cluster numbers are those of merges and mean nothing else. Repeated ids count once.
    """
    points = staged(points.select("id", "x").dropDuplicates(["id"]), "density-points")
    inside, clusters = condensed_clusters(points, reachability_tree(points, k or least, few), least, block)
    labels = inside.join(outermost_chosen(clusters), "node").select("id", "cluster_id")
    return points.select("id").join(labels, "id", "left").withColumn("is_outlier", F.col("cluster_id").isNull())


def density_clusters(features: DataFrame, key: str, least: int | None = None, names: list[str] = FEATURES) -> DataFrame:
    """``features`` with cluster_id and is_outlier, on standardized features; ``least`` is 5 by default, with fewer rows as many, at least 2."""
    least = max(2, min(5, features.count())) if least is None else least
    points = staged(vectors(features, names).select(F.col(key).cast("string").alias("id"), vector_to_array("vector").alias("x")), "density-vectors")
    return features.withColumn("id", F.col(key).cast("string")).join(density_hierarchy(points, least), "id", "left").drop("id")
