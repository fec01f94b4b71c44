"""Agglomerative clustering by Ward's criterion, in rounds that merge all reciprocal nearest neighbours at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.models import FEATURES, vectors
from tidewright.operators.nearest import Pivots, distances
from tidewright.sources.sinks import staged

#: Once so few clusters are left, one task merges them: the last rounds are many and small.
LAST = 512
_MERGES = "a string, b string, height double, size bigint"


def _merge_the_last(batches):
    """All merges of a few clusters (id, weight, x), the nearest two at a time."""
    rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    rows.sort()
    ids, out, n = [r[0] for r in rows], [], len(rows)
    if n > 1:
        x, w, left = np.array([r[2] for r in rows], dtype=float), np.array([r[1] for r in rows], dtype=float), np.ones(n, dtype=bool)
        d = distances("ward", x, w, x, w)
        d[np.tril_indices(n)] = np.inf
    for _ in range(n - 1):
        i, j = np.unravel_index(int(d.argmin()), d.shape)
        size = w[i] + w[j]
        out.append((ids[i], ids[j], float(d[i, j]), int(size)))
        x[i], w[i], left[j] = (x[i] * w[i] + x[j] * w[j]) / size, size, False
        d[j, :], d[:, j] = np.inf, np.inf
        fresh = np.where(left, distances("ward", x[i : i + 1], w[i : i + 1], x, w)[0], np.inf)
        d[i, i + 1 :], d[:i, i] = fresh[i + 1 :], fresh[:i]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["a", "b", "height", "size"])


def ward_merges(points: DataFrame, last: int = LAST) -> DataFrame:
    """(a, b, height, size): the merges of the whole dendrogram of ``points`` (id, x). A cluster is named by its least id, so ``b`` goes into ``a``.

    Height is the square root of twice what the sum of squares inside clusters grows by. Ward's criterion is reducible: two clusters that are each other's nearest stay so whatever
    else merges, so a round merges all such pairs and the dendrogram is that of one merge at a time. What a round keeps are centres and sizes,
    which give the distances that the Lance-Williams formula would update; nearest clusters are found through pivots, never by all pairs.
    Equal vectors merge first, at height 0. A round always merges the nearest pair of all, and usually a third of the clusters; series of points at ever larger distances need a round each.
    """
    rows = points.select("id", F.col("x").cast("array<double>").alias("x")).filter("id is not null and x is not null")
    same = staged(rows.groupBy("x").agg(F.array_sort(F.collect_set("id")).alias("ids")), "ward-equal")
    exploded = same.select(F.col("ids")[0].alias("a"), F.posexplode("ids").alias("place", "b")).filter("place > 0")
    merges = [exploded.select("a", "b", F.lit(0.0).alias("height"), (F.col("place") + 1).cast("bigint").alias("size"))]
    clusters = staged(same.select(F.col("ids")[0].alias("id"), F.size("ids").cast("double").alias("weight"), "x"), "ward-clusters")
    while (n := clusters.count()) > max(last, 1):
        found = Pivots(clusters.withColumn("label", F.col("id")), n).search(None, "ward").groupBy("id").agg(F.min(F.struct("distance", "other")).alias("m"))
        asked = clusters.join(found, "id", "left").select("id", "weight", "x", F.col("m.distance").alias("height"), F.least("id", "m.other").alias("a"), F.greatest("id", "m.other").alias("b"))
        # Two clusters that name each other are one group of two rows; every other group is a row that stays.
        met = asked.groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("id", "weight", "x", "height"))).alias("s"))
        p, q, both = F.col("s")[0], F.get("s", F.lit(1)), F.size("s") == 2
        wa, wb = p["weight"], q["weight"]
        middle = F.zip_with(p["x"], q["x"], lambda u, v: (u * wa + v * wb) / (wa + wb))
        step = staged(met.select(p["id"].alias("id"), F.when(both, q["id"]).alias("b"), p["height"].alias("height"), F.when(both, wa + wb).otherwise(wa).alias("weight"), F.when(both, middle).otherwise(p["x"]).alias("x")), "ward-round")
        merges.append(step.filter("b is not null").select(F.col("id").alias("a"), "b", "height", F.col("weight").cast("bigint").alias("size")))
        clusters = step.select("id", "weight", "x")
    merges.append(clusters.select("id", "weight", "x").coalesce(1).mapInArrow(_merge_the_last, _MERGES))
    out = merges[0]
    for m in merges[1:]:
        out = out.unionByName(m)
    return staged(out, "ward-merges")


def cut(points: DataFrame, merges: DataFrame, k: int) -> DataFrame:
    """(id, cluster_id): ``points`` in ``k`` clusters, named by their least id: without the k - 1 highest merges (of equal heights the larger, then by name)."""
    high = merges.orderBy(F.desc("height"), F.desc("size"), "a", "b").limit(max(k - 1, 0))
    kept = merges.join(high.select("a", "b"), ["a", "b"], "left_anti")
    up = staged(points.select("id").distinct().join(kept.select(F.col("b").alias("id"), F.col("a").alias("up")), "id", "left").select("id", F.coalesce("up", "id").alias("up")), "ward-up")
    while True:
        step = up.alias("p").join(up.alias("q"), F.col("p.up") == F.col("q.id")).select("p.id", F.col("q.up").alias("up"), (F.col("q.up") != F.col("p.up")).alias("_moved"))
        step = staged(step, "ward-up")
        up = step.drop("_moved")
        if step.filter("_moved").isEmpty():
            return up.select("id", F.col("up").alias("cluster_id"))


def ward_cluster(features: DataFrame, key: str, k: int | None = None, completeness: float = 0.8, names: list[str] = FEATURES) -> DataFrame:
    """``features`` rows complete enough, with cluster_id, by Ward's criterion on standardized features; k is half the rows by default, at least 2. None with fewer than two rows."""
    rows = features.filter(F.col("completeness") >= completeness) if "completeness" in features.columns else features
    n = rows.count()
    if n < 2:
        return rows.withColumn("cluster_id", F.lit(None).cast("string")).limit(0)
    points = staged(vectors(rows, names).select(F.col(key).cast("string").alias("id"), vector_to_array("vector").alias("x")), "ward-points")
    found = cut(points, ward_merges(points), min(max(2, n // 2) if k is None else k, n))
    return rows.withColumn("id", F.col(key).cast("string")).join(found, "id").drop("id")
