"""Clustering of feature rows, with Spark ML."""

from __future__ import annotations

import math
import random

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.sources.sinks import staged

FEATURES = ["mean", "median", "sd", "cv", "slope", "growth_4", "growth_13", "peak_ratio", "zero_ratio", "autocorr_1", "autocorr_seasonal", "arrival_delay_mean", "arrival_delay_p90", "transshipment_share", "seasonal_strength", "plan_revision_frequency"]


def vectors(features: DataFrame, names: list[str] = FEATURES, robust: bool = False) -> DataFrame:
    """``features`` with a vector of the named columns: null is 0, then zero mean and unit population deviation (or median and MAD)."""
    filled = features.na.fill(0.0, names)
    if robust:
        mid = filled.agg(*[F.median(c).alias(c) for c in names]).first()
        spread = filled.agg(*[F.median(F.abs(F.col(c) - mid[c])).alias(c) for c in names]).first()
    else:
        both = filled.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names)]).first()
        mid, spread = ({c: both[f"{x}{i}"] for i, c in enumerate(names)} for x in "ms")
    scaled = filled.withColumns({f"_z_{c}": (F.col(c) - F.lit(mid[c] or 0.0)) / F.lit(float(spread[c] or 0) or 1.0) for c in names})
    return VectorAssembler(inputCols=[f"_z_{c}" for c in names], outputCol="vector").transform(scaled).drop(*[f"_z_{c}" for c in names])


def silhouette(labelled: DataFrame, label: str = "cluster_id") -> float | None:
    """None unless there are two clusters and more rows than clusters."""
    rows = labelled.filter(F.col(label).isNotNull()).withColumn("prediction", F.col(label).cast("int"))
    n, k = rows.agg(F.count("*"), F.countDistinct("prediction")).first()
    return None if k < 2 or n <= k else ClusteringEvaluator(featuresCol="vector", metricName="silhouette").evaluate(rows)


def cluster(features: DataFrame, k: int | None = None, completeness: float = 0.8, seed: int = 7, names: list[str] = FEATURES) -> DataFrame:
    """``features`` rows complete enough, with cluster_id, by bisecting k-means; k is half the rows by default, at least 2. None with fewer than two rows."""
    rows = features.filter(F.col("completeness") >= completeness) if "completeness" in features.columns else features
    n = rows.count()
    if n < 2:
        return rows.withColumn("cluster_id", F.lit(None).cast("int")).limit(0)
    data = vectors(rows, names)
    k = min(max(2, n // 2) if k is None else k, n)
    model = BisectingKMeans(k=k, seed=seed, featuresCol="vector", predictionCol="cluster_id").fit(data)
    if len(model.clusterCenters()) < 2 <= k:  # a first split can leave one side empty on very few rows
        model = KMeans(k=k, seed=seed, featuresCol="vector", predictionCol="cluster_id").fit(data)
    return model.transform(data)


def choose_k(features: DataFrame, ks: list[int], names: list[str] = FEATURES, seed: int = 7) -> tuple[int, dict[int, float | None]]:
    """The k of ``ks`` with the best silhouette, and all of them."""
    scores = {k: silhouette(cluster(features, k, names=names, seed=seed)) for k in ks}
    return max(scores, key=lambda k: -math.inf if scores[k] is None else scores[k]), scores


def neighbours(data: DataFrame, key: str, radius: float, size: int, axes: int = 2, seed: int = 1) -> DataFrame:
    """(a, b): all pairs of rows of ``data`` (key, vector of ``size`` numbers) within ``radius`` of each other, each row with itself as well. Exact.

    Along any direction two such rows lie at most ``radius`` apart, so they are in the same or in neighbouring cells of a grid over ``axes`` random
    directions: an equi-join on the cell, then the distance decides.
    """
    rng = random.Random(seed)
    drawn = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(axes)]
    units = [[x / math.sqrt(sum(y * y for y in v)) for x in v] for v in drawn]
    rows = data.select(key, vector_to_array("vector").alias("x"))
    along = lambda v: F.aggregate(F.zip_with("x", F.array(*map(F.lit, v)), lambda p, q: p * q), F.lit(0.0), lambda s, y: s + y)
    placed = rows.withColumns({f"c{i}": F.floor(along(v) / radius) for i, v in enumerate(units)})
    around = placed
    for i in range(axes):
        around = around.withColumn(f"c{i}", F.explode(F.array(*[F.col(f"c{i}") + k for k in (-1, 0, 1)])))
    cells = [f"c{i}" for i in range(axes)]
    both = placed.select(F.col(key).alias("a"), F.col("x").alias("xa"), *cells).join(around.select(F.col(key).alias("b"), F.col("x").alias("xb"), *cells), cells)
    square = F.aggregate(F.zip_with("xa", "xb", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, y: s + y)
    return both.filter(square <= radius * radius).select("a", "b")


def density_cluster(features: DataFrame, key: str, radius: float, min_points: int, names: list[str] = FEATURES) -> DataFrame:
    """Clusters of rows that have ``min_points`` rows (themselves included) within ``radius`` of each other; the rest are outliers without a cluster.

    Neighbours are exact. Core rows take the smallest label around them and then that label's own, until nothing changes: a chain of n rows needs some log n rounds.
    A row within reach of a core row joins its cluster, of several the one with the smallest key.
    """
    near = staged(neighbours(vectors(features, names).select(key, "vector"), key, radius, len(names)), "neighbours")
    cores = near.groupBy("a").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_points).select("a")
    links = staged(near.join(cores, "a").join(cores.select(F.col("a").alias("b")), "b").select("a", "b"), "links")
    labels = staged(cores.withColumn("label", F.col("a")), "labels")
    while True:
        spread = links.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("_new"))
        jump = labels.select(F.col("a").alias("_new"), F.col("label").alias("_next"))
        lowered = staged(labels.join(spread, "a").join(jump, "_new").select("a", F.least("label", "_new", "_next").alias("label"), (F.least("_new", "_next") < F.col("label")).alias("_moved")), "labels")
        labels = lowered.drop("_moved")
        if lowered.filter("_moved").isEmpty():
            break
    reach = near.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("cluster_id"))
    return features.join(reach.withColumnRenamed("a", key), key, "left").withColumn("is_outlier", F.col("cluster_id").isNull())


def cluster_overview(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster_id").agg(F.count("*").alias("entities"), F.count_if(F.col("is_outlier")).alias("outliers"))


def soft_clusters(features: DataFrame, k: int, names: list[str] = FEATURES, seed: int = 7) -> DataFrame:
    return GaussianMixture(k=k, seed=seed, featuresCol="vector", predictionCol="cluster_id", probabilityCol="membership").fit(data := vectors(features, names)).transform(data)


def co_assignment(assignments: DataFrame) -> DataFrame:
    """(a, b, share): in which share of the runs two entities were in one cluster (run_id, entity_key, cluster_id). Only entities of one cluster meet."""
    runs = assignments.agg(F.countDistinct("run_id").alias("_runs"))
    x = assignments.select("run_id", "cluster_id", F.col("entity_key").alias("a"))
    y = assignments.select("run_id", "cluster_id", F.col("entity_key").alias("b"))
    return x.join(y, ["run_id", "cluster_id"]).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("_n")).crossJoin(F.broadcast(runs)).select("a", "b", (F.col("_n") / F.col("_runs")).alias("share"))


def prototypes(curves: DataFrame, assignments: DataFrame) -> DataFrame:
    """Median, quartile and decile bands of each cluster at each time."""
    return curves.join(assignments.select("entity_key", "cluster_id"), "entity_key").groupBy("cluster_id", "time_bucket").agg(F.percentile("value", F.array(*map(F.lit, (0.1, 0.25, 0.5, 0.75, 0.9)))).alias("bands"))


def similar_history(curves: DataFrame, entity: str, points: int, k: int) -> DataFrame:
    """The ``k`` stretches of ``points`` values, of any series of the same type, that are nearest to the entity's latest stretch (Euclidean)."""
    w = Window.partitionBy("entity_key", "curve_type").orderBy("time_bucket").rowsBetween(1 - points, 0)
    back = Window.partitionBy("entity_key", "curve_type").orderBy(F.desc("time_bucket"))
    spans = curves.withColumns({"stretch": F.collect_list("value").over(w), "_r": F.row_number().over(back)}).filter(F.size("stretch") == points)
    asked = spans.filter((F.col("entity_key") == entity) & (F.col("_r") == 1)).select("curve_type", F.col("stretch").alias("_q"))
    distance = F.sqrt(F.aggregate(F.zip_with("stretch", "_q", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    return spans.filter(~((F.col("entity_key") == entity) & (F.col("_r") == 1))).join(asked, "curve_type").withColumn("distance", distance).orderBy("distance", "entity_key", "time_bucket").limit(k).select("entity_key", "curve_type", "time_bucket", "distance")
