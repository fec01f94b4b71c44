"""Ward, density and shape clusters against plain versions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators import density, elastic, hierarchy, nearest


def points(seed, n, d=3, spots=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 6, (spots, d))
    x = np.vstack([centres[i % spots] + rng.normal(0, 0.4 + 0.3 * (i % spots), d) for i in range(n - n // 8)] + [rng.uniform(-12, 12, d) for _ in range(n // 8)])
    return {f"p{i:03}": x[i] for i in rng.permutation(n)}


def frame(spark, pts):
    return spark.createDataFrame([(k, v.tolist(), "x") for k, v in pts.items()], "id string, x array<double>, label string").repartition(3)


def partition(labels):
    groups = {}
    for k, v in labels.items():
        groups.setdefault(v, set()).add(k)
    return {frozenset(g) for v, g in groups.items() if v is not None}


@pytest.mark.parametrize("block", [2000, 7])
def test_nearest_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "BLOCK", block)
    pts = points(1, 150)
    pts["q1"] = pts["q2"] = pts["p000"]
    got = {}
    for r in nearest.nearest(frame(spark, pts), 4).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"], round(r["distance"], 9)))
    for k, x in pts.items():
        want = sorted((round(float(np.sqrt(((x - y) ** 2).sum())), 9), o) for o, y in pts.items() if o != k)[:4]
        assert sorted(got[k]) == [(i + 1, o, d) for i, (d, o) in enumerate(want)]


def test_nearest_leaves_far_cells_out(spark):
    rng = np.random.default_rng(2)
    pts = {f"p{i}": np.array([100.0 * (i % 20), 0]) + rng.normal(0, 1, 2) for i in range(400)}
    rows = frame(spark, pts).select("id", F.col("id").alias("label"), F.lit(1.0).alias("weight"), "x").cache()
    pivots = nearest.Pivots(rows)
    found = pivots.search(rows, "plain")
    assert len(pivots.ids) == 20 and found.count() < 400 * 8


def test_nearest_visits_few_cells_of_one_cloud(spark):
    rng = np.random.default_rng(3)
    rows = frame(spark, {f"p{i}": rng.normal(0, 1, 4) for i in range(1000)}).select("id", F.col("id").alias("label"), F.lit(1.0).alias("weight"), "x").cache()
    found = nearest.Pivots(rows).search(rows, "plain").count()
    assert found < 8 * 1000


def plain_ward(pts):
    groups = {k: (1, np.array(v), {k}) for k, v in pts.items()}
    merges = []
    while len(groups) > 1:
        d, a, b = min((math.sqrt(2 * m * n / (m + n) * ((x - y) ** 2).sum()), a, b) for (a, (m, x, _)), (b, (n, y, _)) in itertools.combinations(sorted(groups.items()), 2))
        (m, x, s), (n, y, t) = groups[a], groups.pop(b)
        groups[a] = m + n, (x * m + y * n) / (m + n), s | t
        merges.append((a, b, round(d, 6), m + n))
    return merges


@pytest.mark.parametrize("n, last", [(200, 40), (24, 2)])
def test_ward_equals_plain_ward(spark, n, last):
    pts = points(3, n)
    df = frame(spark, pts).cache()
    want = plain_ward(pts)
    merges = hierarchy.ward_merges(df, last=last)
    assert sorted((r["a"], r["b"], round(r["height"], 6), r["size"]) for r in merges.collect()) == sorted(want)
    for k in (1, 2, 5, n):
        labels = {k: k for k in pts}
        for a, b, _, _ in sorted(want, key=lambda m: (m[2], m[3]))[: n - k]:
            labels = {p: a if v == b else v for p, v in labels.items()}
        assert {r["id"]: r["cluster_id"] for r in hierarchy.cut(df, merges, k).collect()} == labels


def test_ward_of_repeated_points_and_of_few(spark):
    pts = {f"p{i}": np.array([float(i // 3), 0.0]) for i in range(9)} | {"q": np.array([50.0, 0.0])}
    merges = hierarchy.ward_merges(frame(spark, pts), last=2).collect()
    assert sorted((r["a"], r["b"], r["size"]) for r in merges if r["height"] == 0) == [("p0", "p1", 2), ("p0", "p2", 3), ("p3", "p4", 2), ("p3", "p5", 3), ("p6", "p7", 2), ("p6", "p8", 3)]
    assert len(merges) == 9 and max(r["size"] for r in merges) == 10
    assert hierarchy.ward_merges(frame(spark, {"a": np.zeros(2)})).count() == 0
    assert hierarchy.ward_merges(spark.createDataFrame([], "id string, x array<double>")).count() == 0
    features = spark.createDataFrame([("a", 0.0, 1.0), ("b", 0.1, 1.0), ("c", 9.0, 1.0), ("d", 9.1, 1.0), ("e", 9.0, 0.1)], "entity_key string, mean double, completeness double")
    got = {r["entity_key"]: r["cluster_id"] for r in hierarchy.ward_cluster(features, "entity_key", names=["mean"]).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c"}
    assert hierarchy.ward_cluster(features.limit(1), "entity_key", names=["mean"]).count() == 0


def plain_reach(pts, k):
    ids = sorted(pts)
    x = np.array([pts[i] for i in ids])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    core = np.sort(d + np.diag([np.inf] * len(ids)), axis=1)[:, min(k, len(ids) - 1) - 1]
    return ids, np.maximum(d, np.maximum(core[:, None], core[None]))


def plain_tree(ids, reach):
    """Kruskal over all pairs."""
    up, out = {i: i for i in range(len(ids))}, []
    find = lambda i: i if up[i] == i else find(up[i])
    for w, i, j in sorted((reach[i, j], i, j) for i in range(len(ids)) for j in range(i + 1, len(ids))):
        if find(i) != find(j):
            up[find(i)] = find(j)
            out.append((ids[i], ids[j], float(w)))
    return out


def plain_density(pts, least, k):
    """From the top: cut the heaviest edge, follow the parts that are large enough, choose by stability."""
    ids, reach = plain_reach(pts, k)
    edges = sorted(plain_tree(ids, reach), key=lambda e: (e[2], e[0], e[1]))

    def parts(nodes, left):
        up = {n: n for n in nodes}
        def find(n):
            while up[n] != n:
                n = up[n]
            return n
        for a, b, _ in left:
            up[find(a)] = find(b)
        groups = {}
        for n in nodes:
            groups.setdefault(find(n), set()).add(n)
        return list(groups.values())

    def explore(nodes, left, born):
        """(value, chosen clusters) of a cluster that begins at density ``born`` with these nodes; the whole has none of its own."""
        stability, inside = 0.0, set(nodes)
        while left:
            *left, (_, _, w) = left
            density_now = 1 / max(w, density.LEAST_DISTANCE)
            two = parts(inside, left)
            large = [p for p in two if len(p) >= least]
            if len(large) == 1:
                stability += sum(density_now - born for p in two if len(p) < least for _ in p)
                inside = large[0]
                left = [e for e in left if e[0] in inside]
                continue
            stability += (density_now - born) * len(inside)
            if not large:
                return stability, [set(nodes)]
            below = [explore(p, [e for e in left if e[0] in p], density_now) for p in large]
            value, found = sum(v for v, _ in below), [c for _, cs in below for c in cs]
            return (stability, [set(nodes)]) if born and stability >= value else (max(value, stability if born else 0), found)
        return stability, [set(nodes)]

    top = explore(set(ids), edges, 0.0)[1] if len(ids) >= least else []
    return [] if any(len(c) == len(ids) for c in top) else top


@pytest.mark.parametrize("n, least, k, block, few", [(100, 5, 5, 10_000, 0), (40, 4, 3, 7, 256)])
def test_density_hierarchy_equals_plain_version(spark, n, least, k, block, few):
    pts = points(4 + n, n, d=2)
    df = frame(spark, pts).cache()
    ids, reach = plain_reach(pts, k)
    tree = density.reachability_tree(df, k, few)
    assert sorted((r["a"], r["b"], round(r["weight"], 9)) for r in tree.collect()) == sorted((a, b, round(w, 9)) for a, b, w in plain_tree(ids, reach))
    rows = density.density_hierarchy(df, least, k, block, few).collect()
    assert {r["id"] for r in rows} == set(pts) and all(r["is_outlier"] == (r["cluster_id"] is None) for r in rows)
    want = {frozenset(c) for c in plain_density(pts, least, k)}
    assert partition({r["id"]: r["cluster_id"] for r in rows}) == want and len(want) > 1


def test_density_of_repeated_points_and_of_few(spark):
    pts = {f"p{i}": np.array([float(i // 6) * 5, 0.0]) for i in range(18)} | {"q": np.array([500.0, 0.0])}
    got = {r["id"]: r["cluster_id"] for r in density.density_hierarchy(frame(spark, pts), 4).collect()}
    assert partition(got) == {frozenset(f"p{i}" for i in range(6 * g, 6 * g + 6)) for g in range(3)} and got["q"] is None
    for few in ({}, {"a": np.zeros(2)}, {"a": np.zeros(2), "b": np.ones(2)}):
        df = frame(spark, few) if few else spark.createDataFrame([], "id string, x array<double>")
        assert [r["cluster_id"] for r in density.density_hierarchy(df, 3).collect()] == [None] * len(few)
    features = spark.createDataFrame([(f"e{i}", float(i % 2 * 50 + i / 10)) for i in range(12)] + [("far", 9e3)], "entity_key string, mean double")
    rows = {r["entity_key"]: r for r in density.density_clusters(features, "entity_key", least=4, names=["mean"]).collect()}
    assert len(partition({k: r["cluster_id"] for k, r in rows.items()})) == 2 and rows["far"]["is_outlier"] and len(rows) == 13


def plain_warping(a, b, band):
    if not a or not b or abs(len(a) - len(b)) > band:
        return None
    d = np.full((len(a) + 1, len(b) + 1), np.inf)
    d[0, 0] = 0
    for i in range(1, len(a) + 1):
        for j in range(max(1, i - band), min(len(b), i + band) + 1):
            d[i, j] = (a[i - 1] - b[j - 1]) ** 2 + min(d[i - 1, j - 1], d[i - 1, j], d[i, j - 1])
    return math.sqrt(d[-1, -1])


def waves(seed, n):
    rng = random.Random(seed)
    kinds = [lambda t: math.sin(t), lambda t: t / 4, lambda t: 3.0 if 5 < t < 9 else 0.0]
    out = {}
    for i in range(n):
        f, shift, length = kinds[i % 3], rng.uniform(-0.8, 0.8), rng.choice([14, 15, 16])
        out[f"s{i:02}"] = [round(f(t + shift) + rng.gauss(0, 0.05), 3) for t in range(length)]
    return out


def test_warping_equals_plain_version(spark):
    series = waves(5, 12) | {"e": [], "one": [1.0], "long": [0.5] * 22}
    df = spark.createDataFrame([(k, v) for k, v in series.items()], "id string, x array<double>")
    a, b = df.select(F.col("id").alias("a"), F.col("x").alias("xa")), df.select(F.col("id").alias("b"), F.col("x").alias("xb"))
    for band in (0, 1, 3):
        rows = a.crossJoin(b).select("a", "b", elastic.warping_distance(F.col("xa"), F.col("xb"), band).alias("d"), elastic.envelope_bound(F.col("xa"), elastic.envelope(F.col("xb"), band)).alias("low")).collect()
        for r in rows:
            want = plain_warping(series[r["a"]], series[r["b"]], band)
            assert (r["d"] is None) == (want is None), r
            if want is not None:
                assert math.isclose(r["d"], want, abs_tol=1e-9) and r["low"] <= want + 1e-9


def test_similar_shapes_and_what_the_envelope_rules_out(spark):
    series = waves(6, 60)
    df = spark.createDataFrame(list(series.items()), "id string, x array<double>").repartition(3)
    want = {(a, b): round(d, 9) for a, b in itertools.combinations(sorted(series), 2) if (d := plain_warping(series[a], series[b], 2)) is not None and d <= 0.9}
    assert {(r["a"], r["b"]): round(r["distance"], 9) for r in elastic.similar_shapes(df, 0.9, 2).collect()} == want and len(want) > 50
    met = elastic.shape_candidates(df, 0.9, 2)
    all_pairs, joined, let_through = 60 * 59 // 2, met.count(), met.filter("bound <= 0.9").count()
    assert len(want) <= let_through < 0.4 * all_pairs and let_through < 0.7 * joined, (len(want), let_through, joined)


def test_shape_medoids(spark):
    series = waves(7, 30)
    df = spark.createDataFrame(list(series.items()), "id string, x array<double>").repartition(3)
    rows = {r["id"]: r for r in elastic.shape_medoids(df, 3, 2).collect()}
    assert partition({k: r["medoid"] for k, r in rows.items()}) == {frozenset(f"s{i:02}" for i in range(g, 30, 3)) for g in range(3)}
    for medoid in {r["medoid"] for r in rows.values()}:
        members = [k for k, r in rows.items() if r["medoid"] == medoid]
        cost = {c: sum(plain_warping(series[c], series[m], 2) for m in members) for c in members}
        assert cost[medoid] <= min(cost.values()) + 1e-6
    assert all(math.isclose(r["distance"], plain_warping(series[k], series[r["medoid"]], 2), abs_tol=1e-9) for k, r in rows.items())


def test_similar_shapes_in_one_crowded_cell_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(elastic, "BLOCK", 25)
    rows = [(f"s{i:03}", [float((i * 7 + k * (i % 5)) % 11) / 8 for k in range(6 + i % 2)] if i % 9 else [0.5, None, 0.25, 0.5, 0.5, 0.75]) for i in range(120)]
    df = spark.createDataFrame(rows, "id string, x array<double>")
    plain = df.alias("p").join(df.alias("q"), F.col("p.id") < F.col("q.id")).select(F.col("p.id").alias("a"), F.col("q.id").alias("b"), elastic.warping_distance(F.col("p.x"), F.col("q.x"), 2).alias("d")).filter("d <= 1")
    want = {(r["a"], r["b"]): r["d"] for r in plain.collect()}
    found = elastic.similar_shapes(df, 1.0, 2)
    assert {(r["a"], r["b"]): r["distance"] for r in found.collect()} == want and len(want) > 50
    assert found.rdd.getNumPartitions() == elastic.TASKS


def test_equal_shapes_are_compared_once(spark, monkeypatch):
    monkeypatch.setattr(elastic, "BLOCK", 7)
    tables, write = {}, elastic.staged
    monkeypatch.setattr(elastic, "staged", lambda df, label: tables.setdefault(label, write(df, label)))
    kinds = [[0.0, 1.0, 2.0, 1.0], [0.0, 1.0, 2.0, 1.5, 1.0], [0.5, 1.0, 2.0, 1.0], [-0.0, 1.0, 2.0, 1.0], [9.0], [9.5, 9.0], [float("nan"), 1.0], [float("inf"), 1.0, 1.0]]
    series = {f"s{i:03}": kinds[i % 8] for i in range(160)}
    df = spark.createDataFrame([*series.items(), ("none", None), ("null", [1.0, None])], "id string, x array<double>").repartition(3)
    got = [(r["a"], r["b"], round(r["distance"], 9)) for r in elastic.similar_shapes(df, 1.0, 2).collect()]
    want = [(a, b, round(d, 9)) for a, b in itertools.combinations(sorted(series), 2) if (d := plain_warping(series[a], series[b], 2)) is not None and d <= 1]
    assert sorted(got) == sorted(want) and len(want) > 3000
    assert tables["shape-blocks"].count() == 5


def test_what_the_envelope_rules_out_in_single_precision():
    rng = np.random.default_rng(3)
    for n, m, at, radius in ((5, 5, 0.0, 1.0), (5, 6, 1e6, 1.0), (1, 3, 0.0, 1.0), (3, 1, 0.0, 1.0), (4, 4, 1e12, 0.5), (4, 4, 1e35, 1.0)):
        a, b = at + rng.normal(size=(40, n)), at + rng.normal(size=(50, m))
        some = {(int(p), int(q)) for i, j in elastic._may_be_near(a, b, radius, 2) for p, q in zip(i, j, strict=True)}
        near = {(p, q) for p in range(40) for q in range(50) if plain_warping(list(a[p]), list(b[q]), 2) <= radius}
        assert near <= some and near
        p, q = (np.array(c) for c in zip(*sorted(some), strict=True))
        assert np.allclose(elastic.warped(a[p], b[q], 2, 7), [plain_warping(list(a[i]), list(b[j]), 2) for i, j in sorted(some)], rtol=1e-12)


@pytest.mark.parametrize("series, k", [
    ({f"s{i:03}": [float(i)] * 3 for i in range(400)}, 1),
    ({f"a{i:02}": [0.0] * 4 for i in range(20)} | {f"b{i:02}": [5 + i / 100] * (3 + i % 2) for i in range(30)}, 1),
    ({f"n{i:02}": [round(random.Random(i).gauss(0, 1), 3), round(random.Random(-1 - i).gauss(0, 1), 3), i % 4 / 2] for i in range(90)}, 3),
])
def test_every_member_is_tried_as_medoid_until_nothing_moves(spark, monkeypatch, series, k):
    monkeypatch.setattr(elastic, "BLOCK", 60)
    rows = {r["id"]: r for r in elastic.shape_medoids(spark.createDataFrame(list(series.items()), "id string, x array<double>").repartition(3), k, 2).collect()}
    medoids = {r["medoid"] for r in rows.values()}
    assert len(medoids) == k and set(rows) == set(series)
    d = {(c, m): plain_warping(series[c], series[m], 2) for c in medoids for m in series}
    assert all(math.isclose(r["distance"], min(d[c, i] for c in medoids), abs_tol=1e-9) and math.isclose(r["distance"], d[r["medoid"], i], abs_tol=1e-9) for i, r in rows.items())
    for medoid in medoids:
        members = [i for i, r in rows.items() if r["medoid"] == medoid]
        assert sum(d[medoid, m] for m in members) <= min(sum(plain_warping(series[c], series[m], 2) for m in members) for c in members) + 1e-6
