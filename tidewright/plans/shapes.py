"""Queries of clusters: Ward, density, and warped shapes, over what suppliers look like."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.operators import density, elastic, hierarchy
from tidewright.plans.registry import doubles, query
from tidewright.sources.sinks import staged

_POINTS = "p AS (SELECT id, [quantity, discount, tax, returned] AS x FROM :supplier_vectors:)"


def _points(v):
    return staged(v("supplier_vectors").select("id", F.array("quantity", "discount", "tax", "returned").alias("x")), "supplier-points")


_WARD = f"""{_POINTS},
s(step, state, a, b, height, size) AS (
  SELECT 0, list(struct_pack(id := id, w := CAST(1 AS DOUBLE), x := x) ORDER BY id), NULL::VARCHAR, NULL::VARCHAR, NULL::DOUBLE, NULL::BIGINT FROM p
  UNION ALL SELECT step + 1, [CASE WHEN k = m.i THEN struct_pack(id := state[k].id, w := state[m.i].w + state[m.j].w, x := [(state[m.i].x[c] * state[m.i].w + state[m.j].x[c] * state[m.j].w) / (state[m.i].w + state[m.j].w) FOR c IN range(1, 5)]) ELSE state[k] END FOR k IN range(1, len(state) + 1) IF k <> m.j],
    state[m.i].id, state[m.j].id, m.h, CAST(state[m.i].w + state[m.j].w AS BIGINT)
  FROM (SELECT step, state, list_min(flatten([[struct_pack(h := sqrt(2 * state[i].w * state[j].w / (state[i].w + state[j].w)) * list_distance(state[i].x, state[j].x), i := i, j := j) FOR j IN range(i + 1, len(state) + 1)] FOR i IN range(1, len(state))])) AS m FROM s WHERE len(state) > 1)),
m AS (SELECT a, b, height, size FROM s WHERE a IS NOT NULL)"""


def _merges(v):
    return v.once("ward", lambda: hierarchy.ward_merges(_points(v)))


@query(f"WITH RECURSIVE {_WARD} SELECT a, b, round(height, 5) AS height, size FROM m")
def supplier_hierarchy(v):
    return doubles(_merges(v), "height", digits=5)


@query(f"""WITH RECURSIVE {_WARD}, k AS (SELECT a, b FROM (SELECT a, b, row_number() OVER (ORDER BY height DESC, size DESC, a, b) AS r FROM m) WHERE r > 4),
u(id, up) AS (SELECT id, id FROM p UNION ALL SELECT u.id, k.a FROM u JOIN k ON k.b = u.up)
SELECT id, up AS cluster_id FROM u WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.b = u.up)""")
def supplier_groups(v):
    return hierarchy.cut(_points(v), _merges(v), 5)


_TREE = f"""{_POINTS}, d AS (SELECT a.id AS a, b.id AS b, list_distance(a.x, b.x) AS d FROM p a, p b WHERE a.id <> b.id),
c AS (SELECT a AS id, max(d) AS core FROM (SELECT a, d, row_number() OVER (PARTITION BY a ORDER BY d, b) AS r FROM d) WHERE r <= 3 GROUP BY a),
m AS (SELECT a, b, greatest(d, x.core, y.core) AS w FROM d JOIN c x ON x.id = a JOIN c y ON y.id = b),
t(seen, e) AS (SELECT [min(id)], NULL::STRUCT(w DOUBLE, lo VARCHAR, hi VARCHAR) FROM p
  UNION ALL SELECT CASE WHEN list_contains(seen, e.lo) THEN list_append(seen, e.hi) ELSE list_append(seen, e.lo) END, e
  FROM (SELECT seen, min(struct_pack(w := m.w, lo := least(m.a, m.b), hi := greatest(m.a, m.b))) AS e FROM t JOIN m ON list_contains(t.seen, m.a) AND NOT list_contains(t.seen, m.b) GROUP BY seen))"""


@query(f"WITH RECURSIVE {_TREE} SELECT e.lo AS a, e.hi AS b, round(e.w, 5) AS weight FROM t WHERE e IS NOT NULL")
def supplier_density_tree(v):
    return doubles(density.reachability_tree(_points(v), 3), "weight", digits=5)


@query()
def supplier_density(v):
    """No SQL: a condensed hierarchy; tests hold it against a plain version."""
    return density.density_hierarchy(_points(v), 3)


_BAND, _RADIUS = 2, 4.0
_SERIES = "s AS (SELECT id, list(value ORDER BY month) AS x FROM :supplier_seasons: GROUP BY id)"
_CELL = f"CASE WHEN abs(i[1] - j[1]) <= {_BAND} THEN pow(a.x[i[1]] - b.x[j[1]], 2) + least(d[j[1]], d[j[1] + 1], r[j[1]]) ELSE 'infinity'::DOUBLE END"
_ROWS = f"list_reduce(list_prepend(list_prepend(0.0::DOUBLE, ['infinity'::DOUBLE FOR k IN range(len(b.x))]), [[k::DOUBLE] FOR k IN range(1, len(a.x) + 1)]), lambda d, i: list_reduce(list_prepend(['infinity'::DOUBLE], [[k::DOUBLE] FOR k IN range(1, len(b.x) + 1)]), lambda r, j: list_append(r, {_CELL.replace('[i[1]]', '[i[1]::INT]').replace('[j[1]]', '[j[1]::INT]').replace('[j[1] + 1]', '[j[1]::INT + 1]')})))"


@query(f"WITH {_SERIES}, w AS (SELECT a.id AS a, b.id AS b, {_ROWS}[-1] AS total FROM s a JOIN s b ON a.id < b.id AND abs(len(a.x) - len(b.x)) <= {_BAND}) SELECT a, b, round(sqrt(total), 5) AS distance FROM w WHERE sqrt(total) <= {_RADIUS}")
def similar_seasons(v):
    series = elastic.series_of(v("supplier_seasons"), "id", "month")
    return doubles(elastic.similar_shapes(series, _RADIUS, _BAND), "distance", digits=5)


@query()
def season_medoids(v):
    """No SQL: medoids are found step by step; tests hold them against all members."""
    return doubles(elastic.shape_medoids(elastic.series_of(v("supplier_seasons"), "id", "month"), 3, 12), "distance")
