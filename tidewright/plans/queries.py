"""Named queries: each applies an operator to a binding, beside the SQL that says the same."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewright.functions import codes, text
from tidewright.operators import asof, cdc, gold, joins, profile, quality, reports, sample, series
from tidewright.plans import catalog, following, ledgers, shapes, silver  # noqa: F401 (register their queries)
from tidewright.plans.registry import ORACLES, QUERIES, doubles, longs, query  # noqa: F401

TEU_SQL = "CASE upper(substr(trim(size_code), 1, 1)) WHEN '1' THEN 0.5 WHEN '2' THEN 1.0 WHEN '3' THEN 1.5 WHEN '4' THEN 2.0 WHEN 'L' THEN 2.25 END"
#: The day that dates are judged from; what may count is from 2000-01-01 to 180 days after it.
ANCHOR = dt.date(2006, 1, 1)
GATE_ANCHOR = dt.date(2024, 6, 1)
_GATE_DAILY = f"""m AS (SELECT coalesce(direction, '') AS direction, CASE type WHEN 'GATE_IN' THEN 'IN' ELSE 'OUT' END AS kind, upper(trim(container_no)) AS container_no, trim(CASE type WHEN 'GATE_IN' THEN in_time ELSE out_time END) AS raw, {TEU_SQL} AS teu
  FROM :gate_raw: g WHERE trim(container_no) <> '' AND NOT EXISTS (SELECT 1 FROM :quarantined: q WHERE q.vesselcode = g.vesselcode AND q.voyage = g.voyage)),
t AS (SELECT *, CASE WHEN substr(raw, 5, 1) = '-' THEN substr(raw, 1, 10) WHEN length(raw) >= 8 THEN substr(raw, 1, 4) || '-' || substr(raw, 5, 2) || '-' || substr(raw, 7, 2) END AS day FROM m WHERE raw <> ''),
o AS (SELECT CAST(day AS DATE) AS flow_date, direction, kind, container_no, max(teu) AS teu FROM t WHERE day BETWEEN '2000-01-01' AND '2024-11-28' GROUP BY ALL),
gd AS (SELECT flow_date, direction, count(*) FILTER (kind = 'IN') AS in_count, count(*) FILTER (kind = 'OUT') AS out_count, count(DISTINCT container_no) AS unique_containers,
  CAST(coalesce(sum(teu) FILTER (kind = 'IN'), 0) AS DOUBLE) AS in_teu, CAST(coalesce(sum(teu) FILTER (kind = 'OUT'), 0) AS DOUBLE) AS out_teu,
  count(*) FILTER (kind = 'IN' AND teu IS NOT NULL) AS in_teu_known, count(*) FILTER (kind = 'OUT' AND teu IS NOT NULL) AS out_teu_known FROM o GROUP BY flow_date, direction)"""


@query(f"WITH {_GATE_DAILY} SELECT * FROM gd")
def gate_daily(v):
    return gold.gate_daily(v("gate_raw"), v("quarantined"), GATE_ANCHOR)


@query(f"WITH {_GATE_DAILY} SELECT round(CAST(sum(in_teu_known + out_teu_known) AS DOUBLE) / sum(in_count + out_count), 6) AS coverage, min(flow_date) AS first_date, max(flow_date) AS last_date FROM gd")
def gate_teu_coverage(v):
    return doubles(gold.gate_coverage(gate_daily(v)), "coverage")


_FLOW = """f AS (
  SELECT flow_date, terminal, direction, '' AS route, '' AS cargo_group, '' AS operator, 1 AS vgm_count, weight_kg AS vgm_weight_kg, 0 AS release_count, 0 AS release_weight, 0 AS release_weight_kg, 0 AS release_volume, 0 AS release_pieces, 0 AS transship_count, 0 AS transship_weight, 0 AS transship_volume, 0 AS planned_calls, 0 AS actual_calls, NULL::DOUBLE AS ad, NULL::DOUBLE AS dd FROM :vgm:
  UNION ALL SELECT flow_date, terminal, direction, '', '', operator, 0, 0, CASE WHEN trim(bill_no) <> '' THEN 1 ELSE 0 END, weight, weight_kg, volume, pieces, 0, 0, 0, 0, 0, NULL, NULL FROM :release:
  UNION ALL SELECT flow_date, terminal, '', route, coalesce(cargo_group, 'UNKNOWN'), '', 0, 0, 0, 0, 0, 0, 0, 1, weight, volume, 0, 0, NULL, NULL FROM :transship:
  UNION ALL SELECT flow_date, terminal, direction, '', '', '', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, CASE WHEN arrived THEN 1 ELSE 0 END, CASE WHEN arrival_delay_h BETWEEN 0 AND 720 THEN arrival_delay_h END, CASE WHEN departure_delay_h BETWEEN 0 AND 720 THEN departure_delay_h END
    FROM (SELECT *, row_number() OVER (PARTITION BY vessel_code, voyage, terminal, direction ORDER BY snapshot_time DESC, t1 DESC, t2 DESC, t3 DESC, t4 DESC) AS r FROM :plans:) WHERE r = 1),
d AS (SELECT flow_date, terminal, direction, route, cargo_group, operator, sum(vgm_count) AS vgm_count, coalesce(sum(vgm_weight_kg), 0) AS vgm_weight_kg, sum(release_count) AS release_count, coalesce(sum(release_weight), 0) AS release_weight,
  coalesce(sum(release_weight_kg), 0) AS release_weight_kg, coalesce(sum(release_volume), 0) AS release_volume, coalesce(sum(release_pieces), 0) AS release_pieces, sum(transship_count) AS transship_count, coalesce(sum(transship_weight), 0) AS transship_weight, coalesce(sum(transship_volume), 0) AS transship_volume,
  sum(planned_calls) AS planned_calls, sum(actual_calls) AS actual_calls, avg(ad) AS avg_arrival_delay, avg(dd) AS avg_departure_delay FROM f WHERE flow_date BETWEEN DATE '2000-01-01' AND DATE '2006-06-30' GROUP BY ALL)"""
_COUNTS = ["vgm_count", "release_count", "transship_count", "planned_calls", "actual_calls"]
_MEASURES = ["vgm_weight_kg", "release_weight", "release_weight_kg", "release_volume", "release_pieces", "transship_weight", "transship_volume"]
_DELAYS = ["avg_arrival_delay", "avg_departure_delay"]
_FLOW_OUT = ", ".join([*[f"CAST({c} AS BIGINT) AS {c}" for c in _COUNTS], *[f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in (*_MEASURES, *_DELAYS)]])


def _daily(v):
    return gold.daily_flow(v("vgm"), v("release"), v("transship"), gold.latest_plans(v("plans"), ["t1", "t2", "t3", "t4"]), ANCHOR)


@query(f"WITH {_FLOW} SELECT flow_date, terminal, direction, route, cargo_group, operator, {_FLOW_OUT} FROM d")
def flow_daily(v):
    return longs(doubles(_daily(v), *_MEASURES, *_DELAYS), *_COUNTS)


def _gold_daily(v):
    """The daily aggregate as a table: weekly sums, curves and the index read it."""
    return v.stored("gold_daily", lambda: _daily(v))


_WEEK = f"""w AS (SELECT CAST(date_trunc('week', flow_date) AS DATE) AS week_start, terminal, direction, route, cargo_group, operator, {", ".join(f"sum({c}) AS {c}" for c in [*_COUNTS, *_MEASURES])}, {", ".join(f"avg({c}) AS {c}" for c in _DELAYS)} FROM d GROUP BY ALL)"""


@query(f"""WITH {_FLOW}, {_WEEK}
SELECT week_start, terminal, direction, route, cargo_group, operator, {_FLOW_OUT} FROM w""")
def flow_weekly(v):
    return longs(doubles(gold.weekly_flow(_gold_daily(v)), *_MEASURES, *_DELAYS), *_COUNTS)


@query("""SELECT terminal, count(*) AS revisions, min(CAST(snapshot_time AS DATE)) AS first_revision FROM (SELECT *, lag(record_hash) OVER (PARTITION BY vessel_code, voyage, terminal, direction ORDER BY snapshot_time, t1, t2, t3, t4) AS b FROM :plans:)
WHERE b IS NOT NULL AND b <> record_hash GROUP BY terminal""")
def plan_revisions(v):
    points = series.revision_points(v("plans"), ["t1", "t2", "t3", "t4"])
    return points.groupBy("terminal").agg(F.count("*").alias("revisions"), F.min("flow_date").alias("first_revision"))


CUTOFF = dt.datetime(1998, 6, 30, 23, 59, 59)
_AS_OF = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY observed_at DESC, version_id DESC, quantity DESC, price DESC) AS r FROM :versions: WHERE observed_at <= TIMESTAMP '1998-06-30 23:59:59') WHERE r = 1)"


def _as_of(v):
    return asof.as_of(v("versions"), ["l_orderkey", "l_linenumber"], CUTOFF, order=["version_id", "quantity", "price"])


@query(f"SELECT l_orderkey, l_linenumber, observed_at, version_id, CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price FROM {_AS_OF}")
def versions_as_of(v):
    return doubles(_as_of(v).select("l_orderkey", "l_linenumber", "observed_at", "version_id", "quantity", "price"), "quantity", "price")


@query(f"SELECT CAST(observed_at AS DATE) AS flow_date, terminal, direction, count(*) AS vgm_count, CAST(sum(quantity) AS DOUBLE) AS vgm_weight_kg FROM {_AS_OF} GROUP BY ALL")
def vgm_daily_as_of(v):
    rows = _as_of(v).select(F.to_date("observed_at").alias("flow_date"), "terminal", "direction", "quantity")
    return doubles(rows.groupBy("flow_date", "terminal", "direction").agg(F.count("*").alias("vgm_count"), F.sum("quantity").alias("vgm_weight_kg")), "vgm_weight_kg")


@query("""SELECT 'orders' AS input_name, count(*) AS n, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id, CAST(sum(o_orderkey) AS BIGINT) AS sum_id, CAST(sum(CAST(epoch(o_orderdate) AS BIGINT)) AS BIGINT) AS sum_seconds, max(o_orderdate) AS max_time FROM orders""")
def input_fingerprint(v):
    return asof.fingerprint(v("orders"), "orders", "o_orderkey", "o_orderdate")


_WORDS = ", ".join(f"CAST(sum(CAST(CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS HUGEINT)) AS STRING)" for i in range(8))


@query(f"""WITH h AS (SELECT sha256(concat_ws(chr(31), CAST(o_orderkey AS STRING), CAST(o_custkey AS STRING), o_orderstatus, o_orderpriority)) AS h FROM orders) SELECT sha256(concat_ws(',', CAST(count(*) AS STRING), {_WORDS})) AS digest FROM h""")
def strict_fingerprint(v):
    return asof.strict_digest(v("orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


_FIELDS = ["status", "customer", "priority", "compare_time"]
_CDC = f"""c AS (SELECT n.id, CASE WHEN o.id IS NULL THEN 'new' WHEN {" AND ".join(f"n.{f} = o.{f}" for f in _FIELDS)} THEN 'unchanged' WHEN {" AND ".join(f"n.{f} = o.{f}" for f in _FIELDS[:3])} THEN 'touched' ELSE 'updated' END AS change_type,
  {", ".join(f"o.{f} AS o_{f}, n.{f} AS n_{f}" for f in _FIELDS)} FROM :incoming: n LEFT JOIN :current: o ON n.id = o.id),
l AS ({" UNION ALL ".join(f"SELECT id, change_type, '{f}' AS field, o_{f} AS old_value, n_{f} AS new_value FROM c WHERE change_type IN ('touched', 'updated') AND o_{f} <> n_{f}" for f in _FIELDS)})"""


def _changes(v):
    return cdc.capture_changes(v("current"), v("incoming"), "id", _FIELDS, touch=("compare_time",))


@query(f"WITH {_CDC} SELECT id, change_type FROM c")
def change_capture(v):
    return _changes(v).select("id", "change_type")


@query(f"WITH {_CDC} SELECT count(*) AS seen, count(*) FILTER (change_type = 'new') AS \"new\", count(*) FILTER (change_type = 'updated') AS updated, count(*) FILTER (change_type = 'touched') AS touched, count(*) FILTER (change_type = 'unchanged') AS unchanged, count(*) FILTER (change_type = 'skipped') AS skipped FROM c")
def change_counters(v):
    return cdc.run_counters(_changes(v))


@query(f"WITH {_CDC} SELECT id, field, old_value, new_value FROM l")
def change_log_long(v):
    from tidewright.sources.sinks import long_changes

    return long_changes(_changes(v).filter("changed_fields is not null").withColumn("changed_at", F.lit(None))).drop("changed_at")


@query(f"WITH {_CDC}, k AS (SELECT id, count(*) AS k FROM l GROUP BY id) SELECT field, count(*) AS changes, count(*) FILTER (k = 1) AS rows_only FROM l JOIN k USING (id) GROUP BY field")
def change_fields(v):
    return profile.field_changes(_changes(v).filter("changed_fields is not null"))


@query(f"WITH {_CDC} SELECT field, old_value, new_value, count(*) AS n FROM l WHERE field IN ('status', 'priority') GROUP BY ALL")
def change_transitions(v):
    return profile.transitions(_changes(v).filter("changed_fields is not null"), ["status", "priority"])


@query("""SELECT coalesce(n.id, o.id) AS id, coalesce(n.status, o.status) AS status, coalesce(n.customer, o.customer) AS customer, coalesce(n.priority, o.priority) AS priority, coalesce(n.compare_time, o.compare_time) AS compare_time FROM :current: o FULL JOIN :incoming: n ON n.id = o.id""")
def upserted_snapshot(v):
    return cdc.upsert(v("current"), v("incoming"), "id")


@query("""SELECT l_orderkey, l_linenumber, observed_at, version_id FROM (SELECT *, lag(quantity) OVER w AS b FROM :versions: WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY observed_at, version_id, quantity, price)) WHERE b IS NULL OR b <> quantity""")
def version_appends(v):
    return cdc.new_versions(v("versions"), ["l_orderkey", "l_linenumber"], "quantity", ["observed_at", "version_id", "quantity", "price"]).select("l_orderkey", "l_linenumber", "observed_at", "version_id")


@query("SELECT changes, count(*) AS ids FROM (SELECT l_orderkey, count(*) AS changes FROM lineitem GROUP BY l_orderkey) GROUP BY changes")
def versions_per_key(v):
    return profile.change_histogram(v("lineitem"), "l_orderkey")


@query("SELECT n.id FROM :incoming: n WHERE NOT EXISTS (SELECT 1 FROM :current: o WHERE o.id = n.id)")
def events_to_append(v):
    return cdc.append_new(v("current"), v("incoming"), "id", _FIELDS)[0].select("id")


@query("SELECT n.id FROM :incoming: n JOIN :current: o ON o.id = n.id WHERE n.status <> o.status OR n.customer <> o.customer OR n.priority <> o.priority OR n.compare_time <> o.compare_time")
def append_conflicts(v):
    return cdc.append_new(v("current"), v("incoming"), "id", _FIELDS)[1]


@query("""SELECT c_nationkey, close_at, c_custkey, n - 1 AS duplicates FROM (SELECT c_nationkey, c_custkey, close_at, count(*) OVER (PARTITION BY c_nationkey) AS n, row_number() OVER (PARTITION BY c_nationkey ORDER BY close_at IS NULL, close_at DESC, c_custkey DESC) AS r
FROM (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS close_at FROM customer)) WHERE r = 1""")
def best_duplicates(v):
    rows = v("customer").select("c_nationkey", "c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("close_at"))
    return cdc.best_of_batch(rows, ["c_nationkey"], "close_at", "c_custkey")


@query("SELECT l_suppkey, max(struct_pack(a := l_shipdate, b := l_returnflag)).b AS name, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen FROM lineitem GROUP BY l_suppkey")
def vessel_dimension(v):
    return cdc.dimension(v("lineitem").withColumnRenamed("l_returnflag", "name"), "l_suppkey", ["name"], "l_shipdate")


@query("""SELECT l_suppkey, max(struct_pack(a := l_shipdate, b := l_linestatus)).b AS status, count(*) AS attempts, max(CASE WHEN l_quantity > 40 THEN struct_pack(a := l_shipdate, b := l_returnflag) END).b AS last_error, CAST(min(CASE WHEN l_quantity < 20 THEN struct_pack(a := l_shipdate, b := l_quantity) END).b AS DOUBLE) AS total FROM lineitem GROUP BY l_suppkey""")
def work_states(v):
    rows = v("lineitem").select("l_suppkey", F.col("l_shipdate").alias("at"), F.col("l_linestatus").alias("status"), F.when(F.col("l_quantity") > 40, F.col("l_returnflag")).alias("error"), F.when(F.col("l_quantity") < 20, F.col("l_quantity")).alias("total"))
    return cdc.work_status(rows, ["l_suppkey"])


@query("SELECT entity_key, time_bucket, value, quality_flag FROM (SELECT *, max(time_bucket) OVER (PARTITION BY entity_key) AS m FROM :curves:) WHERE datediff('day', time_bucket, m) < 364")
def curves_weekly(v):
    return series.recent_buckets(v("curves"), 52).select("entity_key", "time_bucket", "value", "quality_flag")


@query("SELECT time_bucket, sum(value) AS value FROM :curves: WHERE curve_type = 'orders' GROUP BY time_bucket")
def curves_rolled_up(v):
    return series.rollup_curves(v("curves"), "orders")


_W = "PARTITION BY entity_key ORDER BY time_bucket"


@query(f"""SELECT entity_key, time_bucket, CAST(datediff('day', min(time_bucket) OVER p, max(time_bucket) OVER p) / 7 AS BIGINT) + 1 AS expected, count(*) OVER p AS observed,
  round(avg(value) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 4) AS moving_avg, round(CASE WHEN stddev_pop(value) OVER p > 0 THEN (value - avg(value) OVER p) / stddev_pop(value) OVER p ELSE 0 END, 6) AS z
FROM :curves: WINDOW p AS (PARTITION BY entity_key)""")
def curve_statistics(v):
    out = series.with_zscore(series.with_moving_average(series.with_completeness(v("curves"), 7)))
    return doubles(doubles(out.select("entity_key", "time_bucket", "expected", "observed", "moving_avg", "z"), "z"), "moving_avg", digits=4)


_REVISIONS = """(SELECT CAST(snapshot_time AS DATE) AS day, terminal FROM (SELECT *, lag(record_hash) OVER (PARTITION BY vessel_code, voyage, terminal, direction ORDER BY snapshot_time, t1, t2, t3, t4) AS b FROM :plans:) WHERE b IS NOT NULL AND b <> record_hash)"""
_UNNEST = ", ".join(f"struct_pack(t := '{t}', x := CAST({c} AS DOUBLE), k := '{k}')" for k, m in (("sum", series.SUM_CURVES), ("mean", series.MEAN_CURVES)) for t, c in m.items())
_MELT = f"""WITH {_FLOW}, {_WEEK}, {_GATE_DAILY}, mm AS (
  SELECT CASE trim(terminal) WHEN '' THEN 'UNKNOWN' ELSE trim(terminal) END || ':' || direction AS entity_key, week_start AS time_bucket, unnest([{_UNNEST}]) AS u FROM w
  UNION ALL SELECT 'ALL_GATE_TERMINALS:' || direction, CAST(date_trunc('week', flow_date) AS DATE), unnest([{", ".join(f"struct_pack(t := '{t}', x := CAST({c} AS DOUBLE), k := 'sum')" for t, c in series.GATE_CURVES.items())}]) FROM gd
  UNION ALL SELECT terminal || ':', CAST(date_trunc('week', day) AS DATE), struct_pack(t := 'plan_revision', x := CAST(1 AS DOUBLE), k := 'sum') FROM {_REVISIONS}),
c AS (SELECT u.t AS curve_type, entity_key, time_bucket, CASE max(u.k) WHEN 'mean' THEN avg(u.x) ELSE sum(u.x) END AS value FROM mm WHERE u.x IS NOT NULL GROUP BY ALL)"""


def _gold_curves(v):
    revisions = series.revision_points(v("plans"), ["t1", "t2", "t3", "t4"])
    gate = v.stored("gold_gate_daily", lambda: gate_daily(v))
    return series.build_curves(gold.weekly_flow(_gold_daily(v)), "week_start", "week", "v1", gate, revisions)


@query(f"{_MELT} SELECT curve_type, entity_key, time_bucket, round(value, 4) AS value FROM c")
def curves_from_gold(v):
    return doubles(_gold_curves(v).select("curve_type", "entity_key", "time_bucket", "value"), "value", digits=4)


_PRESSURE = " ".join(f"WHEN '{k}' THEN {w}" for k, w in series.PRESSURE_WEIGHTS.items() if k != "plan_revision")


@query(f"""{_MELT}, z AS (SELECT *, CASE WHEN stddev_pop(value) OVER p > 0 THEN (value - avg(value) OVER p) / stddev_pop(value) OVER p ELSE 0 END AS z, CASE curve_type {_PRESSURE} END AS w FROM c WINDOW p AS (PARTITION BY curve_type, entity_key))
SELECT entity_key, time_bucket, round(CAST(sum(w * z) / sum(w) AS DOUBLE), 5) AS value, round(CAST(sum(w * z) FILTER (curve_type = 'vgm') / sum(w) AS DOUBLE), 5) AS vgm_part, count(*) AS parts FROM z WHERE w IS NOT NULL GROUP BY entity_key, time_bucket""")
def pressure(v):
    out = series.pressure_index(series.with_zscore(_gold_curves(v)))
    return doubles(out.select("entity_key", "time_bucket", "value", F.col("contributions")["vgm"].alias("vgm_part"), F.cardinality("contributions").cast("bigint").alias("parts")), "value", "vgm_part", digits=5)


@query(f"""WITH s AS (SELECT entity_key, time_bucket, count(*) OVER p AS n, row_number() OVER ({_W}) - 1 AS i, sum(value::DECIMAL(28, 6)) OVER p AS t, stddev_pop(value) OVER p AS sd, sum(value::DECIMAL(28, 6)) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM :curves: WINDOW p AS (PARTITION BY entity_key)),
x AS (SELECT entity_key, time_bucket, CAST(b AS DOUBLE) / i AS before_mean, CAST(t - b AS DOUBLE) / (n - i) AS after_mean, sd FROM s WHERE n >= 5 AND i >= 2 AND i <= n - 3)
SELECT entity_key, time_bucket, round(before_mean, 4) AS before_mean, round(after_mean, 4) AS after_mean, round(abs(after_mean - before_mean) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS score FROM x WHERE abs(after_mean - before_mean) / CASE WHEN sd = 0 THEN 1 ELSE sd END >= 0.3""")
def curve_change_points(v):
    out = series.change_points(v("curves"), 0.3).select("entity_key", "time_bucket", "before_mean", "after_mean", "score")
    return doubles(doubles(out, "score"), "before_mean", "after_mean", digits=4)


@query("""SELECT entity_key, time_bucket, value, round(score, 6) AS score FROM (SELECT entity_key, time_bucket, value, count(*) OVER p AS n, abs(value - avg(value) OVER p) / nullif(stddev_pop(value) OVER p, 0) AS score FROM :curves: WINDOW p AS (PARTITION BY entity_key)) WHERE n >= 3 AND score >= 2""")
def curve_anomalies(v):
    return doubles(series.anomalies(v("curves"), 2.0).select("entity_key", "time_bucket", "value", "score"), "score")


@query(f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY time_bucket DESC) AS r, {", ".join(f"(value - lag(value, {k}) OVER w) / nullif(abs(lag(value, {k}) OVER w), 0) AS g{k}" for k in (1, 4, 13))} FROM :curves: WINDOW w AS ({_W})),
a AS (SELECT entity_key, max(time_bucket) AS time_bucket, max(value) FILTER (r = 1) AS value, {", ".join(f"max(g{k}) FILTER (r = 1) AS g{k}" for k in (1, 4, 13))}, stddev_pop(value) FILTER (r <= 13) AS volatility, avg(value) AS m, avg(CASE quality_flag WHEN 'complete' THEN 1.0 ELSE 0.5 END) AS q FROM s GROUP BY entity_key)
SELECT entity_key, time_bucket, value, round(g1, 6) AS g1, round(g4, 6) AS g4, round(g13, 6) AS g13, round(volatility, 4) AS volatility, round(q, 6) AS data_quality,
  CASE WHEN q < 0.8 THEN 'data_insufficient' WHEN g4 > 0.1 THEN 'growth' WHEN g4 < -0.1 THEN 'decline' WHEN m <> 0 AND volatility > abs(m) THEN 'high_volatility' ELSE 'stable' END AS state FROM a""")
def curve_trends(v):
    out = series.trends(v("curves")).drop("curve_type", "granularity", "model_version")
    return doubles(doubles(out, "g1", "g4", "g13", "data_quality"), "volatility", digits=4)


def _correlation(lagged: str) -> str:
    pairs = f"FILTER ({lagged} IS NOT NULL)"
    return f"round(CASE WHEN count({lagged}) > 1 THEN coalesce(covar_pop({lagged}, value) {pairs} / nullif(stddev_pop({lagged}) {pairs} * stddev_pop(value) {pairs}, 0), 0) END, 5)"


@query(f"""WITH s AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY entity_key) AS n, lag(value) OVER w AS l1, CASE WHEN count(*) OVER (PARTITION BY entity_key) < 14 THEN lag(value, 4) OVER w ELSE lag(value, 7) OVER w END AS ls,
  (value - lag(value, 4) OVER w) / nullif(abs(lag(value, 4) OVER w), 0) AS g4, (value - lag(value, 13) OVER w) / nullif(abs(lag(value, 13) OVER w), 0) AS g13 FROM :curves: WINDOW w AS ({_W}))
SELECT entity_key, count(*) AS n, round(avg(value), 4) AS mean, round(median(value), 4) AS median, round(stddev_pop(value), 4) AS sd, round(coalesce(stddev_pop(value) / nullif(abs(avg(value)), 0), 0), 5) AS cv, round(covar_pop(i, value) / nullif(var_pop(i), 0), 4) AS slope,
  round(max(g4) FILTER (i = n - 1), 6) AS growth_4, round(max(g13) FILTER (i = n - 1), 6) AS growth_13, round(avg(CASE WHEN value = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_ratio, {_correlation("l1")} AS autocorr_1, {_correlation("ls")} AS autocorr_seasonal, round(max(value) / median(value), 5) AS peak_ratio,
  CAST(NULL AS DOUBLE) AS arrival_delay_mean, CAST(NULL AS DOUBLE) AS arrival_delay_p90, CAST(0 AS DOUBLE) AS transshipment_share, CAST(0 AS DOUBLE) AS seasonal_strength, CAST(0 AS DOUBLE) AS plan_revision_frequency FROM s GROUP BY entity_key""")
def curve_features(v):
    out = series.features(v("curves")).drop("curve_type", "granularity", "model_version")
    return doubles(doubles(doubles(out, "growth_4", "growth_13", "zero_ratio"), "autocorr_1", "autocorr_seasonal", "peak_ratio", "cv", digits=5), "mean", "median", "sd", "slope", digits=4)


@query("SELECT terminal, round(avg(arrival_delay_h), 6) AS delay_mean, quantile_disc(arrival_delay_h, 0.9) AS delay_p90 FROM :plans: GROUP BY terminal")
def plan_delays(v):
    return doubles(series.delay_profile(v("plans"), "terminal", "arrival_delay_h"), "delay_mean")


@query("SELECT entity_key, time_bucket, value FROM :curves: WHERE entity_key IN (SELECT entity_key FROM :curves: GROUP BY entity_key ORDER BY sum(value) DESC, entity_key LIMIT 8)")
def top_curves(v):
    return series.top_entities(v("curves"), "orders", 8).select("entity_key", "time_bucket", "value")


@query("SELECT entity_key, round(avg(value), 4) AS latest_avg FROM (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY time_bucket DESC) AS r FROM :curves:) WHERE r <= 4 GROUP BY entity_key")
def latest_cards(v):
    return doubles(series.latest_average(v("curves")).select("entity_key", "latest_avg"), "latest_avg", digits=4)


_COLS = ["c_name", "c_mktsegment", "c_nationkey"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS name, count(*) AS n, count(*) FILTER (trim(CAST({c} AS STRING)) <> '') AS filled, count(DISTINCT {c}) AS distinct_values, 'used' AS status FROM customer" for c in _COLS))
def column_profile(v):
    return profile.columns(v("customer"), _COLS).drop("fill_rate")


@query(" UNION ALL ".join(f"(SELECT '{c}' AS name, CAST({c} AS STRING) AS value, count(*) AS n FROM customer GROUP BY {c} ORDER BY n DESC, CAST({c} AS STRING) LIMIT 2)" for c in _COLS))
def frequent_values(v):
    return profile.top_values(v("customer"), _COLS)


@query("""SELECT 'l_orderkey' AS columns, count(DISTINCT l_orderkey) AS distinct_keys, count(*) AS n FROM lineitem UNION ALL SELECT 'l_orderkey,l_linenumber', count(DISTINCT (l_orderkey, l_linenumber)), count(*) FROM lineitem UNION ALL SELECT 'l_orderkey,l_linenumber,l_partkey', count(DISTINCT (l_orderkey, l_linenumber, l_partkey)), count(*) FROM lineitem""")
def key_cardinality(v):
    return profile.key_prefixes(v("lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"])


@query(" UNION ALL ".join(f"SELECT '{c}' AS name, count(*) FILTER (d > 1) AS violating_groups FROM (SELECT count(DISTINCT {c}) AS d FROM lineitem GROUP BY l_orderkey)" for c in ("l_suppkey", "l_returnflag", "l_linestatus")))
def functional_dependencies(v):
    return profile.dependency_violations(v("lineitem"), ["l_orderkey"], ["l_suppkey", "l_returnflag", "l_linestatus"])


@query("""WITH a AS (SELECT *, (epoch(max(o_orderdate) OVER ()) - epoch(o_orderdate)) / 3600 AS h FROM orders)
SELECT CAST(CASE WHEN h < 24 THEN 0 WHEN h < 168 THEN 1 WHEN h < 720 THEN 2 WHEN h < 8760 THEN 3 ELSE 4 END AS INT) AS age_bucket, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice > 200000) AS large FROM a GROUP BY 1""")
def order_lifecycle(v):
    return profile.lifecycle(v("orders"), "o_orderdate", [24, 168, 720, 8760], {"finished": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 200000})


@query("""SELECT 'discount_below_tax' AS rule, count(*) FILTER (NOT l_discount <= l_tax) AS counter_examples, count(*) AS n FROM lineitem UNION ALL SELECT 'returned_is_final', count(*) FILTER (NOT (l_returnflag <> 'R' OR l_linestatus = 'F')), count(*) FROM lineitem""")
def invariant_counts(v):
    return profile.invariants(v("lineitem"), {"discount_below_tax": F.col("l_discount") <= F.col("l_tax"), "returned_is_final": (F.col("l_returnflag") != "R") | (F.col("l_linestatus") == "F")})


@query("""WITH p AS (SELECT count(*) AS n, count(*) FILTER (l_linestatus = 'F') AS r, count(DISTINCT l_suppkey) > 1 AS a, count(DISTINCT l_returnflag) > 1 AS b FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) = 2)
SELECT 'l_suppkey' AS name, count(*) FILTER (a) AS differing, count(*) AS pairs, count(*) FILTER (r = 1) AS one_received FROM p UNION ALL SELECT 'l_returnflag', count(*) FILTER (b), count(*), count(*) FILTER (r = 1) FROM p""")
def pair_analysis(v):
    return profile.pair_differences(v("lineitem"), ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_returnflag"], F.col("l_linestatus") == "F")


_CODE = "'CSQU' || lpad(CAST({0} % 10000000 AS STRING), 7, '0')"


@query(f"""WITH c AS (SELECT c_custkey, {_CODE.format("(c_custkey * 3054383)")} AS code FROM customer)
SELECT c_custkey, code, (13 * 1 + 30 * 2 + 28 * 4 + 32 * 8 + {" + ".join(f"CAST(substr(code, {i + 5}, 1) AS INT) * {2 ** (i + 4)}" for i in range(6))}) % 11 % 10 = CAST(substr(code, 11, 1) AS INT) AS valid FROM c""")
def container_check(v):
    rows = v("customer").select("c_custkey", F.concat(F.lit("CSQU"), F.lpad(((F.col("c_custkey") * 3054383) % 10000000).cast("string"), 7, "0")).alias("code"))
    return rows.withColumn("valid", codes.iso6346_valid(F.col("code")))


@query("""SELECT p_partkey, CASE WHEN upper(p_name) = 'SMALL RING' THEN 'METAL' WHEN regexp_matches(p_name, '(?i)widget|gear') THEN 'MACHINERY' WHEN regexp_matches(p_name, '(?i)^red') THEN 'PAINT' ELSE 'UNKNOWN' END AS cargo_group,
  CASE WHEN upper(p_name) = 'SMALL RING' THEN 'exact' WHEN regexp_matches(p_name, '(?i)widget|gear|^red') THEN 'regex' ELSE 'unknown' END AS cargo_match FROM part""")
def cargo_groups(v):
    cargo = codes.classify_cargo(F.col("p_name"), {"small ring": "METAL"}, [("widget|gear", "MACHINERY"), ("^red", "PAINT")])
    return v("part").select("p_partkey", cargo["group"].alias("cargo_group"), cargo["match"].alias("cargo_match"))


@query("""SELECT s_suppkey, CASE WHEN s_nationkey % 5 = 0 THEN NULL WHEN upper(s_name) LIKE '%1' THEN 'TEST_SHIP' WHEN upper(s_name) LIKE 'SUPPLIER%' THEN 'TRANSSHIP_POOL' END AS bucket FROM supplier""")
def pseudo_vessels(v):
    imo = F.when(F.col("s_nationkey") % 5 == 0, F.lit("1234567"))
    return v("supplier").select("s_suppkey", codes.classify_vessel(F.lit(None).cast("string"), F.col("s_name"), F.lit(""), imo, F.lit(None).cast("string"), [("en", "%1", "TEST_SHIP"), ("en", "supplier%", "TRANSSHIP_POOL")]).alias("bucket"))


_PAIR = f"SELECT trim(vesselcode, '{text.WHITE_SPACE}') AS vesselcode, trim(voyage, '{text.WHITE_SPACE}') AS voyage, eta FROM :candidates:"
_REASON = f"""CASE WHEN vesselcode = '' THEN 'empty_vesselcode' WHEN upper(vesselcode) = 'FC0000000' OR translate(vesselcode, '0?/.· -_', '') = '' THEN 'placeholder_vesselcode' WHEN voyage = '' THEN 'empty_voyage'
  WHEN translate(voyage, '0?/.· -_', '') = '' THEN 'placeholder_voyage' WHEN regexp_matches(voyage, '[{text.WHITE_SPACE}]') THEN 'voyage_contains_whitespace' WHEN strlen(voyage) > length(voyage) THEN 'voyage_non_ascii' ELSE '' END"""


@query(f"""SELECT vesselcode, voyage, min(eta) AS first_eta, max(eta) AS last_eta, count(*) AS source_plan_rows, vesselcode IN (SELECT vesselcode FROM :catalog:) AS vessel_in_catalog FROM ({_PAIR}) c
WHERE {_REASON} = '' AND NOT EXISTS (SELECT 1 FROM :catalog: k WHERE k.vesselcode = c.vesselcode AND k.voyage = c.voyage) GROUP BY ALL""")
def voyage_candidates(v):
    good, _ = joins.discover_candidates(v("candidates"), v("catalog"), codes.invalid_pair_reason(F.col("vesselcode"), F.col("voyage")))
    return good.drop("vessel_en_name")


@query(f"SELECT DISTINCT vesselcode, voyage, {_REASON} AS reason FROM ({_PAIR}) WHERE reason <> ''")
def rejected_pairs(v):
    return joins.discover_candidates(v("candidates"), v("catalog"), codes.invalid_pair_reason(F.col("vesselcode"), F.col("voyage")))[1]


@query("""SELECT DISTINCT vesselcode, voyage FROM (SELECT vesselcode, voyage, strftime(eta, '%Y-%m') AS m, min(eta) AS a, max(eta) AS b FROM :candidates: GROUP BY ALL) WHERE b >= DATE '1998-03-10' AND a < DATE '1998-04-05'""")
def candidates_in_window(v):
    pairs = v("candidates").select("vesselcode", "voyage").distinct()
    return joins.in_eta_window(pairs, joins.month_evidence(v("candidates")), dt.date(1998, 3, 10), dt.date(1998, 4, 5))


_MATCH = "SELECT g.vesselcode, g.voyage, c.received IS NOT NULL AS matched FROM :gate: g LEFT JOIN (SELECT CAST(c_custkey AS STRING) AS container_no, c_mktsegment AS received FROM customer WHERE c_custkey % 3 <> 0) c USING (container_no)"


def _customs(v):
    return v("customer").select(F.col("c_custkey").cast("string").alias("container_no"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("received"))


@query(f"WITH m AS ({_MATCH}) SELECT count(*) FILTER (matched) AS matched, count(*) FILTER (NOT matched) AS gap, count(DISTINCT CASE WHEN NOT matched THEN (vesselcode, voyage) END) AS gap_pairs FROM m")
def gate_gap_summary(v):
    return joins.gap_summary(joins.match_gate_to_customs(v("gate"), _customs(v), ["container_no"], "received"), ("vesselcode", "voyage"))


@query("SELECT id FROM :gate: g WHERE NOT EXISTS (SELECT 1 FROM customer WHERE CAST(c_custkey AS STRING) = g.container_no AND c_custkey % 3 <> 0) AND NOT EXISTS (SELECT 1 FROM :quarantined: q WHERE q.vesselcode = g.vesselcode AND q.voyage = g.voyage)")
def gate_gap_rows(v):
    return joins.gate_gap(v("gate"), _customs(v), ["container_no"], "received", v("quarantined"), ("vesselcode", "voyage")).select("id")


@query("""SELECT container_no, 'gate_in' AS source, strptime(in_time, '%Y%m%d%H%M') AS event_time FROM :gate: WHERE type = 'GATE_IN' UNION ALL SELECT container_no, 'gate_out', strptime(out_time, '%Y%m%d%H%M') FROM :gate: WHERE type = 'GATE_OUT' UNION ALL SELECT CAST(o_custkey AS STRING), 'api', o_orderdate FROM orders""")
def movement_history(v):
    gate, api = v("gate"), v("orders").select(F.col("o_custkey").cast("string").alias("container_no"), "o_orderdate")
    return joins.all_movements((gate.filter("type = 'GATE_IN'"), "gate_in", text.parse_time(F.col("in_time"))), (gate.filter("type = 'GATE_OUT'"), "gate_out", text.parse_time(F.col("out_time"))), (api, "api", F.col("o_orderdate")))


@query("""SELECT container_no, event_time AS in_time, nt AS out_time, round((CAST(floor(epoch(nt)) AS BIGINT) - CAST(floor(epoch(event_time)) AS BIGINT)) / 3600.0, 6) AS hours FROM (SELECT *, lead(event_time) OVER w AS nt, lead(type) OVER w AS nk FROM :gate: WINDOW w AS (PARTITION BY container_no ORDER BY event_time, type)) WHERE type = 'GATE_IN' AND nk = 'GATE_OUT'""")
def dwell_times(v):
    return doubles(joins.dwell(v("gate"), ["container_no"], "type", "event_time"), "hours")


_AT = "coalesce(nullif(trim({0}), ''), nullif(trim({1}), ''), nullif(trim(received_time), ''))"


@query(f"""WITH e AS (SELECT upper(trim(container_no)) AS c, {_AT.format("in_time", "out_time")} AS a, {_AT.format("out_time", "in_time")} AS b FROM :gate_raw: g WHERE trim(container_no) <> '' AND NOT EXISTS (SELECT 1 FROM :quarantined: q WHERE q.vesselcode = g.vesselcode AND q.voyage = g.voyage)),
s AS (SELECT c, min(a) AS a, max(b) AS b, count(*) AS n FROM e GROUP BY c),
k AS (SELECT c, {" + ".join(f"{f} * 2 ** {i}" for i, f in enumerate([10, 12, 13, 32] + [f"CAST(substr(c, {i + 1}, 1) AS INT)" for i in range(4, 10)]))} AS total FROM s)
SELECT s.c AS container_no, a AS first_event, b AS last_event, n AS events, CAST(total AS BIGINT) % 11 % 10 = CAST(substr(s.c, 11, 1) AS BIGINT) AS valid, CASE WHEN CAST(total AS BIGINT) % 11 % 10 = CAST(substr(s.c, 11, 1) AS BIGINT) THEN 'pending' ELSE 'invalid' END AS status FROM s JOIN k USING (c)""")
def containers(v):
    return joins.container_catalog(v("gate_raw"), v("quarantined"))


@query("""SELECT year(o_orderdate) AS period, count(*) FILTER (o_orderstatus = 'F') AS complete, count(*) FILTER (o_orderstatus = 'O') AS pending, count(*) FILTER (o_orderstatus = 'P') AS error, round(count(*) FILTER (o_orderstatus = 'F')::DOUBLE / count(*), 6) AS completion FROM orders GROUP BY 1""")
def status_by_year(v):
    names = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "O", "pending").otherwise("error")
    return longs(doubles(joins.pivot_status(v("orders").withColumn("status", names), F.year("o_orderdate"), ["complete", "pending", "error"]), "completion"), "period")


@query("""SELECT s.vesselcode, s.voyage, CAST(CASE WHEN s.k % 2 = 0 THEN 0 ELSE 1 END AS INT) AS priority, direction FROM (SELECT 'UN' || CAST(s_suppkey AS STRING) AS vesselcode, CAST(s_nationkey % 20 AS STRING) AS voyage, s_suppkey AS k, unnest(['GATE_IN', 'GATE_OUT']) AS direction FROM supplier) s WHERE NOT (direction = 'GATE_IN' AND s.k % 3 = 0) AND NOT (direction = 'GATE_OUT' AND s.k % 5 = 0)""")
def pending_work(v):
    units = v("supplier").select(F.concat(F.lit("UN"), "s_suppkey").alias("vesselcode"), (F.col("s_nationkey") % 20).cast("string").alias("voyage"), F.when(F.col("s_suppkey") % 3 == 0, F.lit(1)).alias("in_done_at"), F.when(F.col("s_suppkey") % 5 == 0, F.lit(1)).alias("out_done_at"))
    return joins.pending_units(units, v("catalog"))


@query("SELECT endpoint, fingerprint, count(*) AS pages, count(*) - count(DISTINCT payload_hash) AS repeats, count(*) = count(DISTINCT payload_hash) AS passed FROM :page_log: GROUP BY ALL")
def page_repeats(v):
    return quality.repeated_pages(v("page_log")).drop("repeat_rate")


@query("""SELECT l_suppkey AS job, count(*) AS rows, count(*) FILTER (l_partkey % 10 <> l_suppkey % 10) AS "foreign" FROM lineitem GROUP BY l_suppkey""")
def attribution(v):
    rows = v("lineitem").select(F.col("l_suppkey").alias("job"), (F.col("l_suppkey") % 10).alias("asked"), (F.col("l_partkey") % 10).alias("answered"))
    return quality.misattributed(rows, "job", ["asked"], ["answered"])


@query("""SELECT o_custkey, declared, coalesce(n, 0) AS counted, greatest(declared - coalesce(n, 0), 0) AS missing FROM (SELECT o_custkey, count(*) + o_custkey % 2 AS declared FROM orders GROUP BY o_custkey) LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey) USING (o_custkey)""")
def declared_totals(v):
    declared = v("orders").groupBy("o_custkey").agg((F.count("*") + F.first(F.col("o_custkey") % 2)).alias("declared"))
    counted = v("orders").filter("o_orderstatus <> 'P'").groupBy("o_custkey").agg(F.count("*").alias("counted"))
    return quality.completeness(counted, declared, ["o_custkey"]).drop("ratio")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def queue_status(v):
    return quality.status_counts(v("events"), "event_type")


@query("""SELECT event_type AS endpoint, count(DISTINCT user_id) AS unique_records, count(*) - count(DISTINCT user_id) AS duplicates, count(*) FILTER (value < 5) AS empty_time, min(CASE WHEN value >= 5 THEN ts END) AS earliest, max(CASE WHEN value >= 5 THEN ts END) AS latest FROM events GROUP BY 1""")
def endpoint_report(v):
    return quality.endpoint_summary(v("events").select(F.col("event_type").alias("endpoint"), F.col("user_id").alias("record_id"), F.when(F.col("value") >= 5, F.col("ts")).alias("event_time")))


@query("""WITH f AS (SELECT l_suppkey AS k, 'oversized' AS reason FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 60 AND l_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'TEST_SHIP' FROM supplier WHERE upper(s_name) LIKE '%1' UNION ALL SELECT s_suppkey, 'manual' FROM supplier WHERE s_suppkey % 4 = 0)
SELECT k, string_agg(DISTINCT reason, '+' ORDER BY reason) AS reason FROM f GROUP BY k""")
def quarantine_update(v):
    status = F.when(F.col("l_suppkey") % 2 == 0, "hit").otherwise("complete")
    found = v("lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("total"), F.first(status).alias("status"))
    rejected = v("supplier").filter("s_suppkey % 4 = 0").select(F.col("s_suppkey").alias("k"), F.lit("manual").alias("reason"))
    text = lambda c: F.lit(c).cast("string")
    buckets = v("supplier").select(F.col("s_suppkey").alias("k"), codes.classify_vessel(text(None), F.col("s_name"), F.lit(""), text(None), text(None), [("en", "%1", "TEST_SHIP")]).alias("bucket")).filter("bucket is not null")
    return quality.quarantine(rejected, found, buckets, ["k"], 60)


@query("SELECT o_orderkey, l.late FROM orders o JOIN (SELECT l_orderkey, bool_or(o_orderdate > l_shipdate) AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey")
def order_of_times(v):
    rows = v("orders").join(v("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return quality.order_flags(rows, {"late": ("o_orderdate", "l_shipdate")}).groupBy("o_orderkey").agg(F.bool_or("late").alias("late"))


@query("SELECT c_custkey, c_mktsegment FROM customer ORDER BY sha256('seed' || chr(31) || CAST(c_custkey AS STRING) || chr(31) || c_mktsegment), c_custkey LIMIT 100")
def sample_uniform(v):
    return sample.stable_sample(v("customer").select("c_custkey", "c_mktsegment"), ["c_custkey", "c_mktsegment"], 100, "seed")


_STRATA = {"BUILDING": 20, "MACHINERY": 15, "HOUSEHOLD": 5}


@query(f"""SELECT c_custkey, c_mktsegment AS stratum, universe FROM (SELECT c_custkey, c_mktsegment, count(*) OVER (PARTITION BY c_mktsegment) AS universe, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('seed' || chr(31) || CAST(c_custkey AS STRING)), c_custkey) AS r FROM customer)
WHERE r <= CASE c_mktsegment {" ".join(f"WHEN '{k}' THEN {n}" for k, n in _STRATA.items())} ELSE 0 END""")
def sample_stratified(v):
    return sample.stratified_sample(v("customer").select("c_custkey", "c_mktsegment"), ["c_custkey"], F.col("c_mktsegment"), _STRATA, "seed").select("c_custkey", "stratum", "universe")


@query("""SELECT sha256(string_agg(l, chr(10) ORDER BY l)) AS fingerprint, count(*) AS n FROM (SELECT CAST(c_custkey AS STRING) || chr(31) || c_mktsegment AS l FROM (SELECT c_custkey, c_mktsegment FROM customer ORDER BY sha256('seed' || chr(31) || CAST(c_custkey AS STRING) || chr(31) || c_mktsegment), c_custkey LIMIT 100))""")
def manifest(v):
    drawn = sample.stable_sample(v("customer").select("c_custkey", "c_mktsegment"), ["c_custkey", "c_mktsegment"], 100, "seed")
    return sample.manifest_fingerprint(drawn, ["c_custkey", "c_mktsegment"])


@query("""WITH r AS (SELECT CAST(user_id AS STRING) AS voyage, CAST(date_trunc('day', ts) AS DATE) - DATE '2024-01-01' AS round, count(*) FILTER (event_type = 'purchase') AS n, max(ts) AS t FROM events GROUP BY 1, 2),
h AS (SELECT voyage, max(round) FILTER (n > 0) AS hit, max(t) AS last_event FROM r GROUP BY voyage)
SELECT voyage, CAST(count(*) FILTER (hit IS NULL OR round > hit) AS INT) AS idle_rounds, h.last_event, count(*) FILTER (hit IS NULL OR round > hit) >= 6 AS inactive FROM r JOIN h USING (voyage) GROUP BY voyage, hit, h.last_event""")
def idle_voyages(v):
    from tidewright.streaming.streams import idle_rounds_batch

    rounds = v("events").groupBy(F.col("user_id").cast("string").alias("voyage"), F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("round")).agg(F.count_if(F.col("event_type") == "purchase").alias("new_events"), F.max("ts").alias("last_event")).withColumn("in_catalog", F.lit(False))
    return idle_rounds_batch(rounds)


@query("SELECT event_type AS endpoint, event_id AS id, user_id AS uid FROM events")
def landed_records(v):
    from tidewright.sources.landing import page_rows

    record = F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("uid"))
    pages = v("events").groupBy(F.col("event_type").alias("endpoint"), (F.col("event_id") / 100).cast("bigint").alias("page")).agg(F.to_json(F.struct(F.lit(0).alias("code"), F.struct(F.collect_list(record).alias("list")).alias("data"))).alias("body"))
    fields = F.from_json("record", "id bigint, uid bigint")
    return page_rows(pages).select("endpoint", fields["id"].alias("id"), fields["uid"].alias("uid"))


_RUNS = "(SELECT r, s_name AS entity_key, s_suppkey // (r + 3) AS c FROM supplier, (SELECT unnest([0, 1, 2]) AS r))"


@query(f"SELECT x.entity_key AS a, y.entity_key AS b, round(count(*) / 3.0, 6) AS share FROM {_RUNS} x JOIN {_RUNS} y ON x.r = y.r AND x.c = y.c AND x.entity_key < y.entity_key GROUP BY 1, 2")
def consensus(v):
    from tidewright.operators.models import co_assignment

    rows = v("supplier").select(F.explode(F.array(*map(F.lit, range(3)))).alias("run_id"), F.col("s_name").alias("entity_key"), "s_suppkey").withColumn("cluster_id", F.floor(F.col("s_suppkey") / (F.col("run_id") + 3)))
    return doubles(co_assignment(rows), "share")


@query()
def curve_clusters(v):
    """Spark ML labels; tests hold their sizes and silhouette."""
    from tidewright.operators.models import cluster

    return cluster(series.features(v("curves")), k=4).select("entity_key", "cluster_id")


@query()
def curve_density_clusters(v):
    from tidewright.operators.models import density_cluster

    return density_cluster(series.features(v("curves")), "entity_key", 3.0, 3).select("entity_key", "cluster_id", "is_outlier")


@query("SELECT count(*) AS events, count(DISTINCT container_no) AS containers, count(*) FILTER (type = 'GATE_IN') AS moves_in, count(*) FILTER (type = 'GATE_OUT') AS moves_out FROM :gate:")
def gate_counters(v):
    return reports.coverage(v("gate"), "type", "container_no")


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in ("orders", "lineitem", "events", "customer")))
def layer_rows(v):
    return reports.table_counts({t: v(t) for t in ("orders", "lineitem", "events", "customer")})


@query("SELECT type, direction, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY type), 6) AS share FROM :gate: GROUP BY type, direction")
def direction_shares(v):
    return doubles(reports.shares(v("gate"), "type", "direction"), "share")


@query("SELECT terminal, count(*) AS n, round(1 - count(out_time)::DOUBLE / count(*), 6) AS missing_rate FROM :gate: GROUP BY terminal")
def missing_out_times(v):
    return doubles(reports.missing_rate(v("gate"), "terminal", "out_time"), "missing_rate")


@query("SELECT terminal, count(*) AS n, round(CAST(avg(CAST(value AS DECIMAL(18, 4))) AS DOUBLE), 4) AS mean FROM :gate: WHERE value BETWEEN 1 AND 40 GROUP BY terminal HAVING count(*) > 20")
def mean_weights(v):
    return doubles(reports.mean_in_range(v("gate").withColumn("value", F.col("value").cast("double")), "terminal", "value", 1, 40, 20), "mean", digits=4)


@query("""SELECT from_state, to_state, count(*) AS n FROM (SELECT event_type AS to_state, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS from_state FROM events) WHERE from_state IS NOT NULL GROUP BY ALL""")
def event_transitions(v):
    return reports.state_transitions(v("events"), "user_id", "ts", "event_type")


@query("""SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderdate DESC, o_orderkey LIMIT 200 OFFSET 10""")
def enrichment_batch(v):
    return reports.queue_order(v("orders").withColumn("status", F.col("o_orderstatus")), {"P": 0, "O": 1}, "o_orderdate", "o_orderkey", 200, 10).select("o_orderkey", "o_orderstatus")


@query("""SELECT event_type AS kind, count(*) AS runs, round(CAST(avg(CAST(user_id AS DECIMAL(18, 4))) AS DOUBLE), 6) AS avg_requests, 10.0 AS avg_minutes FROM events GROUP BY 1""")
def run_performance(v):
    return doubles(reports.run_statistics(_runs(v)), "avg_requests", "avg_minutes")


@query("""SELECT count(*) AS runs, round(coalesce(sum(user_id), 0) / 86400.0, 6) AS requests_per_second, round(count(*) * 600 / 86400.0, 6) AS concurrency FROM events WHERE ts + INTERVAL 10 MINUTE >= TIMESTAMP '2024-01-05' AND ts + INTERVAL 10 MINUTE < TIMESTAMP '2024-01-06'""")
def run_throughput(v):
    return doubles(reports.throughput(_runs(v), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)), "requests_per_second", "concurrency")


def _runs(v):
    return v("events").select(F.col("event_type").alias("kind"), F.col("ts").alias("started_at"), (F.col("ts") + F.expr("interval 10 minutes")).alias("finished_at"), F.col("user_id").alias("requests"))


@query("""SELECT user_id AS fingerprint, min(CASE WHEN event_type <> 'error' THEN ts END) AS first_success, max(CASE WHEN event_type <> 'error' THEN ts END) AS last_success, count(*) AS runs, CAST(sum(event_id % 5) AS BIGINT) AS requests, max(CASE WHEN event_type = 'error' THEN ts END) AS last_failure FROM events GROUP BY user_id""")
def sessions(v):
    rows = v("events").select(F.col("user_id").alias("fingerprint"), F.col("event_id").alias("event_key"), F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("outcome"), F.col("ts").alias("at"), (F.col("event_id") % 5).alias("requests"))
    return reports.session_rollup(rows.unionByName(rows))


@query("""SELECT o_custkey, o_orderkey, coalesce(round((epoch(o_orderdate) - epoch(lag(o_orderdate) OVER w)) / 3600, 6), -1) AS delta_h, coalesce(o_orderdate <> lag(o_orderdate) OVER w, false) AS changed FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def schedule_deltas(v):
    out = reports.revision_deltas(v("orders"), ["o_custkey"], ["o_orderkey"], ["o_orderdate"])
    return doubles(out.select("o_custkey", "o_orderkey", F.coalesce("o_orderdate_delta_h", F.lit(-1.0)).alias("delta_h"), F.col("o_orderdate_changed").alias("changed")), "delta_h")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER w AS place, count(*) OVER p AS size, min(l_quantity) OVER p AS least, max(l_quantity) OVER p AS largest FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey), p AS (PARTITION BY l_orderkey)""")
def ranked_lines(v):
    out = reports.rank_in_partition(v("lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "l_quantity")
    return longs(out.select("l_orderkey", "l_linenumber", "l_partkey", "place", "size", "least", "largest"), "place")


@query("SELECT DISTINCT container_no FROM (SELECT container_no FROM :gate: UNION ALL SELECT CAST(o_custkey AS STRING) FROM orders)")
def vgm_work_list(v):
    return reports.work_list([v("gate"), v("orders").select(F.col("o_custkey").cast("string").alias("container_no"))], ["container_no"])


@query("""SELECT event_id FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 122 HOUR FROM events WHERE event_type IN ('click', 'view') AND event_id % 3 = 0) AND ts <= TIMESTAMP '2024-01-30'""")
def incremental_rows(v):
    ledger = v("events").select(F.col("event_type").alias("kind"), F.when(F.col("event_id") % 3 == 0, "ok").otherwise("failed").alias("status"), (F.col("ts") - F.expr("interval 5 days")).alias("watermark_to"))
    return reports.in_window(v("events"), "ts", *reports.incremental_window(ledger, ["click", "view"], dt.datetime(2024, 1, 29))).select("event_id")


@query("""SELECT endpoint, fingerprint, page, seq, coalesce(payload_hash = lag(payload_hash, 1) OVER w OR payload_hash = lag(payload_hash, 2) OVER w, false) AS adjacent_repeat FROM :page_log: WINDOW w AS (PARTITION BY endpoint, fingerprint ORDER BY seq)""")
def adjacent_page_repeats(v):
    pages = v("page_log").withColumnsRenamed({"page": "p", "seq": "page"})
    return quality.adjacent_repeats(pages).select("endpoint", "fingerprint", F.col("p").alias("page"), F.col("page").alias("seq"), "adjacent_repeat")


@query("""WITH f AS (SELECT DISTINCT event_type AS endpoint, unnest(['event_id', 'value', 'props']) AS field FROM events), e AS (SELECT DISTINCT event_type AS endpoint, unnest(['event_id', 'owner']) AS field FROM events)
SELECT *, 'new' AS drift FROM (SELECT * FROM f EXCEPT SELECT * FROM e) UNION ALL SELECT *, 'missing' FROM (SELECT * FROM e EXCEPT SELECT * FROM f)""")
def field_drift(v):
    from tidewright.sources.landing import observed_fields, schema_drift

    records = v("events").select(F.col("event_type").alias("endpoint"), F.col("ts").alias("seen_at"), F.to_json(F.struct("event_id", "value", "props")).alias("record"))
    expected = v("events").select(F.col("event_type").alias("endpoint"), F.explode(F.array(F.lit("event_id"), F.lit("owner"))).alias("field")).distinct()
    return schema_drift(observed_fields(records).select("endpoint", "field"), expected)


@query("""WITH p AS (SELECT *, first_value(total) OVER w AS f, lag(total) OVER w AS b, row_number() OVER w AS i FROM :job_pages: WINDOW w AS (PARTITION BY job ORDER BY page)),
x AS (SELECT *, CASE WHEN page <> i THEN 'gap' WHEN total < b THEN 'total_shrank' WHEN least(2, f - (page - 1) * 2) > 0 AND row_count = 0 THEN 'empty_page' WHEN row_count < least(2, f - (page - 1) * 2) THEN 'short_page' END AS fault FROM p)
SELECT job, count(*) AS pages, CAST(ceil(max(f) / 2.0) AS BIGINT) AS expected_pages, coalesce(arg_min(fault, page) FILTER (fault IS NOT NULL), CASE WHEN count(*) < ceil(max(f) / 2.0) THEN 'incomplete' END) AS fault FROM x GROUP BY job""")
def page_plans(v):
    return quality.page_ledger(v("job_pages"), 2)


@query("""SELECT cluster, time_bucket, round(quantile_cont(value, 0.1), 4) AS low, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.9), 4) AS high FROM (SELECT CASE WHEN entity_key < 'M' THEN 0 ELSE 1 END AS cluster, time_bucket, value FROM :curves:) GROUP BY cluster, time_bucket""")
def cluster_bands(v):
    from tidewright.operators.models import prototypes

    assigned = v("curves").select("entity_key").distinct().withColumn("cluster_id", F.when(F.col("entity_key") < "M", 0).otherwise(1))
    bands = prototypes(v("curves"), assigned).select(F.col("cluster_id").alias("cluster"), "time_bucket", F.col("bands")[0].alias("low"), F.col("bands")[2].alias("median"), F.col("bands")[4].alias("high"))
    return doubles(bands, "low", "median", "high", digits=4)
