"""Queries of life cycles, counters, presets, the dashboard's data and further metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewright.operators import cdc, dashboard, ledger, metrics
from tidewright.plans.registry import doubles, longs, query

NOW = dt.datetime(2024, 3, 1)
_GOOD = "NOT EXISTS (SELECT 1 FROM {0} r WHERE r.vesselcode = x.vesselcode AND r.voyage = x.voyage)"
_LIVE, _SEEN = _GOOD.format(":states_rejected:"), _GOOD.format(":quarantined:")


@query(f"""SELECT * FROM (SELECT count(*) FILTER ({_LIVE}) AS voyages, count(*) FILTER ({_LIVE} AND in_done_at IS NOT NULL AND out_done_at IS NOT NULL) AS voyages_done, count(*) FILTER ({_LIVE} AND inactive = 1) AS voyages_inactive, count(*) FILTER (NOT {_LIVE}) AS voyages_quarantined FROM :voyage_states: x),
(SELECT count(*) FILTER (g) AS events, count(*) FILTER (g AND type = 'GATE_IN') AS events_in, count(*) FILTER (g AND type = 'GATE_OUT') AS events_out, count(*) FILTER (NOT g) AS events_quarantined, min(received_time) FILTER (g) AS first_event, max(received_time) FILTER (g) AS last_event
  FROM (SELECT *, NOT (vesselcode, voyage) IN (SELECT (vesselcode, voyage) FROM :states_rejected:) AS g FROM :gate_raw:))""")
def gate_catalog_counters(v):
    return ledger.gate_counters(v("voyage_states"), v("gate_raw"), v("states_rejected"))


@query(f"""WITH g AS (SELECT status, count(*) AS n FROM :candidate_states: x WHERE {_LIVE} GROUP BY status), k AS (SELECT unnest(['pending', 'hit', 'empty', 'complete']) AS status)
SELECT k.status, coalesce(n, 0) AS n FROM k LEFT JOIN g ON g.status = k.status UNION ALL SELECT status, n FROM g WHERE status NOT IN (SELECT status FROM k) UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM g UNION ALL SELECT 'rejected', count(DISTINCT (vesselcode, voyage)) FROM :states_rejected:""")
def candidate_state_counts(v):
    return ledger.candidate_counters(v("candidate_states"), v("states_rejected"))


_SCOPE = dt.date(1998, 3, 10), dt.date(1998, 4, 5)


@query("""SELECT count(*) AS n FROM :history_candidates: x WHERE status IN ('pending', 'hit') AND NOT EXISTS (SELECT 1 FROM :history_rejected: r WHERE r.vesselcode = x.vesselcode AND r.voyage = x.voyage)
AND EXISTS (SELECT 1 FROM :history_months: m WHERE m.vesselcode = x.vesselcode AND m.voyage = x.voyage AND m.last_eta >= DATE '1998-03-10' AND m.first_eta < DATE '1998-04-05') AND vessel_in_catalog""")
def candidates_in_scope(v):
    return ledger.candidates_in_scope(v("history_candidates"), v("history_rejected"), v("history_months"), *_SCOPE, in_catalog=True)


@query(f"""WITH d AS (SELECT vesselcode, voyage FROM :voyage_states: x WHERE in_done_at IS NOT NULL AND out_done_at IS NOT NULL AND {_LIVE})
SELECT vesselcode, voyage, CASE WHEN f THEN 'complete' ELSE status END AS status, CASE WHEN f THEN TIMESTAMP '2024-03-01 00:00:00' ELSE updated_at END AS updated_at FROM (SELECT *, status IN ('pending', 'hit') AND (vesselcode, voyage) IN (SELECT (vesselcode, voyage) FROM d) AS f FROM :candidate_states:)""")
def completed_candidates(v):
    return ledger.complete_filled(v("candidate_states"), v("voyage_states"), v("states_rejected"), NOW).select("vesselcode", "voyage", "status", "updated_at")


_PROBED = """p AS (SELECT vesselcode, voyage, count(*) AS n, bool_or(coalesce(in_total, 0) + coalesce(out_total, 0) > 0) AS hit, max("at") AS last_at, max(struct_pack(a := "at", t := in_total)) FILTER (in_total IS NOT NULL) AS i, max(struct_pack(a := "at", t := out_total)) FILTER (out_total IS NOT NULL) AS o FROM :candidate_probes: GROUP BY ALL)"""


@query(f"""WITH {_PROBED} SELECT c.vesselcode, c.voyage, CASE WHEN hit THEN 'hit' ELSE status END AS status, CAST(attempt_count + coalesce(n, 0) AS BIGINT) AS attempt_count, coalesce(last_at, probed_at) AS probed_at, coalesce(i.t, in_total) AS in_total, coalesce(o.t, out_total) AS out_total
FROM :candidate_states: c LEFT JOIN p ON p.vesselcode = c.vesselcode AND p.voyage = c.voyage""")
def probed_candidates(v):
    return longs(ledger.note_probes(v("candidate_states"), v("candidate_probes")).select("vesselcode", "voyage", "status", "attempt_count", "probed_at", "in_total", "out_total"), "attempt_count")


@query("""WITH o AS (SELECT vesselcode, voyage, max(struct_pack(a := "at", t := total)) FILTER (direction = 'GATE_IN') AS i, max(struct_pack(a := "at", t := total)) FILTER (direction = 'GATE_OUT') AS o FROM :direction_marks: GROUP BY ALL)
SELECT v.vesselcode, v.voyage, coalesce(i.a, in_done_at) AS in_done_at, coalesce(i.t, in_total) AS in_total, coalesce(o.a, out_done_at) AS out_done_at, coalesce(o.t, out_total) AS out_total FROM :voyage_states: v LEFT JOIN o USING (vesselcode, voyage)""")
def marked_directions(v):
    return ledger.mark_directions(v("voyage_states"), v("direction_marks")).select("vesselcode", "voyage", "in_done_at", "in_total", "out_done_at", "out_total")


@query("""WITH h AS (SELECT DISTINCT vesselcode, voyage, vessel_en_name AS name FROM :candidate_states: WHERE status = 'hit')
SELECT coalesce(v.vesselcode, h.vesselcode) AS vesselcode, coalesce(v.voyage, h.voyage) AS voyage, coalesce(nullif(h.name, ''), v.vesselename) AS vesselename, CASE WHEN v.vesselcode IS NULL THEN TIMESTAMP '2024-03-01 00:00:00' ELSE first_seen_at END AS first_seen_at,
  CASE WHEN v.vesselcode IS NULL THEN TIMESTAMP '2024-03-01 00:00:00' ELSE last_seen_at END AS last_seen_at, coalesce(inactive, 0) AS inactive, in_total FROM :voyage_states: v FULL JOIN h ON h.vesselcode = v.vesselcode AND h.voyage = v.voyage""")
def promoted_voyages(v):
    return ledger.promote_hits(v("voyage_states"), v("candidate_states"), NOW).select("vesselcode", "voyage", "vesselename", "first_seen_at", "last_seen_at", "inactive", "in_total")


@query("""SELECT run_id, kind, CASE WHEN s THEN 'interrupted' ELSE status END AS status, CASE WHEN s THEN TIMESTAMP '2024-03-01 00:00:00' ELSE finished_at END AS finished_at, CASE WHEN s THEN 'not ended properly' ELSE error END AS error FROM (SELECT *, status = 'running' AND kind = 'backfill' AS s FROM :run_ledger:)""")
def closed_runs(v):
    return ledger.close_stale(v("run_ledger"), "backfill", NOW).select("run_id", "kind", "status", "finished_at", "error")


@query("""SELECT 'orders' AS name, CAST(count(*) AS STRING) AS value FROM orders UNION ALL SELECT 'catalog_watermark', strftime(max(last_seen_at), '%Y-%m-%d %H:%M:%S') FROM :npp_catalog: UNION ALL SELECT 'changes:' || CAST(l_suppkey AS STRING), CAST(count(*) AS STRING) FROM lineitem GROUP BY l_suppkey""")
def warehouse_counters(v):
    return ledger.warehouse_counters({"orders": v("orders")}, v("npp_catalog"), v("lineitem").select(F.col("l_suppkey").alias("run_id")))


@query("SELECT vgm_status AS status, count(*) AS n FROM :container_states: GROUP BY vgm_status")
def preset_vgm_states(v):
    return v("container_states").groupBy(F.col("vgm_status").alias("status")).agg(F.count("*").alias("n"))


@query("SELECT history_status AS status, count(*) AS n FROM :container_states: GROUP BY history_status")
def preset_history_states(v):
    return v("container_states").groupBy(F.col("history_status").alias("status")).agg(F.count("*").alias("n"))


@query("SELECT run_id, algorithm, sample_count, cluster_count, silhouette, created_at FROM :cluster_records: ORDER BY created_at DESC, run_id, algorithm LIMIT 5")
def preset_newest_cluster_runs(v):
    return v("cluster_records").orderBy(F.desc("created_at"), "run_id", "algorithm").limit(5)


_BOARD = dt.date(2001, 6, 1)
_SHOWN = "s AS (SELECT * FROM :board_curves: WHERE granularity = 'week' AND model_version = 'v1' AND time_bucket BETWEEN DATE '2001-06-01' - 364 AND DATE '2001-06-08')"
_DRAWN = f"""{_SHOWN}, r AS (SELECT CASE WHEN curve_type IN ('planned_demand', 'released_bill_count') THEN 'traffic' WHEN curve_type = 'cargo_release' THEN 'cargo' WHEN curve_type LIKE '%_delay' THEN 'delays' ELSE 'samples' END AS section, curve_type AS name, time_bucket,
  CASE WHEN curve_type LIKE '%_delay' THEN avg(value) WHEN curve_type = 'cargo_release' THEN sum(value) / 1000 ELSE sum(value) END AS value FROM s WHERE isfinite(value) AND curve_type NOT IN ('gate_in_teu', 'gate_out_teu', 'pressure_index') AND (curve_type NOT LIKE '%_delay' OR value BETWEEN 0 AND 720) GROUP BY curve_type, time_bucket)"""


@query(f"""WITH {_DRAWN}, top AS (SELECT entity_key FROM s WHERE curve_type = 'planned_demand' GROUP BY entity_key ORDER BY sum(value) DESC, entity_key LIMIT 8)
SELECT section, name, time_bucket, round(value, 5) AS value FROM r UNION ALL SELECT CASE curve_type WHEN 'planned_demand' THEN 'terminals' ELSE 'pressure' END, entity_key, time_bucket, round(value, 5) FROM s JOIN top USING (entity_key) WHERE curve_type IN ('planned_demand', 'pressure_index') AND isfinite(value)""")
def dashboard_points(v):
    return doubles(dashboard.dashboard_points(v("board_curves"), _BOARD, 52), "value", digits=5)


@query(f"""WITH {_DRAWN}, l AS (SELECT name, avg(value) AS value FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY time_bucket DESC) AS i FROM r) WHERE i <= 4 GROUP BY name)
SELECT k.name, round(l.value, 5) AS value FROM (VALUES ('planned', 'planned_demand'), ('released', 'released_bill_count'), ('arrival', 'arrival_delay')) k(name, curve) LEFT JOIN l ON l.name = k.curve UNION ALL SELECT 'containers', CAST(count(*) AS DOUBLE) FROM :container_states:""")
def dashboard_cards(v):
    return doubles(dashboard.dashboard_cards(v("board_curves"), v("container_states"), _BOARD, 52), "value", digits=5)


@query(f"""WITH {_SHOWN}, a AS (SELECT count(*) AS n, count(*) FILTER (vgm_status = 'complete') AS x, count(*) FILTER (history_status = 'complete') AS y, sum(gate_event_count) AS z FROM :container_states:),
b AS (SELECT count(*) AS n, count(DISTINCT CASE WHEN curve_type = 'gate_in_teu' THEN time_bucket END) + count(DISTINCT CASE WHEN curve_type = 'gate_out_teu' THEN time_bucket END) AS g FROM s)
SELECT unnest(['catalog_containers', 'vgm_queried', 'history_queried', 'gate_source_rows', 'displayed_points', 'gate_observed_points', 'gate_history_validated']) AS name,
  unnest([CAST(a.n AS STRING), CAST(x AS STRING), CAST(y AS STRING), CAST(z AS STRING), CAST(b.n AS STRING), CAST(g AS STRING), 'false']) AS value FROM a, b""")
def dashboard_coverage(v):
    from tidewright.plans.queries import gate_daily

    rows = dashboard.dashboard_coverage(v("board_curves"), v("container_states"), gate_daily(v), _BOARD, 52)
    return rows.filter("name not in ('gate_start', 'gate_end', 'teu_size_coverage')")


@query("""WITH o AS (SELECT CAST(date_trunc('week', flow_date) AS DATE) AS week_start, terminal, direction, nullif(upper(trim(container_no)), '') AS box, sum(weight_kg) AS w, count(*) AS n, count(*) FILTER (result_code = 'Y') AS ok, sum(CASE WHEN received_time >= operator_time THEN (epoch(received_time) - epoch(operator_time)) / 3600 END) AS lag, count(CASE WHEN received_time >= operator_time THEN 1 END) AS lags FROM :metric_facts: GROUP BY ALL)
SELECT week_start, terminal, direction, count(box) AS containers, round(CAST(sum(w) FILTER (box IS NOT NULL) AS DOUBLE) / nullif(count(box), 0), 6) AS weight_per_container, round(CAST(sum(ok) AS DOUBLE) / sum(n), 6) AS success_rate, round(CAST(sum(lag) AS DOUBLE) / nullif(CAST(sum(lags) AS DOUBLE), 0), 6) AS receive_lag_h FROM o GROUP BY ALL""")
def vgm_week_metrics(v):
    return doubles(metrics.vgm_metrics(v("metric_facts")), "weight_per_container", "success_rate", "receive_lag_h")


@query("""WITH o AS (SELECT CAST(date_trunc('week', flow_date) AS DATE) AS week_start, terminal, nullif(bill_no, '') AS bill, sum(weight_kg) AS w FROM :metric_facts: GROUP BY ALL)
SELECT week_start, terminal, count(bill) AS bills, round(CAST(avg(w) FILTER (bill IS NOT NULL) AS DOUBLE), 6) AS weight_per_bill FROM o GROUP BY ALL""")
def release_week_metrics(v):
    return doubles(metrics.release_metrics(v("metric_facts")), "weight_per_bill")


@query("""WITH d AS (SELECT CAST(date_trunc('week', flow_date) AS DATE) AS week_start, terminal, (epoch(actual_anchor) - epoch(estimated_anchor)) / 3600 AS h FROM :metric_facts:)
SELECT week_start, terminal, count(*) FILTER (h BETWEEN 0 AND 720) AS calls, round(avg(h) FILTER (h BETWEEN 0 AND 720), 6) AS anchor_delay_h FROM d GROUP BY ALL""")
def anchor_week_delays(v):
    return doubles(metrics.anchor_delays(v("metric_facts")), "anchor_delay_h")


@query("""WITH e AS (SELECT CAST(date_trunc('week', flow_date) AS DATE) AS week_start, terminal, coalesce(route, 'UNKNOWN') AS route, CAST(sum(weight_kg) AS BIGINT) AS weight FROM :metric_facts: GROUP BY ALL)
SELECT week_start, terminal, route, weight, round(CAST(weight AS DOUBLE) / nullif(CAST(sum(weight) OVER (PARTITION BY week_start, terminal) AS DOUBLE), 0), 6) AS share FROM e""")
def route_shares(v):
    return doubles(metrics.mix(v("metric_facts"), "route", "weight_kg"), "share")


@query("""WITH t AS (SELECT curve_type, min(time_bucket) FILTER (value <> 0) AS a, max(time_bucket) FILTER (value <> 0) AS b, avg(CASE WHEN coalesce(value, 0) <> 0 THEN 1.0 ELSE 0 END) AS live FROM :board_curves: GROUP BY curve_type)
SELECT curve_type, count(*) AS points, min(time_bucket) AS first_bucket, max(time_bucket) AS last_bucket FROM :board_curves: JOIN t USING (curve_type) WHERE time_bucket BETWEEN a AND b AND live > 0 GROUP BY curve_type""")
def live_curves(v):
    rows = metrics.without_dead(metrics.trimmed(v("board_curves")))
    return rows.groupBy("curve_type").agg(F.count("*").alias("points"), F.min("time_bucket").alias("first_bucket"), F.max("time_bucket").alias("last_bucket"))


@query("SELECT substr(size_code, 1, 1) AS iso_length, count(*) AS n FROM :gate_raw: WHERE size_code NOT IN ('40HQ', '40HC', '45HQ', '40GP', '20GP', '40XX') GROUP BY 1")
def iso_lengths(v):
    return metrics.iso_lengths(v("gate_raw"), "size_code")


@query("SELECT p_brand AS value, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM part GROUP BY p_brand ORDER BY n DESC, value LIMIT 10")
def leading_brands(v):
    return doubles(metrics.leading(v("part"), "p_brand"), "share")


@query("SELECT type, count(*) AS n FROM :gate: WHERE vesselcode = 'UN7' AND voyage = '0' GROUP BY type")
def events_of_voyage(v):
    return metrics.events_by_type(v("gate"), "UN7", "0")


_ASSIGNED = "SELECT 'r' || CAST(s_suppkey % 3 AS STRING) AS run_id, CAST(s_suppkey AS STRING) AS entity_key, s_nationkey AS cluster_id FROM supplier"
_FEATURED = "SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'terminal' ELSE 'operator' END AS entity_type, CASE WHEN s_suppkey % 5 = 0 THEN 'v2' ELSE 'v1' END AS feature_version, CAST(s_suppkey AS STRING) AS entity_key, s_acctbal AS mean FROM supplier"


@query(f"SELECT a.run_id, a.entity_key, a.cluster_id, f.mean FROM ({_ASSIGNED}) a LEFT JOIN ({_FEATURED}) f ON f.entity_type = 'terminal' AND f.feature_version = 'v1' AND f.entity_key = a.entity_key WHERE a.run_id = 'r1'")
def cluster_members(v):
    s = v("supplier")
    key = F.col("s_suppkey").cast("string").alias("entity_key")
    assigned = s.select(F.concat(F.lit("r"), (F.col("s_suppkey") % 3).cast("string")).alias("run_id"), key, F.col("s_nationkey").alias("cluster_id"))
    featured = s.select(F.when(F.col("s_suppkey") % 2 == 0, "terminal").otherwise("operator").alias("entity_type"), F.when(F.col("s_suppkey") % 5 == 0, "v2").otherwise("v1").alias("feature_version"), key, F.col("s_acctbal").alias("mean"))
    return metrics.assignments_with_features(assigned, featured, "r1", "terminal", "v1", ["mean"]).select("run_id", "entity_key", "cluster_id", "mean")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem o WHERE o.l_linenumber = 1 AND o.l_orderkey = l.l_orderkey AND o.l_partkey = l.l_partkey)")
def facts_without_version(v):
    rows = v("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return cdc.missing_versions(rows, rows.filter("l_linenumber = 1"), ["l_orderkey"], "l_partkey")


@query("SELECT event_type AS layer, count(*) AS n, count(*) FILTER (event_type = 'error') AS unknown FROM events GROUP BY event_type")
def unknown_events(v):
    return metrics.unknown_counts(v("events"), "event_type", F.col("event_type") == "error")
