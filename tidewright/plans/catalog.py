"""Queries over runs, catalogs, work lists and the questions that a dashboard asks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewright.functions import sql as sql_functions
from tidewright.operators import joins, runs
from tidewright.plans.registry import doubles, query

NOW = dt.datetime(2024, 1, 31)
_FIELDS = ["status", "customer", "priority", "compare_time"]
_KIND = f"CASE WHEN o.id IS NULL THEN 'new' WHEN {' AND '.join(f'n.{f} = o.{f}' for f in _FIELDS)} THEN 'unchanged' WHEN {' AND '.join(f'n.{f} = o.{f}' for f in _FIELDS[:3])} THEN 'touched' ELSE 'updated' END"


@query("SELECT id, status, customer FROM :current: ORDER BY customer, status, id")
def current_rows(v):
    return runs.ordered_rows(v("current"), "customer", "status", "id").select("id", "status", "customer")


@query("SELECT id, vesselcode, voyage, event_time FROM :gate: g WHERE id % 10 = 3 AND NOT EXISTS (SELECT 1 FROM :quarantined: q WHERE q.vesselcode = g.vesselcode AND q.voyage = g.voyage)")
def run_events(v):
    return runs.run_events(v("gate").withColumn("run_id", F.col("id") % 10), 3, v("quarantined")).select("id", "vesselcode", "voyage", "event_time")


@query(f"SELECT n.id, {_KIND} AS change_type, o.status, o.customer FROM :incoming: n JOIN :current: o ON o.id = n.id WHERE n.id % 4 = 1")
def run_changed_rows(v):
    from tidewright.operators.cdc import capture_changes

    changes = capture_changes(v("current"), v("incoming"), "id", _FIELDS, touch=("compare_time",)).withColumn("run_id", F.col("id") % 4)
    return runs.run_changes(changes, v("current"), 1).select("id", "change_type", "status", "customer")


@query(f"SELECT n.id, {_KIND} AS change_type FROM :incoming: n LEFT JOIN :current: o ON n.id = o.id WHERE CAST(n.customer AS BIGINT) % 5 = 0")
def reconciled_changes(v):
    active = v("current").select("customer").distinct().filter(F.col("customer").cast("bigint") % 5 == 0)
    return runs.reconcile(v("current"), v("incoming"), active, ["customer"], "id", _FIELDS, touch=("compare_time",)).select("id", "change_type")


@query(f"SELECT n.id, {_KIND} AS change_type FROM :incoming: n JOIN orders s ON s.o_orderkey = n.id LEFT JOIN :current: o ON n.id = o.id WHERE s.o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-12-31'")
def replayed_changes(v):
    rows = v("incoming").join(v("orders").select(F.col("o_orderkey").alias("id"), "o_orderdate"), "id")
    return runs.replay(v("current"), rows, "o_orderdate", dt.datetime(1995, 1, 1), dt.datetime(1995, 12, 31), "id", _FIELDS, touch=("compare_time",)).select("id", "change_type")


@query("""SELECT job_id, query_voyage, CASE status WHEN 'pending' THEN 0 WHEN 'partial' THEN 1 ELSE 2 END AS state, planned_total, planned_total IS NULL AS unknown
FROM :capture_jobs: JOIN (SELECT c_custkey AS candidate_id, CAST(c_nationkey AS STRING) AS query_voyage FROM customer) USING (candidate_id)""")
def unfinished_jobs(v):
    candidates = v("customer").select(F.col("c_custkey").alias("candidate_id"), F.col("c_nationkey").cast("string").alias("query_voyage"))
    out = runs.unfinished_jobs(v("capture_jobs"), candidates, retry_errors=True)
    return out.select("job_id", "query_voyage", F.col("place.state").cast("int").alias("state"), "planned_total", F.col("place.unknown").alias("unknown"))


@query("""SELECT c.vesselcode, c.voyage, c.status, c.last_eta, g.in_total AS existing_in_total, g.vesselcode IS NOT NULL AS exact_match FROM :history_candidates: c LEFT JOIN :gate_catalog: g ON g.vesselcode = c.vesselcode AND g.voyage = c.voyage
WHERE c.status IN ('pending', 'hit') AND c.vessel_in_catalog AND NOT EXISTS (SELECT 1 FROM :history_rejected: r WHERE r.vesselcode = c.vesselcode AND r.voyage = c.voyage)
  AND EXISTS (SELECT 1 FROM :history_months: m WHERE m.vesselcode = c.vesselcode AND m.voyage = c.voyage AND m.last_eta >= DATE '1995-01-01' AND m.first_eta < DATE '1995-07-01')""")
def pending_candidates(v):
    out = runs.pending_candidates(v("history_candidates"), v("gate_catalog"), v("history_months"), v("history_rejected"), dt.date(1995, 1, 1), dt.date(1995, 7, 1), in_catalog=True)
    return out.select("vesselcode", "voyage", "status", "last_eta", "existing_in_total", "exact_match")


@query("""SELECT g.vesselcode, g.voyage, g.last_event_at, k.last_seen_at AS catalog_last_seen FROM :gate_voyages: g LEFT JOIN :npp_catalog: k ON k.unvessel = g.vesselcode AND k.voyage = g.voyage
WHERE g.inactive = 0 AND (k.unvessel IS NOT NULL OR g.last_event_at >= TIMESTAMP '2024-01-30 12:00:00')""")
def gate_active_voyages(v):
    return runs.active_gate_voyages(v("gate_voyages"), v("npp_catalog"), NOW + dt.timedelta(hours=12), active_days=1).select("vesselcode", "voyage", "last_event_at", "catalog_last_seen")


@query("""WITH b AS (SELECT *, row_number() OVER (PARTITION BY unvessel, voyage ORDER BY portclose_at IS NULL, portclose_at DESC, portclose_raw DESC) AS r FROM :npp_batch:), n AS (SELECT * FROM b WHERE r = 1)
SELECT coalesce(n.unvessel, o.unvessel) AS unvessel, coalesce(n.voyage, o.voyage) AS voyage, CASE WHEN n.unvessel IS NULL THEN o.envessel ELSE n.envessel END AS envessel, coalesce(n.portclose_at, o.portclose_at) AS portclose_at,
  CASE WHEN n.unvessel IS NULL OR (n.portclose_at IS NULL AND o.portclose_at IS NOT NULL) THEN o.portclose_raw ELSE n.portclose_raw END AS portclose_raw, coalesce(o.first_seen_at, TIMESTAMP '2024-01-31') AS first_seen_at,
  CASE WHEN n.unvessel IS NULL THEN o.last_seen_at ELSE TIMESTAMP '2024-01-31' END AS last_seen_at, o.unvessel IS NULL AS new
FROM :npp_catalog: o FULL JOIN n ON n.unvessel = o.unvessel AND n.voyage = o.voyage""")
def merged_voyages(v):
    return runs.merge_voyages(v("npp_catalog"), v("npp_batch"), NOW)


@query("""SELECT coalesce(n.vesselcode, o.vesselcode) AS vesselcode, coalesce(n.voyage, o.voyage) AS voyage, coalesce(nullif(n.vessel_en_name, ''), o.vessel_en_name) AS vessel_en_name, least(o.first_eta, n.first_eta) AS first_eta, greatest(o.last_eta, n.last_eta) AS last_eta,
  greatest(o.source_plan_rows, n.source_plan_rows) AS source_plan_rows, greatest(o.vessel_in_catalog, n.vessel_in_catalog) AS vessel_in_catalog, coalesce(o.status, 'pending') AS status
FROM (SELECT * FROM :history_candidates: WHERE source_plan_rows % 2 = 0) o FULL JOIN (SELECT *, CASE WHEN source_plan_rows % 3 = 0 THEN '' ELSE 'new name' END AS vessel_en_name FROM (SELECT vesselcode, voyage, first_eta - 3 AS first_eta, last_eta + 3 AS last_eta, source_plan_rows + 1 AS source_plan_rows, NOT vessel_in_catalog AS vessel_in_catalog FROM :history_candidates: WHERE status <> 'no_data') x) n
  ON n.vesselcode = o.vesselcode AND n.voyage = o.voyage""")
def merged_candidates(v):
    old = v("history_candidates")
    found = old.filter("status <> 'no_data'").select("vesselcode", "voyage", F.date_sub("first_eta", 3).alias("first_eta"), F.date_add("last_eta", 3).alias("last_eta"), (F.col("source_plan_rows") + 1).alias("source_plan_rows"), (~F.col("vessel_in_catalog")).alias("vessel_in_catalog"))
    found = found.withColumn("vessel_en_name", F.when(F.col("source_plan_rows") % 3 == 0, "").otherwise("new name"))
    return runs.merge_candidates(old.filter("source_plan_rows % 2 = 0"), found)


_VALID = " + ".join(f"{f} * {2**i}" for i, f in enumerate([10, 12, 13, 32] + [f"CAST(substr(c, {i + 1}, 1) AS INT)" for i in range(4, 10)]))


@query("""WITH e AS (SELECT upper(trim(container_no)) AS container_no, count(*) AS events FROM :gate_raw: g WHERE trim(container_no) <> '' AND NOT EXISTS (SELECT 1 FROM :quarantined: q WHERE q.vesselcode = g.vesselcode AND q.voyage = g.voyage) GROUP BY ALL)
SELECT container_no, CASE WHEN CAST(substr(container_no, 5, 7) AS BIGINT) % 2 = 0 THEN 'gate_events+plans' ELSE 'gate_events' END AS source, events,
  CASE WHEN container_no IN (SELECT upper(trim(containerNumber)) FROM :source_vgm: WHERE containerNumber IS NOT NULL) THEN 'complete' WHEN CAST(""" + _VALID.replace("substr(c,", "substr(container_no,") + """ AS BIGINT) % 11 % 10 = CAST(substr(container_no, 11, 1) AS BIGINT) THEN 'pending' ELSE 'invalid' END AS status FROM e""")
def merged_containers(v):
    found = joins.container_catalog(v("gate_raw"), v("quarantined"))
    old = found.filter(F.substring("container_no", 5, 7).cast("bigint") % 2 == 0).withColumns({"source": F.lit("plans"), "events": F.lit(0).cast("bigint")})
    return runs.merge_containers(old, found, "gate_events", v("source_vgm").select(F.col("containerNumber").alias("container_no"))).select("container_no", "source", "events", "status")


@query("SELECT l_partkey, l_suppkey, l_shipdate FROM lineitem EXCEPT SELECT l_partkey, l_suppkey, l_shipdate FROM lineitem WHERE l_linenumber = 1")
def snapshots_to_append(v):
    rows = v("lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    return runs.append_snapshots(v("lineitem").filter("l_linenumber = 1").select("l_partkey", "l_suppkey", "l_shipdate"), rows, ["l_partkey", "l_suppkey"], "l_shipdate")


@query("SELECT 'nation' AS algorithm, TIMESTAMP '2024-01-31' AS created_at, count(*) AS sample_count, count(DISTINCT c_nationkey) AS cluster_count, CAST(NULL AS DOUBLE) AS silhouette FROM customer")
def model_runs(v):
    return runs.model_run(v("customer"), "nation", NOW, cluster="c_nationkey")




@query(f"""SELECT id, CASE WHEN c IS NULL OR c = '' THEN 0 ELSE CAST(CAST({_VALID} AS BIGINT) % 11 % 10 = CAST(substr(c, 11, 1) AS BIGINT) AS INT) END AS valid,
  CASE WHEN voyage = '0' THEN 'placeholder_voyage' ELSE '' END AS reason FROM (SELECT id, voyage, nullif(upper(trim(container_no)), '') AS c FROM :gate_raw:)""")
def sql_functions_on_events(v):
    sql_functions.register(v.spark)
    return v.spark.sql("SELECT id, coalesce(iso6346_valid(container_no), 0) AS valid, gate_history_invalid_reason(vesselcode, voyage) AS reason FROM {gate}", gate=v("gate_raw"))


@query("SELECT status, count(*) AS n FROM :history_candidates: GROUP BY status")
def preset_candidate_states(v):
    return v("history_candidates").groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT status, count(*) AS n FROM :capture_jobs: GROUP BY status")
def preset_job_states(v):
    return v("capture_jobs").groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT * FROM (SELECT p_brand AS algorithm, count(*) AS sample_count, count(DISTINCT p_type) AS cluster_count FROM part GROUP BY p_brand) ORDER BY sample_count DESC, algorithm LIMIT 5")
def preset_latest_clusters(v):
    records = v("part").groupBy(F.col("p_brand").alias("algorithm")).agg(F.count("*").alias("sample_count"), F.countDistinct("p_type").alias("cluster_count"))
    return records.orderBy(F.desc("sample_count"), "algorithm").limit(5)


@query("""SELECT DISTINCT container_no FROM (SELECT upper(trim(container_no)) AS container_no FROM :gate_raw: g WHERE trim(container_no) <> '' AND NOT EXISTS (SELECT 1 FROM :quarantined: q WHERE q.vesselcode = g.vesselcode AND q.voyage = g.voyage))
WHERE CAST(""" + _VALID.replace("substr(c,", "substr(container_no,") + """ AS BIGINT) % 11 % 10 <> CAST(substr(container_no, 11, 1) AS BIGINT) ORDER BY container_no LIMIT 100""")
def preset_invalid_containers(v):
    return joins.container_catalog(v("gate_raw"), v("quarantined")).filter("status = 'invalid'").select("container_no").orderBy("container_no").limit(100)


@query("SELECT time_bucket, value, quality_flag FROM :curves: WHERE curve_type = 'orders' AND granularity = 'weekly' AND entity_key = 'NATION_6' ORDER BY time_bucket DESC LIMIT 260")
def curve_slice(v):
    rows = v("curves").filter("curve_type = 'orders' AND granularity = 'weekly' AND entity_key = 'NATION_6'")
    return rows.select("time_bucket", "value", "quality_flag").orderBy(F.desc("time_bucket")).limit(260)


@query("SELECT DISTINCT curve_type, granularity, entity_key FROM :curves:")
def curve_names(v):
    return v("curves").select("curve_type", "granularity", "entity_key").distinct()


@query("SELECT * FROM (SELECT o_orderkey AS run_id, o_orderdate AS started_at, o_orderstatus AS status FROM orders) ORDER BY started_at DESC, run_id LIMIT 40")
def latest_runs(v):
    return v("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"), F.col("o_orderstatus").alias("status")).orderBy(F.desc("started_at"), "run_id").limit(40)


_CUTOFF = dt.datetime(2005, 6, 30, 23, 59, 59)


@query("""WITH v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY observed_at DESC, version_id DESC) AS r FROM :flow_versions: WHERE observed_at <= TIMESTAMP '2005-06-30 23:59:59') WHERE r = 1),
f AS (SELECT flow_date, terminal, direction, '' AS route, '' AS cargo_group, 1 AS a, weight_kg AS b, 0 AS c, 0 AS d, 0 AS e FROM v UNION ALL SELECT flow_date, terminal, direction, '', '', 0, 0, 1, 0, 0 FROM v
  UNION ALL SELECT flow_date, terminal, '', route, 'UNKNOWN', 0, 0, 0, 1, 0 FROM v UNION ALL SELECT flow_date, terminal, direction, '', '', 0, 0, 0, 0, 1 FROM v)
SELECT flow_date, terminal, direction, route, CAST(sum(a) AS BIGINT) AS vgm_count, round(CAST(sum(b) AS DOUBLE), 6) AS vgm_weight_kg, CAST(sum(c) AS BIGINT) AS release_count, CAST(sum(d) AS BIGINT) AS transship_count, CAST(sum(e) AS BIGINT) AS planned_calls, TIMESTAMP '2005-06-30 23:59:59' AS as_of_time
FROM f WHERE flow_date BETWEEN DATE '2000-01-01' AND DATE '2005-06-30' GROUP BY flow_date, terminal, direction, route, cargo_group""")
def flow_daily_as_of(v):
    rows, keys, order = v("flow_versions"), ["l_orderkey", "l_linenumber"], ["version_id"]
    none = F.lit(0).cast("decimal(18,4)")
    release = rows.select("*", F.lit("B").alias("bill_no"), *[none.alias(c) for c in ("weight", "volume", "pieces")])
    facts = {
        "vgm": rows.drop("route"), "release": release.drop("route"), "transship": rows.drop("direction").select("*", F.lit("C").alias("container_no"), none.alias("weight"), none.alias("volume")),
        "plans": rows.drop("route").select("*", F.lit(True).alias("arrived"), F.lit(None).cast("double").alias("arrival_delay_h"), F.lit(None).cast("double").alias("departure_delay_h")),
    }
    out = runs.daily_flow_as_of({n: (f, keys, order) for n, f in facts.items()}, _CUTOFF)
    return doubles(out.select("flow_date", "terminal", "direction", "route", "vgm_count", "vgm_weight_kg", "release_count", "transship_count", "planned_calls", "as_of_time"), "vgm_weight_kg")
