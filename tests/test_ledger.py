"""Life cycles, metrics, dashboard data, clusters' overviews and other operators that queries alone don't show."""

import datetime as dt

from pyspark.sql import functions as F

from tidewright.operators import cdc, dashboard, ledger, metrics, models

T = lambda d: dt.datetime(2026, 1, d)
CANDIDATE = "vesselcode string, voyage string, vessel_en_name string, status string, attempt_count int, probed_at timestamp, in_total bigint, out_total bigint, updated_at timestamp"
VOYAGE = "vesselcode string, voyage string, vesselename string, first_seen_at timestamp, last_seen_at timestamp, in_done_at timestamp, in_total bigint, out_done_at timestamp, out_total bigint, inactive int"


def by_key(df, *columns):
    return {r["vesselcode"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_life_of_a_candidate(spark):
    """Probed, found, promoted, read in both directions, complete; another is empty; a rejected one stays."""
    start = spark.createDataFrame([(c, "1", n, "pending", 0, None, None, None, T(1)) for c, n in (("A", "ship"), ("B", ""), ("R", "x"))], CANDIDATE)
    probes = spark.createDataFrame([("A", "1", T(2), 0, None), ("A", "1", T(3), 5, None), ("B", "1", T(2), 0, 0), ("Z", "1", T(2), 9, 9)], "vesselcode string, voyage string, at timestamp, in_total bigint, out_total bigint")
    probed = ledger.note_probes(start, probes)
    assert by_key(probed, "status", "attempt_count", "probed_at", "in_total", "out_total") == {"A": ("hit", 2, T(3), 5, None), "B": ("pending", 1, T(2), 0, 0), "R": ("pending", 0, None, None, None)}
    done = ledger.finish_candidates(probed, spark.createDataFrame([("B", "1", T(4), "empty", 0, 0), ("A", "1", T(4), "unknown", 1, 1)], "vesselcode string, voyage string, at timestamp, status string, in_total bigint, out_total bigint"))
    assert by_key(done, "status", "updated_at") == {"A": ("hit", T(3)), "B": ("empty", T(4)), "R": ("pending", T(1))}
    catalog = spark.createDataFrame([("R", "1", "old", T(1), T(1), T(1), 1, T(1), 1, 1)], VOYAGE)
    catalog = ledger.promote_hits(catalog, done, T(5))
    assert by_key(catalog, "vesselename", "first_seen_at", "inactive") == {"A": ("ship", T(5), 0), "R": ("old", T(1), 1)}
    marks = spark.createDataFrame([("A", "1", "GATE_IN", T(6), 5), ("A", "1", "GATE_IN", T(7), 6), ("A", "1", "GATE_OUT", T(7), 0)], "vesselcode string, voyage string, direction string, at timestamp, total bigint")
    catalog = ledger.mark_directions(catalog, marks)
    assert by_key(catalog, "in_done_at", "in_total", "out_done_at", "out_total") == {"A": (T(7), 6, T(7), 0), "R": (T(1), 1, T(1), 1)}
    rejected = spark.createDataFrame([("R", "1")], "vesselcode string, voyage string")
    assert by_key(ledger.complete_filled(done, catalog, rejected, T(8)), "status", "updated_at") == {"A": ("complete", T(8)), "B": ("empty", T(4)), "R": ("pending", T(1))}
    counts = {r["status"]: r["n"] for r in ledger.candidate_counters(done, rejected).collect()}
    assert counts == {"pending": 0, "hit": 1, "empty": 1, "complete": 0, "total": 2, "rejected": 1}
    empty = {r["status"]: r["n"] for r in ledger.candidate_counters(done.limit(0), rejected.limit(0)).collect()}
    assert set(empty.values()) == {0} and len(empty) == 6
    events = spark.createDataFrame([("A", "1", "GATE_IN", "2"), ("A", "1", "GATE_OUT", " "), ("R", "1", "GATE_IN", "1")], "vesselcode string, voyage string, type string, received_time string")
    assert ledger.gate_counters(catalog, events, rejected).first().asDict() == {"voyages": 1, "voyages_done": 1, "voyages_inactive": 0, "voyages_quarantined": 1, "events": 2, "events_in": 1, "events_out": 1, "events_quarantined": 1, "first_event": "2", "last_event": "2"}


def test_seeding_merges_evidence_and_keeps_totals(spark):
    schema = "vesselcode string, voyage string, vessel_name string, first_eta date, last_eta date, source_plan_rows bigint, reason string, evidence map<string,string>"
    d = lambda i: dt.date(2026, 1, i)
    old = spark.createDataFrame([("A", "1", "ship", d(5), d(9), 3, "oversized", {"total": "9", "old": "x"})], schema).withColumns({"discovered_at": F.lit(T(1)), "updated_at": F.lit(T(1))})
    jobs = spark.createDataFrame([("A", "1", "GATE_IN", None, 10, "partial"), ("A", "1", "GATE_OUT", 7, 10, "complete")], "vesselcode string, voyage string, direction string, planned_total bigint, page_cap int, status string")
    found = spark.createDataFrame([("A", "1", "", d(3), d(6), 2, "transship", {"total": "10"}, 4, 99, 5), ("N", "2", "new", d(1), d(1), 1, "", {}, None, 2, 5)], schema + ", in_total bigint, out_total bigint, page_cap int")
    candidates, after = ledger.seed_jobs(old, jobs, found, T(2))
    assert by_key(candidates, "vessel_name", "first_eta", "last_eta", "source_plan_rows", "reason", "evidence", "discovered_at", "updated_at") == {
        "A": ("ship", d(3), d(9), 3, "oversized+transship", {"old": "x", "total": "10"}, T(1), T(2)), "N": ("new", d(1), d(1), 1, "", {}, T(2), T(2)),
    }
    assert sorted(tuple(r) for r in after.select("vesselcode", "direction", "planned_total", "page_cap", "status").collect()) == [
        ("A", "GATE_IN", 4, 10, "partial"), ("A", "GATE_OUT", 7, 10, "complete"), ("N", "GATE_IN", None, 5, "pending"), ("N", "GATE_OUT", 2, 5, "pending"),
    ]


def test_runs_are_closed_and_finished(spark):
    runs = spark.createDataFrame([(1, "gate", "running", None, None), (2, "full", "running", None, None), (3, "gate", "ok", T(1), None)], "run_id int, kind string, status string, finished_at timestamp, error string")
    assert {r["run_id"]: (r["status"], r["finished_at"]) for r in ledger.close_stale(runs, "gate", T(2)).collect()} == {1: ("interrupted", T(2)), 2: ("running", None), 3: ("ok", T(1))}
    counted = runs.withColumns({c: F.lit(None).cast("bigint") for c in ("seen", "new", "updated", "touched", "unchanged")})
    outcome = spark.createDataFrame([(2, "ok", T(3), 5, None, 1, 0, 4)], "run_id int, status string, finished_at timestamp, seen bigint, new bigint, updated bigint, touched bigint, unchanged bigint")
    rows = {r["run_id"]: r for r in ledger.finish_runs(counted, outcome).collect()}
    assert (rows[2]["status"], rows[2]["seen"], rows[2]["new"], rows[2]["unchanged"]) == ("ok", 5, 0, 4) and rows[1]["seen"] is None
    voyages = spark.createDataFrame([("A", "1", None), ("B", "1", T(2)), ("C", "1", T(3)), ("A", "0", None)], "vesselcode string, voyage string, last_event_at timestamp")
    assert [(r["vesselcode"], r["voyage"]) for r in ledger.voyages_in_order(voyages).collect()] == [("C", "1"), ("B", "1"), ("A", "0"), ("A", "1")]


def test_dashboard_withholds_gates_and_odd_values(spark):
    day = dt.date(2026, 1, 5)
    rows = [("planned_demand", f"T{i}:E", day, float(i)) for i in range(12)] + [("gate_in_teu", "ALL:E", day, 5.0), ("arrival_delay", "T1:E", day, 900.0), ("arrival_delay", "T2:E", day, 10.0), ("cargo_release", "T1:E", day, 2500.0), ("cargo_release", "T2:E", day, float("inf")), ("pressure_index", "T11:E", day, 1.5), ("pressure_index", "T0:E", day, 1.5)]
    curves = spark.createDataFrame([(c, e, "week", "v1", b, v) for c, e, b, v in rows] + [("planned_demand", "T1:E", "week", "v1", dt.date(2020, 1, 6), 1e9)], "curve_type string, entity_key string, granularity string, model_version string, time_bucket date, value double")
    got = {(r["section"], r["name"]): r["value"] for r in dashboard.dashboard_points(curves, day).collect()}
    assert got == {("traffic", "planned_demand"): 66.0, ("cargo", "cargo_release"): 2.5, ("delays", "arrival_delay"): 10.0, ("pressure", "T11:E"): 1.5} | {("terminals", f"T{i}:E"): float(i) for i in range(4, 12)}
    assert ("gate", "gate_in_teu") in {(r["section"], r["name"]) for r in dashboard.dashboard_points(curves, day, coverage_validated=True).collect()}
    states = spark.createDataFrame([("c", "complete", "pending", 3)], "container_no string, vgm_status string, history_status string, gate_event_count bigint")
    cards = {r["name"]: r["value"] for r in dashboard.dashboard_cards(curves, states, day).collect()}
    assert cards == {"planned": 66.0, "released": None, "arrival": 10.0, "containers": 1.0}
    gate = spark.createDataFrame([(day, 3, 1, 2, 1)], "flow_date date, in_count bigint, out_count bigint, in_teu_known bigint, out_teu_known bigint")
    coverage = {r["name"]: r["value"] for r in dashboard.dashboard_coverage(curves, states, gate, day).collect()}
    assert coverage == {"catalog_containers": "1", "vgm_queried": "1", "history_queried": "0", "gate_source_rows": "3", "gate_start": "2026-01-05", "gate_end": "2026-01-05", "teu_size_coverage": "0.750000", "displayed_points": "19", "gate_observed_points": "1", "gate_history_validated": "false"}


def test_trimmed_curves_and_choice_of_k(spark):
    day = dt.date(2026, 1, 5)
    weeks = [day + dt.timedelta(weeks=i) for i in range(6)]
    rows = [("vgm", e, w, 0.0 if i in (0, 5) else base + i) for e, base in (("a", 1.0), ("b", 1.1), ("c", 50.0), ("d", 50.2)) for i, w in enumerate(weeks)] + [("dead", "a", w, 0.0) for w in weeks]
    curves = spark.createDataFrame(rows, "curve_type string, entity_key string, time_bucket date, value double")
    live = metrics.trimmed(metrics.without_dead(curves))
    assert {(r["curve_type"], r["time_bucket"]) for r in live.collect()} == {("vgm", w) for w in weeks[1:5]}
    features = live.groupBy("entity_key").agg(F.avg("value").alias("mean"))
    k, scores = models.choose_k(features, [2, 3], names=["mean"])
    assert k == 2 and scores[2] > 0.9
    soft = models.soft_clusters(features, 2, names=["mean"]).collect()
    assert {r["entity_key"]: r["cluster_id"] for r in soft if r["entity_key"] in "ab"}.values().__len__() == 2 and len({r["cluster_id"] for r in soft}) == 2
    labelled = spark.createDataFrame([(1, False), (1, True), (None, True)], "cluster_id int, is_outlier boolean")
    assert {r["cluster_id"]: (r["entities"], r["outliers"]) for r in models.cluster_overview(labelled).collect()} == {1: (2, 1), None: (1, 1)}


def test_facts_without_a_version(spark):
    facts = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h3")], "k string, h string")
    versions = spark.createDataFrame([("a", "h1"), ("b", "h1")], "k string, h string")
    assert {r["k"] for r in cdc.missing_versions(facts, versions, ["k"], "h").collect()} == {"b", "c"}
