import datetime as dt
import json

from pyspark.sql import functions as F

from tidewright.operators import asof, cdc, gold, joins, models, normalize, profile, quality, sample, series
from tidewright.sources import landing, sinks

D = dt.datetime


def test_pages_rows_and_totals(spark):
    pages = spark.createDataFrame([("e", json.dumps({"data": {"total": 3, "list": [{"a": 1}, 5, {"b": "x"}]}})), ("e", json.dumps({"data": [{"c": 1}]})), ("e", "broken"), ("e", json.dumps({"data": {"total": "many"}}))], "endpoint string, body string")
    assert sorted(r.record for r in landing.page_rows(pages).collect()) == ['{"a":1}', '{"b":"x"}', '{"c":1}']
    assert [r.total for r in landing.page_total(pages).collect()] == [3, None, None, None]


def test_landing_is_idempotent(spark):
    pages = spark.createDataFrame([("e", "r", 1, "x"), ("e", "r", 1, "x"), ("e", "r", 1, "y"), ("e", "r", 2, "x")], "endpoint string, request string, page int, body string")
    landed = landing.land_pages(pages)
    assert landed.count() == 3 and landing.land_pages(pages, landed).count() == 0


def test_observed_fields_and_drift(spark):
    rows = spark.createDataFrame([("e", 1, '{"a": "1", "b": "x"}'), ("e", 2, '{"a": "z"}')], "endpoint string, seen_at int, record string")
    seen = landing.observed_fields(rows)
    assert {(r.field, r.first_seen, r.last_seen, r.sample_type) for r in seen.collect()} == {("a", 1, 2, "number"), ("b", 1, 1, "text")}
    drift = landing.schema_drift(seen.select("endpoint", "field"), spark.createDataFrame([("e", "a"), ("e", "c")], "endpoint string, field string"))
    assert {(r.field, r.drift) for r in drift.collect()} == {("b", "new"), ("c", "missing")}


def test_quarantined_events_stay_stored_but_unread(spark):
    events = spark.createDataFrame([("UNQ", "VQ", 1), ("UN1", "V1", 2)], "vesselcode string, voyage string, id int")
    bad = spark.createDataFrame([("UNQ", "VQ")], "vesselcode string, voyage string")
    assert [r.id for r in landing.without_quarantined(events, bad).collect()] == [2] and events.count() == 2


def test_normalize_release_and_vgm(spark):
    release = normalize.normalize_release(spark.createDataFrame([("B1", "12.5", "bad"), ("B2", "9", "318014000"), ("B3", "1", "-4")], "billno string, cargovolum string, grossweight string"))
    got = {r.bill_no: (r.piece_count, r.gross_weight, r.gross_weight_kg, r.weight_unit, r.weight_rule) for r in release.collect()}
    assert got == {"B1": (12.5, None, None, None, None), "B2": (9.0, 318014000.0, 318014000.0, "kg", "cargo-weight-kg-v1"), "B3": (1.0, -4.0, None, None, None)}
    vgm = normalize.normalize_vgm(spark.createDataFrame([("ABCU1234567", "16150.4", "20260728121047", "E"), ("X", "heavy", "", None)], "containerNumber string, vgmGrossWeight string, operatetime string, containerType string")).collect()
    assert (vgm[0].vgm_weight_kg, vgm[0].operator_time, vgm[0].direction, vgm[0].quality) == (16150.4, D(2026, 7, 28, 12, 10, 47), "E", "{}") and vgm[1].quality == '{"invalid_vgm_weight":true}'


def test_other_normalizers(spark):
    t = normalize.normalize_transshipment(spark.createDataFrame([("C", "unclassified cargo", "A", None, "B")], "ctnNo string, cargoDescription string, firstLoadPortCode string, firstDischargePortCode string, secondTransPortCode string"), {}, []).first()
    assert (t.cargo_group, t.route) == ("UNKNOWN", "A::B")
    e = normalize.normalize_container_event(spark.createDataFrame([("C", "ZZ")], "ctnno string, operateId string")).first()
    assert (e.event_type, e.event_code_raw, e.event_time) == ("UNKNOWN", "ZZ", None)
    plans = normalize.normalize_plan(spark.createDataFrame([("U", "1", "T", "E", "202601200000"), ("U", "1", "T", "E", "202602200000"), ("U", "1", None, "E", "1")], "vesselUnCode string, voyage string, terminal string, vesselDirect string, eta string")).collect()
    assert plans[0].business_key_hash == plans[1].business_key_hash != plans[2].business_key_hash and plans[0].record_hash != plans[1].record_hash
    notices = normalize.normalize_notice(spark.createDataFrame([("V", " TEST  SHIP ", "A,B"), ("V", " TEST  SHIP ", "B,A")], "vesselcode string, vesselename string, ediports string")).collect()
    assert notices[0].vessel_en_name == "TEST SHIP" and notices[0].record_hash == notices[1].record_hash


def test_extra_fields_and_dead_letters(spark):
    rows = spark.createDataFrame([({"id": " 1 ", "a": None, "z": "9", "y": " "},), ({"a": "x"},)], "record map<string,string>")
    out = normalize.split_extra(rows, ["id", "a"]).collect()
    assert [(r.id, r.a, r.extra) for r in out] == [("1", "", {"z": "9"})]
    good, bad = normalize.dead_letters(spark.createDataFrame([(1,), (-1,), (None,)], "x int"), {"positive": F.col("x") > 0})
    assert [r.x for r in good.collect()] == [1] and {r.reason for r in bad.collect()} == {"positive"} and bad.count() == 2


S = "id int, a string, t string"


def test_change_capture_paths_and_idempotence(spark):
    current = spark.createDataFrame([(1, "x", "1"), (2, "x", "1"), (3, "x", "1"), (4, "x", None)], S)
    incoming = spark.createDataFrame([(1, "x", "1"), (2, "x", "2"), (3, "y", "2"), (5, "n", "1"), (None, "q", "1"), (4, "x", "")], S)
    got = {r.id: (r.change_type, r.changed_fields) for r in cdc.capture_changes(current, incoming, "id", ["a", "t"], ("t",)).collect()}
    assert got == {1: ("unchanged", {}), 2: ("touched", {"t": ["1", "2"]}), 3: ("updated", {"a": ["x", "y"], "t": ["1", "2"]}), 5: ("new", None), None: ("skipped", None), 4: ("unchanged", {})}
    after = cdc.upsert(current, incoming, "id")
    assert {r.id for r in after.collect()} == {1, 2, 3, 4, 5}
    again = cdc.capture_changes(after, incoming.filter("id is not null"), "id", ["a", "t"])
    assert {r.change_type for r in again.collect()} == {"unchanged"}
    assert cdc.run_counters(cdc.capture_changes(current, incoming, "id", ["a", "t"], ("t",))).first().asDict() == {"seen": 6, "new": 1, "updated": 1, "touched": 1, "unchanged": 2, "skipped": 1}


def test_versions_and_merges(spark):
    seen = spark.createDataFrame([("k", 1, "a"), ("k", 2, "a"), ("k", 3, "b"), ("k", 4, "a"), ("m", 1, None), ("m", 2, None)], "key string, at int, h string")
    assert sorted((r.key, r.at) for r in cdc.new_versions(seen, ["key"], "h", ["at"]).collect()) == [("k", 1), ("k", 3), ("k", 4), ("m", 1), ("m", 2)]
    labels = spark.createDataFrame([("b+a", "c+a"), (None, "x"), ("", None)], "o string, n string").select(cdc.union_labels(F.col("o"), F.col("n")).alias("x"))
    assert [r.x for r in labels.collect()] == ["a+b+c", "x", ""]
    fresh, conflicts = cdc.append_new(spark.createDataFrame([(1, "a")], "id int, v string"), spark.createDataFrame([(1, "b"), (2, "c"), (2, "c"), (None, "d")], "id int, v string"), "id", ["v"])
    assert [r.id for r in fresh.collect()] == [2] and [r.id for r in conflicts.collect()] == [1]
    merged = cdc.merge_catalog(spark.createDataFrame([(1, 5, "a")], "k int, first int, name string"), spark.createDataFrame([(1, 3, None), (2, 9, "z")], "k int, first int, name string"), ["k"], {"first": F.least("old.first", "new.first"), "name": F.coalesce("new.name", "old.name")})
    assert sorted(map(tuple, merged.collect())) == [(1, 3, "a"), (2, 9, "z")]


def test_as_of_reads_grow_with_the_cutoff(spark):
    v = spark.createDataFrame([("k", D(2026, 1, 11), 1, 100), ("k", D(2026, 2, 11), 2, 200), ("m", D(2026, 2, 12), 3, 7)], "key string, observed_at timestamp, version_id int, w int")
    at = lambda c: {r.key: r.w for r in asof.as_of(v, ["key"], c, order=["version_id"]).collect()}
    assert at(D(2026, 1, 31)) == {"k": 100} and at(D(2026, 3, 1)) == {"k": 200, "m": 7} == at(None) and set(at(D(2026, 1, 31))) <= set(at(D(2026, 3, 1)))


def test_fingerprints(spark):
    rows = spark.createDataFrame([("20260101000000123456789", D(2026, 1, 1)), ("20260101000000000000001", D(2026, 1, 2))], "id string, t timestamp")
    f = asof.fingerprint(rows, "x", "id", "t")
    assert (f.first().n, f.first().sum_id) == (2, 123456790)
    g = asof.fingerprint(rows.limit(1), "x", "id", "t")
    assert asof.compare_fingerprints(f, f, ["n", "sum_id"]).first().moved == [] and asof.compare_fingerprints(f, g, ["n"]).first().moved == ["n"]
    digest = lambda d: asof.strict_digest(d, ["id", "t"]).first().digest
    assert digest(rows) == digest(rows.orderBy(F.desc("id"))) != digest(rows.limit(1)) != digest(rows.limit(0)) != digest(rows.unionByName(rows))


def test_gate_daily(spark):
    events = spark.createDataFrame([("GATE_IN", "E", "CSQU3054383", "45GP", "202601010800", None, "U", "1"), ("GATE_OUT", "E", "CSQU3054383", "45GP", "202501010000", "202601010900", "U", "1"), ("GATE_OUT", "I", "X", "ZZ", None, "202601010900", "U", "1"), ("GATE_IN", "E", "Q", "22", "202601010800", None, "UQ", "1")], "type string, direction string, container_no string, size_code string, in_time string, out_time string, vesselcode string, voyage string")
    got = {r.direction: r for r in gold.gate_daily(events, spark.createDataFrame([("UQ", "1")], "vesselcode string, voyage string")).collect()}
    e = got["E"]
    assert (e.in_count, e.out_count, e.unique_containers, e.in_teu, e.out_teu, e.flow_date) == (1, 1, 1, 2.0, 2.0, dt.date(2026, 1, 1)) and got["I"].out_teu_known == 0
    assert gold.gate_coverage(gold.gate_daily(events, events.select("vesselcode", "voyage").limit(0))).first().coverage == 0.75


def test_plans_count_once_and_delays_are_bounded(spark):
    plans = spark.createDataFrame([("V", "1", "T", "E", D(2026, 1, 1), 1), ("V", "1", "T", "E", D(2026, 2, 1), 2)], "vessel_code string, voyage string, terminal string, direction string, snapshot_time timestamp, id int")
    assert [r.id for r in gold.latest_plans(plans, ["id"]).collect()] == [2]
    d = spark.createDataFrame([(D(2026, 1, 1), D(2026, 1, 2)), (D(2026, 1, 2), D(2026, 1, 1)), (D(2026, 1, 1), D(2026, 3, 1)), (None, D(2026, 1, 1))], "p timestamp, a timestamp").select(gold.delay_hours(F.col("p"), F.col("a")).alias("h"))
    assert [r.h for r in d.collect()] == [24.0, None, None, None]
    dates = spark.createDataFrame([(dt.date(1999, 1, 1),), (dt.date(2026, 1, 1),), (dt.date(2027, 1, 1),)], "d date").filter(gold.allowed_date(F.col("d"), dt.date(2026, 1, 1)))
    assert dates.count() == 1


def curves(spark, values, entity="E", kind="orders", flag="complete"):
    return spark.createDataFrame([(kind, entity, "weekly", "v1", dt.date(2026, 1, 5) + dt.timedelta(days=7 * i), None if v is None else float(v), flag) for i, v in enumerate(values)], "curve_type string, entity_key string, granularity string, model_version string, time_bucket date, value double, quality_flag string")


def brute_changes(v, threshold):
    n, mean = len(v), sum(v) / len(v)
    sd = (sum((x - mean) ** 2 for x in v) / n) ** 0.5 or 1.0
    return [i for i in range(2, n - 2) if abs(sum(v[i:]) / (n - i) - sum(v[:i]) / i) / sd >= threshold]


def test_change_points_equal_the_formula(spark):
    for v in ([1.0, 1, 1, 9, 9, 9, 9, 2], [1.0, 2, 3, 4], [5.0] * 7):
        got = series.change_points(curves(spark, v), 0.5).collect()
        assert sorted((r.time_bucket - dt.date(2026, 1, 5)).days // 7 for r in got) == (brute_changes(v, 0.5) if len(v) >= 5 else [])


def test_nulls_do_not_shift_change_points(spark):
    v = [None, 1.0, 1, 1, 9, 9, 9]
    got = series.change_points(curves(spark, v), 0.5).collect()
    assert sorted((r.time_bucket - dt.date(2026, 1, 5)).days // 7 for r in got) == [i + 1 for i in brute_changes(v[1:], 0.5)]


def test_granularities_are_apart(spark):
    a = curves(spark, [1.0, 2, 3])
    b = a.withColumn("granularity", F.lit("daily")).withColumn("value", F.col("value") * 100)
    z = series.with_zscore(a.unionByName(b)).groupBy("granularity").agg(F.sum("z").alias("s"))
    assert all(abs(r.s) < 1e-9 for r in z.collect())


def test_trends_anomalies_and_cards(spark):
    t = series.trends(curves(spark, [10.0, 10, 10, 10, 10, 20])).first()
    assert (t.state, t.g4, t.g13) == ("growth", 1.0, None) and series.trends(curves(spark, [1.0] * 6, flag="partial")).first().state == "data_insufficient"
    assert series.anomalies(curves(spark, [1.0, 1, 1, 1, 1, 9]), 2.0).count() == 1 and series.anomalies(curves(spark, [3.0] * 5), 0.0).count() == 0
    assert series.latest_average(curves(spark, [1.0, 2, 3, 4, 5])).first().latest_avg == 3.5
    assert series.recent_buckets(curves(spark, [1.0] * 9), 4).count() == 4


def test_completeness_and_pressure(spark):
    gap = curves(spark, [1.0, 2, 3, 4]).filter("value <> 2")
    r = series.with_completeness(gap, 7).first()
    assert (r.expected, r.observed, r.quality_flag) == (4, 3, "partial")
    both = curves(spark, [1.0, 2, 3], kind="vgm").unionByName(curves(spark, [3.0, 2, 1], kind="plan_revision"))
    p = series.pressure_index(series.with_zscore(both)).orderBy("time_bucket").collect()
    assert [round(x.value, 4) for x in p] == [-1.2247, 0.0, 1.2247] and "plan_revision" not in p[0].contributions and "departure_delay" in p[0].missing and abs(sum(p[0].contributions.values()) - p[0].value) < 1e-9
    assert abs(series.pressure_index(series.with_zscore(both), include_revision=True).orderBy("time_bucket").first().value) < 1.0


def test_revisions_follow_time_within_an_identity(spark):
    rows = spark.createDataFrame([("V", "1", "T", "E", D(2026, 1, i), h) for i, h in ((1, "a"), (2, "b"), (3, "b"), (4, "a"))], "vessel_code string, voyage string, terminal string, direction string, snapshot_time timestamp, record_hash string")
    got = series.revision_points(rows, []).collect()
    assert sorted(r.flow_date.day for r in got) == [2, 4] and {r.direction for r in got} == {""}


def test_features_and_clusters(spark):
    all_ = curves(spark, [1.0 + i for i in range(8)], "a").unionByName(curves(spark, [10.0 + i for i in range(8)], "b")).unionByName(curves(spark, [20.0 + i for i in range(8)], "c"))
    f = series.features(all_)
    got = {r.entity_key: r for r in f.collect()}
    assert len(got) == 3 and abs(got["a"].slope - 1) < 1e-9 and abs(got["a"].autocorr_1 - 1) < 1e-9 and got["a"].median == 4.5
    labelled = models.cluster(f, k=2)
    assert labelled.count() == 3 and labelled.select("cluster_id").distinct().count() == 2 and models.silhouette(labelled) is not None
    assert models.cluster(f.limit(1)).count() == 0 and models.silhouette(models.cluster(f, k=3)) is None


def test_neighbours_are_exact_and_chains_settle(spark):
    import random

    from pyspark.ml.linalg import Vectors

    rng = random.Random(3)
    points = {i: [rng.uniform(0, 6) for _ in range(3)] for i in range(150)}
    data = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in points.items()], ["k", "vector"])
    want = {(a, b) for a, p in points.items() for b, q in points.items() if sum((x - y) ** 2 for x, y in zip(p, q)) <= 1.21}
    assert {(r.a, r.b) for r in models.neighbours(data, "k", 1.1, 3).collect()} == want
    chain = spark.createDataFrame([(i, float(i)) for i in range(90)], "k int, x double")
    got = models.density_cluster(chain, "k", 0.05, 3, names=["x"]).collect()
    assert {r.cluster_id for r in got} == {1}


def test_density_clusters_and_consensus(spark):
    points = spark.createDataFrame([(f"p{i}", float(i // 5) * 50 + i % 5 * 0.1) for i in range(10)] + [("far", 1000.0)], "entity_key string, mean double")
    got = {r.entity_key: (r.cluster_id, r.is_outlier) for r in models.density_cluster(points, "entity_key", 0.05, 3, ["mean"]).collect()}
    assert got["far"] == (None, True) and len({got[f"p{i}"][0] for i in range(5)}) == 1 and got["p0"][0] != got["p9"][0]
    runs = spark.createDataFrame([(1, "a", 0), (1, "b", 0), (2, "a", 0), (2, "b", 1)], "run_id int, entity_key string, cluster_id int")
    assert [tuple(r) for r in models.co_assignment(runs).collect()] == [("a", "b", 0.5)]


def test_similar_history(spark):
    both = curves(spark, [1.0, 5, 1, 5, 1, 5], "a").unionByName(curves(spark, [9.0, 1, 5, 1, 5, 9], "b"))
    got = models.similar_history(both, "a", 4, 2).collect()
    assert got[0].distance == 0.0 and {r.entity_key for r in got} <= {"a", "b"}


def test_profiles(spark):
    t = spark.createDataFrame([("a", "x", None), ("a", "x", " "), ("b", "y", None)], "k string, v string, dead string")
    c = {r["name"]: (r.filled, r.distinct_values, r.status) for r in profile.columns(t, ["k", "v", "dead"]).collect()}
    assert c == {"k": (3, 2, "used"), "v": (3, 2, "used"), "dead": (0, 0, "dead")}
    assert {r["name"]: r.violating_groups for r in profile.dependency_violations(t, ["k"], ["v", "dead"]).collect()} == {"v": 0, "dead": 1}
    assert profile.invariants(t, {"r": F.col("k") == "a"}).first().counter_examples == 1
    assert profile.pair_differences(t, ["k"], ["v"], F.col("v") == "x").first()["pairs"] == 1


def test_page_ledger(spark):
    rows = [("ok", 1, 2, 5), ("ok", 2, 2, 6), ("ok", 3, 1, 6), ("gap", 1, 2, 4), ("gap", 3, 2, 4), ("shrunk", 1, 2, 4), ("shrunk", 2, 2, 3), ("short", 1, 1, 4), ("short", 2, 2, 4), ("empty", 1, 0, 4), ("cut", 1, 2, 4)]
    got = {r.job: r.fault for r in quality.page_ledger(spark.createDataFrame(rows, "job string, page int, row_count int, total int"), 2).collect()}
    assert got == {"ok": None, "gap": "gap", "shrunk": "total_shrank", "short": "short_page", "empty": "empty_page", "cut": "incomplete"}


def test_page_repeats_and_attribution(spark):
    pages = spark.createDataFrame([("e", "f", 1, "x"), ("e", "f", 2, "y"), ("e", "f", 3, "x"), ("e", "f", 4, "z")], "endpoint string, fingerprint string, page int, payload_hash string")
    assert quality.repeated_pages(pages).first().repeats == 1 and [r.adjacent_repeat for r in quality.adjacent_repeats(pages).orderBy("page").collect()] == [False, False, True, False]
    assert quality.misattributed(spark.createDataFrame([(1, "a", "a"), (1, "a", None)], "q int, x string, y string"), "q", ["x"], ["y"]).first()["foreign"] == 1


def test_quarantine_is_idempotent(spark):
    none = spark.createDataFrame([], "v string, reason string")
    found = spark.createDataFrame([("UN7", "hit", 1633402), ("UNR", "complete", 80000)], "v string, status string, total int")
    buckets = spark.createDataFrame([("UN7", "transship"), ("UNV", "virtual")], "v string, bucket string")
    once = quality.quarantine(none, found, buckets, ["v"], 50000)
    want = {"UN7": "oversized+transship", "UNV": "virtual"}
    assert {r.v: r.reason for r in once.collect()} == want == {r.v: r.reason for r in quality.quarantine(once, found, buckets, ["v"], 50000).collect()}


def test_jobs_status_and_order(spark):
    c = spark.createDataFrame([("U", 1, None)], "v string, total_in int, total_out int")
    assert {(r.direction, r.planned_total) for r in quality.direction_jobs(c, ["v"]).collect()} == {("GATE_IN", 1), ("GATE_OUT", None)}
    flags = quality.order_flags(spark.createDataFrame([(2, 1), (1, None)], "a int, b int"), {"late": ("a", "b")})
    assert [r.late for r in flags.collect()] == [True, False]
    assert {r.status: r.n for r in quality.status_counts(spark.createDataFrame([("pending",), ("pending",), ("complete",)], "status string"), "status").collect()} == {"pending": 2, "complete": 1}


def test_gap_keeps_multiplied_rows(spark):
    gate = spark.createDataFrame([("c1", "U", "1"), ("c2", "U", "1"), ("c3", "UQ", "1")], "container_no string, vesselcode string, voyage string")
    customs = spark.createDataFrame([("c1", "t"), ("c1", "t2"), ("c2", None)], "container_no string, received string")
    m = joins.match_gate_to_customs(gate, customs, ["container_no"], "received")
    assert joins.gap_summary(m, ("vesselcode", "voyage")).first().asDict() == {"matched": 2, "gap": 2, "gap_pairs": 2}
    bad = spark.createDataFrame([("UQ", "1")], "vesselcode string, voyage string")
    assert [r.container_no for r in joins.gate_gap(gate, customs, ["container_no"], "received", bad, ("vesselcode", "voyage")).collect()] == ["c2"]


def test_dwell_and_active_voyages(spark):
    rows = spark.createDataFrame([("c", "GATE_IN", D(2026, 1, 1)), ("c", "GATE_OUT", D(2026, 1, 2)), ("c", "GATE_OUT", D(2026, 1, 3)), ("d", "GATE_IN", D(2026, 1, 1))], "container_no string, type string, t timestamp")
    assert [r.hours for r in joins.dwell(rows, ["container_no"], "type", "t").collect()] == [24.0]
    now = D(2026, 1, 15)
    v = spark.createDataFrame([(1, D(2026, 1, 10), None, 1), (2, D(2025, 1, 1), None, 1), (3, None, D(2026, 1, 10), 1), (4, None, D(2025, 1, 1), 1), (5, D(2025, 1, 1), None, 0), (6, None, None, 1)], "id int, portclose_at timestamp, last_change_at timestamp, backfilled int")
    assert sorted(r.id for r in joins.active_voyages(v, now).collect()) == [1, 3, 5, 6]


def test_candidates(spark):
    plans = spark.createDataFrame([(" UN1 ", " OLD1 "), ("UN1", "OLD1"), ("UN1", "CURRENT"), ("UN2", "OLD2"), ("0", "2501E"), ("UN3", "/"), ("XX1234567", "2503E")], "vesselcode string, voyage string").withColumns({"eta": F.lit(dt.date(2026, 1, 1)), "vessel_en_name": F.lit("n")})
    catalog = spark.createDataFrame([("UN1", "CURRENT")], "vesselcode string, voyage string")
    from tidewright.functions.codes import invalid_pair_reason

    good, bad = joins.discover_candidates(plans, catalog, invalid_pair_reason(F.col("vesselcode"), F.col("voyage")))
    assert {(r.vesselcode, r.voyage, r.source_plan_rows, r.vessel_in_catalog) for r in good.collect()} == {("UN1", "OLD1", 2, True), ("UN2", "OLD2", 1, False), ("XX1234567", "2503E", 1, False)} and bad.count() == 2


def test_samples_do_not_depend_on_order(spark):
    rows = spark.createDataFrame([(f"{p}{i}", f"V{i}") for p, n in (("UN", 8), ("FC", 5), ("CN", 2)) for i in range(n)], "vesselcode string, voyage string")
    cols = ["vesselcode", "voyage"]
    a, b = (sample.stable_sample(r, cols, 7, "s") for r in (rows, rows.orderBy(F.desc("voyage"))))
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()} and a.count() == 7
    assert sample.manifest_fingerprint(a, cols, digits=16).first().fingerprint == sample.manifest_fingerprint(b, cols, digits=16).first().fingerprint
    s = sample.stratified_sample(rows, cols, F.substring("vesselcode", 1, 2), {"UN": 4, "FC": 3, "CN": 2}, "s")
    assert {r.stratum: r.n for r in s.groupBy("stratum").agg(F.count("*").alias("n")).collect()} == {"UN": 4, "FC": 3, "CN": 2} and len(sample.manifest_fingerprint(s.select(*cols), cols, "\t").first().fingerprint) == 64


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "r1", 1), (2, "r2", 2)], "id int, run_id string, started_at int")
    sinks.write_csv(rows, str(tmp_path / "a"))
    assert spark.read.option("header", True).csv(str(tmp_path / "a")).count() == 2
    sinks.write_run_changes(rows.limit(0), str(tmp_path / "b"))
    sinks.write_run_changes(rows, str(tmp_path / "b"))
    assert sorted(p.name for p in (tmp_path / "b").glob("run_id=*")) == ["run_id=r1", "run_id=r2"]
    assert [r.run_id for r in sinks.runs_to_keep(rows.withColumn("kind", F.lit("k")), 1).collect()] == ["r2"]
    assert "| n | 1 |" in sinks.write_report(spark.createDataFrame([("n", "1")], "name string, value string"), str(tmp_path / "c"))


def test_key_prefixes_repeat_no_row_and_count_missing_values(spark):
    rows = [(i % 7 or None, i % 3, i % 5) for i in range(200)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "a int, b int, c int")
    found = profile.key_prefixes(df, ["a", "b", "c"])
    assert {r["columns"]: (r["distinct_keys"], r["n"]) for r in found.collect()} == {",".join("abc"[: k + 1]): (len({r[: k + 1] for r in rows}), 203) for k in range(3)}
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["distinct_keys"], r["n"]) for r in profile.key_prefixes(df.limit(0), ["a", "b"]).collect()} == {(0, 0)}


def test_latest_sorts_nothing_before_its_shuffle(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, 4), ("b", 1, 3), (None, 1, 2), (None, None, 1), ("c", None, 0)], "k string, t int, v int")
    found = asof.latest(rows, ["k"], ["t"])
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.filter("v in (4, 3, 2, 0)").collect()))
    assert "WindowGroupLimit" not in found._jdf.queryExecution().executedPlan().toString()
