import datetime as dt

from pyspark.sql import functions as F

from tidewright.functions import sql, text
from tidewright.operators import gold, joins, runs
from tidewright.plans.bindings import ask
from tidewright.sources import sinks
from tidewright.streaming import streams

D = dt.datetime


def test_days_are_rebuilt_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "daily")
    day = lambda d, v: (dt.date(2026, 1, d), v)
    make = lambda rows: spark.createDataFrame(rows, "flow_date date, vgm_count int")
    make([day(1, 1), day(2, 2), day(3, 3), day(4, 4)]).write.partitionBy("flow_date").parquet(path)
    runs.rebuild_days(make([day(2, 20), day(4, 40)]), path, "flow_date", dt.date(2026, 1, 2), dt.date(2026, 1, 3))
    assert sorted((r.flow_date.day, r.vgm_count) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 20), (4, 4)]


def test_gold_is_rebuilt_whole_or_in_part(spark, tmp_path):
    vgm = spark.createDataFrame([(dt.date(2026, 1, d), "T", "E", 1.0) for d in (1, 2, 9)], "flow_date date, terminal string, direction string, weight_kg double")
    none = spark.createDataFrame([], "flow_date date, bill_no string, weight double, weight_kg double, volume double, pieces double")
    moves = spark.createDataFrame([], "flow_date date, container_no string, weight double, volume double")
    plans = spark.createDataFrame([], "flow_date date, arrived boolean, arrival_delay_h double, departure_delay_h double")
    gate = spark.createDataFrame([(1,)], "n int")
    daily = gold.daily_flow(vgm, none, moves, plans, dt.date(2026, 1, 1))
    assert runs.rebuild_gold(daily, gate, str(tmp_path)) == {"daily": 3, "weekly": 2, "gate_daily": 1}
    assert runs.rebuild_gold(daily.filter("flow_date = '2026-01-01'"), gate, str(tmp_path), dt.date(2026, 1, 1), dt.date(2026, 1, 5)) == {"daily": 2, "weekly": 2, "gate_daily": 1}


def test_as_of_gold_grows_with_the_cutoff(spark):
    rows = [(1, D(2026, 1, 1), 1, 5.0), (1, D(2026, 1, 3), 2, 7.0), (2, D(2026, 1, 2), 3, 1.0)]
    vgm = spark.createDataFrame([(k, at, v, dt.date(2026, 1, 1), "T", "E", w) for k, at, v, w in rows], "k int, observed_at timestamp, version_id int, flow_date date, terminal string, direction string, weight_kg double")
    empty = lambda ddl: spark.createDataFrame([], f"k int, observed_at timestamp, version_id int, flow_date date, {ddl}")
    facts = {"vgm": vgm, "release": empty("bill_no string, weight double, weight_kg double, volume double, pieces double"), "transship": empty("container_no string, weight double, volume double"), "plans": empty("arrived boolean, arrival_delay_h double, departure_delay_h double")}
    total = lambda day: [(r.vgm_count, r.vgm_weight_kg, r.as_of_time) for r in runs.daily_flow_as_of({n: (f, ["k"], ["version_id"]) for n, f in facts.items()}, D(2026, 1, day)).collect()]
    assert total(1) == [(1, 5.0, D(2026, 1, 1))] and total(2) == [(2, 6.0, D(2026, 1, 2))] and total(3) == [(2, 8.0, D(2026, 1, 3))]


def test_reconcile_finds_what_windows_pass_by(spark):
    current = spark.createDataFrame([(1, "V", "a"), (2, "W", "a")], "id int, voyage string, status string")
    rows = spark.createDataFrame([(1, "V", "b", None), (2, "W", "b", None)], "id int, voyage string, status string, at timestamp")
    active = spark.createDataFrame([("V",), ("V",)], "voyage string")
    assert runs.replay(current, rows, "at", D(2020, 1, 1), D(2030, 1, 1), "id", ["status"]).count() == 0
    assert [(r.id, r.change_type) for r in runs.reconcile(current, rows, active, ["voyage"], "id", ["status"]).collect()] == [(1, "updated")]


def test_jobs_and_candidates_in_order(spark):
    jobs = spark.createDataFrame([(1, 9, "partial", 5), (2, 9, "pending", None), (3, 9, "pending", 8), (4, 9, "error", 1), (5, 9, "complete", 1)], "job_id int, candidate_id int, status string, planned_total long")
    candidates = spark.createDataFrame([(9, "V")], "candidate_id int, vessel string")
    order = lambda retry: [r.job_id for r in runs.unfinished_jobs(jobs, candidates, retry).orderBy("place").collect()]
    assert order(False) == [3, 2, 1] and order(True) == [3, 2, 1, 4]


def test_marked_and_merged_containers(spark):
    none = spark.createDataFrame([], "vesselcode string, voyage string")
    events = spark.createDataFrame([(" csqu3054383", "202601010000", "", "x", "U", "1"), ("CSQU3054383 ", None, "202602010000", "x", "U", "1"), (" ", "1", "1", "1", "U", "1"), (None, "1", "1", "1", "U", "1"), ("bad", " ", None, "202603010000", "U", "1")], "container_no string, in_time string, out_time string, received_time string, vesselcode string, voyage string")
    found = joins.container_catalog(events, none)
    assert sorted((r.container_no, r.first_event, r.last_event, r.events, r.status) for r in found.collect()) == [("BAD", "202603010000", "202603010000", 1, "invalid"), ("CSQU3054383", "202601010000", "202602010000", 2, "pending")]
    assert joins.container_catalog(events, spark.createDataFrame([("U", "1")], "vesselcode string, voyage string")).count() == 0
    old = spark.createDataFrame([("CSQU3054383", "plans", None, None, 0, False, "invalid"), ("OLD", "plans", None, None, 0, True, "complete")], "container_no string, source string, first_event string, last_event string, events long, valid boolean, status string")
    facts = spark.createDataFrame([(" bad",)], "container_no string")
    got = {r.container_no: (r.source, r.status) for r in runs.merge_containers(old, found, "gate_events", facts).collect()}
    assert got == {"CSQU3054383": ("gate_events+plans", "pending"), "OLD": ("plans", "complete"), "BAD": ("gate_events", "complete")}


def test_sql_functions(spark):
    sql.register(spark)
    got = spark.sql("SELECT iso6346_valid(' csqu3054383') a, iso6346_valid('CSQU3054384') b, iso6346_valid('x') c, gate_history_invalid_reason(null, '1') d, gate_history_invalid_reason('V', 'a b') e, gate_history_invalid_reason('V', 'é') f, gate_history_invalid_reason('fc0000000', '1') g, gate_history_invalid_reason('V', ' 1E ') h").first()
    assert tuple(got) == (1, 0, 0, "empty_vesselcode", "voyage_contains_whitespace", "voyage_non_ascii", "placeholder_vesselcode", "")


def test_month_and_day_of_one_digit(spark):
    now = F.lit(D(2026, 7, 1))
    rows = spark.range(1).select(*[text.month_day_near(F.lit(v), now).alias(f"c{i}") for i, v in enumerate(("7-5 8:00", " 07-05   08:00", "1-1 0:00", "1-1 00:01", "13-1 0:00", "7-5"))]).first()
    assert tuple(rows) == (D(2026, 7, 5, 8), D(2026, 7, 5, 8), None, D(2026, 1, 1, 0, 1), None, None)


def test_gate_throughput_of_dirty_rows(spark):
    rows = [("GATE_IN", None, " abcu1", "4x", "2026-01-01 08:00", None), ("GATE_IN", None, "ABCU1 ", "2x", "202601012300", None), ("GATE_IN", "E", " ", "22", "202601010800", None), ("GATE_IN", "E", None, "22", "202601010800", None), ("GATE_OUT", "E", "X", "l5", None, " "), ("GATE_OUT", "E", "X", "l5", None, "199912312359"), ("OTHER", "E", "X", "l5", "202601010800", "202601010800")]
    events = spark.createDataFrame([(*r, "U", "1") for r in rows], "type string, direction string, container_no string, size_code string, in_time string, out_time string, vesselcode string, voyage string")
    none = events.select("vesselcode", "voyage").limit(0)
    got = [tuple(r) for r in gold.gate_daily(events, none, dt.date(2026, 1, 1)).collect()]
    assert got == [(dt.date(2026, 1, 1), "", 1, 0, 1, 2.0, 0.0, 1, 0)] and gold.gate_daily(events, none).count() == 2


def test_landing_goes_on_behind_its_checkpoint(spark, tmp_path):
    def page(n):
        (tmp_path / "in").mkdir(exist_ok=True)
        spark.range(n, n + 2).selectExpr("id", "cast('2001-01-01' as timestamp) as at").write.mode("append").json(str(tmp_path / "in"))

    def land():
        stream = spark.readStream.schema("id long, at timestamp").json(str(tmp_path / "in")).withColumn("observed_at", F.current_timestamp())
        streams.start_landing(stream, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    page(0)
    assert land().count() == 2
    page(2)
    out = land()
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 3] and land().count() == 4
    # What was visible goes by the time of landing, not by the rows' own times.
    assert out.filter(F.col("observed_at") <= F.lit(D(2002, 1, 1))).count() == 0


def test_gate_files_by_scope(spark, tmp_path):
    events = spark.createDataFrame([("U", "1", 1), ("V", "2", 2)], "vesselcode string, voyage string, id int")
    active, none = events.filter("id = 2"), events.limit(0)
    read = lambda name: spark.read.option("header", True).csv(f"{tmp_path}/{name}").count()
    for scope, rows in (("all", 2), ("active", 1), ("off", None)):
        sinks.write_gate(events, active, events, none if scope == "off" else events, f"{tmp_path}/{scope}", scope)
        assert read(f"{scope}/gap") == 2 and (tmp_path / scope / "events").exists() == (rows is not None) and (tmp_path / scope / "new").exists() == (scope != "off")
        assert rows is None or read(f"{scope}/events") == rows


def test_questions_in_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert ask(spark, sf, "SELECT count(*) AS n FROM curves WHERE entity_key = :who", who="NATION_6").first().n > 0
    assert ask(spark, sf, "SELECT count(*) AS n FROM gate JOIN quarantined USING (vesselcode, voyage)").first().n >= 0
