"""Cutoffs in one pass, tables that take batches, rebuilds that follow changes, stays, sketches, and the CSV data source."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewright.operators import asof, cdc, gold, joins, rebuild, runs, sketches
from tidewright.operators.keyed import KeyedTable
from tidewright.sources import exports

T = lambda d, h=0: dt.datetime(2026, 1, d, h)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- cutoffs


def test_many_cutoffs_equal_one_at_a_time(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abcd"), T(rng.randint(1, 28), rng.randint(0, 23)) if rng.random() < 0.95 else None, v, rng.randint(0, 9)) for v in range(200)]
    df = spark.createDataFrame(rows, "k string, observed_at timestamp, version_id int, x int").cache()
    cutoffs = [T(1), T(9, 5), T(15), T(15), dt.datetime(2027, 1, 1)]
    many = {(r["as_of_time"], r["k"]): (r["version_id"], r["x"]) for r in asof.as_of_many(df, ["k"], cutoffs).collect()}
    want = {(c, r["k"]): (r["version_id"], r["x"]) for c in set(cutoffs) for r in asof.as_of(df, ["k"], c).collect()}
    assert many == want
    one_pass = plan(asof.as_of_many(df.select("*"), ["k"], cutoffs))
    assert one_pass.count("Exchange hashpartitioning") == 1 and "Join" not in one_pass


def test_as_of_join_takes_the_last_version_before_each_time(spark):
    left = spark.createDataFrame([("a", T(5), 1), ("a", T(1), 2), ("a", None, 3), (None, T(9), 4), ("b", T(9), 5)], "k string, at timestamp, n int")
    versions = spark.createDataFrame([("a", T(2), 1, "x"), ("a", T(5), 1, "y"), ("a", T(5), 2, None), ("a", T(7), 1, "late"), (None, T(3), 1, "null key"), ("a", None, 9, "no time")], "k string, seen timestamp, v int, value string")
    got = {r["n"]: (r["k"], r["at"], r["value"]) for r in asof.as_of_join(left, versions, ["k"], "at", "seen", ["v"], ["value"]).collect()}
    assert got == {1: ("a", T(5), None), 2: ("a", T(1), None), 3: ("a", None, None), 4: (None, T(9), "null key"), 5: ("b", T(9), None)}


def test_gold_at_cutoffs_shows_what_was_known(spark):
    number = "decimal(18,4)"
    vgm = spark.createDataFrame([("k", T(11), 1, dt.date(2026, 1, 10), "T1", "E", 100.0), ("k", T(20), 2, dt.date(2026, 1, 10), "T1", "E", 200.0), ("m", T(11), 1, dt.date(2026, 3, 1), "T1", "E", 7.0)], "id string, observed_at timestamp, version_id int, flow_date date, terminal string, direction string, weight_kg double").withColumn("weight_kg", F.col("weight_kg").cast(number))
    plans = spark.createDataFrame([("V1", T(1), 1, dt.date(2026, 1, 9)), ("V1", T(18), 2, dt.date(2026, 1, 12))], "vessel string, observed_at timestamp, version_id int, flow_date date").withColumns({"terminal": F.lit("T1"), "direction": F.lit("E"), "arrived": F.lit(False), "arrival_delay_h": F.lit(None).cast("double"), "departure_delay_h": F.lit(None).cast("double")})
    none = vgm.limit(0).select("id", "observed_at", "version_id", "flow_date", "terminal")
    zero = {c: F.lit(0).cast(number) for c in ("weight", "weight_kg", "volume", "pieces")}
    facts = {"vgm": (vgm, ["id"], ["version_id"]), "plans": (plans, ["vessel"], ["version_id"]), "release": (none.withColumns(zero | {"bill_no": F.lit("")}), ["id"], ["version_id"]), "transship": (none.withColumns(zero | {"container_no": F.lit("")}), ["id"], ["version_id"])}
    cutoffs = [T(15), T(31)]
    got = runs.daily_flow_at_cutoffs(facts, cutoffs)
    rows = {(r["as_of_time"], r["flow_date"]): (float(r["vgm_weight_kg"]), r["planned_calls"]) for r in got.collect()}
    assert rows == {(T(15), dt.date(2026, 1, 10)): (100.0, 0), (T(15), dt.date(2026, 1, 9)): (0.0, 1), (T(31), dt.date(2026, 1, 10)): (200.0, 0), (T(31), dt.date(2026, 1, 12)): (0.0, 1)}
    for c in cutoffs:
        single = {tuple(r) for r in runs.daily_flow_as_of(facts, c).select(*gold.FLOW_KEYS, "vgm_weight_kg", "planned_calls").collect()}
        assert single == {tuple(r) for r in got.filter(F.col("as_of_time") == F.lit(c)).select(*gold.FLOW_KEYS, "vgm_weight_kg", "planned_calls").collect()}
    events = spark.createDataFrame([("GATE_IN", "E", "ABCU1", "45GP", "202601100000", None, "UN1", "1", T(11)), ("GATE_OUT", "E", "ABCU1", "22GP", None, "202601100900", "UN1", "1", T(16)), ("GATE_IN", "E", "ABCU2", "22GP", "202601100000", None, "UN9", "1", T(11))], "type string, direction string, container_no string, size_code string, in_time string, out_time string, vesselcode string, voyage string, fetched_at timestamp")
    bad = spark.createDataFrame([("UN9", "1")], "vesselcode string, voyage string")
    gate = {r["as_of_time"]: (r["in_count"], r["out_count"], r["unique_containers"], r["in_teu"], r["out_teu"]) for r in runs.gate_daily_at_cutoffs(events, bad, [T(1), *cutoffs]).collect()}
    assert gate == {T(15): (1, 0, 1, 2.0, 0.0), T(31): (1, 1, 1, 2.0, 1.0)}


# ---- tables that take batches


FIELDS = ["a", "b"]
SCHEMA = "id bigint, a string, b string"


def rows_of(df):
    return {r["id"]: (r["a"], r["b"]) for r in df.collect()}


@pytest.fixture
def keyed(spark, tmp_path):
    base = spark.createDataFrame([(i, f"a{i}", None if i % 7 == 0 else f"b{i}") for i in range(200)] + [(None, "x", "y")], SCHEMA)
    return KeyedTable.create(base, f"file://{tmp_path}", "id", FIELDS, 4)


def test_keyed_table_equals_upserts(spark, keyed):
    rng = random.Random(2)
    want = rows_of(keyed.rows())
    assert len(want) == 200
    for k in range(7):
        batch = [(rng.randrange(230), f"a{k}", rng.choice(["b", None])) if rng.random() < 0.5 else (i, *want.get(i, ("n", "n"))) for i in rng.sample(range(200), 40)]
        batch = list({r[0]: r for r in batch}.values()) + [(None, "no", "key")]
        df = spark.createDataFrame(batch, SCHEMA)
        current = spark.createDataFrame([(i, *v) for i, v in want.items()], SCHEMA)
        counters = cdc.run_counters(cdc.capture_changes(current, df, "id", FIELDS, ("b",))).first().asDict()
        assert keyed.apply(df, touch=("b",)) == counters
        want = rows_of(cdc.upsert(current, df, "id"))
        assert rows_of(keyed.rows()) == want
    assert len(keyed.deltas) == 3
    keyed.compact()
    assert rows_of(keyed.rows()) == want and not keyed.deltas


def test_keyed_table_moves_the_batch_only(spark, keyed):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.createDataFrame([(1, "z", "z"), (500, "n", "n")], SCHEMA)
        keyed.apply(batch)
        keyed.apply(spark.createDataFrame([(2, "z", "z"), (500, "m", "n")], SCHEMA))
        assert plan(keyed.changes(batch)).count("Exchange") == 1
        assert "Exchange" not in plan(keyed.rows())
        assert rows_of(keyed.rows())[500] == ("m", "n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_keyed_table_takes_the_last_of_a_batch_and_opens_again(spark, keyed):
    assert keyed.apply(spark.createDataFrame([(1, "old", "x"), (1, "new", "y"), (None, "a", "z")], SCHEMA), order=["b"]) == {"new": 0, "updated": 1, "touched": 0, "seen": 2, "skipped": 1, "unchanged": 0}
    assert keyed.apply(spark.createDataFrame([(1, "new", "y")], SCHEMA))["unchanged"] == 1 and len(keyed.deltas) == 1
    state = keyed.state
    for name in (state["base"], *state["deltas"]):
        spark.sql(f"DROP TABLE {name}")
    again = KeyedTable.open(spark, state)
    assert rows_of(again.rows())[1] == ("new", "y") and len(rows_of(again.rows())) == 200
    assert "Exchange hashpartitioning" not in plan(again.rows())


# ---- rebuilds that follow changes


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_followed_tables_equal_rebuilt_ones_and_leave_the_rest(spark, tmp_path):
    day = dt.date(2026, 1, 5)
    before = [(day + dt.timedelta(days=i), t, d, float(1 + (i * 7 + k) % 11)) for i in range(40) for k, (t, d) in enumerate((("T1", "E"), ("T1", "I"), ("T2", "E")))]
    moved, gone = day + dt.timedelta(days=16), day + dt.timedelta(days=30)
    after = [(f + dt.timedelta(days=1) if f == moved and t == "T1" else f, t, d, w + 5 if f == moved else w) for f, t, d, w in before if f != gone]
    schema = "flow_date date, terminal string, direction string, weight_kg double"
    facts = {"now": spark.createDataFrame(before, schema)}
    number = {c: F.lit(0.0) for c in ("weight", "weight_kg", "volume", "pieces")}
    none = spark.createDataFrame([], "flow_date date, terminal string")
    plans = none.withColumns({"arrived": F.lit(False), "arrival_delay_h": F.lit(0.0), "departure_delay_h": F.lit(0.0)})

    def daily(days):
        rows = facts["now"] if days is None else facts["now"].join(days, "flow_date", "left_semi")
        return gold.daily_flow(rows, none.withColumns(number | {"bill_no": F.lit("")}), none.withColumns(number | {"container_no": F.lit("")}), plans)

    tables = rebuild.GoldTables(spark, str(tmp_path / "followed"), daily)
    tables.rebuild()
    files = {n: files_of(tmp_path / "followed" / n) for n in ("daily", "weekly", "curves")}
    facts["now"] = spark.createDataFrame(after, schema)
    changes = spark.createDataFrame([(moved, moved + dt.timedelta(days=1)), (gone, None)], "old date, new date")
    counts = tables.follow(changes, "old", "new")
    assert counts["daily"] == 3 and counts["weekly"] == 2
    whole = rebuild.GoldTables(spark, str(tmp_path / "whole"), daily)
    whole.rebuild()
    near = lambda v: round(v, 9) if isinstance(v, float) else sorted((k, near(x)) for k, x in v.items()) if isinstance(v, dict) else v
    rounded = lambda df: sorted(str([near(v) for v in r]) for r in df.select(*sorted(df.columns)).collect())
    for name in ("daily", "weekly", "curves", "index"):
        assert rounded(tables.read(name)) == rounded(whole.read(name)), name
    touched = {"daily": [moved, moved + dt.timedelta(days=1), gone], "weekly": [dt.date(2026, 1, 19), dt.date(2026, 2, 2)], "curves": [dt.date(2026, 1, 19), dt.date(2026, 2, 2)]}
    for name, values in touched.items():
        left = {f: t for f, t in files[name].items() if not any(f"={v}" in f for v in values)}
        now = files_of(tmp_path / "followed" / name)
        assert left and all(now.get(f) == t for f, t in left.items()), name
        assert not any(f in now for f in files[name] if f not in left)
    assert not any(f"flow_date={gone}" in f for f in files_of(tmp_path / "followed" / "daily"))


# ---- stays


def plain_stays(events, days):
    """A stack of open INs for each container."""
    once = {}
    for container, kind, into, out in events:
        at = into if kind == "GATE_IN" else out
        if container is not None and at is not None:
            carried = into if kind == "GATE_OUT" and into is not None and into <= out else None
            key = (container, at, kind)
            once[key] = max(filter(None, (once.get(key), carried)), default=None)
    found, open_ins = [], {}
    for (container, at, kind), carried in sorted(once.items(), key=lambda e: e[0]):
        stack = open_ins.setdefault(container, [])
        if kind == "GATE_IN":
            stack.append(at)
            continue
        popped = stack.pop() if stack else None
        near = popped is not None and at - popped <= dt.timedelta(days=days)
        found.append((container, carried or (popped if near else None), at, "direct" if carried else "paired" if near else "lost_in"))
        if popped is not None and not near:
            found.append((container, popped, None, "lost_out"))
    return sorted(map(str, found + [(c, at, None, "lost_out") for c, stack in open_ins.items() for at in stack]))


def test_stays_equal_a_stack(spark):
    rng = random.Random(3)
    events = []
    for _ in range(600):
        kind, at = rng.choice(["GATE_IN", "GATE_IN", "GATE_OUT"]), T(rng.randint(1, 28), rng.randint(0, 5))
        into = at if kind == "GATE_IN" else rng.choice([None, None, at - dt.timedelta(days=2), at + dt.timedelta(days=1)])
        events.append((rng.choice(["A", "B", "C", "D", None]), kind, into, at if kind == "GATE_OUT" and rng.random() < 0.95 else None))
    df = spark.createDataFrame([(*e, 0) for e in events + events[:40]], "container_no string, type string, in_time timestamp, out_time timestamp, level int")
    for days in (1, 5, 100):
        got = joins.stays(df, days)
        assert sorted(str(tuple(r)[:4]) for r in got.select("container_no", "in_time", "out_time", "form").collect()) == plain_stays(events, days)
    assert all(r["hours"] == (r["out_time"] - r["in_time"]).total_seconds() / 3600 for r in got.filter("form in ('direct', 'paired')").collect())
    assert plan(joins.stays(df, 5)).count("Exchange hashpartitioning") <= 2


# ---- sketches


def test_sketches_merge_to_what_one_pass_gives(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.hash("id") % 5000).cast("string").alias("k"), F.when(F.col("id") % 10 == 0, " ").otherwise(F.col("id").cast("string")).alias("u"), (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 10).alias("v"))
    stored = sketches.column_sketches(rows, ["day"], ["k", "u"], ["v"]).cache()
    whole = sketches.merged_sketches(stored, [], ["k", "u"], ["v"])
    got = {r["name"]: r for r in sketches.profile_of(whole, ["k", "u"]).collect()}
    exact = rows.agg(F.countDistinct("k"), F.countDistinct(F.nullif(F.trim("u"), F.lit("")))).first()
    for name, want in zip("ku", exact, strict=True):
        assert got[name]["n"] == 60_000 and abs(got[name]["distinct_values"] - want) <= 0.05 * want
    assert got["u"]["filled"] == 54_000
    band = sketches.bands_of(whole, ["v"]).first()
    values = sorted(r["v"] for r in rows.select("v").collect())
    assert (band["n"], band["low"], band["high"]) == (60_000, values[0], values[-1])
    for share, estimate in zip((0.1, 0.25, 0.5, 0.75, 0.9), band["bands"], strict=True):
        assert abs(sum(v <= estimate for v in values) / 60_000 - share) < 0.015
    days = sketches.profile_of(stored, ["k"], ["day"])
    assert days.count() == 30 and days.filter("n <> 2000").isEmpty()


def test_sketches_of_key_prefixes(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", None), (2, "1:a", 1), (21, ":a", 1)], "x int, y string, z int")
    keys = ["x", "y", "z"]
    whole = sketches.column_sketches(sketches.with_prefixes(rows, keys), [], [sketches.prefix_name(keys[: i + 1]) for i in range(3)])
    assert [tuple(r) for r in sketches.key_growth(whole, keys).collect()] == [("x", 3), ("x,y", 4), ("x,y,z", 5)]
    empty = sketches.column_sketches(rows.limit(0), [], ["x"])
    assert sketches.profile_of(empty, ["x"]).first()["distinct_values"] == 0


# ---- CSV data source


def tree(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names)


def test_export_is_byte_exact_and_keeps_the_last_runs(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(1, 'say "hi", é', None), (2, "line\nbreak", 1.5)], "id int, text string, n double")
    exports.write_run(rows, path, "2026-01-01", one_file=True)
    (name,) = tree(path)
    want = "﻿id,text,n\r\n" + '1,"say ""hi"", é",\r\n' + '2,"line\nbreak",1.5\r\n'
    assert name.startswith("run=2026-01-01/") and open(os.path.join(path, name), "rb").read() == want.encode()
    exports.write_run(rows.limit(0), path, "2026-01-02")
    assert tree(path) == [name]
    for day in ("03", "04"):
        exports.write_run(rows, f"file://{path}", f"2026-01-{day}", keep=2)
    assert {n.split("/")[0] for n in tree(path)} == {"run=2026-01-03", "run=2026-01-04"}
    exports.write_run(rows.filter("id = 1"), path, "2026-01-04")
    exports.write_run(rows.filter("id = 2"), path, "2026-01-04", mode="append")
    assert sum(open(os.path.join(path, n), newline="").read().count("\r\n") - 1 for n in tree(path) if "04/" in n) == 2
    back = spark.read.option("header", True).option("multiLine", True).csv(path)
    assert back.filter("run = '2026-01-03'").count() == 2


def test_failed_export_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    exports.write_run(spark.range(3), path, "kept")
    before = {n: open(os.path.join(path, n), "rb").read() for n in tree(path)}
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    for run in ("kept", "fresh"):
        with pytest.raises(Exception, match="broken"):
            exports.write_run(broken, path, run)
        assert {n: open(os.path.join(path, n), "rb").read() for n in tree(path)} == before and not any(f.startswith("_job") for f in os.listdir(path))
    with pytest.raises(Exception, match="Give path and run"):
        exports.write_run(spark.range(1), path, "../up")
