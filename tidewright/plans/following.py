"""Queries of state over time: several cutoffs in one pass, tables that take batches, rebuilds that follow changes, stays, and stored sketches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewright.operators import asof, gold, joins, rebuild, runs, sketches
from tidewright.operators.keyed import KeyedTable
from tidewright.plans.registry import doubles, longs, query
from tidewright.sources.sinks import staged

CUTOFFS = [dt.datetime(y, 6, 30, 23, 59, 59) for y in range(2004, 2009)]
GATE_CUTOFFS = [dt.datetime(2024, 1, d, 12) for d in (3, 8, 15, 22, 29)]
_TIMES = "c AS (SELECT unnest([{}]) AS as_of_time)"


def _listed(times: list[dt.datetime]) -> str:
    return _TIMES.format(", ".join(f"TIMESTAMP '{t}'" for t in times))


_FACTS = {"vgm": ("flow_versions", ["l_orderkey", "l_linenumber"]), "release": ("release_versions", ["release_key"]), "transship": ("transship_versions", ["part_key", "supp_key"]), "plans": ("plan_versions", ["call_key", "call_voyage", "terminal", "direction"])}
_ORDER = {"vgm": ["version_id", "weight_kg"], "release": ["version_id"], "transship": ["version_id"], "plans": ["version_id"]}
_SEEN = ", ".join(
    f"{n} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY as_of_time, {', '.join(keys)} ORDER BY observed_at DESC, {', '.join(f'{o} DESC' for o in _ORDER[n])}) AS r FROM :{binding}: JOIN c ON observed_at <= as_of_time) WHERE r = 1 AND flow_date BETWEEN DATE '2000-01-01' AND CAST(as_of_time AS DATE))"
    for n, (binding, keys) in _FACTS.items()
)
_COUNTS = ["vgm_count", "release_count", "transship_count", "planned_calls", "actual_calls"]
_MEASURES = ["vgm_weight_kg", "release_weight", "release_weight_kg", "release_volume", "release_pieces", "transship_weight", "transship_volume", "avg_arrival_delay", "avg_departure_delay"]


@query(f"""WITH {_listed(CUTOFFS)}, {_SEEN},
f AS (SELECT as_of_time, flow_date, terminal, direction, '' AS route, '' AS cargo_group, '' AS operator, 1 AS vgm_count, weight_kg AS vgm_weight_kg, 0 AS release_count, 0 AS release_weight, 0 AS release_weight_kg, 0 AS release_volume, 0 AS release_pieces, 0 AS transship_count, 0 AS transship_weight, 0 AS transship_volume, 0 AS planned_calls, 0 AS actual_calls, NULL::DOUBLE AS ad, NULL::DOUBLE AS dd FROM (SELECT * EXCLUDE (route) FROM vgm)
  UNION ALL SELECT as_of_time, flow_date, terminal, direction, '', '', operator, 0, 0, CASE WHEN trim(bill_no) <> '' THEN 1 ELSE 0 END, weight, weight_kg, volume, pieces, 0, 0, 0, 0, 0, NULL, NULL FROM release
  UNION ALL SELECT as_of_time, flow_date, terminal, '', route, coalesce(cargo_group, 'UNKNOWN'), '', 0, 0, 0, 0, 0, 0, 0, CASE WHEN container_no IS NULL THEN 0 ELSE 1 END, weight, volume, 0, 0, NULL, NULL FROM transship
  UNION ALL SELECT as_of_time, flow_date, terminal, direction, '', '', '', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, CASE WHEN arrived THEN 1 ELSE 0 END, CASE WHEN arrival_delay_h BETWEEN 0 AND 720 THEN arrival_delay_h END, CASE WHEN departure_delay_h BETWEEN 0 AND 720 THEN departure_delay_h END FROM plans)
SELECT as_of_time, flow_date, terminal, direction, route, cargo_group, operator, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNTS)}, {", ".join(f"round(CAST(coalesce(sum({c}), 0) AS DOUBLE), 6) AS {c}" for c in _MEASURES[:7])},
  round(CAST(avg(ad) AS DOUBLE), 6) AS avg_arrival_delay, round(CAST(avg(dd) AS DOUBLE), 6) AS avg_departure_delay FROM f GROUP BY ALL""")
def flow_at_cutoffs(v):
    facts = {n: (v(b).drop("route") if n == "vgm" else v(b), keys, _ORDER[n]) for n, (b, keys) in _FACTS.items()}
    return longs(doubles(runs.daily_flow_at_cutoffs(facts, CUTOFFS), *_MEASURES), *_COUNTS)


_TEU = "CASE upper(substr(trim(size_code), 1, 1)) WHEN '1' THEN 0.5 WHEN '2' THEN 1.0 WHEN '3' THEN 1.5 WHEN '4' THEN 2.0 WHEN 'L' THEN 2.25 END"


@query(f"""WITH {_listed(GATE_CUTOFFS)},
m AS (SELECT as_of_time, coalesce(direction, '') AS direction, CASE type WHEN 'GATE_IN' THEN 'IN' ELSE 'OUT' END AS kind, upper(trim(container_no)) AS container_no, trim(CASE type WHEN 'GATE_IN' THEN in_time ELSE out_time END) AS raw, {_TEU} AS teu
  FROM :gate_raw: g JOIN c ON fetched_at <= as_of_time WHERE trim(container_no) <> '' AND NOT EXISTS (SELECT 1 FROM :quarantined: q WHERE q.vesselcode = g.vesselcode AND q.voyage = g.voyage)),
t AS (SELECT *, CASE WHEN substr(raw, 5, 1) = '-' THEN substr(raw, 1, 10) WHEN length(raw) >= 8 THEN substr(raw, 1, 4) || '-' || substr(raw, 5, 2) || '-' || substr(raw, 7, 2) END AS day FROM m WHERE raw <> ''),
o AS (SELECT as_of_time, CAST(day AS DATE) AS flow_date, direction, kind, container_no, max(teu) AS teu FROM t WHERE day BETWEEN '2000-01-01' AND strftime(CAST(as_of_time AS DATE) + 180, '%Y-%m-%d') GROUP BY ALL)
SELECT as_of_time, flow_date, direction, count(*) FILTER (kind = 'IN') AS in_count, count(*) FILTER (kind = 'OUT') AS out_count, count(DISTINCT container_no) AS unique_containers,
  CAST(coalesce(sum(teu) FILTER (kind = 'IN'), 0) AS DOUBLE) AS in_teu, CAST(coalesce(sum(teu) FILTER (kind = 'OUT'), 0) AS DOUBLE) AS out_teu,
  count(*) FILTER (kind = 'IN' AND teu IS NOT NULL) AS in_teu_known, count(*) FILTER (kind = 'OUT' AND teu IS NOT NULL) AS out_teu_known FROM o GROUP BY as_of_time, flow_date, direction""")
def gate_at_cutoffs(v):
    return runs.gate_daily_at_cutoffs(v("gate_raw"), v("quarantined"), GATE_CUTOFFS)


@query("""WITH l AS (SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 3000 DAY AS asked_at FROM orders)
SELECT o_orderkey, o_custkey, asked_at, (SELECT max(struct_pack(a := observed_at, b := version_id, c := bill_no)) FROM :release_versions: r WHERE r.release_key = l.o_custkey AND r.observed_at <= l.asked_at).c AS bill_no FROM l""")
def bills_as_of_order(v):
    left = v("orders").select("o_orderkey", F.col("o_custkey").cast("bigint").alias("o_custkey"), (F.col("o_orderdate").cast("timestamp") + F.expr("interval 3000 days")).alias("asked_at"))
    versions = v("release_versions").withColumn("o_custkey", F.col("release_key").cast("bigint"))
    return asof.as_of_join(left, versions, ["o_custkey"], "asked_at", "observed_at", ["version_id"], ["bill_no"])


_FIELDS = ["status", "customer", "priority", "compare_time"]


def _keyed(v):
    """The current rows, then three batches of a third of the incoming ones, the first of them once more; compacted after the second."""

    def make():
        table = KeyedTable.create(v("current"), v.place("keyed"), "id", _FIELDS, 8)
        counters = []
        for part in (0, 1, 2, 0):
            counters.append(table.apply(v("incoming").filter(F.col("id") % 3 == part), touch=("compare_time",)))
            if len(counters) == 2:
                table.compact()
        return table.state, counters

    state, counters = v.once("keyed", make)
    return KeyedTable.open(v.spark, state), counters


@query("""SELECT coalesce(n.id, o.id) AS id, coalesce(n.status, o.status) AS status, coalesce(n.customer, o.customer) AS customer, coalesce(n.priority, o.priority) AS priority, coalesce(n.compare_time, o.compare_time) AS compare_time FROM :current: o FULL JOIN :incoming: n ON n.id = o.id""")
def keyed_rows(v):
    return _keyed(v)[0].rows()


_SAME = " AND ".join(f"n.{f} = o.{f}" for f in _FIELDS)
_ALMOST = " AND ".join(f"n.{f} = o.{f}" for f in _FIELDS[:3])


@query(f"""WITH c AS (SELECT n.id % 3 AS part, CASE WHEN o.id IS NULL THEN 'new' WHEN {_SAME} THEN 'unchanged' WHEN {_ALMOST} THEN 'touched' ELSE 'updated' END AS kind FROM :incoming: n LEFT JOIN :current: o ON n.id = o.id),
b AS (SELECT CAST(part AS INT) + 1 AS batch, kind FROM c UNION ALL SELECT 4, 'unchanged' FROM c WHERE part = 0)
SELECT batch, count(*) AS seen, count(*) FILTER (kind = 'new') AS "new", count(*) FILTER (kind = 'updated') AS updated, count(*) FILTER (kind = 'touched') AS touched, count(*) FILTER (kind = 'unchanged') AS unchanged, CAST(0 AS BIGINT) AS skipped FROM b GROUP BY batch""")
def keyed_counters(v):
    names = ("seen", "new", "updated", "touched", "unchanged", "skipped")
    rows = [(i + 1, *[int(c[n]) for n in names]) for i, c in enumerate(_keyed(v)[1])]
    return v.spark.createDataFrame(rows, "batch int, " + ", ".join(f"`{n}` bigint" for n in names))


def _followed(v):
    """Gold tables of the facts before corrections, brought up to date by the changes alone."""

    def make():
        facts = {"vgm": v("vgm_dealt")}
        none = {"release": v("release").limit(0), "transship": v("transship").limit(0), "plans": gold.latest_plans(v("plans").limit(0), ["t1"])}

        def daily(days):
            rows = facts["vgm"] if days is None else facts["vgm"].join(days, "flow_date", "left_semi")
            return gold.daily_flow(rows, none["release"], none["transship"], none["plans"])

        tables = rebuild.GoldTables(v.spark, v.place("followed"), daily)
        tables.rebuild()
        facts["vgm"] = v("vgm_corrected")
        hit = v("vgm_dealt").filter("flow_date between date'2004-03-05' and date'2004-03-09' or flow_date = date'2004-06-20'")
        changes = staged(hit.select(F.col("flow_date").alias("old_day"), F.date_add("flow_date", 1).alias("new_day")), "corrections")
        return tables, tables.follow(changes, "old_day", "new_day")

    return v.once("followed", make)


@query("SELECT CAST(date_trunc('week', flow_date) AS DATE) AS week_start, terminal, direction, count(*) AS vgm_count, round(CAST(sum(weight_kg) AS DOUBLE), 6) AS vgm_weight_kg FROM :vgm_corrected: GROUP BY ALL")
def followed_weeks(v):
    rows = _followed(v)[0].read("weekly").select("week_start", "terminal", "direction", "vgm_count", "vgm_weight_kg")
    return longs(doubles(rows, "vgm_weight_kg"), "vgm_count")


@query("""WITH w AS (SELECT CASE trim(terminal) WHEN '' THEN 'UNKNOWN' ELSE trim(terminal) END || ':' || direction AS entity_key, CAST(date_trunc('week', flow_date) AS DATE) AS time_bucket, CAST(sum(weight_kg) AS DOUBLE) AS value FROM :vgm_corrected: GROUP BY ALL)
SELECT entity_key, time_bucket, round(CASE WHEN stddev_pop(value) OVER p > 0 THEN (value - avg(value) OVER p) / stddev_pop(value) OVER p ELSE 0 END, 5) AS z FROM w WINDOW p AS (PARTITION BY entity_key)""")
def followed_index(v):
    """The index of each entity and week is the share of its gross weights: the other facts are empty here, so their scores are 0."""
    rows = _followed(v)[0].read("index")
    from tidewright.operators.series import PRESSURE_WEIGHTS

    total = F.aggregate(F.map_keys("contributions"), F.lit(0.0), lambda s, k: s + F.create_map(*[F.lit(x) for kv in PRESSURE_WEIGHTS.items() for x in kv])[k])
    return doubles(rows.select("entity_key", "time_bucket", (F.col("contributions")["vgm"] * total / PRESSURE_WEIGHTS["vgm"]).alias("z")), "z", digits=5)


_STEP = """o AS (SELECT container_no, type, moment, max(carried) AS carried FROM (SELECT container_no, type, CASE type WHEN 'GATE_IN' THEN in_time ELSE out_time END AS moment, CASE WHEN type = 'GATE_OUT' AND in_time <= out_time THEN in_time END AS carried FROM :stay_events:)
  WHERE container_no IS NOT NULL AND moment IS NOT NULL GROUP BY container_no, type, moment),
s AS (SELECT *, CASE type WHEN 'GATE_IN' THEN 1 ELSE -1 END AS step, row_number() OVER (PARTITION BY container_no ORDER BY moment, type) AS i FROM o)"""


@query(f"""WITH RECURSIVE {_STEP},
w(container_no, i, open, popped) AS (SELECT container_no, CAST(0 AS BIGINT), CAST([] AS TIMESTAMP[]), CAST(NULL AS TIMESTAMP) FROM (SELECT DISTINCT container_no FROM s)
  UNION ALL SELECT w.container_no, s.i, CASE WHEN step = 1 THEN list_append(open, moment) ELSE open[:len(open) - 1] END, CASE WHEN step = -1 THEN open[-1] END FROM w JOIN s ON s.container_no = w.container_no AND s.i = w.i + 1),
p AS (SELECT s.*, CASE WHEN epoch(moment) - epoch(popped) <= 5 * 86400 THEN popped END AS partner FROM s JOIN w USING (container_no, i)),
x AS (SELECT container_no, coalesce(carried, partner) AS in_time, moment AS out_time, CASE WHEN carried IS NOT NULL THEN 'direct' WHEN partner IS NOT NULL THEN 'paired' ELSE 'lost_in' END AS form FROM p WHERE step = -1
  UNION ALL SELECT container_no, moment, NULL, 'lost_out' FROM p a WHERE step = 1 AND NOT EXISTS (SELECT 1 FROM p b WHERE b.container_no = a.container_no AND b.step = -1 AND b.partner = a.moment))
SELECT container_no, in_time, out_time, form, round((epoch(out_time) - epoch(in_time)) / 3600, 6) AS hours FROM x""")
def container_stays(v):
    return doubles(joins.stays(v("stay_events"), 5), "hours")


_SKETCHED = (["l_suppkey", "l_partkey", "l_returnflag"], ["l_quantity", "l_extendedprice"])


def _sketches(v):
    """Sketches by month of shipping, stored; whatever is asked of all history reads those."""
    rows = v("lineitem").withColumn("month", F.date_trunc("month", "l_shipdate").cast("date"))
    return v.stored("sketches", lambda: sketches.column_sketches(rows, ["month"], *_SKETCHED))


@query("""SELECT name, count(*) AS n, count(value) AS filled, true AS near FROM (SELECT unnest([struct_pack(name := 'l_suppkey', value := CAST(l_suppkey AS STRING)), struct_pack(name := 'l_partkey', value := CAST(l_partkey AS STRING)), struct_pack(name := 'l_returnflag', value := l_returnflag)], recursive := true) FROM lineitem) GROUP BY name""")
def sketched_profile(v):
    """Distinct numbers by merged sketches of months; ``near``: within 5 % of those that sketches of suppliers, merged likewise, give: the way of merging doesn't matter."""
    found = sketches.profile_of(sketches.merged_sketches(_sketches(v), [], *_SKETCHED), _SKETCHED[0])
    other = sketches.profile_of(sketches.merged_sketches(sketches.column_sketches(v("lineitem"), ["l_suppkey"], _SKETCHED[0][1:]), [], _SKETCHED[0][1:]), _SKETCHED[0][1:])
    both = found.join(other.select("name", F.col("distinct_values").alias("_other")), "name", "left")
    near = F.coalesce(F.abs(F.col("distinct_values") - F.col("_other")) <= 0.05 * F.col("_other"), F.lit(True))
    return both.select("name", "n", "filled", near.alias("near"))


@query("SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, 'l_quantity' AS name, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high, true AS inside FROM lineitem GROUP BY 1")
def sketched_ranges(v):
    bands = sketches.bands_of(_sketches(v), ["l_quantity"], by=["month"])
    inside = F.col("bands")[2].between(F.col("low"), F.col("high")) & (F.col("bands")[0] <= F.col("bands")[2]) & (F.col("bands")[2] <= F.col("bands")[4])
    return bands.select("month", "name", "n", "low", "high", inside.alias("inside"))
