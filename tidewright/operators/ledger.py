"""Life cycles of candidates, voyages, capture jobs and runs: each operator takes the table as it is and a log of what happened, and returns the next table."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators import cdc

PAIR = ["vesselcode", "voyage"]
#: The columns of a gate direction in the voyage catalog, and states of candidates and runs.
DIRECTIONS = {"GATE_IN": ("in_done_at", "in_total"), "GATE_OUT": ("out_done_at", "out_total")}
OPEN_STATES, FINAL_STATES = ("pending", "hit"), ("empty", "complete")
RUNNING, INTERRUPTED, DONE = "running", "interrupted", "ok"


def _flagged(rows: DataFrame, rejected: DataFrame, name: str = "_rejected") -> DataFrame:
    return rows.join(rejected.select(*PAIR).distinct().withColumn(name, F.lit(True)), PAIR, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def gate_counters(voyages: DataFrame, events: DataFrame, rejected: DataFrame, received: str = "received_time") -> DataFrame:
    """One row: voyages, how many are done in both directions, inactive, quarantined; events, in, out, quarantined; first and last time of a message.

    Quarantined pairs count only as such; blank times don't count. One flagged join and one aggregate for each of the two tables.
    """
    good = ~F.col("_rejected")
    v = _flagged(voyages, rejected).agg(
        F.count_if(good).alias("voyages"), F.count_if(good & F.col("in_done_at").isNotNull() & F.col("out_done_at").isNotNull()).alias("voyages_done"),
        F.count_if(good & (F.col("inactive") == 1)).alias("voyages_inactive"), F.count_if(F.col("_rejected")).alias("voyages_quarantined"),
    )
    at = F.when(good, F.nullif(F.trim(received), F.lit("")))
    e = _flagged(events, rejected).agg(
        F.count_if(good).alias("events"), *[F.count_if(good & (F.col("type") == t)).alias(n) for t, n in (("GATE_IN", "events_in"), ("GATE_OUT", "events_out"))],
        F.count_if(F.col("_rejected")).alias("events_quarantined"), F.min(at).alias("first_event"), F.max(at).alias("last_event"),
    )
    # Both sides are one row.
    return v.withColumn("_one", F.lit(1)).join(e.withColumn("_one", F.lit(1)), "_one").drop("_one")


def candidate_counters(candidates: DataFrame, rejected: DataFrame) -> DataFrame:
    """(status, n): candidates by state without rejected pairs, the four known states even if none is in them, then ``total`` and the number of ``rejected`` pairs."""
    good = candidates.join(rejected.select(*PAIR), PAIR, "left_anti").groupBy("status").agg(F.count("*").alias("n"))
    known = reduce(DataFrame.unionByName, [rejected.limit(0).select(F.lit("").alias("status"), F.lit(0).cast("bigint").alias("n")), *[rejected.sparkSession.range(1).select(F.lit(s).alias("status"), F.lit(0).cast("bigint").alias("n")) for s in (*OPEN_STATES, *FINAL_STATES)]])
    counts = good.unionByName(known).groupBy("status").agg(F.sum("n").alias("n"))
    total = good.agg(F.lit("total").alias("status"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return counts.unionByName(total).unionByName(rejected.select(*PAIR).distinct().agg(F.lit("rejected").alias("status"), F.count("*").alias("n")))


def candidates_in_scope(candidates: DataFrame, rejected: DataFrame, months: DataFrame, start: dt.date, end: dt.date, statuses: tuple[str, ...] = OPEN_STATES, in_catalog: bool | None = None) -> DataFrame:
    """(n): candidates in one of ``statuses``, not rejected, with monthly evidence that overlaps [start, end), in the catalog or not if that is asked."""
    rows = candidates.filter(F.col("status").isin(*statuses))
    rows = rows if in_catalog is None else rows.filter(F.col("vessel_in_catalog") == in_catalog)
    inside = months.filter((F.col("last_eta") >= F.lit(start)) & (F.col("first_eta") < F.lit(end))).select(*PAIR)
    return rows.join(rejected.select(*PAIR), PAIR, "left_anti").join(inside, PAIR, "left_semi").agg(F.count("*").alias("n"))


def complete_filled(candidates: DataFrame, voyages: DataFrame, rejected: DataFrame, now: dt.datetime) -> DataFrame:
    """Open candidates whose pair the catalog has with both directions done are complete as of ``now``; rejected pairs stay as they are."""
    filled = voyages.filter("in_done_at is not null and out_done_at is not null").select(*PAIR).join(rejected.select(*PAIR), PAIR, "left_anti")
    rows = _flagged(candidates, filled, "_filled")
    done = F.col("_filled") & F.col("status").isin(*OPEN_STATES)
    return rows.withColumns({"status": F.when(done, "complete").otherwise(F.col("status")), "updated_at": F.when(done, F.lit(now)).otherwise(F.col("updated_at"))}).drop("_filled")


def _last(name: str) -> Column:
    """Of a group's rows in order of time the last that has the column."""
    return F.max(F.when(F.col(name).isNotNull(), F.struct("at", name)))[name]


def note_probes(candidates: DataFrame, probes: DataFrame) -> DataFrame:
    """Candidates after probes (vesselcode, voyage, at, in_total, out_total), any number of each.

    A candidate that some probe found anything for is a hit, whatever state it was in; others keep their state. Attempts count probes, totals are the last
    known ones, ``probed_at`` and ``updated_at`` the last probe's time. Probes of pairs that are no candidates are left out.
    """
    found = (F.coalesce("in_total", F.lit(0)) + F.coalesce("out_total", F.lit(0))) > 0
    seen = probes.groupBy(*PAIR).agg(F.count("*").alias("_n"), F.bool_or(found).alias("_found"), F.max("at").alias("_at"), _last("in_total").alias("_in"), _last("out_total").alias("_out"))
    rows = candidates.join(seen, PAIR, "left")
    return rows.withColumns({
        "status": F.when(F.col("_found"), "hit").otherwise(F.col("status")), "attempt_count": F.col("attempt_count") + F.coalesce("_n", F.lit(0)), "probed_at": F.coalesce("_at", "probed_at"),
        "in_total": F.coalesce("_in", "in_total"), "out_total": F.coalesce("_out", "out_total"), "updated_at": F.coalesce("_at", "updated_at"),
    }).drop("_n", "_found", "_at", "_in", "_out")


def finish_candidates(candidates: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Candidates after final outcomes (vesselcode, voyage, at, status, in_total, out_total); the last of a pair counts. Only empty and complete are final, others change nothing."""
    final = outcomes.filter(F.col("status").isin(*FINAL_STATES)).groupBy(*PAIR).agg(F.max(F.struct("at", "status", "in_total", "out_total")).alias("_o"))
    rows = candidates.join(final, PAIR, "left")
    known = F.col("_o").isNotNull()
    pick = lambda name: F.when(known, F.col(f"_o.{name}")).otherwise(F.col(name))
    return rows.withColumns({"status": pick("status"), "in_total": pick("in_total"), "out_total": pick("out_total"), "probed_at": F.coalesce("probed_at", "_o.at"), "updated_at": F.when(known, F.col("_o.at")).otherwise(F.col("updated_at"))}).drop("_o")


def mark_directions(voyages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The voyage catalog after directions were read to the end (vesselcode, voyage, direction, at, total): time and total of each, of the last outcome."""
    marks = [F.max(F.when(F.col("direction") == d, F.struct("at", "total"))).alias(f"_{done}") for d, (done, _) in DIRECTIONS.items()]
    rows = voyages.join(outcomes.groupBy(*PAIR).agg(*marks), PAIR, "left")
    for done, total in DIRECTIONS.values():
        known = F.col(f"_{done}").isNotNull()
        rows = rows.withColumns({done: F.when(known, F.col(f"_{done}.at")).otherwise(F.col(done)), total: F.when(known, F.col(f"_{done}.total")).otherwise(F.col(total))})
    return rows.drop(*[f"_{done}" for done, _ in DIRECTIONS.values()])


def promote_hits(voyages: DataFrame, candidates: DataFrame, now: dt.datetime) -> DataFrame:
    """The voyage catalog with all hits: new pairs with their name, seen first and last ``now``; a pair that is there takes the name, if there is one."""
    hits = candidates.filter("status = 'hit'").select(*PAIR, F.col("vessel_en_name").alias("vesselename")).distinct()
    rest = [c for c in voyages.columns if c not in (*PAIR, "vesselename", "first_seen_at", "last_seen_at", "inactive")]
    old, new = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}"))
    fresh = F.col("old").isNull()
    return cdc.merge_catalog(voyages, hits, PAIR, {
        "vesselename": F.coalesce(F.nullif(new("vesselename"), F.lit("")), old("vesselename")), "first_seen_at": F.when(fresh, F.lit(now)).otherwise(old("first_seen_at")),
        "last_seen_at": F.when(fresh, F.lit(now)).otherwise(old("last_seen_at")), "inactive": F.coalesce(old("inactive"), F.lit(0)), **{c: old(c) for c in rest},
    })


def seed_jobs(candidates: DataFrame, jobs: DataFrame, found: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(candidates, jobs) after a discovery ``found`` (vesselcode, voyage, vessel_name, first_eta, last_eta, source_plan_rows, reason, evidence map, in_total, out_total, page_cap).

    Of a pair that is known: reasons are united and sorted, newer evidence replaces older of the same key, ranges widen, the larger count of rows stands, a name is kept unless a new one
    is given. A job a direction: its first known planned total stays, the larger page cap counts. Rows of one pair in ``found`` must be one.
    """
    old, new = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}"))
    seen = F.col("new").isNotNull()
    empty = F.create_map().cast("map<string,string>")
    older = F.map_filter(F.coalesce(old("evidence"), empty), lambda k, _: ~F.coalesce(F.array_contains(F.map_keys(new("evidence")), k), F.lit(False)))
    merged = cdc.merge_catalog(candidates, found, PAIR, {
        "vessel_name": F.coalesce(F.nullif(new("vessel_name"), F.lit("")), old("vessel_name")), "first_eta": F.least(old("first_eta"), new("first_eta")), "last_eta": F.greatest(old("last_eta"), new("last_eta")),
        "source_plan_rows": F.greatest(old("source_plan_rows"), new("source_plan_rows")), "reason": cdc.union_labels(old("reason"), new("reason")), "evidence": F.map_concat(older, F.coalesce(new("evidence"), empty)),
        "discovered_at": F.coalesce(old("discovered_at"), F.lit(now)), "updated_at": F.when(seen, F.lit(now)).otherwise(old("updated_at")),
    })
    asked = found.select(*PAIR, "page_cap", F.explode(F.array(*[F.struct(F.lit(d).alias("direction"), F.col(total).alias("planned_total")) for d, (_, total) in DIRECTIONS.items()])).alias("j")).select(*PAIR, "j.*", "page_cap")
    return merged, cdc.merge_catalog(jobs, asked, [*PAIR, "direction"], {"planned_total": F.coalesce(old("planned_total"), new("planned_total")), "page_cap": F.greatest(old("page_cap"), new("page_cap")), "status": F.coalesce(old("status"), F.lit("pending"))})


def close_stale(runs: DataFrame, kind: str, now: dt.datetime) -> DataFrame:
    """The run ledger (run_id, kind, status, finished_at, error) before a run of ``kind`` starts: rows of that kind that still say they run never ended; they are interrupted."""
    stale = (F.col("status") == RUNNING) & (F.col("kind") == kind)
    return runs.withColumns({"finished_at": F.when(stale, F.lit(now)).otherwise(F.col("finished_at")), "error": F.when(stale, "not ended properly").otherwise(F.col("error")), "status": F.when(stale, INTERRUPTED).otherwise(F.col("status"))})


def finish_runs(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The ledger with what ``outcomes`` (run_id, status, finished_at, seen, new, updated, touched, unchanged) say; counters that are missing are 0."""
    counters = ("seen", "new", "updated", "touched", "unchanged")
    one = outcomes.groupBy("run_id").agg(F.max_by(F.struct("status", "finished_at", *counters), "finished_at").alias("_o"))
    rows = runs.join(one, "run_id", "left")
    known = F.col("_o").isNotNull()
    pick = lambda c: F.when(known, F.col(f"_o.{c}")).otherwise(F.col(c))
    return rows.withColumns({"status": pick("status"), "finished_at": pick("finished_at")} | {c: F.when(known, F.coalesce(F.col(f"_o.{c}"), F.lit(0))).otherwise(F.col(c)) for c in counters}).drop("_o")


def warehouse_counters(tables: dict[str, DataFrame], catalog: DataFrame, changes: DataFrame) -> DataFrame:
    """(name, value): rows of each table, the catalog's watermark (latest last_seen_at), and changes of each run as ``changes:<run>``."""
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").cast("string").alias("value")) for name, df in tables.items()]
    mark = catalog.agg(F.lit("catalog_watermark").alias("name"), F.max("last_seen_at").cast("string").alias("value"))
    by_run = changes.groupBy("run_id").agg(F.count("*").alias("n")).select(F.concat(F.lit("changes:"), F.col("run_id").cast("string")).alias("name"), F.col("n").cast("string").alias("value"))
    return reduce(DataFrame.unionByName, [*counts, mark, by_run])


def voyages_in_order(voyages: DataFrame, at: str = "last_event_at") -> DataFrame:
    """Voyages with the latest event first, those without one last, then by pair: a range sort over all tasks."""
    return voyages.orderBy(F.desc_nulls_last(at), *PAIR)


def newest_by(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The latest row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(at)))
    return rows.withColumn("_r", rank).filter("_r = 1").drop("_r")
