"""Runs over stored tables: what a run changed, replay and reconciliation, rebuilds of affected days, catalogs and their work lists, and records of model runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators import cdc, gold
from tidewright.operators.asof import as_of, as_of_many
from tidewright.operators.reports import in_window

#: States of capture jobs in the order in which they are taken up; errors only when asked for.
JOB_ORDER = ("pending", "partial", "error")


def ordered_rows(rows: DataFrame, *order: str) -> DataFrame:
    """All current rows in a fixed order: a range sort over all tasks."""
    return rows.orderBy(*order)


def run_events(events: DataFrame, run_id: int, quarantined: DataFrame, pair: tuple[str, str] = ("vesselcode", "voyage")) -> DataFrame:
    """Events that one run stored, but for quarantined pairs; the run reaches the scan as a filter, or as a partition."""
    return events.filter(F.col("run_id") == run_id).join(quarantined.select(*pair).distinct(), list(pair), "left_anti")


def run_changes(changes: DataFrame, current: DataFrame, run_id: int, key: str = "id") -> DataFrame:
    """Current rows that a run changed, with the kind of change; a row that is gone since isn't there."""
    return changes.filter(F.col("run_id") == run_id).select(key, "change_type").join(current, key)


def unfinished_jobs(jobs: DataFrame, candidates: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Open jobs with their candidate's columns and ``place``, what their order goes by: state, then known totals before unknown, smallest first, then id."""
    states = JOB_ORDER if retry_errors else JOB_ORDER[:2]
    rank = F.array_position(F.array(*map(F.lit, JOB_ORDER)), F.col("status")) - 1
    place = F.struct(rank.alias("state"), F.col("planned_total").isNull().alias("unknown"), "planned_total", "job_id")
    return jobs.filter(F.col("status").isin(*states)).join(candidates, "candidate_id").withColumn("place", place)


def pending_candidates(candidates: DataFrame, catalog: DataFrame, evidence: DataFrame, rejected: DataFrame, start: dt.date, end: dt.date, statuses: tuple[str, ...] = ("pending", "hit"), in_catalog: bool | None = None) -> DataFrame:
    """Candidates in one of ``statuses`` whose monthly evidence overlaps [start, end), without rejected pairs, with the catalog's state of
    the same pair (in_done_at, in_total, out_done_at, out_total), whether it has that pair, and their order: hits first, newest arrival first."""
    pair = ["vesselcode", "voyage"]
    rows = candidates.filter(F.col("status").isin(*statuses))
    rows = rows if in_catalog is None else rows.filter(F.col("vessel_in_catalog") == in_catalog)
    inside = evidence.filter((F.col("last_eta") >= F.lit(start)) & (F.col("first_eta") < F.lit(end))).select(*pair)
    state = catalog.select(*pair, *[F.col(c).alias(f"existing_{c}") for c in ("in_done_at", "in_total", "out_done_at", "out_total")], F.lit(True).alias("_match"))
    rows = rows.join(rejected.select(*pair), pair, "left_anti").join(inside, pair, "left_semi").join(state, pair, "left")
    place = F.struct((F.col("status") != "hit").alias("later"), (-F.unix_date("last_eta")).alias("day"), "vesselcode", "voyage")
    return rows.withColumns({"exact_match": F.coalesce("_match", F.lit(False)), "place": place}).drop("_match")


def active_gate_voyages(voyages: DataFrame, catalog: DataFrame, now: dt.datetime, active_days: int = 14) -> DataFrame:
    """Gate voyages that are not retired and are in the current catalog (unvessel, voyage, last_seen_at), or had an event in the last ``active_days``."""
    known = catalog.select(F.col("unvessel").alias("vesselcode"), "voyage", F.col("last_seen_at").alias("catalog_last_seen"), F.lit(True).alias("_in"))
    rows = voyages.filter("inactive = 0").join(known, ["vesselcode", "voyage"], "left")
    return rows.filter(F.col("_in").isNotNull() | (F.col("last_event_at") >= F.lit(now - dt.timedelta(days=active_days)))).drop("_in")


def replay(current: DataFrame, rows: DataFrame, at: str, low: dt.datetime, high: dt.datetime, key: str, fields: list[str], touch: tuple[str, ...] = ()) -> DataFrame:
    """Changes that a window's rows bring, read once more. The caller's watermark stays where it is: a replay has none."""
    return cdc.capture_changes(current, in_window(rows, at, low, high), key, fields, touch)


def reconcile(current: DataFrame, rows: DataFrame, active: DataFrame, by: list[str], key: str, fields: list[str], touch: tuple[str, ...] = ()) -> DataFrame:
    """Changes in all rows of the active voyages, whatever their time says: finds rows whose time is missing or didn't move, which every window passes by."""
    return cdc.capture_changes(current, rows.join(active.select(*by).distinct(), by, "left_semi"), key, fields, touch)


def merge_voyages(current: DataFrame, batch: DataFrame, now: dt.datetime) -> DataFrame:
    """The voyage catalog after a batch (unvessel, voyage, envessel, portclose_at, portclose_raw): one row a voyage, of its rows one with a close time first and
    then the latest; a known close time is never lost to an empty one. ``new`` marks voyages that the catalog didn't have."""
    best = cdc.best_of_batch(batch, ["unvessel", "voyage"], "portclose_at", "portclose_raw").drop("duplicates")
    old, new = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}"))
    kept = new("portclose_at").isNull() & old("portclose_at").isNotNull()
    seen = F.col("new").isNotNull()
    return cdc.merge_catalog(current, best, ["unvessel", "voyage"], {
        "envessel": F.when(seen, new("envessel")).otherwise(old("envessel")), "portclose_at": F.coalesce(new("portclose_at"), old("portclose_at")),
        "portclose_raw": F.when(seen & ~kept, new("portclose_raw")).otherwise(old("portclose_raw")), "first_seen_at": F.coalesce(old("first_seen_at"), F.lit(now)),
        "last_seen_at": F.when(seen, F.lit(now)).otherwise(old("last_seen_at")), "new": F.col("old").isNull(),
    })


def merge_containers(current: DataFrame, events: DataFrame, source: str, facts: DataFrame) -> DataFrame:
    """The container catalog (container_no, source, first_event, last_event, events, valid, status) after a catalog made of events (``joins.container_catalog``):
    sources are united, bounds refreshed, an invalid number that is valid now waits again, and what ``facts`` (container_no) has is complete."""
    old, new = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}"))
    state = F.when(~new("valid"), "invalid").when(old("status") == "invalid", "pending").otherwise(F.coalesce(old("status"), new("status")))
    out = cdc.merge_catalog(current, events, ["container_no"], {
        "source": F.when(F.col("new").isNull(), old("source")).otherwise(cdc.union_labels(old("source"), F.lit(source))), **{c: F.coalesce(new(c), old(c)) for c in ("first_event", "last_event", "events", "valid")},
        "status": F.when(F.col("new").isNull(), old("status")).otherwise(state),
    })
    return mark_complete(out, facts.select(F.upper(F.trim("container_no")).alias("container_no")), ["container_no"])


def merge_candidates(current: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates after a discovery: ranges of arrival widen, counts and the catalog flag keep the larger, a name is kept unless a new one is given, and so is the state."""
    old, new = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}"))
    return cdc.merge_catalog(current, found, ["vesselcode", "voyage"], {
        "vessel_en_name": F.coalesce(F.nullif(new("vessel_en_name"), F.lit("")), old("vessel_en_name")), "first_eta": F.least(old("first_eta"), new("first_eta")), "last_eta": F.greatest(old("last_eta"), new("last_eta")),
        "source_plan_rows": F.greatest(old("source_plan_rows"), new("source_plan_rows")), "vessel_in_catalog": F.greatest(old("vessel_in_catalog"), new("vessel_in_catalog")), "status": F.coalesce(old("status"), F.lit("pending")),
    })


def mark_complete(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """``status`` is complete where a fact of the same keys exists."""
    known = facts.select(*keys).distinct().withColumn("_known", F.lit(True))
    return rows.join(known, keys, "left").withColumn("status", F.when(F.col("_known"), "complete").otherwise(F.col("status"))).drop("_known")


def append_snapshots(stored: DataFrame, snapshots: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Snapshots to append: every observation of a key at a time of its own counts, also one without a change; what is stored already doesn't come twice."""
    return snapshots.dropDuplicates([*keys, at]).join(stored.select(*keys, at), [*keys, at], "left_anti")


def daily_flow_as_of(facts: dict[str, tuple[DataFrame, list[str], list[str]]], cutoff: dt.datetime, anchor: dt.date | None = None) -> DataFrame:
    """The daily aggregate as it would have come out at ``cutoff``: of each fact (rows, keys, order of one moment's rows) the last version observed
    up to then. Named vgm, release, transship and plans; ``as_of_time`` keeps the outcomes of cutoffs apart."""
    seen = {name: as_of(rows, keys, cutoff, order=order) for name, (rows, keys, order) in facts.items()}
    day = cutoff.date()
    return gold.daily_flow(seen["vgm"], seen["release"], seen["transship"], seen["plans"], anchor or day, end=day).withColumn("as_of_time", F.lit(cutoff))


def daily_flow_at_cutoffs(facts: dict[str, tuple[DataFrame, list[str], list[str]]], cutoffs: list[dt.datetime]) -> DataFrame:
    """``daily_flow_as_of`` for several cutoffs at once, kept apart by ``as_of_time``: each fact is read once, and its versions are told apart by
    the cutoffs at which they were visible. Dates count up to the day of each cutoff."""
    seen = {}
    for name, (rows, keys, order) in facts.items():
        seen[name] = as_of_many(rows, keys, cutoffs, order=order).filter(F.col("flow_date").between(F.lit(gold.FIRST_DATE), F.to_date("as_of_time")))
    return gold.daily_flow(seen["vgm"], seen["release"], seen["transship"], seen["plans"], apart=("as_of_time",))


def gate_daily_at_cutoffs(events: DataFrame, quarantined: DataFrame, cutoffs: list[dt.datetime], fetched: str = "fetched_at") -> DataFrame:
    """``gold.gate_daily`` as of several cutoffs: an event counts from when it was fetched. Dates count up to HORIZON_DAYS after the day of each cutoff.

    Events have no versions, so each is dealt to the cutoffs from its own on, in one scan; the first aggregate is combined before its shuffle.
    """
    cutoffs = sorted(set(cutoffs))
    seen = events.withColumn("as_of_time", F.explode(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: c >= F.col(fetched))))
    daily = gold.gate_daily(seen, quarantined, apart=("as_of_time",))
    return daily.filter(F.col("flow_date").between(F.lit(gold.FIRST_DATE), F.date_add(F.to_date("as_of_time"), gold.HORIZON_DAYS)))


def rebuild_days(rows: DataFrame, path: str, day: str, start: dt.date, end: dt.date) -> None:
    """Replace the days from start to end of a table partitioned by ``day`` and leave the others; a day of the stretch that ``rows`` lack becomes empty."""
    spark = rows.sparkSession
    inside = rows.filter(F.col(day).between(F.lit(start), F.lit(end)))
    inside.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    stored = spark.read.parquet(path).filter(F.col(day).between(F.lit(start), F.lit(end))).select(day).distinct()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for r in stored.join(inside.select(day).distinct(), day, "left_anti").collect():  # one row a day at most
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{day}={r[0]}"), True)


def rebuild_gold(daily: DataFrame, gate: DataFrame, path: str, start: dt.date | None = None, end: dt.date | None = None) -> dict[str, int]:
    """Daily rows, then the weekly rows from them, then gate throughput, as tables under ``path``. With both ends only those days are
    rebuilt, else all. Returns numbers of rows."""
    spark = daily.sparkSession
    if start and end:
        rebuild_days(daily, f"{path}/daily", "flow_date", start, end)
    else:
        daily.write.mode("overwrite").partitionBy("flow_date").parquet(f"{path}/daily")
    gold.weekly_flow(spark.read.parquet(f"{path}/daily")).write.mode("overwrite").parquet(f"{path}/weekly")
    gate.write.mode("overwrite").parquet(f"{path}/gate_daily")
    return {name: spark.read.parquet(f"{path}/{name}").count() for name in ("daily", "weekly", "gate_daily")}


def model_run(assignments: DataFrame, algorithm: str, at: dt.datetime, silhouette: Column | None = None, cluster: str = "cluster_id") -> DataFrame:
    """A run's record, to be appended to those of other runs: when, by what, over how many rows, into how many clusters, how far apart."""
    score = F.lit(None).cast("double") if silhouette is None else silhouette
    return assignments.agg(F.lit(algorithm).alias("algorithm"), F.lit(at).alias("created_at"), F.count("*").alias("sample_count"), F.countDistinct(cluster).alias("cluster_count"), score.alias("silhouette"))
