"""Gaps between sources, containers, dwell times and work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.codes import iso6346_valid
from tidewright.functions.text import filled


def match_gate_to_customs(gate: DataFrame, customs: DataFrame, keys: list[str], received: str) -> DataFrame:
    """Gate events with the customs record of the same keys that has been received; one row for each match, or one without."""
    known = customs.filter(F.col(received).isNotNull()).select(*keys, received)
    return gate.join(known, keys, "left").withColumn("matched", F.col(received).isNotNull())


def gate_gap(gate: DataFrame, customs: DataFrame, keys: list[str], received: str, quarantined: DataFrame, pair: tuple[str, str]) -> DataFrame:
    """Gate events without a customs record, but for quarantined pairs."""
    known = customs.filter(F.col(received).isNotNull()).select(*keys)
    return gate.join(known, keys, "left_anti").join(quarantined.select(*pair).distinct(), list(pair), "left_anti")


def gap_summary(matched: DataFrame, pair: tuple[str, str]) -> DataFrame:
    gap = ~F.col("matched")
    return matched.agg(F.count_if(F.col("matched")).alias("matched"), F.count_if(gap).alias("gap"), F.countDistinct(F.when(gap, F.struct(*pair))).alias("gap_pairs"))


def all_movements(*sources: tuple[DataFrame, str, Column]) -> DataFrame:
    """(container_no, source, event_time): several event sources as one history; each is (rows, name, time)."""
    out = None
    for rows, name, at in sources:
        part = rows.select("container_no", F.lit(name).alias("source"), at.alias("event_time"))
        out = part if out is None else out.unionByName(part)
    return out


def container_catalog(events: DataFrame, quarantined: DataFrame) -> DataFrame:
    """First and last event, number of events and validity of each container, and the state of its work.

    Events (container_no, in_time, out_time, received_time, vesselcode, voyage) of quarantined pairs don't count, nor do those without a container; numbers are
    taken without case and surrounding spaces. The first event goes by the in time, else the out time, else the message's; the last by out, then in. Times are
    texts of one form each, as the source has them.
    """
    at = lambda *names: F.coalesce(*[F.nullif(F.trim(n), F.lit("")) for n in names])
    rows = events.join(quarantined.select("vesselcode", "voyage").distinct(), ["vesselcode", "voyage"], "left_anti").withColumn("container_no", F.upper(F.trim("container_no")))
    out = rows.filter("container_no <> ''").groupBy("container_no").agg(
        F.min(at("in_time", "out_time", "received_time")).alias("first_event"), F.max(at("out_time", "in_time", "received_time")).alias("last_event"), F.count("*").alias("events")
    )
    return out.withColumn("valid", iso6346_valid(F.col("container_no"))).withColumn("status", F.when(F.col("valid"), "pending").otherwise("invalid"))


def dwell(events: DataFrame, keys: list[str], kind: str, at: str) -> DataFrame:
    """Stays: each IN event with the next event of its container, if that is an OUT; hours between."""
    w = Window.partitionBy(*keys).orderBy(at, kind)
    rows = events.withColumns({"_next": F.lead(at).over(w), "_kind": F.lead(kind).over(w)})
    return rows.filter((F.col(kind) == "GATE_IN") & (F.col("_kind") == "GATE_OUT")).select(*keys, F.col(at).alias("in_time"), F.col("_next").alias("out_time"), ((F.unix_timestamp("_next") - F.unix_timestamp(at)) / 3600).alias("hours"))


def stays(events: DataFrame, days: int, container: str = "container_no", kind: str = "type", into: str = "in_time", out: str = "out_time") -> DataFrame:
    """(container_no, in_time, out_time, hours, form) from gate events with timestamps: every stay of each container, and what is left over.

    direct: an OUT that carries both times in order; its own in time counts. paired: an OUT with the latest IN of its container that no OUT has taken, at most ``days`` before it.
    lost_out: an IN that no OUT takes within that time; lost_in: an OUT without an IN. Messages of one container, kind and time are one event; those without a container or their own time don't count.

    INs and OUTs nest like brackets: the depth of open INs is a running sum less its running minimum below zero, and the next event at an IN's depth is the OUT that takes it.
    So one shuffle by container and two sorts, whatever order the losses come in; nothing is compared across a window of time.
    """
    is_in = F.col(kind) == "GATE_IN"
    own = F.when(is_in, F.col(into)).when(F.col(kind) == "GATE_OUT", F.col(out))
    rows = events.select(F.col(container).alias("container_no"), F.when(is_in, 1).otherwise(-1).alias("step"), own.alias("at"), F.when(~is_in & (F.col(into) <= F.col(out)), F.col(into)).alias("carried"))
    once = rows.filter("container_no is not null and at is not null").groupBy("container_no", "step", "at").agg(F.max("carried").alias("carried"))
    line = Window.partitionBy("container_no").orderBy("at", F.desc("step"))
    far = line.rowsBetween(Window.unboundedPreceding, 0)
    summed = once.withColumn("sum", F.sum("step").over(far)).withColumn("low", F.least(F.min("sum").over(far), F.lit(0)))
    # Depth after the event; an IN opens the depth it leads to, an OUT closes the one above the depth it leads to.
    deep = summed.withColumn("after", F.col("sum") - F.col("low")).withColumn("before", F.coalesce(F.lag("after").over(line), F.lit(0)))
    level = deep.withColumn("level", F.when(F.col("step") == 1, F.col("after")).when(F.col("before") > 0, F.col("before")).otherwise(0))
    same = Window.partitionBy("container_no", "level").orderBy("at", F.desc("step"))
    met = level.withColumns({"taken": F.lead(F.struct("step", "at")).over(same), "taker": F.lag(F.struct("step", "at")).over(same)})
    near = lambda a, b: F.unix_timestamp(b) - F.unix_timestamp(a) <= days * 86400
    partner = F.when((F.col("step") == -1) & (F.col("level") > 0) & (F.col("taker.step") == 1) & near(F.col("taker.at"), F.col("at")), F.col("taker.at"))
    closed = (F.col("taken.step") == -1) & near(F.col("at"), F.col("taken.at"))
    form = F.when(F.col("step") == 1, F.when(~F.coalesce(closed, F.lit(False)), "lost_out")).when(F.col("carried").isNotNull(), "direct").when(partner.isNotNull(), "paired").otherwise("lost_in")
    begin = F.when(F.col("step") == 1, F.col("at")).otherwise(F.coalesce("carried", partner))
    end = F.when(F.col("step") == -1, F.col("at"))
    found = met.select("container_no", begin.alias("in_time"), end.alias("out_time"), form.alias("form")).filter("form is not null")
    return found.withColumn("hours", (F.unix_timestamp("out_time") - F.unix_timestamp("in_time")) / 3600)


def discover_candidates(plans: DataFrame, catalog: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(candidates, rejected) from plan rows (vesselcode, voyage, vessel_en_name, eta): one row per trimmed pair. Pairs for which ``reason`` isn't
    empty are rejected; those in the catalog already are dropped; known vessels are flagged."""
    trimmed = plans.withColumns({c: filled(F.col(c)) for c in ("vesselcode", "voyage")})
    pairs = trimmed.groupBy("vesselcode", "voyage").agg(F.min("eta").alias("first_eta"), F.max("eta").alias("last_eta"), F.max("vessel_en_name").alias("vessel_en_name"), F.count("*").alias("source_plan_rows")).withColumn("reason", reason)
    known = catalog.select("vesselcode").distinct().withColumn("_known", F.lit(True))
    good = pairs.filter("reason = ''").drop("reason").join(catalog.select("vesselcode", "voyage").distinct(), ["vesselcode", "voyage"], "left_anti")
    return good.join(known, "vesselcode", "left").withColumn("vessel_in_catalog", F.coalesce("_known", F.lit(False))).drop("_known"), pairs.filter("reason <> ''").select("vesselcode", "voyage", "reason")


def month_evidence(plans: DataFrame) -> DataFrame:
    """(vesselcode, voyage, eta_month, first_eta, last_eta, rows) of plans."""
    return plans.groupBy("vesselcode", "voyage", F.date_format("eta", "yyyy-MM").alias("eta_month")).agg(F.min("eta").alias("first_eta"), F.max("eta").alias("last_eta"), F.count("*").alias("rows"))


def in_eta_window(candidates: DataFrame, evidence: DataFrame, start, end) -> DataFrame:
    """Candidates with evidence that overlaps [start, end)."""
    inside = evidence.filter((F.col("last_eta") >= F.lit(start)) & (F.col("first_eta") < F.lit(end)))
    return candidates.join(inside.select("vesselcode", "voyage"), ["vesselcode", "voyage"], "left_semi")


def active_voyages(voyages: DataFrame, now, past_days: int = 7, future_days: int = 14, unknown_days: int = 14) -> DataFrame:
    """Voyages whose close time is near, or unknown with a recent change or none, or that were never filled."""
    now = F.lit(now)
    near = F.col("portclose_at").between(now - F.expr(f"interval {past_days} days"), now + F.expr(f"interval {future_days} days"))
    fresh = F.col("last_change_at").isNull() | (F.col("last_change_at") >= now - F.expr(f"interval {unknown_days} days"))
    return voyages.filter(F.coalesce(near, F.lit(False)) | (F.col("portclose_at").isNull() & fresh) | (F.coalesce("backfilled", F.lit(0)) == 0))


def pending_units(voyages: DataFrame, catalog: DataFrame) -> DataFrame:
    """One unit per voyage and unfinished direction; those in the current catalog first."""
    current = catalog.select("vesselcode", "voyage").distinct().withColumn("_in", F.lit(True))
    rows = voyages.join(current, ["vesselcode", "voyage"], "left").select("vesselcode", "voyage", F.when(F.col("_in"), 0).otherwise(1).alias("priority"), F.explode(F.array(F.struct(F.lit("GATE_IN").alias("direction"), F.col("in_done_at").alias("done")), F.struct(F.lit("GATE_OUT").alias("direction"), F.col("out_done_at").alias("done")))).alias("u"))
    return rows.filter("u.done is null").select("vesselcode", "voyage", "priority", "u.direction")


def pivot_status(rows: DataFrame, by: Column, statuses: list[str]) -> DataFrame:
    """Counts by status in columns, and the share that is complete."""
    out = rows.groupBy(by.alias("period")).pivot("status", statuses).count().na.fill(0)
    total = sum((F.col(s) for s in statuses[1:]), F.col(statuses[0]))
    return out.withColumn("completion", F.try_divide(F.col("complete"), total)) if "complete" in statuses else out
