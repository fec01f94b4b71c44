"""Daily and weekly flow aggregates, and gate throughput."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.codes import teu
from tidewright.functions.text import flow_date, has_value, week_start
from tidewright.operators.asof import latest

FLOW_KEYS = ["flow_date", "terminal", "direction", "route", "cargo_group", "operator"]
#: A delay outside these hours is an error of the source; what lies further ahead than so many days, or before that date, is no plan.
DELAY_HOURS, HORIZON_DAYS, FIRST_DATE = (0, 720), 180, dt.date(2000, 1, 1)
SUMS = ["vgm_count", "vgm_weight_kg", "release_count", "release_weight", "release_weight_kg", "release_volume", "release_pieces", "transship_count", "transship_weight", "transship_volume", "planned_calls", "actual_calls"]


def delay_hours(planned: Column, actual: Column) -> Column:
    hours = (F.unix_timestamp(actual) - F.unix_timestamp(planned)) / 3600
    return valid_delay(hours)


def valid_delay(hours: Column) -> Column:
    return F.when(hours.between(*DELAY_HOURS), hours)


def allowed_date(date: Column, anchor: dt.date, start: dt.date | None = None, end: dt.date | None = None) -> Column:
    """Within [start, end], not before FIRST_DATE and at most HORIZON_DAYS after the anchor; as plain bounds, so partitions are pruned."""
    return date.between(F.lit(max(start or FIRST_DATE, FIRST_DATE)), F.lit(min(end or dt.date.max, anchor + dt.timedelta(days=HORIZON_DAYS))))


def latest_plans(snapshots: DataFrame, tie: list[str]) -> DataFrame:
    """The last snapshot of each natural identity."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("vessel_code", "voyage", "terminal", "direction")]
    return latest(snapshots, keys, ["snapshot_time", *tie])


def daily_flow(vgm: DataFrame, release: DataFrame, transship: DataFrame, plans: DataFrame, anchor: dt.date | None = None, start: dt.date | None = None, end: dt.date | None = None, apart: tuple[str, ...] = ()) -> DataFrame:
    """Four facts in one bucket of six keys, and of the columns ``apart`` that keep rebuilds for several moments apart. Facts bring what they have of FLOW_KEYS (absent: empty; a transshipment's missing cargo
    group: UNKNOWN) and their measures: vgm weight_kg; release bill_no, weight, weight_kg, volume, pieces; transship container_no, weight, volume;
    plans arrived (boolean), arrival_delay_h, departure_delay_h. Sums of nothing are 0, delays of nothing null.

    With an ``anchor`` only dates that ``allowed_date`` allows count. One union and one aggregate, combined before the only shuffle.
    """

    def part(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
        keys = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) if k in df.columns else F.lit("").alias(k) for k in FLOW_KEYS[1:]]
        return df.select(*apart, "flow_date", *keys, *[c.alias(n) for n, c in measures.items()])

    one = lambda c: F.when(c, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    if "cargo_group" in transship.columns:
        transship = transship.withColumn("cargo_group", F.coalesce("cargo_group", F.lit("UNKNOWN")))
    else:
        transship = transship.withColumn("cargo_group", F.lit("UNKNOWN"))
    parts = [
        part(vgm, {"vgm_count": F.lit(1).cast("bigint"), "vgm_weight_kg": F.col("weight_kg")}),
        part(release, {"release_count": one(has_value(F.col("bill_no"))), "release_weight": F.col("weight"), "release_weight_kg": F.col("weight_kg"), "release_volume": F.col("volume"), "release_pieces": F.col("pieces")}),
        part(transship, {"transship_count": one(has_value(F.col("container_no"))), "transship_weight": F.col("weight"), "transship_volume": F.col("volume")}),
        part(plans, {"planned_calls": F.lit(1).cast("bigint"), "actual_calls": one(F.col("arrived")), "arrival_delay": valid_delay(F.col("arrival_delay_h")), "departure_delay": valid_delay(F.col("departure_delay_h"))}),
    ]
    if anchor is not None:
        parts = [p.filter(allowed_date(F.col("flow_date"), anchor, start, end)) for p in parts]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.groupBy(*apart, *FLOW_KEYS).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS], F.avg("arrival_delay").alias("avg_arrival_delay"), F.avg("departure_delay").alias("avg_departure_delay"))


def weekly_flow(daily: DataFrame) -> DataFrame:
    """Sums of daily rows by ISO week; a week's delay is the plain mean of its daily means."""
    keys = [week_start(F.col("flow_date")).alias("week_start"), *FLOW_KEYS[1:]]
    return daily.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], *[F.avg(c).alias(c) for c in ("avg_arrival_delay", "avg_departure_delay")])


def gate_daily(events: DataFrame, quarantined: DataFrame, anchor: dt.date | None = None, apart: tuple[str, ...] = ()) -> DataFrame:
    """Gate throughput by day and direction from events (type, direction, container_no, size_code, in_time, out_time, vesselcode, voyage), and by the columns ``apart``.

    IN or OUT is said by ``type`` alone: an OUT event may carry an old in time. A container counts once a day, direction and kind, with its
    largest TEU, whatever the case of its number and the spaces around it; events without a number or a time don't count. Quarantined pairs are left out, and
    with an ``anchor`` so are dates that ``allowed_date`` doesn't allow.
    """
    # Two narrow branches: the type reaches the scan, each reads one time column, and a day is one short expression.
    parts = []
    for kind, at in (("IN", "in_time"), ("OUT", "out_time")):
        own = events.filter(F.col("type") == f"GATE_{kind}").select(*apart, "vesselcode", "voyage", F.coalesce("direction", F.lit("")).alias("direction"), F.lit(kind).alias("kind"), F.upper(F.trim("container_no")).alias("container_no"), F.col(at).alias("at"), "size_code")
        parts.append(own.filter("container_no <> '' and at is not null"))
    rows = parts[0].unionByName(parts[1]).join(quarantined.select("vesselcode", "voyage").distinct(), ["vesselcode", "voyage"], "left_anti")
    moves = rows.select(*apart, "direction", "kind", "container_no", flow_date(F.col("at")).alias("flow_date"), teu(F.col("size_code")).alias("teu")).filter("flow_date is not null")
    if anchor is not None:
        moves = moves.filter(allowed_date(F.col("flow_date"), anchor))
    into, out = F.col("kind") == "IN", F.col("kind") == "OUT"
    once = moves.groupBy(*apart, "flow_date", "direction", "container_no").agg(
        F.bool_or(into).alias("into"), F.bool_or(out).alias("out"), F.max(F.when(into, F.col("teu"))).alias("in_teu"), F.max(F.when(out, F.col("teu"))).alias("out_teu")
    )
    return once.groupBy(*apart, "flow_date", "direction").agg(
        F.count_if("into").alias("in_count"), F.count_if("out").alias("out_count"), F.count("*").alias("unique_containers"), *[F.coalesce(F.sum(f"{k}_teu"), F.lit(0.0)).alias(f"{k}_teu") for k in ("in", "out")],
        *[F.count(f"{k}_teu").alias(f"{k}_teu_known") for k in ("in", "out")],
    )


def gate_coverage(daily: DataFrame) -> DataFrame:
    """Share of counted moves whose TEU is known, and the range of dates."""
    known, moves = F.sum(F.col("in_teu_known") + F.col("out_teu_known")), F.sum(F.col("in_count") + F.col("out_count"))
    return daily.agg(F.try_divide(known, moves).alias("coverage"), F.min("flow_date").alias("first_date"), F.max("flow_date").alias("last_date"))
