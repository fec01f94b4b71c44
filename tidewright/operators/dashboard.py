"""What a dashboard shows, as one long table: roll-ups, the largest entities, cards and coverage."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.gold import DELAY_HOURS
from tidewright.operators.series import latest_average

#: Sections, the curves in each, how entities are put together and what a value is divided by (kilograms are shown in tonnes).
SECTIONS = {
    "traffic": {"planned_demand": ("sum", 1.0), "released_bill_count": ("sum", 1.0)}, "gate": {"gate_in_teu": ("sum", 1.0), "gate_out_teu": ("sum", 1.0)}, "cargo": {"cargo_release": ("sum", 1000.0)},
    "samples": {"container_vgm_count": ("sum", 1.0), "transshipment_container_count": ("sum", 1.0)}, "delays": {"arrival_delay": ("mean", 1.0), "departure_delay": ("mean", 1.0)},
}
#: Sections that are withheld until their coverage was audited; curves shown by entity; the curve that says which entities are largest; entities and periods of a card.
WITHHELD, BY_ENTITY, RANKED_BY, LARGEST, PERIODS = ("gate",), {"terminals": "planned_demand", "pressure": "pressure_index"}, "planned_demand", 8, 4


def shown_points(curves: DataFrame, anchor: dt.date, weeks: int = 156, granularity: str = "week", model_version: str = "v1") -> DataFrame:
    """Curve points of a window of ``weeks`` (4 at least) up to a week after the anchor. Filters reach the scan."""
    start, end = anchor - dt.timedelta(weeks=max(4, weeks)), anchor + dt.timedelta(days=7)
    return curves.filter((F.col("granularity") == granularity) & (F.col("model_version") == model_version) & F.col("time_bucket").between(F.lit(start), F.lit(end)))


def finite(value: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def section_points(points: DataFrame, coverage_validated: bool) -> DataFrame:
    """(section, name, time_bucket, value): each curve of SECTIONS over all entities. Values that aren't finite don't count, nor do delays outside of DELAY_HOURS. One aggregate for all."""
    table = [(s, c, how, by) for s, curves in SECTIONS.items() if coverage_validated or s not in WITHHELD for c, (how, by) in curves.items()]
    place = F.create_map(*[x for s, c, how, by in table for x in (F.lit(c), F.struct(F.lit(s).alias("section"), F.lit(how).alias("how"), F.lit(by).alias("by")))])
    rows = points.withColumn("_p", place[F.col("curve_type")]).filter(F.col("_p").isNotNull() & finite(F.col("value")))
    rows = rows.filter((F.col("_p.how") != "mean") | F.col("value").between(*DELAY_HOURS))
    out = rows.groupBy(F.col("_p.section").alias("section"), F.col("curve_type").alias("name"), "time_bucket").agg(F.first("_p.how").alias("how"), F.first("_p.by").alias("by"), F.sum("value").alias("s"), F.avg("value").alias("m"))
    return out.select("section", "name", "time_bucket", F.when(F.col("how") == "mean", F.col("m")).otherwise(F.col("s") / F.col("by")).alias("value"))


def largest_entities(points: DataFrame, n: int = LARGEST) -> DataFrame:
    """(entity_key): the ``n`` entities with the most of RANKED_BY; ties by name."""
    scores = points.filter((F.col("curve_type") == RANKED_BY) & F.col("value").isNotNull()).groupBy("entity_key").agg(F.sum("value").alias("_score"))
    return scores.orderBy(F.desc("_score"), "entity_key").limit(n).select("entity_key")


def dashboard_points(curves: DataFrame, anchor: dt.date, weeks: int = 156, coverage_validated: bool = False) -> DataFrame:
    """(section, name, time_bucket, value) of everything that is drawn: roll-ups by section, and the series of the largest entities (section terminals: demand, pressure: the index).

    Gate series stay out until ``coverage_validated``: what was read of history is known to be partial.
    """
    points = shown_points(curves, anchor, weeks)
    names = {c: s for s, c in BY_ENTITY.items()}
    of_entities = points.filter(F.col("curve_type").isin(*names) & finite(F.col("value"))).join(largest_entities(points), "entity_key")
    section = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("curve_type")]
    return section_points(points, coverage_validated).unionByName(of_entities.select(section.alias("section"), F.col("entity_key").alias("name"), "time_bucket", "value"))


def dashboard_cards(curves: DataFrame, states: DataFrame, anchor: dt.date, weeks: int = 156) -> DataFrame:
    """(name, value): means of the last PERIODS points of demand, released bills and arrival delay, and the number of containers in the catalog; null without data."""
    drawn = section_points(shown_points(curves, anchor, weeks), False)
    cards = {"planned": "planned_demand", "released": "released_bill_count", "arrival": "arrival_delay"}
    series = drawn.filter(F.col("name").isin(*cards.values())).select(F.col("name").alias("curve_type"), F.lit("").alias("entity_key"), F.lit("").alias("granularity"), F.lit("").alias("model_version"), "time_bucket", "value")
    means = latest_average(series, PERIODS).select(F.col("curve_type"), F.col("latest_avg").alias("value"))
    spark = curves.sparkSession
    names = spark.createDataFrame(list(cards.items()), "name string, curve_type string")
    return names.join(means, "curve_type", "left").select("name", "value").unionByName(states.agg(F.lit("containers").alias("name"), F.count("*").cast("double").alias("value")))


def dashboard_coverage(curves: DataFrame, states: DataFrame, gate: DataFrame, anchor: dt.date, weeks: int = 156, coverage_validated: bool = False) -> DataFrame:
    """(name, value) texts: containers in the catalog, how many were asked for, rows of gate events, first and last day of gate throughput, share of moves with a known size, points shown."""
    points = shown_points(curves, anchor, weeks)
    done = lambda c: F.count_if(F.col(c) == "complete").cast("string")
    a = states.agg(F.count("*").cast("string").alias("catalog_containers"), done("vgm_status").alias("vgm_queried"), done("history_status").alias("history_queried"), F.coalesce(F.sum("gate_event_count"), F.lit(0)).cast("bigint").cast("string").alias("gate_source_rows"))
    moves, known = F.sum(F.col("in_count") + F.col("out_count")), F.sum(F.col("in_teu_known") + F.col("out_teu_known"))
    b = gate.agg(F.min("flow_date").cast("string").alias("gate_start"), F.max("flow_date").cast("string").alias("gate_end"), F.format_number(F.coalesce(F.try_divide(known, moves), F.lit(0.0)), 6).alias("teu_size_coverage"))
    buckets = lambda c: F.countDistinct(F.when((F.col("curve_type") == c) & finite(F.col("value")), F.col("time_bucket")))
    c = points.agg(F.count("*").cast("string").alias("displayed_points"), (buckets("gate_in_teu") + buckets("gate_out_teu")).cast("string").alias("gate_observed_points"), F.lit(str(coverage_validated).lower()).alias("gate_history_validated"))
    tall = [df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in df.columns])).alias("p")).select("p.*") for df in (a, b, c)]
    return reduce(DataFrame.unionByName, tall)
