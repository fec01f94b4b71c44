"""Further weekly metrics of the facts: lags, weights a container and a bill, anchor delays, and shares of routes and cargo."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.text import has_value, week_start
from tidewright.operators.gold import valid_delay


def _week() -> Column:
    return week_start(F.col("flow_date")).alias("week_start")


def hours_between(early: Column, late: Column) -> Column:
    return (F.unix_timestamp(late) - F.unix_timestamp(early)) / 3600


def vgm_metrics(vgm: DataFrame) -> DataFrame:
    """By week, terminal and direction of VGM facts (flow_date, container_no, weight_kg, operator_time, received_time, result_code): containers, mean weight a container,
    share of results that are Y, and mean hours from the operator's time to the terminal's, where that is not negative."""
    lag = hours_between(F.col("operator_time"), F.col("received_time"))
    box = F.when(has_value(F.col("container_no")), F.upper(F.trim("container_no")))
    once = vgm.groupBy(_week(), "terminal", "direction", box.alias("box")).agg(F.sum("weight_kg").alias("w"), F.count("*").alias("n"), F.count_if(F.col("result_code") == "Y").alias("ok"), F.sum(F.when(lag >= 0, lag)).alias("lag"), F.count(F.when(lag >= 0, lag)).alias("lags"))
    return once.groupBy("week_start", "terminal", "direction").agg(
        F.count("box").alias("containers"), F.try_divide(F.sum(F.when(F.col("box").isNotNull(), F.col("w"))), F.count("box")).alias("weight_per_container"),
        (F.sum("ok") / F.sum("n")).alias("success_rate"), F.try_divide(F.sum("lag"), F.sum("lags")).alias("receive_lag_h"),
    )


def release_metrics(release: DataFrame) -> DataFrame:
    """By week and terminal of release facts (flow_date, bill_no, weight_kg): bills, mean weight a bill of those with a weight."""
    bill = F.when(has_value(F.col("bill_no")), F.trim("bill_no"))
    once = release.groupBy(_week(), "terminal", bill.alias("bill")).agg(F.sum("weight_kg").alias("w"))
    return once.groupBy("week_start", "terminal").agg(F.count("bill").alias("bills"), F.avg(F.when(F.col("bill").isNotNull(), F.col("w"))).alias("weight_per_bill"))


def anchor_delays(plans: DataFrame) -> DataFrame:
    """By week and terminal of plans (flow_date, estimated_anchor, actual_anchor): calls with both times in order, mean hours between them. Implausible ones don't count."""
    delay = valid_delay(hours_between(F.col("estimated_anchor"), F.col("actual_anchor")))
    return plans.groupBy(_week(), "terminal").agg(F.count(delay).alias("calls"), F.avg(delay).alias("anchor_delay_h"))


def mix(rows: DataFrame, part: str, weight: str = "weight") -> DataFrame:
    """(week_start, terminal, part, weight, share): the share of each route, or cargo group, in a terminal's weight of a week; null where nothing weighs anything. Two aggregates, the second over few rows."""
    each = rows.groupBy(_week(), "terminal", F.coalesce(F.col(part), F.lit("UNKNOWN")).alias(part)).agg(F.coalesce(F.sum(weight), F.lit(0)).alias("weight"))
    return each.withColumn("share", F.try_divide(F.col("weight"), F.sum("weight").over(Window.partitionBy("week_start", "terminal"))))


def trimmed(curves: DataFrame) -> DataFrame:
    """``curves`` without the empty ends of each curve type: buckets before the first and after the last that has a value other than 0 in any entity."""
    span = curves.filter("value is not null and value <> 0").groupBy("curve_type").agg(F.min("time_bucket").alias("_first"), F.max("time_bucket").alias("_last"))
    return curves.join(F.broadcast(span), "curve_type").filter(F.col("time_bucket").between(F.col("_first"), F.col("_last"))).drop("_first", "_last")


def without_dead(curves: DataFrame, least_share: float = 0.0001) -> DataFrame:
    """``curves`` without the types whose values are 0 or null but for less than ``least_share`` of their points. The table of types is small: one row a type."""
    live = curves.groupBy("curve_type").agg(F.avg(F.when(F.coalesce(F.col("value"), F.lit(0.0)) != 0, 1.0).otherwise(0.0)).alias("_live")).filter((F.col("_live") > 0) & (F.col("_live") >= least_share))
    return curves.join(F.broadcast(live.select("curve_type")), "curve_type", "left_semi")


def iso_lengths(events: DataFrame, size: str, shorthand: tuple[str, ...] = ("40HQ", "40HC", "45HQ", "40GP", "20GP", "40XX")) -> DataFrame:
    """(iso_length, n): events by the first character of their size code; codes that are shorthand for something else (fixed values) don't count, nor do missing ones."""
    return events.filter(F.col(size).isNotNull() & ~F.col(size).isin(*shorthand)).groupBy(F.substring(size, 1, 1).alias("iso_length")).agg(F.count("*").alias("n"))


def leading(rows: DataFrame, column: str, n: int = 10) -> DataFrame:
    """(value, n, share): the ``n`` most frequent values of a column and their share of all rows that have one."""
    counts = rows.filter(has_value(F.col(column))).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))
    return counts.orderBy(F.desc("n"), "value").limit(n).join(F.broadcast(total)).select("value", "n", (F.col("n") / F.col("_all")).alias("share"))


def events_by_type(events: DataFrame, vesselcode: str, voyage: str) -> DataFrame:
    """(type, n) of one voyage; the filters reach the scan."""
    return events.filter((F.col("vesselcode") == vesselcode) & (F.col("voyage") == voyage)).groupBy("type").agg(F.count("*").alias("n"))


def assignments_with_features(assignments: DataFrame, features: DataFrame, run_id: str, entity_type: str, feature_version: str, columns: list[str]) -> DataFrame:
    """Assignments of one run with the features of the same entity, of its entity type and feature version; entities without stay."""
    known = features.filter((F.col("entity_type") == entity_type) & (F.col("feature_version") == feature_version)).select("entity_key", *columns)
    return assignments.filter(F.col("run_id") == run_id).join(known, "entity_key", "left")


def unknown_counts(rows: DataFrame, layer: str, unknown: Column) -> DataFrame:
    """(layer, n, unknown): rows of each layer, and those whose kind is not known."""
    return rows.groupBy(F.col(layer).alias("layer")).agg(F.count("*").alias("n"), F.count_if(unknown).alias("unknown"))
