"""Curves: time series by type and entity, and what is read off them. An entity is one series; windows go along it, never over all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.text import week_start

#: Weights of the pressure index by curve type.
PRESSURE_WEIGHTS = {"vgm": 0.30, "cargo_release": 0.20, "transshipment": 0.15, "arrival_delay": 0.15, "departure_delay": 0.10, "plan_revision": 0.10}
#: Curve types by the column of a daily or weekly aggregate that they are summed from, or averaged from; and those of gate throughput.
SUM_CURVES = {
    "planned_demand": "planned_calls", "vgm": "vgm_weight_kg", "cargo_release": "release_weight_kg", "cargo_release_piece_count": "release_pieces", "transshipment": "transship_weight",
    "container_vgm_count": "vgm_count", "released_bill_count": "release_count", "transshipment_container_count": "transship_count",
}
MEAN_CURVES = {"arrival_delay": "avg_arrival_delay", "departure_delay": "avg_departure_delay"}
GATE_CURVES = {"gate_in_container_count": "in_count", "gate_out_container_count": "out_count", "gate_in_teu": "in_teu", "gate_out_teu": "out_teu"}
SERIES = ["entity_key", "curve_type", "granularity", "model_version"]


def revision_points(snapshots: DataFrame, tie: list[str]) -> DataFrame:
    """(flow_date, terminal, direction '', value 1) for each snapshot whose content differs from the one before of the same identity, in order of time."""
    w = Window.partitionBy("vessel_code", "voyage", "terminal", "direction").orderBy("snapshot_time", *tie)
    changed = snapshots.withColumn("_before", F.lag("record_hash").over(w)).filter("_before is not null and not (_before <=> record_hash)")
    return changed.select(F.to_date("snapshot_time").alias("flow_date"), "terminal", F.lit("").alias("direction"), F.lit(1.0).alias("value"))


def build_curves(gold: DataFrame, bucket: str, granularity: str, model_version: str, gate: DataFrame | None = None, revisions: DataFrame | None = None) -> DataFrame:
    """(curve_type, entity_key, granularity, model_version, time_bucket, value): the metrics of daily or weekly aggregates, summed or averaged
    over an entity ``terminal:direction``; of daily gate throughput over all terminals; and numbers of plan revisions. ``granularity`` week takes days to their Monday."""

    def melted(rows: DataFrame, at: Column, terminal: Column, metrics: dict[str, Column], means: tuple[str, ...] = ()) -> DataFrame:
        entity = F.concat_ws(":", F.coalesce(F.nullif(F.trim(terminal), F.lit("")), F.lit("UNKNOWN")), F.coalesce("direction", F.lit("")))
        each = F.array(*[F.struct(F.lit(m).alias("curve_type"), c.cast("double").alias("value"), F.lit(m in means).alias("mean")) for m, c in metrics.items()])
        return rows.select(at.alias("time_bucket"), entity.alias("entity_key"), F.explode(each).alias("m")).select("time_bucket", "entity_key", "m.*").filter("value is not null")

    day = week_start(F.col("flow_date")) if granularity == "week" else F.col("flow_date")
    long = melted(gold, F.col(bucket), F.col("terminal"), {m: F.col(c) for m, c in (SUM_CURVES | MEAN_CURVES).items()}, tuple(MEAN_CURVES))
    if gate is not None:
        long = long.unionByName(melted(gate, day, F.lit("ALL_GATE_TERMINALS"), {m: F.col(c) for m, c in GATE_CURVES.items()}))
    if revisions is not None:
        long = long.unionByName(melted(revisions, day, F.col("terminal"), {"plan_revision": F.col("value")}))
    value = F.when(F.first("mean"), F.avg("value")).otherwise(F.sum("value"))
    return long.groupBy("curve_type", "entity_key", "time_bucket").agg(value.alias("value")).select("curve_type", "entity_key", F.lit(granularity).alias("granularity"), F.lit(model_version).alias("model_version"), "time_bucket", "value")


def with_completeness(curves: DataFrame, step_days: int) -> DataFrame:
    """Expected buckets of each series by its span, observed ones, their ratio and a flag."""
    w = Window.partitionBy(*SERIES)
    expected = F.datediff(F.max("time_bucket").over(w), F.min("time_bucket").over(w)) / step_days + 1
    out = curves.withColumns({"expected": expected.cast("bigint"), "observed": F.count("*").over(w)})
    out = out.withColumn("completeness", F.col("observed") / F.col("expected"))
    return out.withColumn("quality_flag", F.when(F.col("completeness") >= 1, "complete").otherwise("partial"))


def with_moving_average(curves: DataFrame, points: int = 4) -> DataFrame:
    """Mean of the last ``points`` rows, by row and not by time."""
    w = Window.partitionBy(*SERIES).orderBy("time_bucket").rowsBetween(1 - points, 0)
    return curves.withColumn("moving_avg", F.avg("value").over(w))


def with_zscore(curves: DataFrame) -> DataFrame:
    """Population z-score inside a series; 0 where its values don't vary."""
    w = Window.partitionBy(*SERIES)
    sd = F.stddev_pop("value").over(w)
    return curves.withColumn("z", F.when(sd > 0, (F.col("value") - F.avg("value").over(w)) / sd).otherwise(0.0))


def pressure_index(scored: DataFrame, weights: dict[str, float] = PRESSURE_WEIGHTS, include_revision: bool = False) -> DataFrame:
    """Weighted z-scores of an entity's curves at each time; weights are renormalised over the curves there are, and ``contributions`` add up to the value.
    ``plan_revision`` takes part only if asked to, and is missing otherwise."""
    table = F.create_map(*[F.lit(x) for k, v in weights.items() if include_revision or k != "plan_revision" for x in (k, v)])
    rows = scored.withColumn("_w", table[F.col("curve_type")]).filter("_w is not null")
    parts = F.map_from_entries(F.array_sort(F.collect_list(F.struct("curve_type", (F.col("_w") * F.col("z")).alias("part")))))
    out = rows.groupBy("entity_key", "granularity", "model_version", "time_bucket").agg((F.sum(F.col("_w") * F.col("z")) / F.sum("_w")).alias("value"), F.sum("_w").alias("_w"), parts.alias("contributions"))
    out = out.withColumn("contributions", F.transform_values("contributions", lambda _, v: v / F.col("_w"))).drop("_w")
    return out.withColumn("missing", F.array_sort(F.array_except(F.array(*map(F.lit, weights)), F.map_keys("contributions"))))


def change_points(curves: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Places i from 2 to n - 3 of a series (n >= 5) where the means before and from i on differ by ``threshold`` population deviations.

    The mean behind i is the series' sum less the sum before: one running window instead of a shrinking one, so cost is linear in n.
    """
    rows = curves.filter("value is not null")
    whole, running = Window.partitionBy(*SERIES), Window.partitionBy(*SERIES).orderBy("time_bucket")
    exact = F.col("value").cast("decimal(28,6)")
    rows = rows.withColumns({"n": F.count("*").over(whole), "i": F.row_number().over(running) - 1, "_total": F.sum(exact).over(whole), "_sd": F.stddev_pop("value").over(whole)})
    rows = rows.withColumn("_before", F.sum(exact).over(running.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.filter("n >= 5 and i >= 2 and i <= n - 3")
    left, right = F.col("_before").cast("double") / F.col("i"), (F.col("_total") - F.col("_before")).cast("double") / (F.col("n") - F.col("i"))
    score = F.abs(right - left) / F.when(F.col("_sd") == 0, 1.0).otherwise(F.col("_sd"))
    return rows.select(*SERIES, "time_bucket", left.alias("before_mean"), right.alias("after_mean"), score.alias("score")).filter(F.col("score") >= threshold)


def anomalies(curves: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Values at least ``threshold`` population deviations from the mean of a series of three or more."""
    w = Window.partitionBy(*SERIES)
    rows = curves.filter("value is not null").withColumns({"n": F.count("*").over(w), "mean": F.avg("value").over(w), "sd": F.stddev_pop("value").over(w)})
    score = F.try_divide(F.abs(F.col("value") - F.col("mean")), F.col("sd"))
    return rows.withColumn("score", score).filter((F.col("n") >= 3) & (F.col("score") >= threshold)).select(*SERIES, "time_bucket", "value", "score")


def _growth(value: Column, past: Column) -> Column:
    return F.when(past != 0, (value - past) / F.abs(past))


def trends(curves: DataFrame) -> DataFrame:
    """Latest growth over 1, 4 and 13 points, deviation of the last 13, data quality (a partial point counts half, one without a value too) and a state by ordered
    rules; the deviation is compared with the mean of all points. Points without a value are left out before places are counted."""
    order = [F.col("value").isNotNull().cast("int")]
    w = Window.partitionBy(*SERIES, *order).orderBy("time_bucket")
    back = Window.partitionBy(*SERIES, *order).orderBy(F.desc("time_bucket"))
    rows = curves.withColumns({f"g{k}": _growth(F.col("value"), F.lag("value", k).over(w)) for k in (1, 4, 13)} | {"_r": F.when(F.col("value").isNotNull(), F.row_number().over(back))})
    last = lambda c: F.max(F.when(F.col("_r") == 1, F.col(c)))
    recent = F.when(F.col("_r") <= 13, F.col("value"))
    out = rows.groupBy(*SERIES).agg(
        F.max("time_bucket").alias("time_bucket"), last("value").alias("value"), *[last(f"g{k}").alias(f"g{k}") for k in (1, 4, 13)], F.stddev_pop(recent).alias("volatility"),
        F.avg("value").alias("_mean"), F.avg(F.when(F.col("quality_flag") == "complete", 1.0).otherwise(0.5)).alias("data_quality"),
    ).filter("_mean is not null")
    state = (
        F.when(F.col("data_quality") < 0.8, "data_insufficient").when(F.col("g4") > 0.1, "growth").when(F.col("g4") < -0.1, "decline")
        .when((F.col("_mean") != 0) & (F.col("volatility") > F.abs("_mean")), "high_volatility").otherwise("stable")
    )
    return out.withColumn("state", state).drop("_mean")


def features(curves: DataFrame, seasonal_lag: tuple[int, int] = (4, 7)) -> DataFrame:
    """One feature row per series: mean, median, deviation, its ratio to the mean, slope, growth, peak ratio, share of zeros, autocorrelation at
    lag 1 and at a seasonal lag (the second from 14 points on; null with fewer than two pairs), and completeness where given. A curve of delays has their mean and
    nearest-rank 90th percentile, one of transshipments a share of 1. Undefined ones are null; seasonal strength and frequency of revisions aren't known from one curve and are 0."""
    w = Window.partitionBy(*SERIES).orderBy("time_bucket")
    whole = Window.partitionBy(*SERIES)
    rows = curves.filter("value is not null").withColumns({"i": F.row_number().over(w) - 1, "n": F.count("*").over(whole), "l1": F.lag("value", 1).over(w), "la": F.lag("value", seasonal_lag[0]).over(w), "lb": F.lag("value", seasonal_lag[1]).over(w), "g4": _growth(F.col("value"), F.lag("value", 4).over(w)), "g13": _growth(F.col("value"), F.lag("value", 13).over(w))})
    lagged = F.when(F.col("n") < 14, F.col("la")).otherwise(F.col("lb"))

    def correlation(x: Column) -> Column:
        """From sums over the pairs; 0 where either doesn't vary."""
        y = F.when(x.isNotNull(), F.col("value"))
        c = F.covar_pop(x, y)
        d = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(y)
        return F.when(F.count(y) > 1, F.when(d > 0, c / d).otherwise(0.0))

    last = lambda c: F.max(F.when(F.col("i") == F.col("n") - 1, F.col(c)))
    out = rows.groupBy(*SERIES).agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.median("value").alias("median"), F.stddev_pop("value").alias("sd"),
        F.try_divide(F.covar_pop("i", "value"), F.var_pop("i")).alias("slope"), last("g4").alias("growth_4"), last("g13").alias("growth_13"), F.max("value").alias("_peak"),
        F.expr("percentile_disc(0.9) within group (order by value)").alias("_p90"),
        F.avg(F.when(F.col("value") == 0, 1.0).otherwise(0.0)).alias("zero_ratio"), correlation(F.col("l1")).alias("autocorr_1"), correlation(lagged).alias("autocorr_seasonal"),
    )
    delay = F.col("curve_type") == "arrival_delay"
    out = out.withColumns({"arrival_delay_mean": F.when(delay, F.col("mean")), "arrival_delay_p90": F.when(delay, F.col("_p90")), "transshipment_share": F.when(F.col("curve_type") == "transshipment", 1.0).otherwise(0.0), "seasonal_strength": F.lit(0.0), "plan_revision_frequency": F.lit(0.0)})
    return out.withColumns({"cv": F.coalesce(F.try_divide("sd", F.abs("mean")), F.lit(0.0)), "peak_ratio": F.try_divide("_peak", "median")}).drop("_peak", "_p90")


def delay_profile(delays: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and nearest-rank 90th percentile per key."""
    return delays.filter(F.col(value).isNotNull()).groupBy(key).agg(F.avg(value).alias("delay_mean"), F.expr(f"percentile_disc(0.9) within group (order by `{value}`)").alias("delay_p90"))


def latest_average(curves: DataFrame, points: int = 4) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.desc("time_bucket")))
    return curves.withColumn("_r", rank).filter(F.col("_r") <= points).groupBy(*SERIES).agg(F.avg("value").alias("latest_avg"))


def rollup_curves(curves: DataFrame, curve_type: str, mean: bool = False) -> DataFrame:
    """One curve over all entities."""
    return curves.filter(F.col("curve_type") == curve_type).groupBy("time_bucket").agg((F.avg if mean else F.sum)("value").alias("value"))


def top_entities(curves: DataFrame, curve_type: str, k: int = 8) -> DataFrame:
    """The curves of the ``k`` entities with the largest sums."""
    rows = curves.filter(F.col("curve_type") == curve_type)
    best = rows.groupBy("entity_key").agg(F.sum("value").alias("_s")).orderBy(F.desc("_s"), "entity_key").limit(k)
    return rows.join(best.select("entity_key"), "entity_key", "left_semi")


def recent_buckets(curves: DataFrame, weeks: int) -> DataFrame:
    """Only the last ``weeks`` of each series."""
    w = Window.partitionBy(*SERIES)
    return curves.withColumn("_last", F.max("time_bucket").over(w)).filter(F.datediff("_last", "time_bucket") < 7 * weeks).drop("_last")


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
