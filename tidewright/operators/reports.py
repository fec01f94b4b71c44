"""Roll-ups over runs, queues, tables and movements, and the orders in which work is taken."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.text import has_value

#: A run reads again what came up to so long before its last watermark, and takes rows up to so far ahead.
OVERLAP, AHEAD = dt.timedelta(hours=2), dt.timedelta(hours=24)


def incremental_window(runs: DataFrame, kinds: list[str], now: dt.datetime, manual: tuple[str, str] | None = None) -> tuple[dt.datetime | None, dt.datetime]:
    """(from, to) of the next run: after the latest watermark of a successful run, less OVERLAP, to now plus AHEAD; or two 14-digit stamps given by hand."""
    if manual:
        low, high = (dt.datetime.strptime(x, "%Y%m%d%H%M%S") for x in manual)
        return low, high
    mark = runs.filter(F.col("kind").isin(*kinds) & (F.col("status") == "ok")).agg(F.max("watermark_to")).first()[0]
    return (None if mark is None else mark - OVERLAP), now + AHEAD


def in_window(rows: DataFrame, at: str, low: dt.datetime | None, high: dt.datetime) -> DataFrame:
    """Rows of the window; a plain filter, so it reaches the scan."""
    return rows.filter((F.col(at) <= F.lit(high)) & (F.lit(True) if low is None else F.col(at) >= F.lit(low)))


def queue_order(rows: DataFrame, first: dict[str, int], newest: str, tie: str, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Work in order of status (``first`` gives ranks, others last), newest first, nulls last, then id. With a limit a distributed top-k."""
    rank = reduce(lambda acc, x: acc.when(F.col("status") == x[0], x[1]), first.items(), F.when(F.lit(False), 0)).otherwise(len(first))
    out = rows.orderBy(rank, F.desc_nulls_last(newest), tie)
    return out if limit is None else out.offset(offset).limit(limit)


def smallest_first(rows: DataFrame, size: str, tie: str) -> DataFrame:
    return rows.orderBy(F.asc_nulls_last(size), tie)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) of each table: one row a table, counted from the files' footers where Spark can."""
    return reduce(lambda a, b: a.unionByName(b), [df.agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name, df in tables.items()])


def coverage(events: DataFrame, kind: str, container: str) -> DataFrame:
    """Events, containers, moves in and out."""
    return events.agg(F.count("*").alias("events"), F.countDistinct(container).alias("containers"), F.count_if(F.col(kind) == "GATE_IN").alias("moves_in"), F.count_if(F.col(kind) == "GATE_OUT").alias("moves_out"))


def throughput(runs: DataFrame, since: dt.datetime, until: dt.datetime) -> DataFrame:
    """Of the runs that finished in a stretch of time: how many, requests a second, and how many ran at once on average."""
    done = runs.filter((F.col("finished_at") >= F.lit(since)) & (F.col("finished_at") < F.lit(until)))
    span = (until - since).total_seconds()
    return done.agg(F.count("*").alias("runs"), (F.coalesce(F.sum("requests"), F.lit(0)) / span).alias("requests_per_second"), (F.coalesce(F.sum(F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")), F.lit(0)) / span).alias("concurrency"))


def run_statistics(runs: DataFrame) -> DataFrame:
    """Runs, mean requests and mean minutes by kind."""
    minutes = (F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")) / 60
    return runs.groupBy("kind").agg(F.count("*").alias("runs"), F.avg("requests").alias("avg_requests"), F.avg(minutes).alias("avg_minutes"))


def session_rollup(events: DataFrame) -> DataFrame:
    """First and last success, runs, requests and last failure of each fingerprint; an event that is logged twice counts once."""
    once = events.dropDuplicates(["event_key"])
    ok = F.col("outcome") == "ok"
    return once.groupBy("fingerprint").agg(F.min(F.when(ok, F.col("at"))).alias("first_success"), F.max(F.when(ok, F.col("at"))).alias("last_success"), F.count("*").alias("runs"), F.sum("requests").alias("requests"), F.max(F.when(~ok, F.col("at"))).alias("last_failure"))


def missing_rate(rows: DataFrame, by: str, column: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count("*").alias("n"), (1 - F.avg(F.when(has_value(F.col(column)), 1.0).otherwise(0.0))).alias("missing_rate"))


def shares(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts of each combination and its share of the first key's rows."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(keys[0])))


def mean_in_range(rows: DataFrame, by: str, value: str, low: float, high: float, more_than: int) -> DataFrame:
    """Mean of plausible values per key, for keys that have enough of them."""
    return rows.filter(F.col(value).between(low, high)).groupBy(by).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).filter(F.col("n") > more_than)


def work_list(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Distinct keys of the first source, with those that only later sources have."""
    return reduce(lambda a, b: a.unionByName(b), [s.select(*keys) for s in sources]).dropDuplicates(keys)


def revision_deltas(snapshots: DataFrame, keys: list[str], order: list[str], times: list[str]) -> DataFrame:
    """Hours by which each snapshot moved the given times against the one before, and whether it did."""
    w = Window.partitionBy(*keys).orderBy(*order)
    hours = {f"{t}_delta_h": (F.unix_timestamp(t) - F.unix_timestamp(F.lag(t).over(w))) / 3600 for t in times}
    out = snapshots.withColumns(hours)
    return out.withColumns({f"{t}_changed": F.coalesce(F.col(f"{t}_delta_h") != 0, F.lit(False)) for t in times})


def state_transitions(states: DataFrame, key: str, at: str, state: str) -> DataFrame:
    """(from_state, to_state, n) between neighbouring observations of each key."""
    before = F.lag(state).over(Window.partitionBy(key).orderBy(at))
    return states.withColumn("from_state", before).filter("from_state is not null").groupBy("from_state", F.col(state).alias("to_state")).agg(F.count("*").alias("n"))


def rank_in_partition(rows: DataFrame, keys: list[str], order: list[str | Column], value: str) -> DataFrame:
    """Place, size, least and largest value of each row's partition, from one sort."""
    w = Window.partitionBy(*keys)
    return rows.withColumns({"place": F.row_number().over(w.orderBy(*order)), "size": F.count("*").over(w), "least": F.min(value).over(w), "largest": F.max(value).over(w)})
