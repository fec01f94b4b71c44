"""Reads of versions as they were visible at a cutoff, and fingerprints that tell whether inputs moved."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``, which must tell all rows of a key apart.

    It is the row without one before it. A filter on a rank would have every task sort all it reads before the shuffle, in memory that grows with the scan's splits.
    """
    before = F.lag(F.lit(1)).over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return rows.withColumn("_before", before).filter("_before is null").drop("_before")


def as_of(versions: DataFrame, keys: list[str], cutoff: dt.datetime | None, observed: str = "observed_at", order: list[str] = ("version_id",)) -> DataFrame:
    """The last version of each key observed up to the cutoff; all versions count without one. The cutoff reaches the scan as a filter."""
    seen = versions if cutoff is None else versions.filter(F.col(observed) <= F.lit(cutoff))
    return latest(seen, keys, [observed, *order])


def version_intervals(versions: DataFrame, keys: list[str], observed: str = "observed_at", order: list[str] = ("version_id",)) -> DataFrame:
    """``versions`` with valid_from and valid_to: from when on each was the last of its key, and until when (exclusive; null for the current one).

    Of versions of one moment only the last by ``order`` was ever visible. One shuffle by key.
    """
    w = Window.partitionBy(*keys).orderBy(observed, *order)
    rows = versions.withColumns({"valid_from": F.col(observed), "valid_to": F.lead(observed).over(w)})
    return rows.filter(F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))))


def visible_at(intervals: DataFrame, cutoffs: list[dt.datetime]) -> DataFrame:
    """A row of ``intervals`` for each of the cutoffs at which it was visible, with ``as_of_time``. No join and no second read, however many cutoffs there are."""
    inside = F.filter(F.array(*map(F.lit, sorted(set(cutoffs)))), lambda c: (c >= F.col("valid_from")) & (F.col("valid_to").isNull() | (c < F.col("valid_to"))))
    return intervals.withColumn("as_of_time", F.explode(inside)).drop("valid_from", "valid_to")


def as_of_many(versions: DataFrame, keys: list[str], cutoffs: list[dt.datetime], observed: str = "observed_at", order: list[str] = ("version_id",)) -> DataFrame:
    """``as_of`` for several cutoffs in one pass: versions observed after the last cutoff don't reach the window, and each key is sorted once."""
    seen = versions.filter(F.col(observed) <= F.lit(max(cutoffs)))
    return visible_at(version_intervals(seen, keys, observed, order), cutoffs)


def as_of_join(left: DataFrame, versions: DataFrame, keys: list[str], at: str, observed: str, order: list[str], values: list[str]) -> DataFrame:
    """Each row of ``left`` with the ``values`` of the last version of its keys observed up to its own time ``at``; null without one.

    Both sides are put into one series of each key, in order of time, and each row takes the last version before it: one shuffle and one sort, however many versions
    a key has. Null keys are a key like any other; rows without a time get nothing.
    """
    rest = [c for c in left.columns if c not in keys]
    mine = left.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*rest).alias("_row"))
    theirs = versions.select(*keys, F.col(observed).alias("_t"), F.lit(0).alias("_side"), F.struct(*values).alias("_version"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]).filter("_t is not null")
    both = mine.unionByName(theirs, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_t"), "_side", *[F.asc_nulls_first(f"_o{i}") for i in range(len(order))]).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_last", F.last("_version", ignorenulls=True).over(w)).filter("_side = 1")
    return found.select(*keys, "_row.*", *[F.when(F.col("_t").isNotNull(), F.col(f"_last.{v}")).alias(v) for v in values])


def fingerprint(rows: DataFrame, name: str, id_col: str, time_col: str) -> DataFrame:
    """One row: count, least, largest and sum of ids, sum of epoch seconds and the latest time. A text id counts by its last nine digits."""
    number = F.when(F.col(id_col).cast("string").rlike("^-?[0-9]{1,18}$"), F.col(id_col).try_cast("bigint")).otherwise(F.regexp_extract(F.col(id_col).cast("string"), "([0-9]{1,9})[^0-9]*$", 1).try_cast("bigint"))
    return rows.agg(
        F.lit(name).alias("input_name"), F.count("*").alias("n"), F.min(number).alias("min_id"), F.max(number).alias("max_id"), F.sum(number).alias("sum_id"),
        F.sum(F.unix_timestamp(time_col)).alias("sum_seconds"), F.max(time_col).alias("max_time"),
    )


def strict_digest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One SHA-256 over all content, whatever the order of rows: number of rows and sums of the eight 32-bit words of each row's SHA-256.

    A sum is one number a task, however many rows there are: nothing is gathered or sorted. Repeated rows count each time.
    """
    row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
    words = [F.sum(F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("bigint").cast("decimal(38,0)")).cast("string") for i in range(8)]
    every = rows.select(row.alias("h")).agg(F.concat_ws(",", F.count("*").cast("string"), *[F.coalesce(w, F.lit("0")) for w in words]).alias("sums"))
    return every.select(F.sha2("sums", 256).alias("digest"))


def compare_fingerprints(before: DataFrame, after: DataFrame, fields: list[str], key: str = "input_name") -> DataFrame:
    """(input_name, moved): names of the fields that differ; an input on one side only moved in all."""
    both = before.select(key, F.struct(*fields).alias("a")).join(after.select(key, F.struct(*fields).alias("b")), key, "full")
    moved = F.array_compact(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]))
    return both.select(key, F.when(F.col("a").isNull() | F.col("b").isNull(), F.array(*map(F.lit, fields))).otherwise(moved).alias("moved"))
