"""Data-quality checks over pages, facts and queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.text import has_value
from tidewright.operators.cdc import union_labels


def endpoint_summary(records: DataFrame) -> DataFrame:
    """Unique records, duplicates, unknown times and the range of event times per endpoint (endpoint, record_id, event_time)."""
    return records.groupBy("endpoint").agg(F.countDistinct("record_id").alias("unique_records"), (F.count("*") - F.countDistinct("record_id")).alias("duplicates"), F.count_if(F.col("event_time").isNull()).alias("empty_time"), F.min("event_time").alias("earliest"), F.max("event_time").alias("latest"))


def parse_failures(rows: DataFrame, pairs: dict[str, tuple[str, Column]]) -> DataFrame:
    """(check, failures): rows whose raw text has a value while the typed one is null."""
    one = rows.agg(*[F.count_if(has_value(F.col(raw)) & typed.isNull()).alias(f"c{i}") for i, (raw, typed) in enumerate(pairs.values())])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("failures")) for i, n in enumerate(pairs)])).alias("x")).select("x.*")


def repeated_pages(pages: DataFrame) -> DataFrame:
    """Per endpoint and request: pages, repeats of an earlier payload, their rate, and whether the gate (no repeats) holds."""
    out = pages.groupBy("endpoint", "fingerprint").agg(F.count("*").alias("pages"), (F.count("*") - F.countDistinct("payload_hash")).alias("repeats"))
    return out.withColumns({"repeat_rate": F.col("repeats") / F.col("pages"), "passed": F.col("repeats") == 0})


def adjacent_repeats(pages: DataFrame) -> DataFrame:
    """Pages whose payload is that of one of the two before."""
    w = Window.partitionBy("endpoint", "fingerprint").orderBy("page")
    return pages.withColumn("adjacent_repeat", F.coalesce((F.col("payload_hash") == F.lag("payload_hash", 1).over(w)) | (F.col("payload_hash") == F.lag("payload_hash", 2).over(w)), F.lit(False)))


def page_ledger(pages: DataFrame, size: int) -> DataFrame:
    """(job, pages, expected_pages, fault): the first fault of each job's pages (job, page, row_count, total).

    The plan is frozen by page 1: ceil(total / size) pages. Pages are contiguous from 1, the total may grow but not shrink, and within
    the plan each page is full, but for the last.
    """
    w = Window.partitionBy("job").orderBy("page")
    first = F.first_value("total").over(w)
    before = F.lag("total").over(w)
    want = F.least(F.lit(size), first - (F.col("page") - 1) * size)
    fault = (
        F.when(F.col("page") != F.row_number().over(w), "gap").when(F.col("total") < before, "total_shrank")
        .when((want > 0) & (F.col("row_count") == 0), "empty_page").when((want > 0) & (F.col("row_count") < want), "short_page")
    )
    rows = pages.withColumns({"_fault": fault, "_first": first})
    out = rows.groupBy("job").agg(F.count("*").alias("pages"), F.ceil(F.max("_first") / size).alias("expected_pages"), F.min(F.when(F.col("_fault").isNotNull(), F.struct("page", "_fault")))["_fault"].alias("fault"))
    return out.withColumn("fault", F.coalesce("fault", F.when(F.col("pages") < F.col("expected_pages"), "incomplete")))


def misattributed(rows: DataFrame, request: str, asked: list[str], answered: list[str]) -> DataFrame:
    """(request, rows, foreign): a request with rows of another key than asked for is invalid as a whole."""
    wrong = F.lit(False)
    for a, b in zip(asked, answered, strict=True):
        wrong = wrong | ~F.col(a).eqNullSafe(F.col(b))
    return rows.groupBy(request).agg(F.count("*").alias("rows"), F.count_if(wrong).alias("foreign"))


def completeness(counted: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """Counted rows against declared totals of each key."""
    out = declared.join(counted, keys, "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    return out.withColumns({"missing": F.greatest(F.col("declared") - F.col("counted"), F.lit(0)), "ratio": F.try_divide("counted", "declared")})


def status_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def direction_jobs(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Each candidate as one job per direction, with its planned total."""
    out = candidates.select(*keys, F.explode(F.array(F.struct(F.lit("GATE_IN").alias("direction"), F.col("total_in").alias("planned_total")), F.struct(F.lit("GATE_OUT").alias("direction"), F.col("total_out").alias("planned_total")))).alias("j"))
    return out.select(*keys, "j.*")


def quarantine(rejected: DataFrame, candidates: DataFrame, buckets: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """(keys, reason): pairs to set aside. Unfinished candidates whose total is ``threshold`` or more, and pairs of pseudo vessels, are added to
    those already set aside; reasons of a pair are united, so a second run changes nothing."""
    big = candidates.filter((F.col("status") != "complete") & (F.col("total") >= threshold)).select(*keys, F.lit("oversized").alias("reason"))
    found = big.unionByName(buckets.select(*keys, F.col("bucket").alias("reason"))).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("reason")), "+").alias("_new"))
    return rejected.join(found, keys, "full").select(*keys, union_labels(F.col("reason"), F.col("_new")).alias("reason"))


def order_flags(rows: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """A flag per rule (first, then): true where both times are known and out of order. Rows are marked, never removed."""
    return rows.withColumns({name: F.coalesce(F.col(a) > F.col(b), F.lit(False)) for name, (a, b) in rules.items()})
