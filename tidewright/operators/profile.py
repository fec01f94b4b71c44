"""Profiles of wide text tables: columns, keys, dependencies, invariants, life cycles, pairs and changes. Each is one or a few passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.text import has_value

#: Parts over which keys are dealt to be counted.
PARTS = 256


def columns(df: DataFrame, names: list[str]) -> DataFrame:
    """(name, n, filled, fill_rate, distinct_values, status): one row a column; dead without values, thin under 1 %."""
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(names):
        aggs += [F.count_if(has_value(F.col(c))).alias(f"f{i}"), F.countDistinct(F.when(has_value(F.col(c)), F.col(c))).alias(f"d{i}")]
    one = df.agg(*aggs)
    rows = one.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"f{i}").alias("filled"), F.col(f"d{i}").alias("distinct_values")) for i, c in enumerate(names)])).alias("c")).select("c.name", "n", "c.filled", "c.distinct_values")
    rate = F.try_divide("filled", "n")
    return rows.withColumns({"fill_rate": rate, "status": F.when(F.col("filled") == 0, "dead").when(rate < 0.01, "thin").otherwise("used")})


def top_values(df: DataFrame, names: list[str], k: int = 2) -> DataFrame:
    """(name, value, count): the ``k`` most frequent values of each column; of equal counts the smaller value."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in names])).alias("x")).select("x.*").filter(has_value(F.col("value")))
    counts = long.groupBy("name", "value").agg(F.count("*").alias("n"))
    return counts.withColumn("_r", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("n"), "value"))).filter(F.col("_r") <= k).drop("_r")


def key_prefixes(df: DataFrame, names: list[str]) -> DataFrame:
    """(columns, distinct_keys, n): distinct values of each growing prefix of a candidate key against the rows.

    Rows are dealt by the first column once, so every prefix is whole in one part: the rows are counted by the whole key, these by the prefix one shorter, and so on, each carrying
    the counts so far. No row is repeated for another prefix, and what a task holds are the keys of one of PARTS parts, which are not merged again.
    """
    levels = df.select(*names).repartition(PARTS, names[0]).groupBy(*names).agg(F.count("*").alias("n"))
    for i in range(len(names) - 1, -1, -1):
        deeper = [F.sum(f"k{j}").alias(f"k{j}") for j in range(i + 1, len(names))]
        levels = (levels.groupBy(*names[:i]) if i else levels.groupBy()).agg(F.sum("n").alias("n"), *deeper, F.count("*").alias(f"k{i}"))
    one = levels.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n", *[f"k{i}" for i in range(len(names))])])
    return one.select("n", F.explode(F.array(*[F.struct(F.lit(",".join(names[: i + 1])).alias("columns"), F.col(f"k{i}").alias("distinct_keys")) for i in range(len(names))])).alias("c")).select("c.columns", "c.distinct_keys", "n")


def dependency_violations(df: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """(name, violating_groups): groups of the key in which a column has more than one value; 0 means that the key determines it."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = df.groupBy(*key).agg(*[(F.min(text(c)) != F.max(text(c))).alias(c) for c in names])
    one = groups.agg(*[F.count_if(F.col(c)).alias(c) for c in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("violating_groups")) for c in names])).alias("x")).select("x.*")


def invariants(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, counter_examples, n): rows that break each rule, in one pass."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"r{i}") for i, ok in enumerate(rules.values())])
    return one.select("n", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"r{i}").alias("counter_examples")) for i, r in enumerate(rules)])).alias("x")).select("x.rule", "x.counter_examples", "n")


def lifecycle(df: DataFrame, at: str, edges_hours: list[int], stages: dict[str, Column]) -> DataFrame:
    """Stages reached by age bucket, relative to the table's latest time; empty buckets don't appear. The anchor is a one-row join."""
    anchor = df.agg(F.max(at).alias("_anchor"))
    aged = df.crossJoin(F.broadcast(anchor)).withColumn("_h", (F.unix_timestamp("_anchor") - F.unix_timestamp(at)) / 3600)
    bucket = reduce(lambda acc, i: acc.when(F.col("_h") < edges_hours[i], i), range(len(edges_hours)), F.when(F.col("_h").isNull(), -1)).otherwise(len(edges_hours))
    return aged.groupBy(bucket.alias("age_bucket")).agg(F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in stages.items()])


def pair_differences(df: DataFrame, key: list[str], names: list[str], received: Column) -> DataFrame:
    """Over groups of exactly two rows: in how many each column differs, and how many have exactly one side received."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    pairs = df.groupBy(*key).agg(F.count("*").alias("_n"), F.count_if(received).alias("_r"), *[(F.min(text(c)) != F.max(text(c))).alias(c) for c in names]).filter("_n = 2")
    one = pairs.agg(F.count("*").alias("pairs"), F.count_if(F.col("_r") == 1).alias("one_received"), *[F.count_if(F.col(c)).alias(c) for c in names])
    return one.select("pairs", "one_received", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("differing")) for c in names])).alias("x")).select("x.name", "x.differing", "pairs", "one_received")


def field_changes(changes: DataFrame) -> DataFrame:
    """(field, changes, rows_only): how often each field changed, and in how many rows it was the only one."""
    rows = changes.select(F.cardinality("changed_fields").alias("_n"), F.explode(F.map_keys("changed_fields")).alias("field"))
    return rows.groupBy("field").agg(F.count("*").alias("changes"), F.count_if(F.col("_n") == 1).alias("rows_only"))


def transitions(changes: DataFrame, fields: list[str]) -> DataFrame:
    """(field, old_value, new_value, n)."""
    rows = changes.select(F.explode("changed_fields").alias("field", "_p")).filter(F.col("field").isin(*fields))
    return rows.groupBy("field", F.col("_p")[0].alias("old_value"), F.col("_p")[1].alias("new_value")).agg(F.count("*").alias("n"))


def change_histogram(changes: DataFrame, key: str) -> DataFrame:
    """(changes, ids): how many ids changed so many times."""
    return changes.groupBy(key).agg(F.count("*").alias("changes")).groupBy("changes").agg(F.count("*").alias("ids"))
