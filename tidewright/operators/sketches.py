"""Sketches kept by partition and merged: distinct numbers and quantiles over all history without reading it again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of the registers of a distinct sketch (relative error 1.04 / sqrt(2 ** K)), and k of a quantile sketch (rank error about 1.7 / k).
DISTINCT_K, QUANTILE_K = 12, 400


def column_sketches(rows: DataFrame, by: list[str], distinct: list[str], quantiles: list[str] = ()) -> DataFrame:
    """One row per value of ``by``: rows, and of each column the filled values, their least and largest, and a sketch: of distinct values, or of the distribution.

    Columns: by..., n, and for a column c of ``distinct`` filled_c, hll_c, for one of ``quantiles`` low_c, high_c, kll_c. Blank texts and nulls are not filled. One aggregate that is
    combined before its shuffle: a sketch of some KB a group and task moves, whatever the number of rows.
    """
    text = {c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in distinct}
    aggs = [x for c, t in text.items() for x in (F.count(t).alias(f"filled_{c}"), F.hll_sketch_agg(t, DISTINCT_K).alias(f"hll_{c}"))]
    number = {c: F.col(c).cast("double") for c in quantiles}
    aggs += [x for c, v in number.items() for x in (F.min(v).alias(f"low_{c}"), F.max(v).alias(f"high_{c}"), F.kll_sketch_agg_double(v, QUANTILE_K).alias(f"kll_{c}"))]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *aggs)


def merged_sketches(stored: DataFrame, by: list[str], distinct: list[str], quantiles: list[str] = ()) -> DataFrame:
    """Stored sketches of finer groups (days, partitions, runs) as one for each value of ``by``, in the same columns. Reads sketches only."""
    aggs = [x for c in distinct for x in (F.sum(f"filled_{c}").alias(f"filled_{c}"), F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}"))]
    aggs += [x for c in quantiles for x in (F.min(f"low_{c}").alias(f"low_{c}"), F.max(f"high_{c}").alias(f"high_{c}"), F.kll_merge_agg_double(f"kll_{c}").alias(f"kll_{c}"))]
    return stored.groupBy(*by).agg(F.sum("n").alias("n"), *aggs)


def profile_of(sketches: DataFrame, distinct: list[str], by: list[str] = ()) -> DataFrame:
    """(by..., name, n, filled, distinct_values): a profile of columns, distinct numbers as estimated."""
    one = [F.struct(F.lit(c).alias("name"), F.col("n").alias("n"), F.col(f"filled_{c}").alias("filled"), F.hll_sketch_estimate(f"hll_{c}").alias("distinct_values")) for c in distinct]
    return sketches.select(*by, F.explode(F.array(*one)).alias("p")).select(*by, "p.*")


def bands_of(sketches: DataFrame, columns: list[str], shares: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9), by: list[str] = ()) -> DataFrame:
    """(by..., name, n, low, high, bands): the quantiles ``shares`` of each column, as estimated; least and largest are exact."""
    one = [
        F.struct(F.lit(c).alias("name"), F.kll_sketch_get_n_double(f"kll_{c}").alias("n"), F.col(f"low_{c}").alias("low"), F.col(f"high_{c}").alias("high"), F.array(*[F.kll_sketch_get_quantile_double(f"kll_{c}", F.lit(s)) for s in shares]).alias("bands"))
        for c in columns
    ]
    return sketches.select(*by, F.explode(F.array(*one)).alias("b")).select(*by, "b.*")


def key_growth(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, distinct_keys): how many distinct keys each longer prefix of ``columns`` has, from the sketches of ``with_prefixes``."""
    names = [prefix_name(columns[: i + 1]) for i in range(len(columns))]
    one = [F.struct(F.lit(",".join(columns[: i + 1])).alias("columns"), F.hll_sketch_estimate(f"hll_{name}").alias("distinct_keys")) for i, name in enumerate(names)]
    return sketches.select(F.explode(F.array(*one)).alias("k")).select("k.*")


def prefix_name(columns: list[str]) -> str:
    return "_".join(columns)


def with_prefixes(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with a column for each prefix of ``columns``: its values as one text in which no two keys look alike."""
    part = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return reduce(lambda df, i: df.withColumn(prefix_name(columns[: i + 1]) if i else f"{columns[0]}", F.col(columns[0]) if i == 0 else F.concat(*[part(c) for c in columns[: i + 1]])), range(len(columns)), rows)
