"""Samples that anyone can draw again: rows in order of a salted hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _hash(seed: str, columns: list[str]) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def stable_sample(rows: DataFrame, columns: list[str], size: int, seed: str) -> DataFrame:
    """The ``size`` rows with the smallest SHA-256 of seed and columns: the same for any order of the input. A distributed top-k, not a sort."""
    return rows.withColumn("_h", _hash(seed, columns)).orderBy("_h", *columns).limit(size).drop("_h")


def stratified_sample(rows: DataFrame, columns: list[str], stratum: Column, allocations: dict[str, int], seed: str) -> DataFrame:
    """For each stratum as many rows as it is allocated, with the stratum's size in the whole."""
    table = F.create_map(*[F.lit(x) for pair in allocations.items() for x in pair])
    marked = rows.withColumns({"stratum": stratum, "_h": _hash(seed, columns)})
    w = Window.partitionBy("stratum")
    ranked = marked.withColumns({"_r": F.row_number().over(w.orderBy("_h", *columns)), "universe": F.count("*").over(w)})
    return ranked.filter(F.col("_r") <= F.coalesce(table[F.col("stratum")], F.lit(0))).drop("_h", "_r")


def manifest_fingerprint(sample: DataFrame, columns: list[str], separator: str = "\x1f", digits: int = 64) -> DataFrame:
    """SHA-256 of a sample's sorted rows; the sample is of a size that its caller chose."""
    line = F.concat_ws(separator, *[F.col(c).cast("string") for c in columns])
    return sample.agg(F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256), 1, digits).alias("fingerprint"), F.count("*").alias("n"))
