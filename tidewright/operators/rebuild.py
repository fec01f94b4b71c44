"""Rebuilds of stored aggregates that follow a change log: affected days, their weeks, the curves of those weeks and the index of their entities, and nothing else."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.text import week_start
from tidewright.operators import gold, series
from tidewright.sources.sinks import staged

#: Partitions of the index: an entity is whole in one of them.
INDEX_PARTS = 64


def affected_days(changes: DataFrame, *dates: str) -> DataFrame:
    """(flow_date): the distinct days that any of the columns ``dates`` of a change log names, such as the day of the old and of the new version."""
    return changes.select(F.explode(F.array(*[F.col(d).cast("date") for d in dates])).alias("flow_date")).filter("flow_date is not null").distinct()


def weeks_of(days: DataFrame) -> DataFrame:
    return days.select(week_start(F.col("flow_date")).alias("week_start")).distinct()


def days_of(weeks: DataFrame) -> DataFrame:
    return weeks.select(F.explode(F.sequence(F.col("week_start"), F.date_add("week_start", 6))).alias("flow_date"))


def replace_partitions(rows: DataFrame, path: str, column: str, affected: DataFrame) -> None:
    """Replace the partitions of the table at ``path`` whose value ``affected`` names by those of ``rows``; one that ``rows`` lack goes. Others keep their files.

    ``rows`` must hold only affected values. What is deleted is named by ``affected``, so at most one folder a value; names are of dates and numbers.
    """
    spark = rows.sparkSession
    stored = spark.read.parquet(path).schema
    # Partitions of one table have one type a column, whatever the types of the facts at hand.
    rows = staged(rows.select(*[F.col(f.name).cast(f.dataType) for f in stored]), "partitions")
    rows.repartition(column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    gone = affected.select(column).distinct().join(rows.select(column).distinct(), column, "left_anti")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for r in gone.toLocalIterator():
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{column}={r[0]}"), True)


def _part(entity: Column) -> Column:
    return F.pmod(F.crc32(entity.cast("binary")), F.lit(INDEX_PARTS)).cast("int").alias("part")


class GoldTables:
    """Daily and weekly aggregates, weekly curves and the pressure index under one path, partitioned by day, week, week and entity hash.

    ``daily``, ``gate`` and ``revisions`` give the rows of asked days (a table flow_date, small against the facts; all days when None), from facts as they are now.
    """

    def __init__(self, spark: SparkSession, path: str, daily: Callable[[DataFrame | None], DataFrame], gate: Callable[[DataFrame | None], DataFrame] | None = None, revisions: Callable[[DataFrame | None], DataFrame] | None = None):
        self.spark, self.path, self.daily, self.gate, self.revisions = spark, path, daily, gate, revisions

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def rebuild(self) -> None:
        """Everything, from nothing. A partition is one file."""
        self.daily(None).repartition("flow_date").write.mode("overwrite").partitionBy("flow_date").parquet(f"{self.path}/daily")
        gold.weekly_flow(self.read("daily")).repartition("week_start").write.mode("overwrite").partitionBy("week_start").parquet(f"{self.path}/weekly")
        self._curves(self.read("weekly"), None).repartition("time_bucket").write.mode("overwrite").partitionBy("time_bucket").parquet(f"{self.path}/curves")
        self._index(self.read("curves")).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/index")

    def _curves(self, weekly: DataFrame, days: DataFrame | None) -> DataFrame:
        return series.build_curves(weekly, "week_start", "week", "v1", self.gate(days) if self.gate else None, self.revisions(days) if self.revisions else None)

    def _index(self, curves: DataFrame) -> DataFrame:
        return series.pressure_index(series.with_zscore(curves)).withColumn("part", _part(F.col("entity_key")))

    def follow(self, changes: DataFrame, *dates: str) -> dict[str, int]:
        """Bring the tables up to date with facts whose changes are in ``changes``; returns how many partitions of each were replaced.

        A changed day makes its week, that week's curves and, as z-scores look at whole series, the index of each entity with a curve in that week, before or after. The index
        is replaced by entity hash, so entities that share a part are computed as well. Tables of days and weeks are broadcast by their measured size.
        """
        days = staged(affected_days(changes, *dates), "affected-days")
        replace_partitions(self.daily(days), f"{self.path}/daily", "flow_date", days)
        weeks = staged(weeks_of(days), "affected-weeks")
        inside = staged(days_of(weeks), "days-of-weeks")
        replace_partitions(gold.weekly_flow(self.read("daily").join(inside, "flow_date", "left_semi")), f"{self.path}/weekly", "week_start", weeks)
        buckets = weeks.withColumnRenamed("week_start", "time_bucket")
        touched = lambda: self.read("curves").join(buckets, "time_bucket", "left_semi").select(_part(F.col("entity_key"))).distinct()
        before = staged(touched(), "affected-entities")
        weekly = self.read("weekly").join(weeks, "week_start", "left_semi")
        replace_partitions(self._curves(weekly, inside), f"{self.path}/curves", "time_bucket", buckets)
        parts = staged(before.unionByName(touched()).distinct(), "affected-parts")
        curves = self.read("curves").withColumn("part", _part(F.col("entity_key"))).join(parts, "part", "left_semi").drop("part")
        replace_partitions(self._index(curves), f"{self.path}/index", "part", parts)
        return {"daily": days.count(), "weekly": weeks.count(), "curves": weeks.count(), "index": parts.count()}
