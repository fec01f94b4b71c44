"""Files written for others. Spark's commit protocol makes a write atomic; ``exports`` has a writer with byte-order mark and CRLF."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_run_changes(changes: DataFrame, path: str) -> None:
    """A folder per run under ``path``; a run without changes leaves none."""
    changes.write.mode("append").partitionBy("run_id").option("header", True).csv(path)


def long_changes(versions: DataFrame) -> DataFrame:
    """One row per changed field of ``versions`` (id, changed_at, changed_fields map<string, array<string>>)."""
    return versions.select("id", "changed_at", F.explode("changed_fields").alias("field", "_pair")).select("id", "changed_at", "field", F.col("_pair")[0].alias("old_value"), F.col("_pair")[1].alias("new_value"))


def runs_to_keep(runs: DataFrame, keep: int) -> DataFrame:
    """The newest ``keep`` runs (run_id, started_at) of each kind."""
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("started_at"), F.desc("run_id")))
    return runs.withColumn("_rank", rank).filter(F.col("_rank") <= keep).drop("_rank")


def write_report(metrics: DataFrame, path: str) -> str:
    """Metrics (name, value) as JSON under ``path``, and as Markdown text for a reader. ``metrics`` has one row a metric."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return "\n".join(["| metric | value |", "|---|---|", *[f"| {r['name']} | {r['value']} |" for r in metrics.orderBy("name").collect()]])


def write_gate(events: DataFrame, active: DataFrame, gap: DataFrame, new: DataFrame, path: str, scope: str = "all", pair: tuple[str, str] = ("vesselcode", "voyage")) -> None:
    """Gate files under ``path``: ``events`` of all voyages, of the active ones, or none at all (``scope``: all, active, off); ``new`` rows of the run, if
    there are any; ``gap`` rows always."""
    if scope not in ("all", "active", "off"):
        raise ValueError(f"scope is all, active or off, not {scope}")
    if scope != "off":
        write_csv(events if scope == "all" else events.join(active.select(*pair).distinct(), list(pair), "left_semi"), f"{path}/events")
    if not new.isEmpty():
        write_csv(new, f"{path}/new")
    write_csv(gap, f"{path}/gap")


def shared_base(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, else the warehouse. On a cluster a warehouse that is a local folder is refused: executors would not share it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    base = spark.conf.get("spark.sql.warehouse.dir")
    if base.startswith(("/", "file:")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("Name a folder that all executors share in spark.checkpoint.dir")
    return base


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
