"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z and nothing else is lower-cased by ``ascii_lower``.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What separates words: space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only in local mode, where one machine does all the work."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Name a folder that all executors share in spark.checkpoint.dir")
        found = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Spark removes the shuffle files of a query when it ends, if this is set.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str, free: bool = False, by: str | None = None, buckets: int = 1) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors. With ``free`` its shuffle files go at once.

    With ``by`` it is dealt into ``buckets`` by that column, so that joins on it move the other side only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    name = path.rsplit("/", 1)[1].replace("-", "_")
    before = spark.conf.get(FREE, None)
    if free:
        spark.conf.set(FREE, "true")
    try:
        if by:
            df.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(by).option("path", path).format("parquet").saveAsTable(name)
        else:
            df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(FREE, before) if before is not None else spark.conf.unset(FREE)
    return spark.table(name) if by else spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. In a text without multi-byte characters ``lower`` does just that, and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(id_col: Column) -> Column:
    """True for the third of the ids that no model learns from: crc32 of the id's digits, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_remembered: dict[str, dict] = {}


def remembered(owner: str) -> dict:
    """What this Python worker remembers for ``owner``. Workers outlive a stage: what they remember for others goes, and Arrow memory that is free goes back."""
    for other in _remembered.keys() - {owner}:
        del _remembered[other]
    pa.default_memory_pool().release_unused()
    return _remembered.setdefault(owner, {})
