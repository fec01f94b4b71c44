"""Exact deduplication: group by a 128-bit content hash, compare bytes inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import ascii_lower, written


def md5_key(text: Column) -> Column:
    """The 128-bit content hash."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = ascii_lower,
    content_hash: Callable[[Column], Column] = md5_key,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows belong together when their normalised texts have the same bytes. The
    row with the ``keep`` ("smallest" or "largest") id stays. Text moves through
    one shuffle, and only rows whose hash occurs twice are compared: each with the
    text of one row of its group, through a join that Spark can split where a group is
    hot. Rows of equal hash but other bytes form groups of their own, by SHA-256.

    Null and empty texts are the same text. Rows that repeat an id count one by one, and of
    those with the id that stays, all are kept. A null id loses against any other. An
    empty table gives an empty result; other columns of ``docs`` are not read.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_hash", content_hash(F.col("_text")))
    keys = written(rows.select("_id", "_hash", F.unhex(F.sha2("_text", 256)).alias("_sha")), "exact-keys")

    groups = keys.groupBy("_hash").agg(F.count("*").alias("_n")).filter("_n > 1").select("_hash")
    # Once written, a row has a number; so one row of each group can be named, and only its text is sent to the others.
    twice = written(rows.join(groups, "_hash").select("_hash", F.unhex(F.sha2("_text", 256)).alias("_sha"), "_text", F.monotonically_increasing_id().alias("_row")), "exact-twice")
    named = twice.groupBy("_hash").agg(F.min("_row").alias("_row"))
    refs = written(twice.join(named, ["_hash", "_row"]).select("_hash", F.col("_text").alias("_ref_text")), "exact-refs")
    # Written before it is made distinct, so that nothing keeps Spark from splitting a hot group in this join.
    differ = written(twice.join(refs, "_hash").filter("_text <> _ref_text").select("_hash", "_sha"), "exact-differ")
    others = differ.distinct().withColumn("_other", F.lit(True))

    split = keys.join(others, ["_hash", "_sha"], "left").withColumn("_part", F.when(F.col("_other"), F.col("_sha")).otherwise(F.lit(b""))).drop("_other")
    split = written(split, "exact-split")
    stays = split.groupBy("_hash", "_part").agg(best("_id").alias("keep_id"), F.count("*").alias("group_size"))
    return split.join(stays, ["_hash", "_part"]).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
