"""Landed JSON pages and the raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.text import digest


def page_rows(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of each page: the page's columns but ``body``, then ``record`` (JSON text) and ``position``.

    A page is JSON text ``{data: {list: [...]}}`` or ``{data: [...]}``; what isn't an object in the list is dropped, and so is a page that isn't JSON.
    """
    page = F.try_parse_json(F.col(body))
    rows = F.coalesce(F.try_variant_get(page, "$.data.list", "array<variant>"), F.try_variant_get(page, "$.data", "array<variant>"))
    out = pages.select(*[c for c in pages.columns if c != body], F.posexplode(rows).alias("position", "_row"))
    return out.filter(F.schema_of_variant("_row").startswith("OBJECT")).withColumn("record", F.to_json("_row")).drop("_row")


def page_total(pages: DataFrame, body: str = "body") -> DataFrame:
    """Each page with its reported ``total``; null when absent or not a whole number."""
    return pages.withColumn("total", F.try_variant_get(F.try_parse_json(F.col(body)), "$.data.total", "string").try_cast("int"))


def land_pages(pages: DataFrame, landed: DataFrame | None = None) -> DataFrame:
    """Pages (endpoint, request, page, body) that are new to ``landed``: one for each endpoint, request fingerprint, page number and payload hash."""
    keys = ["endpoint", "fingerprint", "page", "payload_hash"]
    new = pages.withColumn("fingerprint", digest(F.col("request"))).withColumn("payload_hash", digest(F.col("body"))).dropDuplicates(keys)
    return new if landed is None else new.join(landed.select(*keys), keys, "left_anti")


def observed_fields(records: DataFrame, record: str = "record") -> DataFrame:
    """(endpoint, field, first_seen, last_seen, sample_type): every key of the records, with the type of its first value."""
    pairs = records.select("endpoint", "seen_at", F.explode(F.from_json(record, "map<string,string>")).alias("field", "value"))
    kind = F.when(F.col("value").isNull(), "null").when(F.col("value").try_cast("double").isNotNull(), "number").otherwise("text")
    return pairs.withColumn("kind", kind).groupBy("endpoint", "field").agg(F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), F.min(F.struct("seen_at", "kind"))["kind"].alias("sample_type"))


def schema_drift(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """(endpoint, field, drift): fields seen but not expected ("new"), and expected but never seen ("missing")."""
    keys = ["endpoint", "field"]
    new = observed.join(expected, keys, "left_anti").select(*keys, F.lit("new").alias("drift"))
    return new.unionByName(expected.join(observed, keys, "left_anti").select(*keys, F.lit("missing").alias("drift")))


def without_quarantined(events: DataFrame, quarantined: DataFrame, keys: tuple[str, ...] = ("vesselcode", "voyage"), active: DataFrame | None = None) -> DataFrame:
    """Events but those of exactly quarantined pairs; with ``active``, of those pairs only. Spark broadcasts a side by its size."""
    out = events.join(quarantined.select(*keys).distinct(), list(keys), "left_anti")
    return out if active is None else out.join(active.select(*keys).distinct(), list(keys), "left_semi")
