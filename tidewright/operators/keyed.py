"""A table of rows by key that takes batches without moving itself: a base in buckets, delta tables beside it, merged when read."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators.cdc import compared

#: With so many delta tables a batch is followed by compaction.
MOST_DELTAS = 4


class KeyedTable:
    """Rows by ``key`` with ``fields``; keys are unique and not null.

    Base and deltas are Parquet tables in the same number of buckets by key, so joins between them, and of a batch with them, exchange nothing but
    the batch. A delta holds the rows of one batch that are new or differ; of a key in several the latest counts. ``compact`` writes base and deltas as a new base, bucket by bucket,
    again without an exchange. Tables are written under ``folder``, which executors share, and known to the session's catalog under names of their own;
    ``state`` is all that another session needs to ``open`` them.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, fields: list[str], buckets: int):
        self.spark, self.folder, self.key, self.fields, self.buckets = spark, folder, key, fields, buckets
        self.base: str | None = None
        self.deltas: list[str] = []

    @classmethod
    def create(cls, rows: DataFrame, folder: str, key: str, fields: list[str], buckets: int) -> KeyedTable:
        """From rows with unique keys; those without a key are left out. This is the one time that all rows are exchanged."""
        out = cls(rows.sparkSession, folder, key, fields, buckets)
        out.base = out._write(rows.filter(F.col(key).isNotNull()).select(key, *fields).repartition(buckets, key), "base")
        return out

    @classmethod
    def open(cls, spark: SparkSession, state: dict) -> KeyedTable:
        out = cls(spark, state["folder"], state["key"], state["fields"], state["buckets"])
        for name in (state["base"], *state["deltas"]):
            if not spark.catalog.tableExists(name):
                spark.sql(f"CREATE TABLE {name} ({state['schema']}) USING parquet CLUSTERED BY (`{out.key}`) SORTED BY (`{out.key}`) INTO {out.buckets} BUCKETS LOCATION '{out.folder}/{name}'")
        out.base, out.deltas = state["base"], list(state["deltas"])
        return out

    @property
    def state(self) -> dict:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.table(self.base).schema)
        return {"folder": self.folder, "key": self.key, "fields": self.fields, "buckets": self.buckets, "schema": schema, "base": self.base, "deltas": list(self.deltas)}

    def _write(self, rows: DataFrame, kind: str) -> str:
        name = f"{kind}_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        return name

    def _rows_of(self, table: str, alias: str) -> DataFrame:
        return self.spark.table(table).select(F.col(self.key).alias(f"_{alias}_key"), F.struct(*self.fields).alias(alias))

    def _with_known(self, rows: DataFrame, tables: list[str]) -> DataFrame:
        """``rows`` (key, ...) with ``_known``: the row of the last of ``tables`` that has the key. Left joins keep the buckets of ``rows``."""
        names = [f"t{i}" for i in range(len(tables))]
        for name, table in zip(names, tables, strict=True):
            side = self._rows_of(table, name)
            rows = rows.join(side, F.col(self.key) == F.col(f"_{name}_key"), "left").drop(f"_{name}_key")
        known = F.coalesce(*[F.col(n) for n in reversed(names)])
        return rows.withColumn("_known", known).drop(*names)

    def rows(self) -> DataFrame:
        """All current rows. Base rows take what the last delta says of them; a delta adds the keys that no table before it has."""
        tables = [self.base, *self.deltas]
        parts = []
        for i, table in enumerate(tables):
            own = self.spark.table(table)
            for earlier in tables[:i]:
                own = own.join(self.spark.table(earlier).select(self.key), self.key, "left_anti")
            later = tables[i + 1 :]
            if later:
                own = self._with_known(own.select(self.key, F.struct(*self.fields).alias("_own")), later).select(self.key, F.coalesce("_known", "_own").alias("_row")).select(self.key, "_row.*")
            parts.append(own.select(self.key, *self.fields))
        return reduce(DataFrame.unionByName, parts)

    def changes(self, batch: DataFrame, touch: tuple[str, ...] = ()) -> DataFrame:
        """What ``batch`` (key, fields) brings: its rows with change_type and changed_fields (see ``capture_changes``). Only the batch is exchanged."""
        dealt = batch.select(self.key, *self.fields).repartition(self.buckets, self.key)
        both = self._with_known(dealt.withColumn("_new", F.struct(*self.fields)), [self.base, *self.deltas]).withColumnRenamed("_known", "_old")
        return compared(both, self.key, self.fields, touch)

    def apply(self, batch: DataFrame, touch: tuple[str, ...] = (), order: list[str] | None = None) -> dict[str, int]:
        """Take a batch; returns its counters. With ``order`` the last row of each key counts, else keys must be unique in the batch.

        Rows without a key are skipped. A batch that changes nothing writes no delta that is kept.
        """
        if order:
            rest = F.struct(*[F.col(c) for c in order], F.xxhash64(*self.fields))
            newest = batch.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max_by(F.struct(*self.fields), rest).alias("_r")).select(self.key, "_r.*")
            batch = newest.unionByName(batch.filter(F.col(self.key).isNull()).select(self.key, *self.fields))
        found = self.changes(batch, touch)
        name = self._write(found.filter("change_type in ('new', 'updated', 'touched')").select(self.key, *self.fields, "change_type"), "delta")
        kept = {r["change_type"]: r["count"] for r in self.spark.table(name).groupBy("change_type").count().collect()}
        seen, skipped = batch.agg(F.count("*"), F.count_if(F.col(self.key).isNull())).first()
        counters = {k: kept.get(k, 0) for k in ("new", "updated", "touched")}
        counters |= {"seen": seen, "skipped": skipped, "unchanged": seen - skipped - sum(kept.values())}
        if kept:
            self.deltas.append(name)
        else:
            self.spark.sql(f"DROP TABLE {name}")
        if len(self.deltas) >= MOST_DELTAS:
            self.compact()
        return counters

    def compact(self) -> None:
        """Base and deltas become one base. Each task holds one bucket, so nothing is exchanged. Old files stay for readers that hold the former state."""
        old = [self.base, *self.deltas]
        self.base, self.deltas = self._write(self.rows(), "base"), []
        for name in old:
            self.spark.sql(f"DROP TABLE {name}")

