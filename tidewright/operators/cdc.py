"""Change capture and upserts. A table is an immutable snapshot; a job returns the next one and what changed."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def capture_changes(current: DataFrame, incoming: DataFrame, key: str, fields: list[str], touch: tuple[str, ...] = ()) -> DataFrame:
    """One row per key of ``incoming``: key, change_type, changed_fields map<field, array(old, new)>.

    unchanged: no field differs; touched: only fields of ``touch`` do (they are refreshed, no history); updated: others do as well;
    new: not in ``current``; skipped: no key. One full shuffle join on the key, which both sides are hashed by.
    """
    old = current.select(key, F.struct(*fields).alias("_old"))
    new = incoming.select(key, F.struct(*fields).alias("_new"))
    return compared(new.join(old, key, "left"), key, fields, touch)


def compared(both: DataFrame, key: str, fields: list[str], touch: tuple[str, ...] = ()) -> DataFrame:
    """The changes of ``capture_changes`` from rows (key, _old, _new) of the known and the incoming structs; further columns are kept."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    ends = {f: (text(F.col(f"_old.{f}")), text(F.col(f"_new.{f}"))) for f in fields}
    differ = {f: a != b for f, (a, b) in ends.items()}
    some = reduce(or_, differ.values(), F.lit(False))
    beyond = reduce(or_, [d for f, d in differ.items() if f not in touch], F.lit(False))
    # Only rows with a difference build a map of them.
    entries = [F.when(d, F.struct(F.lit(f).alias("key"), F.array(*ends[f]).alias("value"))) for f, d in differ.items()]
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))
    known = F.col("_old").isNotNull()
    kind = F.when(F.col(key).isNull(), "skipped").when(~known, "new").when(~some, "unchanged").when(~beyond, "touched").otherwise("updated")
    changed = F.when(known & some, F.map_from_entries(F.array_compact(F.array(*entries)))).when(known, none)
    rest = [c for c in both.columns if c not in (key, "_old", "_new")]
    return both.select(key, kind.alias("change_type"), changed.alias("changed_fields"), *rest)


def upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The next snapshot: incoming rows replace current ones of the same key; rows without a key are left out."""
    fields = [c for c in current.columns if c != key]
    a, b = current.select(key, F.struct(*fields).alias("_a")), incoming.filter(F.col(key).isNotNull()).select(key, F.struct(*fields).alias("_b"))
    return a.join(b, key, "full").select(key, F.coalesce("_b", "_a").alias("_row")).select(key, "_row.*")


def merge_catalog(current: DataFrame, incoming: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """Full outer merge by rules over ``old`` and ``new`` structs, such as ``coalesce(new.x, old.x)`` or ``least(old.first, new.first)``."""
    a = current.select(*keys, F.struct(*[c for c in current.columns if c not in keys]).alias("old"))
    b = incoming.select(*keys, F.struct(*[c for c in incoming.columns if c not in keys]).alias("new"))
    return a.join(b, keys, "full").select(*keys, *[rule.alias(name) for name, rule in rules.items()])


def union_labels(old: Column, new: Column) -> Column:
    """``a+b`` label sets united, sorted, without repeats."""
    parts = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), r"\+"), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_union(parts(old), parts(new))), "+")


def best_of_batch(rows: DataFrame, keys: list[str], prefer: str, order: str) -> DataFrame:
    """One row per key: one with a ``prefer`` value first, then the latest by ``order``; ``duplicates`` counts the others."""
    w = Window.partitionBy(*keys)
    rank = F.row_number().over(w.orderBy(F.col(prefer).isNull(), F.desc(prefer), F.desc(order)))
    return rows.withColumns({"_rank": rank, "duplicates": F.count("*").over(w) - 1}).filter("_rank = 1").drop("_rank")


def append_new(current: DataFrame, incoming: DataFrame, key: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to append, conflicts): incoming rows whose key isn't known yet, and known keys that come with other content."""
    good = incoming.filter(F.col(key).isNotNull()).dropDuplicates([key])
    fresh = good.join(current.select(key), key, "left_anti")
    differ = F.lit(False)
    for f in fields:
        differ = differ | ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))
    conflicts = current.alias("a").join(good.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}")).filter(differ).select(F.col(f"a.{key}").alias(key))
    return fresh, conflicts


def new_versions(observations: DataFrame, keys: list[str], hash_col: str, order: list[str]) -> DataFrame:
    """Observations whose content differs from the one before of the same key: the versions to append."""
    before = F.lag(hash_col).over(Window.partitionBy(*keys).orderBy(*order))
    return observations.withColumn("_before", before).filter(~F.col(hash_col).eqNullSafe(F.col("_before")) | F.col("_before").isNull()).drop("_before")


def missing_versions(facts: DataFrame, versions: DataFrame, keys: list[str], hash_col: str) -> DataFrame:
    """Facts that have no version with their key and hash yet."""
    return facts.join(versions.select(*keys, hash_col), [*keys, hash_col], "left_anti")


def dimension(rows: DataFrame, code: str, names: list[str], at: str) -> DataFrame:
    """Type-1 dimension: the latest non-null of each name, first and last seen."""
    latest = [F.max(F.when(F.col(n).isNotNull(), F.struct(at, n)))[n].alias(n) for n in names]
    return rows.filter(F.col(code).isNotNull()).groupBy(code).agg(*latest, F.min(at).alias("first_seen"), F.max(at).alias("last_seen"))


def work_status(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """State of work items from their outcome log (status, at, error, total): latest status (of one moment the later letter), attempts, last error, first known total."""
    return outcomes.groupBy(*keys).agg(
        F.max(F.struct("at", "status"))["status"].alias("status"), F.count("*").alias("attempts"), F.max(F.when(F.col("error").isNotNull(), F.struct("at", "error")))["error"].alias("last_error"),
        F.min(F.when(F.col("total").isNotNull(), F.struct("at", "total")))["total"].alias("total"),
    )


def run_counters(changes: DataFrame) -> DataFrame:
    """Counters of a run from its changes: seen, new, updated, touched, unchanged, skipped."""
    kinds = ("new", "updated", "touched", "unchanged", "skipped")
    return changes.agg(F.count("*").alias("seen"), *[F.count_if(F.col("change_type") == k).alias(k) for k in kinds])
