"""Structured Streaming jobs. A query's checkpoint location makes a page or event count once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from tidewright.operators.cdc import upsert
from tidewright.sources.landing import page_rows

#: Late rows are taken up to two hours back, rows from the future up to a day ahead, and a voyage retires after so many idle rounds.
LATE, AHEAD, IDLE_ROUNDS = "2 hours", "24 hours", 6


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Files of page JSON, one page a file, as they land."""
    return spark.readStream.format("text").option("wholetext", True).load(path).withColumnRenamed("value", "body")


def streamed_rows(pages: DataFrame) -> DataFrame:
    return page_rows(pages).withColumn("observed_at", F.current_timestamp())


def not_ahead(events: DataFrame, at: str) -> DataFrame:
    """Without rows whose time lies further ahead than the margin."""
    return events.filter(F.col(at) <= F.current_timestamp() + F.expr(f"interval {AHEAD}"))


def start_landing(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write rows as they come until there are none. ``checkpoint`` remembers what was read: a query that is started again goes on behind it, and
    each page counts once. What ``observed_at`` says at landing is what as-of reads go by, whatever the rows' own times are."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_events(events: DataFrame, id_col: str, at: str) -> DataFrame:
    """Each id once within the watermark; rows from too far ahead are left out."""
    return not_ahead(events, at).withWatermark(at, LATE).dropDuplicatesWithinWatermark([id_col])


def windowed_counts(events: DataFrame, at: str, keys: list[str], weekly: bool = False) -> DataFrame:
    """Counts by day, or by ISO week: windows of seven days that begin on a Monday (1970-01-05 was one)."""
    w = F.window(at, "7 days", startTime="4 days") if weekly else F.window(at, "1 day")
    return not_ahead(events, at).withWatermark(at, LATE).groupBy(w, *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("bucket"), *keys, "n")


class IdleRounds(StatefulProcessor):
    """Rounds without new events per voyage. Input rows: (voyage, round, new_events, in_catalog, last_event).

    With ``silent_ms`` a voyage that no row names for so long has an idle round as well, again and again until it retires, and what retired and stayed silent
    is forgotten after ``forget_ms``.
    """

    def __init__(self, silent_ms: int | None = None, forget_ms: int | None = None):
        self.silent_ms, self.forget_ms = silent_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("idle", "idle int, last_event timestamp, in_catalog boolean", self.forget_ms) if self.forget_ms else handle.getValueState("idle", "idle int, last_event timestamp, in_catalog boolean")

    def _frame(self, key, idle: int, last, known: bool) -> pd.DataFrame:
        return pd.DataFrame({"voyage": [key[0]], "idle_rounds": [idle], "last_event": [last], "inactive": [bool(idle >= IDLE_ROUNDS and not known)]})

    def _wake_after(self, timer_values, retired: bool) -> None:
        """One timer a voyage: the next idle round; none once it has retired."""
        if self.silent_ms:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if not retired:
                self.handle.registerTimer(timer_values.getCurrentProcessingTimeInMs() + self.silent_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("round")
        idle, last = tuple(self.state.get())[:2] if self.state.exists() else (0, None)
        for r in frame.itertuples():
            idle = 0 if r.new_events > 0 else idle + 1
            if pd.notna(r.last_event) and (last is None or r.last_event > pd.Timestamp(last)):
                last = r.last_event.to_pydatetime()
        known = bool(frame["in_catalog"].iloc[-1])
        self.state.update((idle, last, known))
        out = self._frame(key, idle, last, known)
        self._wake_after(timerValues, bool(out["inactive"][0]))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        idle, last, known = self.state.get()
        self.state.update((idle + 1, last, known))
        out = self._frame(key, idle + 1, last, known)
        if not out["inactive"][0]:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silent_ms)
        yield out

    def close(self) -> None:
        pass


IDLE_SCHEMA = "voyage string, idle_rounds int, last_event timestamp, inactive boolean"


def idle_rounds(rounds: DataFrame, silent_ms: int | None = None, forget_ms: int | None = None) -> DataFrame:
    """Per voyage after each batch: idle rounds, last event, and whether it retires: idle for IDLE_ROUNDS and gone from the catalog. Needs the RocksDB state store.

    Without ``silent_ms`` only rows that say so are idle rounds. With it silence counts: processing-time timers add a round each ``silent_ms`` without a row, also in batches without any
    data, and the state of a voyage expires ``forget_ms`` after its last change.
    """
    mode = "ProcessingTime" if silent_ms or forget_ms else "None"
    return rounds.groupBy("voyage").transformWithStateInPandas(IdleRounds(silent_ms, forget_ms), outputStructType=StructType.fromDDL(IDLE_SCHEMA), outputMode="Update", timeMode=mode)


def idle_rounds_batch(rounds: DataFrame) -> DataFrame:
    """The same over a whole log of rounds: rounds since the last with new events."""
    last = F.max(F.when(F.col("new_events") > 0, F.col("round")))
    out = rounds.groupBy("voyage").agg(last.alias("_hit"), F.collect_set("round").alias("_rounds"), F.max("last_event").alias("last_event"), F.max(F.struct("round", "in_catalog"))["in_catalog"].alias("_in"))
    idle = F.size(F.filter("_rounds", lambda r: F.col("_hit").isNull() | (r > F.col("_hit"))))
    return out.select("voyage", idle.alias("idle_rounds"), "last_event", ((idle >= IDLE_ROUNDS) & ~F.col("_in")).alias("inactive"))


def upsert_batches(read: Callable[[], DataFrame], write: Callable[[DataFrame], None], key: str, order: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the latest row of each key in the batch goes into the next snapshot.

    Spark may give a batch again after a failure, under the same id. Taking the same rows twice leaves the same snapshot, so ``write`` must only replace
    what ``read`` gives, not add to it; the id is not needed for that.
    """

    def run(batch: DataFrame, _: int) -> None:
        fields = [c for c in batch.columns if c != key]
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(order, F.xxhash64(*fields))).alias("r")).select(key, "r.*")
        write(upsert(read(), newest, key))

    return run
