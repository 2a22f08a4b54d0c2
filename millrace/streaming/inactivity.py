"""Counts per key that end after a time without rows, by the clock of the running query."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle


class _Counting(StatefulProcessor):
    """State of a key: rows so far, the times of its first and last batch, and when it ends.

    Every call to the state is a message to the JVM, so a key is read once and written once a batch.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("count", "n long, opened_ms long, last_ms long, ends_ms long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        added = sum(row["n"] for row in rows)
        before = self.state.get()
        if before is not None:
            self.handle.deleteTimer(before[3])
            if before[3] <= now:  # its time was over before these rows came, though no batch has said so
                yield self._ended(key, before)
                before = None
        n, opened = (before[0], before[1]) if before is not None else (0, now)
        self.state.update((n + added, opened, now, now + self.idle_ms))
        self.handle.registerTimer(now + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.state.get()
        if held is not None and held[3] <= timerValues.getCurrentProcessingTimeInMs():
            self.state.clear()
            yield self._ended(key, held)

    def _ended(self, key, held) -> Row:
        return Row(key=key[0], n=held[0], opened_ms=held[1], last_ms=held[2])

    def close(self) -> None:
        pass


def _partial_counts(keyed: DataFrame) -> DataFrame:
    """Rows per key and Arrow batch, so that a busy key sends the state's task one row for thousands."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby("key", sort=False).size().rename("n").reset_index()

    return keyed.mapInPandas(counted, "key string, n long")


def idle_counts(df: DataFrame, keys: Sequence[str], idle_ms: int) -> DataFrame:
    """``keys, n, opened_ms, last_ms`` of every count that has ended: no row for more than ``idle_ms`` on the clock of the query.

    Each row puts the end of its key off. A timer ends the count, forgets the key and emits the row, also in a batch without
    data; a row that comes after the end, but before a batch has run the timer, opens a new count. Times are those of batches, in
    milliseconds, and are kept with the state, so time goes on while the query is stopped. The state is one row a key; a null
    is a key like others (keys travel as JSON).
    """
    keyed = df.select(F.to_json(F.struct(*keys)).alias("key"))
    fields = [T.StructField("key", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("n", "opened_ms", "last_ms")]]
    ended = _partial_counts(keyed).groupBy("key").transformWithState(
        _Counting(idle_ms), outputStructType=T.StructType(fields), outputMode="Append", timeMode="ProcessingTime"
    )
    parsed = F.from_json("key", df.select(*keys).schema)
    return ended.select(parsed.alias("k"), "n", "opened_ms", "last_ms").select(*[F.col("k")[k].alias(k) for k in keys], "n", "opened_ms", "last_ms")


@contextmanager
def batches_with_data_only(spark: SparkSession) -> Iterator[None]:
    """For runs that end once all data is read: a query with timers has a batch without data after every other one, for ever."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_out(writer: DataStreamWriter, checkpoint: str, timeout_s: float = 120) -> None:
    """Run until no key has state left: every count has ended and was emitted.

    A query that starts again runs its first batch when the source has something new, be it a file without rows; from then on
    timers keep it going. A batch may take any time. It is an error if, for ``timeout_s``, no batch runs or none reads rows or
    leaves fewer keys than before.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(processingTime="100 milliseconds").start()
    try:
        since, batch, fewest = time.monotonic(), None, None
        while True:
            if query.exception() is not None:
                raise query.exception()
            active, done = query.status["isTriggerActive"], query.lastProgress  # in this order: a batch reports before it is over
            ended = done is not None and done.stateOperators and done.batchId != batch
            if done is not None and done.stateOperators:
                left = done.stateOperators[0].numRowsTotal
                if not done.numInputRows and not left:
                    return
                if ended and (done.numInputRows or fewest is None or left < fewest):
                    since, fewest = time.monotonic(), left
                batch = done.batchId
            if (ended or not active) and time.monotonic() - since > timeout_s:
                raise TimeoutError(f"keys still have state after {timeout_s} s")
            time.sleep(0.1)
    finally:
        query.stop()
