"""Batches of requests that a service works on for a while: polled by timers until they are done, from a stream.

Each submitted batch is a key with state (when it was submitted, how often it has been polled). A timer asks the service
again after every ``interval``; a batch that is done gives its answers, one that isn't by ``timeout`` gives an error. State
and timers live in the query's checkpoint, so a query that was stopped goes on with the batches that are open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: ``poll(batch)`` gives None while the service works, else the answers as (request, answer, error).
Poll = Callable[[str], list[tuple[str, str | None, str | None]] | None]
ANSWERS = "batch string, request string, answer string, error string, polls int"
#: RocksDB keeps state on disk and its changes in the checkpoint; timers need it.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class _Polled(StatefulProcessor):
    def __init__(self, make_poll: Callable[[], Poll], interval: float, timeout: float):
        self.make_poll, self.interval, self.timeout = make_poll, int(interval * 1000), int(timeout * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.poll = handle, self.make_poll()
        self.open = handle.getValueState("open", "since long, polls int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        if key[0] is not None and not self.open.exists():  # a batch that is submitted again is the same batch
            now = timerValues.getCurrentProcessingTimeInMs()
            self.open.update((now, 0))
            self.handle.registerTimer(now + self.interval)
        yield pd.DataFrame([], columns=["batch", "request", "answer", "error", "polls"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since, polls = self.open.get()
        now, found = timerValues.getCurrentProcessingTimeInMs(), self.poll(key[0])
        if found is None and now - since < self.timeout:
            self.open.update((since, polls + 1))
            self.handle.registerTimer(now + self.interval)
            found = []
        else:
            self.open.clear()
            found = [("", None, "batch timed out")] if found is None else found
        rows = [(key[0], request, answer, error, polls + 1) for request, answer, error in found]
        yield pd.DataFrame(rows, columns=["batch", "request", "answer", "error", "polls"])

    def close(self) -> None:
        pass


def polled(submitted: DataFrame, make_poll: Callable[[], Poll], interval: float = 30, timeout: float = 3600, batch: str = "batch") -> DataFrame:
    """(batch, request, answer, error, polls) of a stream of submitted batches, each once it is done or timed out.

    Timers fire with a micro-batch, and a query that has just been started again runs none before there is new data: a tick a
    second sees to it that there is. The session needs the settings in ``STATE_STORE``. Null batches are left out. An answer is given once for each batch, as far as the sink writes a
    repeated micro-batch once.
    """
    spark = submitted.sparkSession
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.lit(None).cast("string").alias("batch"))
    asked = submitted.where(F.col(batch).isNotNull()).select(F.col(batch).cast("string").alias("batch")).unionByName(ticks)
    processor = _Polled(make_poll, interval, timeout)
    return asked.groupBy("batch").transformWithStateInPandas(processor, ANSWERS, "Append", "ProcessingTime")
