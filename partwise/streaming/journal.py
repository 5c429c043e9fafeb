"""The run journal as a stream: each run's last status, and every illegal step, hole and idle run as a row of its own."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENT = "run_id long, sequence long, to_status string"
OUT = "run_id long, kind string, sequence long, from_status string, to_status string, next_sequence long, illegal long, repeated long"
#: Which status may follow which.
EDGES = {None: {"created", "running"}, "created": {"running", "failed"}, "running": {"paused", "completed", "failed"}, "paused": {"running", "failed"}, "completed": set(), "failed": {"running"}}
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER, _NO_DATA = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled"


class Follower(StatefulProcessor):
    """One run: where it stands (a value), and the events that came before their turn (a list).

    Events are taken in order of sequence whatever batch they come in. One that was taken already is counted as repeated.
    One that comes early waits; when the run has been idle for `idle_ms`, what waits is taken as it is, the gap before it
    told as a hole.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stand = handle.getValueState("stand", "status string, expected long, illegal long, repeated long")
        self.early = handle.getListState("early", "sequence long, to_status string")

    def _where(self) -> tuple:
        return tuple(self.stand.get()) if self.stand.exists() else (None, 1, 0, 0)

    def _taken(self, run: int, events: list[tuple[int, str]], all_of_them: bool) -> list[tuple]:
        """Rows for events in order; those that must wait are kept unless all are to be taken."""
        status, expected, illegal, repeated = self._where()
        out, waiting = [], []
        for sequence, to in sorted(events):
            if sequence < expected:
                repeated += 1
                continue
            if sequence > expected and not all_of_them:
                waiting.append((sequence, to))
                continue
            kind = "hole" if sequence > expected else None if to in EDGES.get(status, set()) else "illegal"
            if kind:
                illegal += 1
                out.append((run, kind, sequence, status, to, sequence + 1, illegal, repeated))
            status, expected = to, sequence + 1
        unique = sorted(set(waiting))
        repeated += len(waiting) - len(unique)
        self.stand.update((status, expected, illegal, repeated))
        if unique:
            self.early.put(unique)
        else:
            self.early.clear()
        return [*out, (run, "status", None, None, status, expected, illegal, repeated)]

    def _waiting(self) -> list[tuple[int, str]]:
        return [tuple(e) for e in self.early.get()] if self.early.exists() else []

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = [(int(s), t) for batch in rows for s, t in batch[["sequence", "to_status"]].itertuples(index=False)]
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield _frame(self._taken(int(key[0]), self._waiting() + new, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        run = int(key[0])
        rows = self._taken(run, self._waiting(), True)
        yield _frame([*rows, (run, "idle", None, None, *rows[-1][4:])])

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")]).astype({"sequence": "Int64"})


@contextmanager
def state_store(spark: SparkSession, timers_alone: bool = True) -> Iterator[None]:
    """Queries that are started within have the state store that such state needs; without timers_alone no batch runs for a timer only, so that a stream over what is there ends."""
    wanted = {_PROVIDER: _ROCKS, _NO_DATA: str(timers_alone).lower()}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def journal_states(events: DataFrame, idle_ms: int = 60_000) -> DataFrame:
    """Rows of OUT for a stream of events (run_id, sequence, to_status), to be started within state_store().

    After each batch a run that had events has a status row (its last status, the next sequence, how many steps were
    illegal or holes so far, how many events came again), after one row for each such step; an idle run has an idle row.
    """
    keyed = events.select("run_id", "sequence", "to_status").groupBy("run_id")
    return keyed.transformWithStateInPandas(statefulProcessor=Follower(idle_ms), outputStructType=OUT, outputMode="Append", timeMode="ProcessingTime")


def read_journal(spark: SparkSession, path: str, files_a_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENT)
    return (reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader).json(path)


def followed(events: DataFrame, out: str, marks: str, idle_ms: int = 60_000) -> None:
    """Takes what is there of a stream of events, batch by batch, adding rows of OUT and batch to Parquet below `out`; goes on from `marks` after a stop.

    A batch that is done again replaces its own rows (its folder), so each row is there once.
    """
    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    with state_store(events.sparkSession, timers_alone=False):
        query = journal_states(events, idle_ms).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", marks).trigger(availableNow=True).start()
    query.awaitTermination()
