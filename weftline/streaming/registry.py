"""A registry of chat sessions as a stream: open, append, close, reopen, with state, timers and expiry.

Each event is answered in the order of its session. A session's state is whether it is open and its
last turns, in a map from the turn's number; a timer closes a session without events. ``registry``
is the stream and ``replayed`` the same answers over a table that is at rest, by windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OPEN, APPEND, CLOSE = "open", "append", "close"
ANSWER = "session string, seq long, status string, turns long, history string"
#: Statuses: what an event did, or that it met no open session.
OPENED, REOPENED, APPENDED, CLOSED, UNKNOWN, EXPIRED = "opened", "reopened", "appended", "closed", "unknown", "expired"


def use_state_store(spark: SparkSession) -> None:
    """The state store that map state and timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Registry(StatefulProcessor):
    def __init__(self, keep: int, idle_ms: int | None):
        self.keep, self.idle_ms = keep, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.session = handle.getValueState("session", "is_open boolean, turns long")
        self.turns = handle.getMapState("turns", "n long", "line string")

    def _history(self, n: int) -> str:
        return "\n".join(self.turns.getValue((i,))[0] for i in range(max(0, n - self.keep), n))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values("seq", kind="stable")
        seen = self.session.exists()
        is_open, n = self.session.get() if seen else (False, 0)
        out = []
        for seq, op, line in zip(events.seq, events.op, events.line, strict=True):
            status = UNKNOWN
            if op == OPEN:
                status, seen, is_open, n = REOPENED if seen else OPENED, True, True, 0
                self.turns.clear()
            elif is_open and op == APPEND:
                status = APPENDED
                self.turns.updateValue((n,), (line,))
                if n >= self.keep:
                    self.turns.removeKey((n - self.keep,))
                n += 1
            elif is_open and op == CLOSE:
                status, is_open = CLOSED, False
            out.append((key[0], seq, status, n if is_open or status == CLOSED else 0, self._history(n) if is_open or status == CLOSED else ""))
            if status == CLOSED:
                self.turns.clear()
                n = 0
        if seen:
            self.session.update((is_open, n))
        if self.idle_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if is_open:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield pd.DataFrame(out, columns=["session", "seq", "status", "turns", "history"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n = self.session.get()[1]
        history = self._history(n)
        self.turns.clear()
        self.session.update((False, 0))
        yield pd.DataFrame([(key[0], -1, EXPIRED, n, history)], columns=["session", "seq", "status", "turns", "history"])

    def close(self) -> None:
        pass


def registry(events: DataFrame, keep: int = 8, idle_ms: int | None = None) -> DataFrame:
    """A stream of answers to a stream of ``events`` (session, seq, op, line): session, seq, status, turns and history.

    Events of a session are answered in the order of ``seq`` within a batch, and batches in their
    order. ``history`` is the last ``keep`` lines since the session was opened. A session that has been
    idle for ``idle_ms`` is closed with a row of its own (status expired, seq -1) and may be reopened. An event of
    an unknown or closed session, and one of an unknown kind, is answered with ``unknown``. State is ``keep`` lines a session.
    """
    src = events.select(F.col("session").cast("string").alias("session"), F.col("seq").cast("long").alias("seq"), "op", F.coalesce("line", F.lit("")).alias("line"))
    return src.groupBy("session").transformWithStateInPandas(Registry(keep, idle_ms), ANSWER, "append", "ProcessingTime" if idle_ms else "None")


def replayed(events: DataFrame, keep: int = 8) -> DataFrame:
    """The answers to a table of events, without expiry: the state before an event is decided by the last event that opened or closed its session."""
    w = Window.partitionBy("session").orderBy("seq")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    e = events.select(F.col("session").cast("string").alias("session"), F.col("seq").cast("long").alias("seq"), "op", F.coalesce("line", F.lit("")).alias("line"))
    e = e.withColumn("last", F.last(F.when(F.col("op").isin(OPEN, CLOSE), F.col("op")), ignorenulls=True).over(past))
    e = e.withColumn("opened", F.sum(F.when(F.col("op") == OPEN, 1).otherwise(0)).over(w))
    live = F.col("last").eqNullSafe(F.lit(OPEN))
    status = F.when(F.col("op") == OPEN, F.when(F.col("opened") > 1, REOPENED).otherwise(OPENED)).when(live & (F.col("op") == APPEND), APPENDED).when(live & (F.col("op") == CLOSE), CLOSED).otherwise(UNKNOWN)
    e = e.withColumn("status", status)
    here = Window.partitionBy("session", "opened").orderBy("seq")
    said = F.when(F.col("status") == APPENDED, F.col("line"))
    e = e.withColumn("n", F.count(said).over(here))
    # The last lines are found among those that were appended, so that other events between them do not count.
    lines = e.where(F.col("status") == APPENDED).withColumn("history", F.array_join(F.collect_list("line").over(here.rowsBetween(-(keep - 1), 0)), "\n")).select("session", "opened", F.col("n").alias("__n"), "history")
    met = e.join(lines.withColumnsRenamed({"session": "__s", "opened": "__o"}), (F.col("session") == F.col("__s")) & (F.col("opened") == F.col("__o")) & (F.col("n") == F.col("__n")), "left")
    # An event of another kind does not change an open session: it is answered as unknown, with the session's turns.
    open_ = (F.col("status") != UNKNOWN) | live
    return met.select("session", "seq", "status", F.when(open_, F.col("n")).otherwise(0).cast("long").alias("turns"), F.when(open_, F.coalesce("history", F.lit(""))).otherwise("").alias("history"))
