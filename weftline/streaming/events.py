"""Streams: event-time windows with late data, sessions, and per-conversation state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes", ts: str = "ts", by: str = "event_type") -> DataFrame:
    """Counts and sums by window and type. On a stream, rows later than ``late`` are dropped and state is bounded by it."""
    src = events.withWatermark(ts, late) if events.isStreaming else events
    out = src.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", ts: str = "ts", user: str = "user_id") -> DataFrame:
    """A user's events without a pause of ``gap``."""
    src = events.withWatermark(ts, late) if events.isStreaming else events
    out = src.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count("*").alias("n"))
    return out.select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def conversation_state(turns: DataFrame, limit: int = 8, key: str = "conv_id", idle_ms: int | None = 3_600_000) -> DataFrame:
    """A stream of turns: for each batch of a conversation its turns so far and the last ``limit`` of them.

    State is two arrays of at most ``limit`` entries a conversation. It expires after ``idle_ms`` without
    turns; a stream that is to end by itself (availableNow) takes None, for a timeout asks for ever more batches.
    """

    def step(group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, roles, texts = state.get if state.exists else (0, [], [])
        rows = pd.concat(list(batches)).sort_values("turn")
        n += len(rows)
        roles, texts = [*roles, *rows.role][-limit:], [*texts, *rows.text][-limit:]
        state.update((n, roles, texts))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({key: [group[0]], "turns": [n], "history": ["\n".join(f"{r}: {t}" for r, t in zip(roles, texts, strict=True))]})

    return turns.groupBy(key).applyInPandasWithState(step, f"{key} long, turns long, history string", "n long, roles array<string>, texts array<string>", "update", "ProcessingTimeTimeout" if idle_ms else "NoTimeout")
