"""The session registry as a stream, restarted between batches, beside the same events at rest."""

import random

import pytest

from weftline.streaming import registry

pytest.importorskip("google.protobuf")
KIND = "session string, seq long, op string, line string"


@pytest.fixture
def store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    registry.use_state_store(spark)
    yield
    spark.conf.set(key, old)


def plain(events, keep):
    """Answers by a dict of sessions."""
    known, out = {}, []
    for session, seq, op, line in sorted(events, key=lambda e: (e[0], e[1])):
        turns = known.get(session)
        status = "unknown"
        if op == "open":
            status = "reopened" if session in known else "opened"
            turns = known[session] = []
        elif turns is not None and op == "append":
            status = "appended"
            turns.append(line or "")
        elif turns is not None and op == "close":
            status, known[session] = "closed", None
        out.append((session, seq, status, len(turns or []), "\n".join((turns or [])[-keep:])))
    return sorted(out)


def make(rng, n):
    return [(f"s{rng.randrange(6)}", i, rng.choice(["open", "append", "append", "append", "close", "other"]), rng.choice([None, "", f"line {i}"])) for i in range(n)]


def test_events_at_rest(spark):
    events = make(random.Random(2), 300)
    got = registry.replayed(spark.createDataFrame(events, KIND), keep=3)
    assert sorted(map(tuple, got.collect())) == plain(events, 3)
    assert registry.replayed(spark.createDataFrame([], KIND)).count() == 0


def test_stream_in_batches_with_a_restart(spark, store, tmp_path):
    events = make(random.Random(5), 90)
    for k in range(3):
        spark.createDataFrame(events[30 * k : 30 * k + 30], KIND).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = registry.registry(spark.readStream.schema(KIND).parquet(str(tmp_path / "in")), keep=3)
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out"))
        assert q.awaitTermination(120)
    got = spark.read.schema(registry.ANSWER).parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == plain(events, 3)


def test_idle_sessions_expire(spark, store, tmp_path):
    import time

    path = str(tmp_path / "in")
    spark.createDataFrame([("a", 1, "open", None), ("a", 2, "append", "hi")], KIND).coalesce(1).write.parquet(path)
    stream = registry.registry(spark.readStream.schema(KIND).parquet(path), keep=3, idle_ms=1500)
    q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(processingTime="500 milliseconds").start(str(tmp_path / "out"))
    read = lambda: sorted((r["seq"], r["status"], r["turns"], r["history"]) for r in spark.read.schema(registry.ANSWER).parquet(str(tmp_path / "out")).collect())
    try:
        for _ in range(60):
            time.sleep(1)
            if (tmp_path / "out" / "_spark_metadata").exists() and any(r[1] == "expired" for r in read()):
                break
        spark.createDataFrame([("a", 3, "append", "late"), ("a", 4, "open", None)], KIND).coalesce(1).write.mode("append").parquet(path)
        for _ in range(60):
            time.sleep(1)
            if any(r[0] == 4 for r in read()):
                break
    finally:
        q.stop()
    assert [r for r in read() if r[0] > 0 or r[1] == "expired"][:5] == [(-1, "expired", 1, "hi"), (1, "opened", 0, ""), (2, "appended", 1, "hi"), (3, "unknown", 0, ""), (4, "reopened", 0, "")]
