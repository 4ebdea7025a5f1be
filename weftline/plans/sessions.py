"""Queries of the session registry, at rest and as a stream, beside one SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.plans.catalog import query
from weftline.plans.shared import new_path
from weftline.sources.tables import table
from weftline.streaming import registry

SESSIONS_SQL = """WITH e AS (SELECT CAST(conv_id % 50 AS VARCHAR) AS session, conv_id * 1000 + turn AS seq, CASE WHEN turn = 0 OR (conv_id + turn) % 11 = 0 THEN 'open' WHEN (conv_id + turn) % 7 = 0 THEN 'close' WHEN (conv_id + turn) % 13 = 0 THEN 'ask' ELSE 'append' END AS op, substr(text, 1, 20) AS line FROM conversations),
    l AS (SELECT *, last_value(CASE WHEN op IN ('open', 'close') THEN op END IGNORE NULLS) OVER (PARTITION BY session ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last, count(*) FILTER (op = 'open') OVER (PARTITION BY session ORDER BY seq) AS opened FROM e),
    s AS (SELECT *, CASE WHEN op = 'open' THEN CASE WHEN opened > 1 THEN 'reopened' ELSE 'opened' END WHEN last = 'open' AND op = 'append' THEN 'appended' WHEN last = 'open' AND op = 'close' THEN 'closed' ELSE 'unknown' END AS status FROM l),
    h AS (SELECT *, status <> 'unknown' OR coalesce(last = 'open', false) AS live, coalesce(list(line) FILTER (status = 'appended') OVER (PARTITION BY session, opened ORDER BY seq), []) AS lines FROM s)
    SELECT session, seq, status, CASE WHEN live THEN len(lines) ELSE 0 END AS turns, CASE WHEN live THEN array_to_string(lines[-3:], chr(10)) ELSE '' END AS history FROM h"""


def events_of(turns):
    odd = F.col("conv_id") + F.col("turn")
    op = F.when((F.col("turn") == 0) | (odd % 11 == 0), "open").when(odd % 7 == 0, "close").when(odd % 13 == 0, "ask").otherwise("append")
    return turns.select((F.col("conv_id") % 50).cast("string").alias("session"), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), op.alias("op"), F.substring("text", 1, 20).alias("line"))


@query(SESSIONS_SQL)
def session_registry(spark, d):
    return registry.replayed(events_of(table(spark, d, "conversations")), keep=3)


@query(SESSIONS_SQL)
def session_stream(spark, d):
    """The same answers by the stream, which reads the table as a source of files and ends when it has read all."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    path, out = new_path(spark, "sessions"), new_path(spark, "answers")
    registry.use_state_store(spark)
    try:
        source = spark.readStream.schema(table(spark, d, "conversations").schema).parquet(f"{d}/conversations.parque[t]")  # a pattern, for the table may be one file
        writer = registry.registry(events_of(source), keep=3).writeStream.format("parquet").option("checkpointLocation", path)
        writer.outputMode("append").trigger(availableNow=True).start(out).awaitTermination()
    finally:
        spark.conf.set(key, old)
    return spark.read.schema(registry.ANSWER).parquet(out)
