"""Queries of label records, encodings, readers and named functions, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import registry
from weftline.operators import behaviour, curriculum
from weftline.plans.catalog import query
from weftline.plans.shared import new_path
from weftline.sources import sinks, tables
from weftline.sources.tables import table


@query("""WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'other' ELSE 'persona_speech' END AS task, o_orderpriority AS p, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'say "' || o_orderstatus || '"' END AS d FROM orders)
    SELECT CAST(k AS VARCHAR) AS id, task, 'core' || chr(10) || p AS system, 'and?' AS cue, 'plain' AS answer, NULL AS origin_id FROM r
    UNION ALL SELECT k || ':judgment', 'behavior_judgment', concat_ws(chr(10), 'core', p, CASE WHEN p <> '1-URGENT' THEN '1-URGENT' END), 'why?' || chr(10) || 'and?', '{"decision":"' || replace(d, '"', '\\"') || '","action":"' || p || '"}', CAST(k AS VARCHAR) FROM r WHERE task <> 'other' AND d <> ''""")
def behaviour_records(spark, d):
    """Each record and, where its judgment is complete, the label record made from it."""
    o, turn = table(spark, d, "orders"), lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    decision = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit('say "'), "o_orderstatus", F.lit('"')))
    judgment = F.struct(F.array(F.lit("1-URGENT"), F.lit("core")).alias("activated_memory"), decision.alias("decision"), F.col("o_orderpriority").alias("action"))
    rows = o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderkey") % 5 == 0, "other").otherwise(behaviour.SPEECH).alias("task"), F.array(turn("system", F.concat(F.lit("core\n"), "o_orderpriority")), turn("user", F.lit("and?"))).alias("prompt"),
        F.array(turn("assistant", F.lit("plain"))).alias("completion"), judgment.alias("judgment"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("record_key"),
    )
    out = behaviour.with_behaviour(rows, ["decision", "action"], "why?")
    return out.select("id", "task", F.col("prompt")[0]["content"].alias("system"), F.col("prompt")[1]["content"].alias("cue"), F.col("completion")[0]["content"].alias("answer"), "origin_id")


@query("""WITH e AS (SELECT conv_id, turn, list_transform(string_split(CASE turn % 5 WHEN 3 THEN 'xx' ELSE role END, ''), lambda c: unicode(c)) AS p, list_transform(string_split(role || text, ''), lambda c: unicode(c)) AS x FROM conversations),
    q AS (SELECT *, CASE WHEN NOT (len(x) > len(p) AND x[:len(p)] = p) THEN 'not_a_prefix' WHEN len(x) > 600 THEN 'too_long' END AS problem FROM e)
    SELECT conv_id, turn, problem, CASE WHEN problem IS NULL THEN CAST(len(p) AS BIGINT) END AS n_ignored, CASE WHEN problem IS NULL THEN CAST(list_sum(x[len(p) + 1:]) AS BIGINT) END AS label_sum FROM q""")
def encoded_labels(spark, d):
    """Characters stand for tokens: labels behind the prompt, a prompt that is none, and texts that are too long."""
    ids = lambda c: F.transform(F.split(c, ""), lambda x: F.ascii(x))
    c = table(spark, d, "conversations").withColumns({"p": ids(F.when(F.col("turn") % 5 == 3, "xx").otherwise(F.col("role"))), "x": ids(F.concat("role", "text"))})
    out = behaviour.encoded(c, "p", "x", 600)
    ignored = F.size(F.filter("labels", lambda v: v == -100)).cast("long")
    total = F.aggregate(F.filter("labels", lambda v: v != -100), F.lit(0).cast("long"), lambda s, v: s + v)
    return out.select("conv_id", "turn", "problem", F.when(F.col("labels").isNotNull(), ignored).alias("n_ignored"), total.alias("label_sum"))


@query("""WITH o AS (SELECT doc_id, source, length(text) AS n, row_number() OVER (PARTITION BY source ORDER BY sha256('42|' || doc_id), doc_id) - 1 AS i FROM documents), p AS (SELECT *, i // 128 AS pool FROM o),
    b AS (SELECT *, (row_number() OVER (PARTITION BY source, pool ORDER BY n, doc_id) - 1) // 8 AS batch FROM p), u AS (SELECT DISTINCT source, pool, batch FROM b),
    s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY sha256('42|' || coalesce(source, '') || '|' || pool || '|' || batch)) - 1 AS step FROM u)
    SELECT doc_id, CAST(step AS BIGINT) AS step FROM b JOIN s ON s.source IS NOT DISTINCT FROM b.source AND s.pool = b.pool AND s.batch = b.batch""")
def shuffled_batches(spark, d):
    """Batches of like lengths in a seeded order of their own."""
    docs = table(spark, d, "documents", ["doc_id", "source", "text"]).select("doc_id", "source", F.length("text").alias("n"))
    return curriculum.shuffled_batches(curriculum.length_batches(docs, "source", "doc_id", "n"), "source").select("doc_id", "step")


@query("SELECT conv_id, count(*) AS n, sha256(string_agg(turn || '|' || conv_id || '|' || role || '|' || text, chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id")
def grouped_rows(spark, d):
    """Whole rows of each conversation in order."""
    rows = tables.grouped_rows(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", ["turn"])
    line = lambda r: F.concat_ws("|", r["turn"].cast("string"), r["conv_id"].cast("string"), r["role"], r["text"])
    return rows.select("conv_id", F.size("rows").cast("long").alias("n"), F.sha2(F.array_join(F.transform("rows", line), "\n"), 256).alias("digest"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def json_arrays_round_trip(spark, d):
    """Files that each are one JSON array, one a nation, read with a declared schema."""
    path = new_path(spark, "arrays")
    c = table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey"]).groupBy("c_nationkey").agg(F.collect_list(F.struct("c_custkey", "c_name", "c_nationkey")).alias("a"))
    c.select(F.to_json("a").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return tables.json_array(spark, path, "c_custkey long, c_name string, c_nationkey int")


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'name' ELSE '' END AS missing FROM supplier")
def persona_round_trip(spark, d):
    """A JSON file a supplier: those that lack a required field are errors that say so."""
    path = new_path(spark, "personas")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("name"))
    s.repartition(tables.TASKS * spark.sparkContext.defaultParallelism).write.option("maxRecordsPerFile", 1).json(path)
    good, bad = tables.persona_files(spark, path, "id long, name string", ["id", "name"])
    named = bad.select("found.id", F.lit(None).cast("string").alias("name"), F.array_join("missing", ",").alias("missing"))
    return good.select("id", "name", F.lit("").alias("missing")).unionByName(named)


@query("""WITH n AS (SELECT conv_id AS record_key, count(*) AS n FROM conversations WHERE turn < 2 + conv_id % 2 GROUP BY conv_id)
    SELECT record_key, CASE WHEN n = 1 THEN 'note' ELSE 'repeated' END AS state FROM n UNION ALL SELECT NULL, 'bad' FROM nation""")
def annotation_file(spark, d):
    """Notes written as JSON lines with repeated keys and lines that do not parse."""
    path, c = new_path(spark, "notes"), table(spark, d, "conversations").where("turn < 2 + conv_id % 2")
    sinks.json_lines(c.select(F.col("conv_id").alias("record_key"), "text"), path)
    table(spark, d, "nation").select(F.concat(F.lit("{"), "n_name").alias("value")).write.mode("append").text(path)
    notes, bad, repeated = tables.annotation_file(spark, path, "record_key long, text string", "record_key")
    out = notes.select("record_key", F.lit("note").alias("state")).unionByName(repeated.select("record_key", F.lit("repeated").alias("state")))
    return out.unionByName(bad.select(F.lit(None).cast("long").alias("record_key"), F.lit("bad").alias("state")))


@query(r"""SELECT doc_id, substr(text, 1, 80) AS head, CASE CAST(('0x' || sha256(CAST(doc_id AS VARCHAR))[:8])::BIGINT % 1000 AS BIGINT) WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END AS split,
    regexp_replace(regexp_replace(lower(source || ' ' || lang), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM documents""")
def named_functions(spark, d):
    """Columns by functions that are looked up by name."""
    docs = table(spark, d, "documents").withColumns({"key": F.col("doc_id").cast("string"), "label": F.concat_ws(" ", "source", "lang")})
    return registry.applied(docs, {"head": ("preview", "text"), "split": ("held_out_split", "key"), "slug": ("slug", "label")}).select("doc_id", "head", "split", "slug")
