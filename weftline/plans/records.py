"""Queries of keys, records and acceptance rules, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import classify, records
from weftline.plans.catalog import query
from weftline.sources.tables import table

JSON_SQL = "'\"' || replace(replace(replace({0}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n') || '\"'"


@query(f"""WITH c AS (SELECT conv_id, turn, {JSON_SQL.format("text")} AS j, lag({JSON_SQL.format("text")}) OVER w AS a, lag({JSON_SQL.format("text")}, 2) OVER w AS b FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, turn, sha256('{{"context": [' || concat_ws(', ', b, a) || '], "source": {{"keys": [' || conv_id || ', ' || turn || '], "kind": "talk", "table": "conversations"}}, "speech": [' || j || ']}}') AS record_key FROM c""")
def record_keys(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").withColumn("past", F.collect_list("text").over(w.rowsBetween(-3, -1)))
    key = records.record_key(F.lit("talk"), F.lit("conversations"), F.array("conv_id", "turn"), F.col("past"), F.array("text"))
    return c.select("conv_id", "turn", key.alias("record_key"))


@query(f"""SELECT conv_id, turn, 'speech:' || sha256('{{"language": "ko", "source": {{"kind": "talk", "table": "conversations"}}, "speech": [' || {JSON_SQL.format("text")} || '], "task": "' || role || '"}}') AS speech_key FROM conversations""")
def speech_keys(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", records.speech_key(F.lit(None).cast("string"), F.col("role"), F.lit("talk"), F.lit("conversations"), F.array("text"), "speech:").alias("speech_key"))


@query("""SELECT 'documents' AS lane, 0 AS lane_no, count(*) AS n, count(DISTINCT text) AS n_texts FROM documents
    UNION ALL SELECT 'benchmark', 1, count(*), count(DISTINCT text) FROM benchmark UNION ALL SELECT 'conversations', 2, count(*), count(DISTINCT text) FROM conversations""")
def lane_union(spark, d):
    found = records.lanes([(n, table(spark, d, n, ["text"])) for n in ("documents", "benchmark", "conversations")])
    return found.groupBy("lane", "lane_no").agg(F.count("*").alias("n"), F.countDistinct("text").alias("n_texts"))


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def distinct_in_list(spark, d):
    orders = table(spark, d, "orders", ["o_custkey", "o_orderstatus", "o_orderpriority"])
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_custkey", "o_orderstatus").distinct()


@query("""WITH s AS (SELECT source, CASE WHEN lang = 'en' THEN 'casual' ELSE lang END AS l FROM documents WHERE source IS NOT NULL), c AS (SELECT source, l, count(*) AS n FROM s WHERE l IS NOT NULL GROUP BY ALL),
    t AS (SELECT source, sum(n) AS total, sum(n) FILTER (l <> 'casual') AS others FROM c GROUP BY source), b AS (SELECT source, l, row_number() OVER (PARTITION BY source ORDER BY n DESC, l DESC) AS k FROM c WHERE l <> 'casual')
    SELECT t.source, CASE WHEN others >= 0.3 * total THEN b.l ELSE 'casual' END AS level, CAST(total AS BIGINT) AS total FROM t LEFT JOIN b ON b.source = t.source AND b.k = 1""")
def majority_level(spark, d):
    docs = table(spark, d, "documents", ["source", "lang"]).where("source is not null")
    return records.majority_level(docs.withColumn("l", F.when(F.col("lang") == "en", "casual").otherwise(F.col("lang"))), "source", "l", share=0.3)


@query("""SELECT conv_id, turn, CASE WHEN text = '' THEN 'empty' WHEN length(text) > 60 THEN 'exceeds_length' WHEN row_number() OVER (PARTITION BY role, text ORDER BY conv_id * 1000 + turn) > 1 THEN 'repeated' ELSE 'accepted' END AS state FROM conversations""")
def memory_lines(spark, d):
    c = table(spark, d, "conversations").withColumn("at", F.col("conv_id") * 1000 + F.col("turn"))
    return records.accepted_lines(c, ["role"], "text", "at", 60).select("conv_id", "turn", "state")


@query("""WITH s AS (SELECT o_orderkey AS story_no, CASE WHEN o_orderstatus = 'O' THEN 'main' WHEN o_orderstatus = 'F' THEN 'bond' ELSE 'side' END AS story_type, o_custkey % 5 AS act, CAST(o_custkey % 4 AS INTEGER) AS ending, CAST(o_custkey % 50 AS INTEGER) AS unlock FROM orders),
    v AS (SELECT l_orderkey AS story_no, list(CAST(l_linenumber AS BIGINT)) AS available FROM lineitem GROUP BY 1),
    m AS (SELECT c_custkey AS id, c_custkey % 5 AS owner, c_custkey % 3 = 0 AS is_variant, trim(substr(c_name || repeat('x', CAST(c_custkey % 20 AS INTEGER)), 1 + CAST(c_custkey % 7 AS INTEGER))) AS text, c_custkey * 2 AS story_no, CAST(coalesce(nullif(c_custkey % 45, 0), 1) AS INTEGER) AS level,
          CASE WHEN c_custkey % 2 = 0 THEN [CAST(c_custkey % 6 + 1 AS BIGINT)] ELSE CAST([] AS BIGINT[]) END AS keys FROM customer)
    SELECT id, greatest(level, coalesce(unlock, 1)) AS level, CASE WHEN length(text) NOT BETWEEN 1 AND 29 THEN 'length' WHEN level NOT BETWEEN 1 AND 40 THEN 'level' WHEN story_type IS NULL THEN 'no_story' WHEN story_type NOT IN ('main', 'bond') THEN 'story_type'
        WHEN NOT CASE WHEN story_type = 'main' THEN NOT is_variant ELSE act = owner END THEN 'owner' WHEN ending = 3 THEN 'ending'
        WHEN (story_type = 'main' OR len(keys) > 0) AND (len(keys) = 0 OR NOT list_has_all(coalesce(available, []), keys)) THEN 'evidence' END AS problem
    FROM m LEFT JOIN s USING (story_no) LEFT JOIN v USING (story_no)""")
def memory_validation(spark, d):
    orders, items, customer = table(spark, d, "orders"), table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"]), table(spark, d, "customer", ["c_custkey", "c_name"])
    kind = F.when(F.col("o_orderstatus") == "O", "main").when(F.col("o_orderstatus") == "F", "bond").otherwise("side")
    s = orders.select(F.col("o_orderkey").alias("story_no"), kind.alias("story_type"), (F.col("o_custkey") % 5).alias("act"), (F.col("o_custkey") % 4).cast("int").alias("ending"), (F.col("o_custkey") % 50).cast("int").alias("unlock"))
    v = items.groupBy(F.col("l_orderkey").alias("story_no")).agg(F.collect_set(F.col("l_linenumber").cast("long")).alias("available"))
    k = F.col("c_custkey")
    name = F.substring(F.concat("c_name", F.repeat(F.lit("x"), (k % 20).cast("int"))), (k % 7).cast("int") + 1, F.lit(1000))
    keys = F.when(k % 2 == 0, F.array(k % 6 + 1)).otherwise(F.array().cast("array<bigint>"))
    m = customer.select(k.alias("id"), (k % 5).alias("owner"), (k % 3 == 0).alias("is_variant"), name.alias("text"), (k * 2).alias("story_no"), F.nullif(k % 45, F.lit(0)).cast("int").alias("level"), keys.alias("line_keys"))
    return records.memory_problem(m, s.join(v, "story_no", "left"), ["bond"], "main", [3]).select("id", "level", "problem")


@query("""WITH r AS (SELECT conv_id * 1000 + turn AS k, conv_id, role, text FROM conversations), n AS (SELECT k, CASE WHEN k % 3 = 0 THEN k + 2 WHEN k % 3 = 1 THEN k + 999 END AS e, substr(text, 1, 5) AS ev FROM r),
    j AS (SELECT n.k, f.text, n.ev, f.k IS NULL OR f.conv_id <> o.conv_id OR f.role <> o.role AS far FROM n JOIN r o ON o.k = n.k LEFT JOIN r f ON f.k = coalesce(n.e, n.k))
    SELECT k AS record_key, CASE WHEN far THEN 'other_episode' WHEN NOT contains(text, ev) THEN 'not_in_source' END AS problem FROM j""")
def evidence_join(spark, d):
    c = table(spark, d, "conversations").withColumn("k", F.col("conv_id") * 1000 + F.col("turn"))
    r = c.select(F.col("k").alias("record_key"), F.lit("talk").alias("kind"), F.col("role").alias("table"), F.col("conv_id").alias("episode"), F.col("text").alias("speech"))
    key = F.when(F.col("k") % 3 == 0, F.col("k") + 2).when(F.col("k") % 3 == 1, F.col("k") + 999)
    notes = c.select(F.col("k").alias("record_key"), key.alias("evidence_key"), F.array(F.substring("text", 1, 5)).alias("evidence"))
    return records.evidence_problem(notes, r).select("record_key", "problem")


@query("""WITH t AS (SELECT * FROM (VALUES ('hello {name}', 'fr', 'bonjour'), ('hello {name}', 'de', 'hallo')) t(template, language, text))
    SELECT doc_id, CASE WHEN lang = 'en' THEN 'hello ' || doc_id ELSE t.text END AS line FROM documents LEFT JOIN t ON t.language = lang""")
def rendered_templates(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "lang"]).withColumn("template", F.lit("hello {name}"))
    fixed = spark.createDataFrame([("hello {name}", "fr", "bonjour"), ("hello {name}", "de", "hallo")], "template string, language string, text string")
    names, on, line = records.render_template(F.col("template"), F.col("lang"), fixed, {"name": F.col("doc_id").cast("string")}, "en")
    return docs.join(F.broadcast(names), on, "left").select("doc_id", line.alias("line"))


@query(f"""SELECT conv_id, turn, '{{"situation":' || {JSON_SQL.format("role")} || ',"' || CASE turn % 3 WHEN 0 THEN 'emotion' ELSE 'action' END || '":' || CAST(length(text) AS VARCHAR) || '}}' AS judgment FROM conversations WHERE turn % 3 < 2""")
def judgment_records(spark, d):
    c = table(spark, d, "conversations")
    made = records.judgment_record((F.col("turn") % 3).cast("string"), {"0": "emotion", "1": "action"}, F.length("text"), F.col("role"))
    return c.select("conv_id", "turn", made.alias("judgment")).where("judgment is not null")


@query("""SELECT a.n_name AS owner, 'about' AS direction, b.n_name AS other, a.n_name || '>' || b.n_name AS text FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey * 7) % 25
    UNION ALL SELECT b.n_name, 'by', a.n_name, a.n_name || '>' || b.n_name FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey * 7) % 25""")
def comments_both_ways(spark, d):
    n = table(spark, d, "nation", ["n_nationkey", "n_name"])
    names = n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    far = names.select(F.col("id").alias("by"), F.col("name").alias("by_name"))
    c = n.withColumn("by", (F.col("n_nationkey") * 7 % 25).cast("int")).join(F.broadcast(far), "by").select(F.col("n_nationkey").alias("about"), "by", F.concat("n_name", F.lit(">"), "by_name").alias("text"))
    out = records.both_ways(c, names, "about", "by", "text")
    return out.join(F.broadcast(names), F.col("owner") == F.col("id")).select(F.col("name").alias("owner"), "direction", "other", "text")


@query("""WITH c AS (SELECT conv_id, turn, length(text) % 9 + 1 AS n, turn % 4 AS p FROM conversations)
    SELECT conv_id, turn, CAST(greatest(n, 8) AS BIGINT) AS width, CAST(n AS BIGINT) AS attended, CAST(greatest(n - p, 0) AS BIGINT) AS n_targets, CASE WHEN n > p THEN 1.0::DOUBLE / (n - p) END AS weight FROM c""")
def collated_batch(spark, d):
    n, p = (F.length("text") % 9 + 1).cast("int"), (F.col("turn") % 4).cast("int")
    c = table(spark, d, "conversations").select("conv_id", "turn", records.collated(F.sequence(F.lit(1), n), p, F.lit(8)).alias("b"))
    return c.select("conv_id", "turn", F.size("b.ids").cast("long").alias("width"), F.aggregate("b.mask", F.lit(0), lambda a, x: a + x).cast("long").alias("attended"), F.size("b.targets").cast("long").alias("n_targets"), "b.weight")


@query(r"""WITH c AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN replace(text, ' th', ' @th@') WHEN 1 THEN replace(text, ' of', ' as a language model') ELSE text END AS t FROM conversations)
    SELECT conv_id, turn FROM c WHERE regexp_matches(t, '@[^@\s]{1,20}@') OR regexp_matches(t, 'assistant|language model')""")
def self_references(spark, d):
    """Turns with a masked name or a mention of the speaker; words of the texts are made to be either."""
    t = F.when(F.col("turn") % 3 == 0, F.replace("text", F.lit(" th"), F.lit(" @th@"))).when(F.col("turn") % 3 == 1, F.replace("text", F.lit(" of"), F.lit(" as a language model"))).otherwise(F.col("text"))
    return table(spark, d, "conversations").withColumn("text", t).where(records.mentions_itself(F.col("text"), "assistant|language model")).select("conv_id", "turn")


@query(r"""WITH j AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id)
    SELECT conv_id, CASE WHEN regexp_matches(t, '(^|[^a-z])secret') THEN 'excluded' WHEN regexp_matches(t, 'license') THEN 'review' ELSE 'accepted' END AS state FROM j""")
def dialogue_gate(spark, d):
    """Ordered patterns over all segments of a dialogue, joined in their order."""
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    joined = F.array_join(F.transform("t", lambda x: x["text"]), "\n")
    return rows.select("conv_id", classify.decide([("excluded", joined.rlike("(^|[^a-z])secret")), ("review", joined.rlike("license"))], "accepted").alias("state"))
