"""Queries of conversion, lessons, memories and prompt binding, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import conversion, lessons
from weftline.operators.conversion import Style
from weftline.plans.catalog import query
from weftline.sources.tables import table

#: A turn is speech, an action and speech again; what they hold decides what may be learned.
CONVERSION_SQL = """c AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, substr(text, 1, 40) AS a, substr(text, 41, 20) AS b, substr(text, 61) AS c, CASE WHEN conv_id % 10 = 3 THEN 'review' END AS gate FROM conversations),
    p AS (SELECT *, trim(replace(a, '.', '')) AS pa, trim(replace(b, '.', '')) AS pb, trim(replace(c, '.', '')) AS pc, contains(a, 'oun') OR contains(b, 'oun') OR contains(c, 'oun') AS far,
        contains(a, 'oun') OR contains(a, 'Q') OR contains(a, 'wer') AS xa, contains(b, 'oun') OR contains(b, 'Q') AS xb, contains(c, 'oun') OR contains(c, 'Q') OR contains(c, 'wer') AS xc FROM c),
    q AS (SELECT *, role <> 'user' AND NOT xa AS ka, role <> 'user' AND NOT xa AND NOT xb AND NOT xc AS kc FROM p),
    t AS (SELECT *, CASE WHEN ka THEN translate(a, 'aeiou', 'AEIOU') ELSE pa END AS ta, CASE WHEN kc THEN translate(c, 'aeiou', 'AEIOU') ELSE pc END AS tc FROM q),
    u AS (SELECT conv_id, turn, role, gate, far, kc, a, b, c, concat_ws(' ', nullif(ta, ''), CASE WHEN pb <> '' THEN '*' || pb || '*' END, nullif(tc, '')) AS content FROM t),
    v AS (SELECT *, role = 'user' AND (far OR content = '') AS breaks FROM u WHERE gate IS NULL),
    w AS (SELECT *, bool_or(breaks) OVER (PARTITION BY conv_id ORDER BY turn) AS cut, count(*) FILTER (breaks) OVER (PARTITION BY conv_id ORDER BY turn) AS n_breaks, count(*) FILTER (role <> 'user') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS later FROM v),
    s AS (SELECT * FROM (SELECT *, max(turn) FILTER (role <> 'user') OVER (PARTITION BY conv_id) AS last FROM w WHERE NOT cut AND content <> '') WHERE turn <= last),
    o AS (SELECT conv_id, turn, role, content, kc FROM s UNION ALL SELECT conv_id, -1, 'user', 'good day', false FROM s QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AND role <> 'user'),
    h AS (SELECT *, coalesce(list(role || ': ' || content) OVER k, []) AS past FROM o WINDOW k AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))"""


def converted(spark, d):
    c = table(spark, d, "conversations").withColumn("role", F.when(F.col("role") == "user", "user").otherwise("assistant"))
    part = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    c = c.withColumn("segments", F.array(part("speech", F.substring("text", 1, 40)), part("action", F.substring("text", 41, 20)), part("speech", F.substring("text", F.lit(61), F.length("text")))))
    style = Style(lambda t: t.contains("oun"), lambda t: t.contains("Q"), lambda t: F.when(~t.contains("wer"), F.translate(t, "aeiou", "AEIOU")), lambda t: F.trim(F.replace(t, F.lit("."), F.lit(""))), lambda k, t: F.when(k == "action", F.concat(F.lit("*"), t, F.lit("*"))).otherwise(t))
    return conversion.records_of(c, style, F.when(F.col("conv_id") % 10 == 3, "review"), F.lit("good day"), F.lit("who"), limit=4)


@query(f"""WITH {CONVERSION_SQL} SELECT conv_id, turn, array_to_string(list_prepend('system: who', CASE WHEN past[1] LIKE 'assistant: %' THEN past[2:] ELSE past END), chr(10)) AS prompt, content AS answer FROM h WHERE role <> 'user' AND kc""")
def external_conversion(spark, d):
    """Records of the answers that may be learned, with up to four turns before each."""
    r = converted(spark, d)[0]
    return r.select("conv_id", "turn", F.array_join(F.transform("prompt", lambda m: F.concat_ws(": ", m["role"], m["content"])), "\n").alias("prompt"), F.col("completion")[0]["content"].alias("answer"))


@query(f"""WITH {CONVERSION_SQL}, g AS (SELECT conv_id, min(gate) AS detail, arg_min(a || ' ' || b || ' ' || c, turn) AS text FROM u WHERE gate IS NOT NULL GROUP BY conv_id)
    SELECT conv_id, NULL AS turn, 'content_classification' AS reason, detail, substr(text, 1, 80) AS preview FROM g
    UNION ALL SELECT conv_id, turn, 'context_break', CASE WHEN far THEN 'real_world' ELSE 'empty' END || ':' || later, substr(a || ' ' || b || ' ' || c, 1, 80) FROM w WHERE breaks AND n_breaks = 1
    UNION ALL SELECT conv_id, turn, 'unconverted_speech', 'speech_style', substr(content, 1, 80) FROM w WHERE NOT cut AND content <> '' AND role <> 'user' AND NOT kc""")
def conversion_exclusions(spark, d):
    """What was left out, and why."""
    return converted(spark, d)[1]


@query("""WITH a AS (SELECT c_custkey AS owner, 'topic' || (c_custkey % 4) AS topic, c_name AS name, c_mktsegment || ' of ' || c_name AS text FROM customer UNION ALL SELECT c_custkey, 'home', c_name, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT owner, topic, CASE WHEN topic = 'home' THEN 'system: I am ' || name || chr(10) || 'user: where?' ELSE 'system: I am ' || name || chr(10) || 'user: hello ' || name || chr(10) || 'assistant: from ' || (SELECT n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey = owner) || chr(10) || 'user: what ' || topic || '?' END AS prompt, text AS answer, 'fact of ' || topic AS fact FROM a""")
def authored_topics(spark, d):
    """Each customer's answers to two topics, the turns ahead filled with the name and another answer."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    owners = c.select(F.col("c_custkey").alias("owner"), F.col("c_name").alias("name"))
    topic = F.concat(F.lit("topic"), (F.col("c_custkey") % 4).cast("string"))
    home = c.join(F.broadcast(n), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("owner"), F.lit("home").alias("topic"), F.col("n_name").alias("text"))
    answers = c.select(F.col("c_custkey").alias("owner"), topic.alias("topic"), F.concat("c_mktsegment", F.lit(" of {name}")).alias("text")).unionByName(home)
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), F.lit(text).alias("content"))
    asked = answers.select("topic").distinct().withColumn("question", F.when(F.col("topic") == "home", "where?").otherwise(F.concat(F.lit("what "), "topic", F.lit("?"))))
    asked = asked.withColumns({"history": F.when(F.col("topic") != "home", F.array(turn("user", "hello {name}"), turn("assistant", "from {home}"))), "fact": F.concat(F.lit("fact of "), "topic")})
    out = lessons.topic_lessons(answers, asked, owners, F.concat(F.lit("I am "), F.col("name")))
    return out.select("owner", "topic", F.array_join(F.transform("prompt", lambda m: F.concat_ws(": ", m["role"], m["content"])), "\n").alias("prompt"), F.col("completion")[0]["content"].alias("answer"), "fact")


@query("""WITH c AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
    b AS (SELECT conv_id, CASE WHEN any_value(n) < 2 OR any_value(n) % 2 = 1 THEN 'odd_turns' WHEN bool_or(role <> CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END) THEN 'roles' WHEN bool_or(trim(text, ' ') = '') THEN 'blank' END AS problem FROM c GROUP BY conv_id)
    SELECT c.conv_id, CAST(i // 2 AS BIGINT) AS part, sum(length(text)) OVER (PARTITION BY c.conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prompt_chars, text AS answer, problem FROM c JOIN b ON b.conv_id = c.conv_id WHERE problem IS NULL QUALIFY i % 2 = 1
    UNION ALL SELECT conv_id, NULL, NULL, NULL, problem FROM b WHERE problem IS NOT NULL""")
def authored_conversations(spark, d):
    """Lessons of the conversations that are well formed, and what is wrong with the others."""
    c = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("t"))
    c = c.select((F.col("id") % 25).cast("int").alias("owner"), "id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("turns"))
    owners = table(spark, d, "nation").select(F.col("n_nationkey").alias("owner"), F.col("n_name").alias("name"))
    found, problems = lessons.conversation_lessons(c, owners, F.lit(""))
    chars = F.aggregate("prompt", F.lit(0).cast("long"), lambda s, m: s + F.length(m["content"]))
    out = found.select(F.col("id").alias("conv_id"), F.col("part").cast("long").alias("part"), chars.alias("prompt_chars"), F.col("completion")[0]["content"].alias("answer"), F.lit(None).cast("string").alias("problem"))
    none = F.lit(None).cast("long")
    return out.unionByName(problems.select(F.col("id").alias("conv_id"), none.alias("part"), none.alias("prompt_chars"), F.lit(None).cast("string").alias("answer"), "problem"))


@query("""SELECT o_orderkey AS no, 'self_memory:' || lpad(CAST(o_orderkey AS VARCHAR), greatest(5, 5), '0')[1:5] AS id, concat_ws(chr(10), CASE WHEN o_orderpriority <> '1-URGENT' THEN '1-URGENT' END, CASE WHEN o_orderpriority <> '2-HIGH' THEN '2-HIGH' END, 'level ' || o_custkey % 40) AS system, 'what then?' AS cue, o_orderpriority AS answer,
    CASE WHEN o_custkey % 3 = 0 THEN 'StoryInfo:' || o_custkey ELSE 'memory:' || o_orderstatus || ',memory:' || o_custkey END AS events FROM orders""")
def self_memories(spark, d):
    """A record a memory: core lines without the memory itself, the line of its level, and its events."""
    o = table(spark, d, "orders").select(F.col("o_custkey"), F.col("o_orderkey").alias("no"), F.col("o_orderpriority").alias("text"), F.lit("what then?").alias("cue"), F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("story_no"), F.array(F.col("o_orderstatus"), F.col("o_custkey").cast("string")).alias("evidence"))
    made = lessons.memory_records(o, F.array(F.lit("1-URGENT"), F.lit("2-HIGH"), F.lit("1-URGENT")), F.concat(F.lit("level "), (F.col("o_custkey") % 40).cast("string")))
    return made.select("no", "id", F.col("prompt")[0]["content"].alias("system"), F.col("prompt")[1]["content"].alias("cue"), F.col("completion")[0]["content"].alias("answer"), F.array_join("event_keys", ",").alias("events"))


@query("""SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 THEN 'system: Context: general' || chr(10) || CASE WHEN role = 'system' THEN '' ELSE '|' || role || ': ' || text END || '|user: and?' WHEN turn % 3 = 0 AND role <> 'system' THEN NULL WHEN turn % 3 = 0 THEN 'system: SpiritId: s' || conv_id % 4 || chr(10) || '|user: and?' WHEN turn % 3 = 1 AND conv_id % 5 = 0 THEN NULL
    ELSE 'system: SpiritId: s' || conv_id % 4 || chr(10) || '|' || role || ': ' || text || '|user: and?' END AS prompt FROM conversations""")
def bound_prompts(spark, d):
    """Prompts bound to an owner or to the general context; null where they lack a system message or name another owner."""
    c = table(spark, d, "conversations")
    one = lambda role, text: F.struct(role.alias("role"), text.alias("content"))
    system = F.when((F.col("turn") % 3 == 1) & (F.col("conv_id") % 5 == 0), "SpiritId: other\n").otherwise("identity")
    rest = F.array(one(F.col("role"), F.col("text")), one(F.lit("user"), F.lit("and?")))
    messages = F.when(F.col("turn") % 3 == 0, rest).otherwise(F.concat(F.array(one(F.lit("system"), system)), rest))
    owner = F.when(F.col("conv_id") % 4 != 0, F.concat(F.lit("s"), (F.col("conv_id") % 4).cast("string")))
    bound = lessons.bound_prompt(messages, owner)
    return c.select("conv_id", "turn", F.array_join(F.transform(bound, lambda m: F.concat_ws(": ", m["role"], m["content"])), "|").alias("prompt"))
