"""Queries of lanes and annotations, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import annotate, lanes
from weftline.operators.lanes import Lane, Lookup
from weftline.plans.catalog import query
from weftline.sources.tables import table

_MISSES = "concat_ws(',', {0})"
LANES_SQL = """g AS (SELECT doc_id, quality, toxic, CASE WHEN toxic = 1 THEN 'toxic' END AS why FROM labels),
    q AS (SELECT doc_id, arg_min(quality, (why IS NOT NULL, quality)) AS quality, min(why) FILTER (why IS NOT NULL) AS why, bool_and(why IS NOT NULL) AS unusable FROM g GROUP BY doc_id),
    d AS (SELECT 'documents' AS lane, CAST(d.doc_id AS VARCHAR) AS record_id, CASE WHEN coalesce(d.text, '') = '' THEN 'empty_text' WHEN d.n_chars > 20000 THEN 'too_long' END AS reason,
                 CASE WHEN q.doc_id IS NULL THEN 'no_row' WHEN q.unusable THEN q.why END AS m1, 'quality ' || q.quality AS v1, CASE WHEN d.lang = 'en' THEN NULL WHEN d.lang IS NULL THEN 'no_key' ELSE 'no_row' END AS m2, 'in English' AS v2, NULL AS def FROM documents d LEFT JOIN q ON q.doc_id = d.doc_id),
    c AS (SELECT 'turns' AS lane, conv_id || ':' || turn AS record_id, CASE WHEN coalesce(text, '') = '' THEN 'empty_text' WHEN role = 'system' THEN 'feature_guide' END AS reason,
                 CASE WHEN conv_id % 3 = 0 THEN 'no_key' WHEN n_name IS NULL THEN 'no_row' END AS m1, 'from ' || n_name AS v1, CASE WHEN quality IS NULL THEN 'no_row' WHEN q.unusable THEN q.why END AS m2, 'quality ' || quality AS v2, CASE WHEN turn < 4 THEN 'opening' END AS def
          FROM conversations LEFT JOIN nation ON n_nationkey = conv_id AND conv_id % 3 <> 0 LEFT JOIN q ON q.doc_id = conv_id),
    r AS (SELECT * FROM d UNION ALL SELECT * FROM c),
    f AS (SELECT lane, record_id, CASE WHEN reason IS NULL THEN CASE WHEN m1 IS NULL THEN v1 WHEN m2 IS NULL THEN v2 ELSE def END END AS situation, coalesce(reason, CASE WHEN m1 IS NOT NULL AND m2 IS NOT NULL AND def IS NULL THEN 'unverified_trigger' END) AS reason,
                 CASE WHEN reason IS NULL THEN concat_ws(',', m1, CASE WHEN m1 IS NOT NULL THEN m2 END) ELSE '' END AS misses FROM r)"""


def read(spark, d):
    docs, turns = table(spark, d, "documents", ["doc_id", "lang", "text", "n_chars"]), table(spark, d, "conversations")
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("key"), F.col("quality").alias("value"), F.when(F.col("toxic") == 1, "toxic").alias("reason"))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"))
    english = docs.where("lang = 'en'").select(F.col("lang").alias("key"), F.lit("in English").alias("value")).distinct()
    empty = F.coalesce("text", F.lit("")) == ""
    return lanes.read_lanes(
        [
            Lane("documents", docs, F.col("doc_id"), F.col("text"), [("empty_text", empty), ("too_long", F.col("n_chars") > 20000)], [Lookup("labels", F.col("doc_id"), "quality {value}"), Lookup("languages", F.col("lang"))]),
            Lane(
                "turns", turns, F.concat_ws(":", "conv_id", "turn"), F.col("text"), [("empty_text", empty), ("feature_guide", F.col("role") == "system")],
                [Lookup("nations", F.when(F.col("conv_id") % 3 != 0, F.col("conv_id")), "from {value}"), Lookup("labels", F.col("conv_id"), "quality {value}")], F.when(F.col("turn") < 4, "opening"),
            ),
        ],
        {"labels": labels, "nations": nations, "languages": english},
    )


@query(f"WITH {LANES_SQL} SELECT lane, record_id, situation, reason, misses FROM f")
def situation_lanes(spark, d):
    """Every record of two lanes with its situation or the reason of its skip, and why lookups missed."""
    return read(spark, d).select("lane", "record_id", "situation", "reason", F.array_join(F.transform("misses", lambda m: m["reason"]), ",").alias("misses"))


@query(f"WITH {LANES_SQL} SELECT lane, coalesce(reason, 'accepted') AS state, count(*) AS n FROM f GROUP BY ALL")
def lane_skips(spark, d):
    """Accepted and skipped rows by reason: together the input."""
    return read(spark, d).groupBy("lane", F.coalesce("reason", F.lit("accepted")).alias("state")).agg(F.count("*").alias("n"))


NOTES_SQL = """r AS (SELECT conv_id * 1000 + turn AS k, conv_id AS episode, role, text, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') || chr(10) || text AS context FROM conversations),
    n AS (SELECT k, CASE WHEN k % 7 = 0 THEN 'non_self_speech' ELSE 'judgment' END AS kind, substr(text, 1, 6) AS ev, CASE WHEN k % 14 = 0 THEN k + 1 END AS far, CASE WHEN k % 11 = 0 THEN '' ELSE 'go' END AS decision, CASE WHEN k % 13 = 0 THEN 'unheard of' ELSE substr(text, 1, 4) END AS shown,
                 CASE WHEN k % 17 = 0 THEN 'other' ELSE role END AS memory FROM r WHERE k % 7 = 0 OR k % 3 = 0 UNION ALL SELECT k + 500000000, 'judgment', '', NULL, 'go', '', '' FROM r WHERE k % 97 = 0 UNION ALL SELECT k, 'judgment', '', NULL, 'go', '', '' FROM r WHERE k % 21 = 0),
    m AS (SELECT n.*, count(*) OVER (PARTITION BY n.k) AS times, o.k IS NULL AS lost, f.k IS NULL OR f.episode <> o.episode OR f.role <> o.role AS apart, contains(f.text, ev) AS held, contains(o.context, shown) AS stands, memory = o.role AS known FROM n LEFT JOIN r o ON o.k = n.k LEFT JOIN r f ON f.k = coalesce(far, n.k)),
    p AS (SELECT k, kind, CASE WHEN times > 1 THEN 'repeated' WHEN lost THEN 'no_record' WHEN kind = 'non_self_speech' THEN CASE WHEN apart THEN 'other_episode' WHEN NOT held THEN 'not_in_source' END
                 WHEN decision = '' THEN 'incomplete' WHEN NOT stands THEN 'not_in_context' WHEN NOT known THEN 'unknown_memory' END AS problem FROM m)"""


def annotated(spark, d):
    from pyspark.sql import Window

    c = table(spark, d, "conversations").withColumn("record_key", F.col("conv_id") * 1000 + F.col("turn"))
    before = F.coalesce(F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(""))
    rows = c.select("record_key", F.lit("talk").alias("kind"), F.col("role").alias("table"), F.col("conv_id").alias("episode"), F.col("text").alias("speech"), F.concat(before, F.lit("\n"), "text").alias("context"), F.array("role").alias("memory"))
    k = F.col("record_key")

    def note(df, kind, evidence, far, decision, shown, memory):
        made = F.struct(F.array(memory).alias("activated_memory"), F.lit("i").alias("interpretation"), decision.alias("decision"), F.lit("e").alias("emotion"), F.lit("n").alias("intention"), F.lit("a").alias("action"), F.array(shown).alias("evidence"))
        return df.select("record_key", kind.alias("annotation_kind"), F.lit("quoted").alias("reason"), F.array(evidence).alias("evidence"), far.cast("long").alias("evidence_key"), made.alias("judgment"))

    none, go = F.lit(None), F.lit("go")
    notes = note(c.where((k % 7 == 0) | (k % 3 == 0)), F.when(k % 7 == 0, annotate.EXCLUDES).otherwise("judgment"), F.substring("text", 1, 6), F.when(k % 14 == 0, k + 1), F.when(k % 11 == 0, "").otherwise("go"), F.when(k % 13 == 0, "unheard of").otherwise(F.substring("text", 1, 4)), F.when(k % 17 == 0, "other").otherwise(F.col("role")))
    notes = notes.unionByName(note(c.where(k % 97 == 0).withColumn("record_key", k + 500000000), F.lit("judgment"), F.lit(""), none, go, F.lit(""), F.lit("")))
    return annotate.apply_annotations(rows, notes.unionByName(note(c.where(k % 21 == 0), F.lit("judgment"), F.lit(""), none, go, F.lit(""), F.lit(""))))


@query(f"""WITH {NOTES_SQL}, b AS (SELECT r.k, max(p.kind) FILTER (problem IS NULL) AS kind FROM r LEFT JOIN p ON p.k = r.k GROUP BY r.k)
    SELECT k AS record_key, CASE WHEN kind = 'non_self_speech' THEN 'excluded' WHEN kind IS NULL THEN 'plain' ELSE 'judged' END AS state FROM b""")
def applied_annotations(spark, d):
    """Every record: judged by its note, excluded by it, or without one that stands."""
    kept, excluded, _ = annotated(spark, d)
    return kept.select("record_key", F.when(F.col("judgment").isNull(), "plain").otherwise("judged").alias("state")).unionByName(excluded.select("record_key", F.lit("excluded").alias("state")))


@query(f"WITH {NOTES_SQL} SELECT k AS record_key, problem FROM p WHERE problem IS NOT NULL")
def annotation_problems(spark, d):
    """Notes that cannot stand, each with its first problem."""
    return annotated(spark, d)[2]
