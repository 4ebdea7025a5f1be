"""Queries of text functions, record parts, readers and writers over whole tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import hashing, text
from weftline.operators import classify, derive, evaluate
from weftline.plans.catalog import query
from weftline.plans.shared import new_path
from weftline.sources import sinks, tables
from weftline.sources.tables import table

#: Quotes and stage directions are made of marks that the texts have.
MARKED_SQL = r"""m AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN doc_id % 3 = 0 THEN '"' || substr(coalesce(text, ''), 1, 30) || '"' ELSE substr(coalesce(text, ''), 1, 30) END AS q, translate(coalesce(text, ''), '.,', '*"') AS r FROM documents)"""


@query(rf"""WITH {MARKED_SQL} SELECT doc_id, length(q) >= 2 AND left(q, 1) = '"' AND right(q, 1) = '"' AS quoted,
        CASE WHEN length(q) >= 2 AND left(q, 1) = '"' AND right(q, 1) = '"' THEN regexp_replace(substr(q, 2, length(q) - 2), '^\s+|\s+$', '', 'g') ELSE q END AS bare,
        sha256(regexp_replace(regexp_replace(t, '([^\x00-\x7F])\s+([^\x00-\x7F])', '\1\2', 'g'), '([^\x00-\x7F])\s+([^\x00-\x7F])', '\1\2', 'g')) AS joined,
        sha256(trim(regexp_replace(regexp_replace(replace(regexp_replace(r, '\*[^*]*\*', ' ', 'g'), '"', ' '), '[ㅋㅎㅠㅜ^]{{2,}}', '', 'g'), '\s+', ' ', 'g'))) AS spoken FROM m""")
def quotes_and_stage_directions(spark, d):
    """Quotes taken off, spaces between letters that are not ASCII, stage directions and emoticons."""
    t = F.coalesce("text", F.lit(""))
    head = F.substring(t, 1, 30)
    docs = table(spark, d, "documents", ["doc_id", "text"]).select("doc_id", t.alias("t"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('"'), head, F.lit('"'))).otherwise(head).alias("q"), F.translate(t, ".,", '*"').alias("r"))
    return docs.select("doc_id", text.is_quoted(F.col("q")).alias("quoted"), text.unquote(F.col("q")).alias("bare"), F.sha2(text.join_cjk(F.col("t")), 256).alias("joined"), F.sha2(text.clean_roleplay(F.col("r")), 256).alias("spoken"))


@query(r"""WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents)
    SELECT w, w IN ('and', 'the') OR w LIKE 'ing%' AS placeholder, CASE WHEN w LIKE '%ation' AND length(w) >= 7 THEN w[:-6] WHEN w LIKE '%ing' AND length(w) >= 5 THEN w[:-4] WHEN w LIKE '%s' AND length(w) >= 3 THEN w[:-2] ELSE w END AS stem,
        replace(replace(replace(w, 'th', 'd'), 'ng', 'n'), 'nn', 'n') AS corrected FROM w WHERE w <> ''""")
def word_forms(spark, d):
    """Every distinct word: placeholders, stems by the first suffix that fits, an ordered fold of corrections."""
    w = table(spark, d, "documents", ["text"]).select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).where("w <> ''").distinct()
    marked = text.is_placeholder(F.col("w"), ("and", "the"), ()) | F.col("w").startswith("ing")
    return w.select("w", marked.alias("placeholder"), text.word_stem(F.col("w"), ["ation", "ing", "s"]).alias("stem"), text.corrected(F.col("w"), [("d", ["th"]), ("n", ["ng", "nn"])]).alias("corrected"))


@query(r"""WITH m AS (SELECT doc_id, '{s} {s}{s} ' || lang || ' {t}{s}' AS slots, coalesce(text, '') || chr(10) || 'mark' || chr(10) || chr(10) || ' after ' || doc_id || chr(10) || 'rest' AS doc, 'Doc ' || doc_id || ' (' || source || ')' AS name, text FROM documents)
    SELECT doc_id, '{s} ' || lang || ' {t}{s}' AS slots, 'after ' || doc_id AS section, 'Doc ' || doc_id AS called, CASE WHEN contains(lower(text), 'license') THEN 'LICENSE' WHEN contains(lower(text), 'secret') THEN 'secret' END AS hit FROM m JOIN documents USING (doc_id, text)""")
def slots_sections_and_hits(spark, d):
    """Slots that repeat, the line after a marker, names without their brackets, the first forbidden text."""
    docs = table(spark, d, "documents", ["doc_id", "text", "lang", "source"])
    slots = F.concat(F.lit("{s} {s}{s} "), F.col("lang"), F.lit(" {t}{s}"))
    doc = F.concat(F.lit("mark\n\n after "), F.col("doc_id").cast("string"), F.lit("\nrest"))
    name = F.concat(F.lit("Doc "), F.col("doc_id").cast("string"), F.lit(" ("), F.col("source"), F.lit(")"))
    whole = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), doc)
    return docs.select("doc_id", text.collapse_slots(slots).alias("slots"), text.section_after(whole, "mark").alias("section"), text.call_name(name).alias("called"), evaluate.first_hit(F.col("text"), ["LICENSE", "secret"]).alias("hit"))


@query("""SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 'assistant' WHEN 'user' THEN 'user' ELSE 'other' END AS speaks, '{"role":"' || role || '","n":' || length(text) || '}' AS behaviour, sha256('[' || turn || ',[' || turn || ',' || (turn + length(text) % 5) || ']]') AS fingerprint,
    role || '|' || text[:3] || '|level ' || turn AS memory, CASE role WHEN 'user' THEN '(' || text[:9] || ')' WHEN 'system' THEN 'gift: ' || text[:9] ELSE role || ': ' || text[:9] END AS context,
    CASE WHEN turn % 4 = 0 THEN 'PASS' WHEN turn % 4 < 3 THEN 'FAIL' ELSE 'NEEDS_REVIEW' END AS verdict FROM conversations WHERE text[:3] NOT IN (role, 'core')""")
def record_parts(spark, d):
    """Roles, behaviour labels, fingerprints, memory lines, context items and verdicts of number answers, one row a turn."""
    c = table(spark, d, "conversations").where(~F.substring("text", 1, 3).isin("core") & (F.substring("text", 1, 3) != F.col("role")))
    kind = F.when(F.col("role") == "user", "narration").when(F.col("role") == "system", "gift").otherwise("speech")
    memory = derive.composed_memory(F.array("role", F.lit("core"), F.substring("text", 1, 3), "role"), F.lit("core"), F.concat(F.lit("level "), F.col("turn").cast("string")))
    # An answer of 2, in figures or words, of 3 or 7, or of no number at all.
    answer = F.when(F.col("turn") % 4 == 0, F.when(F.col("conv_id") % 2 == 0, " 2 개.").otherwise("두 개!")).when(F.col("turn") % 4 == 1, "3").when(F.col("turn") % 4 == 2, "7개").otherwise("maybe 2")
    score = evaluate.objective_score(evaluate.number_answer(answer, ["개"], {"두개": 2, "둘": 2}), 2)
    return c.select(
        "conv_id", "turn", classify.speaker_role(F.col("role"), "assistant", ["user"]).alias("speaks"), derive.behaviour_label(role=F.col("role"), n=F.length("text")).alias("behaviour"),
        hashing.fingerprint(F.col("turn"), F.array("turn", F.col("turn") + F.length("text") % 5)).alias("fingerprint"), F.array_join(memory, "|").alias("memory"), derive.context_item(kind, F.col("role"), F.substring("text", 1, 9)).alias("context"), F.coalesce(evaluate.verdict(score), F.lit("NEEDS_REVIEW")).alias("verdict"),
    )


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_lines_round_trip(spark, d):
    """Turns written as JSON lines and read back with a declared schema; lines that do not parse would be a side output."""
    path = new_path(spark, "jsonl")
    sinks.json_lines(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), path)
    rows, bad = tables.json_lines(spark, path, "conv_id long, turn long, role string, text string")
    return rows.unionByName(bad.select(F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("bad").alias("role"), F.col("line").alias("text")))


@query("""WITH a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) AS f FROM conversations)
    SELECT sha256(to_json(list(text ORDER BY turn))) AS line_key, count(*) AS turns, sum(length(text)) AS chars, 'fine' AS state FROM a GROUP BY conv_id
    UNION ALL SELECT '', 0, length('not an array ' || n_name), 'bad' FROM nation""")
def array_lines_round_trip(spark, d):
    """Conversations written as gzip lines that are bare arrays, with some lines that are none, and read back."""
    path = new_path(spark, "arrays")
    rows = tables.conversations_as_arrays(table(spark, d, "conversations"))
    broken = table(spark, d, "nation").select(F.concat(F.lit("not an array "), "n_name").alias("value"))
    rows.select(F.to_json("turns").alias("value")).unionByName(broken).write.option("compression", "gzip").text(path)
    good, bad = tables.array_lines(spark, path)
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda s, x: s + F.length(x))
    out = good.select("line_key", F.size("turns").cast("long").alias("turns"), chars.alias("chars"), F.lit("fine").alias("state"))
    return out.unionByName(bad.select(F.lit("").alias("line_key"), F.lit(0).cast("long").alias("turns"), F.length("line").cast("long").alias("chars"), F.lit("bad").alias("state")))


@query("""WITH f AS (SELECT conv_id, first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) AS f, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, text FROM conversations)
    SELECT conv_id, CAST(turn AS BIGINT) AS turn, CASE WHEN (f = 'user') = (turn % 2 = 0) THEN 'user' ELSE 'assistant' END AS role, text FROM f WHERE f IN ('user', 'assistant')""")
def alternating_roles(spark, d):
    """Conversations as arrays of turns with their first role, and back to rows whose roles alternate."""
    rows = tables.conversations_as_arrays(table(spark, d, "conversations")).where(F.col("first_role").isin("user", "assistant"))
    return tables.exploded_turns(rows).withColumn("turn", F.col("turn").cast("long"))


@query("SELECT n_name AS key, string_split(r_name, ' ')[1] AS value FROM nation JOIN region ON r_regionkey = n_regionkey")
def dictionary_round_trip(spark, d):
    """A tab-separated dictionary of nations, with comments, blank lines and second lines of a key, read back."""
    path = new_path(spark, "dictionary")
    n = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    lines = F.array(F.concat(F.lit("# "), "n_name"), F.lit(""), F.concat("n_name", F.lit("\t"), "r_name", F.lit(" second")), F.concat("n_name", F.lit("\tlater")))
    n.select(F.explode(lines).alias("value")).write.text(path)
    return tables.dictionary(spark, path)


@query("""SELECT source AS owner, lang AS split, count(*) AS n, sum(length(text)) AS chars FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY ALL""")
def split_fan_out(spark, d):
    """Documents written to a folder for each source and language, and counted from the folders."""
    path = new_path(spark, "fanout")
    docs = table(spark, d, "documents", ["doc_id", "source", "lang", "text"]).where("source is not null and lang is not null")
    sinks.fan_out(docs.withColumnsRenamed({"source": "owner", "lang": "split"}), path)
    back = spark.read.schema("doc_id long, text string, owner string, split string").json(path)
    return back.groupBy("owner", "split").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL")
def corpus_writer_counts(spark, d):
    """Counts of what the corpus writer has written, read back through its JSON report."""
    path, told = new_path(spark, "corpus"), new_path(spark, "report")
    sinks.report(sinks.corpus(table(spark, d, "documents"), path, ["source", "lang"]), told)
    return spark.read.schema("source string, lang string, n long").json(told)
