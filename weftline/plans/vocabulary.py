"""Queries of address forms, slots, common turns and registers, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import vocabulary
from weftline.plans.catalog import query
from weftline.plans.shared import materialize
from weftline.sources.tables import table

FORM = r"(?<![a-z])([a-z]{1,12})(ing|er|s)(?![a-z])"
FOLLOW = r"\s*(?:[,.!?]|$)"
WORD_FORM = "'^([a-z]{1,12})(ing|er|s)$'"
STATISTICS_SQL = rf"""u AS (SELECT unnest(regexp_extract_all(lower(text) || '!', '[a-z]+(?:\s*[,.!?])?')) AS t FROM conversations), x AS (SELECT regexp_extract(t, '^[a-z]+') AS form, t <> regexp_extract(t, '^[a-z]+') AS called FROM u),
    f AS (SELECT regexp_extract(form, {WORD_FORM}, 1) AS base, regexp_extract(form, {WORD_FORM}, 2) AS suffix, count(*) AS uses, count(*) FILTER (called) AS vocative_uses FROM x WHERE regexp_matches(form, {WORD_FORM}) GROUP BY form)"""


def statistics(spark, d):
    lines = table(spark, d, "conversations", ["text"]).select(F.lower("text").alias("text"))
    return vocabulary.address_statistics(lines, "text", FORM, FOLLOW)


@query(f"WITH {STATISTICS_SQL} SELECT base, suffix, uses, vocative_uses FROM f")
def address_statistics(spark, d):
    return statistics(spark, d)


@query(f"""WITH {STATISTICS_SQL}, w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark),
    n AS (SELECT base FROM f WHERE suffix = 'ing' UNION SELECT word FROM w)
    SELECT base || suffix AS form, base, suffix, uses, vocative_uses FROM f WHERE base IN (SELECT base FROM n) AND (base || suffix NOT IN (SELECT word FROM w) OR vocative_uses >= 3)""")
def foreign_address_forms(spark, d):
    words = table(spark, d, "benchmark", ["text"]).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    words = materialize(words.distinct(), "words")
    return vocabulary.foreign_forms(materialize(statistics(spark, d), "forms"), words.select(F.col("word").alias("form")), words, ["ing"])


@query("""WITH w AS (SELECT *, regexp_extract(text, '[A-Za-z]{4,}') AS w FROM conversations)
    SELECT conv_id, turn, replace(CASE WHEN w = '' THEN text ELSE regexp_replace(text, '(?:' || w || '|' || substr(w, 1, 3) || ')', '{own}', 'g') END, 'that', '{other}') AS slotted FROM w""")
def slotted_turns(spark, d):
    c = table(spark, d, "conversations")
    own = F.regexp_extract("text", "[A-Za-z]{4,}", 0)
    slots = [(F.array(F.substring(own, 1, 3), own), "{own}"), (F.array(F.lit("that")), "{other}")]
    return c.select("conv_id", "turn", vocabulary.slotted(F.col("text"), slots).alias("slotted"))


@query(r"""SELECT conv_id, turn, coalesce(NOT regexp_matches(text, '\d|whan') AND NOT list_has_any(list_transform(regexp_extract_all(text, '[a-z]+'), lambda x: regexp_replace(x, '(ing|ed)$', '')), ['thou', 'inst', 'her']), false) AS common FROM conversations""")
def common_turns(spark, d):
    c = table(spark, d, "conversations")
    stem = lambda w: F.regexp_replace(w, "(ing|ed)$", "")
    return c.select("conv_id", "turn", vocabulary.is_common_turn(F.split("text", r"\. "), [r"\d", "whan"], "[a-z]+", stem, ["thou", "inst", "her"]).alias("common"))


@query(r"""WITH s AS (SELECT conv_id, turn, list_transform(list_filter(regexp_split_to_array(text, '[.!?]\s*'), lambda x: trim(x) <> ''), lambda x: CASE WHEN ends_with(trim(x), 's') THEN trim(x) WHEN trim(x) = 'Er' THEN 'Err'
      WHEN ends_with(trim(x), 'ing') THEN regexp_replace(trim(x), 'ing$', 'ed') WHEN regexp_matches(trim(x), '[a-r]$') THEN trim(x) || 'o' END) AS l FROM conversations)
    SELECT conv_id, turn, CASE WHEN len(l) > 0 AND len(list_filter(l, lambda x: x IS NULL)) = 0 THEN array_to_string(l, ' ') END AS rewritten FROM s""")
def rewritten_registers(spark, d):
    c = table(spark, d, "conversations")
    rewrite = lambda s: vocabulary.rewritten_ending(s, {"Er": "Err"}, [("ing", "ed"), ("([a-r])", "$1o")], ["s"])
    return c.select("conv_id", "turn", vocabulary.rewritten_text(F.split("text", r"[.!?]\s*"), rewrite).alias("rewritten"))
