"""Queries of audits, style profiles, reviewed splits and general records, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import hashing
from weftline.operators import audits, classify, records, report, split
from weftline.plans.catalog import COMPONENT_SQL, components, query
from weftline.sources.tables import table

#: Letters and syllables of the texts stand for what the checks look for.
PATTERN_SQL = r"""p AS (SELECT conv_id, turn, role, text, replace(replace(replace(text, 'tion', '{t}'), 'ing', '{s}-ssi'), 'éon', '{t} {t}') AS slots, translate(text, 'zZ', 'すツ') AS j FROM conversations),
    a AS (SELECT conv_id, turn, 'marker' AS "check", CASE WHEN contains(text, 'license') THEN 'license' WHEN contains(text, 'ouon') THEN 'ouon' END AS matched FROM p
        UNION ALL SELECT conv_id, turn, 'kana', nullif(regexp_extract(j, '[ぁ-ゖァ-ヺ]+'), '') FROM p
        UNION ALL SELECT conv_id, turn, 'slot', CASE WHEN contains(slots, '{s}-ssi') AND turn % 4 = 0 THEN '{s}' ELSE coalesce(nullif(regexp_extract(slots, '\{[a-z]+\}-ssi'), ''), nullif(regexp_extract(slots, '\{t\}\s*\{t\}|\{s\}\s*\{s\}'), '')) END FROM p
        UNION ALL SELECT conv_id, turn, 'own_slot', CASE WHEN role = 'user' AND contains(slots, '{t}') THEN '{t}' WHEN role = 'assistant' AND contains(slots, '{s}') THEN '{s}' END FROM p
        UNION ALL SELECT conv_id, turn, 'source_term', nullif(regexp_extract(replace(text, 'the', ' '), 'ther|th'), '') FROM p
        UNION ALL SELECT conv_id, turn, 'address', list_filter(regexp_extract_all(text, '[A-Z][a-z]+ed'), lambda x: x NOT IN ('Red', 'Ed') AND (x LIKE '%ned' OR x LIKE '%red'))[1] FROM p)"""


@query(f"""WITH {PATTERN_SQL} SELECT conv_id, turn, "check", matched FROM a WHERE matched IS NOT NULL""")
def pattern_audit(spark, d):
    """Six checks of every turn, each with the text that it found."""
    c = table(spark, d, "conversations")
    slots = F.replace(F.replace(F.replace("text", F.lit("tion"), F.lit("{t}")), F.lit("ing"), F.lit("{s}-ssi")), F.lit("éon"), F.lit("{t} {t}"))
    c = c.withColumns({"slots": slots, "j": F.translate("text", "zZ", "すツ")})
    slot = F.when(F.col("turn") % 4 == 0, audits.slot_problem(F.array("slots"), ["{t}"], ["-ssi"])).otherwise(audits.slot_problem(F.array("slots"), ["{t}", "{s}"], ["-ssi"]))
    checks = {
        "marker": audits.marker_hit(F.col("text"), ["license", "ouon"]), "kana": audits.kana_hit(F.col("j")), "slot": slot, "own_slot": audits.own_slot(F.col("role"), F.col("slots"), {"user": "{t}", "assistant": "{s}"}),
        "source_term": audits.source_term(F.col("text"), ["th", "ther"], ["the"]), "address": audits.address_hit(F.col("text"), "[A-Z][a-z]+ed", ["ned", "red"], ["Red", "Ed"]),
    }
    return classify.audit(c, checks, ["conv_id", "turn"])


@query(r"""WITH n AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-zé]+')) AS w FROM benchmark) WHERE length(w) > 6),
    w AS (SELECT conv_id, turn, generate_subscripts(l, 1) AS pos, unnest(l) AS w FROM (SELECT conv_id, turn, regexp_extract_all(text, '[A-Za-zé]+') AS l FROM conversations)),
    h AS (SELECT w.* FROM w WHERE w IN (SELECT w FROM n) OR CASE WHEN w LIKE '%s' AND length(w) >= 3 THEN w[:-2] ELSE w END IN (SELECT w FROM n)) SELECT conv_id, turn, arg_min(w, pos) AS word FROM h GROUP BY ALL""")
def foreign_names(spark, d):
    """The first word of each turn that is a name, with or without its ending; long words of another table stand for names."""
    from weftline.functions import text

    names = table(spark, d, "benchmark", ["text"]).select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zé]+"), F.lit(0))).alias("name")).where(F.length("name") > 6)
    return audits.foreign_names(table(spark, d, "conversations"), names, ["conv_id", "turn"], "text", "[A-Za-zé]+", lambda w: text.word_stem(w, ["s"]))


STYLE_SQL = r"""r AS (SELECT source, coalesce(text, '') AS t, contains(text, 'license') OR contains(text, 'ouon') AS addressed FROM documents WHERE source IS NOT NULL),
    c AS (SELECT source, CAST(sum((length(t) - length(replace(t, 'license', ''))) // 7) AS BIGINT) AS a0, CAST(sum((length(replace(t, 'license', ' ')) - length(replace(replace(t, 'license', ' '), 'ouon', ''))) // 4) AS BIGINT) AS a1,
             CAST(sum(len(regexp_extract_all(t, '\bthe\b'))) AS BIGINT) AS f0, CAST(sum(len(regexp_extract_all(t, '\bof\b'))) AS BIGINT) AS f1, CAST(sum(len(regexp_extract_all(t, '\bwas\b'))) AS BIGINT) AS s FROM r GROUP BY source),
    x AS (SELECT source, addressed, unnest(regexp_extract_all(t, '[^.!?…~♪♡♥★]+')) AS e FROM r), y AS (SELECT source, coalesce(addressed, false) AS addressed, rtrim(regexp_replace(e, '^\s+|\s+$', '', 'g'), '.!?…~♪♡♥★ )"''') AS e FROM x),
    l AS (SELECT source, addressed, CASE WHEN e LIKE '%ed' THEN 'military' WHEN e LIKE '%ing' THEN 'formal' WHEN e LIKE '%er' THEN 'archaic' WHEN e LIKE '%s' THEN 'polite' ELSE 'casual' END AS v FROM y WHERE e <> ''),
    k AS (SELECT source, count(*) FILTER (addressed) >= 5 AS few FROM l GROUP BY source), m AS (SELECT l.source, few, v FROM l JOIN k ON k.source = l.source WHERE NOT few OR addressed),
    g AS (SELECT source, any_value(few) AS addressed, count(*) AS total, count(*) FILTER (v = 'casual') AS casual, count(*) FILTER (v = 'military') AS m, count(*) FILTER (v = 'archaic') AS a, count(*) FILTER (v = 'formal') AS f FROM m GROUP BY source),
    z AS (SELECT *, CASE WHEN greatest(CASE WHEN m / total >= 0.2 THEN m ELSE 0 END, CASE WHEN a / total >= 0.2 THEN a ELSE 0 END, CASE WHEN f / total >= 0.2 THEN f ELSE 0 END) > 0 THEN CASE WHEN m / total >= 0.2 AND m >= CASE WHEN a / total >= 0.2 THEN a ELSE 0 END AND m >= CASE WHEN f / total >= 0.2 THEN f ELSE 0 END THEN 'military'
        WHEN a / total >= 0.2 AND a >= CASE WHEN f / total >= 0.2 THEN f ELSE 0 END THEN 'archaic' ELSE 'formal' END WHEN (total - casual - a) / total >= 0.3 THEN 'polite' ELSE 'casual' END AS level FROM g)"""


@query(f"""WITH {STYLE_SQL} SELECT z.source, total, level, z.addressed, CASE WHEN a0 > 0 AND a0 >= a1 THEN 'license' WHEN a1 > 0 THEN 'ouon' ELSE 'none' END AS address,
    CASE WHEN level IN ('casual', 'archaic') THEN CASE WHEN f0 > 0 AND f0 >= f1 THEN 'the' WHEN f1 > 0 THEN 'of' ELSE 'the' END ELSE CASE WHEN f1 > 0 THEN 'of' ELSE 'one' END END AS first_person, s > greatest(a0, a1) AS uses_second_person FROM z JOIN c ON c.source = z.source""")
def style_profiles(spark, d):
    """Registers, address, first and second person of each source's sentences; English endings stand for registers."""
    docs = table(spark, d, "documents", ["source", "text"])
    ends = lambda e: F.col("s").endswith(e)
    level = F.when(ends("ed"), "military").when(ends("ing"), "formal").when(ends("er"), "archaic").when(ends("s"), "polite").otherwise("casual")
    out = report.style_profile(docs, "source", "text", ["license", "ouon"], {"the": r"\bthe\b", "of": r"\bof\b"}, r"\bwas\b", level, 5, "none", "the", "one")
    return out.select("source", "total", "level", "addressed", "address", "first_person", "uses_second_person")


@query(f"""WITH RECURSIVE {COMPONENT_SQL.removeprefix("RECURSIVE ")}, z AS (SELECT component, count(*) AS size, bool_or(id % 17 = 3) AS reviewed FROM c GROUP BY component),
    y AS (SELECT *, row_number() OVER (ORDER BY size DESC, sha256('42|' || component::VARCHAR), component) AS place FROM z), f AS (SELECT min(place) AS first FROM y WHERE reviewed),
    o AS (SELECT component, size, row_number() OVER (ORDER BY place <> first, place) AS i, sum(size) OVER () AS total, count(*) OVER () AS k FROM y, f),
    g AS (SELECT i, component, size, 1 AS s, CAST(total * 0.85 - size AS DOUBLE) AS d1, CAST(total * 0.1 AS DOUBLE) AS d2, CAST(total * 0.05 AS DOUBLE) AS d3, false AS e1, true AS e2, true AS e3 FROM o WHERE i = 1
      UNION ALL SELECT i, component, size, s, d1 - CASE WHEN s = 1 THEN size ELSE 0 END, d2 - CASE WHEN s = 2 THEN size ELSE 0 END, d3 - CASE WHEN s = 3 THEN size ELSE 0 END, e1 AND s <> 1, e2 AND s <> 2, e3 AND s <> 3 FROM
        (SELECT o.i, o.component, o.size, d1, d2, d3, e1, e2, e3, CASE WHEN o.k - o.i + 1 <= e1::INT + e2::INT + e3::INT THEN CASE WHEN e1 THEN 1 WHEN e2 THEN 2 ELSE 3 END WHEN d1 >= d2 AND d1 >= d3 THEN 1 WHEN d2 >= d3 THEN 2 ELSE 3 END AS s FROM g JOIN o ON o.i = g.i + 1))
    SELECT component, size, ['train','validation','test'][s] AS split FROM g""")
def reviewed_split(spark, d):
    """The leakage-safe split with the first component that holds a reviewed row dealt to train before all others."""
    c = components(spark, d)
    return split.leakage_safe_split(c, reviewed=c.where("id % 17 = 3").select("id"))


GENERAL_SQL = r"""c AS (SELECT conv_id, 'soda:train:' || conv_id AS id, list(regexp_replace(text, '^\s+|\s+$', '', 'g') ORDER BY turn) AS turns, any_value(regexp_replace(text, '^\s+|\s+$', '', 'g')) FILTER (turn = 0) AS cue, ['xAttr', 'xReact', 'xIntent', 'xWant', 'xNeed', 'xEffect', 'none'][conv_id % 7 + 1] AS relation FROM (SELECT conv_id, turn, substr(text, 1, 12) AS text FROM conversations) GROUP BY conv_id),
    s AS (SELECT *, list_filter(turns, lambda t: t <> '') AS told, CAST(('0x' || sha256(id)[:8])::BIGINT % 1000 AS BIGINT) AS m FROM c)"""


@query(f"""WITH {GENERAL_SQL}, r AS (SELECT *, CASE m WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END AS split, CASE relation WHEN 'xAttr' THEN 'interpretation' WHEN 'xReact' THEN 'emotion' WHEN 'xIntent' THEN 'intention' WHEN 'xWant' THEN 'intention' WHEN 'xNeed' THEN 'decision' WHEN 'xEffect' THEN 'action' END AS field FROM s)
    SELECT id, 'en' AS language, split, 'user' AS first_role, array_to_string(told, '|') AS turns, NULL AS judgment FROM r WHERE len(told) >= 2
    UNION ALL SELECT id || ':judgment', 'en', split, 'user', cue, '{{"' || field || '": "tail ' || conv_id || '"}}' FROM r WHERE field IS NOT NULL AND cue <> ''
    UNION ALL SELECT 'kor:' || conv_id, 'ko', 'train', 'user', array_to_string(told, '|'), NULL FROM r WHERE len(told) >= 2
    UNION ALL SELECT 'kor:' || conv_id || ':judgment', 'ko', 'train', 'user', cue, '{{"emotion": "' || CASE conv_id % 3 WHEN 0 THEN '기쁨' ELSE '슬픔' END || '"}}' FROM r WHERE conv_id % 3 < 2 AND cue <> ''""")
def general_corpus(spark, d):
    """Conversations and judgments by relation and by emotion, from the first characters of the turns."""
    from weftline.functions import text

    c = table(spark, d, "conversations").withColumn("text", text.strip(F.substring("text", 1, 12)))
    c = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("turns"), F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("cue"))
    names = F.array(*map(F.lit, [*records.RELATIONS, "none"]))
    one = c.select(F.concat(F.lit("soda:train:"), F.col("conv_id").cast("string")).alias("id"), "turns", "cue", F.element_at(names, (F.col("conv_id") % 7 + 1).cast("int")).alias("relation"), F.concat(F.lit(" tail "), F.col("conv_id").cast("string")).alias("tail"))
    two = c.select(F.concat(F.lit("kor:"), F.col("conv_id").cast("string")).alias("id"), "turns", "cue", F.element_at(F.array(F.lit("joyful"), F.lit("sad"), F.lit("unheard of")), (F.col("conv_id") % 3 + 1).cast("int")).alias("emotion"))
    out = records.general_records(one, "en", hashing.held_out_split(F.col("id")), "relation").unionByName(records.general_records(two, "ko", F.lit("train"), "emotion"))
    return out.withColumn("turns", F.array_join("turns", "|"))
