"""Queries of prefixes, quotes and digests, beside their SQL where SQL has it."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weftline.functions import quotes
from weftline.operators import prefixes
from weftline.plans.catalog import query
from weftline.sources import digests
from weftline.sources.tables import table

#: Some conversations are cut short so that they are prefixes of others.
SHORT_SQL = """c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT conv_id + 1000000000, turn, role, text FROM conversations WHERE turn <= conv_id % 5 UNION ALL SELECT conv_id + 2000000000, turn, role, text FROM conversations WHERE conv_id % 4 = 0)"""


def with_short_ones(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    cut = c.where(F.col("turn") <= F.col("conv_id") % 5).withColumn("conv_id", F.col("conv_id") + 1000000000)
    return c.unionByName(cut).unionByName(c.where("conv_id % 4 = 0").withColumn("conv_id", F.col("conv_id") + 2000000000))


@query(f"""WITH {SHORT_SQL}, p AS (SELECT conv_id, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS turns, string_agg(role || chr(1) || text, chr(2)) OVER w AS s FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    e AS (SELECT s, min(conv_id) AS first, count(*) AS copies FROM p WHERE n = turns GROUP BY s), j AS (SELECT p.*, e.first, e.copies FROM p LEFT JOIN e ON e.s = p.s)
    SELECT conv_id, turns, max(copies) FILTER (n = turns) AS copies, max(first) FILTER (n = turns) AS same_as, arg_max(first, n) FILTER (n < turns AND first IS NOT NULL) AS continues, max(n) FILTER (n < turns AND first IS NOT NULL) AS shared FROM j GROUP BY conv_id, turns""")
def continued_conversations(spark, d):
    """Conversations that begin with another one, and those that are equal."""
    return prefixes.continuations(with_short_ones(spark, d))


@query("""WITH a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) FILTER (role = 'assistant') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS answers, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_turn,
        coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS chars FROM conversations),
    r AS (SELECT *, lag(n) OVER (PARTITION BY conv_id ORDER BY turn) AS m, lag((conv_id + turn) % 6) OVER (PARTITION BY conv_id ORDER BY turn) AS odd FROM a WHERE role = 'assistant')
    SELECT conv_id, turn, CASE WHEN n = 1 THEN 'no_prompt' WHEN prev <> 'user' THEN 'last_not_user' WHEN (conv_id + turn) % 6 = 1 THEN 'completion_count' WHEN m IS NOT NULL AND (n - 2 <> m OR odd IN (0, 1)) THEN 'broken_chain' WHEN chars > 2000 THEN 'too_long' END AS problem FROM r""")
def record_chains(spark, d):
    """Records of all turns before an answer; some completions have been rewritten or doubled since, which breaks the chain of the next record."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    c = table(spark, d, "conversations").withColumn("prompt", F.collect_list(F.struct("role", F.col("text").alias("content"))).over(w))
    odd = (F.col("conv_id") + F.col("turn")) % 6
    turn = lambda t: F.struct("role", t.alias("content"))
    done = F.when(odd == 0, F.array(turn(F.reverse(F.concat(F.col("text"), F.lit("~")))))).when(odd == 1, F.array(turn(F.col("text")), turn(F.col("text")))).otherwise(F.array(turn(F.col("text"))))
    rows = c.where("role = 'assistant'").withColumn("completion", done)
    chars = F.aggregate("prompt", F.length("text").cast("long"), lambda s, x: s + F.length(x["content"]))
    found = prefixes.record_problems(rows, "conv_id", "turn")
    return found.select("conv_id", "turn", F.coalesce("problem", F.when(chars > 2000, "too_long")).alias("problem"))


QUOTES_SQL = r"""t AS (SELECT page_id, translate(coalesce(html, ''), '<>{}', '「」「」') AS t FROM pages), u AS (SELECT page_id, generate_subscripts(string_split(t, ''), 1) AS i, unnest(string_split(t, '')) AS c FROM t),
    s AS (SELECT *, sum(CASE c WHEN '「' THEN 1 WHEN '」' THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS s FROM u), m AS (SELECT *, least(min(s) OVER (PARTITION BY page_id ORDER BY i), 0) AS low FROM s),
    d AS (SELECT *, s - low AS depth, lag(low, 1, 0) OVER (PARTITION BY page_id ORDER BY i) > low AS unopened FROM m),
    f AS (SELECT page_id, string_agg(c, '' ORDER BY i) FILTER (NOT (c = '「' AND depth > 1) AND NOT (c = '」' AND depth > 0 AND NOT unopened)) AS t FROM d GROUP BY page_id),
    g AS (SELECT t.page_id, coalesce(f.t, '') AS t FROM t LEFT JOIN f USING (page_id)),
    p AS (SELECT page_id, nullif(trim(regexp_extract(t, '^[\s]*([^「」()（）\n]{1,24}?)[\s]*[「(（]', 1)), '') AS speaker, t FROM g),
    b AS (SELECT page_id, speaker, unnest(regexp_extract_all(CASE WHEN speaker IS NULL THEN t ELSE substr(t, length(regexp_extract(t, '^[\s]*[^「」()（）\n]{1,24}?[\s]*[「(（]')))  END, '「[^」]*(?:」|$)|[(（][^)）]*[)）]|[^「(（]+')) AS part, contains(t, '「') AS q FROM p),
    k AS (SELECT page_id, speaker, part[1] = '「' AS quoted, unnest(CASE WHEN part[1] = '「' THEN regexp_extract_all(regexp_replace(part, '^「|」$', '', 'g'), '[(（][^)）]*[)）]|[^(（]+') ELSE [part] END) AS x, q FROM b),
    n AS (SELECT page_id, CASE WHEN x[1] IN ('(', '（') OR (NOT quoted AND q) THEN 'action' ELSE 'speech' END AS kind, regexp_replace(CASE WHEN x[1] IN ('(', '（') THEN regexp_replace(x, '^[(（]|[)）]$', '', 'g') ELSE x END, '^\s+|\s+$', '', 'g') AS x FROM k)"""


@query(f"""WITH {QUOTES_SQL}, a AS (SELECT page_id, count(*) FILTER (kind = 'speech') AS n_speech, count(*) FILTER (kind = 'action') AS n_action, sum(length(x)) AS chars FROM n WHERE x <> '' GROUP BY page_id)
    SELECT p.page_id, speaker, coalesce(n_speech, 0) AS n_speech, coalesce(n_action, 0) AS n_action, CAST(coalesce(chars, 0) AS BIGINT) AS chars FROM p LEFT JOIN a USING (page_id)""")
def nested_quotes(spark, d):
    """Pages whose tags and braces stand for quotes: the speaker ahead, and quoted, acted and plain parts."""
    pages = table(spark, d, "pages", ["page_id", "html"]).select("page_id", quotes.without_inner_quotes(F.translate(F.coalesce("html", F.lit("")), "<>{}", "「」「」")).alias("t"))
    speaker, parts = quotes.turn_parts(F.col("t"))
    out = pages.select("page_id", speaker.alias("speaker"), parts.alias("parts"))
    many = lambda kind: F.size(F.filter("parts", lambda x: x["kind"] == kind)).cast("long")
    chars = F.aggregate("parts", F.lit(0).cast("long"), lambda s, x: s + F.length(x["text"]))
    return out.select("page_id", "speaker", many("speech").alias("n_speech"), many("action").alias("n_action"), chars.alias("chars"))


@query()
def table_digests(spark, d):
    """Name, length and tree digest of each file of the tables."""
    return digests.file_digests(spark, d).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "length", "digest")
