"""A query of registers beside its SQL. The tables of endings are examples, not a grammar."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators.registers import ANY_FINAL, Rule, rewritten_speech
from weftline.plans.catalog import query
from weftline.sources.tables import table

POLITE = [Rule("요|죠", "$0"), Rule("지", "죠"), Rule("해", "해요"), Rule("워", "워요"), Rule("어", "어요")]
FORMAL = [Rule("죠", "지요"), Rule("해요", "합니다", "합니까"), Rule("워요", "ㅂ습니다", "ㅂ습니까"), Rule(f"(?!ㄹ)({ANY_FINAL})어요", "$1습니다", "$1습니까")]
MILITARY = [Rule("ㅂ니다", "ㅁ다"), Rule("ㅂ니까", "ㅁ까")]
STEMS, ENDS = ["가", "먹", "들", "더", "있"], ["어", "해", "워", "지", "자"]


def _list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query(f"""WITH c AS (SELECT c_custkey, {_list(STEMS)}[c_custkey % 5 + 1] AS s, {_list(ENDS)}[c_custkey // 5 % 5 + 1] AS e, CASE WHEN c_nationkey % 2 = 0 THEN '?' ELSE '.' END AS m FROM customer),
    f AS (SELECT *, (unicode(s) - 44032) % 28 AS last FROM c),
    p AS (SELECT *, CASE e WHEN '지' THEN s || '죠' WHEN '자' THEN NULL ELSE s || e || '요' END AS polite, CASE WHEN m = '?' THEN '까' ELSE '다' END AS k FROM f),
    o AS (SELECT *, CASE e WHEN '지' THEN s || '지요' WHEN '해' THEN s || '합니' || k WHEN '워' THEN CASE WHEN last = 0 THEN chr(CAST(unicode(s) + 17 AS INTEGER)) || '습니' || k ELSE 'skip' END WHEN '어' THEN CASE WHEN last NOT IN (0, 8) THEN s || '습니' || k END END AS formal FROM p)
    SELECT c_custkey, polite || m || ' ' || polite || m AS polite, formal || m || ' ' || formal || m AS formal, CASE e WHEN '해' THEN s || '함' || k WHEN '워' THEN left(formal, 1) || '슴' || k WHEN '어' THEN CASE WHEN formal IS NOT NULL THEN s || '슴' || k END END || m || ' ' || CASE e WHEN '해' THEN s || '함' || k WHEN '워' THEN left(formal, 1) || '슴' || k WHEN '어' THEN CASE WHEN formal IS NOT NULL THEN s || '슴' || k END END || m AS military
    FROM o WHERE formal IS DISTINCT FROM 'skip'""")
def chained_registers(spark, d):
    """Two sentences a customer, made of a stem and an ending, in three registers; null where one cannot be derived."""
    k = F.col("c_custkey")
    word = F.concat(F.element_at(F.array(*map(F.lit, STEMS)), (k % 5 + 1).cast("int")), F.element_at(F.array(*map(F.lit, ENDS)), (F.floor(k / 5) % 5 + 1).cast("int")))
    mark = F.when(F.col("c_nationkey") % 2 == 0, "?").otherwise(".")
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey"]).withColumn("t", F.concat(word, mark, F.lit(" "), word, mark))
    c = c.where(~((F.floor(k / 5) % 5 == 2) & (k % 5).isin(1, 2, 4)))  # such a stem has a final consonant already
    pieces, polite = rewritten_speech(F.col("t"), [POLITE])
    c = c.withColumn("pieces", pieces)
    formal, military = (rewritten_speech(F.col("t"), chain)[1] for chain in ([POLITE, FORMAL], [POLITE, FORMAL, MILITARY]))
    return c.select("c_custkey", polite.alias("polite"), formal.alias("formal"), military.alias("military"))
