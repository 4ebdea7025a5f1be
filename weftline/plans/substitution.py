"""Queries of substitution by owners' tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text
from weftline.operators import substitution
from weftline.plans.catalog import query
from weftline.sources.tables import table

#: A syllable for each digit, with a final consonant for odd ones.
DIGITS, SYLLABLES = "0123456789", "가각나난다단라란마만"

FORMS_SQL = """f AS (SELECT n_regionkey AS owner, lower(substr(n_name, 1, k)) AS form, min(n_name) AS target FROM nation, (VALUES (1), (2), (3)) v(k) WHERE k > 1 OR n_nationkey % 3 = 0 GROUP BY ALL),
    p AS (SELECT owner, '(?s)' || string_agg(form, '|' ORDER BY length(form) DESC, form) || '|.' AS pattern, map_from_entries(list({'k': form, 'v': target})) AS m FROM f GROUP BY owner)"""


@query(f"WITH {FORMS_SQL} SELECT doc_id, sha256(array_to_string(list_transform(regexp_extract_all(text, pattern), lambda t: coalesce(m[t], t)), '')) AS made FROM documents JOIN p ON owner = doc_id % 5")
def owner_names(spark, d):
    """Each region has a table of its own: first letters of its nations stand for their names, in whole documents."""
    nation = table(spark, d, "nation")
    forms = nation.select(F.col("n_regionkey").cast("long").alias("owner"), F.explode(F.when(F.col("n_nationkey") % 3 == 0, F.array(*map(F.lit, (1, 2, 3)))).otherwise(F.array(*map(F.lit, (2, 3))))).alias("k"), "n_name")
    names = forms.select("owner", F.lower(F.substring("n_name", F.lit(1), F.col("k"))).alias("form"), F.col("n_name").alias("target"))
    docs = table(spark, d, "documents", ["doc_id", "text"]).withColumn("owner", F.col("doc_id") % 5)
    return substitution.replaced_by_owner(docs, names, "owner", "text", agree=False).select("doc_id", F.sha2("text", 256).alias("made"))


STAGES_SQL = """a AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '(?s)the|th|an|.'), lambda t: CASE t WHEN 'the' THEN 'Y' WHEN 'th' THEN 'X' WHEN 'an' THEN 'Xa' ELSE t END), '') AS t FROM documents),
    b AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(t, '(?s)Xa|X|Y|.'), lambda t: CASE t WHEN 'Xa' THEN 'pq' WHEN 'X' THEN 'p' WHEN 'Y' THEN 'q' ELSE t END), '') AS t FROM a),
    c AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(t, '(?s)pq|.'), lambda t: CASE t WHEN 'pq' THEN 'Q' ELSE t END), '') AS t FROM b)"""


@query(f"WITH {STAGES_SQL} SELECT doc_id, sha256(t) AS made FROM c")
def script_conversion(spark, d):
    """Three chained longest-match dictionaries over whole documents; keys overlap and stages feed each other."""
    stages = [{"the": "Y", "th": "X", "an": "Xa"}, {"Xa": "pq", "X": "p", "Y": "q"}, {"pq": "Q"}]
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"]).withColumn("owner", F.lit("all"))
    rows = spark.createDataFrame([("all", i, k, v) for i, s in enumerate(stages) for k, v in s.items()], "owner string, stage int, form string, target string")
    return substitution.replaced_by_owner(docs, rows, "owner", "text", agree=False).select("doc_id", F.sha2("text", 256).alias("made"))


@query(f"""WITH c AS (SELECT c_custkey, c_nationkey AS n, CAST(c_custkey % 10 AS VARCHAR) AS k, c_custkey % 4 AS p FROM customer),
    t AS (SELECT *, translate(CAST((c_custkey % 10 * 7 + n) % 10 AS VARCHAR), '{DIGITS}', '{SYLLABLES}') AS target, (c_custkey % 10 * 7 + n) % 2 = 1 AS closed FROM c)
    SELECT c_custkey, target || CASE p WHEN 0 THEN CASE WHEN closed THEN '은' ELSE '는' END WHEN 1 THEN CASE WHEN closed THEN '을' ELSE '를' END WHEN 2 THEN '는개' ELSE '' END || ' 온다' AS made, target || CASE WHEN closed THEN '이' ELSE '가' END AS subject FROM t""")
def name_agreement(spark, d):
    """Names of a customer's nation in a sentence, each followed by a particle, by what only looks like one, or by none."""
    hangul = lambda c: F.translate(c.cast("string"), DIGITS, SYLLABLES)
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    after = F.when(k % 4 == 0, "는").when(k % 4 == 1, "을").when(k % 4 == 2, "는개").otherwise("")
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey"]).withColumn("text", F.concat(F.lit("엑"), hangul(k % 10), after, F.lit(" 온다")))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"))
    names = nations.select("c_nationkey", F.concat(F.lit("엑"), hangul(F.col("k"))).alias("form"), hangul((F.col("k") * 7 + n) % 10).alias("target"))
    target = hangul((k % 10 * 7 + n) % 10)
    return substitution.replaced_by_owner(c, names, "c_nationkey", "text").select("c_custkey", F.col("text").alias("made"), text.with_particle(target, "subject").alias("subject"))


@query("""WITH b AS (SELECT c_custkey AS owner, c_name || ' ' || c_mktsegment AS name FROM customer), p AS (SELECT owner, name, unnest(list_prepend(name, string_split(name, ' '))) AS part FROM b),
    f AS (SELECT DISTINCT owner, name, part || s AS form FROM p, (VALUES (''), ('-nim'), ('-ssi')) v(s) WHERE part = name OR length(part) >= 2)
    SELECT owner, form, row_number() OVER (PARTITION BY owner ORDER BY length(form) DESC, form) AS place FROM f""")
def ordered_name_forms(spark, d):
    """Forms of two-part names, the longest first."""
    c = table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"]).select(F.col("c_custkey").alias("owner"), F.concat_ws(" ", "c_name", "c_mktsegment").alias("name"))
    return substitution.name_forms(c, "owner", "name", "name", ["-nim", "-ssi"]).select("owner", "form", F.col("place").cast("long").alias("place"))
