"""The queries of the library outside the llm subpackage, each beside its SQL where SQL has it.

``queries()`` gives Spark plans over the tables of a folder, ``oracle_sql()`` what they must equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import hashing, text
from weftline.operators import annotate, batches, classify, containment, curriculum, dedup, derive, evaluate, report, sequence, split
from weftline.plans.shared import materialize
from weftline.sources.tables import table
from weftline.streaming import events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name; ``sql`` is its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)


# -- counts, unions, manifests ------------------------------------------------------------------


@query("SELECT source, lang, count(*) AS n, count(*) FILTER (n_chars > 2000) AS n_long FROM documents GROUP BY source, lang")
def corpus_counts(spark, d):
    docs = table(spark, d, "documents", ["source", "lang", "n_chars"])
    return docs.groupBy("source", "lang").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") > 2000).alias("n_long"))


@query("""SELECT 'lang' AS grouping, lang AS value, count(*) AS n FROM documents GROUP BY lang
    UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source""")
def manifest_counts(spark, d):
    return report.manifest(table(spark, d, "documents", ["lang", "source"]), ["lang", "source"])


@query("""SELECT 'documents' AS origin, doc_id AS id, length(text) AS n FROM documents
    UNION ALL SELECT 'pages', page_id, length(html) FROM pages
    UNION ALL SELECT 'conversations', conv_id * 1000 + turn, length(text) FROM conversations""")
def union_sources(spark, d):
    part = lambda name, i, t: table(spark, d, name).select(F.lit(name).alias("origin"), i.alias("id"), F.length(t).cast("long").alias("n"))
    return part("documents", F.col("doc_id"), "text").unionByName(part("pages", F.col("page_id"), "html")).unionByName(part("conversations", F.col("conv_id") * 1000 + F.col("turn"), "text"))


@query("""WITH a AS (SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(regexp_split_to_array(text, '[^A-Za-z]+')) AS w FROM benchmark) WHERE w <> ''),
    b AS (SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(regexp_split_to_array(text, '[^A-Za-z]+')) AS w FROM conversations) WHERE w <> '')
    SELECT 'both' AS side, count(*) AS n FROM (SELECT w FROM a INTERSECT SELECT w FROM b)
    UNION ALL SELECT 'first', count(*) FROM (SELECT w FROM a EXCEPT SELECT w FROM b)
    UNION ALL SELECT 'second', count(*) FROM (SELECT w FROM b EXCEPT SELECT w FROM a)""")
def vocabulary_difference(spark, d):
    def vocab(name):
        w = F.explode(F.split(F.lower("text"), "[^a-z]+"))
        return table(spark, d, name, ["text"]).select(w.alias("w")).where("w <> ''").distinct()

    a, b = vocab("benchmark"), vocab("conversations")
    count = lambda side, df: df.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return count("both", a.intersect(b)).unionByName(count("first", a.subtract(b))).unionByName(count("second", b.subtract(a)))


@query("SELECT sum(1) AS n, sum(length(text)) AS chars, count(DISTINCT sha256(coalesce(text, ''))) AS distinct_texts FROM documents")
def content_digest_counts(spark, d):
    docs = table(spark, d, "documents", ["text"])
    return docs.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.countDistinct(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("distinct_texts"))


@query("""SELECT count(*) AS n, CAST(sum(CAST('0x' || substr(sha256(concat_ws(chr(31), CAST(doc_id AS VARCHAR), coalesce(text, chr(0)), coalesce(lang, chr(0)), coalesce(source, chr(0)), CAST(n_chars AS VARCHAR))), 1, 15) AS BIGINT)) % 2305843009213693951 AS BIGINT) AS digest FROM documents""")
def dataset_digest(spark, d):
    return report.dataset_digest(table(spark, d, "documents"))


# -- text ---------------------------------------------------------------------------------------


@query(r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')), '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS normalized FROM documents""")
def normalize_text(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", F.sha2(text.normalize_text(F.col("text")), 256).alias("normalized"))


@query(r"""SELECT page_id, length(regexp_replace(regexp_replace(regexp_replace(html, '<(?:font|sound|effect|camera|transition|motionway|display)(?::[^<>]*)?>', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS n FROM pages""")
def clean_script_text(spark, d):
    pages = table(spark, d, "pages", ["page_id", "html"])
    return pages.select("page_id", F.length(text.clean_script_text(F.col("html"))).cast("long").alias("n"))


@query(r"""WITH s AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^.!?…~♪♡♥★]+[.!?…~♪♡♥★]*')) AS raw FROM documents),
    t AS (SELECT doc_id, regexp_replace(regexp_replace(raw, '^\s+|\s+$', '', 'g'), '[.!?…~♪♡♥★ )"'']+$', '') AS s FROM s)
    SELECT doc_id, count(*) AS n, sum(length(s)) AS chars, count(DISTINCT s) AS n_distinct FROM t WHERE s <> '' GROUP BY doc_id""")
def sentence_endings(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "text"])
    each = docs.select("doc_id", F.explode(text.sentences(F.col("text"))).alias("s"))
    return each.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("s")).alias("chars"), F.countDistinct("s").alias("n_distinct"))


@query(r"""WITH s AS (SELECT c_custkey % 700 AS k, regexp_replace(regexp_replace(lower(c_mktsegment || ' #' || (c_custkey % 700)::VARCHAR), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM customer)
    SELECT slug, count(*) AS n, min(k) AS least FROM s GROUP BY slug HAVING count(*) > 1""")
def slugify_collisions(spark, d):
    k = F.col("c_custkey") % 700
    rows = table(spark, d, "customer", ["c_custkey", "c_mktsegment"]).select(k.alias("k"), text.slug(F.concat("c_mktsegment", F.lit(" #"), k.cast("string"))).alias("slug"))
    return rows.groupBy("slug").agg(F.count("*").alias("n"), F.min("k").alias("least")).where("n > 1")


@query(r"""WITH q AS (SELECT page_id, string_split(html, '*') AS ps, len(string_split(html, '*')) AS k FROM pages), m AS (SELECT page_id, ps, k, k - CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS n FROM q),
    p AS (SELECT page_id, i, CASE WHEN i = n AND k % 2 = 0 THEN ps[k - 1] || '*' || ps[k] ELSE ps[i] END AS part FROM m, LATERAL (SELECT unnest(range(1, n + 1)) AS i))
    SELECT page_id, CASE WHEN i % 2 = 0 THEN 'action' ELSE 'speech' END AS kind, count(*) AS n FROM p
    WHERE CASE WHEN i % 2 = 0 THEN regexp_replace(part, '^\s+|\s+$', '', 'g') ELSE regexp_replace(regexp_replace(regexp_replace(part, '^\s+|\s+$', '', 'g'), '^["“”]+|["“”]+$', '', 'g'), '^\s+|\s+$', '', 'g') END <> '' GROUP BY ALL""")
def segment_turns(spark, d):
    pages = table(spark, d, "pages", ["page_id", "html"])
    each = pages.select("page_id", F.explode(text.segments(F.col("html"))).alias("s"))
    return each.groupBy("page_id", F.col("s.kind").alias("kind")).agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(s, 'tion$') THEN 'noun' WHEN regexp_matches(s, '(ly|ing)$') THEN 'modifier' WHEN regexp_matches(s, 'ed$') THEN 'past' ELSE 'other' END AS label
    FROM (SELECT doc_id, regexp_replace(lower(text), '[^a-z]+$', '') AS s FROM documents)""")
def ordered_suffix_rules(spark, d):
    s = F.regexp_replace(F.lower("text"), "[^a-z]+$", "")
    docs = table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", text.first_match(s, [("noun", "tion$"), ("modifier", "(ly|ing)$"), ("past", "ed$")], "other").alias("label"))


@query(r"""WITH w AS MATERIALIZED (SELECT unnest(string_split(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), ' ')) AS w FROM documents),
    c AS MATERIALIZED (SELECT w, count(*) AS n FROM w WHERE w <> '' GROUP BY w),
    a AS MATERIALIZED (SELECT substr(w, 1, length(w) - 2) AS word, n AS suffixed FROM c WHERE w LIKE '%ed' AND length(w) > 2)
    SELECT a.word, a.suffixed, c.n AS bare FROM a JOIN c ON c.w = a.word WHERE a.suffixed >= 0.5 * c.n""")
def suffix_share(spark, d):
    return report.suffix_share(table(spark, d, "documents", ["text"]), "text", "ed")


@query("""SELECT w, length(w) AS n FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM benchmark) WHERE w <> '' ORDER BY n DESC, w LIMIT 50""")
def longest_first(spark, d):
    w = table(spark, d, "benchmark", ["text"]).select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).where("w <> ''").distinct()
    return w.select("w", F.length("w").cast("long").alias("n")).orderBy(F.desc("n"), "w").limit(50)


# -- gates and audits ---------------------------------------------------------------------------

LEXICON = [("identity", ["assistant", "language model"]), ("tool", ["search", "http"]), ("protected", ["secret", "token ="]), ("review", ["license"])]
PRIORITY = ["unanswered", "protected", "system", "identity", "tool", "review", "accepted"]
LABEL_SQL = """CASE WHEN role = 'system' THEN 'system' WHEN contains(t, 'assistant') OR contains(t, 'language model') THEN 'identity'
    WHEN contains(t, 'search') OR contains(t, 'http') THEN 'tool' WHEN contains(t, 'secret') OR contains(t, 'token =') THEN 'protected' WHEN contains(t, 'license') THEN 'review' ELSE 'accepted' END"""


def turn_label(role, content):
    t = text.strip(F.lower(content))
    return classify.decide([("system", role == "system"), *[(label, classify.any_of(t, words)) for label, words in LEXICON]], "accepted")


@query(f"""SELECT conv_id, turn, {LABEL_SQL} AS label FROM (SELECT *, trim(lower(text)) AS t FROM conversations)""")
def turn_classification(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", turn_label(F.col("role"), F.col("text")).alias("label"))


EXCHANGE_SQL = f"""t AS (SELECT *, trim(lower(text)) AS t FROM conversations),
    b AS (SELECT conv_id, turn, role, text, {LABEL_SQL} AS label, role = 'assistant' AS mine, coalesce(lag(role = 'assistant') OVER (PARTITION BY conv_id ORDER BY turn), false) AS before FROM t),
    e AS (SELECT *, sum(CASE WHEN NOT mine AND before THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS exchange FROM b)"""


@query(f"""WITH {EXCHANGE_SQL}, x AS (SELECT conv_id, exchange, bool_or(mine) AS answered, count(*) FILTER (NOT mine) AS n_prompt, count(*) FILTER (mine) AS n_answer,
    min(list_position(['unanswered','protected','system','identity','tool','review','accepted'], label)) AS p FROM e GROUP BY conv_id, exchange)
    SELECT conv_id, CAST(exchange AS BIGINT) AS exchange, n_prompt, n_answer, CASE WHEN answered THEN ['unanswered','protected','system','identity','tool','review','accepted'][p] ELSE 'unanswered' END AS label FROM x""")
def exchanges(spark, d):
    c = table(spark, d, "conversations")
    e = sequence.exchanges(c.withColumn("label", turn_label(F.col("role"), F.col("text"))))
    out = e.groupBy("conv_id", "exchange").agg(F.count_if("is_prompt").alias("n_prompt"), F.count_if(~F.col("is_prompt")).alias("n_answer"), F.first("answered").alias("answered"), classify.highest_priority(F.col("label"), PRIORITY).alias("label"))
    return out.select("conv_id", "exchange", "n_prompt", "n_answer", F.when(F.col("answered"), F.col("label")).otherwise("unanswered").alias("label"))


@query(f"""WITH {EXCHANGE_SQL}, x AS (SELECT min(list_position(['unanswered','protected','system','identity','tool','review','accepted'], label)) AS p, bool_or(mine) AS answered FROM e GROUP BY conv_id, exchange)
    SELECT CASE WHEN answered THEN ['unanswered','protected','system','identity','tool','review','accepted'][p] ELSE 'unanswered' END AS label, count(*) AS n FROM x GROUP BY 1""")
def exchange_priority(spark, d):
    return exchanges(spark, d).groupBy("label").agg(F.count("*").alias("n"))


@query(f"""WITH {EXCHANGE_SQL}, x AS (SELECT conv_id, exchange, bool_or(mine) AS answered, string_agg(text, chr(10) ORDER BY turn) FILTER (mine) AS answer,
    min(list_position(['unanswered','protected','system','identity','tool','review','accepted'], label)) AS p FROM e GROUP BY conv_id, exchange)
    SELECT conv_id, CAST(exchange AS BIGINT) AS exchange, CASE WHEN NOT answered THEN 'unanswered' WHEN p < 6 THEN ['unanswered','protected','system','identity','tool','review','accepted'][p] WHEN trim(answer) = '' THEN 'empty' ELSE 'accepted' END AS state,
    coalesce(answer[:80], '') AS preview FROM x""")
def exchange_records(spark, d):
    """Accepted exchanges and, as excluded rows with their reason, all others: together they are the input."""
    c = table(spark, d, "conversations")
    e = sequence.exchanges(c.withColumn("label", turn_label(F.col("role"), F.col("text"))))
    answer = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_prompt"), F.struct("turn", "text")))), lambda x: x["text"]), "\n")
    out = e.groupBy("conv_id", "exchange").agg(F.first("answered").alias("answered"), answer.alias("answer"), classify.highest_priority(F.col("label"), PRIORITY).alias("label"))
    state = F.when(~F.col("answered"), "unanswered").when(~F.col("label").isin("review", "accepted"), F.col("label")).when(F.col("label") == "review", "review").when(text.is_empty_text(F.col("answer")), "empty").otherwise("accepted")
    return out.select("conv_id", "exchange", state.alias("state"), text.preview(F.col("answer")).alias("preview"))


@query("SELECT b.item_id, count(*) AS n_docs, min(d.doc_id) AS first_doc FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE b.text <> '' GROUP BY b.item_id")
def target_leakage(spark, d):
    """Documents that hold a benchmark text whole, whatever its length; empty items are in none."""
    leaks = containment.containing(table(spark, d, "documents", ["doc_id", "text"]), table(spark, d, "benchmark"))
    return leaks.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query("""WITH c AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations)
    SELECT conv_id, turn, concat_ws(',', CASE WHEN trim(text) = '' THEN 'empty' END, CASE WHEN length(text) > 400 THEN 'too_long' END, CASE WHEN turn = last AND role <> 'assistant' THEN 'ends_open' END, CASE WHEN prev = role THEN 'repeats_role' END) AS problems
    FROM c WHERE trim(text) = '' OR length(text) > 400 OR (turn = last AND role <> 'assistant') OR prev = role""")
def record_validation(spark, d):
    w = Window.partitionBy("conv_id")
    c = table(spark, d, "conversations").withColumn("last", F.max("turn").over(w)).withColumn("prev", F.lag("role").over(w.orderBy("turn")))
    found = classify.problems({"empty": text.is_empty_text(F.col("text")), "too_long": F.length("text") > 400, "ends_open": (F.col("turn") == F.col("last")) & (F.col("role") != "assistant"), "repeats_role": F.col("prev") == F.col("role")})
    return c.select("conv_id", "turn", F.array_join(found, ",").alias("problems")).where("problems <> ''")


AUDIT = {"email": r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "url": r"https?://[^ \n]+", "number": r"[0-9]{6,}", "pipe": r"\| [A-Za-z]+ \|", "shout": r"[A-Z]{4,}!!", "license": r"[Ll]icense[a-z]*"}
#: A text that every match holds, and what must not stand ahead of one, so that a run is tried from its start alone.
AUDIT_NEEDS = {"email": "@", "url": "http", "pipe": "| ", "shout": "!!", "license": "icense"}
AUDIT_STARTS = {"email": "(?<![A-Za-z0-9._])", "number": "(?<![0-9])"}
AUDIT_SQL = "a AS (" + " UNION ALL ".join(f"SELECT doc_id, '{n}' AS \"check\", regexp_extract(text, '{p}') AS matched FROM documents" for n, p in AUDIT.items()) + ")"


def audited(spark, d):
    return classify.audit(table(spark, d, "documents", ["doc_id", "text"]), {n: classify.guarded(F.col("text"), p, AUDIT_NEEDS.get(n), AUDIT_STARTS.get(n, "")) for n, p in AUDIT.items()}, ["doc_id"])


@query(f"""WITH {AUDIT_SQL} SELECT "check", count(*) AS n FROM a WHERE matched <> '' GROUP BY "check" """)
def audit_counts(spark, d):
    return audited(spark, d).groupBy("check").agg(F.count("*").alias("n"))


@query(f"""WITH {AUDIT_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY doc_id) AS n FROM a WHERE matched <> '')
    SELECT "check", n, r.doc_id, matched, d.text[:80] AS preview FROM r JOIN documents d ON d.doc_id = r.doc_id WHERE n <= 5""")
def audit_samples(spark, d):
    some = classify.samples(audited(spark, d), "check", ["doc_id"])  # a feature of the report: five a check
    docs = table(spark, d, "documents", ["doc_id", "text"])
    return docs.join(F.broadcast(some), "doc_id").select("check", F.col("n").cast("long").alias("n"), "doc_id", "matched", text.preview(F.col("text")).alias("preview"))


@query(r"""WITH p AS (SELECT doc_id, list_transform(regexp_extract_all(text, '([0-9]{1,3})\s*(?:years old|살|세)', 1), lambda x: CAST(x AS INTEGER)) AS ages, contains(lower(text), 'secret') AS s, length(text) AS n FROM documents)
    SELECT CASE WHEN len(list_filter(ages, lambda x: x < 18)) > 0 THEN 'age' WHEN s THEN 'secret' WHEN n < 40 THEN 'short' ELSE 'accepted' END AS reason, count(*) AS n FROM p GROUP BY 1""")
def policy_gate(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "text"])
    reason = classify.decide([("age", classify.stated_age_under(F.col("text"), 18)), ("secret", F.contains(F.lower("text"), F.lit("secret"))), ("short", F.length("text") < 40)], "accepted")
    good, bad = classify.gate(docs, F.nullif(reason, F.lit("accepted")), "first rule that holds", ["doc_id"])
    return bad.select("reason").unionByName(good.select(F.lit("accepted").alias("reason"))).groupBy("reason").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT source, array_sort(list_distinct(list(lang))) AS have FROM documents GROUP BY source)
    SELECT source, len(have) AS n_have, array_to_string(list_filter(['de','en','es','fr','it'], lambda x: NOT list_contains(have, x)), ',') AS missing FROM s""")
def required_coverage(spark, d):
    docs = table(spark, d, "documents", ["source", "lang"]).groupBy("source").agg(F.collect_set("lang").alias("have"))
    need = F.array(*map(F.lit, ["de", "en", "es", "fr", "it"]))
    return docs.select("source", F.size("have").cast("long").alias("n_have"), F.array_join(F.array_except(need, "have"), ",").alias("missing"))


# -- joins --------------------------------------------------------------------------------------


@query("""SELECT coalesce(r.doc_id, a.doc_id) AS doc_id, CASE WHEN r.doc_id IS NULL THEN 'unused' WHEN a.doc_id IS NULL THEN 'unannotated' ELSE 'matched' END AS state, a.quality
    FROM (SELECT doc_id FROM documents WHERE lang = 'en') r FULL OUTER JOIN labels a ON a.doc_id = r.doc_id""")
def annotation_merge(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "lang"]).where("lang = 'en'").select("doc_id")
    return annotate.annotation_merge(docs, table(spark, d, "labels", ["doc_id", "quality"]), "doc_id").select("doc_id", "state", "quality")


@query("""SELECT d.doc_id, d.source FROM documents d WHERE d.lang <> 'en' AND NOT EXISTS (SELECT 1 FROM documents e JOIN labels l ON l.doc_id = e.doc_id WHERE l.toxic = 1 AND e.lang = 'en' AND e.source = d.source)""")
def cross_lingual_exclusion(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "lang", "source"])
    bad = table(spark, d, "labels", ["doc_id", "toxic"]).where("toxic = 1")
    rejected = docs.where("lang = 'en'").join(bad, "doc_id", "left_semi").select("source").distinct()
    return docs.where("lang <> 'en'").join(rejected, "source", "left_anti").select("doc_id", "source")


@query("""WITH p AS (SELECT doc_id, sha256(text) AS h, CASE WHEN doc_id % 10 < 2 THEN 'test' ELSE 'train' END AS split FROM documents WHERE doc_id % 3 = 0),
    q AS (SELECT h, min(split) AS split FROM p GROUP BY h)
    SELECT d.doc_id, coalesce(p.split, q.split, 'new') AS split FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN q ON q.h = sha256(d.text)""")
def split_inheritance(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "text"]).select("doc_id", F.sha2("text", 256).alias("h"))
    prior = docs.where("doc_id % 3 = 0").withColumn("split", F.when(F.col("doc_id") % 10 < 2, "test").otherwise("train"))
    by_text = prior.groupBy("h").agg(F.min("split").alias("split"))
    return annotate.inherit(docs, prior.select("doc_id", "split"), by_text, "doc_id", "h", "split").select("doc_id", F.coalesce("split", F.lit("new")).alias("split"))


@query("""WITH k AS (SELECT DISTINCT conv_id, role || ':' || (length(text) % 7)::VARCHAR AS key FROM conversations),
    a AS (SELECT 'user:' || i::VARCHAR AS key, 'assistant:' || ((i + 1) % 7)::VARCHAR AS alias FROM range(7) t(i)),
    x AS (SELECT conv_id, key FROM k UNION SELECT conv_id, alias FROM k JOIN a USING (key))
    SELECT conv_id, string_agg(key, ',' ORDER BY key) AS keys FROM x GROUP BY conv_id""")
def event_alias_expand(spark, d):
    key = F.concat("role", F.lit(":"), (F.length("text") % 7).cast("string"))
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_set(key).alias("keys"))
    aliases = spark.range(7).select(F.concat(F.lit("user:"), F.col("id").cast("string")).alias("key"), F.concat(F.lit("assistant:"), ((F.col("id") + 1) % 7).cast("string")).alias("alias"))
    out = annotate.expand_aliases(rows, aliases, "conv_id", "keys")
    return out.select("conv_id", F.array_join("keys", ",").alias("keys"))


@query("""SELECT a.n_name AS owner, b.n_name AS other, r.r_name || ' ' || b.n_name AS fact FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name <> b.n_name JOIN region r ON r.r_regionkey = b.n_regionkey""")
def other_owner_facts(spark, d):
    n = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    facts = n.select(F.col("n_name").alias("name"), "n_regionkey", F.concat("r_name", F.lit(" "), "n_name").alias("fact_text"))
    return derive.other_owner_facts(facts, "name", "n_regionkey", "fact_text")


@query("""SELECT c.c_custkey, n.n_name AS nation, r.r_name AS region FROM customer c LEFT JOIN nation n ON n.n_nationkey = nullif(c.c_nationkey, 0) LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def localized_lookup(spark, d):
    """Two keyed hops; key 0 stands for none."""
    n = table(spark, d, "nation").select(F.lit("nation").alias("source_table"), F.col("n_nationkey").alias("sno"), F.col("n_regionkey").alias("pool_id_en"), F.col("n_name").alias("nation"))
    pool = table(spark, d, "region").select(F.col("r_regionkey").alias("pool_id"), F.col("r_name").alias("payload"))
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    out = annotate.localized(c, n, pool, F.lit("nation"), F.col("c_nationkey"), "en")
    names = n.select(F.col("sno").alias("__n"), "nation")
    return out.join(names, F.nullif("c_nationkey", F.lit(0)) == F.col("__n"), "left").select("c_custkey", "nation", F.col("localized").alias("region"))


@query("""SELECT DISTINCT c.c_custkey, s.s_suppkey FROM customer c JOIN supplier s ON (s.s_suppkey = c.c_custkey OR s.s_name = replace(c.c_name, 'Customer', 'Supplier'))""")
def two_key_match(spark, d):
    c = table(spark, d, "customer", ["c_custkey", "c_name"]).withColumn("alias", F.replace("c_name", F.lit("Customer"), F.lit("Supplier")))
    s = table(spark, d, "supplier", ["s_suppkey", "s_name"])
    return annotate.two_key_join(c, s, [("c_custkey", "s_suppkey"), ("alias", "s_name")], "c_custkey", "s_suppkey")


@query("""SELECT p.p_partkey, coalesce(m.level, 1) AS level FROM part p LEFT JOIN (SELECT l_partkey, CAST(max(l_linenumber) AS INTEGER) AS level FROM lineitem WHERE l_quantity > 45 GROUP BY l_partkey) m ON m.l_partkey = p.p_partkey""")
def lookup_with_default(spark, d):
    levels = table(spark, d, "lineitem", ["l_partkey", "l_linenumber", "l_quantity"]).where("l_quantity > 45").groupBy("l_partkey").agg(F.max("l_linenumber").alias("level"))
    p = table(spark, d, "part", ["p_partkey"])
    return p.join(levels, p.p_partkey == levels.l_partkey, "left").select("p_partkey", F.coalesce("level", F.lit(1)).alias("level"))


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') OR c_custkey IN (1, 2, 3)""")
def roster(spark, d):
    c = table(spark, d, "customer", ["c_custkey", "c_name"])
    urgent = table(spark, d, "orders", ["o_custkey", "o_orderpriority"]).where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    fixed = spark.createDataFrame([(1,), (2,), (3,)], "c_custkey long")
    return c.join(urgent.unionByName(fixed), "c_custkey", "left_semi")


# -- hashes and assignment ----------------------------------------------------------------------


@query("SELECT doc_id, CAST(('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT % 97 AS BIGINT) AS bucket FROM documents")
def stable_index(spark, d):
    return table(spark, d, "documents", ["doc_id"]).select("doc_id", hashing.stable_index(F.col("doc_id").cast("string"), 97).alias("bucket"))


@query("""SELECT doc_id, CASE ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::UBIGINT % 1000 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END AS split FROM documents""")
def held_out_split(spark, d):
    return table(spark, d, "documents", ["doc_id"]).select("doc_id", hashing.held_out_split(F.col("doc_id").cast("string")).alias("split"))


@query("""WITH o AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS n, count(*) OVER () AS k FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)),
    c AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT c.conv_id, o.source AS owner FROM c JOIN o ON o.n = ('0x' || substr(sha256(c.conv_id::VARCHAR), 1, 16))::UBIGINT % o.k""")
def stable_assignment(spark, d):
    owners = table(spark, d, "documents", ["source"]).where("source is not null").distinct()
    owners = materialize(owners.select("source", (F.row_number().over(Window.orderBy("source")) - 1).cast("long").alias("n")), "owners")
    k = max(1, owners.count())
    c = table(spark, d, "conversations", ["conv_id"]).distinct().withColumn("n", hashing.stable_index(F.col("conv_id").cast("string"), k))
    return c.join(owners, "n").select("conv_id", F.col("source").alias("owner"))


@query("""SELECT d.doc_id, q.item_id FROM documents d JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS n, count(*) OVER () AS k FROM benchmark) q ON q.n = ('0x' || substr(sha256(d.text), 1, 16))::UBIGINT % q.k""")
def stable_question_pick(spark, d):
    items = table(spark, d, "benchmark", ["item_id"])
    items = materialize(items.select("item_id", (F.row_number().over(Window.orderBy("item_id")) - 1).cast("long").alias("n")), "items")
    k = max(1, items.count())
    return table(spark, d, "documents", ["doc_id", "text"]).withColumn("n", hashing.stable_index(F.col("text"), k)).join(items, "n").select("doc_id", "item_id")


# -- votes and profiles -------------------------------------------------------------------------


@query("""WITH c AS (SELECT source, lang, count(*) AS n FROM documents WHERE coalesce(lang, '') <> '' GROUP BY source, lang), t AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS k FROM c)
    SELECT r.source, lang, n, total FROM r JOIN t ON t.source IS NOT DISTINCT FROM r.source WHERE k = 1 AND n >= 0.5 * total""")
def dominant_value(spark, d):
    return report.dominant(table(spark, d, "documents", ["source", "lang"]), "source", "lang")


@query(r"""WITH s AS (SELECT source, unnest(regexp_extract_all(text, '[^.!?…~♪♡♥★]+[.!?…~♪♡♥★]*')) AS raw FROM documents),
    t AS (SELECT source, regexp_replace(regexp_replace(raw, '^\s+|\s+$', '', 'g'), '[.!?…~♪♡♥★ )"'']+$', '') AS s FROM s),
    l AS (SELECT source, CASE WHEN regexp_matches(s, 'tion$') THEN 'military' WHEN regexp_matches(s, '(ly|ing)$') THEN 'formal' WHEN regexp_matches(s, 'ed$') THEN 'archaic' WHEN regexp_matches(s, 'er$') THEN 'polite' ELSE 'casual' END AS level FROM t WHERE s <> ''),
    c AS (SELECT source, count(*) AS total, count(*) FILTER (level = 'casual') AS casual, count(*) FILTER (level = 'polite') AS polite, count(*) FILTER (level = 'formal') AS formal, count(*) FILTER (level = 'military') AS military, count(*) FILTER (level = 'archaic') AS archaic FROM l GROUP BY source)
    SELECT *, CASE WHEN military / total >= 0.2 AND NOT (archaic / total >= 0.2 AND archaic > military) AND NOT (formal / total >= 0.2 AND formal > military) THEN 'military'
        WHEN archaic / total >= 0.2 AND NOT (formal / total >= 0.2 AND formal > archaic) THEN 'archaic' WHEN formal / total >= 0.2 THEN 'formal'
        WHEN (total - casual - archaic) / total >= 0.3 THEN 'polite' ELSE 'casual' END AS level FROM c""")
def register_profile(spark, d):
    """The profile of each source by the endings of its sentences; English endings stand in for the registers."""
    rules = [("military", "tion$"), ("formal", "(ly|ing)$"), ("archaic", "ed$"), ("polite", "er$")]
    return report.level_profile(table(spark, d, "documents", ["source", "text"]), "source", "text", level=text.first_match(F.col("s"), rules, "casual"))


@query("""SELECT conv_id, CASE WHEN y > n THEN 'yes' WHEN n > y THEN 'no' ELSE 'unknown' END AS vote FROM (SELECT conv_id, count(*) FILTER (contains(lower(text), 'the ')) AS y, count(*) FILTER (contains(lower(text), 'of ')) AS n FROM conversations GROUP BY conv_id)""")
def role_vote(spark, d):
    return report.role_vote(table(spark, d, "conversations"), "conv_id", F.contains(F.lower("text"), F.lit("the ")), F.contains(F.lower("text"), F.lit("of ")))


# -- sequences ----------------------------------------------------------------------------------


@query("""WITH l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations), r AS (SELECT *, sum(CASE WHEN prev IS NOT DISTINCT FROM role THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM l)
    SELECT conv_id, CAST(run AS BIGINT) AS run, min(role) AS role, count(*) AS n FROM r GROUP BY conv_id, run""")
def role_runs(spark, d):
    return sequence.role_runs(table(spark, d, "conversations")).groupBy("conv_id", "run").agg(F.min("role").alias("role"), F.count("*").alias("n"))


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
    h AS (SELECT a.conv_id, a.turn, b.i, b.role, b.text FROM n a JOIN n b ON a.conv_id = b.conv_id AND b.i BETWEEN a.i - 8 AND a.i - 1 WHERE a.role = 'assistant'),
    f AS (SELECT *, first_value(role) OVER w AS r0, first_value(i) OVER w AS i0, last_value(role) OVER w AS r1 FROM h WINDOW w AS (PARTITION BY conv_id, turn ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    k AS (SELECT * FROM f WHERE r0 = 'user' OR i > i0)
    SELECT conv_id, turn, count(*) AS n, sum(length(text)) AS chars FROM k WHERE r1 = 'user' GROUP BY conv_id, turn""")
def history_windows(spark, d):
    h = sequence.history(table(spark, d, "conversations"))
    chars = F.aggregate("history", F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"]))
    return h.select("conv_id", "turn", F.size("history").cast("long").alias("n"), chars.alias("chars"))


@query("""SELECT * FROM (SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS earlier, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier_chars FROM conversations) WHERE earlier % 2 = 1""")
def prefix_history(spark, d):
    return sequence.prefix_history(table(spark, d, "conversations")).select("conv_id", "turn", F.col("earlier").cast("long").alias("earlier"), F.col("earlier_chars").cast("long").alias("earlier_chars"))


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, length(text) % 5 <> 0 AS c FROM conversations),
    g AS (SELECT *, sum(CASE WHEN c THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM n), r AS (SELECT *, min(i) FILTER (role = 'user') OVER (PARTITION BY conv_id, g) AS a FROM g WHERE c),
    z AS (SELECT *, max(i) FILTER (role = 'assistant' AND i > a) OVER (PARTITION BY conv_id, g) AS z FROM r)
    SELECT conv_id, min(turn) AS start, max(turn) AS "end" FROM z WHERE i BETWEEN a AND z GROUP BY conv_id, g""")
def common_runs(spark, d):
    return sequence.common_runs(table(spark, d, "conversations"), F.length("text") % 5 != 0)


@query("""WITH b AS (SELECT *, bool_or(role = 'user' AND length(text) % 3 = 0) OVER (PARTITION BY conv_id ORDER BY turn) AS cut FROM conversations)
    SELECT conv_id, count(*) FILTER (NOT cut) AS n_kept, count(*) FILTER (cut AND role = 'assistant') AS n_lost_answers FROM b GROUP BY conv_id""")
def context_break(spark, d):
    b = sequence.before_break(table(spark, d, "conversations"), (F.col("role") == "user") & (F.length("text") % 3 == 0))
    return b.groupBy("conv_id").agg(F.count_if(~F.col("cut")).alias("n_kept"), F.count_if(F.col("cut") & (F.col("role") == "assistant")).alias("n_lost_answers"))


@query("""SELECT conv_id, turn, role FROM (SELECT *, max(turn) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS l FROM conversations) WHERE turn <= l""")
def trailing_trim(spark, d):
    return sequence.trim_tail(table(spark, d, "conversations")).select("conv_id", "turn", "role")


@query(f"""WITH {EXCHANGE_SQL}, x AS (SELECT conv_id, exchange, string_agg(text, ' ' ORDER BY turn) FILTER (NOT mine) AS u, string_agg(text, ' ' ORDER BY turn) FILTER (mine) AS a FROM e GROUP BY conv_id, exchange)
    SELECT conv_id, CAST(exchange AS BIGINT) AS exchange, count(*) OVER w AS n_earlier, coalesce(sum(length(coalesce(a, ''))) OVER w, 0) AS answer_chars FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY exchange ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""")
def running_history(spark, d):
    e = sequence.exchanges(table(spark, d, "conversations"))
    joined = lambda cond: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("turn", "text")))), lambda x: x["text"]), " ")
    x = e.groupBy("conv_id", "exchange").agg(joined(F.col("is_prompt")).alias("user_text"), joined(~F.col("is_prompt")).alias("answer_text"))
    h = sequence.earlier_exchanges(x)
    return h.select("conv_id", "exchange", F.size("earlier").cast("long").alias("n_earlier"), F.aggregate("earlier", F.lit(0).cast("long"), lambda a, m: a + F.length(m["answer"])).alias("answer_chars"))


# -- duplicates, samples, batches ---------------------------------------------------------------


@query("""SELECT doc_id, row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY doc_id) = 1 AS kept FROM documents""")
def exact_dedup(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "text"]).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return dedup.first_seen(docs, ["h"], ["doc_id"]).select("doc_id", "kept")


FOCUS_SQL = """f AS (SELECT d.doc_id, d.source, d.lang, length(d.text) AS n, sha256(d.text) AS h, coalesce(l.toxic = 1, false) AS focus FROM documents d LEFT JOIN labels l USING (doc_id)),
    u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY focus DESC, CASE WHEN focus THEN -doc_id ELSE doc_id END) AS k FROM f) WHERE k = 1)"""


def focused(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "source", "lang", "text"]).select("doc_id", "source", "lang", F.length("text").alias("n"), F.sha2("text", 256).alias("h"))
    docs = docs.join(table(spark, d, "labels", ["doc_id", "toxic"]), "doc_id", "left").withColumn("focus", F.coalesce(F.col("toxic") == 1, F.lit(False)))
    return dedup.focus_dedup(docs, "h", F.col("focus"), "doc_id")


@query(f"WITH {FOCUS_SQL} SELECT doc_id, h, focus FROM u")
def focus_dedup(spark, d):
    return focused(spark, d).select("doc_id", "h", "focus")


@query("""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('42|' || doc_id::VARCHAR), doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE k <= least(n, greatest(ceil(n * 0.1), 3))""")
def replay_sample(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "source"])
    n = F.col("available")
    return curriculum.sample_per_owner(docs, "source", "doc_id", F.least(n, F.greatest(F.ceil(n * 0.1), F.lit(3)))).select("doc_id", "source")


@query(f"""WITH {FOCUS_SQL}, c AS (SELECT source, lang, count(*) FILTER (focus) AS nf, count(*) FILTER (NOT focus) AS ne FROM u GROUP BY source, lang),
    r AS (SELECT u.*, row_number() OVER (PARTITION BY u.source, u.lang, focus ORDER BY sha256('42|' || doc_id::VARCHAR), doc_id) AS q, nf, ne FROM u JOIN c ON c.source = u.source AND c.lang = u.lang)
    SELECT doc_id, focus FROM r WHERE focus OR q <= least(ne, greatest(ceil(nf * 0.5), 1))""")
def curriculum_select(spark, d):
    """All rows in focus and, by owner and language, a seeded replay of half as many others, one at least."""
    u = focused(spark, d)
    w = Window.partitionBy("source", "lang")
    u = u.withColumn("nf", F.count_if("focus").over(w)).withColumn("ne", F.count_if(~F.col("focus")).over(w))
    order = Window.partitionBy("source", "lang", "focus").orderBy(hashing.seeded_order(42, F.col("doc_id")), "doc_id")
    u = u.withColumn("q", F.row_number().over(order))
    return u.where(F.col("focus") | (F.col("q") <= F.least("ne", F.greatest(F.ceil(F.col("nf") * 0.5), F.lit(1))))).select("doc_id", "focus")


@query("""WITH o AS (SELECT doc_id, source, length(text) AS n, floor((row_number() OVER (PARTITION BY source ORDER BY sha256('42|' || doc_id::VARCHAR), doc_id) - 1) / 128) AS pool FROM documents),
    b AS (SELECT *, floor((row_number() OVER (PARTITION BY source, pool ORDER BY n, doc_id) - 1) / 8) AS batch FROM o)
    SELECT source, CAST(pool AS BIGINT) AS pool, CAST(batch AS BIGINT) AS batch, count(*) AS n_rows, max(n) * count(*) - sum(n) AS padding FROM b GROUP BY ALL""")
def length_batches(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "source", "text"]).select("doc_id", "source", F.length("text").alias("n"))
    b = curriculum.length_batches(docs, "source", "doc_id", "n")
    return b.groupBy("source", "pool", "batch").agg(F.count("*").alias("n_rows"), (F.max("n") * F.count("*") - F.sum("n")).alias("padding"))


@query("""WITH RECURSIVE r AS (SELECT lang, length(text) AS w, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM documents),
    f AS (SELECT lang, i, 0 AS batch, 1 AS n, w AS width FROM r WHERE i = 1 UNION ALL
        SELECT r.lang, r.i, CASE WHEN f.n = 8 OR (f.n + 1) * greatest(f.width, r.w) > 20000 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.n = 8 OR (f.n + 1) * greatest(f.width, r.w) > 20000 THEN 1 ELSE f.n + 1 END,
        CASE WHEN f.n = 8 OR (f.n + 1) * greatest(f.width, r.w) > 20000 THEN r.w ELSE greatest(f.width, r.w) END FROM f JOIN r ON r.lang = f.lang AND r.i = f.i + 1)
    SELECT lang, CAST(batch AS BIGINT) AS batch, CAST(max(n) AS BIGINT) AS n, max(width) AS width FROM f GROUP BY lang, batch""")
def micro_batches(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "lang", "text"]).select("doc_id", "lang", F.length("text").alias("w"))
    return batches.micro_batches(docs, "lang", "doc_id", "w", 8, 20000)


@query("""SELECT source, doc_id, CAST(coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM documents""")
def token_offsets(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "source", "text"]).select("doc_id", "source", F.length("text").alias("n"))
    return curriculum.token_offsets(docs, "source", "doc_id", "n").select("source", "doc_id", "offset")


@query("""WITH t AS (SELECT conv_id, turn, len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS n FROM conversations), w AS (SELECT *, max(n) OVER (PARTITION BY conv_id) AS width FROM t)
    SELECT conv_id, turn, n, width, width - n AS padding FROM w""")
def pad_batch(spark, d):
    ids = F.transform(F.filter(F.split("text", " "), lambda x: x != ""), lambda x: F.length(x))
    c = table(spark, d, "conversations").select("conv_id", "turn", ids.alias("ids"))
    c = c.withColumn("width", F.max(F.size("ids")).over(Window.partitionBy("conv_id")))
    padded = curriculum.pad(F.col("ids"), F.col("width"), -1)
    return c.select("conv_id", "turn", F.size("ids").cast("long").alias("n"), F.size(padded).cast("long").alias("width"), F.size(F.filter(padded, lambda x: x == -1)).cast("long").alias("padding"))


# -- graphs and splits --------------------------------------------------------------------------

COMPONENT_SQL = """RECURSIVE k AS (SELECT doc_id, 't' || sha256(text) AS key FROM documents UNION SELECT doc_id, 'c' || source || (n_chars // 40)::VARCHAR FROM documents),
    e AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM k a JOIN k b USING (key)),
    r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y), c AS (SELECT x AS id, min(y) AS component FROM r GROUP BY x)"""


def components(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "source", "text", "n_chars"])
    keys = [F.concat(F.lit("t"), F.sha2("text", 256)), F.concat(F.lit("c"), F.col("source"), F.floor(F.col("n_chars") / 40).cast("string"))]
    return split.record_components(docs, "doc_id", keys)


@query(f"WITH {COMPONENT_SQL} SELECT id, component FROM c")
def connected_components(spark, d):
    return components(spark, d)


@query(f"""WITH {COMPONENT_SQL}, p AS (SELECT doc_id AS id, CASE doc_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS s FROM documents WHERE doc_id % 4 = 0),
    b AS (SELECT component, min(s) AS s FROM c LEFT JOIN p USING (id) GROUP BY component) SELECT id, component, ['train','validation','test'][coalesce(s, 1)] AS split FROM c JOIN b USING (component)""")
def split_extend(spark, d):
    comp = materialize(components(spark, d), "components")
    prior = table(spark, d, "documents", ["doc_id"]).where("doc_id % 4 = 0").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 5 == 0, "train").when(F.col("doc_id") % 5 == 1, "validation").otherwise("test").alias("split"))
    return split.extend_split(comp, prior)


JOINT_SQL = f"""{COMPONENT_SQL}, s0 AS (SELECT doc_id AS id, CASE WHEN h = 0 THEN 'validation' WHEN h = 1 THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::UBIGINT % 5 AS h FROM documents)),
    m AS (SELECT component, bool_or(coalesce(l.toxic = 1, false)) AS forced, min(list_position(['train','validation','test'], s0.split)) AS s FROM c JOIN s0 USING (id) LEFT JOIN labels l ON l.doc_id = c.id GROUP BY component)"""


def joint(spark, d):
    docs = table(spark, d, "documents", ["doc_id"])
    h = F.conv(F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 8), 16, 10).cast("long") % 5
    before = docs.select(F.col("doc_id").alias("id"), F.when(h == 0, "validation").when(h == 1, "test").otherwise("train").alias("split"))
    comp = materialize(components(spark, d), "components")
    after = split.extend_split(comp, before)
    forced = comp.join(table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("id")), "id", "left_semi").select("component").distinct().withColumn("forced", F.lit(True))
    after = after.join(forced, "component", "left").select("id", "component", F.when(F.col("forced"), "train").otherwise(F.col("split")).alias("split"))
    return before, after


@query(f"WITH {JOINT_SQL} SELECT id, component, CASE WHEN forced THEN 'train' ELSE ['train','validation','test'][s] END AS split FROM c JOIN m USING (component)")
def joint_partition(spark, d):
    return joint(spark, d)[1]


@query(f"WITH {JOINT_SQL} SELECT s0.split || '->' || CASE WHEN forced THEN 'train' ELSE ['train','validation','test'][s] END AS move, count(*) AS n FROM c JOIN m USING (component) JOIN s0 USING (id) GROUP BY 1")
def partition_moves(spark, d):
    before, after = joint(spark, d)
    return report.moves(before, after, "id", "split")


@query(f"""WITH {COMPONENT_SQL}, z AS (SELECT component, count(*) AS size FROM c GROUP BY component), o AS (SELECT *, row_number() OVER (ORDER BY size DESC, sha256('42|' || component::VARCHAR), component) AS i, sum(size) OVER () AS total, count(*) OVER () AS k FROM z),
    g AS (SELECT i, component, size, 1 AS s, CAST(total * 0.85 - size AS DOUBLE) AS d1, CAST(total * 0.1 AS DOUBLE) AS d2, CAST(total * 0.05 AS DOUBLE) AS d3, false AS e1, true AS e2, true AS e3 FROM o WHERE i = 1
      UNION ALL SELECT i, component, size, s, d1 - CASE WHEN s = 1 THEN size ELSE 0 END, d2 - CASE WHEN s = 2 THEN size ELSE 0 END, d3 - CASE WHEN s = 3 THEN size ELSE 0 END, e1 AND s <> 1, e2 AND s <> 2, e3 AND s <> 3 FROM
        (SELECT o.i, o.component, o.size, d1, d2, d3, e1, e2, e3, CASE WHEN o.k - o.i + 1 <= e1::INT + e2::INT + e3::INT THEN CASE WHEN e1 THEN 1 WHEN e2 THEN 2 ELSE 3 END WHEN d1 >= d2 AND d1 >= d3 THEN 1 WHEN d2 >= d3 THEN 2 ELSE 3 END AS s FROM g JOIN o ON o.i = g.i + 1))
    SELECT component, size, ['train','validation','test'][s] AS split FROM g""")
def leakage_safe_split(spark, d):
    return split.leakage_safe_split(components(spark, d))


# -- derivation and evaluation ------------------------------------------------------------------


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
    h AS (SELECT a.conv_id, a.turn, string_agg(b.role || ': ' || b.text, chr(10) ORDER BY b.i) AS past FROM n a JOIN n b ON a.conv_id = b.conv_id AND b.i BETWEEN a.i - 2 AND a.i - 1 GROUP BY a.conv_id, a.turn)
    SELECT n.conv_id, n.turn, sha256('system: conversation ' || n.conv_id::VARCHAR || chr(10) || coalesce(past || chr(10), '') || 'user: ' || n.text) AS prompt FROM n LEFT JOIN h ON h.conv_id = n.conv_id AND h.turn = n.turn WHERE n.role = 'user'""")
def render_prompt(spark, d):
    c = table(spark, d, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-2, -1)
    c = c.withColumn("past", F.collect_list(F.struct("role", F.col("text").alias("content"))).over(w)).where("role = 'user'")
    p = derive.render_prompt(F.concat(F.lit("conversation "), F.col("conv_id").cast("string")), F.col("past"), F.col("text"))
    return c.select("conv_id", "turn", F.sha2(derive.prompt_text(p), 256).alias("prompt"))


@query("""SELECT doc_id, name, value FROM (SELECT doc_id, 'quality' AS name, quality AS value FROM labels UNION ALL SELECT doc_id, 'toxic', toxic FROM labels) WHERE value <> 0""")
def unpivot_columns(spark, d):
    return derive.unpivot_columns(table(spark, d, "labels"), "doc_id", ["quality", "toxic"])


@query("""WITH f AS (SELECT p_partkey, CAST(0 AS INTEGER) AS field_no, 'brand' AS label, p_brand AS v FROM part UNION ALL SELECT p_partkey, 1, 'type', replace(p_type, ' ', ', ') FROM part),
    i AS (SELECT p_partkey, field_no, label, unnest(regexp_split_to_array(v, '\\s*,\\s*')) AS item, CAST(generate_subscripts(regexp_split_to_array(v, '\\s*,\\s*'), 1) - 1 AS INTEGER) AS item_no FROM f)
    SELECT p_partkey, field_no, item_no, label || ': ' || item AS line FROM i WHERE item <> ''""".replace("\\\\", "\\"))
def profile_lines(spark, d):
    p = table(spark, d, "part", ["p_partkey", "p_brand", "p_type"]).withColumn("p_type", F.replace("p_type", F.lit(" "), F.lit(", ")))
    return derive.profile_lines(p, "p_partkey", [("brand", "p_brand"), ("type", "p_type")])


@query("""SELECT s_suppkey, CASE WHEN v BETWEEN 1 AND 40 THEN v END AS level FROM (SELECT s_suppkey, coalesce(nullif(CAST(s_suppkey % 60 AS BIGINT), 0), 1) AS v FROM supplier)""")
def clamped_levels(spark, d):
    return table(spark, d, "supplier", ["s_suppkey"]).select("s_suppkey", derive.clamped_level(F.col("s_suppkey") % 60).alias("level"))


@query(r"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') AS t FROM documents),
    w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '')) AS w FROM t), c AS (SELECT doc_id, w, count(*) AS n FROM w GROUP BY doc_id, w), s AS (SELECT doc_id, sum(n) AS total, max(n) AS top FROM c GROUP BY doc_id)
    SELECT t.doc_id, CASE WHEN t = '' THEN 'empty_response' WHEN total >= 5 AND top / total > 0.4 THEN 'repetition_collapse' WHEN length(t) >= 10 AND len(list_distinct(string_split(t, ''))) / length(t) < 0.15 THEN 'character_collapse' END AS reason FROM t LEFT JOIN s USING (doc_id)""")
def degenerate_text(spark, d):
    return table(spark, d, "documents", ["doc_id", "text"]).select("doc_id", evaluate.degenerate(F.col("text")).alias("reason"))


GROUPS = [["the of", "of the"], ["and"], ["is", "was"]]


@query(r"""SELECT conv_id, turn, (contains(t, 'theof') OR contains(t, 'ofthe')) AND contains(t, 'and') AND (contains(t, 'is') OR contains(t, 'was')) AS ok FROM (SELECT *, regexp_replace(text, '\s+', '', 'g') AS t FROM conversations)""")
def required_groups(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", evaluate.required_groups(F.col("text"), GROUPS).alias("ok"))


@query(r"""WITH s AS (SELECT role, CASE WHEN length(text) < 40 THEN NULL WHEN contains(lower(text), 'the ') THEN 1.0 ELSE 0.0 END AS score FROM conversations)
    SELECT role, CASE WHEN score = 1.0 THEN 'PASS' WHEN score = 0.0 THEN 'FAIL' ELSE 'NEEDS_REVIEW' END AS verdict, count(*) AS n FROM s GROUP BY 1, 2""")
def eval_rollup(spark, d):
    score = F.when(F.length("text") < 40, F.lit(None)).when(F.contains(F.lower("text"), F.lit("the ")), 1.0).otherwise(0.0)
    return table(spark, d, "conversations").groupBy("role", evaluate.verdict(score).alias("verdict")).agg(F.count("*").alias("n"))


@query("""SELECT role, round(avg(r), 6) AS macro, round(sum(a) / sum(n), 6) AS micro FROM (SELECT role, length(regexp_replace(text, '[^a]', '', 'g')) AS a, length(text) AS n, length(regexp_replace(text, '[^a]', '', 'g')) / length(text) AS r FROM conversations WHERE text <> '') GROUP BY role""")
def macro_vs_micro_mean(spark, d):
    a, n = F.length(F.regexp_replace("text", "[^a]", "")), F.length("text")
    c = table(spark, d, "conversations").where("text <> ''").select("role", a.alias("a"), n.alias("n"))
    return c.groupBy("role").agg(F.round(F.avg(F.col("a") / F.col("n")), 6).alias("macro"), F.round(F.sum("a") / F.sum("n"), 6).alias("micro"))


@query("""WITH a AS (SELECT *, trim(coalesce(text, '')) AS t FROM documents), g AS (SELECT * FROM a WHERE t <> '' AND NOT contains(lower(text), 'secret')), u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM g) WHERE k = 1)
    SELECT CAST(0 AS INTEGER) AS step, 'read' AS stage, count(*) AS n FROM documents UNION ALL SELECT 1, 'not_empty', count(*) FROM a WHERE t <> '' UNION ALL SELECT 2, 'gate', count(*) FROM g UNION ALL SELECT 3, 'dedup', count(*) FROM u
    UNION ALL SELECT 4, 'train', count(*) FROM u WHERE ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::UBIGINT % 1000 > 1""")
def pipeline_funnel(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "text"])
    full = docs.where(~text.is_empty_text(F.col("text")))
    ok, _ = classify.gate(full, F.when(F.contains(F.lower("text"), F.lit("secret")), "secret"), "policy", ["doc_id"])
    once = dedup.first_rows(ok.withColumn("h", F.sha2("text", 256)), ["h"], ["doc_id"], ["doc_id"])
    once = materialize(once, "once")
    return report.funnel([("read", docs), ("not_empty", full), ("gate", ok), ("dedup", once), ("train", once.where(hashing.held_out_split(F.col("doc_id").cast("string")) == "train"))])


# -- extras on the relational tables: beyond the surveyed operators --------------------------------


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(avg(l_discount), 6) AS avg_disc FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, d):
    li = table(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_shipdate"]).where("l_shipdate <= timestamp '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc"))


@query("""SELECT n_name, count(DISTINCT o_orderkey) AS n_orders, count(*) AS n_lines FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def orders_by_nation(spark, d):
    c, o = table(spark, d, "customer", ["c_custkey", "c_nationkey"]), table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    li = table(spark, d, "lineitem", ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    x = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return x.groupBy("n_name").agg(F.count("*").alias("n_orders"), F.sum("lines").alias("n_lines"))


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def events_tumbling(spark, d):
    out = events.tumbling(table(spark, d, "events", ["ts", "event_type", "value"]))
    return out.select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query("""WITH l AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM l)
    SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def events_session(spark, d):
    return events.sessions(table(spark, d, "events", ["ts", "user_id"])).select("user_id", "start", "n")


from weftline.plans import audits as _audits  # noqa: E402, F401  (registers its queries)
from weftline.plans import chains as _chains  # noqa: E402, F401  (registers its queries)
from weftline.plans import lanes as _lanes  # noqa: E402, F401  (registers its queries)
from weftline.plans import lessons as _lessons  # noqa: E402, F401  (registers its queries)
from weftline.plans import parts as _parts  # noqa: E402, F401  (registers its queries)
from weftline.plans import records as _records  # noqa: E402, F401  (registers its queries)
from weftline.plans import registers as _registers  # noqa: E402, F401  (registers its queries)
from weftline.plans import scripts as _scripts  # noqa: E402, F401  (registers its queries)
from weftline.plans import sessions as _sessions  # noqa: E402, F401  (registers its queries)
from weftline.plans import substitution as _substitution  # noqa: E402, F401  (registers its queries)
from weftline.plans import texts as _texts  # noqa: E402, F401  (registers its queries)
from weftline.plans import vocabulary as _vocabulary  # noqa: E402, F401  (registers its queries)
