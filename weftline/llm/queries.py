"""The registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crosspolytope, exact_dedup, lines, minhash, mixing, packing, pseudolik, quality, resampling, tokenfiles, toxicity, warc, whitening

#: Parameter: the vocabulary file; it is read where a task runs.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_counts(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captured(table(spark, sf_dir, "pages"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudolik.corpus_scored(pseudolik.train(table(spark, sf_dir, "documents")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), k=3, percent=85)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.encoded_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


#: The links (x, y) of a query to the smallest id reachable from each row of ``nodes`` (id).
REACH = """reach AS (SELECT id AS x, id AS y FROM nodes UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
    comp AS (SELECT x AS id, min(y) AS component FROM reach GROUP BY x)"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it expresses and runs on whole small tables."""
    return {
        "op3_warc": """
            WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
            f AS (SELECT *, CASE WHEN strlen(h) >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first FROM p),
            u AS (SELECT coalesce(url, '') AS u, count(DISTINCT page_id) AS n FROM p GROUP BY 1)
            SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN first < page_id THEN first END AS refers_to, CASE WHEN page_id % 20 = 0 THEN u.n END AS url_captures
            FROM f JOIN u ON u.u = coalesce(f.url, '')""",
        "op4_embeddings": f"""
            WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
            g AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
            links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
            nodes AS (SELECT vec_id AS id FROM embeddings), {REACH}, n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
            SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component AS component_id, vec_id = component AS kept FROM embeddings JOIN comp ON comp.id = vec_id LEFT JOIN n ON n.x = vec_id""",
        "op8_minhash": f"""
            WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
            s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
            c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
            k AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * m >= 85 * (p.n + q.n - m)),
            links AS (SELECT x, y FROM k UNION SELECT y, x FROM k), nodes AS (SELECT doc_id AS id FROM documents), {REACH}
            SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component AS component_id, d.doc_id = component AS kept FROM documents d JOIN comp ON comp.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
        "op12_resampling": """
            WITH crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
            texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
            w AS (SELECT side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM texts),
            e AS (SELECT side, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM w),
            n AS (SELECT side, id, f, count(*) AS n FROM e GROUP BY ALL),
            d AS (SELECT f, hex(encode(f)) AS x FROM n GROUP BY f),
            b AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)),
                                            lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295::BIGINT) % 10000 AS bucket FROM d, crc),
            k AS (SELECT bucket, sum(CASE WHEN side = 0 THEN n ELSE 0 END) AS s, sum(CASE WHEN side = 1 THEN n ELSE 0 END) AS t FROM n JOIN b USING (f) GROUP BY bucket),
            a AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM k),
            g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM k, a),
            m AS (SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total FROM n JOIN b USING (f) JOIN g USING (bucket) WHERE side = 0 GROUP BY id),
            p AS (SELECT w.id AS doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features,
                         coalesce(total // n_features - CASE WHEN total % n_features < 0 THEN 1 ELSE 0 END, 0) AS weight,
                         ('0x' || sha256('7:' || w.id)[1:8])::BIGINT AS h FROM w LEFT JOIN m ON m.id = w.id WHERE side = 0),
            q AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM p),
            r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM q WHERE n_words >= 20)
            SELECT q.doc_id, q.n_features, q.weight, q.score, CASE WHEN r.rank <= r.n * 25 // 100 THEN r.rank END AS rank FROM q LEFT JOIN r ON r.doc_id = q.doc_id""",
    }
