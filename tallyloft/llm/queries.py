"""Registered queries of the corpus operators, ``opN_<name>``, and their SQL where SQL can express them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloft.llm import (
    chat, decontaminate, embeddings, exact_dedup, html_text, langid, mix, pii, prefix_trie, quality, simhash, token_alignment, url_filter,
)
from tallyloft.llm.common import table

# The folder of the tokenizers' files on the driver, which hands them to the tasks.
TOKENIZERS = "/opt/tokenizers"
# The key of the registered query; real runs pass one that is kept secret.
PII_KEY = "an example, not a secret"
# The rules that the URL query judges by.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", "url", html_text.extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repaired(table(spark, sf_dir, "conversations"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = langid.learn(docs.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), langid.guess(model, docs, F.col("text")).alias("guess"))
    return found.select("doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), "guess.score", "guess.cross_entropy", "guess.rejected")


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mix.plan(table(spark, sf_dir, "documents"))
    return mix.taken(planned, mix.draws(planned)).withColumnRenamed("id", "doc_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replaced(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_replaced")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.DigestIndex(spark).add(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 toxic, 1 poor, 2 good. ``keep``: likely enough not toxic."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).when(F.col("quality") == 0, 1)
    grader = quality.learn(docs, labels.select("doc_id", grade.alias("grade")))
    found = docs.select("doc_id", quality.graded(grader, docs, F.col("text")).alias("g"))
    return found.select("doc_id", "g.expected_grade", quality.tail(F.col("g"), grader, 2).alias("p_good"),
                        (quality.tail(F.col("g"), grader, 1) >= quality.KEEP_PROBABILITY).alias("keep"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), name="found")
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("found")).alias("contaminated"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules, ["page_id"])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), group=100, most=6)


def op12_token_alignment(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    a, b = Path(tokenizers, "byte_bpe_50k.json").read_text(encoding="utf-8"), Path(tokenizers, "piece_bpe_32k.model").read_bytes()
    return token_alignment.aligned(table(spark, sf_dir, "documents"), a, b).withColumnRenamed("id", "doc_id")


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least_cosine=0.98).withColumnRenamed("id", "vec_id")


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_chat": op2_chat,
    "op3_language_id": op3_language_id,
    "op4_mix": op4_mix,
    "op5_pii": op5_pii,
    "op6_simhash": op6_simhash,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality": op8_quality,
    "op9_decontaminate": op9_decontaminate,
    "op10_url_filter": op10_url_filter,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_alignment": op12_token_alignment,
    "op13_embedding_dedup": op13_embedding_dedup,
}

ORACLES = {
    "op7_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        WINDOW g AS (PARTITION BY text_sha256)""",
    "op9_decontaminate": r"""
        WITH d AS (
          SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (
          SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        c AS (SELECT item_id, w, least(len(w), 13) AS k FROM b WHERE len(w) > 0),
        s AS (SELECT item_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM c),
        windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1 : i + k], ' ') AS t FROM s),
        g AS (SELECT r, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
        h AS (SELECT r, i, item_id, k FROM (SELECT r, i, k, array_to_string(w[i + 1 : i + k], ' ') AS t FROM g) JOIN windows USING (k, t)),
        n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r),
        m AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY r)
        SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
        FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)""",
    "op10_url_filter": r"""
        WITH cut AS (
          SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS r FROM pages),
        rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        fits AS (
          SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM cut JOIN rules
          ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM cut LEFT JOIN fits USING (r)""",
    "op11_prefix_trie": r"""
        WITH bits AS (SELECT list(crc ORDER BY i) AS t FROM (
            SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc FROM range(256) AS b(i))),
        own AS (
          SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST,
            sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        hashed AS (
          SELECT c, turns, (xor(list_reduce([4294967295] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
            lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 6)::BIGINT AS h FROM own, bits),
        rebuilt AS (
          SELECT x.c, coalesce(b.turns[1:x.h], []) || x.turns[x.h + 1:] AS turns FROM hashed x LEFT JOIN own b ON b.c = x.c - x.c % 100),
        starts AS (SELECT c, d, turns[1:d] AS k, d = len(turns) AS ends FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
        nodes AS (
          SELECT k, d, min(c) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS e
          FROM starts GROUP BY k, d),
        kids AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
        weighed AS (
          SELECT k, d, conv_id, nodes.n, e, coalesce(kids.n, 0) AS n_children, CASE WHEN d > 0 THEN (nodes.n - 1) * length(k[d].t) ELSE 0 END AS saved
          FROM nodes LEFT JOIN kids USING (k)),
        sums AS (
          SELECT k[1:a] AS k, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
          FROM (SELECT k, saved, n_children, unnest(range(0, d + 1)) AS a FROM weighed) GROUP BY 1)
        SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n AS n_convs, w.n_children, n_leaves, saved_tokens, w.e AS ends_sha256
        FROM weighed w JOIN sums ON sums.k = w.k LEFT JOIN nodes p ON w.d > 0 AND p.d = w.d - 1 AND p.k = w.k[1:w.d - 1]""",
    "op13_embedding_dedup": r"""
        WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
        sound AS (
          SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS MATERIALIZED (
          SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT reach.a AS r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
        n AS (SELECT a AS r, count(*) AS n FROM links GROUP BY 1)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM v JOIN least USING (r) LEFT JOIN n USING (r)""",
}
