"""The queries opN_<name> of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tidelog.llm import bpe, decontaminate, html, language, linedup, lm, neardup, tokencount, tokenfile, topk
from tidelog.llm._shared import read


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_encode_decode(spark, sf_dir):
    return bpe.encode(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_token_counts(spark, sf_dir):
    return tokencount.token_counts(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), shingle=2, percent=80)


def op4_exact_top_k(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"), every=50, k=5)


def op5_line_dedup(spark, sf_dir):
    return linedup.deduplicate_lines(read(spark, sf_dir, "documents"), min_words=50).select("doc_id", "n_lines", "n_deleted", "text")


def op6_html_extraction(spark, sf_dir):
    return html.extract(read(spark, sf_dir, "pages"))


def op7_token_id_files(spark, sf_dir):
    return tokenfile.write_and_check(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)


def op8_language_id(spark, sf_dir):
    return language.identify(read(spark, sf_dir, "documents"), folds=4, fold=2)


def op9_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=13, share=20)


def op10_lm_scoring(spark, sf_dir):
    return lm.score_held_out(read(spark, sf_dir, "documents"), folds=7, fold=2)


def queries():
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


OP4_SQL = """WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.row <> c.row),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


#: Lower-cases A-Z alone.
LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = rf"""WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER_SQL}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM c JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * both_n >= 80 * (a.n + b.n - both_n)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
m AS (SELECT u, least(u, min(v)) AS m FROM r GROUP BY u)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.m, w.doc_id) AS component_id, w.doc_id = coalesce(m.m, w.doc_id) AS kept FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.u = w.doc_id"""

OP9_SQL = rf"""WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
t AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)),
x AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t))),
h AS (SELECT doc_id, item_id, i, n FROM x JOIN t USING (n, g)),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN p USING (doc_id) LEFT JOIN k USING (doc_id)"""


def oracle_sql():
    return {"op3_minhash_near_dedup": OP3_SQL, "op4_exact_top_k": OP4_SQL, "op9_benchmark_decontamination": OP9_SQL}
