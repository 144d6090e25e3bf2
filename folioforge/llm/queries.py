"""Queries op1 to op10 and the pipeline: thin digests of the operators' outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, linededup, quality, simhash, substring, token_store, topk, toxicity, warc, winnow
from .common import cut, settings

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _compact(digests: DataFrame) -> DataFrame:
    """A few digests a row: dealt anew into partitions of the advisory size, so that no task writes a tiny file."""
    return digests.hint("rebalance")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compact(quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnow.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return _compact(out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_pages(_table(spark, sf_dir, "pages"))
    return warc.read_pages(spark, folder).select(F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return _compact(out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.quantise(_table(spark, sf_dir, "embeddings"))
    found = topk.search(rows, rows.where("id % 50 = 0"), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compact(toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_store.write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path())
    digests = _compact(token_store.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", token_store.ids_crc32("ids").alias("ids_crc32")))
    with settings(spark, token_store.ROWS):  # they hold while the digests are written
        return cut(digests, "token-digests")


def queries() -> dict:
    import corpus_pipeline

    own = [op1_quality, op2_bpe, op3_decontaminate, op4_simhash, op5_line_dedup, op6_warc, op7_substring, op8_topk, op9_toxicity, op10_token_store]
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"[\x20\x09-\x0D]"

_OP3 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
ns AS (SELECT DISTINCT n FROM bl),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.p = bw.p),
pos AS (SELECT doc_id, count(DISTINCT pos_at) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos_at FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_OP5 = rf"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos_at FROM l),
k AS (SELECT *, {_LOWER.format(f"regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g')")} AS key FROM x),
o AS (SELECT key, min(doc_id) AS owner, max(doc_id) AS last FROM k WHERE length(key) >= 10 GROUP BY key)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE o.owner < k.doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos_at) FILTER (WHERE o.owner IS NULL OR o.owner = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN o ON k.key = o.key GROUP BY k.doc_id
"""

_OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS n, sha256(h) AS d FROM p),
f AS (SELECT d, min(page_id) AS first FROM s WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, s.d AS payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM s LEFT JOIN f ON s.d = f.d AND s.n >= 100
"""

_OP7 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT p, min({{'d': doc_id, 'i': i}}) AS first FROM s GROUP BY p HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos_at FROM s JOIN f USING (p) WHERE {{'d': doc_id, 'i': i}} > first),
a AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos_at FROM d),
r AS (SELECT a.doc_id, count(g.pos_at) AS n_removed, string_agg(word, ' ' ORDER BY a.pos_at) FILTER (WHERE g.pos_at IS NULL) AS kept FROM a LEFT JOIN g ON a.doc_id = g.doc_id AND a.pos_at = g.pos_at GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

_OP8 = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM e q, e c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    own = {"op3_decontaminate": _OP3, "op5_line_dedup": _OP5, "op6_warc": _OP6, "op7_substring": _OP7, "op8_topk": _OP8}
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
