"""One query per operator, over its whole table, and SQL for those that SQL can express."""

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm import embedding_dedup, toxicity
from obsframe.llm.bpe import encode, read_ranks
from obsframe.llm.common import given, held_out, learnable
from obsframe.llm.context_tree import score
from obsframe.llm.hamming import sign_code, top_k
from obsframe.llm.language import identify, learn
from obsframe.llm.packing import pack
from obsframe.llm.repeats import collapse_runs
from obsframe.llm.sharding import shard_by_bytes
from obsframe.llm.simhash import near_duplicates
from obsframe.llm.site_tree import extract
from obsframe.llm.vector_codes import code_vectors
from obsframe.llm.warc import archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = shard_by_bytes(given(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


@query
def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(given(spark, sf_dir, "documents"), words=4, distance=4, seed=42)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(given(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE["op7_warc"] = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), m AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM m
"""


@query
def op8_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = given(spark, sf_dir, "embeddings").select("vec_id", sign_code("embedding").alias("code"))
    found = top_k(codes, codes.where(F.col("vec_id") % 20 == 0), 10)
    return found.select("vec_id", "rank", F.col("neighbour").alias("neighbour_id"), "distance")


ORACLE["op8_hamming_topk"] = """
WITH c AS (
    SELECT vec_id, array_to_string(list_transform(range(64), lambda i:
        CASE WHEN embedding[i + 1] > 0 THEN '1' ELSE '0' END), '')::BIT AS code
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding[:64], lambda v: v IS NULL OR isnan(v))) = 0
), p AS (
    SELECT q.vec_id, r.vec_id AS neighbour_id, CAST(bit_count(xor(q.code, r.code)) AS INTEGER) AS distance
    FROM c q JOIN c r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id
), n AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM p
)
SELECT vec_id, rank, neighbour_id, distance FROM n WHERE rank <= 10
"""


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(given(spark, sf_dir, "embeddings"), 0.9)


ORACLE["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), r AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON a = vec_id
"""


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = encode(given(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN, decode=True)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(given(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    found = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    models = learn(docs.where(learnable("doc_id")))
    found = identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_rejected")


@query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(given(spark, sf_dir, "documents"), learnable("doc_id", 7))
    return found.select(
        "doc_id", held_out("doc_id", 7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.learn(docs.where(learnable("doc_id")), given(spark, sf_dir, "labels"))
    found = toxicity.score(docs, scorer)
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def planted(key: int | None, words: int) -> np.ndarray | None:
    """Word numbers to read: one document in ten, by hash of its id, repeats a stretch up to its end."""
    h = 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not words:
        return None
    g = h // 10
    begin = g % words
    period = 1 + (words - begin) // (3 + g % 8)
    at = np.arange(words)
    return np.where(at < begin, at, begin + (at - begin) % period)


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(given(spark, sf_dir, "documents"), edit=planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("longest.length * 1000 div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = code_vectors(given(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    known = hashlib.sha256(books.text().encode()).hexdigest() if books else None
    return coded.select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(known).cast("string").alias("codebooks_sha256"),
    )


def nearest_sql(books: str) -> str:
    """Per vector and part the nearest entry of a table (part, entry, e), as distance * 64 + entry."""
    return f"""
    SELECT p.vec_id, p.part, any_value(p.x) AS x,
           min(list_sum(list_transform(list_zip(p.x, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + c.entry) AS m
    FROM p JOIN {books} c USING (part) GROUP BY p.vec_id, p.part"""


def moved_sql(books: str, near: str) -> str:
    """The entries after a round; a sum less its non-negative remainder is divided without rounding."""
    return f"""
    SELECT c.part, c.entry, coalesce(n.e, c.e) AS e FROM {books} c LEFT JOIN (
        SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS e FROM (
            SELECT part, m % 64 AS entry, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n
            FROM {near}, (SELECT unnest(range(1, 5)) AS i) GROUP BY ALL
        ) GROUP BY part, entry
    ) n USING (part, entry)"""


ORACLE["op12_vector_codes"] = f"""
WITH k AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
    SELECT vec_id, part::BIGINT AS part, v[part * 4 + 1 : part * 4 + 4] AS x FROM k, (SELECT unnest(range(16)) AS part)
), c0 AS MATERIALIZED (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS e FROM p
    QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 64
), a1 AS MATERIALIZED ({nearest_sql("c0")}), c1 AS MATERIALIZED ({moved_sql("c0", "a1")}),
a2 AS MATERIALIZED ({nearest_sql("c1")}), c2 AS MATERIALIZED ({moved_sql("c1", "a2")}),
a3 AS MATERIALIZED ({nearest_sql("c2")}),
r AS (SELECT vec_id, string_agg(printf('%02x', m % 64), '' ORDER BY part) AS code, sum(m // 64)::BIGINT AS error FROM a3 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM c2) AS codebooks_sha256
FROM r JOIN k USING (vec_id)
"""


@query
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(given(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
