"""NULLs, empty and long texts, ties, repeated rows, empty tables, and columns whose names clash."""

import hashlib
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from obsframe.llm import embedding_dedup, hamming, language, packing, sharding, simhash, toxicity, warc
from obsframe.llm import bpe, context_tree
from obsframe.llm.common import learnable

LONG = "one two three four five six seven. " * 3000
ROWS = [
    (1, "one two three four five six"), (2, "one two three four five six"), (3, None), (4, ""), (5, " \n\t "), (6, LONG),
    (7, "12 !! 34"), (8, "você idiot ÀÉ 😀"), (None, "one two three four five six"), (None, None), (9, "repeat me"), (9, "repeat me"),
]
CLASHES = ["key", "slot", "shard", "size", "nth", "rank", "bin", "class", "component_id", "fingerprint", "score", "ids", "length"]


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    return table.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("bigint"), **{c: F.lit("clash") for c in CLASHES}})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where(F.lit(False))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bpe(docs, none):
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = bpe.encode(docs, tokens, public_tokenizers.PATTERN, decode=True)
    assert found(out.select("doc_id", F.col("decoded").cast("string"))) == sorted(((k, t or "") for k, t in ROWS), key=repr)
    assert bpe.encode(none, tokens, public_tokenizers.PATTERN).collect() == []


def test_language(docs, none):
    out = language.identify(docs, language.learn(docs.where(learnable("doc_id")))).collect()
    assert len(out) == len(ROWS) and {"clash"} == {r.rank for r in out}
    for r in out:
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == blank and (not blank or r.lang_rejected and r.lang_score == 0)
    assert language.learn(none) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(none, None).collect() == []


def test_shards(docs, none):
    placed, maps = sharding.shard_by_bytes(docs, 3, slots=64)
    out = placed.collect()
    assert sorted((r.doc_id, r["size"]) for r in out if r.doc_id) == sorted((k, 16 + len((t or "").encode())) for k, t in ROWS if k)
    assert len(out) == len(ROWS) and {zlib.crc32(b"")} <= {r.text_crc32 for r in out}
    for shard in range(3):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert maps.groupBy("version").count().orderBy("version").collect() == [(1, 64), (2, 64)]
    assert sharding.shard_by_bytes(none, 3, slots=64)[0].collect() == []


def test_grown_map_only_fills_the_new_shard(spark):
    sizes = spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"), F.lit(10).cast("bigint").alias("bytes"), F.lit(1).alias("rows"))
    first = sharding.first_map(spark, 4, 64)
    before = {r.virtual_slot: r.shard for r in first.collect()}
    after = {r.virtual_slot: r.shard for r in sharding.edit_map(first, sizes, 5).collect()}
    assert {after[s] for s in before if after[s] != before[s]} == {4}
    assert max(list(after.values()).count(s) for s in range(5)) <= 13


def test_near_duplicates(docs, none):
    out = simhash.near_duplicates(docs)
    got = found(out.select("doc_id", "component_id"))
    blank, same = 3, 1
    expected = [(1, same), (2, same), (None, same), (3, blank), (4, blank), (5, blank), (None, blank), (6, 6), (7, 7), (8, 8), (9, 9), (9, 9)]
    assert got == sorted(expected, key=repr)
    assert simhash.near_duplicates(none).collect() == []


def test_toxicity(spark, docs, none):
    marks = spark.createDataFrame([(1, 0), (6, 0), (8, 1), (9, 1), (3, 1), (2, None), (7, 5)], "doc_id bigint, toxic int")
    out = toxicity.score(docs, toxicity.learn(docs, marks)).collect()
    assert len(out) == len(ROWS)
    assert all(0 <= r.toxic_score <= 1 and (r.toxic_score > 0 or not (r.text or "").split()) for r in out)
    assert toxicity.learn(docs, marks.where("toxic = 0")) is None
    assert {r.toxic_score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(none, None).collect() == []


def test_packing(docs, none):
    out = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)
    rows = out.collect()
    assert sorted(k or 0 for k in {(r.doc_id or 0) for r in rows}) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert sum(r.doc_tokens == 1 for r in rows) == 3
    made = {r.sequence_id: r.ids for r in packing.sequences(out).collect()}
    assert all(made[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in rows)
    assert sum(map(len, made.values())) == sum(r.length for r in rows) and max(map(len, made.values())) <= 2048
    assert packing.padding(out).first().tokens == sum(r.length for r in rows)
    assert packing.pack(none, public_tokenizers.path("byte_bpe_50k.json")).collect() == []


def test_warc(spark):
    page = "x" * 120
    rows = [(5, "u", page), (3, None, page), (None, "a b", page), (4, "v", "short"), (6, "v", "short"), (7, "w", None), (8, "w", ""), (3, "z", page)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit(1) for c in ("key", "first", "sha", "payload")})
    out = warc.archive_pages(pages.repartition(2)).collect()
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in out), key=repr)
    assert got == sorted([
        (5, "revisit", 3, 120), (3, "response", None, 120), (3, "response", None, 120), (None, "revisit", 3, 120),
        (4, "response", None, 5), (6, "response", None, 5), (7, "response", None, 0), (8, "response", None, 0),
    ], key=repr)
    assert {r.payload_digest for r in out if r.payload_bytes == 120} == {hashlib.sha256(page.encode()).hexdigest()}
    assert warc.archive_pages(pages.where("false")).collect() == []


def test_top_k(spark):
    rows = [(1, 0), (2, 0), (3, 0), (4, 1), (5, 3), (5, 3), (6, None), (None, 1), (7, -1)]
    codes = spark.createDataFrame(rows, "vec_id bigint, code bigint").withColumns({c: F.lit(9) for c in ("id", "asks", "r", "q")})
    out = hamming.top_k(codes, codes.where("vec_id in (2, 6, 7)"), 3)
    assert found(out) == [(2, 1, 1, 0), (2, 2, 3, 0), (2, 3, 4, 1), (7, 1, 5, 62), (7, 2, 4, 63), (7, 3, 1, 64)]
    assert len(hamming.top_k(codes, codes.where("vec_id = 1"), 50).collect()) == 5
    assert hamming.top_k(codes.where("false"), codes.where("false"), 3).collect() == []
    vectors = spark.createDataFrame([([1.0, -1.0, 2.0],), ([],), (None,), ([None, 1.0],), ([float("nan")],)], "v array<float>")
    assert [r[0] for r in vectors.select(hamming.sign_code("v")).collect()] == [5, None, None, None, None]


def test_scores(docs, none):
    out = context_tree.score(docs, learnable("doc_id", 7)).collect()
    assert len(out) == len(ROWS) and all(r.score < 0 and r.n_known >= 1 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (3, 4, 5)} == {1}
    nothing = context_tree.score(docs, F.lit(False)).collect()
    assert {r.base_score for r in nothing} == {0.0} and {r.train_tokens for r in nothing} == {0}
    assert all(abs(r.code_bits - 8) < 1e-4 for r in nothing)
    assert context_tree.score(none, learnable("doc_id", 7)).collect() == []


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (4, [0.0, 1.0]), (5, [0.0, 0.0]), (6, None), (7, []), (8, [nan, 1.0]),
        (9, [inf, 1.0]), (10, [None, 1.0]), (None, [0.0, 2.0]), (11, [-1.0, 0.0]), (12, [1.0]), (4, [0.0, 1.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({c: F.lit(0) for c in ("label", "key", "class", "size", "cell")})
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(vectors).collect()}
    alone = {(k, 0, k, True) for k in (5, 6, 7, 8, 9, 10, 11)}
    assert got == alone | {(k, 3, 1, k == 1) for k in (1, 2, 3, 12)} | {(4, 2, 4, True), (None, 2, 4, False)}
    assert embedding_dedup.near_duplicates(vectors.where("false")).collect() == []


def test_pipeline_stages(spark, docs, tmp_path):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (8, 1)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 7, 8, 9]
    only = docs.where("doc_id is null")
    assert corpus_pipeline.near_duplicate_stage(spark, only, str(tmp_path)).count() == 2
    named = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, str(tmp_path)).collect()}
    assert {1, 2, 6, 9} <= named and not {3, 4, 5, 7} & named
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.where("false"), str(tmp_path))
        assert out.collect() == [] and (name == "packing" or out.columns == docs.columns)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
