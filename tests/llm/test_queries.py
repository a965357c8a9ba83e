"""Each query on a small table against a plain version of what it does."""

import base64
import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from obsframe.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def crc(key, folds):
    return zlib.crc32(str(key).encode()) % folds


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    answer = con.execute(ORACLE[name])
    columns = [d[0] for d in answer.description]
    found = QUERIES[name](spark, DATA)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(answer.fetchall(), key=repr)


def test_bpe_equals_the_library(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = QUERIES["op1_byte_bpe"](spark, DATA).collect()
    assert len(found) == len(docs)
    for r in found:
        text = docs[r.doc_id].text or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_language_of_held_out_texts(spark, docs):
    found = QUERIES["op2_language_id"](spark, DATA).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)
    assert not any(r.lang_rejected for r in held)


def test_shards_are_of_near_equal_bytes(spark, docs):
    found = QUERIES["op3_sharding"](spark, DATA).collect()
    assert {r.doc_id for r in found} == set(docs) and len(found) == len(docs)
    loads, slots = Counter(), {}
    for r in found:
        data = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        loads[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(loads) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in found)
    assert max(loads.values()) - sum(loads.values()) / 40 <= largest


def test_simhash_against_all_pairs(spark, docs):
    prints = {}
    for key, row in docs.items():
        words = (row.text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[key] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    smallest = {k: k for k in prints}
    for _ in prints:
        before = dict(smallest)
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    smallest[a] = min(smallest[a], smallest[b])
        if smallest == before:
            break
    found = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in QUERIES["op4_simhash_dedup"](spark, DATA).collect()}
    assert found == {k: (prints[k], smallest[k]) for k in prints}


def test_toxicity_of_held_out_texts(spark, docs):
    folder = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = QUERIES["op5_toxicity"](spark, folder).collect()
    assert len(found) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (crc(r.doc_id, 4) == 2) for r in found)
    held = [(r.score, marks[r.doc_id]) for r in found if r.held_out and marks.get(r.doc_id) is not None]
    pairs = [(a, b) for a, x in held for b, y in held if x == 1 and y == 0]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) > 0.85


def test_packing_holds_every_token_once(spark, docs):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    found = QUERIES["op6_packing"](spark, DATA).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(docs)
    for key, parts in by_doc.items():
        ids = np.array(model.encode(docs[key].text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(r.length for r in found)
    assert len(by_sequence) <= 1.1 * total / 2048 + 2


def test_base_score_and_training_set(spark, docs):
    learns = [r for k, r in docs.items() if crc(k, 7) != 2]
    counts = Counter(w for r in learns for w in (r.text or "").encode().lower().split())
    n, v = sum(counts.values()) + len(learns), len(counts) + 1
    found = QUERIES["op9_lm_score"](spark, DATA).collect()
    assert len(found) == len(docs)
    for r in found:
        words = (docs[r.doc_id].text or "").encode().lower().split()
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [len(learns), *(counts[w] for w in words)])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (crc(r.doc_id, 7) == 2, len(words) + 1, n)
        assert r.n_known == sum(counts[w] > 0 for w in words) + 1
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0


def test_queries_read_whole_tables(spark):
    for name, table, key in (("op7_warc", "pages", "page_id"), ("op10_embedding_dedup", "embeddings", "vec_id")):
        rows = spark.read.parquet(f"{DATA}/{table}.parquet").select(key)
        assert QUERIES[name](spark, DATA).select(key).exceptAll(rows).isEmpty()
        assert rows.exceptAll(QUERIES[name](spark, DATA).select(key)).isEmpty()
    asked = spark.read.parquet(f"{DATA}/embeddings.parquet").where(F.col("vec_id") % 20 == 0).count()
    assert QUERIES["op8_hamming_topk"](spark, DATA).select("vec_id").distinct().count() == asked
