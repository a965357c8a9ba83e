"""The pipeline against a plain version of each stage."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from obsframe.llm import language, simhash, toxicity
from obsframe.llm.common import given, learnable

DATA = "/root/testdata/sf0.001"


def test_whole_run(spark):
    docs = given(spark, DATA, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    known = docs.where(learnable("doc_id"))
    texts = {k: r.text or "" for k, r in rows.items()}

    names, _, _, rejected = language.learn(known).predict(list(texts.values()))
    kept = [k for k, gone in zip(texts, rejected.tolist()) if not gone]
    clean = [k for k, r in rows.items() if r.text and r.lang]
    assert set(clean) <= set(kept)

    scorer = toxicity.learn(known, given(spark, DATA, "labels"))
    scores = dict(zip(kept, scorer.scores([texts[k] for k in kept]).tolist()))
    kept = [k for k in kept if scores[k] < 0.3]

    prints = dict(zip(kept, simhash.fingerprint_texts([texts[k].encode() for k in kept], 4, 42).tolist()))
    group = {k: k for k in kept}
    changed = True
    while changed:
        changed = False
        for a in kept:
            for b in kept:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and group[b] < group[a]:
                    group[a], changed = group[b], True
    kept = [k for k in kept if group[k] == k]

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    sizes = {k: len(model.encode(texts[k], add_special_tokens=False).ids) + 1 for k in kept}
    found = corpus_pipeline.run(spark, DATA)
    got = found.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("said")).collect()
    assert {r.doc_id: (r.n, r.said) for r in got} == {k: (n, n) for k, n in sizes.items()}
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_stages_return_the_columns_of_documents(spark):
    docs = given(spark, DATA, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).schema.names == docs.schema.names, name
