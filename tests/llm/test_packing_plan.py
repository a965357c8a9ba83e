"""The plan comes from columns that the knapsack prices, and words are known within a bound of bytes."""

import itertools

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from obsframe.llm import packing, pretokens
from obsframe.llm.pretokens import Words

PATH = public_tokenizers.path("byte_bpe_50k.json")


def lengths_of(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    rows = packing.cut(docs, PATH, 1).groupBy("length").count().collect()
    return {r.length: r["count"] for r in rows}


def taken(rows):
    return max(r[3] + r[4] for r in rows)


@pytest.mark.parametrize("folder,most", [("sf0.001", 96), ("sf0.01", 482)])
def test_sequences_of_documents(spark, folder, most):
    histogram = lengths_of(spark, folder)
    assert taken(packing.plan(histogram)) <= most
    sizes = np.array(sorted(histogram))
    patterns, amount = packing.solve(sizes, np.array([histogram[s] for s in sizes.tolist()]), 2048)
    assert np.floor(amount + 1e-9).sum() >= 0.4 * most  # sequences that are whole amounts of columns


def test_columns_are_priced(monkeypatch):
    """A case in which full patterns mislead: the program needs columns that its dual values find."""
    asked = []
    real = packing.price
    monkeypatch.setattr(packing, "price", lambda *a: asked.append(real(*a)) or asked[-1])
    sizes, demand = np.array([3, 5, 7, 9, 16]), np.array([120, 333, 201, 77, 45])
    patterns, amount = packing.solve(sizes, demand, 32)
    assert (patterns @ sizes <= 32).all() and np.allclose(amount @ patterns, demand)
    sizes, demand = np.array([6, 7, 11, 12, 13]), np.array([10, 200, 150, 90, 300])
    patterns, amount = packing.solve(sizes, demand, 32)
    assert np.allclose(amount @ patterns, demand) and asked and asked[-1][0] <= 1.2


def test_program_reaches_the_least_amount():
    """Against all patterns of small cases: no dual solution is better than what was found."""
    rnd = np.random.default_rng(7)
    for _ in range(40):
        sizes = np.sort(rnd.choice(np.arange(3, 20), rnd.integers(1, 6), replace=False))
        demand = rnd.integers(1, 400, len(sizes))
        patterns, amount = packing.solve(sizes, demand, 24)
        assert np.allclose(amount @ patterns, demand, atol=1e-6) and (amount >= 0).all()
        basis = np.linalg.lstsq(patterns.astype(float), np.ones(len(patterns)), rcond=None)[0]
        every = np.array([p for p in itertools.product(*[range(24 // s + 1) for s in sizes.tolist()]) if 0 < np.dot(p, sizes) <= 24])
        worth = (every @ basis).max()
        least = max(amount.sum() / max(worth, 1), (sizes * demand).sum() / 24)
        assert amount.sum() <= least * (1 + packing.GAP + 1e-6) or np.ceil(amount.sum() - 1e-6) <= np.ceil(least - 1e-6)


@pytest.mark.parametrize("histogram", [
    {3: 50_000}, {1025: 100, 700: 30, 3: 10}, {n: 50 for n in range(1, 2049)}, {n: 9 for n in range(600, 2049)}, {1000: 1000, 1049: 700, 513: 99}, {2048: 5}, {1: 1},
])
def test_every_piece_has_a_place(histogram):
    rows = packing.plan(histogram)
    load = np.zeros(taken(rows), np.int64)
    for size, first, end, start, times in rows:
        np.add.at(load, start + (np.arange(first, end) - first) % times, size)
    assert load.max() <= 2048 and load.min() > 0 and load.sum() == sum(k * n for k, n in histogram.items())
    for size, n in histogram.items():
        spans = sorted((r[1], r[2]) for r in rows if r[0] == size)
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in itertools.pairwise(spans))


def test_texts_without_blanks_are_not_kept(monkeypatch):
    monkeypatch.setattr(pretokens, "MOST_BYTES", 2000)
    model = Tokenizer.from_file(PATH)
    sizes = packing.octets(model)
    words = Words(lambda found: packing.encode_words(model, sizes, found))
    rnd = np.random.default_rng(1)
    for turn in range(12):
        texts = ["".join(map(chr, rnd.integers(0x4E00, 0x5000, 5000))), f"a word {turn} and a word", "x" * 100_000, "", " ", f"tail{turn} " + "y" * 70]
        found, counts = words.of(texts)
        assert counts.sum() == len(found)
        assert [ids.tolist() for ids in np.split(found, np.cumsum(counts)[:-1])] == [model.encode(t, add_special_tokens=False).ids for t in texts]
        assert max(map(len, words.number), default=0) <= pretokens.LONGEST
        assert len(words.number) == len(words.ends) and len(words.flat) == (words.ends[-1] if len(words.ends) else 0)
        assert words.bytes < 2500
    assert "".join(words.number)  # short words of blocks with long ones are known


def test_ids_by_rank_are_those_of_the_tokenizer():
    text = open(PATH, encoding="utf-8").read()
    ranks = packing.ranked(text)
    own = tiktoken.Encoding("own", pat_str=packing.MATCHES, mergeable_ranks=ranks, special_tokens={})
    model = Tokenizer.from_file(PATH)
    model.encode_special_tokens = True
    rnd = np.random.default_rng(3)
    signs = [*"ab'sS tTdD\n\r\t 1²é\u0301\u00a0\u2003\u3000中😀ß%*", "'ll", "'re", "  ", "<|endoftext|>", *model.get_added_tokens_decoder()]
    signs = [s if isinstance(s, str) else model.id_to_token(s) for s in signs]
    for _ in range(3000):
        sample = "".join(rnd.choice(signs, rnd.integers(0, 30)))
        assert own.encode_ordinary(sample) == model.encode(sample, add_special_tokens=False).ids
    long = "x" * 300_000 + "".join(map(chr, rnd.integers(0x4E00, 0x9000, 50_000)))
    assert own.encode_ordinary(long) == model.encode(long, add_special_tokens=False).ids


def test_other_tokenizers_have_no_ranks():
    import json

    found = json.loads(open(PATH, encoding="utf-8").read())
    assert packing.ranked(json.dumps(found | {"normalizer": {"type": "NFC"}})) is None
    assert packing.ranked(json.dumps(found | {"pre_tokenizer": {"type": "Whitespace"}})) is None
    merges = found["model"]["merges"]
    assert packing.ranked(json.dumps(found | {"model": found["model"] | {"merges": [merges[1], merges[0], *merges[2:]]}})) is None


def test_words_give_the_same_pieces(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    by_rank = sorted(map(tuple, packing.cut(docs, PATH, 1).select(*columns).collect()))
    monkeypatch.setattr(packing, "ranked", lambda text: None)
    assert sorted(map(tuple, packing.cut(docs, PATH, 1).select(*columns).collect())) == by_rank
