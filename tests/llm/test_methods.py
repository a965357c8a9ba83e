"""The parts of the operators that need no Spark."""

import io
import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from obsframe.llm import bpe, context_tree, embedding_dedup, hamming, language, packing, simhash, toxicity, warc
from obsframe.llm.pretokens import Words, by_matches

TOKENS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
MERGES = bpe.Merges(TOKENS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: r for r, t in enumerate(TOKENS)}, special_tokens={})
MODEL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
MODEL.encode_special_tokens = True
ODD = st.text(alphabet="aab   'stéñ\n\t0一😀<|endoftext|>zq!!\x1c\x85\xa0\0", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, max_size=5))
def test_ids_are_those_of_the_libraries(texts):
    texts += ["", " ", "a" * 300, "aaaa bb" * 9]
    words = Words(by_matches(public_tokenizers.PATTERN, lambda found: bpe.replay([w.encode() for w in found], MERGES)))
    found = words.ids(texts)
    assert [f.tolist() for f in found] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [MERGES.decode(f) for f in found] == [t.encode() for t in texts]
    words = Words(lambda found: packing.encode_words(MODEL, packing.octets(MODEL), found))
    assert [f.tolist() for f in words.ids(texts)] == [MODEL.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.integers(1, 30), max_size=12))
def test_plan_places_every_piece_within_capacity(histogram):
    rows = packing.plan(histogram, 256, 16)
    by_bin, load = {}, {}
    for size, first, end, start, times in rows:
        by_bin.setdefault(size, []).append((first, end))
        for rank in range(first, end):
            sequence = start + (rank - first) % times
            load[sequence] = load.get(sequence, 0) + size * 16
    for size in {-(-n // 16) for n in histogram}:
        spans = sorted(by_bin[size])
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert spans[-1][1] == sum(c for n, c in histogram.items() if -(-n // 16) == size)
    assert sorted(load) == list(range(len(load))) and all(v <= 256 for v in load.values())


def test_plan_fills_sequences():
    lengths = np.random.default_rng(4).integers(1, 257, 3000)
    rows = packing.plan(dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True)))), 256, 4)
    assert max(r[3] + r[4] for r in rows) <= 1.03 * lengths.sum() / 256 + 2


def test_majority_of_many_hashes():
    rng = np.random.default_rng(3)
    counts = np.array([0, 1, 255, 256, 1000, 3, 0])
    hashes = rng.integers(0, 2**64, counts.sum(), dtype=np.uint64)
    found, at = simhash.majority(hashes, counts), 0
    for value, n in zip(found.tolist(), counts.tolist()):
        some = hashes[at : at + n].tolist()
        assert value == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in some) > n)
        at += n


def test_ring_links_exactly_what_is_near():
    ring, rng = simhash.Ring(4), random.Random(5)
    for distance in range(8):
        for _ in range(40):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), distance):
                b ^= 1 << bit
            met = [s for s in range(len(ring.starts)) if (a ^ b) & int(ring.mask(s)) == 0]
            linked = any(ring.linked(s, np.array([a ^ b], np.uint64))[0] for s in met)
            assert linked == (distance <= 4)


def test_top_k_of_a_block():
    rng = np.random.default_rng(1)
    codes = rng.integers(-(2**63), 2**63 - 1, 300)
    codes[10:20] = codes[0]
    tree = hamming.MultiIndex(np.arange(300), codes)
    for q in range(0, 300, 29):
        far = sorted(((int(codes[q]) ^ int(c)) & (2**64 - 1)).bit_count() * 1000 + n for n, c in enumerate(codes.tolist()) if n != q)
        assert tree.search(int(codes.view(np.uint64)[q]), 7, q) == [(f // 1000, f % 1000) for f in far[:7]]
    assert len(tree.search(5, 1000, None)) == 300
    assert hamming.MultiIndex(np.empty(0, np.int64), np.empty(0, np.int64)).search(5, 3, None) == []


def test_context_tree_is_a_distribution():
    data, lengths = context_tree.stream([[b"abra", b"cadabra"] * 40, [], [b"x"] * 90])
    keys, counts = context_tree.grams(data, lengths, 3)
    levels = []
    for d in range(4):
        levels.append({})
        for k, n in zip(keys.tolist(), counts.tolist()):
            levels[d].setdefault(k >> 8 & ((1 << 8 * d) - 1), np.zeros(256, np.int64))[k & 255] += n
    tree = context_tree.Tree(levels)
    every = 256 - (tree.symbol < tree.bits.shape[1] - 1).sum()
    total = (10.0 ** tree.bits[:, :-1].astype(float)).sum(axis=1) + every * 10.0 ** tree.bits[:, -1].astype(float)
    assert np.allclose(total, 1, atol=1e-4)
    seen, other = (context_tree.log_probabilities(*context_tree.stream([w]), tree.parts())[0] for w in ([b"abra"] * 5, [b"qqqq"] * 5))
    assert seen > other


def test_krichevsky_trofimov_estimate():
    for a, b in ((0, 0), (1, 0), (3, 2), (700, 12)):
        exact = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        assert context_tree.estimate(np.array([float(a)]), np.array([float(b)]))[0] == pytest.approx(exact, abs=1e-7)


def test_letters_of_texts():
    symbols, counts = language.letters(["Hé, a!! b", " ", "", "x", "..y  ", "\0z"], language.letter_table())
    assert "".join(map(chr, symbols)) == " hé a b  x  y  z " and counts.tolist() == [8, 0, 0, 3, 3, 3]


def test_kneser_ney_sums_to_one():
    models = language.Models({"a": ["banana bandana"], "b": ["oui non oui"]}, language.letter_table())
    size = int(models.symbol.max()) + 1
    for context in ("ban", "xyz", "  o"):
        codes = [int(models.symbol[ord(c)]) for c in context]
        keys = np.array([codes[0] << 48 | codes[1] << 32 | codes[2] << 16 | s for s in range(size)], np.uint64)
        assert np.allclose(models.probability(keys, 4).sum(axis=0), 1, atol=1e-5)


def test_gru_gradients():
    rng, h = np.random.default_rng(0), toxicity.HIDDEN
    vocabulary = toxicity.Vocabulary()
    windows, counts = vocabulary.windows(["ab cd ef ab gh " * 9, "cd xx ab", ""])
    assert counts.tolist() == [2, 1, 0]
    p = {"attend": rng.normal(0, 1, 2 * h), "out": rng.normal(0, 1, 2 * h), "bias": np.zeros(1)}
    for side in ("left", "right"):
        p |= {f"w_{side}": rng.normal(0, 0.5, (toxicity.INPUTS, 3 * h)), f"u_{side}": rng.normal(0, 0.5, (h, 3 * h)), f"b_{side}": rng.normal(0, 0.5, 3 * h)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    x = rng.normal(0, 1, (len(vocabulary.number), toxicity.INPUTS)).astype(np.float32)
    y = np.array([1, 0, 1], np.float32)

    def loss(q):
        return float(np.mean(np.log1p(np.exp(-toxicity.logits(q, *toxicity.both(q, x), windows).astype(float) * (2 * y - 1)))))

    g = toxicity.gradients(p, x, windows, y, np.ones(3, np.float32))
    for name in ("u_left", "u_right", "w_left", "w_right", "attend", "out", "b_left"):
        at = tuple(int(rng.integers(0, n)) for n in p[name].shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert g[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=0.02, abs=2e-4)


def test_records_are_read_as_written_and_checked():
    payloads = [b"", b"x" * 200_000, "é\r\n\r\n".encode(), bytes(range(256))]
    archive = b"".join(
        warc.encode_record(warc.record_id(n), f"http://a/{n} é\r\nX: y", p, warc.digest(p), len(p), None) for n, p in enumerate(payloads)
    ) + warc.encode_record(warc.record_id(None), None, b"", warc.digest(b"abc"), 3, warc.record_id(1))
    found = [warc.read_record(m) for m in warc.members(io.BytesIO(archive))]
    assert [f[2] for f in found] == [*payloads, None] and found[-1][1] == 3
    assert warc.key_of(found[-1][0]["warc-refers-to"]) == 1 and warc.key_of(found[-1][0]["warc-record-id"]) is None
    for broken in (archive[:-5], archive[:400] + b"zz" + archive[402:], archive[10:]):
        with pytest.raises(warc.WarcError):
            [warc.read_record(m) for m in warc.members(io.BytesIO(broken))]
    wrong = warc.encode_record(warc.record_id(1), None, b"abc", warc.digest(b"abd"), 3, None)
    with pytest.raises(warc.WarcError):
        [warc.read_record(m) for m in warc.members(io.BytesIO(wrong))]


def test_cells_lose_no_partner():
    rng = np.random.default_rng(2)
    rows = embedding_dedup.unit(rng.normal(0, 1, (400, 5)))
    centres = embedding_dedup.fit_cells(rows, 9)
    home = (rows @ centres.T).argmax(axis=1)
    can = embedding_dedup.reachable(rows, home, centres, 0.9)
    i, j = np.nonzero(rows @ rows.T >= 0.9)
    assert can[i, home[j]].all() and not can.all()
    pairs = set()
    for a, b in embedding_dedup.compare(rows, None, 0.9):
        pairs |= set(zip(a.tolist(), b.tolist()))
    assert pairs == {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a < b}
