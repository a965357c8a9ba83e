"""Models against plain versions of the same definition, on small texts."""

import math
from collections import Counter

import numpy as np
import pytest

from obsframe.llm import context_tree
from obsframe.llm.context_tree import Tree, before, grams, log_probabilities, stream


def plain_tree(texts, depth):
    """log10 of the probability of a byte after a context, by recursion over all contexts seen."""
    counts = Counter()
    for text in texts:
        line = b"\n" * depth + text
        for at in range(depth, len(line)):
            for d in range(depth + 1):
                counts[line[at - d : at], line[at]] += 1
    followers = {}
    for (context, byte), n in counts.items():
        followers.setdefault(context, Counter())[byte] += n

    def split(own, bits):
        """How often the next bit is 0 and 1, of the bytes that begin with ``bits``."""
        found = [0, 0]
        for byte, n in own.items():
            written = f"{byte:08b}"
            if written.startswith(bits):
                found[int(written[len(bits)])] += n
        return found

    def kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def weighted(context, bits):
        """(log of the node's weighted probability, share of its own estimate)."""
        own = kt(*split(followers[context], bits))
        longer = [c for c in followers if len(c) == len(context) + 1 and c[1:] == context] if len(context) < depth else []
        if not longer:
            return own, 1.0
        below = sum(weighted(c, bits)[0] for c in longer)
        below += kt(*split(followers[context] - sum((followers[c] for c in longer), Counter()), bits))
        return np.logaddexp(own, below) - math.log(2), 1 / (1 + math.exp(below - own))

    def chance(context, whole, bits):
        """Of a 1 after ``bits``."""
        zeros, ones = split(followers[context], bits)
        share = weighted(context, bits)[1]
        here = (ones + 0.5) / (zeros + ones + 1)
        if share == 1.0:
            return here
        deeper = whole[len(whole) - len(context) - 1 :]
        if deeper in followers:
            return share * here + (1 - share) * chance(deeper, whole, bits)
        return share * here + (1 - share) * 0.5  # nothing of it is left for contexts never seen

    def byte_log(whole, byte):
        written, total = f"{byte:08b}", 0.0
        for k in range(8):
            p = chance(b"", whole, written[:k])
            total += math.log10(p if written[k] == "1" else 1 - p)
        return total

    return byte_log


def test_context_tree_weights_as_the_recursion_does():
    depth = 3
    learned = [b"abra cadabra\n", b"abra abba\n", b"cad\n", b"\n"]
    data = np.frombuffer(b"".join(learned), np.uint8)
    lengths = np.array([len(t) for t in learned])
    keys, n = grams(data, lengths, depth)
    levels = []
    for d in range(depth + 1):
        level = {}
        for key, count in zip(keys.tolist(), n.tolist()):
            level.setdefault(key >> 8 & (1 << 8 * d) - 1, np.zeros(256, np.int64))[key & 255] += count
        levels.append(level)
    tree = Tree(levels)
    plain = plain_tree([t for t in learned], depth)
    for text in (b"abra\n", b"dab cab\n", b"\n", b"bbbb\n"):
        expected = sum(plain((b"\n" * depth + text)[at : at + depth], text[at]) for at in range(len(text)))
        known = set(b"".join(learned))
        assert set(text) <= known
        got = log_probabilities(np.frombuffer(text, np.uint8), np.array([len(text)]), tree.parts())[0]
        assert got == pytest.approx(expected, abs=2e-4 * len(text))


def test_words_of_any_length_are_counted(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "MOST_BYTES", 4000)
    long = "z" * 3000
    rows = [(n, f"{long}{n % 3} a b {'ab' * (n % 5)}") for n in range(40)] + [(99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = {r.doc_id: r for r in context_tree.score(docs, docs.doc_id % 2 == 0).collect()}
    learned = [t.split() for k, t in rows if t and k % 2 == 0]
    counts = Counter(w for t in learned for w in t)
    total, kinds = sum(counts.values()) + 20, len(counts) + 1
    for key, text in rows:
        words = (text or "").split()
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words) + math.log10(21 / (total + kinds + 1))
        assert found[key].base_score == pytest.approx(base, rel=1e-9)
        assert found[key].n_known == sum(counts[w] > 0 for w in words) + 1


def test_rare_contexts_are_nodes_at_any_size(spark):
    """Contexts seen once among 300,000 bytes and more: each has its own estimate, as in the recursion."""
    rows = [(n, "a" * 60_000) for n in range(6)] + [(6, "Xyz qrst"), (7, "cab baz qrs"), (8, None), (9, "xyz qrst"), (10, "qrs! é ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learns = docs.doc_id < 9
    lines = [b" ".join((t or "").encode().lower().split()) + b"\n" for _, t in rows]
    depth = 4
    plain = plain_tree(lines[:9], depth)
    found = {r.doc_id: r.score for r in context_tree.score(docs, learns, depth=depth).collect()}
    assert len(found) == len(rows)
    for key in range(6, 11):
        whole = b"\n" * depth + lines[key]
        expected = sum(plain(whole[at - depth : at], whole[at]) for at in range(depth, len(whole)))
        assert found[key] == pytest.approx(expected, abs=1e-4)
