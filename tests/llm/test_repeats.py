"""Periodic runs against a search that tries every period at every word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsframe.llm import repeats
from obsframe.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plain_runs(words):
    smallest = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(6, 4 * period):
                smallest.setdefault((at, end + period), period)
            at = end + 1
    return sorted((start, end - start, period) for (start, end), period in smallest.items())


def random_text(rnd):
    size, kinds = rnd.choice([0, 1, 5, 6, 7, 20, 60, 150, 400]), rnd.choice([1, 2, 2, 3, 5, 30])
    text = [rnd.randrange(kinds) for _ in range(size)]
    if size and rnd.random() < 0.7:
        begin = rnd.randrange(size)
        period = 1 + (size - begin) // rnd.randint(3, 10)
        text = [text[i] if i < begin else text[begin + (i - begin) % period] for i in range(size)]
    return text


@pytest.mark.parametrize("chunk", [5, 1 << 18])  # with few candidates at a time, known runs spare multiples
def test_runs_of_random_texts(chunk, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    rnd = random.Random(chunk)
    for _ in range(120):
        texts = [random_text(rnd) for _ in range(rnd.randint(0, 8))]
        found = repeats.find_runs([np.array(t, np.int64) for t in texts])
        assert [[tuple(r) for r in own.tolist()] for own in found] == [plain_runs(t) for t in texts]


def test_grammar_tells_how_far_places_agree():
    rnd = np.random.default_rng(3)
    for kinds in (1, 2, 4, 50):
        text = np.concatenate([[-1], np.tile(rnd.integers(0, kinds, 90), 3), rnd.integers(0, kinds, 90), [-2]])
        a, b = (rnd.integers(1, 360, 300) for _ in range(2))
        a, b = a[a != b], b[a != b]
        grammar = repeats.Grammar(text)
        right, left = grammar.agree(a, b, 1), grammar.agree(a, b, -1)
        for x, y, r, n in zip(a.tolist(), b.tolist(), right.tolist(), left.tolist()):
            assert (text[x : x + r] == text[y : y + r]).all() and text[x + r] != text[y + r]
            assert (text[x - n + 1 : x + 1] == text[y - n + 1 : y + 1]).all() and text[x - n] != text[y - n]


def test_the_grammar_is_of_logarithmic_height():
    for text in (np.zeros(5000, np.int64), np.arange(5000), np.tile(np.arange(7), 700)):
        grammar = repeats.Grammar(np.concatenate([[-1], text, [-2]]))
        assert len(grammar.symbols) < 8 * len(text)


def test_query(spark):
    found = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, DATA).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert set(found) == set(docs) and any(r.n_runs for r in found.values())
    for key, text in docs.items():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        size, h = len(words), zlib.crc32(str(key).encode())
        if size > 3000:
            continue
        if h % 10 == 0 and size:
            begin = h // 10 % size
            period = 1 + (size - begin) // (3 + h // 10 % 8)
            words = [words[i] if i < begin else words[begin + (i - begin) % period] for i in range(size)]
        runs, r = plain_runs(words), found[key]
        cut = {i for start, length, period in runs for i in range(start + period, start + length)}
        lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
        assert r.n_runs == len(runs) and r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in cut)).hexdigest()
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])


def test_odd_rows(spark):
    rows = [
        (1, "a " * 6), (1, "a " * 6), (2, None), (3, ""), (4, " \t\n "), (None, "x y z w " * 4 + "x"), (5, "é\u00a0b\tc\x0b" * 5),
        (6, "blankfree" * 20000), (7, "on and on " * 20000), (8, "a a a a a b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("runs", "start", "longest", "collapsed")})
    out = repeats.collapse_runs(docs.repartition(3))
    assert out.columns == ["doc_id", "runs", "longest", "collapsed"]
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=repr)
    assert got == sorted([
        (1, [(0, 6, 1)], "a"), (1, [(0, 6, 1)], "a"), (2, [], ""), (3, [], ""), (4, [], ""), (None, [(0, 17, 4)], "x y z w"),
        (5, [(0, 10, 2)], "é\u00a0b c"), (6, [], "blankfree" * 20000), (7, [(0, 60000, 3)], "on and on"), (8, [], "a a a a a b"),
    ], key=repr)
    assert repeats.collapse_runs(docs.where("false")).collect() == []
