"""Codes of vectors against a search that compares with every entry."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsframe.llm import vector_codes as codes


def plain(vectors, entries, parts, rounds, scale):
    """Codes, errors and codebooks of {key: vector}, by comparing every part with every entry."""
    numbers = np.floor(scale * np.array([vectors[k] for k in sorted(vectors)])).astype(int)
    split = numbers.reshape(len(numbers), parts, -1).transpose(1, 0, 2)
    books = split[:, :entries].copy()
    for last in [False] * rounds + [True]:
        far = ((split[:, :, None] - books[:, None]) ** 2).sum(-1)
        near = far.argmin(-1)
        if last:
            return near.T, far.min(-1).sum(0), books
        for p in range(parts):
            for e in range(books.shape[1]):
                if (near[p] == e).any():
                    books[p, e] = split[p][near[p] == e].sum(0) // (near[p] == e).sum()


def test_orchard_finds_what_a_full_search_finds():
    rnd = np.random.default_rng(0)
    for _ in range(80):
        width, size, most = rnd.integers(1, 6), rnd.integers(1, 65), rnd.choice([1, 2, 5, 300])
        entries, points = rnd.integers(-most, most + 1, (size, width)), rnd.integers(-most, most + 1, (200, width))
        far = ((points[:, None] - entries[None]) ** 2).sum(2)
        best, distance = codes.Orchard(entries).nearest(points)
        assert (best == far.argmin(1)).all() and (distance == far.min(1)).all()


def test_orchard_stops_early():
    entries = np.arange(64)[:, None] * 1000
    asked = []
    real = codes.squared
    codes.squared = lambda d: asked.append(len(d)) or real(d)
    try:
        search = codes.Orchard(entries)
        asked.clear()
        search.nearest(np.arange(63)[:, None] * 1000 + 10)
    finally:
        codes.squared = real
    assert sum(asked) <= 4 * 63


@pytest.mark.parametrize("split", [1, 7])
def test_fit_and_codes(spark, split, monkeypatch):
    monkeypatch.setattr(codes, "CHUNK", 16)
    rnd = np.random.default_rng(5)
    vectors = {int(k): rnd.normal(0, 0.3, 8).round(2).tolist() for k in rnd.permutation(300)}
    rows = [(k, v, None if k % 3 == 0 else k % 3) for k, v in vectors.items()]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(split)
    out, books = codes.code_vectors(table, parts=4, entries=10, rounds=3, scale=100)
    near, far, entries = plain(vectors, 10, 4, 3, 100)
    assert (books.entries == entries).all()
    sums = {n: sum(int(far[k]) for k in range(300) if k % 3 == n) for n in range(3)}
    assert sorted(map(tuple, ((r.vec_id, tuple(r.codes), r.error, r.label_error) for r in out.collect()))) == [
        (k, tuple(near[k].tolist()), far[k], sums[k % 3]) for k in range(300)
    ]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (2, [0.5, -0.5], None), (None, [9.0, 9.0], 0), (3, None, 0), (4, [nan, 1.0], 0), (5, [-inf, 1.0], 0),
        (6, [None, 1.0], 0), (7, [], 0), (8, [1.0], 0), (9, [-0.001, 1.0], None),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({c: F.lit(0) for c in ("key", "vector", "codes", "error", "unlabelled")})
    out, books = codes.code_vectors(table.repartition(3), parts=2, entries=3, rounds=0)
    assert out.columns == ["vec_id", "codes", "error", "label_error"]
    assert books.entries.tolist() == [[[0], [0], [128]], [[256], [256], [-128]]]
    far = (2304 - 128) ** 2 + (2304 - 256) ** 2
    assert sorted(((r.vec_id, r.codes, r.error, r.label_error) for r in out.collect()), key=repr) == sorted([
        (1, [0, 0], 0, far), (1, [0, 0], 0, far), (2, [2, 2], 0, 1), (None, [2, 0], far, far), (9, [0, 0], 1, 1),
    ], key=repr)
    for nothing in (table.where("false"), table.where("embedding is null")):
        out, books = codes.code_vectors(nothing)
        assert books is None and out.collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        codes.code_vectors(table.where("vec_id = 1"), parts=5)
