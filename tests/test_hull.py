"""Hulls of groups, whatever task their points are in."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsframe.functions.geojson import outline
from obsframe.operators import hull as module
from obsframe.operators.hull import hull, hulls


def turns(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9)), min_size=1, max_size=200))
def test_hull(points):
    found = [tuple(map(int, p)) for p in hull(np.array(points, float))]
    assert len(set(found)) == len(found) and set(found) <= set(points) and found[0] == min(points)
    if len(found) > 2:
        ring = found + found[:2]
        assert all(turns(*ring[i : i + 3]) > 0 for i in range(len(found)))
        assert all(turns(a, b, p) >= 0 for a, b in zip(ring, ring[1:]) for p in points)
    else:
        assert all(turns(found[0], found[-1], p) == 0 for p in points)
        assert {min(points), max(points)} == set(found)


def test_many_points_are_thinned_first():
    points = np.random.default_rng(0).normal(0, 1, (50_000, 2))
    assert len(module._outer(np.unique(points, axis=0))) < 25_000
    corners = hull(points)
    assert (hull(np.concatenate([hull(points[:20_000]), hull(points[20_000:])])) == corners).all()


@pytest.mark.parametrize("limits", [(100_000, 200_000), (10, 20)])
def test_groups(spark, limits, monkeypatch):
    monkeypatch.setattr(module, "FAN", 2)
    rnd = np.random.default_rng(1)
    rows = [(None if g == 3 else g, f"k{g % 2}", *map(float, rnd.integers(0, 50, 2))) for g in rnd.integers(0, 5, 3000).tolist()]
    rows += [(7, "one", 1.0, 2.0), (7, "one", 1.0, 2.0), (8, "line", 0.0, 0.0), (8, "line", 2.0, 2.0), (8, "line", 1.0, 1.0)]
    rows += [(9, "none", None, 1.0), (9, "none", float("nan"), 1.0), (1, "k1", float("inf"), 3.0)]
    table = spark.createDataFrame(rows, "g int, h string, Longitude double, Latitude double").repartition(9)
    monkeypatch.setattr(module, "HELD", limits[0])
    monkeypatch.setattr(module, "KEPT", limits[1])
    found = {(r.g, r.h): r.ring for r in hulls(table, ["g", "h"]).collect()}
    assert set(found) == {(g, h) for g, h, x, _ in rows if h != "none"}
    for key, ring in found.items():
        own = np.array([r[2:] for r in rows if (r[0], r[1]) == key and np.isfinite(r[2])])
        corners = hull(own).tolist()
        assert ring == (corners + corners[:1] if len(corners) > 2 else corners)
    assert found[7, "one"] == [[1.0, 2.0]] and found[8, "line"] == [[0.0, 0.0], [2.0, 2.0]]
    assert hulls(table.where("false"), ["g"]).collect() == []


def test_shapes(spark):
    rows = spark.createDataFrame([([[0.0, 0.0], [1.0, 0.0], [0.0, 1.0], [0.0, 0.0]],), ([[0.0, 0.0], [1.0, 1.0]],), ([[3.0, 4.0]],), (None,)], "r array<array<double>>")
    got = [r[0] and json.loads(r[0])["geometry"] for r in rows.select(outline(F.col("r"), {"a": F.lit(1)})).collect()]
    assert got == [
        {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 1], [0, 0]]]}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]},
        {"type": "Point", "coordinates": [3, 4]}, None,
    ]
