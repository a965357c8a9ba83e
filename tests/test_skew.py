"""Large and skewed inputs take other paths; the results are the same."""

import math
import random
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsframe.operators import cluster, lookup, nearest
from obsframe.operators.correlate import spearman_long
from obsframe.operators.lookup import hot_keys, lookup_join
from obsframe.operators.nearest import nearest_join, nearest_place
from obsframe.operators.position import running_total, with_position


@pytest.fixture
def nothing_small(monkeypatch):
    """Broadcast only tables of up to 40 rows, so that most joins take the path for large tables."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 40)


def facts_with_hot_key(spark):
    """A third of 3000 rows has key 7; key 8 is as frequent but has no row in the table; some keys are NULL."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, -8).when(F.col("id") % 50 == 2, None).otherwise(F.col("id") % 400)
    return spark.range(3000).select("id", key.alias("key"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_large(spark, nothing_small, how):
    facts = facts_with_hot_key(spark)
    table = spark.range(300).select(F.col("id").alias("key"), (F.col("id") * 10).alias("v"))
    got = lookup_join(facts, table, ["key"], how).select("id", "key", "v")
    want = facts.join(table, "key", how).select("id", "key", "v")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_lookup_join_small_facts(spark, nothing_small):
    facts = spark.range(5).select(F.lit("a").alias("name"), F.col("id").alias("key"))
    table = spark.range(300).select(F.col("id").alias("key"), (F.col("id") * 10).alias("v"))
    assert sorted(map(tuple, lookup_join(facts, table, ["key"]).select("key", "name", "v").collect())) == [
        (i, "a", 10 * i) for i in range(5)
    ]


def test_wide_rows_are_not_small(spark, monkeypatch):
    df = spark.createDataFrame([(1, "x" * 2000)], "k int, t string")
    assert lookup.is_small(df)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 1000)
    assert not lookup.is_small(df) and lookup.is_small(df.select("k"))


def test_hot_keys_are_few(spark):
    assert {r.key for r in hot_keys(facts_with_hot_key(spark), ["key"]).where("key in (7, -8)").collect()} == {7, -8}


def test_position_with_copies(spark):
    rows = [(5, "x")] * 40 + [(5, str(i)) for i in range(20)] + [(i, "y") for i in range(60)]
    random.Random(1).shuffle(rows)
    got = with_position(spark.createDataFrame(rows, "k int, t string").repartition(5), ["k"]).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    assert [r.k for r in got] == sorted(r[0] for r in rows)
    assert {r.total for r in got} == {len(rows)}


def test_position_of_nothing(spark):
    assert with_position(spark.createDataFrame([], "k int"), ["k"]).count() == 0


def test_running_total(spark, nothing_small):
    rows = [(m, float(v), (v * 7) % 5 + 1) for m in ("a", "b") for v in range(200)]
    got = running_total(spark.createDataFrame(rows, "m string, v double, n long").repartition(4), "m", "v", "n", "below")
    seen = {(r.m, r.v): r.below for r in got.collect()}
    for m in ("a", "b"):
        total = 0
        for _, v, n in [r for r in rows if r[0] == m]:
            assert seen[m, v] == total
            total += n


def brute(queries, places):
    found = []
    for q in queries:
        found.append(min((sum((a - b) * (a - b) for a, b in zip(q, p[1:])), p[0]) for p in places))
    return found


@pytest.mark.parametrize("small,few", [(True, 0), (False, 0), (True, 1000)])
def test_nearest_dense_and_far(spark, monkeypatch, small, few):
    """A third of the places in one tiny spot, a third exact copies, the rest wide; queries in and far out."""
    monkeypatch.setattr(nearest, "FEW", few)
    if not small:
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 40)
    monkeypatch.setattr(nearest, "LEAF_PLACES", 4)
    r = random.Random(3)
    places = [(i, 10 + r.random() * 1e-4, 20 + r.random() * 1e-4) for i in range(150)]
    places += [(150 + i, 3.0, 4.0) for i in range(150)]
    places += [(300 + i, r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(150)]
    queries = [(r.uniform(-100, 100), r.uniform(-200, 200)) for _ in range(60)]
    queries += [(10 + r.random() * 1e-4, 20 + r.random() * 1e-4) for _ in range(30)]
    queries += [(3.0, 4.0)] * 30 + [(10.0, 20.0)]
    q = spark.createDataFrame([(i, *p) for i, p in enumerate(queries)] + [(999, None, 1.0)], "q int, x double, y double")
    p = spark.createDataFrame(places, "place_id int, x double, y double").withColumn("name", F.concat(F.lit("p"), "place_id"))
    got = {r.q: r for r in nearest_join(q, p, ["x", "y"], "place_id", ["name"]).collect()}
    assert len(got) == len(queries) + 1 and got[999].place_id is None
    for i, (d, place) in enumerate(brute(queries, places)):
        assert (got[i].squared_distance, got[i].place_id, got[i].name) == (d, place, f"p{place}")


def test_one_place_far_out_fills_no_cell(spark, monkeypatch):
    monkeypatch.setattr(nearest, "FEW", 0)
    places = spark.range(20_000).select(
        F.col("id").cast("int").alias("place_id"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1e9).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_003)) / 1e9).alias("y"),
    ).union(spark.createDataFrame([(-1, 1e9, 1e9)], "place_id int, x double, y double"))
    grid = nearest._Grid(places.select("x", "y", "place_id"), ["x", "y"])
    assert grid._fullest() <= nearest.LEAF_PLACES and grid.bits <= 15
    asked = [(0, 0.0, 0.0), (1, 5e-4, 5e-4), (2, 1e9, 9e8), (3, 4e8, 4e8)]
    q = spark.createDataFrame(asked, "q int, x double, y double")
    got = {r.q: (r.squared_distance, r.place_id) for r in nearest_join(q, places, ["x", "y"], "place_id", []).collect()}
    known = [tuple(r) for r in places.collect()]
    assert got == dict(enumerate(brute([a[1:] for a in asked], known)))


@pytest.mark.parametrize("few", [0, 64])
def test_nearest_on_a_line_and_alone(spark, monkeypatch, few):
    monkeypatch.setattr(nearest, "FEW", few)
    q = spark.createDataFrame([(1, 5.0, 0.0)], "q int, x double, y double")
    line = spark.createDataFrame([(i, float(i), 2.0) for i in range(200)], "place_id int, x double, y double")
    assert nearest_join(q, line, ["x", "y"], "place_id", []).first().place_id == 5
    assert nearest_join(q, line.where("place_id = 9"), ["x", "y"], "place_id", []).first().place_id == 9
    assert nearest_join(q, line.where("place_id < 0"), ["x", "y"], "place_id", []).first().place_id is None


def test_nearest_on_the_globe(spark):
    r = random.Random(5)
    places = [(i, math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180), f"a{i}, b, c") for i in range(500)]
    queries = [(i, r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(80)] + [(80, 0.0, 180.0), (81, 0.0, -180.0), (82, 90.0, 7.0)]
    got = {
        row.q: row.place_id for row in nearest_place(
            spark.createDataFrame(queries, "q int, la double, lo double"),
            spark.createDataFrame(places, "place_id int, lat double, lon double, address string"), "la", "lo", ["address"],
        ).collect()
    }

    def angle(a, b):
        (p1, l1), (p2, l2) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
        return 2 * math.asin(math.sqrt(h))

    for i, la, lo in queries:
        best = min(angle((la, lo), p[1:3]) for p in places)
        chosen = next(p for p in places if p[0] == got[i])
        assert angle((la, lo), chosen[1:3]) == pytest.approx(best, abs=1e-9)
    assert got[80] == got[81]


def test_points_of_large_groups_are_split_and_whole(spark):
    rows = [(1, i, float(i), -float(i)) for i in range(500)] + [(2, 1000 + i, 0.0, 0.0) for i in range(5)]
    clustered = spark.createDataFrame(rows, "prediction int, locationID long, Longitude double, Latitude double")
    got = cluster.cluster_points(clustered, ["prediction"], parts=5).collect()
    assert len([g for g in got if g.prediction == 1]) == 5 and len([g for g in got if g.prediction == 2]) == 5
    assert all(g.parts == 5 and p.locationID % 5 == g.part for g in got for p in g.points)
    assert len(cluster.cluster_points(clustered, ["prediction"]).collect()) == 2
    assert sorted((g.prediction, *p) for g in got for p in g.points) == sorted(rows)
    assert all([p.locationID for p in g.points] == sorted(p.locationID for p in g.points) for g in got)


@pytest.mark.parametrize("small", [True, False])
def test_spearman_ties_nulls_constants(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 40)
    r = np.random.default_rng(2)
    n = 600
    pdf = pd.DataFrame({
        "a": r.normal(size=n), "b": np.where(r.random(n) < 0.4, 0.0, r.integers(0, 9, n)), "c": 3.0,
        "d": r.integers(0, 2, n).astype(float),
    })
    pdf["a"] = pdf["a"] + pdf["d"]
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0)], "a double, b double, c double, d double"))
    long = spearman_long(df.withColumn("d", F.col("d").cast("boolean")), list("abcd"), datetime(2024, 5, 1, 10, 15)).collect()
    assert len(long) == 16 and {x.time for x in long} == {"2024-05-01 10:15:00"}
    want = pdf.rank().corr()
    for x in long:
        if "c" in (x.matrix_x, x.matrix_y):
            assert x.correlation == (1.0 if x.matrix_x == x.matrix_y else None)
        else:
            assert x.correlation == pytest.approx(want.loc[x.matrix_x, x.matrix_y], abs=1e-9)


def test_run_time_now_is_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
        text = spearman_long(spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "a double, b double"), ["a", "b"], now).first().time
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    seen = datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    assert abs((datetime.now(timezone.utc) - seen).total_seconds()) < 120


def test_spearman_of_nothing(spark):
    assert spearman_long(spark.createDataFrame([], "a double, b double"), ["a", "b"], datetime(2024, 1, 1)).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_wide_rows_of_hot_keys_are_salted(spark, monkeypatch, how):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 150)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 2_000)
    facts = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"), F.col("id").alias("v"), F.lit("f" * 50).alias("wide"),
    )
    table = spark.range(300).select(F.col("id").alias("k"), F.concat(F.lit("t" * 4000), F.col("id")).alias("payload"))
    stored = lookup.materialize(table, "wide")
    found = lookup.lookup_join(facts, stored, ["k"], how)
    plan = found._jdf.queryExecution().toString()
    assert "_salt" in plan
    expected = facts.join(table, "k", how).select("k", "v", F.substring("payload", 4001, 9).alias("p"))
    got = found.select("k", "v", F.substring("payload", 4001, 9).alias("p"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
