"""k-means that no layout changes, and nearest centres among many."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from obsframe.operators import cluster, kmeans, kmeans_fit
from obsframe.operators.kmeans import CentreBlocks, Centres, assign_centres, assign_many, fit_centres, seeds


@pytest.fixture(scope="module")
def points(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, *map(float, rnd.normal(0, 1, 3))) for i in range(3000)]
    rows += [(3000, None, 1.0, 1.0), (3001, float("nan"), 1.0, 1.0), (3002, float("inf"), 0.0, 0.0)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double")


FEATURES = ["a", "b", "c"]


def test_no_layout_changes_the_centres(points, monkeypatch):
    found = [fit_centres(points.repartition(n).orderBy(*order) if order else points.repartition(n), FEATURES, 7, "id", rounds=15)
             for n, order in ((1, []), (2, []), (7, []), (3, [F.desc("a")]), (5, ["id"]))]
    monkeypatch.setattr(kmeans, "ROWS_AT_ONCE", 13)
    found.append(fit_centres(points.repartition(4), FEATURES, 7, "id", rounds=15))
    assert all(f == found[0] for f in found) and found[0].values == sorted(found[0].values)
    assert Centres.from_json(found[0].to_json()) == found[0]


def test_rounds_against_a_plain_version(points):
    rows = np.array([list(r)[1:] for r in points.where("id < 3000").orderBy("id").collect()])
    begun = seeds(points, FEATURES, 5, "id")
    centres = np.array(begun.values)
    for _ in range(4):
        label = ((rows[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([rows[label == c].mean(0) for c in range(5)])
    found = fit_centres(points, FEATURES, 5, "id", rounds=4)
    assert np.allclose(found.values, sorted(centres.tolist()), atol=1e-6)
    again = fit_centres(points, FEATURES, 5, "id", rounds=0, given=found)
    assert again == found
    labels = {r.id: r.prediction for r in assign_centres(points, found).collect()}
    far = ((rows[:, None] - np.array(found.values)[None]) ** 2).sum(2).argmin(1)
    assert labels == dict(enumerate(far.tolist()))


def test_few_points(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(500)] + [(900, 5.0, 6.0)], "id long, a double, b double")
    found = fit_centres(same.repartition(3), ["a", "b"], 4, "id")
    assert found.values == [[1.0, 2.0], [5.0, 6.0]]  # of all points, not only of the first rows by hash
    assert assign_centres(same, found).groupBy("prediction").count().orderBy("prediction").collect() == [(0, 500), (1, 1)]
    none = same.where("false")
    assert fit_centres(none, ["a", "b"], 4, "id").values == [] and assign_centres(none, Centres(["a", "b"], [])).collect() == []
    one = fit_centres(same, ["a", "b"], 1, "id")
    assert len(one.values) == 1 and assign_centres(same, one).where("prediction <> 0").count() == 0
    with pytest.raises(PySparkException, match="beyond"):
        fit_centres(spark.createDataFrame([(1, 1e12), (2, 0.0)], "id long, a double"), ["a"], 2, "id")


def test_ties_go_to_the_first_centre(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 2.0)], "id long, a double")
    assert [r.prediction for r in assign_centres(rows, Centres(["a"], [[0.0], [2.0], [2.0]])).orderBy("id").collect()] == [0, 0, 1]


def test_blocks_find_what_a_full_search_finds(monkeypatch):
    monkeypatch.setattr(kmeans, "CENTRES_AT_ONCE", 16)
    rnd = np.random.default_rng(8)
    for spread in (0.05, 1.0):
        middles = rnd.normal(0, 5, (30, 4))
        centres = np.round(middles[rnd.integers(0, 30, 400)] + rnd.normal(0, spread, (400, 4)), 1)
        labels = rnd.permutation(400) * 3
        points = np.round(middles[rnd.integers(0, 30, 500)] + rnd.normal(0, spread, (500, 4)), 1)
        far = kmeans.squares(points, centres)
        expected = [labels[row == row.min()].min() for row in far]
        assert CentreBlocks(centres, labels).nearest(points).tolist() == expected


def test_blocks_are_skipped(monkeypatch):
    monkeypatch.setattr(kmeans, "CENTRES_AT_ONCE", 50)
    rnd = np.random.default_rng(9)
    middles = rnd.normal(0, 100, (100, 3))
    centres = (middles[:, None] + rnd.normal(0, 1, (100, 50, 3))).reshape(-1, 3)
    blocks = CentreBlocks(centres, np.arange(len(centres)))
    asked = []
    real = kmeans.squares
    monkeypatch.setattr(kmeans, "squares", lambda p, c: asked.append(len(p) * len(c)) or real(p, c))
    blocks.nearest(middles[rnd.integers(0, 100, 400)] + rnd.normal(0, 1, (400, 3)))
    assert sum(asked) < 400 * 5000 / 5


def test_many_centres(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "ROWS_AT_ONCE", 100)
    rnd = np.random.default_rng(2)
    centres = spark.createDataFrame([(5 * i, rnd.normal(0, 1, 2).tolist()) for i in range(900)] + [(None, [0.0, 0.0]), (1, None)], "label int, centre array<double>")
    rows = [(i, rnd.normal(0, 1, 2).tolist()) for i in range(700)]
    odd = [(-1, None), (-2, [1.0]), (-3, [float("nan"), 0.0]), (-4, [None, 0.0])]
    table = spark.createDataFrame(rows + odd, "id long, v array<float>").withColumn("label", F.lit("x"))
    got = {r.id: r.prediction for r in assign_many(table.repartition(3), "v", centres).collect()}
    known = {r.label: r.centre for r in centres.dropna().collect()}
    values = np.array(list(known.values()))
    for i, v in rows:
        assert got[i] == list(known)[((values - np.array(v, np.float32).astype(float)) ** 2).sum(1).argmin()]
    assert [got[i] for i, _ in odd] == [None] * 4
    assert {r.prediction for r in assign_many(table, "v", centres.where("false")).collect()} == {None}


def test_a_fit_has_tasks_by_bytes(spark, monkeypatch):
    """Not by the number of cores alone, which would give each task more as the rows grow."""
    parts = []
    real = cluster.Pipeline.fit
    monkeypatch.setattr(cluster.Pipeline, "fit", lambda self, rows: parts.append(rows.rdd.getNumPartitions()) or real(self, rows))
    rows = spark.range(4000, numPartitions=2).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"))
    row = 8 * (2 + cluster.OVERHEAD)
    for bytes_, partitions in ((4000 * row, 3), (500 * row, 3), (500 * row, None), (4000 * row, None)):
        monkeypatch.setattr(cluster, "TASK_BYTES", bytes_)
        model = cluster.fit_clusters(rows, ["a", "b"], k=3, partitions=partitions)
        assert cluster.assign_clusters(model, rows).count() == 4000
    assert parts == [3, 8, 8, 2]


def test_products_give_the_labels_of_plain_distances(spark):
    rnd = np.random.default_rng(6)
    for shift in (0.0, 1e6, 1e9):  # the larger, the more rounding leaves to plain distances
        centres = np.round(rnd.normal(shift, 3, (12, 5)), 1)
        centres[7] = centres[2]
        between = (centres[rnd.integers(0, 12, 500)] + centres[rnd.integers(0, 12, 500)]) / 2  # many ties
        points = np.concatenate([between, centres, np.round(rnd.normal(shift, 3, (500, 5)), 1)])
        assert kmeans.first_nearest(points, centres).tolist() == kmeans.nearest(points, centres)[0].tolist()
    huge = np.array([[1e200, 0.0], [0.0, 0.0]])
    assert kmeans.first_nearest(huge, huge[::-1]).tolist() == kmeans.nearest(huge, huge[::-1])[0].tolist()


def test_rounds_read_bytes(points, monkeypatch):
    """Rounds neither filter nor convert the rows again, and labels are no expression of k distances."""
    seen = []
    real = kmeans._moved
    monkeypatch.setattr(kmeans, "_moved", lambda rows, centres: seen.append((rows.columns, rows.count())) or real(rows, centres))
    monkeypatch.setattr(kmeans, "PACK_BYTES", 100)  # four rows
    found = fit_centres(points.coalesce(1), FEATURES, 3, "id", rounds=2)
    assert seen == [(["points"], 750)] * 2
    plan = assign_centres(points, found)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "_least" not in plan


def test_a_large_fit_reads_what_is_stored(spark, tmp_path, monkeypatch):
    """Rows that tasks cannot hold are neither shuffled, nor kept in memory or on disk, nor stored again."""
    rnd = np.random.default_rng(5)
    middles = rnd.normal(0, 20, (6, 3))
    points = middles[rnd.integers(0, 6, 4000)] + rnd.normal(0, 1, (4000, 3))
    rows = [(*map(float, p),) for p in points] + [(None, 1.0, 1.0), (float("nan"), 1.0, 1.0)]
    spark.createDataFrame(rows, "a double, b double, c double").repartition(3).write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    plain = cluster.centres(cluster.fit_clusters(stored, FEATURES, k=6))
    monkeypatch.setattr(cluster, "TASK_BYTES", 1 << 12)

    def refuse(*_, **__):
        raise AssertionError("the rows were kept or moved")

    kept = []
    real = kmeans_fit._each
    with monkeypatch.context() as m:
        m.setattr(cluster, "materialize", refuse)
        m.setattr(type(stored), "repartition", refuse)
        m.setattr(kmeans_fit, "_each", lambda rows, *of: kept.append(spark.sparkContext._jsc.getPersistentRDDs().size()) or real(rows, *of))
        before = spark.sparkContext._jsc.getPersistentRDDs().size()
        model = cluster.fit_clusters(stored, FEATURES, k=6, partitions=2)
    assert set(kept) == {before} and len(kept) > 4
    assert np.allclose(cluster.centres(model), plain)
    assert np.allclose(cluster.centres(model), sorted(points[kmeans.nearest(points, np.array(plain))[0] == c].mean(axis=0).tolist() for c in range(6)))
    labels = cluster.assign_clusters(model, stored).collect()
    assert len(labels) == 4000 and all(r.prediction == kmeans.nearest(np.array([r[:3]]), np.array(plain))[0][0] for r in labels[::100])
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert cluster.centres(again) == cluster.centres(model)
    scaled = cluster.fit_clusters(stored, FEATURES, k=6, scale=True)
    assert cluster.assign_clusters(scaled, stored).groupBy("prediction").count().count() == 6


def test_a_large_fit_of_few_or_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(cluster, "TASK_BYTES", 64)
    few = spark.createDataFrame([(1.0, 2.0)] * 50 + [(3.0, 4.0)], "a double, b double")
    assert cluster.centres(cluster.fit_clusters(few, ["a", "b"], k=5)) == [[1.0, 2.0], [3.0, 4.0]]
    with pytest.raises(PySparkException, match="not finite"):
        cluster.fit_clusters(few.union(spark.createDataFrame([(float("inf"), 1.0)], few.schema)), ["a", "b"], k=2)


def test_a_draw_needs_no_sum_beforehand(spark):
    """Rows are taken by their share of the sum over all tasks, about as many as are wanted."""
    rnd = np.random.default_rng(1)
    points = np.concatenate([rnd.normal(0, 1, (3000, 2)), rnd.normal(500, 1, (30, 2))])
    rows = spark.createDataFrame([(p.tolist(),) for p in points], "point array<double>").repartition(5)
    sizes = []
    for seed in range(12):
        found = kmeans_fit._each(rows, np.zeros((1, 2)), lambda parts, centres: kmeans_fit._drawn(parts, centres, 8, (seed, 0)), "cost double, bar double, point array<double>").collect()
        cost = sum(r.cost for r in found if r.cost is not None)
        assert cost == pytest.approx((points**2).sum())
        taken = [r.point for r in found if r.point is not None and r.bar * cost < 8]
        assert all(p in points for p in taken) and len(found) < 200
        sizes.append(len(taken))
    assert 5 < np.mean(sizes) < 11
