"""Runs over what is new give what one run over everything gives, and leave other days alone."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obsframe.operators import cluster
from obsframe.operators.kmeans import Centres
from obsframe.operators.states import mean_of, merge_states, partial_states
from obsframe.plans import incremental
from obsframe.plans.incremental import Store, add_forecasts, add_readings, current_summary, daily_summary, run_incremental
from obsframe.schemas import DAILY_TEMPERATURES
from obsframe.sinks.commits import Conflict, commit, last_commit, names

DAYS = [datetime(2024, 5, 1) + timedelta(days=d) for d in range(4)]


@pytest.fixture(scope="module")
def places(spark):
    return spark.range(12).select("id", (F.col("id") % 4 * 10.0).alias("Longitude"), (F.col("id") % 3 * 10.0).alias("Latitude"), F.concat(F.lit("P"), "id").alias("address"))


@pytest.fixture(scope="module")
def gazetteer(places):
    return places.select(F.col("id").alias("place_id"), F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"), "address")


def forecasts(spark, days, version):
    rows = [(1000 * version + i, str(i), d, datetime(2024, 5, 1, version), *[float((i * 7 + d.day * 3 + version + n) % 11) for n in range(4)]) for d in days for i in range(13)]
    names_ = ", ".join(f"{t} double" for t in DAILY_TEMPERATURES)
    return spark.createDataFrame(rows, f"id int, locationID string, time timestamp, time_created timestamp, {names_}")


def readings(spark, hours):
    rows = [(str(i), (DAYS[0] + timedelta(hours=h)).isoformat(), *[float((i * (n + 1) + h) % 17) for n in range(19)]) for h in hours for i in range(13)]
    table = spark.createDataFrame(rows, "locationID string, time string, " + ", ".join(f"{m} double" for m in cluster.CURRENT_FEATURES))
    return table.withColumn("is_day", F.col("is_day") > 8)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_states_merge_to_the_means(spark):
    rows = spark.createDataFrame([("a", 1.5, True), ("a", None, None), ("b", 2.25, False), ("b", -1.0, None), ("b", 4.0, False), ("c", None, None)], "g string, x double, f boolean")
    parts = [partial_states(rows.where(w), ["g"], ["x"], ["f"]) for w in ("x > 2 or x is null", "x <= 2")]
    whole = merge_states(parts[0].unionByName(parts[1]), ["g"], ["x"], ["f"])
    assert found(whole.select("g", mean_of("x"), "f_any")) == [("a", 1.5, True), ("b", 1.75, False), ("c", None, None)]
    with pytest.raises(PySparkException, match="x lies beyond"):
        partial_states(spark.createDataFrame([("a", 1e10)], "g string, x double"), ["g"], ["x"]).collect()


def test_commits(spark, tmp_path):
    folder = f"{tmp_path}/c"
    assert last_commit(spark, folder) == (0, None)
    for n in (1, 2, 3):
        commit(spark, folder, n, {"n": n})
    assert last_commit(spark, folder) == (3, {"n": 3}) and sorted(names(spark, folder)) == ["2", "3"]
    with pytest.raises(Conflict):
        commit(spark, folder, 3, {})
    spark.createDataFrame([("{",)], "value string").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(f"{folder}/4")
    assert last_commit(spark, folder)[0] == 3  # not written whole
    commit(spark, folder, 4, {"n": 4})
    assert last_commit(spark, folder) == (4, {"n": 4})


def test_two_runs_are_one(spark, places, tmp_path):
    centres = Centres(cluster.DAILY_FEATURES, [[0.0] * 6, [20.0, 10.0, 5.0, 5.0, 5.0, 5.0]])
    stores = [Store(spark, f"{tmp_path}/{n}") for n in "ab"]
    for store in stores:
        store.keep("daily", centres)
    one, two = stores
    first = forecasts(spark, DAYS[:3], 1)
    later = forecasts(spark, DAYS[2:], 2)  # a day anew and a new one
    add_forecasts(one, first.unionByName(later).unionByName(forecasts(spark, DAYS[:1], 0)), places)
    assert add_forecasts(two, first, places).days == ["2024-05-01", "2024-05-02", "2024-05-03"]
    before = two.daily.days()
    # Files of days without news may be gone: no run opens them.
    hidden = tmp_path / "b" / "forecasts" / "rows"
    for d in ("2024-05-01", "2024-05-02"):
        for day in hidden.glob(f"*/day={d}/*.parquet"):
            day.rename(day.with_suffix(".away"))
    assert add_forecasts(two, later, places).days == ["2024-05-03", "2024-05-04"]
    for away in hidden.glob("*/*/*.away"):
        away.rename(away.with_suffix(".parquet"))
    assert {d: two.daily.days()[d] for d in ("2024-05-01", "2024-05-02")} == {d: before[d] for d in ("2024-05-01", "2024-05-02")}
    assert found(daily_summary(two)) == found(daily_summary(one)) and len(found(daily_summary(one))) > 4
    assert found(daily_summary(two, ["2024-05-04"])) == [r for r in found(daily_summary(one)) if r[0] == DAYS[3]]
    add_forecasts(two, forecasts(spark, DAYS[:1], 0), places)  # versions older than what is stored
    assert found(daily_summary(two)) == found(daily_summary(one))
    assert two.clean() == 4 and two.clean() == 0  # of two tables a day that was replaced, twice
    assert found(daily_summary(two)) == found(daily_summary(one))


def test_readings_add_up(spark, places, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "MERGE", 3)
    one, many = Store(spark, f"{tmp_path}/one", k=3), Store(spark, f"{tmp_path}/many", k=3)
    whole = readings(spark, range(6)).unionByName(readings(spark, [30]))
    add_readings(one, whole, places)
    many.keep("current", Centres(**last_commit(spark, f"{tmp_path}/one/centres-current")[1]))
    for part in (readings(spark, [0, 1]).where("locationID < 5"), readings(spark, [0, 1]).where("locationID >= 5"), readings(spark, [2, 3, 4, 5, 30])):
        add_readings(many, part, places)
    assert {d: len(b) for d, b in many.current.days().items()} == {"2024-05-01": 1, "2024-05-02": 1}
    assert found(current_summary(many)) == found(current_summary(one)) != []


def test_runs(spark, places, gazetteer, tmp_path):
    one, two = Store(spark, f"{tmp_path}/one", k=2), Store(spark, f"{tmp_path}/two", k=2)
    now = datetime(2024, 5, 9)
    news = (forecasts(spark, DAYS, 1), readings(spark, range(5)))
    whole = run_incremental(one, *news, places, gazetteer, now, parts=2)
    for kind in ("daily", "current"):
        two.keep(kind, Centres(**last_commit(spark, f"{tmp_path}/one/centres-{kind}")[1]))
    run_incremental(two, forecasts(spark, DAYS[:3], 1), readings(spark, range(3)), places, gazetteer, now, parts=2)
    last = run_incremental(two, forecasts(spark, DAYS[3:], 1), readings(spark, [3, 4]), places, gazetteer, now, parts=2)
    new = [r for r in found(whole.tables["daily_geojson"]) if r[0] == DAYS[3]]
    assert found(last.tables["daily_geojson"]) == new != []
    pairs = [{(r.matrix_x, r.matrix_y): r.correlation for r in t.tables["current_correlation"].collect()} for t in (last, whole)]
    assert pairs[0] == pytest.approx(pairs[1], abs=1e-9, nan_ok=True) and len(pairs[0]) == 19 * 19
    assert found(last.tables["current_summary"]) == found(whole.tables["current_summary"])  # all times are of one day
    before = found(daily_summary(two)), found(current_summary(two))
    assert add_forecasts(two, news[0].where("false"), places).days == add_readings(two, news[1].where("false"), places).days == []
    assert (found(daily_summary(two)), found(current_summary(two))) == before
    with pytest.raises(ValueError, match="another folder"):
        two.keep("daily", Centres(cluster.DAILY_FEATURES, []))


def test_rows_without_a_cluster_are_told(spark, places, tmp_path):
    store = Store(spark, f"{tmp_path}/s", k=2)
    gap = forecasts(spark, DAYS[:1], 1).withColumn(DAILY_TEMPERATURES[0], F.when(F.col("id") > 1003, F.col(DAILY_TEMPERATURES[0])))
    added = add_forecasts(store, gap, places)
    assert added.skipped.count() == 4 and added.clustered.count() == 8
    all_gone = forecasts(spark, DAYS[:1], 2).withColumn(DAILY_TEMPERATURES[0], F.lit(None).cast("double"))
    add_forecasts(store, all_gone, places)
    assert found(daily_summary(store)) == []
