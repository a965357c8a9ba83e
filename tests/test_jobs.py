"""Whole runs on small tables."""

import json
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from obsframe.operators.envelope import encode_messages
from obsframe.plans.jobs import run_and_store, run_from_source, run_once, store_result
from obsframe.functions.casts import typed
from obsframe.schemas import CASUAL_METRICS, CURRENT_WIRE, DAILY_TEMPERATURES, DAILY_WIRE
from obsframe.sinks.tables import append_to
from obsframe.sources.paged import register_paged_rest
from obsframe.sources.streams import stored_messages
from obsframe.streaming.ingest import ingest_to_folder, read_folder
from obsframe.workspace import open_runs, shared_folder

PLACES = 24

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows_of(table):
    shard = table.endswith("_2")
    kind = table.removesuffix("_2")
    if kind == "location":
        return [
            {"id": i, "Name": f"n{i}", "Latitude": str(10 + 5 * (i % 4)), "Longitude": str(100 + i % 3), "Address": "a"}
            for i in range(PLACES)
        ]
    ids = range(PLACES // 2, PLACES + 1) if shard else range(PLACES // 2)  # one reading of an unknown place
    if kind == "daily":
        return [
            {
                "id": v * 1000 + i, "locationID": str(i), "time": f"2024-05-0{d}", "time_created": f"2024-05-01 0{v}:00:00",
                **{m: str(20.5 + v + d) for m in DAILY_TEMPERATURES},
            }
            for i in ids for d in (1, 2) for v in (1, 2)
        ]
    return [
        {
            "locationID": str(i), "time": f"2024-05-01T0{t}:00",
            **{m: (i * (j + 1) + t) % 17 if m != "is_day" else t % 2 for j, m in enumerate(CASUAL_METRICS)},
            "snow_depth": None if (i, t) == (0, 0) else "0.00",
        }
        for i in ids for t in range(4)
    ]


class Tables:
    def __init__(self, table):
        self.rows = rows_of(table)

    def count(self):
        return len(self.rows)

    def page(self, offset, limit):
        return 200, json.dumps({"list": self.rows[offset:offset + limit]})


@pytest.fixture(scope="module")
def result(spark):
    register_paged_rest(spark, lambda options: Tables(options["table"]))
    gazetteer = spark.createDataFrame(
        [(1, 12.0, 101.0, "1 Road, South, Land"), (2, 24.0, 101.0, "2 Road, North, Land"), (3, 80.0, -20.0, "Ice")],
        "place_id int, lat double, lon double, address string",
    )
    return run_from_source(spark, gazetteer, datetime(2024, 5, 1, 12), parts=1, page_size="7")


def test_daily_features(result):
    rows = result.tables["daily_geojson"].collect()
    assert {str(r.time) for r in rows} == {"2024-05-01 00:00:00", "2024-05-02 00:00:00"}
    features = [(r.time.day, json.loads(r.geojson)) for r in rows]
    for day in (1, 2):
        points = [p for d, f in features if d == day for p in f["geometry"]["coordinates"][0]]
        assert len(points) == PLACES
        assert sorted(map(tuple, points)) == sorted((100.0 + i % 3, 10.0 + 5 * (i % 4)) for i in range(PLACES))
    for day, feature in features:
        assert feature["type"] == "Feature" and feature["geometry"]["type"] == "Polygon"
        assert feature["properties"]["name"] in ("South", "North")
        assert feature["properties"]["temperature_2m_max"] == 22.5 + day  # the second version


def test_current_summary(result):
    summary = result.tables["current_summary"]
    assert set(summary.columns) == {
        "time", "prediction", "centroid_Longitude", "centroid_Latitude", "centroid_address", *[f"avg_{m}" for m in CASUAL_METRICS],
    }
    rows = summary.collect()
    assert {r.time for r in rows} == {f"2024-05-01T0{t}:00" for t in range(4)}
    assert {r.prediction for r in rows} == set(range(10))
    assert all(r.avg_is_day == (r.time[12] in "13") for r in rows)
    assert result.skipped["current"].count() == 1 and result.skipped["daily"].count() == 0


def test_results_are_stored(spark, result, tmp_path):
    for _ in range(2):
        store_result(result, append_to(str(tmp_path)))
    assert spark.read.parquet(f"{tmp_path}/current_correlation").count() == 722
    assert spark.read.parquet(f"{tmp_path}/daily_geojson").columns == ["time", "geojson"]
    assert spark.read.parquet(f"{tmp_path}/current_summary").count() == 2 * result.tables["current_summary"].count()


def test_current_correlation(result):
    rows = {(r.matrix_x, r.matrix_y): r for r in result.tables["current_correlation"].collect()}
    assert len(rows) == 361 and {r.time for r in rows.values()} == {"2024-05-01 12:00:00"}
    for (x, y), r in rows.items():
        assert r.correlation == pytest.approx(rows[y, x].correlation) if r.correlation is not None else rows[y, x].correlation is None
    assert all(rows[f"avg_{m}", f"avg_{m}"].correlation == pytest.approx(1.0) for m in CASUAL_METRICS)
    assert rows["avg_snow_depth", "avg_rain"].correlation is None


def test_from_messages_to_results(spark, tmp_path):
    """Two rounds of messages of 30 places through the stream, then a run over what it stored."""
    root, folder = str(tmp_path / "out"), str(tmp_path / "in")
    for hour in ("10", "11"):
        record = spark.range(30).select(
            F.when(F.col("id") < 15, 1).otherwise(2).alias("shard"), "id",
            F.struct(F.lit(f"2024-05-01T{hour}:00").alias("time"), *[
                ((F.col("id") * (i + 1) + int(hour)) % 13 if m != "is_day" else F.col("id") % 2).alias(m)
                for i, m in enumerate(CASUAL_METRICS)
            ]).alias("current"),
            F.struct(
                F.array(*[F.lit(f"2024-05-0{d}") for d in range(1, 8)]).alias("time"),
                *[F.array(*[F.lit(float(hour)) + d for d in range(7)]).alias(t) for t in DAILY_TEMPERATURES],
            ).alias("daily"),
        )
        encode_messages(record).write.mode("append").parquet(folder)
        ingest_to_folder(stored_messages(spark, folder), root, f"{root}/progress", available_now=True).awaitTermination()
    places = spark.range(30).select("id", (F.col("id") * 2.0).alias("Longitude"), (F.col("id") * 1.0).alias("Latitude"))
    gazetteer = spark.createDataFrame([(1, 5.0, 10.0, "a, West, b"), (2, 25.0, 50.0, "a, East, b")],
                                      "place_id int, lat double, lon double, address string")
    tables = run_once(read_folder(spark, root, "daily"), read_folder(spark, root, "current"), places, gazetteer, parts=1).tables
    features = [(r.time.day, json.loads(r.geojson)) for r in tables["daily_geojson"].collect()]
    for day in range(1, 8):
        assert sum(len(f["geometry"]["coordinates"][0]) for d, f in features if d == day) == 30
    assert all(f["properties"]["temperature_2m_max"] == 11.0 + d - 1 for d, f in features)
    assert {f["properties"]["name"] for _, f in features} == {"West", "East"}
    assert {str(r.time) for r in tables["current_summary"].collect()} == {"2024-05-01 10:00:00", "2024-05-01 11:00:00"}
    assert tables["current_correlation"].count() == 361


@pytest.mark.parametrize("fails", [False, True])
def test_a_run_leaves_nothing_behind(spark, tmp_path, fails):
    shared = Path(shared_folder(spark).removeprefix("file:"))
    left = lambda: sorted(p.name for p in (shared / "obsframe").glob("*"))
    before = left()
    gazetteer = spark.createDataFrame([(1, 12.0, 101.0, "1 Road, South, Land")], "place_id int, lat double, lon double, address string")
    at = spark.createDataFrame([(i, 10.0 + i % 4, 100.0 + i % 3) for i in range(PLACES)], "id int, Latitude double, Longitude double")
    seen = []

    def write(name, rows):
        seen.append((name, len(open_runs(spark)), any((shared / "obsframe-runs").rglob("*.parquet"))))
        if fails:
            raise OSError("no room")
        append_to(f"{tmp_path}/out")(name, rows)

    daily = typed(spark.createDataFrame(rows_of("daily"), DAILY_WIRE), "daily")
    current = typed(spark.createDataFrame(rows_of("current"), CURRENT_WIRE), "current")
    if fails:
        with pytest.raises(OSError):
            run_and_store(daily, current, at, gazetteer, write, datetime(2024, 5, 1), parts=2, k=3)
    else:
        assert run_and_store(daily, current, at, gazetteer, write, datetime(2024, 5, 1), parts=2, k=3) == {"daily": 0, "current": 1}
        features = [json.loads(r.geojson) for r in spark.read.parquet(f"{tmp_path}/out/daily_geojson").collect()]
        assert {(f["properties"]["part"], f["properties"]["parts"]) for f in features} == {(0, 2), (1, 2)}
    assert seen[0] == ("daily_geojson", 1, True)
    assert open_runs(spark) == [] and left() == before
