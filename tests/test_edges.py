"""Odd input, operator by operator."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.casts import conform, misfits, typed
from obsframe.functions.geojson import polygon, ring
from obsframe.functions.text import address_part, grid
from obsframe.operators import cluster
from obsframe.operators.envelope import (
    current_rows, encode_messages, entries, forecast_rows, parse_messages, tag_records, valid_messages,
)
from obsframe.operators.places import locate
from obsframe.operators.shards import shard_of, split_shards, topic_of, union_shards
from obsframe.operators.versions import insert_ignore, latest_forecasts
from obsframe.schemas import (
    CASUAL_METRICS, CURRENT_TABLE, CURRENT_WIRE, DAILY_WIRE, FULL_METRICS, LOCATION_WIRE, PROFILES, struct,
)
from obsframe.sources.requests import build_requests, profile


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").withColumn("value", F.col("value").cast("binary"))


def message(id=3, days=2, **over):
    body = {
        "id": id,
        "current": {"time": "2024-05-01T10:15", "interval": 900, "temperature_2m": 30.1, "rain": None, "is_day": 1, "showers": "n/a"},
        "daily": {
            "time": [f"2024-05-0{d + 1}" for d in range(days)],
            "temperature_2m_max": [33.1 + d for d in range(days)], "temperature_2m_min": [25.2] * days,
            "apparent_temperature_max": [38.0] * days, "apparent_temperature_min": [28.8] * max(days - 1, 0),
            "sunrise": ["2024-05-01T05:31"] * days, "sunset": ["sometime"] * days,
        },
        **over,
    }
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def test_messages_that_are_not_whole(spark):
    bad = messages(spark, "{", "null", "", "[1]", "7", message(id=...), message(id=None), message(current=...), message(daily=None), message(id=4))
    assert [r.id for r in valid_messages(parse_messages(bad)).collect()] == ["4"]


def test_every_message_of_a_batch_is_kept(spark):
    rows = current_rows(valid_messages(parse_messages(messages(spark, *[message(id=i) for i in range(9)]))))
    assert sorted(r.locationID for r in rows.collect()) == list(range(9))


def test_current_row(spark):
    row = current_rows(parse_messages(messages(spark, message(id="12")))).first()
    assert (row.locationID, str(row.time), row.temperature_2m, row.is_day) == (12, "2024-05-01 10:15:00", 30.1, 1)
    assert row.rain is None and row.showers is None and row.uv_index is None
    assert "interval" not in row.asDict() and set(CASUAL_METRICS) < set(row.asDict())


@pytest.mark.parametrize("days,rows", [(0, 0), (2, 2), (7, 7), (12, 7)])
def test_forecast_days(spark, days, rows):
    got = forecast_rows(parse_messages(messages(spark, message(days=days)))).orderBy("temperature_2m_max").collect()
    assert len(got) == rows
    if rows:
        assert got[0].apparent_temperature_min == 28.8 and got[0].sunset is None and got[0].locationID == 3
        assert [r.temperature_2m_max for r in got] == [33.1 + d for d in range(rows)]
    if 0 < days < 7:
        assert got[-1].apparent_temperature_min is None


def test_entries_keep_nested_text(spark):
    got = {r.id: r.data for r in entries(messages(spark, message(), "{", "null")).collect()}
    assert set(got) == {"id", "current", "daily"} and json.loads(got["current"])["interval"] == 900


def test_encode_keeps_nulls_and_routes(spark):
    df = spark.createDataFrame([(1, 5, None), (2, 6, "ä")], "shard int, id int, note string")
    got = {r.topic: json.loads(bytes(r.value).decode()) for r in encode_messages(df).collect()}
    assert got == {"weather_1": {"id": 5, "note": None}, "weather_2": {"id": 6, "note": "ä"}}
    assert df.select(shard_of(topic_of(F.col("shard"))).alias("s")).distinct().count() == 2


def test_tag_records(spark):
    df = spark.createDataFrame([(1, 5, ' {"a": {"b": "}"}} '), (2, 6, "{}")], "shard int, id int, record string")
    assert [json.loads(bytes(r.value).decode()) for r in tag_records(df).collect()] == [{"a": {"b": "}"}, "id": 5}, {"id": 6}]


def test_round_trip(spark):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "id long, t double").select(
        F.lit(1).alias("shard"), "id",
        F.struct(F.lit("2024-05-01T10:15").alias("time"), F.col("t").alias("temperature_2m")).alias("current"),
        F.struct(F.array(F.lit("2024-05-01")).alias("time")).alias("daily"),
    )
    got = current_rows(valid_messages(parse_messages(encode_messages(df)))).select("locationID", "temperature_2m")
    assert sorted(map(tuple, got.collect())) == [(1, 2.5), (2, None)]


def test_typed(spark):
    wire = spark.createDataFrame([{"locationID": "02", "time": "x", "rain": "n/a", "showers": "1.5", "is_day": 0, "cloud_cover": 4}], CURRENT_WIRE)
    row = typed(wire, "current").first()
    assert (row.locationID, row.time, row.rain, row.showers, row.is_day, row.cloud_cover) == (2, "x", None, 1.5, False, 4)
    daily = spark.createDataFrame([{"locationID": "x", "time": "2024-05-01", "time_created": "later"}], DAILY_WIRE)
    row = typed(daily, "daily").first()
    assert row.locationID is None and str(row.time) == "2024-05-01 00:00:00" and row.time_created is None
    place = spark.createDataFrame([{"id": 1, "Latitude": "21.03", "Longitude": "east"}], LOCATION_WIRE)
    assert typed(place, "location").select("Latitude", "Longitude").first() == (21.03, None)


def test_conform_and_misfits(spark):
    rows = spark.createDataFrame(
        [(1, 999.994, 1.0), (2, 999.995, 2.9), (3, -1000.0, 3e9), (4, None, None), (5, float("nan"), -2147483648.5)],
        "locationID long, temperature_2m double, visibility double",
    )
    got = [(r.locationID, r.temperature_2m and float(r.temperature_2m), r.visibility) for r in conform(rows, CURRENT_TABLE).orderBy("locationID").collect()]
    assert got == [(1, 999.99, 1), (2, None, 3), (3, None, None), (4, None, None), (5, None, None)]
    lost = {r.locationID: r.misfit for r in misfits(rows, CURRENT_TABLE).collect()}
    assert lost == {2: ["temperature_2m"], 3: ["temperature_2m", "visibility"], 5: ["temperature_2m", "visibility"]}
    text = spark.createDataFrame([("1.006",), ("x",)], "v string")
    assert [str(r.v) for r in conform(text, struct(v=T.DecimalType(5, 2))).collect()] == ["1.01", "None"]


def test_latest_ties_and_nulls(spark):
    df = spark.createDataFrame([
        (1, 1, 9, "2024-01-01", 1), (1, 1, 9, "2024-01-02", 2), (1, 1, 8, "2024-01-02", 3), (1, 1, 9, None, 4),
        (2, 1, 9, "2024-01-02", 5), (1, 2, 1, None, 6),
    ], "shard int, locationID int, id int, time_created string, v int").withColumn("time", F.lit(0))
    assert sorted(r.v for r in latest_forecasts(df).collect()) == [5, 6]


def test_locate_text_ids(spark):
    readings = spark.createDataFrame([("02", 1), ("x", 2), (None, 3), ("9", 4)], "locationID string, v int")
    places = spark.createDataFrame([(2, 1.0), (3, 2.0)], "id int, Latitude double")
    assert [tuple(r) for r in locate(readings, places).select("locationID", "v", "Latitude").collect()] == [(2, 1, 1.0)]


def test_insert_ignore_keeps_one_per_key(spark):
    new = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, Name string")
    assert [tuple(r) for r in insert_ignore(new, spark.createDataFrame([(2, "z")], "id int, Name string"), "id").collect()] == [(1, "a")]


@pytest.mark.parametrize("n", [0, 1, 61, 62])
def test_shards_and_batches(spark, n):
    places = spark.range(n).select((F.col("id") * 3 + 5).alias("id"), F.lit(1.5).alias("Latitude"), F.lit(2.0).alias("Longitude"))
    sharded = split_shards(places)
    got = sorted((r.id, r.shard, r.seat) for r in sharded.collect())
    assert got == [(i * 3 + 5, 1 if i < n // 2 else 2, i if i < n // 2 else i - n // 2) for i in range(n)]
    requests = build_requests(sharded).collect()
    ids = sorted(i for r in requests for i in r.ids)
    assert ids == [i * 3 + 5 for i in range(n)]
    assert all(len(r.ids) == len(r.latitude) == len(r.longitude) <= 30 and r.ids == sorted(r.ids) for r in requests)
    assert len(requests) == -(-(n // 2) // 30) + -(-(n - n // 2) // 30)


def test_union_keeps_copies(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert union_shards(df, df.select("y", "x")).collect() == [(1, "a", 1), (1, "a", 2)]


def test_profiles(spark):
    assert (len(CASUAL_METRICS), len(FULL_METRICS)) == (19, 45) and set(CASUAL_METRICS) < set(FULL_METRICS)
    df = spark.createDataFrame([tuple(range(45))], FULL_METRICS)
    assert profile(df, "full").columns == PROFILES["full"] and profile(df, "casual").columns == CASUAL_METRICS


def test_text_functions(spark):
    df = spark.createDataFrame([("a, b , c",), ("alone",), ("",), (None,), ("x,y",)], "a string")
    assert [r.p for r in df.select(address_part(F.col("a")).alias("p")).collect()] == ["b", "", "", None, "x"]
    df = spark.createDataFrame([(0.25,), (0.35,), (-21.04,)], "x double")
    assert [r.g for r in df.select(grid(F.col("x")).alias("g")).collect()] == [0.2, 0.4, -21.0]


def test_geojson(spark):
    df = spark.sql("SELECT array(named_struct('Longitude', 105.83, 'Latitude', 21.0)) AS p, CAST(NULL AS STRING) AS name, 1.5D AS t")
    text = df.select(polygon(ring(F.col("p")), {"name": F.col("name"), "t": F.col("t")}).alias("g")).first().g
    assert json.loads(text) == {
        "type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[105.83, 21.0]]]}, "properties": {"name": None, "t": 1.5},
    }


def test_schema_guard_and_skipped_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    with pytest.raises(ValueError, match="c, d"):
        cluster.assemble(df, ["a", "c", "d"])
    assert cluster.assemble(df, ["a", "b"]).count() == 1 and cluster.incomplete(df, ["a", "b"]).count() == 1
    gaps = spark.createDataFrame([(1.0, float("nan")), (2.0, 3.0), (None, 1.0)], "a double, b double")
    assert cluster.assemble(gaps, ["a", "b"]).count() == 1 and cluster.incomplete(gaps, ["a", "b"]).count() == 2


def test_centres_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cluster, "CENTRES_PER_BLOCK", 2)
    given = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(7)], "label int, centre array<double>")
    rows = spark.createDataFrame([([0.2, 1.0],), ([2.5, 0.0],), ([99.0, 0.0],)], "v array<double>")
    assert sorted(r.prediction for r in cluster.assign_given(rows, "v", given).collect()) == [0, 2, 6]


def test_kmeans(spark):
    df = spark.createDataFrame([(float(g * 100 + i), float(g)) for g in (2, 0, 1) for i in range(20)], "a double, b double")
    for scale in (False, True):
        model = cluster.fit_clusters(df, ["a", "b"], k=3, scale=scale)
        got = cluster.assign_clusters(model, df).groupBy("prediction").agg(F.min("b"), F.max("b"), F.count("*")).orderBy("prediction").collect()
        assert [tuple(r) for r in got] == [(0, 0.0, 0.0, 20), (1, 1.0, 1.0, 20), (2, 2.0, 2.0, 20)]
    few = df.limit(2)
    assert cluster.assign_clusters(cluster.fit_clusters(few, ["a", "b"]), few).count() == 2


def test_max_of_boolean(spark):
    df = spark.createDataFrame([(1, 0, 1.0, False), (1, 0, 3.0, True), (1, 1, 5.0, False)], "time int, prediction int, x double, is_day boolean")
    got = cluster.summarize_current(df, ["x", "is_day"]).orderBy("prediction").collect()
    assert [(r.avg_x, r.avg_is_day) for r in got] == [(2.0, True), (5.0, False)]
