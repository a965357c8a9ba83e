"""Sources, sinks and streams on stored files."""

import json
import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.operators.envelope import encode_messages
from obsframe.operators.shards import shard_of
from obsframe.plans.crawl import crawl
from obsframe.schemas import CURRENT_TABLE, LOCATIONS_TABLE, struct
from obsframe.sinks.jdbc import append_jdbc, jdbc_options, shard_rows
from obsframe.sinks.kafka import send_messages
from obsframe.sinks.tables import create_tables, insert_locations, insert_rows
from obsframe.sources.locations import read_locations
from obsframe.sources.paged import page_rows, plan_pages, read_pages, read_table, register_paged_rest
from obsframe.sources.requests import REQUEST_COLUMNS, failed, records
from obsframe.sources.streams import kafka_messages, kafka_options, stored_messages
from obsframe.sources.transports import StoredPages
from obsframe.streaming.ingest import (
    days_of, folder_readings, ingest_to_folder, read_distinct, read_folder, start_distinct, start_ingest, unseen,
)
from obsframe.workspace import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_location_file(spark, tmp_path):
    (tmp_path / "g.csv").write_text('Name,Latitude,Longitude,Address,id\n"Hill, North",21.03,105.83,"12 ""A"", Town",1\nX,north,1,,x\n')
    rows = read_locations(spark, str(tmp_path / "g.csv")).orderBy(F.desc("id")).collect()
    assert tuple(rows[0]) == ("Hill, North", 21.03, 105.83, '12 "A", Town', 1)
    assert tuple(rows[1]) == ("X", None, 1.0, None, None)


@pytest.mark.parametrize("rows,pages", [(0, 0), (1, 1), (500, 1), (501, 2), (1000, 2)])
def test_no_page_beyond_the_last_row(rows, pages):
    assert [(p.first, p.end) for p in plan_pages(rows)] == [(i, i + 1) for i in range(pages)]


def test_more_pages_than_partitions():
    plan = plan_pages(1_000_000, 500, 300)
    assert len(plan) <= 300 and plan[0].first == 0 and plan[-1].end == 2000
    assert all(a.end == b.first for a, b in zip(plan, plan[1:]))


class Numbers:
    """1001 records; page 1 fails where asked to."""

    def __init__(self, options):
        self.broken = options.get("broken")

    def count(self):
        return 1001

    def page(self, offset, limit):
        if self.broken == "status" and offset == 500:
            return 503, None
        if self.broken == "error" and offset == 500:
            raise ConnectionError("gone")
        return 200, json.dumps({"list": [{"n": str(i), "extra": [i]} for i in range(offset, min(offset + limit, 1001))], "more": 1})


N = struct(n=T.IntegerType())
N_TEXT = struct(n=T.StringType())


def test_pages(spark):
    register_paged_rest(spark, lambda options: Numbers(options))
    assert sorted(int(r.n) for r in page_rows(read_pages(spark), N_TEXT).collect()) == list(range(1001))
    assert page_rows(read_pages(spark, page_size="100", partitions="3"), N_TEXT).count() == 1001
    assert read_pages(spark, page_size="100", partitions="3").rdd.getNumPartitions() == 3


@pytest.mark.parametrize("broken,status", [("status", 503), ("error", 0)])
def test_a_missing_page_is_not_lost(spark, broken, status):
    register_paged_rest(spark, lambda options: Numbers(options))
    pages = read_pages(spark, broken=broken)
    assert [(r.page, r.status) for r in pages.where("status <> 200").collect()] == [(1, status)]
    with pytest.raises(PySparkException, match=f"page 1: status {status}"):
        page_rows(pages, N_TEXT).collect()


def test_stored_pages(spark, tmp_path):
    body = '{"list":[{"id":4,"Name":"a","Latitude":"1.5","Longitude":"x"}]}'
    spark.createDataFrame([(0, body)], "page long, body string").write.parquet(str(tmp_path / "pages" / "run=0"))
    (tmp_path / "count").mkdir()
    (tmp_path / "count" / "part-0").write_text('{"count":1}')
    register_paged_rest(spark, lambda options: StoredPages(options["path"]))
    for path in (str(tmp_path), f"file:{tmp_path}"):
        assert tuple(read_table(spark, "location", path=path).first()) == (4, "a", 1.5, None, None)
    stored = StoredPages(str(tmp_path))
    assert stored.count() == 1 and stored.page(0, 500) == (200, body)
    assert stored.page(500, 500) == stored.page(500_000, 500) == (404, None)


def test_crawl(spark, tmp_path):
    """Three batches: one answered, one refused, one that breaks. Each is sent once."""
    log = str(tmp_path)

    def transport(request):
        assert list(request) == REQUEST_COLUMNS and request["timezone"] == "Asia/Bangkok"
        first = int(request["latitude"][0])
        Path(log, f"{first}-{len(list(Path(log).glob(f'{first}-*')))}").touch()
        if first == 40:
            return 429, "slow down"
        if first == 70:
            raise TimeoutError("late")
        return 200, json.dumps([{"latitude": a, "current": {"interval": 900}} for a in request["latitude"]])

    places = spark.range(80).select((F.col("id") + 100).alias("id"), F.col("id").cast("double").alias("Latitude"), F.lit(1.0).alias("Longitude"))
    found, failed = crawl(places, transport)
    got = {r.id: json.loads(r.record) for r in found.collect()}
    assert set(got) == set(range(100, 140)) and got[107] == {"latitude": 7.0, "current": {"interval": 900}}
    assert sorted((r.shard, r.status, len(r.ids)) for r in failed.collect()) == [(2, 0, 10), (2, 429, 30)]
    assert sorted(p.name for p in Path(log).iterdir()) == ["0-0", "30-0", "40-0", "70-0"]


def test_stored_tables(spark, tmp_path):
    create_tables(spark, "t_", str(tmp_path))
    create_tables(spark, "t_", str(tmp_path))
    insert_rows(spark.createDataFrame([(1, 1.239, 2)], "locationID long, rain double, shard int"), "t_current", "current")
    row = spark.table("t_current").first()
    assert (row.locationID, str(row.rain), row.shard, row.time) == (1, "1.24", 2, None)
    insert_rows(spark.createDataFrame([(1, 30.0, 1)], "locationID long, temperature_2m_max double, shard int"), "t_daily", "daily")
    assert spark.table("t_daily").first().time_created is not None
    places = spark.createDataFrame([(1, "a", 21.0), (2, "b", 22.0)], "id int, Name string, Latitude double")
    insert_rows(places.where("id = 1"), "t_locations", "locations")
    insert_locations(places.unionByName(places), "t_locations")
    insert_locations(places, "t_locations")
    assert sorted((r.id, str(r.Latitude)) for r in spark.table("t_locations").collect()) == [(1, "21.00000000"), (2, "22.00000000")]
    assert spark.table("t_locations").schema == LOCATIONS_TABLE


def test_database_and_broker_options(spark):
    options = jdbc_options("jdbc:mysql://host/db", "current", "u", "p", connections=3)
    assert options["driver"] == "com.mysql.jdbc.Driver" and options["numPartitions"] == "3" and options["dbtable"] == "current"
    assert jdbc_options("jdbc:postgresql://host/db", "t", "u", "p")["driver"] == "org.postgresql.Driver"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:other://host/db", "t", "u", "p")
    with pytest.raises(Exception, match="com.mysql.jdbc.Driver"):
        append_jdbc(spark.range(1), "jdbc:mysql://host/db", "current", "u", "p")
    assert kafka_options("h:1") == {"kafka.bootstrap.servers": "h:1", "subscribe": "weather_1,weather_2", "startingOffsets": "earliest"}
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "h:1")
    with pytest.raises(Exception, match="(?i)kafka"):
        send_messages(encode_messages(spark.createDataFrame([(2,)], "id int"), "weather"), "h:1")
    rows = spark.createDataFrame([(1, 5), (2, 6)], "shard int, locationID long")
    assert [r.locationID for r in shard_rows(rows, "current", 2).collect()] == [6]
    assert shard_rows(rows, "current", 2).schema == CURRENT_TABLE


def put(spark, folder, *readings):
    """One file of messages: (shard, id, minute, temperature)."""
    rows = spark.createDataFrame(list(readings), "shard int, id long, minute string, t double").coalesce(1)
    encode_messages(rows.select(
        "shard", "id", F.struct(F.col("minute").alias("time"), F.col("t").alias("temperature_2m")).alias("current"),
        F.struct(F.array(F.lit("2024-05-01"), F.lit("2024-05-02")).alias("time"), F.array("t", "t").alias("temperature_2m_max")).alias("daily"),
    )).write.mode("append").parquet(folder)


def ingest(spark, folder, root):
    stream = stored_messages(spark, folder, maxFilesPerTrigger="1")
    query = ingest_to_folder(stream, root, f"{root}/progress", available_now=True)
    query.awaitTermination()
    current = read_folder(spark, root, "current")
    return sorted((r.shard, r.locationID, str(r.time)[:16], r.temperature_2m) for r in current.collect()), read_folder(spark, root, "daily").count()


def test_ingest_restarts_and_replays(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, (1, 1, "2024-05-01T10:15", 20.0), (1, 1, "2024-05-01T10:15", 20.0), (2, 2, "2024-05-01T10:15", 21.0))
    first = [(1, 1, "2024-05-01 10:15", 20.0), (2, 2, "2024-05-01 10:15", 21.0)]
    assert ingest(spark, folder, root) == (first, 6)
    assert ingest(spark, folder, root) == (first, 6)
    put(spark, folder, (1, 1, "2024-05-01T10:15", 99.0), (1, 1, "2024-05-02T10:15", 22.0))
    second = sorted([*first, (1, 1, "2024-05-02 10:15", 22.0)])
    assert ingest(spark, folder, root) == (second, 10)
    # The last batch is tried again, as after a failure before its commit.
    for name in (".1.crc", "1"):
        commit = Path(root, "progress", "commits", name)
        if commit.exists():
            commit.unlink()
    assert ingest(spark, folder, root) == (second, 10)


def test_a_large_file_is_dealt_to_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("obsframe.streaming.ingest.MESSAGES_PER_TASK", 10, raising=False)
    folder, seen = str(tmp_path / "in"), {}
    put(spark, folder, *[(1, n, "2024-05-01T10:15", 20.0) for n in range(45)])  # one file

    def write(table, rows, batch_id):
        seen[table] = [len(p) for p in rows.rdd.glom().collect()]

    stream = stored_messages(spark, folder, maxFilesPerTrigger="1")
    start_ingest(stream, str(tmp_path / "progress"), write, lambda *_: None, available_now=True).awaitTermination()
    assert sum(seen["current"]) == 45 and sum(seen["daily"]) == 90
    assert len(seen["daily"]) >= 5 and max(seen["daily"]) <= 20  # two forecasts a message


def test_ingest_of_bad_messages_only(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    bad = spark.createDataFrame([("weather_1", "{")], "topic string, value string")
    bad.withColumn("value", F.col("value").cast("binary")).write.parquet(folder)
    stream = stored_messages(spark, folder)
    ingest_to_folder(stream, root, f"{root}/progress", available_now=True).awaitTermination()
    put(spark, folder, (1, 1, "2024-05-01T10:15", 20.0))
    assert ingest(spark, folder, root)[0] == [(1, 1, "2024-05-01 10:15", 20.0)]
    put(spark, folder, (1, 4, "some time", 20.0))
    assert ingest(spark, folder, root)[0] == [(1, 1, "2024-05-01 10:15", 20.0), (1, 4, "None", 20.0)]


def test_only_days_of_the_batch_are_listed(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, *[(1, 1, f"2024-05-0{d}T10:15", 20.0) for d in range(1, 6)])
    ingest(spark, folder, root)
    days = [date(2024, 5, 2), date(2024, 5, 4), date(1999, 1, 1)]
    assert len(read_folder(spark, root, "current", days).inputFiles()) == 2
    known = folder_readings(root)
    assert known(spark, 7, days).count() == 2 and known(spark, 0, days).count() == 0
    assert known(spark, 7, [date(1999, 1, 1)]) is None and known(spark, 7, []) is None
    many = [date(2024, 5, 2)] + [date(1990, 1, 1) + timedelta(days=n) for n in range(700)] + [date(2024, 5, 4)]
    assert known(spark, 7, many).count() == 2
    assert days_of(read_folder(spark, root, "current").where("day < '2024-05-02'")) == [date(2024, 5, 1)]


def test_ingest_with_other_sinks(spark, tmp_path):
    folder, written, asked = str(tmp_path / "in"), [], []
    put(spark, folder, (1, 1, "2024-05-01T10:15", 20.0), (2, 2, "2024-05-02T10:15", 21.0))
    known = spark.createDataFrame([(1, datetime(2024, 5, 1, 10, 15))], "locationID long, time timestamp")
    start_ingest(
        stored_messages(spark, folder), str(tmp_path / "progress"),
        lambda table, rows, batch: written.append((table, batch, rows.count())),
        lambda session, batch, days: asked.append((batch, sorted(days))) or known, available_now=True,
    ).awaitTermination()
    assert written == [("current", 0, 1), ("daily", 0, 4)]
    assert asked == [(0, [date(2024, 5, 1), date(2024, 5, 2)])]


def test_distinct_readings(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-05-01 10:15:00"), (1, "2024-05-01 10:15:00"), (1, "2024-05-01 10:30:00"), (2, "2024-05-01 10:15:00")],
                                 "locationID int, time string").withColumn("time", F.col("time").cast("timestamp_ntz"))
    late = rows.limit(1).selectExpr("locationID", "CAST('2024-04-30 06:15:00' AS TIMESTAMP_NTZ) AS time")
    none = rows.limit(1).selectExpr("locationID", "CAST(NULL AS TIMESTAMP_NTZ) AS time")
    for some in (rows, late, rows.unionByName(late), none, none):
        some.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    start_distinct(stream, str(tmp_path / "out"), str(tmp_path / "progress"), available_now=True).awaitTermination()
    assert read_distinct(spark, str(tmp_path / "out"), rows.schema).count() == 5


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_incomplete_pages_fail(spark):
    record = T.StructType([T.StructField("id", T.IntegerType())])
    for body in ('{"list": [{"id": 1}', '{"msg": "x"}', "<html>", None):
        pages = spark.createDataFrame([(0, 200, '{"list": [{"id": 1}, {"id": 2}]}'), (1, 200, body)], "page bigint, status int, body string")
        with pytest.raises(Exception, match="page 1"):
            page_rows(pages, record).collect()
    assert page_rows(pages.where("page = 0"), record).count() == 2


def test_incomplete_responses_are_failures(spark):
    rows = [(1, '["a", "b"]'), (2, '{"a": 1}'), (3, '["a"]'), (4, "text"), (5, '["a", "b", "c"]'), (6, None)]
    responses = spark.createDataFrame([(1, n, [n, 10 + n], 200, body) for n, body in rows], "shard int, batch int, ids array<int>, status int, body string")
    assert sorted((r.id, r.record) for r in records(responses).collect()) == [(1, "a"), (11, "b")]
    assert {r.batch: r.reason for r in failed(responses).collect()} == {
        2: "no list", 3: "number of records", 4: "no list", 5: "number of records", 6: "no list",
    }


def test_unknown_shards_fail(spark):
    for value in ("weather_3", None):
        with pytest.raises(Exception, match="unknown topic"):
            spark.createDataFrame([(value,)], "t string").select(shard_of(F.col("t"))).collect()


def test_a_reading_with_a_value_goes_first(spark):
    rows = spark.createDataFrame([(1, "a", None), (1, "a", 20.0)], "locationID int, time string, value double")
    assert [r.value for r in unseen(rows, None).collect()] == [20.0]
