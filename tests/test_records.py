"""Paged records: which pages are fetched, and copies that read only what was added."""

import json
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from obsframe.schemas import struct
from obsframe.sources import history
from obsframe.sources.records import (
    Number, PageIndex, RecordReader, may_match, page_index, parse_body, read_records, register_paged_records, value_of,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = struct(id=T.LongType(), time=T.StringType(), value=T.DoubleType(), note=T.StringType(), ok=T.BooleanType(), n=T.IntegerType())


def record(i, mark=""):
    return {"id": i, "time": f"2024-01-{1 + i // 100:02d}", "value": i / 4, "note": None if i % 3 else {"a": i}, "ok": i % 2 == 0, "n": "text", "more": mark}


class Service:
    """``rows`` records; every page that is asked for is noted in ``log``."""

    def __init__(self, options):
        self.rows, self.log, self.broken = int(options["rows"]), options.get("log"), options.get("broken", "")

    def count(self):
        return self.rows

    def page(self, offset, limit):
        if self.log:
            Path(self.log, str(offset // limit)).touch()
        listed = [record(i) for i in range(offset, min(offset + limit, self.rows + (5 if self.broken == "grown" else 0)))]
        if offset == 50 and self.broken == "status":
            return 503, None
        if offset == 50 and self.broken == "short":
            listed = listed[1:]
        if offset == 50 and self.broken == "list":
            return 200, '{"rows": []}'
        if offset == 50 and self.broken == "repeat":
            listed = [record(i) for i in range(limit)]
        if self.broken == "shifted":
            listed = [record(r["id"] + 1) for r in listed]
        return 200, json.dumps({"list": listed})


@pytest.fixture
def source(spark, tmp_path):
    register_paged_records(spark, lambda options: Service(options))
    log = tmp_path / "log"
    log.mkdir()

    def read(rows, index=None, **options):
        return read_records(spark, SCHEMA, index, rows=str(rows), page_size="50", log=str(log), **options)

    def fetched():
        pages = sorted(int(p.name) for p in log.iterdir())
        for p in log.iterdir():
            p.unlink()
        return pages

    read.fetched = fetched
    return read


def test_whole_table(source):
    rows = source(1005).orderBy("position").collect()
    assert [r.position for r in rows] == [r.id for r in rows] == list(range(1005))
    assert tuple(rows[4]) == (4, 4, "2024-01-01", 1.0, None, True, None) and rows[3].note == '{"a":3}'
    assert source.fetched() == list(range(21))
    assert source(0).count() == 0
    assert source(1005, partitions="3").rdd.getNumPartitions() == 3


def test_positions_tell_the_pages(source):
    assert source(1005).where("position >= 980 and position < 1003").count() == 23
    assert source.fetched() == [19, 20]
    assert source(1005).where("position in (1, 501)").count() == 2
    assert source.fetched() == [0, 10]
    assert source(1005).where("position > 5000").count() == 0
    assert source.fetched() == []


def test_an_index_tells_the_pages(spark, source, tmp_path):
    source(1005).write.parquet(f"{tmp_path}/rows")
    index = PageIndex.from_json(page_index(spark.read.parquet(f"{tmp_path}/rows"), ["id", "time"], 50).to_json())
    source.fetched()
    assert sorted(r.id for r in source(1005, index).where("id between 120 and 130").collect()) == list(range(120, 131))
    assert source.fetched() == [2, 20]  # the last page is not full, so it may have changed
    assert source(1205, index).where("time >= '2024-01-11' and value is not null").count() == 205
    assert source.fetched() == [20, 21, 22, 23, 24]
    assert source(1205, index).where("time = '2024-01-03' and id < 240 and n is null").count() == 40
    assert source.fetched() == [4, 20, 21, 22, 23, 24]
    assert source(500, index).where("id = 7").count() == 1  # fewer records than were indexed: the index says nothing
    assert source.fetched() == list(range(10))
    plan = source(1005, index).where("id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "id" in plan and "Filter" in plan  # Spark still checks every row
    with pytest.raises(Exception, match="pages of 50"):
        read_records(spark, SCHEMA, index, rows="10", page_size="20").count()


@pytest.mark.parametrize("broken,says", [("status", "page 1: status 503"), ("short", "page 1: 49 records of 50"), ("list", "page 1: no list")])
def test_a_page_that_does_not_come_whole_fails_the_job(source, broken, says):
    with pytest.raises(PySparkException, match=says):
        source(120, broken=broken).collect()


def test_rows_are_as_many_as_were_counted(source):
    assert source(120, broken="grown").count() == 120


def test_pages_that_repeat(spark, source, tmp_path):
    source(150, broken="repeat").write.parquet(f"{tmp_path}/rows")
    with pytest.raises(RuntimeError, match="same keys"):
        page_index(spark.read.parquet(f"{tmp_path}/rows"), ["id"], 50)
    with pytest.raises(RuntimeError, match="149 rows of 150"):
        page_index(spark.read.parquet(f"{tmp_path}/rows").where("position <> 3"), ["value"], 50)
    with pytest.raises(ValueError, match="no text"):
        page_index(spark.read.parquet(f"{tmp_path}/rows"), ["ok"], 50)


def test_long_tables_have_longer_runs(spark):
    index = page_index(spark.range(5_000_000).select(F.col("id").alias("position"), "id"), ["id"], 500)
    assert index.run == 5 and len(index.keys["id"]) == 2000 and index.keys["id"][1] == (2500, 4999)
    reader = RecordReader(Service({"rows": "5000000"}), SCHEMA, {"index": index.to_json()})
    list(reader.pushFilters([GreaterThan(("id",), 4_990_000), LessThan(("id",), 4_990_002)]))
    assert reader.wanted(5_000_000) == [9980, 9981, 9982, 9983, 9984]


def test_matches():
    a = ("a",)
    yes = [EqualTo(a, 3), GreaterThan(a, 4), GreaterThanOrEqual(a, 5), LessThan(a, 2), LessThanOrEqual(a, 1), In(a, (9, None, 5)), EqualTo(a, "x")]
    no = [EqualTo(a, 6), GreaterThan(a, 5), GreaterThanOrEqual(a, 6), LessThan(a, 1), LessThanOrEqual(a, 0), In(a, (9, None)), EqualTo(a, None)]
    assert all(may_match(f, 1, 5) for f in yes) and not any(may_match(f, 1, 5) for f in no)
    assert not any(may_match(f, None, None) for f in yes)


def test_values():
    import pyarrow as pa

    row = parse_body('{"list": [{"a": 1.50, "b": "1.50", "c": true, "d": [1, {"x": 2.0}], "e": 3000000000}]}')[0]
    assert [value_of(row[k], pa.string()) for k in "abcde"] == ["1.50", "1.50", "true", '[1,{"x":2.0}]', "3000000000"]
    assert [value_of(row[k], pa.float64()) for k in "abcde"] == [1.5, None, None, None, 3e9]
    assert value_of(row["e"], pa.int32()) is None and value_of(row["e"], pa.int64()) == 3_000_000_000
    assert value_of(Number("1.5"), pa.int64()) is None and value_of(True, pa.bool_()) is True
    assert parse_body("[]") is parse_body(None) is parse_body('{"list": [1]}') is parse_body('{"list": {}}') is None


def ids(spark, folder, **options):
    return sorted(r.id for r in history.read_history(spark, SCHEMA, folder, **options).collect())


def test_history_reads_only_what_was_added(spark, source, tmp_path):
    folder = f"{tmp_path}/copy"
    sync = lambda rows, **options: history.sync(spark, SCHEMA, folder, rows=str(rows), page_size="50", log=f"{tmp_path}/log", **options)
    assert sync(0).version == 0 and ids(spark, folder) == []
    assert sync(320).rows == 320 and source.fetched() == list(range(7))
    assert sync(320).version == 1 and source.fetched() == [6]
    assert sync(405).rows == 405 and source.fetched() == [6, 7, 8]
    assert ids(spark, folder) == list(range(405)) and ids(spark, folder, from_position=400) == list(range(400, 405))
    with pytest.raises(history.HistoryChanged):
        sync(404)
    with pytest.raises(history.HistoryChanged):
        sync(500, broken="shifted")
    assert ids(spark, folder) == list(range(405))  # what a failed run wrote is not read
    assert history.clean(spark, folder) == 2 and ids(spark, folder) == list(range(405))


def test_batches_are_merged(spark, source, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "MERGE", 3)
    folder = f"{tmp_path}/copy"
    for n in range(1, 12):
        state = history.sync(spark, SCHEMA, folder, rows=str(30 * n), page_size="50")
    assert [(b.level, b.rows) for b in state.batches] == [(2, 270), (0, 30), (0, 30)]
    assert ids(spark, folder) == list(range(330)) and ids(spark, folder, from_position=280) == list(range(280, 330))
    assert history.clean(spark, folder) == 12 and ids(spark, folder) == list(range(330))
