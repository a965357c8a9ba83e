"""Stream tables: batches once, few folders, and only files that may hold a key are opened."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from obsframe.schemas import struct
from obsframe.sinks.commits import commit, names
from obsframe.streaming import store
from obsframe.streaming.store import StreamTable
from pyspark.sql import types as T

SCHEMA = struct(place=T.LongType(), time=T.TimestampType(), value=T.DoubleType())


@pytest.fixture
def table(spark, tmp_path):
    return StreamTable(spark, f"{tmp_path}/t", SCHEMA, ["place", "time"], merge=3)


def rows(spark, *some):
    return spark.createDataFrame([(p, t and datetime(2024, 5, 1) + timedelta(hours=t), v) for p, t, v in some], SCHEMA)


def found(table, days=None):
    return sorted(((r.place, str(r.time), r.value) for r in table.read(days).collect()), key=repr)


def test_batches_come_once(spark, table):
    first = rows(spark, (1, 1, 1.0), (1, 1, None), (2, 30, 2.0), (None, None, 3.0))
    assert table.add(first, 0) == 0
    stored = found(table)
    assert len(stored) == 3 and (1, "2024-05-01 01:00:00", 1.0) in stored and found(table, ["2024-05-02"]) == [(2, "2024-05-02 06:00:00", 2.0)]
    table.add(rows(spark, (9, 1, 9.0)), 0)  # a batch that was taken in
    assert found(table) == stored
    again = rows(spark, (1, 1, 5.0), (None, None, 5.0), (3, 30, 4.0))
    assert table.add(again, 1) == 2  # the parts that hold the first two
    assert found(table) == sorted([*stored, (3, "2024-05-02 06:00:00", 4.0)], key=repr)
    assert table.add(rows(spark).where("false"), 2) == 0 and table.state()[1]["batch"] == 2
    assert table.add(rows(spark, (4, 40, 1.0)), 3) == 0  # new keys: nothing is opened


def test_folders_stay_few(spark, table):
    for n in range(8):
        table.add(rows(spark, (n, 1, 1.0), (n, 30, 1.0), (0, 2, 1.0)), n)
        assert max(map(len, table.state()[1]["days"].values())) < 3
    assert len(found(table)) == 17
    before = found(table)
    assert table.clean() > 0 and table.clean() == 0 and found(table) == before
    kept = {b for batches in table.state()[1]["days"].values() for b in batches}
    assert set(names(spark, f"{table.folder}/rows")) == set(names(spark, f"{table.folder}/filters")) == kept
    table.add(rows(spark, (0, 1, 7.0), (7, 30, 7.0), (50, 1, 1.0)), 9)  # keys of merged batches
    assert found(table) == sorted([*before, (50, "2024-05-01 01:00:00", 1.0)], key=repr)


def test_a_merge_or_batch_that_fails_changes_nothing(spark, table, monkeypatch):
    for n in range(2):
        table.add(rows(spark, (n, 1, 1.0)), n)

    def fails(*args):
        raise OSError("gone")

    monkeypatch.setattr(store, "commit", fails)
    with pytest.raises(OSError):
        table.add(rows(spark, (5, 1, 1.0)), 2)
    assert len(found(table)) == 2 and table.state()[1]["batch"] == 1
    monkeypatch.setattr(store, "commit", commit)
    table.merge = 99
    table.add(rows(spark, (5, 1, 1.0), (6, 1, 1.0)), 2)  # tried again, with what its files now hold
    assert [r[0] for r in found(table)] == [0, 1, 5, 6]
    table.merge = 3
    monkeypatch.setattr(store, "commit", fails)
    with pytest.raises(OSError):
        table.compact()
    assert [r[0] for r in found(table)] == [0, 1, 5, 6]
    monkeypatch.setattr(store, "commit", commit)
    assert table.compact() == ["2024-05-01"] and [r[0] for r in found(table)] == [0, 1, 5, 6]


def test_filters_of_many_keys(spark, table):
    many = spark.range(20_000).select(F.col("id").alias("place"), F.lit(datetime(2024, 5, 1)).alias("time"), F.lit(1.0).alias("value"))
    table.add(many, 0)
    part = [("2024-05-01", "batch-0")]
    maps = spark.read.schema(store.FILTER).parquet(f"{table.folder}/filters/batch-0")
    assert maps.count() == 7 and {r.maps for r in maps.collect()} == {7}
    day = F.lit("2024-05-01").alias("day")
    assert all(table.may_hold(many.where(F.col("place") == n).select("*", day), part) == part for n in (0, 77, 19_999))
    others = many.withColumn("place", F.col("place") + 1_000_000).select("*", day)
    none = sum(not table.may_hold(others.where(F.col("place") == 1_000_000 + n), part) for n in range(12))
    assert none >= 8  # about one in BITS seems to be there
    assert table.may_hold(others.where("false"), part) == table.may_hold(others, []) == []
