"""From message streams to stored current and forecast rows."""

from collections.abc import Callable
from functools import reduce
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from obsframe.operators.envelope import current_rows, forecast_rows, parse_messages, valid_messages
from obsframe.operators.shards import shard_of
from obsframe.operators.versions import latest
from obsframe.schemas import CASUAL_METRICS, DAILY_TEMPERATURES, struct

KEY = ["locationID", "time"]

_long, _double, _time = T.LongType(), T.DoubleType(), T.TimestampType()
_folders = {"batch_id": _long, "shard": T.IntegerType(), "day": T.DateType()}
STORED_ROWS = {
    "current": struct(
        locationID=_long, time=_time,
        **{m: T.IntegerType() if m == "is_day" else _double for m in CASUAL_METRICS}, **_folders,
    ),
    "daily": struct(
        locationID=_long, time=_time, **{t: _double for t in DAILY_TEMPERATURES}, sunrise=_time, sunset=_time,
        time_created=_time, **_folders,
    ),
}

# Writes the rows of one batch to the table of the given name.
Sink = Callable[[str, DataFrame, int], None]
# Reads (locationID, time) of the readings that other batches stored for the given days.
Stored = Callable[[SparkSession, int, list[date]], DataFrame | None]
# So many days are listed in one read.
DAYS_PER_READ = 300
# Messages whose parsed rows a task holds.
MESSAGES_PER_TASK = 100_000


def with_shard(messages: DataFrame) -> DataFrame:
    return messages.withColumn("shard", shard_of(F.col("topic")))


def folder_sink(root: str) -> Sink:
    """A folder per table, day, batch and shard; those of a batch are overwritten when it is tried again. A root
    belongs to one checkpoint, which counts the batches.

    Rows are gathered by folder, so that there are few files; adaptive execution splits a large folder again.
    """

    def write(table: str, rows: DataFrame, batch_id: int) -> None:
        marked = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        marked = marked.hint("rebalance", F.col("day"), F.col("shard"))
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "batch_id", "shard").parquet(f"{root}/{table}")

    return write


def folder_readings(root: str) -> Stored:
    """The readings under ``root``; folders of other days are not even listed."""

    def read(spark: SparkSession, batch_id: int, days: list[date]) -> DataFrame | None:
        found = []
        for at in range(0, len(days), DAYS_PER_READ):
            try:
                found.append(read_folder(spark, root, "current", days[at : at + DAYS_PER_READ]))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":  # nothing stored for these days
                    raise
        rows = reduce(DataFrame.unionByName, found) if found else None
        return None if rows is None else rows.where(F.col("batch_id") != batch_id).select(*KEY)

    return read


def read_folder(spark: SparkSession, root: str, table: str, days: list[date] | None = None) -> DataFrame:
    chosen = "*" if days is None else f"{{{','.join(str(d) for d in days)}}}"
    reader = spark.read.schema(STORED_ROWS[table]).option("basePath", f"{root}/{table}")
    return reader.parquet(f"{root}/{table}/day={chosen}")


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.to_date("time"))


def days_of(rows: DataFrame) -> list[date]:
    """The days of a batch; the calendar bounds their number."""
    return sorted(r.day for r in rows.select("day").dropna().distinct().collect())


def unseen(rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """One row per (locationID, time), none that is stored."""
    once = latest(rows, KEY, [F.col(c).asc_nulls_last() for c in rows.columns if c not in KEY])
    return once if stored is None else once.join(stored, KEY, "left_anti")


def spread(messages: DataFrame) -> DataFrame:
    """The messages in tasks of up to MESSAGES_PER_TASK, however unevenly they come."""
    least = -(-messages.count() // MESSAGES_PER_TASK)
    return messages.repartition(max(least, messages.rdd.getNumPartitions())) if least > 1 else messages


def start_ingest(
    messages: DataFrame, checkpoint: str, write: Sink, stored: Stored, available_now: bool = False,
) -> StreamingQuery:
    """Store each message's reading in ``current``, once per place and time, and its forecasts in ``daily``.

    With :func:`folder_sink`, a batch that is tried again after a failure replaces its own rows, so neither
    table gets a row twice.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        parsed = valid_messages(parse_messages(with_shard(spread(batch)), "shard")).persist()
        try:
            readings = with_day(current_rows(parsed, "shard"))
            days = days_of(readings)
            known = None if days == [] else stored(batch.sparkSession, batch_id, days)
            write("current", unseen(readings, known), batch_id)
            created = F.current_timestamp().alias("time_created")
            write("daily", with_day(forecast_rows(parsed, "shard")).select("*", created), batch_id)
        finally:
            parsed.unpersist()

    writer = messages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest_to_folder(messages: DataFrame, root: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    return start_ingest(messages, checkpoint, folder_sink(root), folder_readings(root), available_now)


def start_distinct(
    stream: DataFrame, root: str, checkpoint: str, keys: list[str] = KEY, time: str = "time", available_now: bool = False,
) -> StreamingQuery:
    """Store each reading once per key below ``root``, by day and batch, however late it comes.

    A batch drops what repeats within it and what other batches stored for its days; NULL keys are equal to each
    other. One that is tried again replaces its own rows. A root belongs to one checkpoint. Read it with
    :func:`read_distinct`.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(time, F.col(time).cast("timestamp")).withColumn("day", F.to_date(time))
        once = latest(rows, keys, [F.col(c).asc_nulls_last() for c in rows.columns if c not in keys])
        if batch_id:
            stored = read_distinct(batch.sparkSession, root, T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())]))
            inside = F.col("day").isin(days_of(rows)) | F.col("day").isNull()
            known = stored.where((F.col("batch_id") < batch_id) & inside).select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            once = once.join(known, same, "left_anti")
        marked = once.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "batch_id").parquet(root)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_distinct(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, which may name ``day`` and ``batch_id`` too."""
    return spark.read.schema(schema).parquet(root).select(*schema.names)
