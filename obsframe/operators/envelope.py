"""Messages of one location each: writing them, and reading them into current and forecast rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.functions.casts import minute
from obsframe.functions.geojson import KEEP_NULLS
from obsframe.operators.shards import topic_of
from obsframe.schemas import CASUAL_METRICS, DAILY_TEMPERATURES, DAILY_VARIABLES, FORECAST_DAYS, MESSAGE


def encode_messages(records: DataFrame, topic: str | None = None) -> DataFrame:
    """(topic, value) per record; ``shard`` picks the topic, where none is given, and every other column goes
    into the message."""
    fields = [c for c in records.columns if c != "shard"]
    return records.select(
        (topic_of(F.col("shard")) if topic is None else F.lit(topic)).alias("topic"),
        F.to_json(F.struct(*fields), KEEP_NULLS).cast("binary").alias("value"),
    )


def tag_records(records: DataFrame) -> DataFrame:
    """(topic, value) per (shard, id, record): the JSON object of the record with the id of its place added."""
    inside = F.trim(F.regexp_replace("record", r"^\s*\{|\}\s*$", ""))
    tagged = F.concat(
        F.lit("{"), inside, F.when(inside != "", ",").otherwise(""), F.lit('"id":'), F.col("id").cast("string"), F.lit("}")
    )
    return records.select(topic_of(F.col("shard")).alias("topic"), tagged.cast("binary").alias("value"))


def entries(messages: DataFrame, *keep: str) -> DataFrame:
    """One row (id, data) per top-level field of each message; nested values stay JSON text."""
    parsed = F.from_json(F.col("value").cast("string"), "map<string,string>")
    return messages.select(*keep, F.explode(parsed).alias("id", "data"))


def parse_messages(messages: DataFrame, *keep: str) -> DataFrame:
    """(id, current, daily) of each message; text that is no JSON object gives NULLs.

    The parse is the input of a generator, so filters on its fields do not parse the text again.
    """
    parsed = F.from_json(F.col("value").cast("string"), MESSAGE)
    return messages.select(*keep, F.inline(F.array(parsed)))


def valid_messages(parsed: DataFrame) -> DataFrame:
    """Messages that have all three parts."""
    return parsed.where(F.col("id").isNotNull() & F.col("current").isNotNull() & F.col("daily").isNotNull())


def _metric(name: str) -> Column:
    kind = "int" if name == "is_day" else "double"
    return F.col(f"current.{name}").try_cast(kind).alias(name)


def current_rows(parsed: DataFrame, *keep: str) -> DataFrame:
    """The one current reading of each message."""
    return parsed.select(
        *keep, F.col("id").try_cast("bigint").alias("locationID"),
        minute(F.col("current.time")).alias("time"),
        *[_metric(m) for m in CASUAL_METRICS],
    )


def forecast_rows(parsed: DataFrame, *keep: str, days: int = FORECAST_DAYS) -> DataFrame:
    """One row per forecast day, up to ``days``; where an array is absent or shorter than another its column is
    NULL."""
    arrays = [F.coalesce(f"daily.{v}", F.array().cast("array<string>")).alias(v) for v in ("time", *DAILY_VARIABLES)]
    zipped = F.arrays_zip("time", *DAILY_VARIABLES)
    return (
        parsed.select(*keep, F.col("id").try_cast("bigint").alias("locationID"), *arrays)
        .select(*keep, "locationID", F.inline(F.slice(zipped, 1, days)))
        .select(
            *keep, "locationID", F.col("time").try_cast("timestamp").alias("time"),
            *[F.col(t).try_cast("double").alias(t) for t in DAILY_TEMPERATURES],
            minute(F.col("sunrise")).alias("sunrise"), minute(F.col("sunset")).alias("sunset"),
        )
    )
