"""How the given tables stand in for places, readings, forecasts and messages.

The expressions are valid in Spark SQL and in the oracle's SQL; they define inputs, not results.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.functions.geojson import KEEP_NULLS
from obsframe.operators.envelope import encode_messages
from obsframe.operators.position import with_position
from obsframe.schemas import CURRENT_WIRE, ROWS_PER_PAGE
from obsframe.sources.transports import PAGES_PER_FOLDER
from obsframe.workspace import new_path

# lineitem as current readings.
READING = {
    "temperature_2m": "l_quantity",
    "relative_humidity_2m": "l_linenumber",
    "dew_point_2m": "l_discount * 100",
    "apparent_temperature": "l_extendedprice / 1000",
    "precipitation_probability": "l_linenumber * 10",
    "precipitation": "l_tax",
    "rain": "l_discount",
    "showers": "l_tax * l_discount",
    "snowfall": "l_tax * 2",
    "snow_depth": "l_quantity * l_discount",
    "cloud_cover": "l_linenumber * 7",
    "visibility": "l_extendedprice",
    "wind_speed_10m": "l_quantity + l_tax",
    "wind_direction_10m": "CAST(l_quantity AS INT)",
    "wind_gusts_10m": "l_extendedprice / l_quantity",
    "uv_index": "l_tax + l_discount",
    "uv_index_clear_sky": "l_linenumber * 5e-1",
    "is_day": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "sunshine_duration": "l_extendedprice * l_discount",
}

# lineitem as forecasts that are already located.
FORECAST = {
    "temperature_2m_max": "l_quantity",
    "temperature_2m_min": "l_discount * 100",
    "apparent_temperature_max": "l_extendedprice / 1000",
    "apparent_temperature_min": "l_tax * 100",
    "Longitude": "l_discount",
    "Latitude": "l_tax",
}

# Two of the five event types belong to the first shard.
EVENT_SHARD = "CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END"


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def select(df: DataFrame, expressions: dict[str, str], *also: str) -> DataFrame:
    return df.select(*also, *[F.expr(e).alias(n) for n, e in expressions.items()])


def places(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("Name"),
        F.col("c_acctbal").alias("Latitude"), F.col("c_nationkey").cast("double").alias("Longitude"),
        F.concat_ws(", ", "c_name", "c_mktsegment", F.lit("X")).alias("Address"),
    )


def order_messages(spark: SparkSession, folder: str) -> DataFrame:
    """(o_orderkey, topic, value): one message per order, with 1 to 10 forecast days; the sunset is absent on
    the last one."""
    orders = given(spark, folder, "orders")
    days = F.sequence(F.lit(0), (F.col("o_orderkey") % 10).cast("int"))
    minute = "yyyy-MM-dd'T'HH:mm"

    stamps = F.transform(days, lambda i: F.date_format(F.col("o_orderdate") + F.make_dt_interval(i), minute))
    record = orders.withColumns({"_days": days, "_stamps": stamps}).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.lit(1).alias("shard"),
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.date_format("o_orderdate", minute).alias("time"), F.lit(900).alias("interval"),
            F.col("o_totalprice").alias("temperature_2m"), F.lit("n/a").alias("rain"),
            (F.col("o_orderstatus") == "F").cast("int").alias("is_day"),
        ).alias("current"),
        F.struct(
            F.transform("_stamps", lambda s: F.substring(s, 1, 10)).alias("time"),
            F.transform("_days", lambda i: F.col("o_totalprice") + i).alias("temperature_2m_max"),
            F.transform("_days", lambda i: F.col("o_totalprice") - i).alias("temperature_2m_min"),
            F.col("_days").cast("array<double>").alias("apparent_temperature_max"),
            F.transform("_days", lambda i: F.lit(None).cast("double")).alias("apparent_temperature_min"),
            F.col("_stamps").alias("sunrise"),
            F.slice("_stamps", F.lit(1), F.size("_stamps") - 1).alias("sunset"),
        ).alias("daily"),
    )
    return record


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    """(topic, value): one message per event."""
    record = given(spark, folder, "events").select(
        F.expr(EVENT_SHARD).alias("shard"),
        F.col("user_id").alias("id"),
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("value").alias("temperature_2m")
        ).alias("current"),
        F.struct(
            F.array(F.date_format("ts", "yyyy-MM-dd")).alias("time"), F.array("value").alias("temperature_2m_max")
        ).alias("daily"),
    )
    return encode_messages(record)


def daily_wire(spark: SparkSession, folder: str) -> DataFrame:
    """events as untyped forecast versions: one per event, for the day it falls on."""
    return given(spark, folder, "events").select(
        F.col("event_id").cast("int").alias("id"), F.col("user_id").cast("string").alias("locationID"),
        F.date_format("ts", "yyyy-MM-dd").alias("time"),
        F.col("value").cast("string").alias("temperature_2m_min"),
        (F.col("value") + 1).cast("string").alias("temperature_2m_max"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("apparent_temperature_min"),
        (F.col("value") * 2).cast("string").alias("apparent_temperature_max"),
        F.lit(None).cast("string").alias("sunrise"), F.lit(None).cast("string").alias("sunset"),
        F.col("ts").cast("string").alias("time_created"),
    )


def current_wire(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as untyped readings; the seventh line of an order has no number for its rain."""
    wire = select(given(spark, folder, "lineitem"), READING, "l_suppkey", "l_shipdate", "l_linenumber")
    rain = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("rain").cast("string"))
    return wire.withColumns({
        "locationID": F.col("l_suppkey"), "time": F.date_format("l_shipdate", "yyyy-MM-dd"), "rain": rain,
    }).select(*[F.col(f.name).cast(f.dataType) for f in CURRENT_WIRE])


def store_pages(df: DataFrame, key: str) -> str:
    """Keep a table the way the paged service would answer: a JSON body per page, and the number of records."""
    folder = new_path(df.sparkSession, "pages")
    seated = with_position(df, [key])
    record = F.struct("position", F.struct(*df.columns).alias("record"))
    (
        seated.groupBy(F.floor(F.col("position") / ROWS_PER_PAGE).alias("page"))
        .agg(F.sort_array(F.collect_list(record)).alias("list"))
        .select("page", F.to_json(F.struct(F.col("list.record").alias("list")), KEEP_NULLS).alias("body"))
        .withColumn("run", F.floor(F.col("page") / PAGES_PER_FOLDER)).repartition("run")
        .write.partitionBy("run").parquet(f"{folder}/pages")
    )
    df.agg(F.to_json(F.struct(F.count("*").alias("count"))).alias("body")).write.text(f"{folder}/count")
    return folder


def store_messages(messages: DataFrame, copies: int = 1) -> str:
    folder = new_path(messages.sparkSession, "messages")
    for _ in range(copies):
        messages.write.mode("append").parquet(folder)
    return folder
