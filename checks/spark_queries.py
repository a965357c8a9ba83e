"""One query per operator, each over whole tables."""

import json
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import checks
from checks.standins import (
    EVENT_SHARD, FORECAST, READING, current_wire, daily_wire, event_messages, given, order_messages, places, select,
    store_messages, store_pages,
)
from obsframe.functions.casts import count_misfits, local_time, typed
from obsframe.functions.geojson import ring
from obsframe.functions.text import address_part, grid, page_query
from obsframe.operators import cluster
from obsframe.operators.correlate import spearman_long
from obsframe.operators.envelope import (
    current_rows, encode_messages, entries, forecast_rows, parse_messages, tag_records, valid_messages,
)
from obsframe.operators.kmeans import Centres, assign_centres, fit_centres
from obsframe.operators.lookup import lookup_join
from obsframe.operators.nearest import nearest_join
from obsframe.operators.places import locate
from obsframe.operators.position import with_position
from obsframe.operators.shards import shard_sizes, split_shards, table_of, topic_of, union_shards
from obsframe.operators.states import mean_of, merge_states, partial_states
from obsframe.operators.versions import insert_ignore, latest_forecasts
from obsframe.plans.crawl import crawl
from obsframe.plans.incremental import Store, add_forecasts, daily_summary
from obsframe.plans.jobs import daily_features, outline_features, run_and_store, run_current
from obsframe.schemas import CASUAL_METRICS, CURRENT_TABLE, DAILY_TEMPERATURES, FULL_METRICS, ROWS_PER_PAGE, TIMEZONE
from obsframe.sinks.tables import append_by_shard, append_to, create_tables, insert_rows, read_refused
from obsframe.sources.history import read_history, sync
from obsframe.sources.locations import read_locations
from obsframe.sources.paged import page_rows, read_pages, read_table, register_paged_rest
from obsframe.sources.records import page_index, read_records, register_paged_records
from obsframe.sources.requests import build_requests, failed, profile, succeeded
from obsframe.sources.streams import stored_messages
from obsframe.sources.transports import StoredPages
from obsframe.streaming.ingest import MESSAGES_PER_TASK, ingest_to_folder, read_distinct, read_folder, start_distinct
from obsframe.streaming.store import ingest_to_tables, stream_tables
from obsframe.workspace import materialize, new_path

cloudpickle.register_pickle_by_value(checks)

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
RUN_TIME = "2024-05-01 10:15:00"


def r4(value: Column | str) -> Column:
    """To four decimals. The shift keeps exact ties from rounding by the order in which a mean was summed."""
    return F.round((F.col(value) if isinstance(value, str) else value) + 1e-9, 4)


# Sources, shards and requests

def q_location_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "locations-csv")
    places(spark, sf).select("Name", "Latitude", "Longitude", "Address", "id").write.csv(path, header=True)
    return read_locations(spark, path)


def q_shard_split(spark, sf):
    return split_shards(places(spark, sf)).select("id", "position", "shard", "seat")


def q_shard_sizes(spark, sf):
    return shard_sizes(split_shards(places(spark, sf)))


def q_shard_union(spark, sf):
    events = given(spark, sf, "events").select("event_id", "user_id", "value", F.expr(EVENT_SHARD).alias("of"))
    first, second = events.where("of = 1").drop("of"), events.where("of = 2").drop("of")
    return union_shards(first, second)


def q_shard_route(spark, sf):
    path = new_path(spark, "routed")
    shard = F.col("shard")
    append_by_shard(
        split_shards(places(spark, sf)).select(
            "id", "shard", topic_of(shard).alias("topic"),
            table_of(shard, "current").alias("current_table"), table_of(shard, "daily").alias("daily_table"),
        ),
        path,
    )
    return spark.read.parquet(path)


def q_fetch_requests(spark, sf):
    return build_requests(split_shards(places(spark, sf))).select(
        "shard", "batch", F.size("ids").alias("n"), F.element_at("ids", 1).alias("first_id"),
        F.element_at("ids", -1).alias("last_id"), "points", F.array_join("current", ",").alias("variables"),
    )


def q_fetch_records(spark, sf):
    def echo(request):
        return 200, json.dumps([
            {"latitude": lat, "current": {"interval": 900, "temperature_2m": lat}, "daily": {"temperature_2m_max": [lon]}}
            for lat, lon in zip(request["latitude"], request["longitude"])
        ])

    found, _ = crawl(places(spark, sf), echo, connections=spark.sparkContext.defaultParallelism)
    return parse_messages(tag_records(found), "topic").select(
        "topic", F.col("id").cast("bigint").alias("id"), F.col("current.temperature_2m").cast("double").alias("latitude"),
        F.get("daily.temperature_2m_max", F.lit(0)).cast("double").alias("longitude"),
    )


def q_fetch_errors(spark, sf):
    responses = given(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"), F.col("props").alias("body")
    )
    good = succeeded(responses).select("event_id", "status", "body", F.lit("record").alias("goes_to"))
    return good.unionByName(failed(responses).select("event_id", "status", "body", F.lit("error").alias("goes_to")))


def q_page_slice(spark, sf):
    seated = with_position(given(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    page = F.floor(F.col("position") / ROWS_PER_PAGE).alias("page")
    return seated.groupBy(page).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    ).withColumn("query", page_query(F.col("page"), ROWS_PER_PAGE))


def _open_stored_pages(options):
    return StoredPages(options["path"])


def q_rest_pages(spark, sf):
    orders = given(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    folder = store_pages(orders, "o_orderkey")
    register_paged_rest(spark, _open_stored_pages)
    tasks = str(2 * spark.sparkContext.defaultParallelism)
    return page_rows(read_pages(spark, path=folder, partitions=tasks), orders.schema)


def q_rest_table(spark, sf):
    folder = store_pages(places(spark, sf), "id")
    register_paged_rest(spark, _open_stored_pages)
    return read_table(spark, "location", path=folder)


EVENT_RECORD = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def _event_records(spark, sf):
    return given(spark, sf, "events").select("event_id", F.date_format("ts", MICROS).alias("ts"), "event_type", "value")


def q_paged_filter(spark, sf):
    """A filtered read that fetches the pages an index of the table's last whole read points to."""
    folder = store_pages(_event_records(spark, sf), "event_id")
    register_paged_records(spark, _open_stored_pages)
    whole = materialize(read_records(spark, EVENT_RECORD, path=folder), "event-records")
    middle = whole.agg(F.min("ts"), F.max("event_id")).first()
    index = page_index(whole, ["event_id", "ts"])
    rows = read_records(spark, EVENT_RECORD, index, path=folder)
    return rows.where((F.col("event_id") >= middle[1] // 2) & (F.col("ts") >= middle[0])).drop("position")


def q_history_sync(spark, sf):
    """A copy of a paged table that grows from two thirds to the whole between two reads."""
    events = _event_records(spark, sf)
    most = events.agg(F.max("event_id")).first()[0]
    copy = new_path(spark, "history")
    register_paged_records(spark, _open_stored_pages)
    for rows in (events.where(F.col("event_id") <= most * 2 // 3), events):
        sync(spark, EVENT_RECORD, copy, path=store_pages(rows, "event_id"))
    return read_history(spark, EVENT_RECORD, copy)


def q_profile_select(spark, sf):
    lineitem = given(spark, sf, "lineitem")
    every = select(lineitem, {m: READING.get(m, "l_orderkey") for m in FULL_METRICS}, "l_partkey")
    return profile(every, "casual", ["l_partkey"])


# Types and functions

def q_typed_current(spark, sf):
    return typed(current_wire(spark, sf), "current")


def q_typed_daily(spark, sf):
    rows = typed(daily_wire(spark, sf), "daily")
    return rows.drop("sunrise", "sunset").withColumns({
        "time": F.date_format("time", MICROS), "time_created": F.date_format("time_created", MICROS),
    })


def q_typed_location(spark, sf):
    wire = places(spark, sf).withColumns({
        "Latitude": F.col("Latitude").cast("string"),
        "Longitude": F.when(F.col("Address").contains("BUILDING"), "east").otherwise(F.col("Longitude").cast("string")),
    })
    return typed(wire, "location")


def q_local_time(spark, sf):
    moment = local_time(F.col("ts").cast("timestamp"), TIMEZONE)
    return given(spark, sf, "events").select("event_id", F.date_format(moment, MICROS).alias("local"))


def q_grid_cell(spark, sf):
    return given(spark, sf, "customer").select("c_custkey", grid(F.col("c_acctbal")).cast("decimal(12,1)").alias("cell"))


def q_address_part(spark, sf):
    address = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name"))
        .when(F.col("c_mktsegment") != "MACHINERY", F.concat_ws(", ", "c_name", "c_mktsegment", F.lit("X")))
    )
    return given(spark, sf, "customer").select("c_custkey", address_part(address).alias("part"))


# Messages

def q_message_encode(spark, sf):
    record = given(spark, sf, "events").select(
        F.expr(EVENT_SHARD).alias("shard"), "event_id", "event_type", "value", F.lit(None).cast("string").alias("note")
    )
    return encode_messages(record).select("topic", F.col("value").cast("string").alias("text"))


def q_envelope_entries(spark, sf):
    return entries(event_messages(spark, sf), "topic")


def _orders_encoded(spark, sf):
    record = order_messages(spark, sf)
    return encode_messages(record.select("shard", "id", "current", "daily"))


def q_parse_envelope(spark, sf):
    return parse_messages(_orders_encoded(spark, sf)).select(
        F.col("id").cast("bigint").alias("id"), F.col("current.time").alias("time"),
        F.col("current.temperature_2m").cast("double").alias("temperature_2m"),
        F.col("current.rain").alias("rain"), F.size("daily.time").alias("days"),
        F.size("daily.sunset").alias("sunsets"),
    )


def q_valid_messages(spark, sf):
    record = order_messages(spark, sf).select(
        "shard",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("id")).alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("current")).alias("current"),
        F.when(F.col("o_orderstatus") != "P", F.col("daily")).alias("daily"),
        F.col("o_orderkey"),
    )
    cut = F.when(F.get_json_object(F.col("value").cast("string"), "$.current.is_day") == "1",
                 F.lit("{\"id\": 1, \"cur").cast("binary")).otherwise(F.col("value"))
    sent = encode_messages(record).withColumn("value", cut)
    return valid_messages(parse_messages(sent)).select(F.col("id").cast("bigint").alias("id"))


def q_current_rows(spark, sf):
    rows = current_rows(valid_messages(parse_messages(_orders_encoded(spark, sf))))
    return rows.select("locationID", F.date_format("time", MICROS).alias("time"), "temperature_2m", "rain", "is_day")


def q_forecast_rows(spark, sf):
    rows = forecast_rows(valid_messages(parse_messages(_orders_encoded(spark, sf))))
    stamps = {c: F.date_format(c, MICROS) for c in ("time", "sunrise", "sunset")}
    return rows.withColumns(stamps)


# Versions, joins, inserts

def _event_versions(spark, sf):
    return given(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("locationID"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("time"),
        F.col("ts").cast("timestamp").alias("time_created"), "value",
    )


def q_latest_daily(spark, sf):
    return latest_forecasts(_event_versions(spark, sf)).select(
        "id", "locationID", F.date_format("time", MICROS).alias("time"), "value"
    )


def q_location_join(spark, sf):
    located = locate(latest_forecasts(_event_versions(spark, sf)), places(spark, sf).select("id", "Name", "Latitude", "Longitude"))
    return located.select("id", "locationID", "value", "Name", "Latitude", "Longitude")


def q_location_join_current(spark, sf):
    readings = given(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", F.lit("unknown")).otherwise(F.col("l_suppkey").cast("string")).alias("locationID"),
        "l_orderkey", "l_linenumber", "l_quantity",
    )
    return locate(readings, places(spark, sf).select("id", "Latitude", "Longitude"))


def q_insert_ignore(spark, sf):
    known = places(spark, sf).where(F.col("Latitude") >= 0)
    new = places(spark, sf).unionByName(places(spark, sf))
    return insert_ignore(new, known, "id")


# Clusters

def q_cluster_assign(spark, sf):
    vectors = given(spark, sf, "embeddings")
    means = cluster.mean_vectors(vectors, "label", "embedding")
    return cluster.assign_given(vectors, "embedding", means).select("vec_id", "label", "prediction")


def _kmeans_check(df: DataFrame, features: list[str]) -> DataFrame:
    """How many rows were assigned, to how many clusters, and how many of them to another than the nearest."""
    stored = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    model = cluster.fit_clusters(stored, features, partitions=df.sparkSession.sparkContext.defaultParallelism)
    found = cluster.centres(model)
    to_centre = [sum(((F.col(c) - x) * (F.col(c) - x) for c, x in zip(features, centre)), F.lit(0.0)) for centre in found]
    own = F.get(F.array(*to_centre), F.col("prediction"))
    return cluster.assign_clusters(model, stored).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("prediction").alias("n_clusters"),
        F.count_if(own > F.least(*to_centre) * (1 + 1e-9) + 1e-6).alias("n_misassigned"),
    )


def q_kmeans_daily(spark, sf):
    return _kmeans_check(select(given(spark, sf, "lineitem"), FORECAST), cluster.DAILY_FEATURES)


def q_kmeans_current(spark, sf):
    return _kmeans_check(select(given(spark, sf, "lineitem"), READING), cluster.CURRENT_FEATURES)


def q_kmeans_centres(spark, sf):
    """Centres after three rounds from seeds by hash, and how many rows are nearest to each."""
    rows = select(given(spark, sf, "lineitem"), {**FORECAST, "key": "l_orderkey * 10 + l_linenumber"})
    rows = materialize(rows, "kmeans-rows")
    found = fit_centres(rows, cluster.DAILY_FEATURES, 4, "key", rounds=3)
    sizes = assign_centres(rows, found).groupBy("prediction").agg(F.count("*").alias("n"))
    centres = spark.createDataFrame([(i, *c) for i, c in enumerate(found.values)], ["prediction", *found.features])
    return centres.join(F.broadcast(sizes), "prediction").select(
        F.col("prediction").cast("int").alias("prediction"), "n", *[F.round(f, 9).alias(f) for f in found.features]
    )


def q_summary_states(spark, sf):
    """Means of three parts of a table, from the merged states of each."""
    flags, means = ["is_day"], [m for m in CASUAL_METRICS if m != "is_day"]
    rows = select(
        given(spark, sf, "lineitem"),
        {**READING, "is_day": "l_returnflag = 'R'", "time": "l_shipdate", "prediction": "l_linenumber", "part": "l_returnflag"},
    )
    by, path = ["time", "prediction"], new_path(spark, "states")
    for part in [r.part for r in rows.select("part").distinct().collect()]:
        partial_states(rows.where(F.col("part") == part), by, means, flags).write.mode("append").parquet(path)
    merged = merge_states(spark.read.parquet(path), by, means, flags)
    return merged.select(
        F.date_format("time", MICROS).alias("time"), "prediction", F.col("is_day_any").alias("avg_is_day"),
        *[r4(mean_of(m)).alias(f"avg_{m}") for m in means],
    )


GIVEN_CENTRES = [[float(n * 8), float(n * 3000 - 1000), float(n * 100), 20.0, 100.0 * n, 30.0] for n in range(3)]


def q_incremental_daily(spark, sf):
    """Summaries by day and nearest of three given centres, from two runs, the second with later versions and days."""
    wire = typed(daily_wire(spark, sf), "daily")
    versions = wire.withColumns({"shard": F.lit(1), "apparent_temperature_min": F.coalesce("apparent_temperature_min", F.lit(0.0))})
    store = Store(spark, new_path(spark, "store"))
    store.keep("daily", Centres(cluster.DAILY_FEATURES, GIVEN_CENTRES))
    cut = versions.agg(F.expr("timestamp_micros(cast(avg(unix_micros(time_created)) as bigint))")).first()[0]
    for run in (versions.where(F.col("time_created") < cut), versions.where(F.col("time_created") >= cut)):
        add_forecasts(store, run, places(spark, sf))
    return daily_summary(store).select(
        F.date_format("time", MICROS).alias("time"), "prediction",
        *[r4(c).alias(c) for c in (*DAILY_TEMPERATURES, "centroid_Longitude", "centroid_Latitude")],
    )


def q_cluster_summary_daily(spark, sf):
    clustered = select(given(spark, sf, "lineitem"), {**FORECAST, "time": "l_shipdate", "prediction": "l_linenumber"})
    summary = cluster.summarize_daily(clustered)
    return summary.select(
        F.date_format("time", MICROS).alias("time"), "prediction",
        *[r4(c).alias(c) for c in (*DAILY_TEMPERATURES, "centroid_Longitude", "centroid_Latitude")],
    )


def q_cluster_summary_current(spark, sf):
    clustered = select(
        given(spark, sf, "lineitem"),
        {**READING, "is_day": "l_returnflag = 'R'", "time": "l_shipdate", "prediction": "l_linenumber"},
    )
    means = [f"avg_{m}" for m in CASUAL_METRICS if m != "is_day"]
    return cluster.summarize_current(clustered).select(
        F.date_format("time", MICROS).alias("time"), "prediction", "avg_is_day", *[r4(c).alias(c) for c in means]
    )


def _customers_by_nation(spark, sf):
    return given(spark, sf, "customer").select(
        F.col("c_custkey").alias("locationID"), F.col("c_nationkey").alias("prediction"),
        F.col("c_acctbal").alias("Latitude"), (F.col("c_custkey") % 360).cast("double").alias("Longitude"),
        *[F.col("c_acctbal").alias(t) for t in DAILY_TEMPERATURES],
    )


def q_cluster_points(spark, sf):
    return cluster.cluster_points(_customers_by_nation(spark, sf), ["prediction"], parts=3).select(
        "prediction", "part", F.size("points").alias("n"), F.to_json(ring(F.col("points"))).alias("coordinates")
    )


def q_cluster_centroid(spark, sf):
    return cluster.centroids(_customers_by_nation(spark, sf)).select(
        "prediction", r4("centroid_Longitude").alias("centroid_Longitude"), r4("centroid_Latitude").alias("centroid_Latitude")
    )


def _named(spark, sf):
    names = given(spark, sf, "nation").select(F.col("n_nationkey").alias("prediction"), F.col("n_name").alias("centroid_address"))
    centres = materialize(cluster.centroids(_customers_by_nation(spark, sf)), "nation-centroids")
    return materialize(lookup_join(centres, names, ["prediction"], stored=True), "nation-names")


def q_cluster_named(spark, sf):
    summary = cluster.summarize_daily(_customers_by_nation(spark, sf), ["prediction"])
    return cluster.join_names(summary, _named(spark, sf)).select(
        "prediction", "centroid_address", r4("centroid_Latitude").alias("centroid_Latitude"),
        *[r4(t).alias(t) for t in DAILY_TEMPERATURES],
    )


def q_geojson(spark, sf):
    customers = _customers_by_nation(spark, sf)
    summary = cluster.join_names(cluster.summarize_daily(customers, ["prediction"]), _named(spark, sf))
    points = cluster.cluster_points(customers, ["prediction"], parts=3)
    rounded = summary.select("prediction", "centroid_address", *[r4(t).alias(t) for t in DAILY_TEMPERATURES])
    return daily_features(materialize(rounded, "geojson-summary"), points, ["prediction"])


def q_geojson_hull(spark, sf):
    """The outline of each nation's customers, and its corners in order, from the feature."""
    customers = _customers_by_nation(spark, sf)
    summary = cluster.join_names(cluster.summarize_daily(customers, ["prediction"]), _named(spark, sf))
    rounded = summary.select("prediction", "centroid_address", *[r4(t).alias(t) for t in DAILY_TEMPERATURES])
    found = outline_features(materialize(rounded, "hull-summary"), customers, ["prediction"])
    shape = T.StructType([
        T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))])),
        T.StructField("properties", T.StructType([T.StructField("name", T.StringType())])),
    ])
    parsed = found.select("prediction", F.from_json("geojson", shape).alias("f"))
    ring_ = F.get("f.geometry.coordinates", F.lit(0))
    return parsed.select("prediction", F.col("f.properties.name").alias("name"), F.col("f.geometry.type").alias("type"), F.posexplode(ring_).alias("place", "at")).select(
        "prediction", "name", "type", "place", F.get("at", F.lit(0)).alias("lon"), F.get("at", F.lit(1)).alias("lat"),
    )


def q_reverse_geocode(spark, sf):
    queries = given(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("lat"), F.col("s_nationkey").cast("double").alias("lon")
    )
    gazetteer = places(spark, sf).select(
        F.col("id").alias("place_id"), F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"), "Address"
    )
    found = nearest_join(queries, gazetteer, ["lat", "lon"], "place_id", ["Address"])
    return found.select(
        "s_suppkey", "place_id", address_part(F.col("Address")).alias("name"), r4("squared_distance").alias("squared_distance")
    )


def q_spearman_long(spark, sf):
    lineitem = given(spark, sf, "lineitem")
    metrics = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return spearman_long(lineitem, metrics, F.lit(RUN_TIME).cast("timestamp")).withColumn(
        "correlation", F.round(F.col("correlation") + 1e-9, 6)
    )


# Stored tables and streams

def _table_rows(spark, sf):
    return select(given(spark, sf, "lineitem"), {
        "locationID": "l_suppkey", "time": "l_shipdate", "temperature_2m": "l_quantity", "rain": "l_discount",
        "apparent_temperature": "l_extendedprice", "precipitation": "l_tax", "wind_direction_10m": "l_linenumber",
        "uv_index": "l_linenumber + 0.55D", "visibility": "l_quantity * 8.375D",
        "shard": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END",
    })


def q_ddl_typed_table(spark, sf):
    prefix = f"check_{uuid.uuid4().hex}_"
    create_tables(spark, prefix, new_path(spark, "tables"))
    insert_rows(_table_rows(spark, sf), f"{prefix}current", "current", as_null=True)
    numbers = ["temperature_2m", "rain", "apparent_temperature", "precipitation", "snowfall"]
    return spark.table(f"{prefix}current").select(
        "locationID", F.date_format("time", MICROS).alias("time"), "wind_direction_10m", "uv_index", "visibility", "shard",
        *[F.col(c).cast("double").alias(c) for c in numbers],
    )


def q_table_misfits(spark, sf):
    return count_misfits(_table_rows(spark, sf), CURRENT_TABLE)


def q_refused_rows(spark, sf):
    """What an insert refuses: rows with a temperature or a visibility that the table has no room for."""
    rows = select(given(spark, sf, "lineitem"), {
        "locationID": "l_orderkey", "time": "l_shipdate", "temperature_2m": "l_quantity * 30", "visibility": "l_extendedprice * 1e5",
        "wind_direction_10m": "l_linenumber", "shard": "1",
    })
    prefix, errors = f"refused_{uuid.uuid4().hex}_", new_path(spark, "errors")
    create_tables(spark, prefix, new_path(spark, "tables"))
    written = insert_rows(rows, f"{prefix}current", "current", errors)
    refused = read_refused(spark, errors)
    field = lambda name: F.get_json_object("row", f"$.{name}")
    listed = refused.select(
        field("locationID").cast("bigint").alias("orderkey"), field("wind_direction_10m").cast("int").alias("line"),
        F.array_join("columns", ",").alias("columns"), F.round(field("visibility").cast("double"), 2).alias("visibility"),
    )
    kept = spark.table(f"{prefix}current").agg(
        F.lit(None).cast("bigint").alias("orderkey"), F.lit(written.refused).cast("int").alias("line"), F.lit("kept").alias("columns"),
        F.count("*").cast("double").alias("visibility"),
    )
    return listed.unionByName(kept)


def _ingested(spark, sf, table):
    root = new_path(spark, "ingest")
    messages = stored_messages(spark, store_messages(event_messages(spark, sf)))
    ingest_to_folder(messages, root, f"{root}/progress", available_now=True).awaitTermination()
    return read_folder(spark, root, table).withColumn("time", F.date_format("time", MICROS))


def q_stream_ingest(spark, sf):
    return _ingested(spark, sf, "current").select("locationID", "time", "temperature_2m", "shard")


def q_stream_forecasts(spark, sf):
    return _ingested(spark, sf, "daily").select("locationID", "time", "temperature_2m_max", "sunrise", "shard")


def q_stream_tables(spark, sf):
    """Readings that came twice, in four batches, in tables that merge every two batches of a day."""
    root = new_path(spark, "stream-tables")
    messages = event_messages(spark, sf)
    # Files of bounded size, half of a copy in each batch.
    files = max(1, -(-given(spark, sf, "events").count() // (2 * MESSAGES_PER_TASK)))
    folder = store_messages(messages.repartition(2 * files), copies=2)
    stream = stored_messages(spark, folder, maxFilesPerTrigger=str(files))
    ingest_to_tables(stream, root, f"{root}/progress", available_now=True, merge=2).awaitTermination()
    found = stream_tables(spark, root)["current"].read()
    return found.select("locationID", F.date_format("time", MICROS).alias("time"))


def q_stream_dedup(spark, sf):
    root = new_path(spark, "distinct")
    readings = given(spark, sf, "events").select(
        F.col("user_id").alias("locationID"), F.col("ts").cast("timestamp").alias("time"), "value"
    )
    stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(store_messages(readings, copies=2))
    start_distinct(stream, f"{root}/rows", f"{root}/progress", available_now=True).awaitTermination()
    return read_distinct(spark, f"{root}/rows", readings.schema).withColumn("time", F.date_format("time", MICROS))


def q_run_once(spark, sf):
    """Points per day in the daily features, and the sizes of the other two results."""
    at = places(spark, sf)
    gazetteer = at.select(
        F.col("id").alias("place_id"), (F.col("Latitude") / 200).alias("lat"), F.col("Longitude").alias("lon"),
        F.col("Address").alias("address"),
    )
    at = at.withColumn("Latitude", F.col("Latitude") / 200)
    out = new_path(spark, "results")
    run_and_store(
        typed(daily_wire(spark, sf), "daily").fillna(0.0, DAILY_TEMPERATURES),
        typed(current_wire(spark, sf), "current").fillna(0.0), at, gazetteer, append_to(out), F.lit(RUN_TIME).cast("timestamp"), parts=3,
    )
    result = {name: spark.read.parquet(f"{out}/{name}") for name in ("daily_geojson", "current_summary", "current_correlation")}
    shape = T.StructType([T.StructField("geometry", T.StructType([
        T.StructField("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))),
    ]))])
    points = F.size(F.get(F.from_json("geojson", shape)["geometry"]["coordinates"], F.lit(0)))
    daily = result["daily_geojson"].groupBy(F.date_format("time", "yyyy-MM-dd").alias("of")).agg(F.sum(points).alias("n"))
    times = result["current_summary"].agg(F.lit("times").alias("of"), F.count_distinct("time").alias("n"))
    pairs = result["current_correlation"].agg(F.lit("pairs").alias("of"), F.count("*").alias("n"))
    return daily.unionByName(times).unionByName(pairs)


def q_run_one_cluster(spark, sf):
    """Means of all readings of a time, as a run with one cluster has them, and how many readings have no cluster."""
    at = places(spark, sf)
    gazetteer = at.select(
        F.col("id").alias("place_id"), (F.col("Latitude") / 200).alias("lat"), F.col("Longitude").alias("lon"), F.col("Address").alias("address"),
    )
    wire = typed(current_wire(spark, sf), "current")
    result = run_current(wire, at, gazetteer, F.lit(RUN_TIME).cast("timestamp"), k=1)
    means = [f"avg_{m}" for m in CASUAL_METRICS if m != "is_day"]
    summary = result.tables["current_summary"].select("time", "prediction", "avg_is_day", *[r4(m).alias(m) for m in means])
    skipped = result.skipped["current"].agg(
        F.lit("skipped").alias("time"), F.count("*").cast("int").alias("prediction"), F.lit(None).cast("boolean").alias("avg_is_day"),
        *[F.lit(None).cast("double").alias(m) for m in means],
    )
    return summary.unionByName(skipped)


QUERIES = {name: value for name, value in list(globals().items()) if name.startswith("q_")}
