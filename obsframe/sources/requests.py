"""Forecast requests for batches of locations, and their responses."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import obsframe
from obsframe.functions.text import point_text
from obsframe.schemas import DAILY_VARIABLES, LOCATIONS_PER_REQUEST, PROFILES, TIMEZONE

# Tasks get the code of this package with the query, so executors need no copy of it.
cloudpickle.register_pickle_by_value(obsframe)

# A transport sends one request, a dict of the columns below, and returns (status, body).
Transport = Callable[[dict], tuple[int, str | None]]

# So many bodies are held before they go on.
RESPONSES_HELD = 16
REQUEST_COLUMNS = ["latitude", "longitude", "current", "daily", "timezone"]


def profile(df: DataFrame, name: str, also: list[str] = []) -> DataFrame:
    """The columns of a variable profile (``casual`` or ``full``)."""
    return df.select(*also, *PROFILES[name])


def build_requests(
    sharded: DataFrame, profile_name: str = "casual", size: int = LOCATIONS_PER_REQUEST, timezone: str = TIMEZONE,
) -> DataFrame:
    """One row per batch of up to ``size`` places of a shard, from :func:`operators.shards.split_shards`.

    The ids travel with the coordinates, so a response is matched to its place by id.
    """
    batch = F.floor(F.col("seat") / size).alias("batch")
    place = F.struct("seat", F.col("id"), F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    grouped = sharded.groupBy("shard", batch).agg(F.sort_array(F.collect_list(place)).alias("places"))
    return grouped.select(
        "shard", "batch",
        F.col("places.id").alias("ids"),
        F.col("places.lat").alias("latitude"),
        F.col("places.lon").alias("longitude"),
        F.array_join(F.transform("places", lambda p: point_text(p["lat"], p["lon"])), "; ").alias("points"),
        F.array(*[F.lit(v) for v in PROFILES[profile_name]]).alias("current"),
        F.array(*[F.lit(v) for v in DAILY_VARIABLES]).alias("daily"),
        F.lit(timezone).alias("timezone"),
    )


def fetch(requests: DataFrame, transport: Transport, connections: int = 8) -> DataFrame:
    """Send each request from one of ``connections`` tasks: (shard, batch, ids, status, body). A raised error is
    status 0."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), RESPONSES_HELD):
                some, answers = pdf.iloc[at : at + RESPONSES_HELD], []
                for request in some[REQUEST_COLUMNS].to_dict("records"):
                    try:
                        answers.append(transport(request))
                    except Exception as error:  # noqa: BLE001 - kept as a row of the error table
                        answers.append((0, repr(error)))
                yield some[["shard", "batch", "ids"]].assign(
                    status=[a[0] for a in answers], body=[a[1] for a in answers]
                )

    ids = requests.schema["ids"].dataType.simpleString()
    kinds = {c: requests.schema[c].dataType.simpleString() for c in ("shard", "batch")}
    spread = requests.select("shard", "batch", "ids", *REQUEST_COLUMNS).repartition(connections, "shard", "batch")
    return spread.mapInPandas(
        send, f"shard {kinds['shard']}, batch {kinds['batch']}, ids {ids}, status int, body string"
    )


def _reason(responses: DataFrame) -> Column:
    """Why a response is of no use; NULL if it is. A body is a list with a record per id, where there are ids."""
    reason = F.when(~F.col("status").eqNullSafe(200), F.lit("status"))
    if "ids" not in responses.columns:
        return reason
    listed = F.from_json("body", "array<string>")
    return reason.when(listed.isNull(), F.lit("no list")).when(F.size(listed) != F.size("ids"), F.lit("number of records"))


def succeeded(responses: DataFrame) -> DataFrame:
    return responses.where(_reason(responses).isNull())


def failed(responses: DataFrame) -> DataFrame:
    """The error table: every response that is not a 200 or not whole, with the ``reason``."""
    return responses.withColumn("reason", _reason(responses)).where(F.col("reason").isNotNull())


def records(responses: DataFrame) -> DataFrame:
    """(shard, id, record) per place of the successful responses, whose body is a list in request order.

    The record stays the JSON text that was received, so no field of it is lost.
    """
    listed = F.from_json("body", "array<string>")
    return (
        succeeded(responses).select("shard", "ids", F.posexplode(listed).alias("at", "record"))
        .select("shard", F.get("ids", F.col("at")).alias("id"), "record")
    )
