"""Forecasts of all places, fetched once."""

from pyspark.sql import DataFrame

from obsframe.operators.shards import split_shards
from obsframe.sources.requests import Transport, build_requests, failed, fetch, records
from obsframe.workspace import materialize


def crawl(
    places: DataFrame, transport: Transport, profile: str = "casual", connections: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """(shard, id, record) of every place that was answered, and the responses that failed.

    The responses are stored, so each request is sent once however often they are read.
    """
    requests = build_requests(split_shards(places), profile)
    responses = materialize(fetch(requests, transport, connections), "responses")
    return records(responses), failed(responses)
