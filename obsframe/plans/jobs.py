"""The analytics of one run."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe import workspace
from obsframe.functions.geojson import outline, polygon, ring
from obsframe.operators import cluster
from obsframe.operators.correlate import spearman_long
from obsframe.operators.hull import hulls
from obsframe.operators.kmeans import assign_centres, fit_centres
from obsframe.operators.lookup import sized_join
from obsframe.operators.places import locate
from obsframe.operators.shards import union_shards
from obsframe.operators.versions import latest_forecasts
from obsframe.schemas import DAILY_TEMPERATURES
from obsframe.sources.paged import read_table
from obsframe.workspace import materialize

POSITION = ["id", "Longitude", "Latitude"]


@dataclass
class Result:
    tables: dict[str, DataFrame]
    skipped: dict[str, DataFrame]


def daily_features(summary: DataFrame, points: DataFrame, by: list[str]) -> DataFrame:
    """One GeoJSON Feature per group and part, which it names; see :func:`cluster.cluster_points`.
    ``summary`` is a stored table with one row per group."""
    properties = {"name": F.col("centroid_address"), **{t: F.col(t) for t in DAILY_TEMPERATURES}, "part": F.col("part"), "parts": F.col("parts")}
    return sized_join(points, summary, by).select(
        *by, "part", "parts", polygon(ring(F.col("points")), properties).alias("geojson")
    )


def outline_features(summary: DataFrame, clustered: DataFrame, by: list[str]) -> DataFrame:
    """One GeoJSON Feature per group: the convex hull of its places. ``summary`` is a stored table with one row per
    group; a group without any place has no feature."""
    properties = {"name": F.col("centroid_address"), **{t: F.col(t) for t in DAILY_TEMPERATURES}}
    return sized_join(hulls(clustered, by), summary, by).select(*by, outline(F.col("ring"), properties).alias("geojson"))


def run_daily(daily: DataFrame, places: DataFrame, gazetteer: DataFrame, parts: int, k: int = cluster.CLUSTERS) -> Result:
    """Latest forecasts by day and cluster as GeoJSON: (time, geojson), in ``parts`` features a group; give as many as
    the points of the largest group need. And the outline of each group, as one feature."""
    columns = ["time", "locationID", *DAILY_TEMPERATURES]
    located = materialize(locate(latest_forecasts(daily).select(*columns), places.select(*POSITION)), "daily")
    centres = fit_centres(located, cluster.DAILY_FEATURES, k, "locationID")
    clustered = materialize(assign_centres(located, centres), "daily-clustered")
    named = materialize(cluster.name_centroids(cluster.centroids(clustered), gazetteer), "daily-named")
    summary = materialize(cluster.join_names(cluster.summarize_daily(clustered), named), "daily-summary")
    points = cluster.cluster_points(clustered, ["time", "prediction"], parts)
    features = daily_features(summary, points, ["time", "prediction"])
    return Result(
        {
            "daily_geojson": features.select("time", "geojson"),
            "daily_outline": outline_features(summary, clustered, ["time", "prediction"]).select("time", "geojson"),
        },
        {"daily": cluster.incomplete(located, cluster.DAILY_FEATURES)},
    )


def run_current(
    current: DataFrame, places: DataFrame, gazetteer: DataFrame, run_time: datetime | Column,
    k: int = cluster.CLUSTERS,
) -> Result:
    """Summary of the current readings by time and cluster, and the rank correlation of its metrics."""
    columns = ["time", "locationID", *cluster.CURRENT_FEATURES]
    located = materialize(locate(current.select(*columns), places.select(*POSITION)), "current")
    centres = fit_centres(located, cluster.CURRENT_FEATURES, k, "locationID")
    clustered = materialize(assign_centres(located, centres), "current-clustered")
    named = materialize(cluster.name_centroids(cluster.centroids(clustered), gazetteer), "current-named")
    summary = materialize(cluster.join_names(cluster.summarize_current(clustered), named), "current-summary")
    metrics = [f"avg_{m}" for m in cluster.CURRENT_FEATURES]
    return Result(
        {"current_correlation": spearman_long(summary, metrics, run_time), "current_summary": summary},
        {"current": cluster.incomplete(located, cluster.CURRENT_FEATURES)},
    )


def run_once(
    daily: DataFrame, current: DataFrame, places: DataFrame, gazetteer: DataFrame,
    run_time: datetime | Column | None = None, *, parts: int, k: int = cluster.CLUSTERS,
) -> Result:
    """One whole run, at ``run_time`` or now in UTC. When to run again is the caller's schedule.

    Its tables are read from what it has materialized; see :func:`run_and_store` for one that cleans up."""
    if run_time is None:
        run_time = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    first = run_daily(daily, places, gazetteer, parts, k)
    second = run_current(current, places, gazetteer, run_time, k)
    return Result(first.tables | second.tables, first.skipped | second.skipped)


def store_result(result: Result, write: Callable[[str, DataFrame], None]) -> None:
    """Append each table of a run with ``write(name, rows)``."""
    for name, rows in result.tables.items():
        write(name, rows)


def run_and_store(
    daily: DataFrame, current: DataFrame, places: DataFrame, gazetteer: DataFrame, write: Callable[[str, DataFrame], None],
    run_time: datetime | Column | None = None, *, parts: int, k: int = cluster.CLUSTERS,
) -> dict[str, int]:
    """:func:`run_once`, :func:`store_result`, and the number of rows that were in no cluster, by table; nothing that
    was materialized on the way is left, also after a failure."""
    with workspace.run(daily.sparkSession):
        result = run_once(daily, current, places, gazetteer, run_time, parts=parts, k=k)
        store_result(result, write)
        return {name: rows.count() for name, rows in result.skipped.items()}


def run_from_source(
    spark: SparkSession, gazetteer: DataFrame, run_time: datetime | None = None, *, parts: int, k: int = cluster.CLUSTERS, **options: str,
) -> Result:
    """:func:`run_once` over the five tables of the registered ``paged_rest`` source."""
    def both(kind: str) -> DataFrame:
        return union_shards(read_table(spark, kind, **options), read_table(spark, f"{kind}_2", **options))

    return run_once(
        materialize(both("daily"), "daily-source"), materialize(both("current"), "current-source"),
        materialize(read_table(spark, "location", **options), "location-source"), gazetteer, run_time, parts=parts, k=k,
    )
