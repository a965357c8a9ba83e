"""Runs that read and write only the days that have changed since the last one."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.operators import cluster
from obsframe.operators.correlate import spearman_long
from obsframe.operators.kmeans import Centres, assign_centres, fit_centres
from obsframe.operators.places import locate
from obsframe.operators.states import mean_of, merge_states, partial_states, state_schema
from obsframe.operators.versions import latest_forecasts
from obsframe.plans.jobs import POSITION, Result, daily_features
from obsframe.schemas import DAILY_TEMPERATURES
from obsframe.sinks.commits import commit, last_commit
from obsframe.sinks.days import DayTable, day_of
from obsframe.workspace import materialize

BY = ["time", "prediction"]
GROUPS = T.StructType([T.StructField("time", T.TimestampType()), T.StructField("prediction", T.IntegerType())])
DAILY_MEANS = [*DAILY_TEMPERATURES, "Longitude", "Latitude"]
CURRENT_MEANS = [*[m for m in cluster.CURRENT_FEATURES if m != "is_day"], "Longitude", "Latitude"]
FLAGS = ["is_day"]
MERGE = 16
FORECASTS = T.StructType([
    *[T.StructField(c, T.LongType()) for c in ("locationID", "id", "shard")], *[T.StructField(c, T.TimestampType()) for c in ("time", "time_created")],
    *[T.StructField(c, T.DoubleType()) for c in DAILY_TEMPERATURES],
])


@dataclass
class Store:
    """Where runs keep what they know, below ``folder``: the latest forecasts and the states of all summaries by day,
    and the centres of clusters, which are fitted by the first run and stay, so that labels mean the same in all."""

    spark: SparkSession
    folder: str
    k: int = cluster.CLUSTERS
    rounds: int = 20

    @property
    def forecasts(self) -> DayTable:
        return DayTable(self.spark, f"{self.folder}/forecasts", FORECASTS)

    @property
    def daily(self) -> DayTable:
        return DayTable(self.spark, f"{self.folder}/daily-states", state_schema(GROUPS, DAILY_MEANS))

    @property
    def current(self) -> DayTable:
        return DayTable(self.spark, f"{self.folder}/current-states", state_schema(GROUPS, CURRENT_MEANS, FLAGS))

    def centres(self, kind: str, rows: DataFrame, features: list[str], key: str) -> Centres:
        version, known = last_commit(self.spark, f"{self.folder}/centres-{kind}")
        if known:
            return Centres(**known)
        found = fit_centres(rows, features, self.k, key, self.rounds)
        if found.values:
            self.keep(kind, found)
        return found

    def keep(self, kind: str, centres: Centres) -> None:
        """Use these centres (``daily`` or ``current``), as of the first run."""
        version, _ = last_commit(self.spark, f"{self.folder}/centres-{kind}")
        if version:
            raise ValueError("there are centres; states of other centres cannot be merged, begin in another folder")
        commit(self.spark, f"{self.folder}/centres-{kind}", 1, {"features": centres.features, "values": centres.values})

    def clean(self) -> int:
        """Delete files that no run refers to any more."""
        return self.forecasts.clean() + self.daily.clean() + self.current.clean()


@dataclass
class Added:
    """What a run has taken in: its rows (of forecasts, all of their days), which of them have no cluster, and the days."""

    clustered: DataFrame
    skipped: DataFrame
    days: list[str]


def add_forecasts(store: Store, new: DataFrame, places: DataFrame) -> Added:
    """Take new versions of forecasts into the store.

    Of these days alone the stored forecasts are read, the latest of old and new kept, clustered, and their states
    written anew. A version that is older than the stored one changes nothing."""
    fields = [F.col(f.name).cast(f.dataType) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in FORECASTS]
    keyed = new.withColumn("locationID", F.col("locationID").try_cast("bigint")).select(*fields)
    keyed = materialize(keyed.withColumn("day", day_of("time")), "new-forecasts")
    days = sorted(r.day for r in keyed.select("day").distinct().collect())  # of one run's rows
    newest = latest_forecasts(store.forecasts.read(days).unionByName(keyed.drop("day")))
    newest = materialize(newest.withColumn("day", day_of("time")), "latest-forecasts")
    located = materialize(locate(newest.drop("day"), places.select(*POSITION)), "located-forecasts")
    centres = store.centres("daily", located, cluster.DAILY_FEATURES, "locationID")
    clustered = materialize(assign_centres(located, centres), "clustered-forecasts")
    if days:
        store.forecasts.replace(newest, days)
        store.daily.replace(partial_states(clustered, BY, DAILY_MEANS).withColumn("day", day_of("time")), days)
    return Added(clustered, cluster.incomplete(located, cluster.DAILY_FEATURES), days)


def add_readings(store: Store, new: DataFrame, places: DataFrame) -> Added:
    """Take new readings into the store. Only their states are kept, and added to those of the same days; a reading
    must come in one run only. Of a day with MERGE batches of states one is made."""
    columns = ["time", "locationID", *cluster.CURRENT_FEATURES]
    timed = new.select(*columns).withColumn("time", F.col("time").try_cast("timestamp"))
    located = materialize(locate(timed, places.select(*POSITION)), "located-readings")
    centres = store.centres("current", located, cluster.CURRENT_FEATURES, "locationID")
    clustered = materialize(assign_centres(located, centres), "clustered-readings")
    days = store.current.add(partial_states(clustered, BY, CURRENT_MEANS, FLAGS).withColumn("day", day_of("time")))
    full = [d for d, batches in store.current.days().items() if len(batches) >= MERGE]
    if full:
        merged = merge_states(store.current.read(full), BY, CURRENT_MEANS, FLAGS)
        store.current.replace(merged.withColumn("day", day_of("time")), full)
    return Added(clustered, cluster.incomplete(located, cluster.CURRENT_FEATURES), days)


def daily_summary(store: Store, days: list[str] | None = None) -> DataFrame:
    """Mean temperatures and centroid of each day and cluster, of all days or of some."""
    merged = merge_states(store.daily.read(days), BY, DAILY_MEANS)
    return merged.select(
        *BY, *[mean_of(t).alias(t) for t in DAILY_TEMPERATURES],
        mean_of("Longitude").alias("centroid_Longitude"), mean_of("Latitude").alias("centroid_Latitude"),
    )


def current_summary(store: Store, days: list[str] | None = None) -> DataFrame:
    """Mean of each metric per time and cluster; of ``is_day``, whether it holds for any reading."""
    merged = merge_states(store.current.read(days), BY, CURRENT_MEANS, FLAGS)
    return merged.select(*BY, *[
        (F.col("is_day_any") if m in FLAGS else mean_of(m)).alias(f"avg_{m}") for m in cluster.CURRENT_FEATURES
    ])


def centroids(states: DataFrame, means: list[str], flags: list[str] = []) -> DataFrame:
    """Mean position of each cluster over all times, from states."""
    merged = merge_states(states, ["prediction"], means, flags)
    return merged.select("prediction", mean_of("Longitude").alias("centroid_Longitude"), mean_of("Latitude").alias("centroid_Latitude"))


def run_incremental(
    store: Store, daily: DataFrame, current: DataFrame, places: DataFrame, gazetteer: DataFrame,
    run_time: datetime | Column, parts: int,
) -> Result:
    """One run over what is new: the features of the days whose forecasts changed, the summary of the times that have
    new readings, and the correlation over all times, as one run over everything would give them.

    Stored days without news are not opened, but for the states of the summaries, a few rows a time."""
    forecasts = add_forecasts(store, daily, places)
    named = materialize(cluster.name_centroids(centroids(store.daily.read(), DAILY_MEANS), gazetteer), "daily-named")
    summary = materialize(cluster.join_names(daily_summary(store, forecasts.days), named), "daily-summary")
    features = daily_features(summary, cluster.cluster_points(forecasts.clustered, BY, parts), BY)
    readings = add_readings(store, current, places)
    named = materialize(cluster.name_centroids(centroids(store.current.read(), CURRENT_MEANS, FLAGS), gazetteer), "current-named")
    whole = materialize(current_summary(store), "current-all")
    metrics = [f"avg_{m}" for m in cluster.CURRENT_FEATURES]
    changed = cluster.join_names(current_summary(store, readings.days), named)
    return Result(
        {"daily_geojson": features.select("time", "geojson"), "current_summary": changed,
         "current_correlation": spearman_long(whole, metrics, run_time)},
        {"daily": forecasts.skipped, "current": readings.skipped},
    )
