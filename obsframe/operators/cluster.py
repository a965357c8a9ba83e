"""k-means groups of readings and their summaries."""

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.text import address_part, grid
from obsframe.operators.kmeans import assign_many, first_nearest
from obsframe.operators.kmeans_fit import fit_parallel, parts_of, points_of
from obsframe.operators.lookup import is_small, lookup_join
from obsframe.operators.nearest import nearest_place
from obsframe.schemas import CASUAL_METRICS, DAILY_TEMPERATURES
from obsframe.workspace import materialize

DAILY_FEATURES = ["Longitude", "Latitude", *DAILY_TEMPERATURES]
CURRENT_FEATURES = CASUAL_METRICS
CLUSTERS = 10
SEED = 1
CENTRES_PER_BLOCK = 1_000
# Bytes that a task of a fit holds at most; a row takes up its features and about OVERHEAD more numbers.
TASK_BYTES, OVERHEAD = 32 << 20, 9


def require_columns(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def assemble(df: DataFrame, features: list[str], output: str = "features") -> DataFrame:
    """Add the feature vector; rows with a NULL feature are left out (see :func:`incomplete`)."""
    require_columns(df, features)
    return VectorAssembler(inputCols=features, outputCol=output, handleInvalid="skip").transform(df)


def incomplete(df: DataFrame, features: list[str]) -> DataFrame:
    """The rows :func:`assemble` leaves out."""
    require_columns(df, features)
    gap = F.lit(False)
    for c in features:
        gap = gap | F.col(c).isNull()
        if isinstance(df.schema[c].dataType, T.FractionalType) and not isinstance(df.schema[c].dataType, T.DecimalType):
            gap = gap | F.isnan(c)
    return df.where(gap)


class CentresModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``, the first of the nearest centres, by numeric columns or, where none are named, the vector
    ``features``. Like other models it can be saved."""

    columns = Param(Params._dummy(), "columns", "numeric columns", TypeConverters.toListString)
    centres = Param(Params._dummy(), "centres", "the centres, one after the other", TypeConverters.toListFloat)
    k = Param(Params._dummy(), "k", "their number", TypeConverters.toInt)

    def clusterCenters(self) -> list[np.ndarray]:
        return list(np.reshape(self.getOrDefault("centres"), (self.getOrDefault("k"), -1)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = np.array(self.clusterCenters())

        def label(column: pa.Array) -> pa.Array:
            found = [first_nearest(points, values) for points in parts_of(points_of(column), len(values))]
            return pa.array(np.concatenate([*found, np.empty(0, np.int64)]), pa.int32())

        labelled = F.arrow_udf(label, "int", F.ArrowUDFType.SCALAR)(_numbers(self.getOrDefault("columns")))
        return dataset.withColumn("prediction", labelled)


class StoredKMeans(Estimator):
    """:func:`fit_parallel` of numeric columns or, where none are named, of the vector ``features``. A dataset that is
    not ``stored`` is stored once."""

    def __init__(self, k: int, seed: int, columns: list[str], stored: bool) -> None:
        super().__init__()
        self.k, self.seed, self.columns, self.stored = k, seed, columns, stored

    def _fit(self, dataset: DataFrame) -> CentresModel:
        rows = dataset.select(_numbers(self.columns).alias("point"))
        found = fit_parallel(rows if self.stored else materialize(rows, "kmeans-rows"), self.k, self.seed)
        return CentresModel()._set(columns=self.columns, centres=found.ravel().tolist(), k=len(found))


def _numbers(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns]) if columns else vector_to_array("features")


def fit_clusters(
    df: DataFrame, features: list[str], k: int = CLUSTERS, seed: int = SEED, scale: bool = False,
    partitions: int | None = None,
) -> PipelineModel:
    """Fit k-means. Pass a stored table.

    Rows that ``partitions`` tasks (or one) hold with TASK_BYTES each are fitted by Spark ML, which keeps them between its
    passes; ``partitions`` spreads them once, before that. More rows are neither spread nor kept: each pass reads the
    table where it is, so that a fit takes up no disk; rows that are not stored are, in parts of TASK_BYTES."""
    require_columns(df, features)
    vector = "_vector" if scale else "features"
    stages = [VectorAssembler(inputCols=features, outputCol=vector, handleInvalid="skip")]
    if scale:
        stages.append(StandardScaler(inputCol=vector, outputCol="features", withMean=True))
    rows = df.select(*features)
    least = -(-rows.count() * (len(features) + OVERHEAD) * 8 // TASK_BYTES)
    if least <= (partitions or 1):
        fit = KMeans(k=k, seed=seed)
        rows = rows.repartition(partitions) if partitions else rows
    else:
        stored = bool(rows.inputFiles())
        fit = StoredKMeans(k, seed, [] if scale else features, stored)
        rows = rows if stored or least <= rows.rdd.getNumPartitions() else rows.repartition(least)
    return Pipeline(stages=[*stages, fit]).fit(rows)


def centres(model: PipelineModel) -> list[list[float]]:
    """Cluster centres in label order: sorted, so that labels do not depend on the order of discovery."""
    return sorted([float(x) for x in c] for c in model.stages[-1].clusterCenters())


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``, the label of the nearest centre."""
    found = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    order = sorted(range(len(found)), key=lambda i: found[i])
    labels = F.array(*[F.lit(order.index(i)) for i in range(len(found))])
    assigned = model.transform(df)
    kept = [c for c in assigned.columns if c in df.columns]
    return assigned.select(*kept, F.get(labels, F.col("prediction")).alias("prediction"))


def squared_distance(a: Column, b: Column) -> Column:
    """Of two numeric arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def nearest_centre(vector: Column, given: Column) -> Column:
    """(d, label) of the nearest of ``given``, an array of structs (label, centre); the smallest label wins ties."""
    ranked = F.transform(given, lambda c: F.struct(squared_distance(vector, c["centre"]).alias("d"), c["label"].alias("label")))
    return F.array_min(ranked)


def mean_vectors(df: DataFrame, label: str, vector: str) -> DataFrame:
    """The mean of an array column per label, as (label, centre)."""
    vectors = array_to_vector(F.col(vector).cast("array<double>"))
    means = df.groupBy(F.col(label).alias("label")).agg(Summarizer.mean(vectors).alias("mean"))
    return means.select("label", vector_to_array("mean").alias("centre"))


def assign_given(df: DataFrame, vector: str, given: DataFrame) -> DataFrame:
    """Add ``prediction`` for given centres (label, centre).

    Centres that are small enough to broadcast, by count and bytes, meet the rows in one pass, in blocks of which only
    those are looked at that can hold the nearest (:func:`kmeans.assign_many`). Beyond that, or with labels that are
    no whole numbers, rows meet a block of centres at a time and keep the nearest so far."""
    given = materialize(given, "centres")
    kind = given.schema["label"].dataType
    if isinstance(kind, T.IntegralType) and is_small(given):
        found = assign_many(df, vector, given)
        return found.withColumn("prediction", F.col("prediction").cast(kind))
    blocks = max(1, -(-given.count() // CENTRES_PER_BLOCK))
    nearest = df.withColumn("_nearest", F.lit(None).cast(f"struct<d:double,label:{given.schema['label'].dataType.simpleString()}>"))
    for block in range(blocks):
        some = given.where(F.pmod(F.xxhash64("label"), F.lit(blocks)) == block)
        table = some.agg(F.collect_list(F.struct("label", "centre"))).scalar()
        found = nearest_centre(F.col(vector), F.col("_centres"))
        nearest = nearest.withColumn("_centres", table).select(*df.columns, F.least("_nearest", found).alias("_nearest"))
        if blocks > 1:
            nearest = materialize(nearest, "nearest")
    return nearest.select(*df.columns, F.col("_nearest.label").alias("prediction"))


def summarize_daily(clustered: DataFrame, by: list[str] = ["time", "prediction"]) -> DataFrame:
    """Mean temperatures and centroid of each day and cluster."""
    return clustered.groupBy(*by).agg(
        *[F.avg(c).alias(c) for c in DAILY_TEMPERATURES],
        F.avg("Longitude").alias("centroid_Longitude"),
        F.avg("Latitude").alias("centroid_Latitude"),
    )


def summarize_current(
    clustered: DataFrame, metrics: list[str] = CURRENT_FEATURES, any_of: str = "is_day",
    by: list[str] = ["time", "prediction"],
) -> DataFrame:
    """Mean of each metric per time and cluster; of the boolean ``any_of``, whether it holds for any reading."""
    return clustered.groupBy(*by).agg(
        *[(F.max(F.col(c).cast("boolean")) if c == any_of else F.avg(c)).alias(f"avg_{c}") for c in metrics]
    )


def centroids(clustered: DataFrame) -> DataFrame:
    """Mean position of each cluster over all times."""
    return clustered.groupBy("prediction").agg(
        F.avg("Longitude").alias("centroid_Longitude"), F.avg("Latitude").alias("centroid_Latitude")
    )


def name_centroids(of: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Add ``centroid_address``: part of the address of the place nearest to the centroid, to one decimal."""
    rounded = of.withColumns({"_lat": grid(F.col("centroid_Latitude")), "_lon": grid(F.col("centroid_Longitude"))})
    named = nearest_place(rounded, gazetteer, "_lat", "_lon", ["address"])
    return named.select(*of.columns, address_part(F.col("address")).alias("centroid_address"))


def join_names(summary: DataFrame, named: DataFrame) -> DataFrame:
    """Inner join of a summary with its clusters' (stored) names; the centroid is the one over all times."""
    kept = [c for c in summary.columns if c not in named.columns or c == "prediction"]
    return lookup_join(summary.select(*kept), named, ["prediction"])


def cluster_points(clustered: DataFrame, by: list[str], parts: int = 1) -> DataFrame:
    """The points of each group in order of ``locationID``, as ``points``, in ``parts`` parts; and ``part`` and ``parts``.

    A part holds the points whose id leaves that remainder, whatever the number of points. Give as many parts as the
    largest group needs to fit a row; a NULL id is in part 0.
    """
    part = F.coalesce(F.pmod(F.col("locationID"), F.lit(parts)), F.lit(0)).cast("int")
    return clustered.groupBy(*by, F.lit(parts).alias("parts"), part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("locationID", "Longitude", "Latitude"))).alias("points")
    )
