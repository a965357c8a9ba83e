"""Spearman rank correlation in long form."""

from datetime import datetime

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.casts import stamp
from obsframe.operators.cluster import require_columns
from obsframe.operators.lookup import BROADCAST_ROWS, HOT_SHARE, lookup_join
from obsframe.operators.position import running_total
from obsframe.schemas import struct
from obsframe.workspace import materialize

LONG = struct(matrix_x=T.StringType(), matrix_y=T.StringType(), correlation=T.DoubleType())


def ranks(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Average rank of each metric in each row; rows with a NULL metric are left out.

    Values are counted within each task before they are shuffled, and only distinct ones are sorted, so a value that
    fills a third of all rows is one row of the sort. Ranks of a metric with few distinct values are broadcast back to
    the rows, which are then not shuffled for it; for any other metric they meet the rows by value, hot values apart.
    """
    require_columns(df, metrics)
    numbers = df.select(*[F.col(m).cast("double").alias(m) for m in metrics]).dropna()
    found = materialize(numbers, "rank-input")
    counts = found.unpivot([], metrics, "metric", "value").groupBy("metric", "value").count()
    ranked = running_total(counts, "metric", "value", "count", "below").withColumn("rank", F.col("below") + (F.col("count") + 1) / 2)
    ranked = materialize(ranked.select("metric", "value", "count", "rank"), "ranks")
    distinct = {r.metric: r["count"] for r in ranked.groupBy("metric").count().collect()}  # one row per metric
    total = found.count()
    many = [m for m in metrics if distinct.get(m, 0) > BROADCAST_ROWS]
    of = lambda m: ranked.where(F.col("metric") == m).select(F.col("value").alias(m), F.col("rank").alias(f"_rank_{m}"), "count")
    for m in many:
        own = materialize(of(m), "ranks-of")
        hot = own.where(F.col("count") * HOT_SHARE > total).drop("count")
        found = lookup_join(found, own.drop("count"), [m], hot_rows=hot, stored=m == many[0])
    for m in metrics:
        if m not in many:
            found = found.join(F.broadcast(of(m).drop("count")), m)  # BROADCAST_ROWS pairs of numbers at most
    return found.select(*[F.col(f"_rank_{m}").alias(m) for m in metrics])


def spearman_long(df: DataFrame, metrics: list[str], run_time: datetime | Column) -> DataFrame:
    """One row per ordered pair of metrics: (matrix_x, matrix_y, correlation, time).

    The matrix of a few metrics is all that reaches the driver. A constant metric correlates with itself
    only (1.0); with others the coefficient is undefined and NULL.
    """
    vectors = VectorAssembler(inputCols=metrics, outputCol="ranks").transform(
        materialize(ranks(df, metrics), "rank-vectors")
    )
    spark = df.sparkSession
    if vectors.isEmpty():
        return spark.createDataFrame([], LONG).withColumn("time", F.lit(None).cast("string"))
    matrix = Correlation.corr(vectors, "ranks", "pearson").first()[0].toArray()
    pairs = [(x, y, float(matrix[i, j])) for i, x in enumerate(metrics) for j, y in enumerate(metrics)]
    moment = run_time if isinstance(run_time, Column) else F.lit(run_time)
    return spark.createDataFrame(pairs, LONG).select(
        "matrix_x", "matrix_y",
        F.when(~F.isnan("correlation"), F.col("correlation")).alias("correlation"),
        stamp(moment).alias("time"),
    )
