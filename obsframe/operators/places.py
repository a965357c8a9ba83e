"""Readings and the places they were taken at."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.operators.lookup import lookup_join


def locate(readings: DataFrame, places: DataFrame) -> DataFrame:
    """Inner join on ``locationID`` (``id`` of a place, unique). Text ids that are no number match nothing."""
    readings = readings.withColumn("locationID", F.col("locationID").try_cast("bigint"))
    places = places.withColumnRenamed("id", "locationID").withColumn(
        "locationID", F.col("locationID").cast("bigint")
    )
    return lookup_join(readings, places, ["locationID"])
