"""The location file."""

from pyspark.sql import DataFrame, SparkSession

from obsframe.schemas import LOCATION_FILE


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Name, Latitude, Longitude, Address, id from CSV with a header; types are declared, not inferred."""
    return spark.read.csv(path, header=True, schema=LOCATION_FILE, multiLine=False, escape='"')
