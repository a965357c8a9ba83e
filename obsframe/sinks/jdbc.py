"""Tables in a database. Address and credentials come from the caller."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.casts import conform, marked
from obsframe.operators.shards import SHARD_TABLES
from obsframe.schemas import STORED

# Driver classes by database.
DRIVERS = {"mysql": "com.mysql.jdbc.Driver", "postgresql": "org.postgresql.Driver"}
# End of fixed values.


def jdbc_options(url: str, table: str, user: str, password: str, connections: int = 8, batch: int = 10_000) -> dict[str, str]:
    """``connections`` bounds how many tasks write at once."""
    database = url.split(":")[1]
    if database not in DRIVERS:
        raise ValueError(f"no driver known for {database}")
    return {
        "url": url, "driver": DRIVERS[database], "dbtable": table, "user": user, "password": password,
        "numPartitions": str(connections), "batchsize": str(batch),
    }


def append_jdbc(df: DataFrame, url: str, table: str, user: str, password: str, **tuning: int) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, user, password, **tuning)).mode("append").save()


def append_to(url: str, user: str, password: str, **tuning: int):
    """A writer for ``plans.jobs.store_result``: a database table each."""
    return lambda name, rows: append_jdbc(rows, url, name, user, password, **tuning)


def shard_rows(rows: DataFrame, kind: str, shard: int) -> DataFrame:
    """The rows of one shard, as its table holds them."""
    return conform(rows.where(F.col("shard") == shard), STORED[kind])


def checked_rows(rows: DataFrame, kind: str, as_null: bool = False) -> DataFrame:
    """The rows as their tables hold them, with ``shard``. One that has a value which does not fit fails the job
    before it is sent, unless misfits are to be NULL."""
    schema = T.StructType([*STORED[kind].fields, T.StructField("shard", T.IntegerType())])
    found = marked(rows, schema)
    says = F.concat(F.lit(f"{kind}: no room for the values of "), F.array_join("misfit", ", "))
    fits = F.lit(True) if as_null else F.when(F.col("misfit").isNull(), True).otherwise(F.raise_error(says).cast("boolean"))
    return found.where(fits).drop("misfit")


def jdbc_sink(url: str, user: str, password: str, as_null: bool = False, **tuning: int):
    """For :func:`streaming.ingest.start_ingest`: each shard to its own tables. A value that does not fit fails the
    batch, unless misfits are to be NULL.

    A batch that is tried again appends its forecasts again, as further versions of the same forecast.
    """

    def write(kind: str, rows: DataFrame, batch_id: int) -> None:
        checked = checked_rows(rows, kind, as_null)
        for shard, tables in SHARD_TABLES.items():
            append_jdbc(checked.where(F.col("shard") == shard).drop("shard"), url, tables[kind], user, password, **tuning)

    return write


def jdbc_readings(url: str, user: str, password: str, **tuning: int):
    """For :func:`streaming.ingest.start_ingest`: the keys both shards hold, from the first to the last of the
    given days."""

    def read(spark: SparkSession, batch_id: int, days: list[date] | None) -> DataFrame:
        first, second = [
            spark.read.format("jdbc").options(**jdbc_options(url, tables["current"], user, password, **tuning)).load()
            .select(F.col("locationID").cast("bigint").alias("locationID"), "time")
            for tables in SHARD_TABLES.values()
        ]
        both = first.unionByName(second)
        if not days:
            return both
        return both.where((F.col("time") >= F.lit(min(days))) & (F.col("time") < F.lit(max(days) + timedelta(days=1))))

    return read
