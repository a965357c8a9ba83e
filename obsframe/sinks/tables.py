"""Stored tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.casts import marked
from obsframe.operators.versions import insert_ignore
from obsframe.schemas import STORED
from obsframe.workspace import materialize


def ddl(name: str, schema: T.StructType, partition_by: list[str] = [], location: str | None = None) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    extra = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{extra}{place}"


def create_tables(spark: SparkSession, prefix: str = "", folder: str | None = None) -> None:
    """Create the stored tables that do not exist; readings and forecasts are partitioned by shard."""
    for name, schema in STORED.items():
        shard = [] if name == "locations" else ["shard"]
        full = schema if not shard else T.StructType([*schema.fields, T.StructField("shard", T.IntegerType())])
        spark.sql(ddl(f"{prefix}{name}", full, shard, f"{folder.rstrip('/')}/{name}" if folder else None))


def stamped(df: DataFrame) -> DataFrame:
    """With ``time_created``, now unless given."""
    if "time_created" in df.columns:
        return df.withColumn("time_created", F.coalesce("time_created", F.current_timestamp()))
    return df.withColumn("time_created", F.current_timestamp())


@dataclass
class Written:
    """What an insert has done: rows written, rows refused, and for each column how many values did not fit."""

    rows: int
    refused: int
    columns: dict[str, int]


class Refused(ValueError):
    """Values that do not fit the table."""


def insert_rows(df: DataFrame, table: str, kind: str, errors: str | None = None, as_null: bool = False) -> Written:
    """Append to a table made by :func:`create_tables`; ``shard``, where given, picks the partition.

    Every value is cast once, into a stored table, and counted on the way. A value that does not fit refuses its row:
    the job fails and the table stays as it was, unless ``errors`` names a folder for refused rows (see
    :func:`read_refused`). With ``as_null`` such a row goes into the table too, its misfits as NULL."""
    schema = STORED[kind]
    rows = stamped(df) if kind == "daily" else df
    if "shard" in df.columns:
        schema = T.StructType([*schema.fields, T.StructField("shard", T.IntegerType())])
    seen = Observation()
    lost = [F.count_if(F.array_contains("misfit", f.name)).alias(f.name) for f in schema]
    with_given = marked(rows.withColumn("_given", F.to_json(F.struct(*df.columns))), T.StructType([*schema.fields, T.StructField("_given", T.StringType())]))
    given = F.when(F.col("misfit").isNotNull(), F.col("_given")).alias("_given")
    checked = with_given.select(*schema.names, "misfit", given).observe(
        seen, F.count("*").alias("rows"), F.count("misfit").alias("refused"), *[c.alias(f"lost_{f.name}") for c, f in zip(lost, schema)]
    )
    stored = materialize(checked, "checked")
    found = seen.get
    columns = {f.name: found[f"lost_{f.name}"] for f in schema if found[f"lost_{f.name}"]}
    refused = found["refused"]
    if refused and errors is None and not as_null:
        raise Refused(f"{refused} of {found['rows']} rows do not fit {table}: {', '.join(f'{n} in {c}' for c, n in columns.items())}")
    good = stored if as_null or not refused else stored.where(F.col("misfit").isNull())
    good.select(*schema.names).write.insertInto(table)
    if refused and errors:
        stored.where(F.col("misfit").isNotNull()).select(
            F.lit(table).alias("table"), F.col("misfit").alias("columns"), F.col("_given").alias("row"), F.current_timestamp().alias("time")
        ).write.mode("append").parquet(errors)
    return Written(found["rows"] if as_null else found["rows"] - refused, refused, columns)


def read_refused(spark: SparkSession, errors: str) -> DataFrame:
    """(table, columns, row, time) of refused rows: the columns that did not fit, and the row as it was given, as JSON."""
    return spark.read.schema("table string, columns array<string>, row string, time timestamp").parquet(errors)


def insert_locations(new: DataFrame, table: str, errors: str | None = None, as_null: bool = False) -> Written:
    """Append the locations whose id the table does not have."""
    fresh = insert_ignore(new, new.sparkSession.table(table), "id")
    return insert_rows(fresh, table, "locations", errors, as_null)


def append_to(folder: str):
    """A writer for ``plans.jobs.store_result``: a folder per table."""
    return lambda name, rows: rows.write.mode("append").parquet(f"{folder}/{name}")


def append_by_shard(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("shard").parquet(path)
