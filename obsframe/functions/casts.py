"""Typed projections of wire rows. Text that does not fit its type becomes NULL."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.schemas import CASUAL_METRICS, DAILY_TEMPERATURES, INTEGER_METRICS

MINUTE = "yyyy-MM-dd'T'HH:mm"
SECOND = "yyyy-MM-dd HH:mm:ss"


def _current_types():
    kinds = {m: "int" if m in INTEGER_METRICS else "double" for m in CASUAL_METRICS}
    return {"locationID": "bigint", **kinds, "is_day": "boolean"}


TYPES = {
    "current": _current_types(),
    "daily": {
        "locationID": "bigint", "time": "timestamp", "time_created": "timestamp",
        **{m: "double" for m in DAILY_TEMPERATURES},
    },
    "location": {"Latitude": "double", "Longitude": "double"},
}


def typed(df: DataFrame, kind: str) -> DataFrame:
    """Cast the columns of a ``current``, ``daily`` or ``location`` table in one projection."""
    types = TYPES[kind]
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def fitted(df: DataFrame, field: T.StructField) -> Column:
    """A column in the type of a stored field, NULL where it does not fit.

    Numbers are compared with the bounds of the type first: a failing ``try_cast`` costs an exception per row.
    """
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    value, source, target = F.col(field.name), df.schema[field.name].dataType, field.dataType
    if isinstance(source, (T.DoubleType, T.FloatType)) and isinstance(target, T.DecimalType):
        # A number is rounded by the digits it is written with, so it fits if it is less than half a step below the
        # bound as that is written.
        return F.when(F.abs(value) < (10 ** (target.precision) - 0.5) / 10**target.scale, value.cast(target))
    if isinstance(source, T.NumericType) and isinstance(target, T.DecimalType):
        bound = 10 ** (target.precision - target.scale)
        return F.when(F.abs(F.round(value, target.scale)) < bound, value.cast(target))
    if isinstance(source, T.FractionalType) and isinstance(target, T.IntegerType):
        whole = F.round(value)
        return F.when((whole >= -(1 << 31)) & (whole < 1 << 31), whole.cast(target))
    return value.try_cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the columns of a stored table, by name; absent columns are NULL."""
    return df.select(*[fitted(df, f).alias(f.name) for f in schema])


def marked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """:func:`conform`, with ``misfit``: the names of the columns whose value does not fit, NULL if all do. To be
    stored before it is filtered by ``misfit``, else every cast is evaluated once more for the filter."""
    kept = {f.name: fitted(df, f) for f in schema}
    lost = [F.when(F.col(f.name).isNotNull() & kept[f.name].isNull(), F.lit(f.name)) for f in schema if f.name in df.columns]
    misfit = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    return df.select(*[kept[f.name].alias(f.name) for f in schema], F.when(F.size(misfit) > 0, misfit).alias("misfit"))


def misfits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in which :func:`conform` would lose a value, with the names of the columns that lose it."""
    lost = [
        F.when(F.col(f.name).isNotNull() & fitted(df, f).isNull(), F.lit(f.name))
        for f in schema if f.name in df.columns
    ]
    return df.withColumn("misfit", F.array_compact(F.array(*lost))).where(F.size("misfit") > 0)


def count_misfits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, n): how many values of each column do not fit, by one pass; only columns that have any."""
    known = [f for f in schema if f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(f.name).isNotNull() & fitted(df, f).isNull()).alias(f.name) for f in known])
    return counts.unpivot([], [f.name for f in known], "column", "n").where(F.col("n") > 0)


def minute(text: Column) -> Column:
    """Timestamp of ``2024-05-01T10:15``."""
    return F.try_to_timestamp(text, F.lit(MINUTE))


def local_time(utc: Column, zone: str) -> Column:
    return F.from_utc_timestamp(utc, zone)


def stamp(moment: Column) -> Column:
    """Text of a timestamp to the second."""
    return F.date_format(moment, SECOND)
