"""Means and any-of flags as states that can be stored, merged and finished later, exactly."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Values are added up in whole units, so that sums do not depend on what was added first.
UNIT = 2.0**-32
MOST = 2.0**30


def _units(column: str) -> Column:
    """A value in units as a whole number; NULL stays, and a value beyond MOST fails the job."""
    value = F.col(column).cast("double")
    whole = F.floor(value / UNIT + 0.5).cast("decimal(20,0)")
    fits = value.isNull() | (F.abs(value) < MOST)
    return F.when(fits, whole).otherwise(F.raise_error(F.lit(f"{column} lies beyond {MOST}")).cast("decimal(20,0)"))


def partial_states(rows: DataFrame, by: list[str], means: list[str], flags: list[str] = []) -> DataFrame:
    """Per group: count and sum of each column that is averaged, and whether each flag holds for any row."""
    return rows.groupBy(*by).agg(*[
        part for c in means for part in (F.count(c).alias(f"{c}_n"), F.sum(_units(c)).cast("decimal(38,0)").alias(f"{c}_sum"))
    ], *[F.max(F.col(c).cast("boolean")).alias(f"{c}_any") for c in flags])


def merge_states(states: DataFrame, by: list[str], means: list[str], flags: list[str] = []) -> DataFrame:
    """States of the same or of coarser groups, from states: of several runs, or of all times."""
    return states.groupBy(*by).agg(*[
        part for c in means for part in (F.sum(f"{c}_n").cast("bigint").alias(f"{c}_n"), F.sum(f"{c}_sum").cast("decimal(38,0)").alias(f"{c}_sum"))
    ], *[F.max(f"{c}_any").alias(f"{c}_any") for c in flags])


def mean_of(column: str) -> Column:
    """The mean that a state stands for; NULL of no values."""
    return F.when(F.col(f"{column}_n") > 0, F.col(f"{column}_sum").cast("double") / F.col(f"{column}_n") * UNIT)


def state_schema(groups: T.StructType, means: list[str], flags: list[str] = []) -> T.StructType:
    fields = [*groups.fields]
    for c in means:
        fields += [T.StructField(f"{c}_n", T.LongType()), T.StructField(f"{c}_sum", T.DecimalType(38, 0))]
    return T.StructType(fields + [T.StructField(f"{c}_any", T.BooleanType()) for c in flags])
