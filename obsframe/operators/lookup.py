"""Joins to a table with few rows per key, whatever its size and however skewed the facts."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.workspace import materialize

# A side is broadcast up to so many rows, whose columns of no fixed width take up so many bytes.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 32 << 20
# A key is hot when it holds more than one row in HOT_SHARE, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1_000
# Tasks that share the facts of a hot key whose rows in the table are too wide to broadcast.
SALTS = 16


def is_small(df: DataFrame) -> bool:
    """Counted, not estimated. Pass a stored table: its count comes from the file footers."""
    if df.count() > BROADCAST_ROWS:
        return False
    wide = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    if not wide:
        return True
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct(*wide))))).first()[0] or 0) <= BROADCAST_BYTES


def sized_join(facts: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Broadcast the (stored) table if it is small; else leave the join to a shuffle."""
    return facts.join(F.broadcast(table) if is_small(table) else table, on, how)


def hot_keys(facts: DataFrame, on: list[str]) -> DataFrame:
    """Keys that hold more than 1 / HOT_SHARE of the (stored) rows; counts are combined before the shuffle."""
    return facts.groupBy(*on).count().where(F.col("count") * HOT_SHARE > facts.count()).select(*on)


def lookup_join(
    facts: DataFrame, table: DataFrame, on: list[str], how: str = "inner", hot_rows: DataFrame | None = None,
    stored: bool = False,
) -> DataFrame:
    """Join ``facts`` (``inner`` or ``left``) to a stored ``table`` with a bounded number of rows per key.

    A small table is broadcast. Beyond that only the rows of the hot keys are, as there are fewer than
    HOT_SHARE such keys, and all other keys meet in a shuffle in which no key is large. Hot rows that are too wide for
    that meet their facts in a shuffle by key and salt. ``hot_rows`` are the
    rows of the table for the hot keys, where the caller knows them; ``stored`` facts are not stored again.
    """
    if is_small(table):
        return facts.join(F.broadcast(table), on, how)
    if not stored:
        facts = materialize(facts, "lookup-facts")
    if how == "inner" and is_small(facts):
        return table.join(F.broadcast(facts), on).select(
            *facts.columns, *[c for c in table.columns if c not in on]
        )
    hot = None
    if hot_rows is None:
        hot = materialize(hot_keys(facts, on).dropna(), "hot-keys")
        hot_rows = table.join(F.broadcast(hot), on, "left_semi")
    hot_rows = materialize(hot_rows, "hot-rows")
    met = hot_rows.select(*on).distinct()
    hot = met if hot is None else hot
    keyed = facts.dropna(subset=on)
    rest = keyed.join(F.broadcast(hot), on, "left_anti")
    if is_small(hot_rows):
        found = facts.join(F.broadcast(hot_rows), on)
    else:
        # Too wide to broadcast: the facts of a hot key are dealt to SALTS tasks, each of which gets its rows.
        dealt = keyed.join(F.broadcast(met), on, "left_semi").withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int"))
        spread = hot_rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = dealt.join(spread, [*on, "_salt"]).drop("_salt")
    found = found.unionByName(rest.join(table, on, how))
    if how == "inner":
        return found
    # What can meet nothing is not shuffled: NULL keys, and hot keys without a row in the table.
    lone = facts.where(_any_null(on))
    lone = lone.unionByName(keyed.join(F.broadcast(hot.join(F.broadcast(met), on, "left_anti")), on, "left_semi"))
    empty = {f.name: F.lit(None).cast(f.dataType) for f in table.schema.fields if f.name not in on}
    return found.unionByName(lone.withColumns(empty) if empty else lone)


def _any_null(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])
