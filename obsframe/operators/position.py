"""Row numbers and running totals over a whole table, without bringing it to one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsframe.operators.lookup import lookup_join
from obsframe.workspace import materialize

# monotonically_increasing_id() holds the partition above bit 33 and the row within it below.
_ROW_BITS = 33


def with_position(df: DataFrame, order_by: list[str], position: str = "position", total: str = "total") -> DataFrame:
    """Add the 0-based position of each row in the order of ``order_by`` and the number of rows.

    One range shuffle. Rows with equal keys are ordered, and spread over partitions, by a hash of the whole
    row. Only one count per partition is summed up outside of the partitions.
    """
    in_order = df.orderBy(*order_by, F.xxhash64(*df.columns))
    stored = materialize(in_order.withColumn("_seat", F.monotonically_increasing_id()), "positions")
    stored = stored.withColumn("_part", F.shiftright("_seat", _ROW_BITS))
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_size"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_ahead"),
        F.sum("_size").over(everything).alias(total),
    )
    row = F.col("_seat").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per partition of the sort: bounded by the shuffle partitions of the session.
    return stored.join(F.broadcast(offsets), "_part").select(
        *df.columns, (row + F.col("_ahead")).alias(position), total
    )


def running_total(df: DataFrame, within: str, order_by: str, amount: str, before: str) -> DataFrame:
    """Add the sum of ``amount`` over the rows of the same ``within`` that come earlier.

    ``(within, order_by)`` is unique. Every partition of a range shuffle sums its own rows, then gets the
    sum of the partitions ahead of it.
    """
    stored = materialize(
        df.orderBy(within, order_by).withColumn("_part", F.spark_partition_id()), "running-total"
    )
    ahead = Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        stored.groupBy("_part", within).agg(F.sum(amount).alias("_sum"))
        .select("_part", within, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead")),
        "running-offsets",
    )
    local = Window.partitionBy("_part", within).orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    inside = stored.withColumn("_inside", F.coalesce(F.sum(amount).over(local), F.lit(0)))
    return lookup_join(inside, offsets, ["_part", within]).select(
        *df.columns, (F.col("_inside") + F.col("_ahead")).alias(before)
    )
