"""Convex hulls of groups, put together from hulls of parts."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# So many partial hulls of a group are merged at a time.
FAN = 32
# Points that a task holds before it thins them out to hulls, and hull points before it hands them on.
HELD, KEPT = 100_000, 200_000


def hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull of rows (x, y), counterclockwise from the smallest x and y; of points on a line
    its two ends, of equal points one."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def chain(rows: list) -> list:
        found: list = []
        for p in rows:
            while len(found) > 1:
                a, b = found[-2], found[-1]
                if (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) > 0:
                    break
                found.pop()
            found.append(p)
        return found[:-1]

    rows = _outer(points).tolist()
    return np.array(chain(rows) + chain(rows[::-1]))


def _outer(points: np.ndarray) -> np.ndarray:
    """Of many sorted points those that can be corners: the lowest and highest of each x, and of those no point that
    lies within the quadrilateral of the extremes."""
    change = np.flatnonzero(np.diff(points[:, 0])) + 1
    ends = np.unique(np.concatenate([[0], change - 1, change, [len(points) - 1]]))
    points = points[ends]
    if len(points) < 64:
        return points
    x, y = points[:, 0], points[:, 1]
    frame = points[[x.argmin(), y.argmin(), x.argmax(), y.argmax()]]
    inside = np.ones(len(points), bool)
    for a, b in zip(frame, np.roll(frame, -1, axis=0)):
        inside &= (b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) > 0
    return points[~inside]


def hulls(points: DataFrame, by: list[str], x: str = "Longitude", y: str = "Latitude") -> DataFrame:
    """(``by``, ring) per group: the corners of its hull as [x, y] pairs, counterclockwise, the first one again at the
    end if there are three or more. Points with a coordinate that is no finite number are left out, and so is a group
    without any; NULL is a group like any other.

    Every task thins its points out to one hull per group. Hulls of a group then meet FAN at a time, in as many rounds
    as the tasks need, so no task sees a group's points, and what is shuffled are corners."""
    columns = [*[F.col(c) for c in by], F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")]
    finite = [F.coalesce(F.abs(c) < float("inf"), F.lit(False)) for c in ("x", "y")]
    rows = points.select(*columns).where(finite[0] & finite[1])
    schema = rows.schema
    tasks = max(1, rows.rdd.getNumPartitions())
    found = rows.mapInArrow(_thinner(by), schema)
    for _ in range(math.ceil(math.log(tasks, FAN)) - 1 if tasks > FAN else 0):
        tasks = -(-tasks // FAN)
        part = F.pmod(F.spark_partition_id(), F.lit(tasks)).alias("_part")
        found = found.select("*", part).repartition(*by, "_part").drop("_part").mapInArrow(_thinner(by), schema)
    gathered = found.groupBy(*by).agg(F.collect_list(F.struct("x", "y")).alias("corners"))  # FAN hulls at most
    ring = T.ArrayType(T.ArrayType(T.DoubleType()))
    return gathered.mapInArrow(_rings(by), T.StructType([*[f for f in schema.fields if f.name in by], T.StructField("ring", ring)]))


def _thinner(by: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        count, least = 0, HELD
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            count += batch.num_rows
            if count >= least:
                thin = _thinned(pa.concat_tables(held), by)
                held, count = [thin], thin.num_rows
                if count > KEPT:  # many groups: what is known of them goes on
                    yield from thin.to_batches(max_chunksize=10_000)
                    held, count = [], 0
                least = max(HELD, 2 * count)
        if held:
            yield from _thinned(pa.concat_tables(held), by).to_batches(max_chunksize=10_000)

    return run


def _thinned(table: pa.Table, by: list[str]) -> pa.Table:
    groups = table.group_by(by, use_threads=False).aggregate([("x", "list"), ("y", "list")]).combine_chunks()
    corners, sizes = [], []
    for xs, ys in zip(groups["x_list"].to_numpy(), groups["y_list"].to_numpy()):
        found = hull(np.column_stack([xs, ys]))
        corners.append(found)
        sizes.append(len(found))
    at = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.concatenate(corners) if corners else np.empty((0, 2))
    columns = {c: groups[c].take(pa.array(at)) for c in by}
    return pa.table({**columns, "x": flat[:, 0], "y": flat[:, 1]}).select(table.column_names).cast(table.schema)


def _rings(by: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = []
            for corners in batch.column("corners"):
                values = corners.values
                found = hull(np.column_stack([values.field("x").to_numpy(), values.field("y").to_numpy()])).tolist()
                rings.append(found + found[:1] if len(found) > 2 else found)
            columns = [batch.column(c) for c in by]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rings, pa.list_(pa.list_(pa.float64())))], names=[*by, "ring"])

    return run
