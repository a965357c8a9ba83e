"""k-means|| over rows that no cluster holds in memory: every pass reads them where they are stored, and keeps none.

Only candidates, counts and sums leave the tasks. Rows come as one column of arrays of numbers, which are no gaps."""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.operators.kmeans import first_nearest, squares

# Distances that are looked at together.
CELLS = 1 << 17
Parts = Iterator[np.ndarray]


def fit_parallel(rows: DataFrame, k: int, seed: int, rounds: int = 20, tol: float = 1e-4, steps: int = 2) -> np.ndarray:
    """Centres, by the steps and limits of Spark ML's k-means: :func:`begin`, then Lloyd's rounds until no centre moves
    by more than ``tol``. A centre without rows stays. Where there are fewer distinct rows than ``k``, so are centres."""
    found = begin(rows, k, seed, steps)
    for _ in range(rounds):
        counts, sums = _sums(rows, found)
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], found)
        still = ((moved - found) ** 2).sum(axis=1).max() <= tol**2
        found = moved
        if still:
            break
    return found


def begin(rows: DataFrame, k: int, seed: int, steps: int) -> np.ndarray:
    """One row, then in each step every row with a probability by its squared distance, 2 ``k`` of them on average; of
    these ``k`` by k-means++, weighted by the number of rows nearest to them."""
    (column,) = rows.columns
    first = rows.orderBy(F.xxhash64(column, F.lit(seed)), column).limit(1).collect()
    if not first:
        raise ValueError("no rows to fit")
    found = np.array([first[0][0]])
    for step in range(steps):
        # Which rows are taken depends on the sum of all distances: tasks give all that may be, by their own sums.
        drawn = _each(rows, found, lambda parts, centres: _drawn(parts, centres, 2 * k, (seed, step)), "cost double, bar double, point array<double>").collect()
        cost = math.fsum(r.cost for r in drawn if r.cost is not None)
        taken = [r.point for r in drawn if r.point is not None and r.bar * cost < 2 * k]
        if taken:
            found = np.unique(np.concatenate([found, np.array(taken)]), axis=0)
    return found if len(found) <= k else plus_plus(found, _sums(rows, found)[0], k)


def points_of(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def parts_of(points: np.ndarray, centres: int) -> Parts:
    rows = max(16, CELLS // centres)
    return (points[at : at + rows] for at in range(0, len(points), rows))


def _each(rows: DataFrame, centres: np.ndarray, make: Callable[[Parts, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``make(parts, centres)`` yields from all points of a task, which come in parts."""
    sent = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from make((part for b in batches for part in parts_of(points_of(b.column(0)), len(sent.value))), sent.value)

    return rows.mapInArrow(run, schema)


def _drawn(parts: Parts, centres: np.ndarray, wanted: int, seed: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """A task's sum of squared distances, and the rows that a draw may take, each with its number in (0, 1) by its own
    distance: a row is taken if that is below ``wanted`` by the sum over all tasks."""
    chance = np.random.default_rng([s % (1 << 32) for s in (*seed, TaskContext.get().partitionId())])
    cost, bars, taken = 0.0, np.empty(0), np.empty((0, centres.shape[1]))
    for points in parts:
        if not np.isfinite(points).all():
            raise ValueError("a feature is not finite")
        apart = ((points - centres[first_nearest(points, centres)]) ** 2).sum(axis=1)
        cost += apart.sum()
        drawn = chance.random(len(points))
        may = np.flatnonzero(drawn * cost < wanted * apart)
        bars, taken = np.concatenate([bars, drawn[may] / apart[may]]), np.concatenate([taken, points[may]])
        still = bars * cost < wanted
        bars, taken = bars[still], taken[still]
    yield pa.RecordBatch.from_arrays([
        pa.array([cost, *[None] * len(bars)], pa.float64()), pa.array([None, *bars], pa.float64()),
        pa.array([None, *taken.tolist()], pa.list_(pa.float64())),
    ], ["cost", "bar", "point"])


def _added(parts: Parts, centres: np.ndarray) -> Iterator[pa.RecordBatch]:
    counts, sums = np.zeros(len(centres), np.int64), np.zeros(centres.shape)
    for points in parts:
        label = first_nearest(points, centres)
        counts += np.bincount(label, minlength=len(centres))
        if len(centres) <= 64:
            sums += (label == np.arange(len(centres))[:, None]).astype(float) @ points
        else:
            np.add.at(sums, label, points)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.float64()))], ["label", "n", "sums"]
    )


def _sums(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many rows are nearest to each centre, and their sums. Tasks add up their own; only these are shuffled."""
    parts = _each(rows, centres, _added, "label int, n bigint, sums array<double>")
    added = parts.groupBy("label").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(centres.shape[1])])
    counts, sums = np.zeros(len(centres), np.int64), np.zeros(centres.shape)
    for label, n, *of in map(tuple, added.collect()):  # one row per centre
        counts[label], sums[label] = n, of
    return counts, sums


def plus_plus(points: np.ndarray, weights: np.ndarray, k: int, rounds: int = 30) -> np.ndarray:
    """``k`` centres of a few weighted points: drawn by distance, then moved."""
    chance = np.random.default_rng(0)
    found = points[[chance.choice(len(points), p=weights / weights.sum())]]
    while len(found) < k:
        share = weights * squares(points, found).min(axis=1)
        if not share.sum():
            break
        found = np.concatenate([found, points[[chance.choice(len(points), p=share / share.sum())]]])
    for _ in range(rounds):
        own = (squares(points, found).argmin(axis=1) == np.arange(len(found))[:, None]) * weights
        counts = own.sum(axis=1)
        moved = np.where(counts[:, None] > 0, own @ points / np.maximum(counts, 1)[:, None], found)
        if (moved == found).all():
            break
        found = moved
    return found
