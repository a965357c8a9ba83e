"""k-means whose result does not depend on how rows are laid out, and nearest of many centres."""

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.operators.lookup import is_small
from obsframe.workspace import materialize

# Features are summed in whole units, so sums are exact in any order.
UNIT = 2.0**-20
MOST = 2.0**31
ROWS_AT_ONCE = 2_048
# So many bytes of rows are one binary value where rounds read them.
PACK_BYTES = 4_096
# Centres of a block share a ball; rows that no ball can bring nearer skip its block.
CENTRES_AT_ONCE = 256


@dataclass(frozen=True)
class Centres:
    """Centres in label order. They can be kept as text, so that later runs label as this one."""

    features: list[str]
    values: list[list[float]]

    def to_json(self) -> str:
        return json.dumps([self.features, self.values])

    @staticmethod
    def from_json(text: str) -> "Centres":
        return Centres(*json.loads(text))


def seeds(df: DataFrame, features: list[str], k: int, key: str, rows_per_seed: int = 20) -> Centres:
    """The first ``k`` distinct points in the order of MD5 of their rows' ``key`` (as text).

    They are looked for among the first k * ``rows_per_seed`` rows, which every task picks out of its own; only where
    so many hold fewer than ``k`` points, all distinct points are gathered."""
    hashed = complete(df, features).select(F.md5(F.col(key).cast("string").cast("binary")).alias("_hash"), *features)
    order = [F.col("_hash").asc_nulls_last(), *features]
    found = list(dict.fromkeys(tuple(r)[1:] for r in hashed.orderBy(*order).limit(k * rows_per_seed).collect()))
    if len(found) < k:
        points = hashed.groupBy(*features).agg(F.min("_hash").alias("_hash"))
        found = [tuple(r) for r in points.orderBy(*order).limit(k).select(*features).collect()]
    return Centres(features, [list(p) for p in found[:k]])


def finite(features: list[str]) -> Column:
    """Whether each feature is a number, and finite."""
    return reduce(Column.__and__, [F.coalesce(F.abs(F.col(f).cast("double")) < float("inf"), F.lit(False)) for f in features])


def complete(df: DataFrame, features: list[str]) -> DataFrame:
    """The rows in which each feature is a finite number; features as doubles."""
    return df.where(finite(features)).withColumns({f: F.col(f).cast("double") for f in features})


def fit_centres(df: DataFrame, features: list[str], k: int, key: str, rounds: int = 20, given: Centres | None = None) -> Centres:
    """Centres after up to ``rounds`` rounds, or once no centre moves, of the (stored) rows; sorted, so labels do not
    depend on the order of seeds. Begins with :func:`seeds`, or ``given`` centres.

    The features are stored once as bytes, which rounds read as they are. A round is one pass: tasks add up the features
    of the rows nearest to each centre, in whole UNITs, and only these sums are shuffled. Each distance is added up
    feature by feature, ties go to the first centre, and a centre without rows stays. So the same rows give the same
    centres in any partitioning, order or cluster. Rows with a feature that is no finite number take no part; one beyond
    MOST fails the job.
    """
    centres = given or seeds(df, features, k, key)
    if not centres.values or rounds < 1:
        return Centres(features, sorted(centres.values))
    rows = materialize(_packed(complete(df.select(*features), features)), "kmeans-points")
    for _ in range(rounds):
        moved = _moved(rows, centres)
        if moved == centres.values:
            break
        centres = Centres(features, moved)
    return Centres(features, sorted(centres.values))


def _packed(rows: DataFrame) -> DataFrame:
    """(points): the numbers of some rows one after the other, as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if np.abs(points).max(initial=0) >= MOST:
                raise ValueError(f"a feature lies beyond {MOST}")
            some = max(1, PACK_BYTES // (8 * points.shape[1]))
            packs = [points[at : at + some].tobytes() for at in range(0, len(points), some)]
            yield pa.RecordBatch.from_arrays([pa.array(packs, pa.binary())], ["points"])

    return rows.mapInArrow(pack, "points binary")


def _moved(rows: DataFrame, centres: Centres) -> list[list[float]]:
    sent = rows.sparkSession.sparkContext.broadcast(np.array(centres.values))  # k x features numbers
    k, width = len(centres.values), len(centres.features)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), object)
        for batch in batches:
            points = _points(batch.column(0), width)
            for at in range(0, len(points), ROWS_AT_ONCE):
                some = points[at : at + ROWS_AT_ONCE]
                label = first_nearest(some, sent.value)
                units = np.floor(some * (1 / UNIT) + 0.5).astype(np.int64)
                order = np.argsort(label.astype(np.int16) if k < 1 << 15 else label, kind="stable")
                firsts = np.flatnonzero(np.diff(label[order], prepend=-1))
                own = label[order[firsts]]
                total[own, :width] += np.add.reduceat(units[order], firsts, axis=0).astype(object)
                total[own, width] += np.diff(firsts, append=len(some)).astype(object)
        used = np.flatnonzero(total[:, width] > 0)
        yield pa.RecordBatch.from_pydict({
            "label": pa.array(used, pa.int64()), "n": pa.array(total[used, width].tolist(), pa.int64()),
            "sums": pa.array([[str(v) for v in total[c, :width]] for c in used], pa.list_(pa.string())),
        })

    parts = rows.mapInArrow(sums, "label bigint, n bigint, sums array<string>")
    added = parts.groupBy("label").agg(F.sum("n").alias("n"), *[
        F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)
    ]).collect()  # one row per centre
    moved = [list(c) for c in centres.values]
    for r in added:
        moved[r.label] = [float(int(r[f"s{i}"])) / r.n * UNIT for i in range(width)]
    sent.unpersist()
    return moved


def _points(packs: pa.Array, width: int) -> np.ndarray:
    """The rows of :func:`_packed` values, which lie one after the other."""
    packs = packs.cast(pa.binary())
    if not len(packs):
        return np.empty((0, width))
    offsets = np.frombuffer(packs.buffers()[1], np.int32)[packs.offset : packs.offset + len(packs) + 1]
    return np.frombuffer(packs.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.float64).reshape(-1, width)


def first_nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The label of :func:`nearest`. Products of matrices settle the points whose nearest centre is nearer than the
    others by more than rounding can change; distances are added up for the rest."""
    with np.errstate(all="ignore"):
        far = points @ (-2 * centres.T) + np.einsum("ij,ij->i", centres, centres)
        label = far.argmin(axis=1)
        doubt = np.einsum("ij,ij->i", points, points) + np.einsum("ij,ij->i", centres, centres).max()
        doubt *= 64 * (points.shape[1] + 4) * np.finfo(float).eps
        close = np.flatnonzero((far <= (far[np.arange(len(points)), label] + doubt)[:, None]).sum(axis=1) != 1)
    if len(close):
        label[close] = nearest(points[close], centres)[0]
    return label


def squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, added up feature by feature, so that every engine gets the same numbers."""
    total = np.zeros((len(points), len(centres)))
    for f in range(points.shape[1]):
        apart = points[:, f, None] - centres[None, :, f]
        apart *= apart
        total += apart
    return total


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point the first of the nearest centres, and its squared distance."""
    far = squares(points, centres)
    label = far.argmin(axis=1)
    return label, far[np.arange(len(points)), label]


def assign_centres(df: DataFrame, centres: Centres) -> DataFrame:
    """Add ``prediction``, the label of the nearest centre, to the rows whose features are finite numbers. Only the
    features go through Python: one expression of k distances would be more code than a JVM compiles."""
    rows = df.where(finite(centres.features))
    if not centres.values:
        return rows.withColumn("prediction", F.lit(None).cast("int")).where(F.lit(False))
    if len(centres.values) == 1:
        return rows.withColumn("prediction", F.lit(0))
    values = np.array(centres.values)

    def label(*columns: pa.Array) -> pa.Array:
        points = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
        found = [first_nearest(points[at : at + ROWS_AT_ONCE], values) for at in range(0, len(points), ROWS_AT_ONCE)]
        return pa.array(np.concatenate([*found, np.empty(0, np.int64)]), pa.int32())

    labelled = F.arrow_udf(label, "int", F.ArrowUDFType.SCALAR)(*[F.col(f).cast("double") for f in centres.features])
    return rows.withColumn("prediction", labelled).select(*df.columns, "prediction")


class CentreBlocks:
    """Many centres in blocks around pivots. The distance from a point to any centre of a block is at least its
    distance to the pivot less the block's radius, so blocks beyond the nearest centre so far are skipped."""

    def __init__(self, centres: np.ndarray, labels: np.ndarray) -> None:
        order = np.argsort(labels, kind="stable")
        centres, labels = centres[order], labels[order]
        count = max(1, -(-len(centres) // CENTRES_AT_ONCE))
        pivots = centres[np.linspace(0, len(centres) - 1, count).astype(int)]
        home = np.concatenate([squares(centres[at : at + ROWS_AT_ONCE], pivots).argmin(axis=1) for at in range(0, len(centres), ROWS_AT_ONCE)])
        self.blocks = []
        for b in np.unique(home):
            own, named = centres[home == b], labels[home == b]
            for at in range(0, len(own), CENTRES_AT_ONCE):
                some = own[at : at + CENTRES_AT_ONCE]
                self.blocks.append((some, named[at : at + CENTRES_AT_ONCE]))
        self.middles = np.stack([b.mean(axis=0) for b, _ in self.blocks])
        self.radii = np.array([np.sqrt(squares(b, m[None]).max()) for (b, _), m in zip(self.blocks, self.middles)])

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """Per point the smallest label of the nearest centres."""
        count = len(points)
        least, label = np.full(count, np.inf), np.zeros(count, self.blocks[0][1].dtype)
        bound = np.maximum(np.sqrt(squares(points, self.middles)) - self.radii, 0)
        turns = np.argsort(bound, axis=1, kind="stable")
        for turn in range(len(self.blocks)):
            # A doubt as wide as rounding keeps a block that could tie.
            open_ = np.flatnonzero(bound[np.arange(count), turns[:, turn]] <= np.sqrt(least) * (1 + 1e-9) + 1e-12)
            if not len(open_):
                break
            asked = turns[open_, turn]
            for b in np.unique(asked):
                rows = open_[asked == b]
                centres, labels = self.blocks[b]
                far = squares(points[rows], centres)
                first = far.argmin(axis=1)
                far, named = far[np.arange(len(rows)), first], labels[first]
                better = (far < least[rows]) | (far == least[rows]) & (named < label[rows])
                least[rows[better]], label[rows[better]] = far[better], named[better]
        return label


def assign_many(df: DataFrame, vector: str, centres: DataFrame) -> DataFrame:
    """Add ``prediction`` for (stored) ``centres`` (label bigint, centre), by one pass over the rows.

    The centres, which must be small enough to broadcast, are sent to all tasks in blocks; a row is compared with the
    blocks that can hold its nearest. Rows whose vector is NULL, or holds a NULL or a NaN, or has another width than the centres, get
    a NULL, as do all rows where there are no centres."""
    usable = centres.where(F.col("label").isNotNull() & ~F.exists(F.coalesce("centre", F.array(F.lit(None))), lambda v: v.isNull() | F.isnan(v)))
    if not is_small(centres):
        raise ValueError("too many centres to send to every task")
    sent_rows = usable.select(F.col("label").cast("bigint"), F.col("centre").cast("array<double>")).toArrow()
    found = None
    if sent_rows.num_rows:
        values = np.array(sent_rows.column("centre").to_pylist())
        found = CentreBlocks(values, sent_rows.column("label").to_numpy())
    sent = df.sparkSession.sparkContext.broadcast(found)
    fields = df.schema
    schema = type(fields)([*fields.fields]).add("prediction", "long")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                yield some.append_column("prediction", _labels(some.column(vector), blocks))

    return df.mapInArrow(assign, schema)


def _labels(column: pa.Array, blocks: CentreBlocks | None) -> pa.Array:
    import pyarrow.compute as pc

    if blocks is None:
        return pa.nulls(len(column), pa.int64())
    width = blocks.middles.shape[1]
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy()
    fits = np.flatnonzero(lengths == width)
    flat = pc.take(column, pa.array(fits)).flatten().cast(pa.float64())
    points = flat.to_numpy(zero_copy_only=False).reshape(len(fits), width)
    whole = ~np.isnan(points).any(axis=1)
    labels = np.zeros(len(column), np.int64)
    known = np.zeros(len(column), bool)
    if whole.any():
        labels[fits[whole]] = blocks.nearest(points[whole])
        known[fits[whole]] = True
    return pa.array(labels, pa.int64(), mask=~known)
