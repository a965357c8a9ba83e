"""Product codes of vectors in whole numbers: codebooks fitted in rounds, nearest entries by Orchard's search."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import schema_with
from obsframe.operators.lookup import lookup_join
from obsframe.workspace import materialize

# Rows that are searched together.
CHUNK = 8192
# Up to here no sum of squares of a vector of 2**10 components leaves 64 bits.
MOST = 1 << 26


class Orchard:
    """Of each entry, all entries by distance from it; :meth:`nearest` walks these lists.

    A point at distance r from an entry has nothing nearer, or as near, beyond twice r from that entry. So the list is
    read up to there; the first better entry is jumped to, and its list read in turn. What was compared is marked.
    Distances are squared and whole, so ties are exact; the lower index wins.
    """

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.apart = squared(entries[:, None] - entries[None])
        self.lists = np.argsort(self.apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(self.apart, self.lists, axis=1)
        self.line = np.argsort(entries[:, 0], kind="stable") if entries.shape[1] else np.arange(len(entries))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count, size = len(points), len(self.entries)
        best = np.zeros(count, np.int64)
        if self.entries.shape[1]:  # to begin with, the entry whose first component is next above
            above = np.searchsorted(self.entries[self.line, 0], points[:, 0])
            best = self.line[np.minimum(above, size - 1)]
        far = squared(points - self.entries[best])
        seen = np.zeros((count, size), bool)
        seen[np.arange(count), best] = True
        open_, at = np.arange(count), np.zeros(count, np.int64)
        while len(open_):
            at_open, current, own = at[open_], best[open_], far[open_]
            candidate = self.lists[current, at_open]
            within = self.apart[current, at_open] <= 4 * own
            fresh = within & ~seen[open_, candidate]
            look, asked = open_[fresh], candidate[fresh]
            if len(look):
                seen[look, asked] = True
                distance = squared(points[look] - self.entries[asked])
                better = (distance < far[look]) | (distance == far[look]) & (asked < best[look])
                jump = look[better]
                best[jump], far[jump], at[jump] = asked[better], distance[better], -1
            at[open_] += 1
            open_ = open_[within & (at[open_] < size)]
        return best, far


def squared(differences: np.ndarray) -> np.ndarray:
    return np.einsum("...d,...d->...", differences, differences)


def whole(vector: str) -> Column:
    """The vector as doubles, where it has no NULL or non-finite component; else NULL."""
    values = F.col(vector).cast("array<double>")
    odd = F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~odd, values)


def _matrix(column: pa.Array, width: int, scale: int) -> np.ndarray:
    numbers = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), width)
    if np.abs(numbers).max(initial=0) > MOST:
        raise ValueError(f"a component times {scale} lies beyond {MOST}; its squares would not fit")
    return numbers.astype(np.int64)


class Codebooks:
    """``entries`` (part, entry, position) of whole numbers; NumPy arrays only, so tasks get it as it is."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per vector and part the nearest entry and its squared distance."""
        parts, _, width = self.entries.shape
        found = [Orchard(self.entries[p]).nearest(np.ascontiguousarray(vectors[:, p * width : (p + 1) * width])) for p in range(parts)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def text(self) -> str:
        return ",".join(map(str, self.entries.reshape(-1).tolist()))


def fit(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks | None:
    """Codebooks of the (stored) ``vectors`` (key, vector): they begin as the parts of the first vectors by key, then
    each round every entry becomes the floor of the mean of the parts it is nearest to. None without vectors.

    The first rows by key, and a sum per entry and position, are all that reaches the driver; sums are whole numbers,
    so the result does not depend on how rows are laid out. Of rows that repeat a key, the smaller vector comes first;
    NULL keys come last."""
    first = vectors.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow().column("vector").combine_chunks()
    if not len(first):
        return None
    width = len(first[0])
    if width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    begun = _matrix(first, width, scale).reshape(len(first), parts, width // parts)
    books = Codebooks(np.ascontiguousarray(begun.transpose(1, 0, 2)))
    for _ in range(rounds):
        books = _moved(vectors, books, scale)
    return books


def _moved(vectors: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    sent = vectors.sparkSession.sparkContext.broadcast(books)  # parts x entries x positions numbers
    parts, entries, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                numbers = _matrix(batch.column("vector").slice(at, CHUNK), parts * width, scale)
                nearest, _ = sent.value.assign(numbers)
                for p in range(parts):
                    np.add.at(total[p, :, :width], nearest[:, p], numbers[:, p * width : (p + 1) * width])
                    total[p, :, width] += np.bincount(nearest[:, p], minlength=entries)
        flat = total.reshape(-1)
        at = np.flatnonzero(np.repeat(total[:, :, width].reshape(-1) > 0, width + 1))
        yield pa.RecordBatch.from_pydict({"place": at, "total": flat[at]})

    added = vectors.select("vector").mapInArrow(sums, "place bigint, total bigint").groupBy("place").agg(F.sum("total").alias("total"))
    total = np.zeros(parts * entries * (width + 1), np.int64)
    for place, value in added.collect():  # one row per place in a codebook
        total[place] = value
    total = total.reshape(parts, entries, width + 1)
    count = total[:, :, width:]
    sent.unpersist()
    return Codebooks(np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books.entries))


def code_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
) -> tuple[DataFrame, Codebooks | None]:
    """(key, codes, error, label_error) per vector, and the codebooks.

    A component x counts as floor(``scale`` * x). ``codes`` has the nearest entry of each part, ``error`` their squared
    distances summed, ``label_error`` the errors of all vectors with the same label, NULL labels being one. Left out
    are vectors that are NULL or hold NULL or non-finite components, and those whose number of components differs from
    that of the first by key, which have no place in its codebooks. Rows that repeat are coded each; without any
    vector the result is empty and there are no codebooks. Components beyond MOST / ``scale`` fail the job. Other
    columns are not looked at.
    """
    rows = vectors.select(F.col(key).alias("key"), whole(vector).alias("vector"), F.col(label).alias("label"))
    rows = rows.where(F.col("vector").isNotNull())
    first = rows.orderBy(F.col("key").asc_nulls_last(), "vector").select(F.size("vector")).first()
    rows = materialize(rows.where(F.size("vector") == (first[0] if first else 0)), "code-vectors")
    books = fit(rows, parts, entries, rounds, scale)
    kinds = schema_with(rows.select("key", "label"), {"codes": "array<int>", "error": "bigint"})
    if books is None:
        coded = rows.sparkSession.createDataFrame([], kinds)
    else:
        sent = rows.sparkSession.sparkContext.broadcast(books)

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    some = batch.slice(at, CHUNK)
                    nearest, far = sent.value.assign(_matrix(some.column("vector"), parts * sent.value.entries.shape[2], scale))
                    ends = pa.array(np.arange(0, nearest.size + 1, parts), pa.int32())
                    codes = pa.ListArray.from_arrays(ends, pa.array(nearest.reshape(-1).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [some.column("key"), some.column("label"), codes, pa.array(far.sum(axis=1))], names=["key", "label", "codes", "error"]
                    )

        coded = materialize(rows.mapInArrow(code, kinds), "vector-codes")
    # NULL is a label like any other, so the join is on a value and a mark.
    plain = F.coalesce("label", F.lit(0).cast(rows.schema["label"].dataType))
    coded = coded.withColumns({"unlabelled": F.col("label").isNull(), "label": plain})
    on = ["unlabelled", "label"]
    sums = materialize(coded.groupBy(*on).agg(F.sum("error").alias("label_error")), "label-errors")
    found = lookup_join(coded, sums, on, stored=True)
    return found.select(F.col("key").alias(key), "codes", "error", "label_error"), books
