"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.components import components
from obsframe.workspace import materialize

# Cells are fitted on so many vectors at most; every vector is assigned to one.
FIT_ROWS, MOST_CELLS, ROUNDS = 20_000, 1024, 10
BLOCK_ROWS, CHUNK = 8192, 1024


def valid(vector: str) -> Column:
    """Not NULL, and of finite components that are not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    for at, (end, n) in enumerate(zip(np.cumsum(lengths).tolist(), lengths.tolist())):
        out[at, :n] = flat[end - n : end]
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit_cells(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of spherical k-means: rows go to the centre of the largest cosine, centres are mean directions."""
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(int)]
    for _ in range(ROUNDS):
        home = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def reachable(rows: np.ndarray, home: np.ndarray, centres: np.ndarray, least: float) -> np.ndarray:
    """(rows, cells): whether a vector at a cosine of ``least`` or more from the row can be at home in the cell.

    Such a vector lies at most the angle acos(least) away, and all vectors of another cell lie beyond the plane
    between the two centres; so a row farther than that from the plane has no partner there.
    """
    away = math.sin(math.acos(max(min(least, 1.0), 0.0)))
    own = np.einsum("ij,ij->i", rows, centres[home])[:, None] - rows @ centres.T
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))[home]
    return own <= away * apart + 1e-9


class Forest:
    """Local components: the root of each row is the smallest row it is connected to."""

    def __init__(self, rows: int):
        self.root = np.arange(rows)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (self.root != (up := self.root[self.root])).any():
                self.root = up


def compare(left: np.ndarray, right: np.ndarray | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of left, row of right) of the pairs at a cosine of ``least`` or more, block by block; each unordered pair
    of ``left`` once if there is no ``right``. Rows have unit length. Products are taken in single precision, those
    that could go either way again in double precision."""
    other = left if right is None else right
    doubt = 4e-7 * (8 + left.shape[1]) if left.size else 0.0
    single, columns = left.astype(np.float32), other.astype(np.float32).T.copy()
    for at in range(0, len(left), CHUNK):
        first = at if right is None else 0
        products = single[at : at + CHUNK] @ columns[:, first:]
        i, j = np.nonzero(products >= least - doubt)
        close = products[i, j] < least + doubt
        i, j = i + at, j + first
        keep = np.ones(len(i), bool)
        if right is None:
            keep = i < j
        keep[close] &= np.einsum("ij,ij->i", left[i[close]], other[j[close]]) >= least
        yield i[keep], j[keep]


def near_duplicates(vectors: DataFrame, least: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) per row of ``vectors``.

    Rows are linked at a cosine of ``least`` or more; ``component_id`` is the smallest key reachable by links, and
    the row that has it is ``kept``. Vectors that are NULL, empty, zero, or hold NULL or non-finite components link
    with nothing. Equal vectors are compared once, as one with a weight; vectors of fewer components count as filled
    up with zeros. A row with a NULL key counts as a link, but is never kept and names no component. Other columns,
    labels too, are not looked at.

    No link is lost between cells: a row also meets those cells that can hold a partner (:func:`reachable`). Cells
    are split into blocks, and each pair of blocks is a task's work, so none grows with a group. Where vectors form
    no clusters at all, every block can meet every other one.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    same = F.sha2(F.array_join(F.col("vector").cast("array<string>"), ",").cast("binary"), 256)
    rows = materialize(rows.withColumn("class", F.when(valid("vector"), same)), "vectors")
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("key").alias("smallest"), F.count("*").alias("size"), F.first("vector").alias("vector")
    )
    classes = materialize(classes, "vector-classes")
    count, width = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    linked = _linked(classes, count, width, least) if count else None
    if linked is None:
        found = classes.select("class", F.lit(0).cast("bigint").alias("others"), "smallest")
    else:
        linked = materialize(linked, "vector-links")
        roots = components(linked.select(F.col("class").alias("a"), F.col("root").alias("b")))
        degrees = linked.groupBy("class").agg(F.sum("others").alias("others"))
        rooted = classes.select("class", "smallest").join(roots, F.col("class") == F.col("node"), "left").select(
            "class", "smallest", F.coalesce("root", "class").alias("root")
        )
        ids = rooted.groupBy("root").agg(F.min("smallest").alias("smallest"))
        found = rooted.select("class", "root").join(ids, "root").join(degrees, "class", "left").select(
            "class", F.coalesce("others", F.lit(0)).alias("others"), "smallest"
        )
    sized = classes.select("class", "size").join(found, "class")
    out = rows.select("key", "class").join(sized, "class", "left")
    component = F.coalesce("smallest", F.when(F.col("class").isNull(), F.col("key")))
    return out.select(
        F.col("key").alias(key), F.coalesce(F.col("others") + F.col("size") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )


def _linked(classes: DataFrame, count: int, width: int, least: float) -> DataFrame:
    """(class, root, others): per class with a link and task, one it is connected to, and the rows it is linked with."""
    spark = classes.sparkSession
    cells = max(1, min(MOST_CELLS, math.ceil(count / BLOCK_ROWS)))
    sample = classes.select("class", "vector").orderBy(F.xxhash64("class")).limit(FIT_ROWS).select("vector").toArrow()
    centres = spark.sparkContext.broadcast(fit_cells(unit(matrix(sample.column("vector"), width)), cells))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home = (unit(matrix(batch.column("vector"), width)) @ centres.value.T).argmax(axis=1).astype(np.int32)
                yield batch.append_column("cell", pa.array(home))

    kinds = "class string, size bigint, vector array<double>"
    at_home = materialize(classes.select("class", "size", "vector").mapInArrow(assign, f"{kinds}, cell int"), "vector-cells")
    sizes = np.zeros(cells, np.int64)
    for cell, n in at_home.groupBy("cell").count().collect():  # one row per cell
        sizes[cell] = n
    parts = np.maximum(1, -(-sizes // BLOCK_ROWS))
    first = np.concatenate([[0], np.cumsum(parts)])  # the blocks of a cell

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                some = batch.slice(at, CHUNK)
                home = some.column("cell").to_numpy()
                can = np.repeat(reachable(unit(matrix(some.column("vector"), width)), home, centres.value, least), parts, axis=1)
                block = first[home] + [int(c[:15], 16) % n for c, n in zip(some.column("class").to_pylist(), parts[home].tolist())]
                row, other = np.nonzero(can)
                low, high = np.minimum(block[row], other), np.maximum(block[row], other)
                data = some.drop_columns(["cell"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low), pa.array(high), pa.array(block[row] == low), *data.columns], ["low", "high", "is_low", *data.schema.names]
                )

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by([("is_low", "descending")])
        rows, size = unit(matrix(table.column("vector"), width)), table.column("size").to_numpy()
        split = int(table.column("is_low").to_numpy(zero_copy_only=False).sum())
        alone = table.column("low")[0] == table.column("high")[0]
        others, forest = np.zeros(len(rows), np.int64), Forest(len(rows))
        for i, j in compare(rows, None, least) if alone else compare(rows[:split], rows[split:], least):
            j = j if alone else j + split
            np.add.at(others, i, size[j])
            np.add.at(others, j, size[i])
            forest.link(i, j)
        hit = np.flatnonzero(others)
        names = table.column("class")
        return pa.table({"class": names.take(pa.array(hit)), "root": names.take(pa.array(forest.root[hit])), "others": others[hit]})

    pairs = at_home.mapInArrow(visit, f"low bigint, high bigint, is_low boolean, {kinds}")
    return pairs.groupBy("low", "high").applyInArrow(link, "class string, root string, others bigint")
