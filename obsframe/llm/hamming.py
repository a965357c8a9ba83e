"""Exact top-k search over binary codes by incremental multi-index hashing."""

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsframe.llm.pretokens import ranges
from obsframe.workspace import materialize

BITS, SEGMENT = 64, 16
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 8192, 1024


def sign_code(vector: str) -> Column:
    """A code with bit i set where component i (of the first 64) is above zero; NULL for a vector that is NULL, empty
    or holds a NULL or NaN component."""
    values = F.slice(F.col(vector), 1, BITS)
    bad = F.exists(values, lambda v: v.isNull() | F.isnan(v)) | (F.size(values) < 1)
    bits = F.transform(values, lambda v, i: F.when(v > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return F.when(F.col(vector).isNotNull() & ~bad, F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b)))


class MultiIndex:
    """The codes of a block, sorted by each of their segments of 16 bits.

    Codes that differ from a query in at most ``segments * (r + 1) - 1`` bits have a segment that differs in at most
    r. So once all segments within r have been looked up, that many bits are covered.
    """

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        order = np.lexsort((ids, codes))
        self.ids, self.codes = ids[order], codes[order].view(np.uint64)
        self.tables = []
        for s in range(BITS // SEGMENT):
            values = self.values(self.codes, s)
            by = np.argsort(values, kind="stable")
            self.tables.append((by, np.searchsorted(values[by], np.arange((1 << SEGMENT) + 1))))
        self.flips = [
            np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT), r)], np.int64) for r in range(SEGMENT + 1)
        ]

    @staticmethod
    def values(codes: np.ndarray, segment: int) -> np.ndarray:
        return ((codes >> np.uint64(SEGMENT * segment)) & np.uint64((1 << SEGMENT) - 1)).astype(np.int64)

    def search(self, code: int, k: int, besides: int | None) -> list[tuple[int, int]]:
        """The k nearest (distance, id) in order, the id ``besides`` left out; all of them if there are fewer."""
        query = np.uint64(code)
        seen = np.zeros(len(self.codes), bool)
        at, far = np.empty(0, np.int64), np.empty(0, np.int64)
        parts = [int(self.values(np.array([query]), s)[0]) for s in range(len(self.tables))]
        for radius in range(SEGMENT + 1):
            new = [self.rows(s, parts[s] ^ self.flips[radius]) for s in range(len(self.tables))]
            found = np.zeros(len(self.codes), bool)
            found[np.concatenate(new)] = True
            new = np.flatnonzero(found & ~seen)
            seen |= found
            if besides is not None:
                new = new[self.ids[new] != besides]
            at = np.concatenate([at, new])
            far = np.concatenate([far, np.bitwise_count(self.codes[new] ^ query).astype(np.int64)])
            if len(at) > k:
                kept = np.lexsort((self.ids[at], far))[:k]
                at, far = at[kept], far[kept]
            covered = len(self.tables) * (radius + 1) - 1
            if len(at) >= k and far.max() <= covered or seen.all():
                break
        order = np.lexsort((self.ids[at], far))[:k]
        return list(zip(far[order].tolist(), self.ids[at[order]].tolist()))

    def rows(self, segment: int, values: np.ndarray) -> np.ndarray:
        by, bounds = self.tables[segment]
        starts, ends = bounds[values], bounds[values + 1]
        full = ends > starts
        return ranges(by, starts[full], ends[full])


def top_k(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", code: str = "code") -> DataFrame:
    """(key, rank, neighbour, distance): for every query the ``k`` rows at the smallest Hamming distance.

    Of equal distances the smaller key comes first; rows with the query's own key are not its neighbours, rows that
    repeat a key count once, rows and queries without key or code take no part, and a query gets fewer than ``k``
    neighbours only where there are no more rows. Codes that repeat are searched as one, for any number of rows:
    only the ``k + 1`` smallest keys of a code can be among the nearest.

    Every block of queries meets every block of codes once. Within, the search grows by multi-index hashing until the
    k-th distance is covered; then the blocks' k best are merged.
    """
    kept = rows.select(F.col(key).alias("id"), F.col(code).alias("code")).dropna()
    # Exact: neighbours of one code are at one distance, so the smallest keys win, and the query itself may be one.
    smallest = Window.partitionBy("code").orderBy("id")
    index = kept.distinct().withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k + 1).select("id", "code")
    index = materialize(index, "codes")
    asked = materialize(queries.select(F.col(key).alias("id"), F.col(code).alias("code")).dropna().distinct(), "queries")
    row_blocks = max(1, math.ceil(index.count() / ROWS_PER_BLOCK))
    query_blocks = max(1, math.ceil(asked.count() / QUERIES_PER_BLOCK))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("code", "id"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = index.select("id", "code", F.lit(False).alias("asks"), block(row_blocks).alias("r"), every(query_blocks).alias("q"))
    right = asked.select("id", "code", F.lit(True).alias("asks"), every(row_blocks).alias("r"), block(query_blocks).alias("q"))

    def search(batch: pa.Table) -> pa.Table:
        ids, codes = (batch.column(c).to_numpy() for c in ("id", "code"))
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        tree = MultiIndex(ids[~asks], codes[~asks])
        found = [(i, n, d) for i, c in zip(ids[asks].tolist(), codes[asks].view(np.uint64).tolist()) for d, n in tree.search(c, k, i)]
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({"id": pa.array(columns[0], pa.int64()), "neighbour": pa.array(columns[1], pa.int64()), "distance": pa.array(columns[2], pa.int32())})

    local = left.unionByName(right).groupBy("r", "q").applyInArrow(search, "id bigint, neighbour bigint, distance int")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    merged = local.withColumn("rank", rank).where(F.col("rank") <= k)
    return merged.select(F.col("id").alias(key), "rank", "neighbour", "distance")
