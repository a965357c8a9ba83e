"""Near-duplicates by SimHash fingerprints, found by pigeonring filtering.

The bits of a fingerprint lie on a ring of ``distance + 1`` segments. If two fingerprints differ in at most
``distance`` bits, there is a segment from which every chain of l consecutive segments differs in at most
``l * distance / (distance + 1)`` bits, rounded down: none in the first, one in the first two, and so on round the
ring. Candidates share such a first segment, and the second but for one bit; longer chains prune them, the whole
ring is the distance itself.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import blocks, raw_texts
from obsframe.llm.components import components
from obsframe.workspace import materialize

BITS = 64
BLOCK_BYTES = 4 << 20


def fingerprint_texts(texts: list[bytes], words: int, seed: int) -> np.ndarray:
    """One unsigned fingerprint per UTF-8 text: bit k is 1 if it is set in over half of the hashes of its shingles."""
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        found = text.lower().split()  # of bytes: A-Z only, and between the ASCII blanks
        if len(found) <= words:
            counts.append(min(len(found), 1))
            hashes += [digest(b" ".join(found), seed)] if found else []
            continue
        joined = b" ".join(found)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(found) - words + 1].tolist()
        hashes += [digest(joined[i:j], seed) for i, j in zip(starts, ends[words - 1 :].tolist())]
        counts.append(len(starts))
    return majority(np.array(hashes, np.uint64), np.array(counts, np.int64))


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits set in over half of each run of ``counts[i]`` hashes; an empty run has none."""
    found = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return found
    # Eight counters of a byte each are added at once, so a sum is over 255 hashes at most.
    ends = np.cumsum(counts)
    pieces = [np.arange(e - n, e, 255) for e, n in zip(ends[full].tolist(), counts[full].tolist())]
    starts = np.concatenate(pieces)
    first_piece = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]])
    lanes = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    sums = np.stack([np.add.reduceat(lanes[octets[:, k]], starts) for k in range(8)], axis=1)
    per_bit = np.add.reduceat(sums.view(np.uint8).reshape(-1, BITS), first_piece, axis=0, dtype=np.int64)
    over = per_bit * 2 > counts[full][:, None]
    found[full] = np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]
    return found


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint bigint) per row; a text without words (or NULL) has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            found = fingerprint_texts(raw_texts(block.column("text")), words, seed)
            yield pa.RecordBatch.from_arrays([block.column("key"), pa.array(found.view(np.int64))], ["key", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return named.mapInArrow(run, f"key {kind}, fingerprint bigint").withColumnRenamed("key", key)


class Ring:
    """The segments of the ring, and the chains that start at each."""

    def __init__(self, distance: int):
        self.distance, self.segments = distance, distance + 1
        cuts = [BITS * i // self.segments for i in range(self.segments + 1)]
        self.masks = [sum(1 << b for b in range(i, j)) for i, j in zip(cuts, cuts[1:])]
        # A start, with the bit of the next segment that may differ.
        self.starts = []
        for i in range(self.segments if distance else 0):
            n = (i + 1) % self.segments
            self.starts += [(i, bit) for bit in range(cuts[n], cuts[n + 1])]

    def mask(self, start: int) -> np.uint64:
        """Of the bits that all of a bucket share."""
        i, bit = self.starts[start]
        return np.uint64((self.masks[i] | self.masks[(i + 1) % self.segments]) & ~(1 << bit))

    def linked(self, start: int, differing: np.ndarray) -> np.ndarray:
        """Which differences stay within the budget of each chain from the start's segment on."""
        i, _ = self.starts[start]
        chain = self.masks[i]
        alive = np.arange(len(differing))
        for length in range(2, self.segments + 1):
            chain |= self.masks[(i + length - 1) % self.segments]
            budget = length * self.distance // self.segments
            alive = alive[np.bitwise_count(differing[alive] & np.uint64(chain)) <= budget]
        found = np.zeros(len(differing), bool)
        found[alive] = True
        return found

    def spread(self, prints: np.ndarray) -> np.ndarray:
        """The bucket of each fingerprint, for one start after the other."""
        return np.concatenate([prints & self.mask(s) for s in range(len(self.starts))])

    def stars(self, start: int, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Edges that connect what is linked within a bucket: a fingerprint reached once is not compared again."""
        left = np.unique(prints)
        while len(left) > 1:
            root, left = left[0], left[1:]
            front = [root]
            while front and len(left):
                near = self.linked(start, left ^ front.pop())
                if near.any():
                    hit, left = left[near], left[~near]
                    front += list(hit)
                    yield np.full(len(hit), root), hit


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, enough to connect all that differ in at most ``distance`` bits."""
    ring = Ring(distance)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fingerprint").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for at in range(0, len(values) if ring.starts else 0, 4096):
                part = values[at : at + 4096]
                starts = np.repeat(np.arange(len(ring.starts), dtype=np.int32), len(part))
                columns = [starts, ring.spread(part).view(np.int64), np.tile(part, len(ring.starts)).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["start", "bucket", "fingerprint"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in order of their bucket; the last one may go on in the next batch.
        rest: list[np.ndarray] = []
        for batch in batches:
            rest.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1, 2)]))
            rows = np.concatenate(rest, axis=1) if rest[0][0, 0] != rest[-1][0, -1] or rest[0][1, 0] != rest[-1][1, -1] else None
            if rows is None:
                continue
            new = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
            yield from found(rows[:, : new[-1]], np.concatenate([[0], new[:-1]]))
            rest = [rows[:, new[-1] :]]
        if rest:
            rows = np.concatenate(rest, axis=1)
            yield from found(rows, np.array([0]))

    def found(rows: np.ndarray, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.diff(np.append(first, rows.shape[1]))
        prints = rows[2].view(np.uint64)
        edges = []
        pairs = first[sizes == 2]
        starts = rows[0][pairs]
        for s in np.unique(starts):
            a, b = prints[pairs[starts == s]], prints[pairs[starts == s] + 1]
            near = ring.linked(int(s), a ^ b)
            edges.append((a[near], b[near]))
        for at, n in zip(first[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            edges += ring.stars(int(rows[0, at]), prints[at : at + n])
        if edges:
            a, b = (np.concatenate([e[k] for e in edges]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    buckets = prints.select("fingerprint").mapInArrow(spread, "start int, bucket bigint, fingerprint bigint")
    together = buckets.repartition("start", "bucket").sortWithinPartitions("start", "bucket")
    return together.mapInArrow(link, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, words: int = 4, distance: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, fingerprint, component_id) per row of ``docs``; ``component_id`` is the smallest key reachable over
    fingerprints that differ in at most ``distance`` bits.

    Fingerprints that repeat are compared once, whatever their number of rows. NULL and empty texts, and those of
    blanks only, have fingerprint 0, which is linked like any other. A row with a NULL key keeps its fingerprint and
    gets the smallest key of its component, NULL if there is none. Other columns are not looked at.
    """
    printed = materialize(fingerprints(docs, words, seed, key, text), "fingerprints")
    classes = printed.groupBy("fingerprint").agg(F.min(key).alias("smallest"))
    found = materialize(components(links(classes, distance)), "fingerprint-roots")
    # Most fingerprints have no link; only those with one are joined again.
    rooted = classes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "smallest", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = rooted.join(ids, "root").select("fingerprint", "component_id")
    return printed.join(named, "fingerprint").select(key, "fingerprint", "component_id")
