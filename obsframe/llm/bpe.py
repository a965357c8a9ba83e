"""Byte-level BPE by corpus-level merge replay, and decoding."""

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import blocks
from obsframe.llm.pretokens import Words, by_matches, ranges

BLOCK_BYTES = 8 << 20
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file of lines "base64 rank"."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def pairs(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (left, right) in order, and the rank of the token that the two make."""
    rank = {t: r for r, t in enumerate(tokens)}
    made = sorted(
        (rank[t[:i]] << 32 | rank[t[i:]], r)
        for t, r in rank.items() for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank
    )
    keys, ranks = np.array(made, np.int64).reshape(-1, 2).T
    return keys.copy(), ranks.astype(np.int32)


class Merges:
    """Which two tokens make which: sorted keys (left, right) and ranks; as large as the vocabulary."""

    def __init__(self, tokens: list[bytes], keys: np.ndarray | None = None, ranks: np.ndarray | None = None):
        self.whole = {t: r for r, t in enumerate(tokens)}
        self.octet = np.array([self.whole[bytes([b])] for b in range(256)], np.int32)
        self.keys, self.ranks = pairs(tokens) if keys is None else (keys, ranks)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.ends = np.cumsum([len(t) for t in tokens])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        ends = self.ends[ids]
        starts = np.where(ids > 0, self.ends[ids - 1], 0)
        return ranges(self.bytes, starts, ends).tobytes()


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, one after the other; number of ids per word).

    All words are one chain of symbols with gaps. An inverted index has the positions of every pair that can merge,
    by rank. The lowest rank is applied at all its positions at once, from left to right within a word; only the
    pairs with the new symbol's neighbours are looked up anew and filed. A word that is a token needs no merge.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    size = int(ends[-1]) if len(words) else 0
    symbol = merges.octet[np.frombuffer(b"".join(words), np.uint8)] if size else np.empty(0, np.int32)
    after = np.arange(1, size + 1, dtype=np.int64)
    before = np.arange(-1, size - 1, dtype=np.int64)
    full = lengths > 0
    after[ends[full] - 1] = -1
    before[starts[full]] = -1
    alive = np.ones(size, bool)
    for n, word in enumerate(words):
        if lengths[n] > 1 and (whole := merges.whole.get(word)) is not None:
            a, b = starts[n], ends[n]
            symbol[a], after[a], alive[a + 1 : b] = whole, -1, False
            after[a + 1 : b] = -1
    pair = np.full(size, NONE)  # the rank of the pair that starts at a position
    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def file(at: np.ndarray) -> None:
        """Look up the pairs that start at these positions, and file those that can merge."""
        at = at[at >= 0]
        has = after[at] >= 0
        pair[at[~has]] = NONE
        at = at[has]
        found = merges.rank(symbol[at], symbol[after[at]])
        pair[at] = found
        can = found != NONE
        at, found = at[can], found[can]
        if not len(at):
            return
        if len(at) > 1:
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            groups = zip(found[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts))
        else:
            groups = [(int(found[0]), at)]
        for rank, positions in groups:
            if rank not in index:
                index[rank] = []
                heapq.heappush(waiting, rank)
            index[rank].append(positions)

    file(np.flatnonzero(alive))
    while waiting:
        rank = heapq.heappop(waiting)
        held = index.pop(rank)
        at = np.unique(np.concatenate(held)) if len(held) > 1 else np.sort(held[0])
        at = at[pair[at] == rank]
        if not len(at):
            continue
        nxt = after[at]
        if len(at) > 1 and (touch := nxt[:-1] == at[1:]).any():
            # Pairs that overlap in a run of one symbol: every other one, from the left.
            run = np.concatenate([[0], np.cumsum(~touch)])
            first = np.searchsorted(run, run, side="left")
            chosen = (np.arange(len(at)) - first) % 2 == 0
            at, nxt = at[chosen], nxt[chosen]
        far = after[nxt]
        symbol[at], after[at] = rank, far
        before[far[far >= 0]] = at[far >= 0]
        alive[nxt] = False
        pair[nxt] = NONE
        file(np.unique(np.concatenate([at, before[at]])))
    return symbol[alive], np.add.reduceat(np.append(alive, False).astype(np.int64), starts) * full if len(words) else lengths


def encode(docs: DataFrame, tokens: list[bytes], pattern: str, key: str = "doc_id", text: str = "text", decode: bool = False) -> DataFrame:
    """(key, ids array<int>) per row, with ``decode`` also ``decoded``, the bytes that the ids stand for.

    Each match of ``pattern`` is encoded by itself, without special tokens. NULL texts and empty ones have no ids,
    long texts are encoded whole. A task replays the merges over the distinct matches of a block of texts at a time.
    Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast((tokens, *pairs(tokens)))  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(*shared.value)
        words = Words(by_matches(pattern, lambda found: replay([w.encode() for w in found], merges)))
        for block in blocks(batches, "text", BLOCK_BYTES):
            found = words.ids([t or "" for t in block.column("text").to_pylist()])
            offsets = np.cumsum([0, *map(len, found)])
            columns = [block.column("key"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32()))]
            if decode:
                columns.append(pa.array([merges.decode(ids) for ids in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["key", "ids", "decoded"]
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = named.mapInArrow(run, f"key {kind}, ids array<int>" + ", decoded binary" * decode)
    return out.withColumnRenamed("key", key)
