"""Sequences of bounded length by cutting-stock column generation."""

import json
import math
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsframe.llm.common import blocks
from obsframe.llm.pretokens import Words, ranges
from obsframe.workspace import materialize

CAPACITY, SALTS = 2048, 256
# The linear program ends when no plan can need a smaller share than this of its sequences, or fewer whole ones.
GAP = 1e-3
BLOCK_BYTES = 8 << 20


# The plan: numbers only, at most one per length.

def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the largest value that fits: an unbounded knapsack by dynamic programming."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = np.searchsorted(sizes, c, side="right")
        best[c] = best[c - 1]
        if fits:
            gains = best[c - sizes[:fits]] + values[:fits]
            if gains[at := int(gains.argmax())] > best[c] + 1e-12:
                best[c], last[c] = gains[at], at
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[capacity]), pattern


def fullest(sizes: list[int], capacity: int) -> list[int]:
    """The sizes of the pattern that fills the most of ``capacity`` and holds the largest size: the knapsack in which
    each size is worth itself. What sums can be reached is one number, a bit per sum."""
    reached, room = 1, capacity - sizes[-1]
    mask = (1 << room + 1) - 1
    for size in sizes:
        if size > room:
            break
        step = size
        while step <= room:
            reached |= reached << step & mask
            step *= 2
    left, found = reached.bit_length() - 1, [sizes[-1]]
    at = bisect_right(sizes, left) - 1
    while left:
        while sizes[at] > left or not reached >> left - sizes[at] & 1:
            at -= 1
        found.append(sizes[at])
        left -= sizes[at]
    return found


def begin(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, how often each): a basis of the linear program that meets the demand.

    As long as patterns can be full, a size is worth its share of the capacity, so these values price the first
    columns. Each is used until a size is met; that size is left out of the next, so the basis is triangular."""
    basis, amount, rest = np.zeros((len(sizes), len(sizes))), np.zeros(len(sizes)), demand.astype(np.float64)
    place = {s: n for n, s in enumerate(sizes.tolist())}
    open_ = sizes.tolist()
    while open_:
        counts = Counter(fullest(open_, capacity))
        used = np.array([place[s] for s in counts])
        each = np.array(list(counts.values()), np.float64)
        ratio = rest[used] / each
        met = int(used[ratio.argmin()])
        rest[used] = np.maximum(rest[used] - ratio.min() * each, 0)
        basis[used, met], amount[met] = each, ratio.min()
        open_.pop(bisect_left(open_, int(sizes[met])))
    return basis, amount


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, how often each): the linear program of fewest sequences, by column generation.

    ``sizes`` rise, and ``demand`` has as many. From the basis of :func:`begin` on, the dual values price a new pattern
    by the knapsack; it takes the place of the one that runs out first. A pattern worth v says that no plan needs
    fewer than 1 / v of the sequences, and no plan needs fewer than the pieces fill. The search ends when that leaves
    nothing to gain: GAP, or not one whole sequence."""
    basis, amount = begin(sizes, demand, capacity)
    least = float((sizes * demand).sum()) / capacity
    inverse = None
    while True:
        total = float(amount.sum())
        if total <= (1 + GAP) * least or math.ceil(total - 1e-6) <= math.ceil(least - 1e-6):
            break
        if inverse is None:
            inverse = np.linalg.inv(basis)
        value, column = price(inverse.sum(axis=0), sizes, capacity)
        least = max(least, total / value)
        change = inverse @ column
        rises = change > 1e-9
        if value <= 1 + 1e-9 or not rises.any():
            break
        ratio = np.where(rises, amount, np.inf) / np.where(rises, change, 1)
        out = int(ratio.argmin())
        basis[:, out] = column
        pivot = inverse[out] / change[out]
        inverse -= np.outer(change, pivot)
        inverse[out] = pivot
        amount = np.maximum(inverse @ demand, 0)
    return np.rint(basis.T).astype(np.int64), amount


def first_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns for what rounding leaves: the largest first, each into the fullest sequence that has room."""
    rest, found = demand.copy(), []
    while rest.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for at in range(len(sizes) - 1, -1, -1):
            n = min(int(rest[at]), room // int(sizes[at]))
            pattern[at], room = n, room - n * int(sizes[at])
        times = int((rest[pattern > 0] // pattern[pattern > 0]).min())
        rest -= times * pattern
        found += [(pattern, times)]
    return found


def filling(here: np.ndarray, room: int, least: int, items: int) -> list[int] | None:
    """Up to so many of the sizes marked in ``here`` that together take ``least`` to ``room``, large ones first."""
    if least <= 0:
        return []
    top = min(room, len(here) - 1)
    for total in range(top, least - 1, -1):
        if here[total]:
            return [total]
    if items >= 2:
        for total in range(room, least - 1, -1):
            low, high = max(1, total - len(here) + 1), min(total, len(here))
            pairs = np.flatnonzero(here[low:high] & here[total - high + 1 : total - low + 1][::-1])
            if len(pairs):
                return [total - low - int(pairs[0]), low + int(pairs[0])]
    if items >= 3:
        for size in np.flatnonzero(here[: top + 1])[::-1].tolist():
            if more := filling(here, room - size, least - size, items - 1):
                return [size, *more]
    return None


def full_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[list[tuple[np.ndarray, int]], np.ndarray]:
    """(patterns and how often each, what is left of the demand): of the pieces that rounding leaves, those that
    together fill the capacity, and those beside which nothing fits."""
    found, rest = [], demand.copy()
    here, place = np.zeros(capacity + 1, bool), {s: n for n, s in enumerate(sizes.tolist())}
    here[sizes[rest > 0]] = True
    for size in sizes[::-1].tolist():
        copies = 1
        while here[size] and copies <= min(capacity // size, int(rest[place[size]])):
            room = capacity - copies * size
            alone = not here[: room + 1].any()
            more = [] if alone else filling(here, room, room, 3)
            if more is None:
                copies += 1
                continue
            pattern = np.zeros(len(sizes), np.int64)
            for s in [size] * copies + more:
                pattern[place[s]] += 1
            used = pattern > 0
            times = int((rest[used] // pattern[used]).min())
            if times:
                rest -= times * pattern
                found.append((pattern, times))
            short = used & (rest < pattern) if not times else used & (rest == 0)
            here[sizes[short]] = False  # what is left of one that a pattern asks for twice is filled in last
    return found, rest


def plan(histogram: dict[int, int], capacity: int = CAPACITY, unit: int = 1) -> list[tuple[int, int, int, int, int]]:
    """(bin, first rank, end rank, first sequence, sequences) for pieces binned by length, from their numbers.

    A bin holds lengths up to a multiple of ``unit``. The amounts of the linear program's patterns are rounded down;
    what that leaves, less than one sequence per pattern, is filled greedily, by full sequences first or by the largest
    pieces first, whichever takes fewer. Of bin b, the pieces of ranks first to
    end are dealt in turn to the sequences of one pattern.
    """
    counts: dict[int, int] = {}
    for length, n in histogram.items():
        counts[-(-length // unit)] = counts.get(-(-length // unit), 0) + n
    sizes = np.array(sorted(counts), np.int64)
    if not len(sizes):
        return []
    rest = np.array([counts[s] for s in sizes.tolist()], np.int64)
    chosen = []
    patterns, amount = solve(sizes, rest, capacity // unit)
    for pattern, times in zip(patterns, np.floor(amount + 1e-9).astype(np.int64).tolist()):
        used = pattern > 0
        times = min(times, int((rest[used] // pattern[used]).min()))
        if times:
            rest -= times * pattern
            chosen.append((pattern, times))
    full, left = full_patterns(sizes, rest, capacity // unit)
    fills = [full + first_fit(sizes, left, capacity // unit), first_fit(sizes, rest, capacity // unit)]
    chosen += min(fills, key=lambda found: sum(times for _, times in found))
    rows, start, ranks = [], 0, np.zeros(len(sizes), np.int64)
    for pattern, times in chosen:
        for at in np.flatnonzero(pattern).tolist():
            n = int(pattern[at]) * times
            rows.append((int(sizes[at]), int(ranks[at]), int(ranks[at]) + n, start, times))
            ranks[at] += n
        start += times
    return rows


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[int, list[tuple[int, int, int, int, int]]]:
    """(unit, plan), by exact lengths."""
    return 1, plan(histogram, capacity)


# Ids of words.

def octets(model) -> np.ndarray:
    """The bytes of each token of a byte-level tokenizer, which writes a byte as a character."""
    vocabulary = model.get_vocab()
    found = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, at in vocabulary.items():
        found[at] = len(token)
    return found


def encode_words(model, sizes: np.ndarray, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, number per word). Words with a blank in front are encoded many at a time, as a new match
    begins at each; their bytes tell which ids are whose."""
    apart = np.fromiter((w[:1] != " " for w in found), bool, len(found))
    order = np.argsort(apart, kind="stable")
    many = [found[n] for n in order[: int((~apart).sum())].tolist()]
    texts = ["".join(many[at : at + 500]) for at in range(0, len(many), 500)]
    ids = [e.ids for e in model.encode_batch_fast(texts + [found[n] for n in np.flatnonzero(apart).tolist()], add_special_tokens=False)]
    flat = np.fromiter(chain.from_iterable(ids), np.int32)
    lengths = np.empty(len(found), np.int64)
    ends = np.cumsum(pc.binary_length(pa.array(many, pa.string())).to_numpy().astype(np.int64))
    total = sum(map(len, ids[: len(texts)]))
    lengths[~apart] = np.diff(np.searchsorted(np.cumsum(sizes[flat[:total]]), ends, side="right"), prepend=0)
    lengths[apart] = np.fromiter(map(len, ids[len(texts) :]), np.int64)
    starts = np.empty(len(found), np.int64)
    starts[order] = np.cumsum(lengths[order]) - lengths[order]
    return ranges(flat, starts, starts + lengths), lengths


# Fixed value: where tokenizers that write bytes as characters begin a new match.
MATCHES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """The byte that each character stands for: visible Latin-1 characters stand for themselves, the other bytes have
    characters from 256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


def ranked(tokenizer: str) -> dict[bytes, int] | None:
    """Ids by bytes, if the tokenizer (JSON) only cuts into MATCHES and merges the pair with the smallest id first;
    else None. Such ids are found by rank, without the merges."""
    found = json.loads(tokenizer)
    model, cut_by = found["model"], found.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not found.get("normalizer") and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    if not plain or cut_by.get("type") != "ByteLevel" or cut_by.get("add_prefix_space") or not cut_by.get("use_regex", True):
        return None
    special = {t["content"] for t in found.get("added_tokens") or []}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
    ids = [model["vocab"].get(m, -1) for m in merged]
    byte = byte_characters()
    words = {t: n for t, n in model["vocab"].items() if t not in special}
    if any(a >= b for a, b in pairwise([-1, *ids])) or set(words) - set(merged) != set(byte) or max(map(words.get, byte)) > ids[0]:
        return None
    return {bytes(map(byte.__getitem__, t)): n for t, n in words.items()}


# Spark.

def cut(
    docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens) and, if asked for, ids: documents in pieces of up to ``capacity``.

    A document is its ids by the tokenizer file (JSON), without special tokens, and the id ``end``. It is cut after
    every ``capacity`` ids, so only its last piece is shorter. Ids of a tokenizer that merges by rank are found by
    rank, text by text; another one, which begins a new match at a single blank, gets each distinct word once for a
    block of texts. A NULL text is empty. ``nth`` numbers the rows; it is
    to be stored before use.
    """
    with open(tokenizer, encoding="utf-8") as file:
        model_text = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((model_text, ranked(model_text)))  # as large as the vocabulary

    def encoder():
        model, ranks = shared.value
        if ranks is not None:
            import tiktoken

            own = tiktoken.Encoding("ranked", pat_str=MATCHES, mergeable_ranks=ranks, special_tokens={})

            def by_rank(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
                found = [own.encode_ordinary(t) for t in texts]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts

            return by_rank
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(model)
        whole.encode_special_tokens = True
        sizes = octets(whole)
        return Words(lambda found: encode_words(whole, sizes, found)).of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for block in blocks(batches, "text", BLOCK_BYTES):
            found, counts = encode([t or "" for t in block.column("text").to_pylist()])
            ids = np.insert(found, np.cumsum(counts), end).astype("<u4")
            tokens = counts + 1
            pieces = -(-tokens // capacity)
            row = np.repeat(np.arange(len(counts)), pieces)
            start = capacity * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            length = np.minimum(capacity, tokens[row] - start)
            octet = 4 * (np.cumsum(length) - length)  # pieces lie one after the other, as do documents
            view = memoryview(ids.tobytes())
            check = [zlib.crc32(view[a:b]) for a, b in zip(octet.tolist(), (octet + 4 * length).tolist())]
            columns = [pa.array(c, pa.int64()) for c in (start, length, check, tokens[row])]
            if with_ids:
                ends = pa.array(np.append(0, np.cumsum(length)), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([block.column("key").take(pa.array(row)), *columns], ["key", *names[: len(columns)]])

    names = ["start", "length", "ids_crc32", "doc_tokens", "ids"]
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids
    return named.mapInArrow(run, schema).withColumn("nth", F.monotonically_increasing_id()).withColumnRenamed("key", key)


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (``length``, ``nth``).

    Only the number of pieces of each length reaches the driver, and only the plan comes back, a few rows per
    length. Pieces are ranked in their bin by the number of smaller parts and their rank within their own part, so
    no task holds a whole bin.
    """
    spark = pieces.sparkSession
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    unit, rows = best_plan(histogram, capacity)
    steps = spark.createDataFrame(rows, "bin int, first bigint, end bigint, sequence bigint, times bigint")
    binned = pieces.withColumns({"bin": F.ceil(F.col("length") / unit).cast("int"), "part": F.pmod(F.xxhash64("nth"), F.lit(SALTS)).cast("int")})
    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = binned.groupBy("bin", "part").count()  # at most bins * SALTS rows
    starts = sizes.select("bin", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("bin", "part").orderBy(F.desc("length"), "nth"))
    ranked = binned.withColumn("within", within).join(F.broadcast(starts), ["bin", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within") - 1)
    fits = (ranked["bin"] == steps["bin"]) & (ranked["rank"] >= steps["first"]) & (ranked["rank"] < steps["end"])
    sequence = F.col("sequence") + (F.col("rank") - F.col("first")) % F.col("times")
    placed = ranked.join(F.broadcast(steps), fits).select(*[ranked[c] for c in pieces.columns], sequence.alias("sequence_id"))
    filled = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "nth").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(filled), F.lit(0)))


def pack(
    docs: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY, key: str = "doc_id",
    text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece of each document; and ``ids``, if
    asked for, of which :func:`sequences` makes the sequences.

    Every id of a document is in exactly one piece, and a sequence has at most ``capacity`` ids. Repeated rows are
    packed each; a NULL key stays one; a table without rows gives none. Other columns are not looked at.
    """
    pieces = materialize(cut(docs, tokenizer, end, capacity, key, text, with_ids), "pieces")
    return assign(pieces, capacity).drop("nth")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces with their ids; a sequence is bounded by its capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row (sequences, tokens, padded): a sequence is filled up to ``capacity``, unless its length is a power of two."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    lacks = F.when(F.bit_count("used") == 1, F.lit(0)).otherwise(capacity - F.col("used"))
    return used.agg(F.count("*").alias("sequences"), F.sum("used").alias("tokens"), F.sum(lacks).alias("padded"))
