"""Language-model scores by context-tree weighting, beside those of single words."""

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.llm.common import blocks, raw_texts, text_bytes
from obsframe.workspace import materialize, new_path, run as run_folder

DEPTH = 5
# Neighbouring texts of about so many bytes, at most twice as many, are a part, which looks up each of its different
# sequences once. A longer text is a part alone.
PART_BYTES = 16 << 20
# Contexts that agree in their last bytes, so many, are weighed in one task; about so many sequences go into a group.
SUFFIX, GROUP = 3, 1 << 17
# Values are handed on to the parts beyond so many.
MOST_VALUES = 1 << 20
# A word is frequent with this share of all words, so there are at most 2**18 frequent ones; one longer than LONGEST bytes
# is never sent to the driver, but joined.
WORD_SHARE, LONGEST = 2.0**-18, 64
BLOCK_BYTES = 1 << 20
# Counted words are handed on beyond so many of them, or so many bytes.
MOST_WORDS, MOST_BYTES = 250_000, 32 << 20
END = 0x0A


def normal(text: bytes) -> list[bytes]:
    return text.lower().split()


def stream(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, number per text): words with a blank between them, and an end."""
    parts = [b" ".join(w) + b"\n" for w in words]
    return np.frombuffer(b"".join(parts), np.uint8), np.fromiter(map(len, parts), np.int64, len(parts))


def before(data: np.ndarray, lengths: np.ndarray, depth: int) -> list[np.ndarray]:
    """The byte 1, 2, ... ``depth`` places before each; ends before the start of a text."""
    starts = np.cumsum(lengths) - lengths
    out = []
    for k in range(1, depth + 1):
        b = np.empty_like(data)
        b[k:] = data[: len(data) - k] if k < len(data) else data[:0]
        b[:k] = END
        for j in range(min(k, int(lengths.max()) if len(lengths) else 0)):
            b[starts[lengths > j] + j] = END
        out.append(b)
    return out


def sequences(data: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Each byte with its context: the byte lowest, then the one before it, and so on."""
    key = data.astype(np.int64)
    for k, b in enumerate(before(data, lengths, depth), 1):
        key |= b.astype(np.int64) << 8 * k
    return key


def grams(data: np.ndarray, lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte, how often), by context and byte as a number."""
    return np.unique(sequences(data, lengths, depth), return_counts=True)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of values above zero: Stirling's series from 8 on, the recurrence below."""
    small = x < 8
    z = np.where(small, x + 8, x)
    found = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    product = np.ones_like(z)
    for k in range(8):
        product *= np.where(small, x + k, 1.0)
    return found - np.log(product)


def bit_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(zeros, ones) at each of the 255 decisions of a byte, by (rows, 256) counts; decision 1 is the highest bit, and
    2n and 2n + 1 follow decision n."""
    tree = np.zeros((len(counts), 512))
    tree[:, 256:] = counts
    for n in range(255, 0, -1):
        tree[:, n] = tree[:, 2 * n] + tree[:, 2 * n + 1]
    return tree[:, 2:512:2][:, :255], tree[:, 3:512:2][:, :255]


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)


class Tree:
    """The weighted tree of few contexts, whole in one process; :func:`weigh` does the same on Spark for any number.

    It is over symbols: the bytes that were seen, and one symbol for all others, which are equally
    likely among themselves. States below ``inner`` have children: ``step[state, symbol]`` goes one byte back. The
    others are leaves: ``bits[state - inner, symbol]`` is the log10 probability of a byte after one."""

    def __init__(self, levels: list[dict[int, np.ndarray]]):
        """``levels[d]`` has the counts of the next byte per node of ``d`` bytes of context; level 0 has the root."""
        counts, parent, level, children = [levels[0].get(0, np.zeros(256, np.int64))], [-1], [0], [[]]
        at = {(0, 0): 0}
        for d in range(1, len(levels)):
            for context in sorted(levels[d]):
                up = at.get((d - 1, context & ((1 << 8 * (d - 1)) - 1)))
                if up is not None:
                    at[d, context] = len(counts)
                    children[up].append((context >> 8 * (d - 1), len(counts)))
                    counts.append(levels[d][context])
                    parent.append(up)
                    level.append(d)
                    children.append([])
        pool = {}
        for n in range(len(counts)):
            if children[n]:  # what its nodes do not cover shares a leaf
                pool[n] = len(counts)
                counts.append(counts[n] - sum(counts[c] for _, c in children[n]))
                parent.append(n)
                level.append(level[n] + 1)
        parents, depths, size = np.array(parent), np.array(level), len(counts)
        inner = np.zeros(size, bool)
        inner[list(pool)] = True
        self.depth = int(depths.max())
        own, chance = np.empty((size, 255)), np.empty((size, 255), np.float32)
        for part in range(0, size, 4096):
            zeros, ones = bit_counts(np.array(counts[part : part + 4096]))
            own[part : part + 4096] = estimate(zeros, ones)
            chance[part : part + 4096] = (ones + 0.5) / (zeros + ones + 1)
        # Bottom up: the log of the weighted probability, and the share of a node's own estimate in it; the rest goes
        # to what lies deeper.
        below, share = np.zeros((size, 255)), np.ones((size, 255), np.float32)
        for d in range(self.depth, 0, -1):
            rows = np.flatnonzero(depths == d)
            np.add.at(below, parents[rows], own[rows])
            up = np.flatnonzero((depths == d - 1) & inner)
            share[up] = 1 / (1 + np.exp(np.clip(below[up] - own[up], -80, 80)))
            own[up] = np.logaddexp(own[up], below[up]) - math.log(2)
        del own, below
        leaves = np.flatnonzero(~inner)
        known = np.flatnonzero(counts[0])
        others = np.setdiff1d(np.arange(256), known)
        self.symbol = np.full(256, len(known), np.int32)
        self.symbol[known] = np.arange(len(known))
        self.bits = np.zeros((len(leaves), len(known) + 1), np.float32)
        for part in range(0, len(leaves), 4096):
            some = leaves[part : part + 4096]
            value, up = chance[some].astype(np.float64), parents[some]
            while (open_ := np.flatnonzero(up >= 0)).size:
                node = up[open_]
                value[open_] = share[node] * chance[node] + (1 - share[node]) * value[open_]
                up[open_] = parents[node]
            p = np.stack([1 - value, value], axis=2)
            logs = sum(np.log10(p[:, node, bit]) for node, bit in self.paths())
            self.bits[part : part + 4096, :-1] = logs[:, known]
            if len(others):
                self.bits[part : part + 4096, -1] = np.log10((10.0 ** logs[:, others]).mean(axis=1))
        # States: inner nodes first.
        self.inner = int(inner.sum())
        state = np.empty(size, np.int32)
        state[inner], state[leaves] = np.arange(self.inner), self.inner + np.arange(len(leaves))
        self.step = np.empty((self.inner, len(known) + 1), np.int32)
        for n, rest in pool.items():
            self.step[state[n]] = state[rest]
            for byte, c in children[n]:
                self.step[state[n], self.symbol[byte]] = state[c]

    def parts(self) -> tuple:
        """What scoring takes, as plain arrays."""
        return self.symbol, self.step, self.bits, self.inner, self.depth

    @staticmethod
    def paths() -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of the eight decisions: where it stands and what is decided, per byte."""
        byte = np.arange(256)
        return [(((256 + byte) >> 8 - k) - 1, byte >> 7 - k & 1) for k in range(8)]


def log_probabilities(data: np.ndarray, lengths: np.ndarray, tree: tuple) -> np.ndarray:
    """log10 of the probability of each text, by the parts of a tree."""
    symbol, step, bits, inner, depth = tree
    width = bits.shape[1]
    state = np.zeros(len(data), np.int32)
    going = np.arange(len(data) if inner else 0)
    flat = step.ravel()
    for b in before(data, lengths, depth):
        state[going] = flat[state[going] * width + symbol[b[going]]]
        going = going[state[going] < inner]
    logs = bits.ravel()[(state - inner) * width + symbol[data]]
    return np.add.reduceat(logs, np.cumsum(lengths) - lengths, dtype=np.float64) if len(lengths) else np.empty(0)


def packed(rows: pa.RecordBatch) -> bytes:
    """The rows as they travel: compressed, so that texts and their values take up little disk in a shuffle."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unpacked(column: pa.ChunkedArray | pa.Array) -> Iterator[pa.RecordBatch]:
    for value in column:
        yield from pa.ipc.open_stream(value.as_buffer())


def pack(part: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([packed(rows)], pa.binary())], ["part", "rows"])


def in_parts(texts: DataFrame, size: int) -> DataFrame:
    """(part, rows): the rows of ``texts`` (``text``) in packed blocks, with a row number ``nth`` and the number of their
    part: the ``nth`` of its first text. Small partitions are read together, by the ``size`` of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, 0
        for block in blocks(batches, "text", BLOCK_BYTES):
            size = sum(text_bytes(block.column("text")))
            if part is None or held + size > 2 * PART_BYTES:
                part, held = block.column("nth")[0].as_py(), 0
            held += size
            yield pack(part, block)

    together = texts.coalesce(max(1, math.ceil(size / PART_BYTES)))
    return together.withColumn("nth", F.monotonically_increasing_id()).mapInArrow(run, "part bigint, rows binary")


def count_sequences(parts: DataFrame, depth: int) -> DataFrame:
    """(part, gram, n): how often each sequence comes in the texts to learn from (``learns``) of a part; those of other
    texts only are there with 0. A part that several tasks read has rows from each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for number, block in zip(batch.column("part").to_pylist(), unpacked(batch.column("rows"))):
                if held and number != part:
                    yield from out(part, held)
                    held = []
                part = number
                split = [normal(t) for t in raw_texts(block.column("text"))]
                for learned in (True, False):
                    chosen = [w for w, learns in zip(split, block.column("learns").to_pylist()) if learns == learned]
                    if chosen:
                        keys, counts = grams(*stream(chosen), depth)
                        held.append((keys, counts if learned else np.zeros_like(counts)))
                if len(held) >= 8:
                    held = [merged(held)]
        if held:
            yield from out(part, held)

    def out(part: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, counts = merged(held)
        for at in range(0, len(keys), 1 << 17):
            some = keys[at : at + (1 << 17)]
            columns = [np.full(len(some), part), some, counts[at : at + (1 << 17)]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "gram", "n"])

    return parts.mapInArrow(run, "part bigint, gram bigint, n bigint")


def by_part(values: DataFrame) -> DataFrame:
    """(part, rows): (gram, value) of ``values`` in packed blocks of one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= MOST_VALUES:
                yield from out(held)
                held, size = [], 0
        if held:
            yield from out(held)

    def out(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        order = np.lexsort((table.column("gram").to_numpy(), table.column("part").to_numpy()))
        rows = table.take(pa.array(order)).combine_chunks()
        parts = rows.column("part").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for start, end in zip(edges, edges[1:]):
            for some in rows.select(["gram", "value"]).slice(start, end - start).to_batches():
                yield pack(int(parts[start]), some)

    return values.select("part", "gram", "value").mapInArrow(run, "part bigint, rows binary")


@F.arrow_udf(T.DoubleType())
def own_estimate(zeros: pa.Array, ones: pa.Array) -> pa.Array:
    return pa.array(estimate(zeros.to_numpy().astype(np.float64), ones.to_numpy().astype(np.float64)))


def above(d: int) -> int:
    """The bits of a node that its node at depth ``d - 1`` has too."""
    return (1 << 8 * d) - 1


def decisions(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, bit) of the eight decisions of each sequence, (8, rows). A node is a context and one of the 255 decisions
    of a byte, as in :func:`bit_counts`: the number of the decision is lowest, then comes the context."""
    byte, k = grams & 255, np.arange(8)[:, None]
    return grams - byte + (byte + 256 >> 8 - k), byte >> 7 - k & 1


def climb(grams: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[np.ndarray, list[tuple], np.ndarray]:
    """(place of each decision among the deepest nodes; per depth, deepest first, the nodes, their zeros and ones, the
    share of the own estimate, and the place of the node above; log of the weighted probability at depth ``top``)."""
    nodes, bits = decisions(grams)
    keys, place = np.unique(nodes, return_inverse=True)
    place, times = place.reshape(nodes.shape), np.broadcast_to(n, nodes.shape)
    zeros, ones = (np.bincount(place.ravel(), (times * (bits == bit)).ravel(), len(keys)) for bit in (0, 1))
    weighted, share, levels = estimate(zeros, ones), np.ones(len(keys)), []
    for d in range(depth, top, -1):
        upper, up = np.unique(keys & above(d), return_inverse=True)
        levels.append((keys, zeros, ones, share, up))
        zeros, ones, below = (np.bincount(up, x, len(upper)) for x in (zeros, ones, weighted))
        own, keys = estimate(zeros, ones), upper
        weighted = np.logaddexp(own, below) - math.log(2)
        share = 1 / (1 + np.exp(np.clip(below - own, -80, 80)))
    return place, [*levels, (keys, zeros, ones, share, None)], weighted


def weigh(sums: DataFrame, depth: int) -> DataFrame:
    """(gram, value) per row of ``sums`` (gram, n): log10 of the probability of its byte after its context, by the
    weighted tree of all contexts with ``n`` above 0.

    Going up, nodes add up what lies below them; going down, they share out the weight that is left. Tasks do so for
    groups of contexts that agree in their last SUFFIX bytes, sums and joins by node do it above them. What was not
    learned has no counts, so halves everywhere.
    """
    top = min(SUFFIX, depth)
    groups = max(1, math.ceil(sums.count() / GROUP))

    def grouped(rows: DataFrame, column: str) -> DataFrame:
        suffix = F.shiftright(column, 8).bitwiseAND(F.lit(above(top)))
        return rows.withColumn("group", F.pmod(F.xxhash64(suffix), F.lit(groups))).groupBy("group")

    def rise(rows: pa.Table) -> pa.Table:
        _, levels, weighted = climb(rows.column("gram").to_numpy(), rows.column("n").to_numpy(), depth, top)
        return pa.table(dict(zip(("node", "zeros", "ones", "share", "weighted"), (*levels[-1][:4], weighted))))

    def descend(rows: pa.Table, mixed: pa.Table) -> pa.Table:
        grams = rows.column("gram").to_numpy()
        place, levels, _ = climb(grams, rows.column("n").to_numpy(), depth, top)
        mixed = mixed.sort_by("node")  # the nodes of the highest level here
        one, rest = mixed.column("one").to_numpy(), mixed.column("rest").to_numpy()
        for _, zeros, ones, share, up in levels[-2::-1]:
            one, rest = one[up] + rest[up] * share * (ones + 0.5) / (zeros + ones + 1), rest[up] * (1 - share)
        _, bits = decisions(grams)
        p = one[place]
        return pa.table({"gram": grams, "value": np.log10(np.where(bits, p, 1 - p)).sum(axis=0).astype(np.float32)})

    level = grouped(sums, "gram").applyInArrow(rise, "node bigint, zeros double, ones double, share double, weighted double")
    levels = [materialize(level, "nodes")]
    for d in range(top, 0, -1):
        node = F.col("node").bitwiseAND(F.lit(above(d)))
        level = levels[-1].groupBy(node.alias("node")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
        level = level.withColumn("own", own_estimate("zeros", "ones"))
        weighted = F.greatest("own", "below") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("below")))) - math.log(2)
        share = 1 / (1 + F.exp(F.col("below") - F.col("own")))
        levels.append(materialize(level.select("node", "zeros", "ones", weighted.alias("weighted"), share.alias("share")), "nodes"))
    # Of a 1, by the nodes so far; the rest is for those below.
    chance = F.col("share") * (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    mixed = levels.pop().select("node", chance.alias("one"), (1 - F.col("share")).alias("rest"))
    for d in range(1, top + 1):
        upper = mixed.select(F.col("node").alias("up"), "one", "rest")
        mixed = levels.pop().withColumn("up", F.col("node").bitwiseAND(F.lit(above(d)))).join(upper, "up").select(
            "node", (F.col("one") + F.col("rest") * chance).alias("one"), (F.col("rest") * (1 - F.col("share"))).alias("rest"),
        )
    return grouped(sums, "gram").cogroup(grouped(mixed, "node")).applyInArrow(descend, "gram bigint, value float")


def look_up(keys: np.ndarray, grams: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each key, by ascending ``grams`` that hold all of them."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    found = np.empty(len(keys))
    found[order] = values[np.searchsorted(grams, ranked[new])][np.cumsum(new) - 1]
    return found


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n, learned): of all words how often they come, and how often in texts to learn from (``learns``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, others, known, held = Counter(), Counter(), 0, 0
        for block in blocks(batches, "text", BLOCK_BYTES):
            texts = raw_texts(block.column("text"))
            for text, learns in zip(texts, block.column("learns").to_pylist()):
                (some if learns else others).update(normal(text))
            # New words of a block take up no more than its bytes.
            held += sum(map(len, texts)) if len(some) + len(others) > known else 0
            known = len(some) + len(others)
            if known > MOST_WORDS or held > MOST_BYTES and sum(map(len, chain(some, others))) > MOST_BYTES:
                yield from out(some, others)
                some, others, known, held = Counter(), Counter(), 0, 0
        yield from out(some, others)

    def out(some: Counter, others: Counter) -> Iterator[pa.RecordBatch]:
        for counts, learned in ((some, True), (others, False)):
            times = pa.array(counts.values(), pa.int64())
            zeros = pa.array(np.zeros(len(counts), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), times, times if learned else zeros], ["word", "n", "learned"])

    parts = texts.select("text", "learns").mapInArrow(run, "word binary, n bigint, learned bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("learned").alias("learned"))


def score(
    docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, code_bits) per row of ``docs``.

    Tokens are the lower-cased (A-Z) words and an end. ``base_score`` adds log10((c + 1) / (N + V + 1)) per token, by
    the tokens of the rows where ``learns`` holds. ``score`` is the log10 probability, by the context tree of those
    rows, of the words with single blanks between them and an end; ``code_bits`` is its code length per byte.

    Every context of up to ``depth`` bytes (at most 7) that was learned is a node of the tree, however rare. Sequences
    are counted by part, weighed on Spark, and each part gets the values of its own ones; no table of them is held whole.

    A NULL or empty text is an end only, long texts are scored whole, repeated rows each, a NULL key stays one. With
    nothing to learn from all bytes are alike. Other columns are not looked at.

    Frequent words of up to LONGEST bytes, at most 2**18, are looked up in the task; all others are joined with their
    counts. A long word that is frequent may be a hot key there; it comes once per text, and adaptive execution splits it.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    spark = docs.sparkSession
    words = materialize(count_words(rows), "word-counts")
    learned, everything, distinct, size = words.agg(
        F.sum("learned"), F.sum("n"), F.count_if(F.col("learned") > 0), F.sum(F.col("n") * (F.octet_length("word") + 1)),
    ).first()
    ends, number = rows.agg(F.count_if("learns"), F.count("*")).first()
    tokens, kinds = (learned or 0) + ends, distinct + (ends > 0)
    short = F.octet_length("word") <= LONGEST
    frequent = words.where((F.col("n") >= (everything or 0) * WORD_SHARE) & short).select("word", "learned").toArrow()
    table = {w: math.log10(c + 1) for w, c in zip(frequent.column("word").to_pylist(), frequent.column("learned").to_pylist())}
    shared = spark.sparkContext.broadcast(table)

    def run(texts: pa.Table, values: pa.Table) -> pa.Table:
        known = pa.Table.from_batches(unpacked(values.column("rows"))).sort_by("gram")
        grams, chances = known.column("gram").to_numpy(), known.column("value").to_numpy()
        return pa.Table.from_batches(scored(unpacked(texts.column("rows")), grams, chances))

    def scored(batches: Iterator[pa.RecordBatch], known: np.ndarray, chances: np.ndarray) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for block in batches:
            split = [normal(t) for t in raw_texts(block.column("text"))]
            data, lengths = stream(split)
            each = look_up(sequences(data, lengths, depth), known, chances)
            values = np.add.reduceat(each, np.cumsum(lengths) - lengths)
            sums, seen, rare, times, offsets = [], [], [], [], [0]
            for found in split:
                counts = Counter(found)
                total = known_here = 0
                for w, n in counts.items():
                    value = logs.get(w)
                    if value is None:
                        rare.append(w)
                        times.append(n)
                    elif value:
                        total += n * value
                        known_here += n
                sums.append(float(total))
                seen.append(known_here)
                offsets.append(len(rare))
            items = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays([
                block.column("key"), block.column("nth"), pa.array([len(w) + 1 for w in split], pa.int64()),
                pa.array(seen, pa.int64()), pa.array(sums), pa.array(values), pa.array(lengths),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items),
            ], ["key", "nth", "n_tokens", "seen", "sums", "score", "bytes", "rare"])

    kind = docs.schema[key].dataType.simpleString()
    path = new_path(spark, "scores")
    with run_folder(spark):  # all tables but the scores go at its end
        texts = materialize(in_parts(rows, (size or 0) + number), "texts")
        counted = materialize(count_sequences(texts, depth), "grams")
        sums = materialize(counted.groupBy("gram").agg(F.sum("n").alias("n")), "sums")
        values = materialize(weigh(sums, depth), "values")
        values = by_part(counted.select("part", "gram").join(values.hint("shuffle_hash"), "gram"))
        found = texts.groupBy("part").cogroup(values.groupBy("part")).applyInArrow(
            run, f"key {kind}, nth bigint, n_tokens bigint, seen bigint, sums double, score double, bytes bigint, rare array<struct<word:binary,n:bigint>>"
        )
        found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    rest = found.select("nth", F.inline("rare")).join(words.where(F.col("learned") > 0).select("word", "learned"), "word")
    rest = rest.groupBy("nth").agg(
        F.sum("n").alias("more_seen"), F.sum(F.col("n") * F.log10(F.col("learned") + 1)).alias("more"),
    )
    joined = found.drop("rare").join(rest, "nth", "left")
    base = F.col("sums") + F.coalesce("more", F.lit(0.0)) + math.log10(ends + 1) - F.col("n_tokens") * math.log10(tokens + kinds + 1)
    return joined.select(
        F.col("key").alias(key), "n_tokens",
        (F.col("seen") + F.coalesce("more_seen", F.lit(0)) + (1 if ends else 0)).cast("bigint").alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score",
        (-F.col("score") / (F.col("bytes") * math.log10(2))).alias("code_bits"),
    )

