"""Periodic runs of words, found by recompression: a run-length grammar tells how far two places of a text agree."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from obsframe.llm.common import blocks, raw_texts, schema_with

BLOCK_BYTES = 3 << 20
# Candidates that are extended together.
CHUNK = 1 << 18
# A run holds its period so often at least, and so many words.
TURNS, SHORTEST = 4, 6
RUN = "struct<start: bigint, length: bigint, period: bigint>"


class Grammar:
    """Levels over a sequence of symbols, in turn by blocks and by pairs.

    A block level gives each stretch of one symbol a symbol of its own by (symbol, length); a pair level does so for
    each pair of a symbol of one side and one of the other, sides being dealt by hash. Negative symbols are ends: each
    occurs once and is never paired. Nodes of all levels lie one after the other; equal symbols of a level stand for
    equal stretches, and a stretch is cut alike wherever it occurs but for its margins.
    """

    def __init__(self, sequence: np.ndarray) -> None:
        symbols, firsts, parents, blocky = [sequence.astype(np.int64)], [np.arange(len(sequence))], [], []
        base, fresh, blocked = 0, int(sequence.max(initial=0)) + 1, True
        while True:
            now = symbols[-1]
            paired = (now[:-1] >= 0) & (now[1:] >= 0)
            if not paired.any():
                break
            if blocked:
                heads = np.concatenate([[True], now[1:] != now[:-1]])
            else:
                heads = np.concatenate([[True], ~_pairs(now, paired, len(symbols))])
            at = np.flatnonzero(heads)
            width = np.diff(np.append(at, len(now)))
            upper, wide = now[at], np.flatnonzero(width > 1)
            if len(wide):
                second = width[wide] if blocked else now[at[wide] + 1]
                _, named = np.unique(upper[wide] * (int(second.max()) + 1) + second, return_inverse=True)
                upper[wide] = fresh + named
                fresh += int(named.max()) + 1
            parents.append(np.cumsum(heads) - 1 + base + len(now))
            blocky.append(np.full(len(now), blocked))
            firsts.append(at + base)
            symbols.append(upper)
            base += len(now)
            blocked = not blocked
        parents.append(np.full(len(symbols[-1]), -1))
        blocky.append(np.zeros(len(symbols[-1]), bool))
        self.words = len(sequence)
        self.symbols, self.blocky = np.concatenate(symbols), np.concatenate(blocky)
        self.parents, self.firsts = np.concatenate(parents), np.append(np.concatenate(firsts), 0)

    def agree(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from places ``a`` and ``b`` (unequal) on, to the right (step 1) or left (step -1).

        Every query climbs while both nodes begin their parents, walks over equal ones, and after the first unequal
        ones goes down to the words."""
        out = np.zeros(len(a), np.int64)
        query, i, j, climbs = np.arange(len(a)), a.copy(), b.copy(), np.ones(len(a), bool)
        while len(query):
            same = self.symbols[i] == self.symbols[j]
            climbs &= same
            p, r = self.parents[i], self.parents[j]
            if step > 0:
                left_i, left_j = self.firsts[p + 1] - i, self.firsts[r + 1] - j
                edge = (self.firsts[p] == i) & (self.firsts[r] == j)
            else:
                left_i, left_j = i - self.firsts[p] + 1, j - self.firsts[r] + 1
                edge = (self.firsts[p + 1] - 1 == i) & (self.firsts[r + 1] - 1 == j)
            up = climbs & edge & (p >= 0) & (r >= 0)
            on = same & ~up
            far = np.where(self.blocky[i] & on, np.minimum(left_i, left_j), 1) * step
            ended = ~same & (i < self.words)
            if ended.any():
                out[query[ended]] = (i[ended] - a[query[ended]]) * step
            down = ~same
            low_i, low_j = (self.firsts[i], self.firsts[j]) if step > 0 else (self.firsts[i + 1] - 1, self.firsts[j + 1] - 1)
            i = np.where(up, p, np.where(down, low_i, i + far))
            j = np.where(up, r, np.where(down, low_j, j + far))
            if ended.any():
                stay = ~ended
                query, i, j, climbs = query[stay], i[stay], j[stay], climbs[stay]
        return out


def _pairs(now: np.ndarray, paired: np.ndarray, level: int) -> np.ndarray:
    """Whether each symbol but the first is joined to the one before it; of the two ways of dealing sides, the one
    that joins more."""
    odd = np.uint64(0x9E3779B97F4A7C15) + np.uint64(2 * level)
    side = ((now.astype(np.uint64) + np.uint64(level)) * odd >> np.uint64(40)).astype(np.int64)
    side = (side ^ side >> 7 ^ side >> 13) & 1 == 1
    one, other = paired & side[:-1] & ~side[1:], paired & ~side[:-1] & side[1:]
    return one if np.count_nonzero(one) >= np.count_nonzero(other) else other


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (start, length, period) of all runs of each text (of word numbers >= 0), by start and then period.

    A run keeps its smallest period over at least TURNS periods and SHORTEST words, and no neighbour extends it. It
    holds at least TURNS multiples of its period, so equal words at so many of them, in any grid, are its candidates.
    """
    order = np.argsort([-len(t) for t in texts], kind="stable")
    lengths = np.array([len(texts[k]) for k in order], np.int64)
    ends = np.cumsum(lengths + 1) + 1
    starts = ends - lengths - 1
    size = int(ends[-1]) if len(ends) else 1
    line = np.full(size, -1, np.int64)
    for at, k in zip(starts, order):
        line[at : at + len(texts[k])] = texts[k]
    line[line < 0] = -1 - np.arange(np.count_nonzero(line < 0))
    small = line.astype(np.int32) if abs(line).max() < 2**31 else line
    found, known = [], _Known(size)
    pending: list[tuple[np.ndarray, int]] = []
    waiting, docs, period = 0, len(lengths), 0
    while True:
        period += 1
        while docs and lengths[docs - 1] < max(SHORTEST, TURNS * period):
            docs -= 1
        if docs:
            grid = small[: int(ends[docs - 1]) : period]
            alike = grid[1:] == grid[:-1]
            hits = alike[: len(alike) - TURNS + 2].copy()
            for n in range(1, TURNS - 1):
                hits &= alike[n : n + len(hits)]
            at = np.flatnonzero(hits) * period
            if len(at):
                pending.append((at, period))
                waiting += len(at)
        if waiting > CHUNK or pending and not docs:
            runs = _extend(line, starts, ends, known, pending)
            known.add(runs)
            found.append(runs)
            pending, waiting = [], 0
        if not docs:
            break
    out = [np.empty((0, 3), np.int64)] * len(texts)
    if not found:
        return out
    runs = np.unique(np.concatenate(found), axis=0)  # by start, end and period
    first = np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]) if len(runs) else np.empty(0, bool)
    runs = runs[first]
    home = np.searchsorted(starts, runs[:, 0], side="right") - 1
    for k in np.unique(home):
        own = runs[home == k]
        rows = np.stack([own[:, 0] - starts[k], own[:, 1] - own[:, 0], own[:, 2]], axis=1)
        out[order[k]] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return out


class _Known:
    """Of the longest run known at each place its period and end, so that multiples of the period need no extension:
    a stretch whose period is a multiple and that holds two such multiples of a run is that run."""

    def __init__(self, size: int) -> None:
        self.size, self.period = size, None

    def add(self, runs: np.ndarray) -> None:
        if self.period is None:
            self.period, self.end = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        for start, end, period in runs[np.argsort(runs[:, 1] - runs[:, 0], kind="stable")].tolist():
            self.period[start:end], self.end[start:end] = period, end

    def new(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        if self.period is None:
            return np.ones(len(at), bool)
        own = self.period[at]
        return (own == 0) | (period % np.maximum(own, 1) != 0) | (at + (TURNS - 1) * period >= self.end[at])


def _extend(line: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: _Known, pending: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """(start, end, period) of the candidates that are long enough, by a grammar of the texts that have any."""
    at = np.concatenate([p for p, _ in pending])
    period = np.repeat([q for _, q in pending], [len(p) for p, _ in pending])
    home = np.searchsorted(starts, at, side="right") - 1
    new = known.new(at, period) & (at + (TURNS - 1) * period < ends[home] - 1)  # a grid runs on from text to text
    at, period, home = at[new], period[new], home[new]
    if not len(at):
        return np.empty((0, 3), np.int64)
    used, home = np.unique(home, return_inverse=True)
    sizes = ends[used] - starts[used]  # with the end behind each text
    moved = np.concatenate([[1], np.cumsum(sizes) + 1])[:-1]
    parts = np.concatenate([[0], *[np.arange(starts[k], ends[k]) for k in used]])
    grammar = Grammar(line[parts])
    shift = (starts[used] - moved)[home]
    own = at - shift
    right = grammar.agree(own, own + period, 1)
    left = grammar.agree(own - 1, own + period - 1, -1)
    runs = np.stack([at - left, at + period + right, period], axis=1)
    length = runs[:, 1] - runs[:, 0]
    return np.unique(runs[(length >= TURNS * period) & (length >= SHORTEST)], axis=0)


def best_run(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, exactly; of equal ones the first by start, then period."""
    best = None
    for run in runs.tolist():
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best and tuple(best)


def collapse_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", edit: Callable[[int | None, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """(key, runs, longest, collapsed) of every row of ``docs``: all periodic runs of the words of its whole text, the
    one with the most turns, and the text with every run cut to its first period, words joined by one blank.

    Words are what ASCII blanks (space, tab to carriage return) separate, compared as bytes. ``edit`` (key, number of
    words) may give word numbers to read in place of the text as it stands. A NULL text, and one without words, has no
    runs and collapses to an empty one; rows that repeat each get their row. Other columns are not looked at. Texts
    are independent: nothing is shuffled, a block of texts is searched at once, and a long text is a block alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, BLOCK_BYTES):
            yield _collapse(block, key, text, edit, schema)

    rows = docs.select(key, text)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("runs", pa.list_(run_type)), ("longest", run_type), ("collapsed", pa.string())])
    out = schema_with(rows.select(key), {"runs": f"array<{RUN}>", "longest": RUN, "collapsed": "string"})
    return rows.mapInArrow(run, out)


def _collapse(
    block: pa.RecordBatch, key: str, text: str, edit: Callable[[int | None, int], np.ndarray | None] | None, schema: pa.Schema,
) -> pa.RecordBatch:
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    words, texts = [], []
    for own, raw in zip(block.column(key).to_pylist(), raw_texts(block.column(text))):
        split = raw.split()  # of bytes: at the blanks of ASCII
        picked = edit(own, len(split)) if edit else None
        if picked is not None:
            split = [split[k] for k in picked.tolist()]
        words.append(split)
        texts.append(np.fromiter((number(w, len(numbers)) for w in split), np.int64, len(split)))
    runs, longest, collapsed = [], [], []
    for split, own in zip(words, find_runs(texts)):
        best = best_run(own)
        longest.append(best and dict(zip(("start", "length", "period"), best)))
        runs.append([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()])
        if best:
            kept = np.ones(len(split), bool)
            for start, length, period in own.tolist():
                kept[start + period : start + length] = False
            split = [split[k] for k in np.flatnonzero(kept).tolist()]
        collapsed.append(b" ".join(split))
    new = [
        pa.array(runs, schema.field("runs").type), pa.array(longest, schema.field("longest").type),
        pa.array(collapsed, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays([block.column(key), *new], names=[key, *schema.names])
