"""Toxicity by a bidirectional gated recurrent network with attention pooling, over words and their characters."""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import blocks, sample_texts, schema_with
from obsframe.llm.language import letter_table
from obsframe.llm.pretokens import ranges

# The network learns from a bounded sample: per label so many texts and bytes at most; every third one calibrates.
SAMPLE_ROWS, SAMPLE_BYTES, CALIBRATE = 3_000, 3 << 20, 3
# A passage of up to WINDOW - STRIDE + 1 = 20 words is whole in one window at least, wherever it stands.
WINDOW, STRIDE = 32, 13
TABLE_BITS, PRIOR, INPUTS, HIDDEN = 17, 5.0, 6, 6
EPOCHS, LEAST_STEPS, BATCH, RATE, SEED = 4, 600, 512, 0.02, 7
MOST_WORDS = 150_000
BLOCK_BYTES = 1 << 20
THRESHOLD = 0.3
ODD = np.uint64(0x9E3779B97F4A7C15)
PLACES = ODD ** np.arange(1, 65, dtype=np.uint64)  # of a character in a word, modulo 2**64


def characters(words: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(characters of all words, number per word): letters in lower case between a mark at either end."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = table[np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.int32)]
    keep = codes != 32
    counts = np.bincount(np.repeat(np.arange(len(words)), lengths)[keep], minlength=len(words))
    ends = np.cumsum(counts)
    kept = np.insert(codes[keep], np.concatenate([ends - counts, ends]), np.repeat([1, 2], len(words)))
    # Where a word is empty its marks, and those of its neighbours, are inserted at one place.
    order = np.argsort(np.insert(np.repeat(np.arange(len(words)), counts), np.concatenate([ends - counts, ends]), np.tile(np.arange(len(words)), 2)), kind="stable")
    return kept[order].astype(np.uint64), counts + 2


def rows_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * ODD) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def sequences(words: list[str], table: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per kind of sequence the table rows of all words, one after the other, and their number per word: the word
    itself, what it begins with (two to eight letters), and its runs of three characters. Each has one at least."""
    chars, counts = characters(words, table)
    starts = np.cumsum(counts) - counts
    place = np.arange(len(chars)) - np.repeat(starts, counts)
    sums = np.cumsum(chars * PLACES[place % 64])
    before = np.concatenate([np.zeros(1, np.uint64), sums])[starts]
    upto = sums - np.repeat(before, counts)
    beginning = (place >= 2) & (place <= 8) | (place == 1)
    three = chars[:-2] * PLACES[2] + chars[1:-1] * PLACES[1] + chars[2:] * PLACES[0] if len(chars) > 2 else chars[:0]
    within = np.flatnonzero(place < np.repeat(np.maximum(counts - 2, 0), counts))
    alone = np.maximum(counts - 2, 1)  # a word without letters has its two marks for a run
    runs = np.zeros(int(alone.sum()), np.uint64)
    full = np.repeat(counts > 2, alone)
    runs[full] = three[within]
    return {
        "word": (rows_of(upto[starts + counts - 1]), np.ones(len(words), np.int64)),
        "begin": (rows_of(upto[beginning]), np.add.reduceat(beginning, starts).astype(np.int64)),
        "three": (rows_of(runs), alone),
    }


class Vocabulary:
    """Numbers of the distinct words of some texts; number 0 fills short windows."""

    def __init__(self):
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[""]

    def words(self, start: int = 0) -> list[str]:
        return list(self.number)[start:]

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(windows of word numbers, windows per text): one every STRIDE words of every text, the last one filled up.
        A text without words has none."""
        found = [np.fromiter(map(self.number.__getitem__, t.lower().split()), np.int32) for t in texts]
        counts = [max(1, -(-(len(w) - WINDOW) // STRIDE) + 1) if len(w) else 0 for w in found]
        rows = np.zeros((sum(counts), WINDOW), np.int32)
        at = 0
        for words, n in zip(found, counts):
            if n:
                padded = np.zeros((n - 1) * STRIDE + WINDOW, np.int32)
                padded[: len(words)] = words
                rows[at : at + n] = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]
                at += n
        return rows, np.array(counts, np.int64)


def inputs(tables: dict[str, np.ndarray], kinds: dict[str, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The vector of each word: the log odds of itself, of its beginnings and of its runs of characters."""
    word = tables["word"][kinds["word"][0]]
    out = [word, np.ones_like(word)]
    for kind in ("begin", "three"):
        rows, counts = kinds[kind]
        values, starts = tables[kind][rows], np.cumsum(counts) - counts
        out += [np.maximum.reduceat(values, starts), np.add.reduceat(values, starts) / counts]
    return np.stack(out, axis=1).astype(np.float32)


def gate(x: np.ndarray) -> np.ndarray:
    """A piecewise linear sigmoid."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def bend(x: np.ndarray) -> np.ndarray:
    """Softsign, in place of tanh."""
    return x / (1 + np.abs(x))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def run_gru(x: np.ndarray, windows: np.ndarray, u: np.ndarray, steps: range, trace: list | None = None) -> np.ndarray:
    """States (time, window, hidden) by the projected input of each word number; where there is no word a state stays."""
    states = np.empty((WINDOW, len(windows), HIDDEN), np.float32)
    h = np.zeros((len(windows), HIDDEN), np.float32)
    for t in steps:
        word = windows[:, t]
        given, back = x[word], h @ u
        zr = gate(given[:, : 2 * HIDDEN] + back[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = bend(given[:, 2 * HIDDEN :] + r * back[:, 2 * HIDDEN :])
        new = c + z * (h - c)
        if not word.all():
            new = np.where(word[:, None] > 0, new, h)
        if trace is not None:
            trace.append((t, h, z, r, c, back[:, 2 * HIDDEN :]))
        h = states[t] = new
    return states


def backward_gru(trace: list, d_states: np.ndarray, mask: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gradient of the projected inputs, gradient of ``u``)."""
    d_gates = np.zeros((len(mask), WINDOW, 3 * HIDDEN), np.float32)
    d_u, d_h = np.zeros_like(u), np.zeros((len(mask), HIDDEN), np.float32)
    for t, h, z, r, c, back in reversed(trace):
        d = d_states[t] + d_h
        here = mask[:, t, None]
        d_new = np.where(here, d, 0)
        d_c = d_new * (1 - z) * (1 - np.abs(c)) ** 2
        d_z = d_new * (h - c) * 0.25 * ((z > 0) & (z < 1))
        d_r = d_c * back * 0.25 * ((r > 0) & (r < 1))
        d_gates[:, t] = np.concatenate([d_z, d_r, d_c], axis=1)
        d_back = np.concatenate([d_z, d_r, d_c * r], axis=1)
        d_u += h.T @ d_back
        d_h = d_back @ u.T + np.where(here, d * z, d)
    return d_gates, d_u


def both(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inputs projected for either direction."""
    return x @ p["w_left"] + p["b_left"], x @ p["w_right"] + p["b_right"]


def gradients(p: dict[str, np.ndarray], x: np.ndarray, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted cross-entropy of a batch; ``x`` has the inputs of the words it numbers."""
    mask, lefts, rights = windows > 0, [], []
    left, right = both(p, x)
    left = run_gru(left, windows, p["u_left"], range(WINDOW), lefts)
    right = run_gru(right, windows, p["u_right"], range(WINDOW - 1, -1, -1), rights)
    states = np.concatenate([left, right], axis=2)
    logit, weight, pooled = attend(p, states, mask)
    d_logit = ((sigmoid(logit) - labels) * weights / weights.sum()).astype(np.float32)
    g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["out"]
    d_weight = np.einsum("bh,tbh->tb", d_pooled, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["attend"] = np.einsum("tb,tbh->h", d_score, states)
    d_states = weight[:, :, None] * d_pooled + d_score[:, :, None] * p["attend"]
    for side, trace, part in (("left", lefts, slice(0, HIDDEN)), ("right", rights, slice(HIDDEN, None))):
        d_gates, g[f"u_{side}"] = backward_gru(trace, d_states[:, :, part], mask, p[f"u_{side}"])
        flat = d_gates[mask]
        g[f"w_{side}"], g[f"b_{side}"] = x[windows[mask]].T @ flat, flat.sum(axis=0)
    return g


def attend(p: dict[str, np.ndarray], states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logit, attention over time, pooled state) per window."""
    scores = np.where(mask.T, states @ p["attend"], -np.inf)
    weight = np.exp(scores - scores.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", weight, states)
    return pooled @ p["out"] + p["bias"], weight, pooled


def logits(p: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Per window, with the projected input of each word number for either direction."""
    out = np.empty(len(windows), np.float32)
    for at in range(0, len(windows), 1024):
        some = windows[at : at + 1024]
        states = np.concatenate([
            run_gru(left, some, p["u_left"], range(WINDOW)), run_gru(right, some, p["u_right"], range(WINDOW - 1, -1, -1)),
        ], axis=2)
        out[at : at + 1024] = attend(p, states, some > 0)[0]
    return out


def log_odds(rows: np.ndarray, hits: np.ndarray, ratio: float) -> np.ndarray:
    """How much likelier each table row is under label 1, by how many windows of either label have it; towards 0 for
    rows that few windows have. ``ratio`` is that of the labels' windows."""
    n0, n1 = (np.bincount(rows[hits == k], minlength=1 << TABLE_BITS) for k in (0, 1))
    return np.log((n1 + PRIOR) / (n0 * ratio + PRIOR)).astype(np.float32)


def train(texts: list[list[str]], table: np.ndarray) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(tables, weights) by texts of label 0 and of label 1. A window has the label of its text."""
    rng = np.random.default_rng(SEED)
    vocabulary = Vocabulary()
    found = [vocabulary.windows(t) for t in texts]
    labels = np.repeat(np.arange(2), [len(w) for w, _ in found])
    fold = np.concatenate([np.repeat(np.arange(len(n)) % 2, n) for _, n in found])
    windows = np.concatenate([w for w, _ in found])
    kinds = sequences(vocabulary.words(), table)

    def odds(chosen: np.ndarray) -> dict[str, np.ndarray]:
        size = len(vocabulary.number)
        pairs = np.unique(np.repeat(np.flatnonzero(chosen), WINDOW) * size + windows[chosen].ravel())
        of, word = pairs[pairs % size > 0] // size, pairs[pairs % size > 0] % size
        ratio = (labels[chosen] == 1).sum() / max((labels[chosen] == 0).sum(), 1)
        out = {}
        for kind, (rows, counts) in kinds.items():
            ends = np.cumsum(counts)
            out[kind] = log_odds(ranges(rows, ends[word] - counts[word], ends[word]), np.repeat(labels[of], counts[word]), ratio)
        return out

    # The network learns to read odds that its own window had no part in: either half of the texts has the other's.
    x = np.concatenate([inputs(odds(fold != f), kinds) for f in (0, 1)])
    tables = odds(fold >= 0)
    windows = np.where((windows > 0) & (fold == 1)[:, None], windows + len(vocabulary.number), windows)
    p = {"attend": rng.normal(0, 0.3, 2 * HIDDEN), "out": rng.normal(0, 0.5, 2 * HIDDEN), "bias": np.zeros(1)}
    for side in ("left", "right"):
        p[f"w_{side}"] = rng.normal(0, 0.5, (INPUTS, 3 * HIDDEN))
        p[f"u_{side}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        p[f"b_{side}"] = np.zeros(3 * HIDDEN)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    share = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1)).astype(np.float32)
    step, each = 0, -(-len(windows) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // each))
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            used, local = np.unique(np.append(windows[some], 0), return_inverse=True)
            g = gradients(p, x[used], local[:-1].reshape(-1, WINDOW), labels[some], share[some])
            step += 1
            for k in p:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.01 * (g[k] * g[k] - second[k])
                p[k] -= RATE * (1.05 - step / (epochs * each)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return tables, p


def summary(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What a text's windows say: the highest logit, the mean chance, the sum of chances, and how many there are."""
    out = np.zeros((len(counts), 4))
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        chance = sigmoid(values.astype(np.float64))
        out[full, 0] = np.maximum.reduceat(values, starts)
        total = np.add.reduceat(chance, starts)
        out[full, 1], out[full, 2], out[full, 3] = total / counts[full], np.log1p(total), np.log(counts[full])
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Coefficients, the constant last, by Newton's method with a little shrinkage."""
    x = np.hstack([x, np.ones((len(x), 1))])
    b, keep = np.zeros(x.shape[1]), 1e-3 * weights.sum() * np.eye(x.shape[1])
    for _ in range(30):
        m = sigmoid(x @ b)
        h = (x * (weights * m * (1 - m))[:, None]).T @ x + keep
        b = b + np.linalg.solve(h, x.T @ (weights * (y - m)) - keep @ b)
    return b


class Scorer:
    """A trained network, and how the windows of a text make its score."""

    def __init__(self, table: np.ndarray, tables: dict[str, np.ndarray], p: dict[str, np.ndarray], final: np.ndarray | None = None):
        self.table, self.tables, self.p, self.final = table, tables, p, final
        self.forget()

    def forget(self) -> None:
        self.vocabulary = Vocabulary()
        self.left = self.right = np.empty((0, 3 * HIDDEN), np.float32)

    def summaries(self, texts: list[str]) -> np.ndarray:
        if len(self.vocabulary.number) > MOST_WORDS:
            self.forget()
        windows, counts = self.vocabulary.windows(texts)
        if new := self.vocabulary.words(len(self.left)):
            left, right = both(self.p, inputs(self.tables, sequences(new, self.table)))
            self.left, self.right = np.concatenate([self.left, left]), np.concatenate([self.right, right])
        return summary(logits(self.p, self.left, self.right, windows), counts)

    def scores(self, texts: list[str]) -> np.ndarray:
        """0 to 1 per text; 0 for one without words."""
        found = self.summaries(texts)
        values = sigmoid(np.hstack([found, np.ones((len(found), 1))]) @ self.final)
        return np.where(found.any(axis=1), values, 0.0)


def learn(texts: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Scorer | None:
    """A scorer from a bounded sample of the ``texts`` that have a ``label`` of 0 or 1 in ``labels``; None unless there
    are some of either. The final step is fitted on texts the network did not learn from, at the labels' own ratio."""
    hashed = texts.select(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.octet_length(text).alias("bytes"), F.col(text).alias("text"))
    marks = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where(F.col("label").isin(0, 1))
    known = hashed.where(F.col("bytes") > 0).select("key", "hash", "bytes").join(marks, "key").select("label", "hash", "bytes")
    sample = sample_texts(texts, known, SAMPLE_ROWS, SAMPLE_BYTES, text)
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    found: list[list[str]] = [[], []]
    for k, body in zip(sample.column("label").to_pylist(), sample.column("text").to_pylist()):
        if body.split():
            found[k].append(body)
    if not all(found):
        return None
    apart = [t[::CALIBRATE] if len(t) >= 2 * CALIBRATE else t for t in found]
    kept = [[x for n, x in enumerate(t) if n % CALIBRATE] if len(t) >= 2 * CALIBRATE else t for t in found]
    table = letter_table()
    scorer = Scorer(table, *train(kept, table))
    x = np.concatenate([scorer.summaries(t) for t in apart])
    y = np.repeat([0.0, 1.0], [len(t) for t in apart])
    weights = np.where(y == 1, counts[1] / len(apart[1]), counts[0] / len(apart[0]))
    scorer.final = fit_logistic(x, y, weights / weights.sum() * len(y))
    return scorer


def score(docs: DataFrame, scorer: Scorer | None, text: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``toxic_score`` (0 to 1); a column of this name is replaced.

    The score takes in the whole text, by windows of WINDOW words that begin every STRIDE words. A text that is NULL or has no words has score 0, and
    so have all texts where there was nothing to learn from.
    """
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "toxic_score"])
    if scorer is None:
        return kept.withColumn("toxic_score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast((scorer.table, scorer.tables, scorer.p, scorer.final))  # a few MB, by the tables' sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Scorer(*shared.value)
        for block in blocks(batches, text, BLOCK_BYTES):
            found = model.scores([t or "" for t in block.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(found)], [*block.schema.names, "toxic_score"])

    return kept.mapInArrow(run, schema_with(kept, {"toxic_score": "double"}))
