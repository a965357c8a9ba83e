"""Language ID by interpolated Kneser-Ney character models in sorted hash arrays."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import blocks, labelled, sample_texts, schema_with

ORDER = 4
# Models learn from a bounded sample: per language so many texts and bytes at most, some of them for calibration.
SAMPLE_ROWS, SAMPLE_BYTES, CALIBRATE = 2_000, 4 << 20, 5
# A text is rejected this many standard deviations above the mean cross-entropy of its language.
REJECT, LEAST_VARIANCE = 10.0, 0.02
UNKNOWN = "und"
BLOCK_BYTES = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)


def letter_table() -> np.ndarray:
    """Code point to lower-case letter, and to a blank where it is no letter (or mark)."""
    import unicodedata

    table = np.full(0x110000, 32, np.int32)
    for code in range(0x110000):
        char = chr(code)
        if unicodedata.category(char)[0] in "LM":
            table[code] = ord(char.lower()[0])
    return table


def letters(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, number per text): lower-case letters, runs of anything else as one blank, and a blank at
    both ends. A text without letters has none."""
    joined = "\0".join(texts) + "\0"  # ends each text; one within a text is found by the lengths
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.int32)
    mapped = table[codes]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    first = np.zeros(len(mapped), bool)
    first[0] = True
    first[ends[:-1]] = True
    blank = mapped == 32
    # The blank that ends a text is kept; one after a blank, or at the start, is not.
    keep = ~blank | (~np.concatenate([[True], blank[:-1]]) & ~first)
    starts = np.concatenate([[0], ends[:-1]])
    text_of = np.repeat(np.arange(len(texts)), ends - starts)
    kept, owner = mapped[keep], text_of[keep]
    counts = np.bincount(owner, minlength=len(texts))
    # Ends cut off by a run of blanks before them, and the blank in front.
    full = np.flatnonzero(counts)
    begin = np.concatenate([[0], np.cumsum(counts)])[full]
    symbols = np.insert(kept, begin, 32)
    counts[full] += 1
    return symbols, counts


class HashTable:
    """Sorted hashes of keys, with rows beside them. A key of up to four symbols of 16 bits is multiplied by an odd
    number, so no two keys share a hash; the top bits of a hash say where it would stand."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        hashes = keys.astype(np.uint64) * ODD
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], rows[order]
        bits = max(1, int(np.ceil(np.log2(max(2, 2 * len(keys))))))
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.first = np.append(self.first, len(keys)).astype(np.int32)
        self.longest = int(np.diff(self.first).max())

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where each key stands; -1 if it is not there."""
        found = np.full(len(keys), -1, np.int32)
        if not len(self.hashes):
            return found
        hashes = keys.astype(np.uint64) * ODD
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        last = len(self.hashes) - 1
        open_ = np.arange(len(keys))
        for _ in range(self.longest):
            here = np.minimum(at, last)
            value = self.hashes[here]
            hit = value == hashes
            found[open_[hit]] = here[hit]
            more = value < hashes
            open_, at, hashes = open_[more], at[more] + 1, hashes[more]
            if not len(open_):
                break
        return found


class Models:
    """One model per language over shared tables: a row of a table has a value per language."""

    def __init__(self, texts: dict[str, list[str]], table: np.ndarray, order: int = ORDER):
        self.languages, self.order, self.table = sorted(texts), order, table
        streams = {l: letters(texts[l], table)[0] for l in self.languages}
        alphabet = np.unique(np.concatenate([*streams.values(), [32]]))[: (1 << 16) - 2]
        # Symbols 1 and up, 0 is any letter that was not seen.
        self.symbol = np.zeros(0x110000, np.uint16)
        self.symbol[alphabet] = np.arange(1, len(alphabet) + 1)
        count = len(self.languages)
        self.uniform = 1.0 / (len(alphabet) + 1)
        grams: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order + 1)]
        for l in self.languages:
            symbols = self.symbol[streams[l]].astype(np.uint64)
            found = np.unique(self.keys(symbols, order)[order - 1 :], return_counts=True)
            grams[order].append(found)
            for n in range(order - 1, 0, -1):
                # A shorter sequence counts by the number of symbols it follows.
                found = np.unique(found[0] & np.uint64((1 << 16 * n) - 1), return_counts=True)
                grams[n].append(found)
        self.seen: list[HashTable] = [None]
        self.back: list[HashTable] = [None]
        for n in range(1, order + 1):
            union = np.unique(np.concatenate([k for k, _ in grams[n]]))
            contexts = np.unique(union >> np.uint64(16))
            value, weight = np.zeros((len(union), count)), np.ones((len(contexts), count))
            for at, (keys, counts) in enumerate(grams[n]):
                once, twice = (counts == 1).sum(), (counts == 2).sum()
                discount = once / (once + 2 * twice) if once and twice else 0.5
                where = np.searchsorted(contexts, keys >> np.uint64(16))
                total = np.bincount(where, counts, len(contexts))
                kinds = np.bincount(where, minlength=len(contexts))
                weight[total > 0, at] = discount * kinds[total > 0] / total[total > 0]
                value[np.searchsorted(union, keys), at] = (counts - discount) / total[where]
            lower = self.probability(union & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
            value += weight[np.searchsorted(contexts, union >> np.uint64(16))] * lower
            self.seen.append(HashTable(union, value.astype(np.float32)))
            self.back.append(HashTable(contexts, weight.astype(np.float32)))
        self.bits = np.log2(self.seen[order].rows)
        self.limits = np.zeros((count, 3))

    @staticmethod
    def keys(symbols: np.ndarray, n: int) -> np.ndarray:
        """The n symbols that end at each position, 16 bits each; fewer at the start."""
        key = symbols.copy()
        for k in range(1, n):
            key[k:] |= symbols[: len(symbols) - k] << np.uint64(16 * k)
        return key

    def probability(self, keys: np.ndarray, n: int) -> np.ndarray:
        """Of the last symbol of each key, given those before it; a column per language."""
        if n == 0:
            return np.full((len(keys), len(self.languages)), self.uniform)
        at = self.seen[n].find(keys)
        out = self.seen[n].rows[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            keys = keys[miss]
            context = self.back[n].find(keys >> np.uint64(16))
            weight = np.where(context[:, None] >= 0, self.back[n].rows[context], 1.0)
            out[miss] = weight * self.probability(keys & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bits per symbol by language, variance of one symbol's bits, symbols) per text; no symbols, no bits."""
        symbols, counts = letters(texts, self.table)
        bits, variance = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        full = np.flatnonzero(counts)
        if len(full):
            keys = self.keys(self.symbol[symbols].astype(np.uint64), self.order)
            at = self.seen[self.order].find(keys)
            logs = self.bits[at]
            miss = np.flatnonzero(at < 0)
            logs[miss] = np.log2(self.probability(keys[miss], self.order))
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[full]
            logs[starts] = 0  # the blank in front is given
            n = np.maximum(counts[full] - 1, 1)[:, None]
            bits[full] = -np.add.reduceat(logs, starts, axis=0, dtype=np.float64) / n
            best = bits[full].argmin(axis=1)
            own = logs[np.arange(len(logs)), np.repeat(best, counts[full])]
            variance[full] = np.add.reduceat(own * own, starts, dtype=np.float64) / n[:, 0] - bits[full].min(axis=1) ** 2
        return bits, np.maximum(variance, 0), np.maximum(counts - 1, 0)

    def calibrate(self, texts: dict[str, list[str]]) -> None:
        """Per language the mean of the bits of texts, their variance between texts, and that of one symbol."""
        for at, language in enumerate(self.languages):
            bits, variance, counts = self.entropies(texts.get(language) or [""])
            some = counts > 0
            if some.any():
                means, n = bits[some, at], counts[some]
                centre = np.average(means, weights=n)
                one = np.average(variance[some], weights=n)
                between = max(0.0, float(np.mean((means - centre) ** 2 - one / n)))
                self.limits[at] = centre, max(between, LEAST_VARIANCE), max(one, 0.1)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, bits per symbol, rejected) per text."""
        bits, _, counts = self.entropies(texts)
        best = bits.argmin(axis=1)
        least = bits.min(axis=1)
        # The chance of the best language, were symbols up to a hundred independent.
        odds = np.exp2(-(bits - least[:, None]) * np.minimum(counts, 100)[:, None])
        centre, between, one = self.limits[best].T
        limit = centre + REJECT * np.sqrt(between + one / np.maximum(counts, 1))
        none = counts == 0
        names = [UNKNOWN if n else self.languages[b] for n, b in zip(none.tolist(), best.tolist())]
        return names, np.where(none, 0.0, 1 / odds.sum(axis=1)), np.where(none, np.nan, least), none | (least > limit)


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> Models | None:
    """Models from a bounded sample of the rows that have a text and a language; every fifth text calibrates. None if
    there are no such rows."""
    sample = sample_texts(rows, labelled(rows, lang, text), SAMPLE_ROWS, SAMPLE_BYTES, text)
    texts: dict[str, list[str]] = {}
    for language, body in zip(sample.column("label").to_pylist(), sample.column("text").to_pylist()):
        texts.setdefault(language, []).append(body)
    table = letter_table()
    texts = {l: t for l, t in texts.items() if letters(t, table)[1].any()}
    if not texts:
        return None
    apart = {l: t[::CALIBRATE] if len(t) > CALIBRATE else t for l, t in texts.items()}
    kept = {l: [x for n, x in enumerate(t) if n % CALIBRATE] if len(t) > CALIBRATE else t for l, t in texts.items()}
    kept = {l: t if letters(t, table)[1].any() else texts[l] for l, t in kept.items()}
    models = Models(kept, table)
    models.calibrate(apart)
    return models


def identify(docs: DataFrame, models: Models | None, text: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``lang_pred``, ``lang_score`` (0 to 1), ``lang_bits`` (per symbol) and
    ``lang_rejected``; columns of these names are replaced.

    The language is that of the lowest cross-entropy per symbol. A text that is NULL or has no letter is ``und``, with
    score 0, and rejected; so is one whose cross-entropy lies too far above what texts of its language have, which
    keeps its nearest language. Long texts are scored whole. Without models all texts are ``und``.
    """
    added = {"lang_pred": "string", "lang_score": "double", "lang_bits": "double", "lang_rejected": "boolean"}
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    if models is None:
        values = {"lang_pred": F.lit(UNKNOWN), "lang_score": F.lit(0.0), "lang_bits": F.lit(None).cast("double"), "lang_rejected": F.lit(True)}
        return kept.withColumns(values)
    shared = docs.sparkSession.sparkContext.broadcast(vars(models).copy() | {"seen": _plain(models.seen), "back": _plain(models.back)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Models.__new__(Models)
        vars(model).update(shared.value)
        model.seen, model.back = _tables(model.seen), _tables(model.back)
        for block in blocks(batches, text, max(1 << 16, 4 * BLOCK_BYTES // len(model.languages))):
            names, score, bits, rejected = model.predict([t or "" for t in block.column(text).to_pylist()])
            arrays = [pa.array(names), pa.array(score), pa.array(bits, from_pandas=True), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*block.columns, *arrays], [*block.schema.names, *added])

    return kept.mapInArrow(run, schema_with(kept, added))


def _plain(tables: list[HashTable | None]) -> list[dict | None]:
    """Tables as arrays, which tasks can read without this package."""
    return [t and vars(t) for t in tables]


def _tables(plain: list[dict | None]) -> list[HashTable | None]:
    out: list[HashTable | None] = []
    for arrays in plain:
        out.append(None if arrays is None else HashTable.__new__(HashTable))
        if arrays is not None:
            vars(out[-1]).update(arrays)
    return out
