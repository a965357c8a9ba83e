"""Texts as numbers of their words, each distinct word encoded once."""

import re
from collections import defaultdict
from collections.abc import Callable
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# What is known of words is forgotten beyond so many of them or so many bytes of words and ids; longer words are not kept.
MOST_WORDS, MOST_BYTES, LONGEST = 400_000, 64 << 20, 64
#: (ids of all strings, one after the other; number of ids per string)
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class Words:
    """Cuts texts before every blank with something visible after it, and knows the ids of each such word.

    With the pattern in use a match can have a blank only in front, or among other blanks, so there is always a new
    match at these cuts, and a word's matches do not depend on what surrounds it. Words longer than ``LONGEST``, such
    as texts without blanks, are known for one block of texts. When more than ``MOST_WORDS`` words, or ``MOST_BYTES``
    of them and their ids, are known they are forgotten before the next block, and encoded again if they come again;
    so memory is bounded, and the ids are the same.
    """

    odd = re.compile(r" (?:\s|$)").search
    cuts = re.compile(r"(?<=.)(?= \S)", re.DOTALL).split

    def __init__(self, encode: Encode):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.flat, self.ends, self.bytes = np.empty(0, np.int32), np.empty(0, np.int64), 0

    def keys(self, text: str) -> list[str]:
        """A word without its blank in front; the first one, which has none, behind a blank."""
        if self.odd(text):
            first, *rest = self.cuts(text)
            return [" " + first, *(w[1:] for w in rest)]
        found = text.split(" ")
        found[0] = " " + found[0]
        return found

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; number of ids of each)."""
        if len(self.number) > MOST_WORDS or self.bytes > MOST_BYTES:
            self.forget()
        known = len(self.number)
        numbers, words = self.numbers(texts)
        if len(self.number) > known:
            new = list(islice(self.number, known, None))
            self.add(*self.encode([w[1:] if w[0] == " " else " " + w for w in new]))
        starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends
        first, last = starts[numbers], self.ends[numbers]
        found = ranges(self.flat, first, last)
        total = np.concatenate([[0], np.cumsum(last - first)])
        ends = np.cumsum(words)
        counts = total[ends] - total[ends - words]
        if len(self.number) > known:
            self.keep(known, new)
        return found, counts

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of all texts, one after the other; number of words of each). Words of a block are
        first told apart by Arrow, so that each distinct one is looked up once."""
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, r" (?:[\s\p{Z}\x{1C}-\x{1F}\x{85}]|$)").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.filter(column, pa.array(~odd)), " ")
        offsets = lists.offsets.to_numpy()
        flat, begins = lists.flatten(), np.zeros(int(offsets[-1] - offsets[0]), bool)
        begins[offsets[:-1] - offsets[0]] = True  # every text has a word, if only an empty one
        fronts = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), flat.filter(pa.array(begins)), pa.scalar(" ", pa.large_string()))
        flat = pc.replace_with_mask(flat, pa.array(begins), fronts)
        own = {int(n): self.keys(texts[n]) for n in np.flatnonzero(odd)}
        flat = pa.concat_arrays([flat, pa.array(list(chain.from_iterable(own.values())), pa.large_string())])
        words = np.zeros(len(texts), np.int64)
        words[~odd] = np.diff(offsets)
        words[odd] = [len(k) for k in own.values()]
        told = flat.dictionary_encode()
        of = np.fromiter(map(self.number.__getitem__, told.dictionary.to_pylist()), np.int32, len(told.dictionary))
        numbers = of[told.indices.to_numpy()]
        if not own:
            return numbers, words
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        starts = np.empty(len(texts), np.int64)
        starts[order] = np.cumsum(words[order]) - words[order]
        return ranges(numbers, starts, starts + words), words

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        start = self.ends[-1] if len(self.ends) else 0
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, start + np.cumsum(lengths)])

    def keep(self, known: int, new: list[str]) -> None:
        """Of the words ``new`` since ``known``, keep the short ones."""
        short = np.array([len(w) <= LONGEST for w in new])
        if not short.all():
            starts = np.concatenate([[0], self.ends[:-1]])[known:][short]
            ends = self.ends[known:][short]
            flat = ranges(self.flat, starts, ends)
            for _ in new:
                self.number.popitem()
            begun = int(self.ends[known - 1]) if known else 0
            self.flat, self.ends = self.flat[:begun].copy(), self.ends[:known]
            new = [w for w, s in zip(new, short.tolist()) if s]
            for w in new:
                self.number[w]  # numbers it
            self.add(flat, ends - starts)
        self.bytes += sum(map(len, new))
        self.bytes += 0 if not new else 4 * int(self.ends[-1] - (self.ends[known - 1] if known else 0))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        found, counts = self.of(texts)
        return np.split(found, np.cumsum(counts)[:-1]) if texts else []


def by_matches(pattern: str, encode: Encode) -> Encode:
    """Encodes strings by the matches of ``pattern`` in each, every distinct match once."""
    split = regex.compile(pattern).findall

    def run(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        found = [split(w) for w in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.fromiter(map(number.__getitem__, chain.from_iterable(found)), np.int64)
        flat, lengths = encode(list(number))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        total = np.concatenate([[0], np.cumsum(lengths[numbers])])
        last = np.cumsum(counts)
        return ranges(flat, starts[numbers], ends[numbers]), total[last] - total[last - counts]

    return run


def ranges(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ranges of ``flat``, one after the other."""
    lengths = ends - starts
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return flat[shift + np.arange(len(shift))]
