"""Quality rules over the repeats that a suffix array of a text's words shows.

The words of a text are numbered and their suffixes sorted by doubling the compared length; only
suffixes that are not told apart yet take part in a round. The classes of all rounds give the longest
common prefix of neighbours. The longest repeat that starts at a word is the larger of its two common
prefixes; a repeat that is not the tail of the one a word earlier is maximal. The spans of maximal
repeats are united; a text goes if they cover too much of it or if one is too long.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import map_texts, small_batches, text_slices

# Fixed values of the contract.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """A text is kept if it is within all of these; counts are words."""

    min_repeat: int = 4
    max_covered: float = 0.3
    max_longest: int = 60
    max_symbols_per_word: float = 0.15
    max_shouted: float = 0.5


COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_shouted long, n_covered long, longest_repeat long")


def longest_repeats(words: list[list[bytes]], least: int) -> list[np.ndarray]:
    """For each text and word: words in the longest repeat that starts there, 0 below ``least``."""
    sizes = np.array([len(w) for w in words], np.int64)
    n = int(sizes.sum())
    result = np.zeros(n, np.int64)
    if n:
        number = defaultdict()
        number.default_factory = number.__len__
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, n)
        ends = np.repeat(np.cumsum(sizes), sizes)
        text = np.repeat(np.arange(len(words)), sizes)
        suffixes, classes = _suffix_array(text * len(number) + ids, ends, least)
        _common_prefixes(suffixes, classes, ends, least, result)
    return np.split(result, np.cumsum(sizes)[:-1])


def _suffix_array(keys: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and for each round k the class of every suffix by its first 2**k words.

    A class is the place of its first member in the order.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=first[1:])
    places = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = places
    classes, length = [rank], 1
    while True:
        # places in the order whose suffix shares its class with a neighbour
        alone = first & np.append(first[1:], True)
        open_at = np.flatnonzero(~alone)
        if not len(open_at):
            return order, classes
        members = order[open_at]
        beyond = members + length
        inside = beyond < ends[members]
        second = np.where(inside, rank[np.where(inside, beyond, 0)] + 1, 0)
        group = rank[members]
        again = np.lexsort((second, group)) if n >= 1 << 31 else np.argsort(group * (n + 1) + second, kind="stable")
        members, second, group = members[again], second[again], group[again]
        order[open_at] = members
        starts = np.empty(len(members), bool)
        starts[0] = True
        starts[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        first[open_at] = starts
        rank = rank.copy()
        rank[members] = np.maximum.accumulate(np.where(starts, open_at, 0))
        classes.append(rank)
        length *= 2


def _common_prefixes(order: np.ndarray, classes: list[np.ndarray], ends: np.ndarray, least: int,
                     result: np.ndarray) -> None:
    """Writes each suffix's longest common prefix with a neighbour in the order, where it is ``least`` or more."""
    level = least.bit_length() - 1
    if level >= len(classes):
        return  # all suffixes differ in fewer words
    same = classes[level][order[1:]] == classes[level][order[:-1]]
    a, b = order[:-1][same], order[1:][same]
    prefix = np.zeros(len(a), np.int64)
    for k in range(len(classes) - 1, -1, -1):
        x, y = a + prefix, b + prefix
        fits = np.flatnonzero((x < ends[a]) & (y < ends[b]))
        equal = fits[classes[k][x[fits]] == classes[k][y[fits]]]
        prefix[equal] += 1 << k
    long_enough = prefix >= least
    np.maximum.at(result, a[long_enough], prefix[long_enough])
    np.maximum.at(result, b[long_enough], prefix[long_enough])


def covered(repeats: np.ndarray) -> int:
    """Words in the union of the maximal repeats' spans."""
    at = np.flatnonzero(repeats)
    maximal = at[(at == 0) | (repeats[at - 1] <= repeats[at])]
    edge = np.zeros(len(repeats) + 1, np.int64)
    np.add.at(edge, maximal, 1)
    np.add.at(edge, maximal + repeats[maximal], -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def measure(texts: list[str | None], min_repeat: int) -> list[list[int]]:
    """The figures of each text in the order of ``COLUMNS``."""
    bodies = [(t or "").encode() for t in texts]
    words = [b.split() for b in bodies]
    repeats = longest_repeats(words, min(WINDOW, min_repeat))
    rows = []
    for text, body, own, found in zip(texts, bodies, words, repeats):
        lines = [x for x in body.split(b"\n") if x.strip()]
        in_windows, in_repeats, longest = 0, 0, 0
        if found.any():
            in_windows = covered(np.where(found >= WINDOW, found, 0))
            in_repeats = covered(np.where(found >= min_repeat, found, 0))
            longest = int(found.max())
        rows.append((
            len(own), len(text or "") - (len(body) - len(body.translate(None, SPACES))),
            len(body) - len(body.translate(None, SYMBOLS)), len(lines) - len(set(lines)), in_windows,
            sum(map(bytes.isupper, own)), in_repeats, longest if longest >= min_repeat else 0))
    return [list(c) for c in zip(*rows)]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def within(limits: Limits) -> Column:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return (
        (F.col("n_covered") <= F.lit(limits.max_covered) * words) & (F.col("longest_repeat") <= limits.max_longest)
        & (F.col("n_symbols") <= F.lit(limits.max_symbols_per_word) * words)
        & (F.col("n_shouted") <= F.lit(limits.max_shouted) * words)
    )


def judge(df: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Figures and verdict of every text: ``<key>``, ``COLUMNS``, ``base_failed, kept``.

    Whole texts are measured. A null text has no words and is not kept, nor is an empty one. Repeated
    rows each get a row; other columns are not read; an empty table gives no rows.
    """
    figures = map_texts(df, key, text, lambda texts: measure(texts, limits.min_repeat), COLUMNS)
    return figures.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & within(limits))


def keep_good(df: DataFrame, limits: Limits = Limits(), text: str = "text", slice_chars: int = 1_000_000) -> DataFrame:
    """The rows of ``df`` whose text is kept, with all their columns, in one pass.

    A null or empty text is not kept. Repeated rows are judged each; other columns pass through whatever
    their names; an empty table gives no rows. A task measures about ``slice_chars`` characters at a time; a
    longer text is measured alone and whole.
    """
    import pyarrow as pa

    at = df.columns.index(text)
    small_batches(df.sparkSession)

    def good(texts: list[str | None]) -> list[bool]:
        n_words, _, n_symbols, _, n_repeat, n_shouted, n_covered, longest = measure(texts, limits.min_repeat)
        return [
            w >= MIN_WORDS and 100 * r <= MAX_REPEAT_PERCENT * w and c <= limits.max_covered * w
            and x <= limits.max_longest and s <= limits.max_symbols_per_word * w and u <= limits.max_shouted * w
            for w, s, r, u, c, x in zip(n_words, n_symbols, n_repeat, n_shouted, n_covered, longest)
        ]

    def run(batches):
        for batch in batches:
            for start, stop, texts in text_slices(batch, at, slice_chars):
                yield batch.slice(start, stop - start).filter(pa.array(good(texts)))

    return df.mapInArrow(run, df.schema)
