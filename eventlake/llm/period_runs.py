"""Runs of repeated words: every maximal stretch of a text that repeats with some period.

A run is a stretch of words with smallest period q (words q apart are the same) and at least
``max(least, 2 * q)`` words, which no neighbouring word extends with that period.

1. **Harmonic grid.** A run with period p has at least 2p words, so two neighbours of the grid
   0, p, 2p, ... lie in it. For every p all such neighbours are compared, n log n pairs a text in
   all; a pair stays if the words at its places are the same and so are three more, on one side.
2. **Longest common extensions** to the right and to the left of each pair that stays give the
   stretch with period p around it. Of equal stretches the least period is the run's.
3. Extensions come from an index of **difference-cover samples**: places whose remainder mod 21 is
   in a cover, of which any two places reach two after the same few words. Only the suffixes at
   samples are sorted, by three words at a time up to 21, then by doubling; names of the doubling
   steps give the common length of neighbours in that order, and a sparse table of minima the one
   of any two. A query compares the words up to the next samples and asks the table for the rest.

Texts are worked on in chunks of whole texts; the index has only texts with a pair that stays.
Work on a text of n words is n log n for the grid and for the sort, its memory some 150 bytes a
word, however repetitive it is. Nothing is shuffled. Words are told apart by 64-bit hashes.

Defined cases: a null, empty or blank text has no words and no runs, and collapses to the empty
text. Repeated rows and ids are rows of their own. Other columns are passed on, clashing ones
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.shared import prepare
from eventlake.llm.tokens import NOT_WHITE, Texts, as_bytes, chunks, owners

LEAST_WORDS = 12
# A difference cover: every difference mod 21 is one of two members.
MODULUS, COVER = 21, (0, 1, 4, 14, 16)
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Grid pairs looked at in one go.
PAIRS = 1 << 20
REPORT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_runs", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("period", T.LongType()),
        T.StructField("exponent_milli", T.LongType()),
        T.StructField("runs", T.StringType()),
        T.StructField("collapsed", T.StringType()),
    ]
)


def collapse_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """All columns of ``docs`` and, of the runs of at least ``least`` words in ``text``: n_words,
    n_runs; start, length, period, exponent_milli of the longest run (ties: least start, then
    period); ``runs``, a line ``start,length,period`` each by start, then period; and
    ``collapsed``, the words joined by one space without those that a run repeats."""
    if least < 4:
        raise ValueError("least must be 4 or more")
    prepare(docs.sparkSession)
    docs = docs.drop(*REPORT.fieldNames())

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = as_bytes(batch["text"]), []
            for a, b in chunks(texts):
                rows += _reports(texts[a:b], least)
            columns = list(zip(*rows, strict=True)) or [()] * len(REPORT.fields)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    *[pa.array(c, pa.int64()) for c in columns[:6]],
                    *[pa.array(c, pa.string()) for c in columns[6:]],
                ],
                names=[*batch.schema.names, *REPORT.fieldNames()],
            )

    return docs.mapInArrow(collapse, T.StructType([*docs.schema.fields, *REPORT.fields]))


def repeated_from(text: Column, at: Column, period: Column) -> Column:
    """The words of ``text`` joined by one space, word i >= ``at`` replaced by word
    ``at + (i - at) % period``: a text with a known run."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), 1)
    head, tail = F.slice(words, 1, at), F.slice(words, at + 1, period)
    n = F.size(words) - at
    copies = F.slice(F.flatten(F.array_repeat(tail, F.ceil(n / period).cast("int"))), F.lit(1), n)
    return F.array_join(F.concat(head, copies), " ")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0))


def find_runs(words: np.ndarray, counts: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, in that order.

    ``words`` are the words of all texts as equal or unequal numbers, ``counts`` words per text.
    """
    kept = _surviving_pairs(words, counts, least)
    found = [np.zeros((0, 4), dtype=np.int64)]
    if kept:
        texts = np.unique(np.concatenate([k[0] for k in kept]))
        forward, backward, place = _indexes(words, counts, texts)
        for text, i, p in kept:
            at = place[text] + i
            right = forward.common(at, at + p)
            n = len(backward)
            left = backward.common(n - at, n - at - p)
            long = (left + right >= p) & (left + right + p >= least)
            run = np.stack([x[long] for x in (text, i - left, left + right + p, p)], axis=1)
            # Neighbours on one grid line mostly find the same run.
            new = np.ones(len(run), dtype=bool)
            new[1:] = (run[1:] != run[:-1]).any(axis=1)
            found.append(run[new])
    runs = np.unique(np.concatenate(found), axis=0)
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


class CommonExtensions:
    """Lengths of common extensions of an array in which separators (negative) are all different
    and places are only ever compared between the same two separators."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        # Beyond the last separator nothing is compared; the padding only spares a check.
        low = symbols.min(initial=0)
        self.symbols = np.append(symbols, np.arange(low - 1, low - 1 - 2 * MODULUS, -1))
        part = np.cumsum(symbols < 0) - (symbols < 0)
        self.places = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        self.sample = np.full(n, -1, dtype=np.int64)
        self.sample[self.places] = np.arange(len(self.places))
        self.rank, levels = self._sorted(part[self.places])
        order = np.empty_like(self.rank)
        order[self.rank] = np.arange(len(order))
        sizes = np.bincount(part[self.places], minlength=1)
        self.minima = self._minima(self._neighbours(order, levels), int(sizes.max()))

    def __len__(self) -> int:
        return len(self.symbols) - 2 * MODULUS

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal symbols from ``i`` and ``j`` on, for places i != j."""
        step = _STEPS[i % MODULUS, j % MODULUS]
        length = self._compared(i, j, step)
        rest = np.flatnonzero(length == step)
        a = self.rank[self.sample[i[rest] + step[rest]]]
        b = self.rank[self.sample[j[rest] + step[rest]]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        width = np.frexp(high - low)[1] - 1  # floor of the logarithm
        length[rest] += np.minimum(self.minima[width, low], self.minima[width, high - (1 << width)])
        return length

    def _compared(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Number of equal symbols, at most ``limit``, by looking at them one after the other."""
        length = np.zeros(len(i), dtype=np.int64)
        live = np.flatnonzero(limit > 0)
        for step in range(1, int(limit.max(initial=0)) + 1):
            same = self.symbols[i[live] + step - 1] == self.symbols[j[live] + step - 1]
            live = live[same]
            length[live] = step
            live = live[limit[live] > step]
        return length

    def _sorted(self, part: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Ranks of the sampled suffixes, part by part, and their names by the first 21, 42, 84,
        ... symbols: the rank of the first suffix that begins with the same ones."""
        m = len(part)
        rank = np.searchsorted(part, part)
        live = np.arange(m)
        keys = self.symbols - self.symbols.min()
        bits = int(keys.max()).bit_length()
        together = 63 // bits
        for offset in range(0, MODULUS, together):
            packed = np.zeros(len(live), dtype=np.int64)
            for step in range(offset, min(offset + together, MODULUS)):
                packed = packed << bits | keys[self.places[live] + step]
            live = _refine(rank, live, packed)
        levels, length = [rank.copy()], MODULUS
        while len(live):
            live = _refine(rank, live, rank[self.sample[self.places[live] + length]])
            length *= 2
            levels.append(rank.copy())
        return rank, levels

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Number of equal symbols of each sampled suffix and the next in order."""
        i, j = self.places[order[:-1]], self.places[order[1:]]
        length = np.zeros(len(i), dtype=np.int64)
        live = np.arange(len(i))
        if len(levels) > 1:  # most neighbours differ within the first 21 symbols
            live = np.flatnonzero(levels[0][order[:-1]] == levels[0][order[1:]])
        for k in range(len(levels) - 1, -1, -1):
            a, b = i[live] + length[live], j[live] + length[live]
            same = levels[k][self.sample[a]] == levels[k][self.sample[b]]
            length[live[same]] += MODULUS << k
        limit = np.full(len(i), MODULUS)
        return length + self._compared(i + length, j + length, limit)

    @staticmethod
    def _minima(values: np.ndarray, widest: int) -> np.ndarray:
        """Row k: the least of 2**k values from each place on."""
        table = [values]
        while 1 << len(table) <= widest:
            half, last = 1 << (len(table) - 1), table[-1]
            row = last.copy()
            row[: len(row) - half] = np.minimum(last[: len(last) - half], last[half:])
            table.append(row)
        return np.stack(table).astype(np.int32)


def _steps() -> np.ndarray:
    """How many symbols two places, by their remainders, are from the next two samples."""
    table = np.full((MODULUS, MODULUS), -1, dtype=np.int64)
    for step in reversed(range(MODULUS)):
        here = np.isin((np.arange(MODULUS) + step) % MODULUS, COVER)
        table[here[:, None] & here[None, :]] = step
    assert (table >= 0).all(), "not a difference cover"
    return table


_STEPS = _steps()


def _refine(rank: np.ndarray, live: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Split groups of equal rank among ``live`` by ``key``, in place; returns who still shares a
    rank. A group's rank is the place of its first member."""
    if not len(live):
        return live
    order = np.lexsort((key, rank[live]))
    live, key = live[order], key[order]
    old = rank[live]
    place = np.arange(len(live))
    group = np.ones(len(live), dtype=bool)
    group[1:] = old[1:] != old[:-1]
    new = group.copy()
    new[1:] |= key[1:] != key[:-1]
    begin = np.maximum.accumulate(np.where(group, place, 0))
    first = np.maximum.accumulate(np.where(new, place, 0))
    rank[live] = old + first - begin
    alone = new & np.append(new[1:], True)
    return live[~alone]


def _surviving_pairs(
    words: np.ndarray, counts: np.ndarray, least: int
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place in the text, period) of grid pairs that may lie in a run.

    A run holds ``max(p, least - p)`` equal pairs in a row, 6 of them if least is 12; so from a
    grid pair on, equal pairs go on for half of that to the right or to the left.
    """
    first = np.cumsum(counts) - counts
    able = np.flatnonzero(counts >= least)
    side = least // 4  # of least / 2 pairs in a row, besides the pair itself
    half = counts[able] // 2
    line_text = np.repeat(able, half)
    line_p = np.arange(len(line_text)) - np.repeat(np.cumsum(half) - half, half) + 1
    line_n = (counts[line_text] - 1) // line_p
    cuts = np.searchsorted(np.cumsum(line_n), np.arange(PAIRS, line_n.sum(), PAIRS)) + 1
    kept = []
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(line_n)], strict=True):
        n = line_n[a:b]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p = np.repeat(line_p[a:b], n)
        i = k * p
        at = i + np.repeat(first[line_text[a:b]], n)
        some = np.flatnonzero(words[at] == words[at + p])
        i, p, at = i[some], p[some], at[some]
        text = np.repeat(line_text[a:b], n)[some]
        right = np.ones(len(at), dtype=bool)
        left = right.copy()
        for d in range(1, side + 1):
            inside = i + p + d < counts[text]
            there = np.where(inside, at + d, at)
            right &= inside & (words[there] == words[there + p])
            there = np.where(i >= d, at - d, at)
            left &= (i >= d) & (words[there] == words[there + p])
        stay = right | left
        if stay.any():
            kept.append((text[stay], i[stay], p[stay]))
    return kept


def _indexes(
    words: np.ndarray, counts: np.ndarray, texts: np.ndarray
) -> tuple[CommonExtensions, CommonExtensions, np.ndarray]:
    """Extensions to the right and, of the reversed array, to the left over some of the texts;
    and the place of the first word of each text."""
    first = np.cumsum(counts) - counts
    n = counts[texts]
    # A separator before each text and one at the end; none occurs twice.
    begin = np.cumsum(n + 1) - n
    total = int(n.sum() + len(n) + 1)
    symbols = np.empty(total, dtype=np.int64)
    separators = np.append(begin - 1, total - 1)
    inner = np.ones(total, dtype=bool)
    inner[separators] = False
    offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    _, dense = np.unique(words[np.repeat(first[texts], n) + offset], return_inverse=True)
    symbols[inner] = dense
    symbols[separators] = -1 - np.arange(len(separators))
    place = np.full(len(counts), -1, dtype=np.int64)
    place[texts] = begin
    return CommonExtensions(symbols), CommonExtensions(symbols[::-1]), place


def _reports(texts: list[bytes], least: int) -> list[tuple]:
    chunk = Texts(texts, lower=False)
    begin, end = chunk.runs(NOT_WHITE)
    counts = chunk.counts(begin)
    _, words = np.unique(chunk.hashes(begin, end), return_inverse=True)
    runs = find_runs(words, counts, least)
    first = np.cumsum(counts) - counts
    change = np.zeros(len(words) + 1, dtype=np.int64)
    start = first[runs[:, 0]] + runs[:, 1]
    np.add.at(change, start + runs[:, 3], 1)
    np.add.at(change, start + runs[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    edges = np.searchsorted(owners(counts)[kept], np.arange(len(texts) + 1))
    of_text = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    rows = []
    for t in range(len(texts)):
        own = runs[of_text[t] : of_text[t + 1], 1:].tolist()
        best = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None, None, None)
        rows.append(
            (
                int(counts[t]),
                len(own),
                *best,
                1000 * best[1] // best[2] if own else None,
                "".join(f"{s},{length},{p}\n" for s, length, p in own),
                _joined(chunk, begin, end, kept[edges[t] : edges[t + 1]]),
            )
        )
    return rows


def _joined(chunk: Texts, begin: np.ndarray, end: np.ndarray, words: np.ndarray) -> str:
    spans = zip(begin[words].tolist(), end[words].tolist(), strict=True)
    return b" ".join([chunk.raw[a:b] for a, b in spans]).decode()
