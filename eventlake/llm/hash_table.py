"""Sorted arrays of hashes with values, in shards, in the shared folder.

A shard's rows are ordered by their hashes, spread over the whole range by an odd factor. The
leading bits of a spread hash are not stored: a table of where each of their values begins implies
them, with 8 to 16 rows to a value. The next 56 bits are kept, so from 2**12 rows on all 64 bits
decide, and a smaller shard takes a wrong hash for one of its own with a chance below 2**-52.

The values of a row are one byte, which makes 8 with the kept bits: the number of their combination
among the shard's most frequent ones, or ``ESCAPE`` for a row of the list of exceptions. So one
large count does not widen others, and a look-up in a large table touches two places of memory, the
beginning of its rows and these rows.

Tasks build shards and append consecutive ones to one file, so that there are few files however
many shards there are. Workers memory-map the files and look batches of hashes up by binary search,
all shards of a file at once: a shard's size tells where its parts stand in the file.
"""

from __future__ import annotations

import contextlib

import numpy as np

from eventlake.llm.shared import appended, load_array, load_bytes, save_array

ESCAPE = 255
KEPT_BITS = 56
# A table has about FILES files, and more only where one would hold more shards than SHARDS_OF_FILE.
FILES = 64
SHARDS_OF_FILE = 64
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_CODE = np.uint64(0xFF)
_BOOK = 256


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal parts of the hash range, in order: shard numbers rise with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def shards_of_file(shards: int) -> int:
    """Consecutive shards that share a file in a table of so many."""
    return max(1, min(SHARDS_OF_FILE, -(-shards // FILES)))


def save_shard(folder: str, name: str, number: int, hashes: np.ndarray, **values) -> None:
    """A file of one shard: distinct hashes and arrays of their values, none negative."""
    with ShardWriter(folder, name, number) as file:
        file.add(hashes, **values)


def save_values(folder: str, name: str, number: int, **values) -> None:
    """A file of one shard that is looked up by place alone."""
    with ShardWriter(folder, name, number) as file:
        file.add_values(**values)


class ShardWriter:
    """The files ``<folder>/<name>-<number>-*`` of consecutive shards, which are there at the end.

    Shards are added in the order of their numbers; those without rows may be left out.
    """

    def __init__(self, folder: str, name: str, number: int):
        self.folder, self.name = folder, f"{name}-{number}"
        self.rows, self.exceptions = 0, []

    def __enter__(self) -> ShardWriter:
        self._files, self._open = {}, contextlib.ExitStack()
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None and self.exceptions:
            save_array(self.folder, f"{self.name}-more", _joined(self.exceptions))
        self._open.__exit__(kind, error, trace)

    def add(self, hashes: np.ndarray, **values) -> None:
        """Distinct hashes and one or more arrays of their values, none negative."""
        if not len(hashes):
            return
        spread = hashes * _FACTOR
        order = np.argsort(spread)
        bits = _prefix_bits(len(hashes))
        lead, kept = _split(spread[order], np.uint64(bits))
        starts = np.searchsorted(lead, np.arange(_heads(bits))).astype(np.uint32)
        code = self._coded([v[order] for v in values.values()])
        self._write("rows", starts, kept | code)

    def add_values(self, **values) -> None:
        columns = list(values.values())
        if len(columns[0]):
            self._write("code", self._coded(columns))

    def _coded(self, columns: list[np.ndarray]) -> np.ndarray:
        book, code, others = _encoded(columns)
        self._write("book", book)
        more = np.stack([others + self.rows, *(c[others] for c in columns)])
        self.exceptions.append(narrow(more))
        self.rows += len(code)
        return code

    def _write(self, part: str, *arrays: np.ndarray) -> None:
        if part not in self._files:
            out = self._open.enter_context(appended(self.folder, f"{self.name}-{part}"))
            self._files[part] = out
        for array in arrays:
            self._files[part].write(array.tobytes())


def narrow(values: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds all values."""
    top = int(values.max(initial=0))
    types = (np.uint8, np.uint16, np.uint32, np.uint64)
    return values.astype(next(t for t in types if top <= np.iinfo(t).max))


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts, axis=1, dtype=max(p.dtype for p in parts))


def _prefix_bits(rows: int) -> int:
    return (rows >> 4).bit_length()


def _heads(bits):
    """Beginnings of all values of the leading bits and the end, filled up to an even number."""
    return ((1 << bits) + 2) // 2 * 2


def _split(spread: np.ndarray, bits) -> tuple[np.ndarray, np.ndarray]:
    """The leading bits of spread hashes, and the kept bits after them, above a byte of zeros."""
    lead = (spread >> np.uint64(1)) >> (np.uint64(63) - bits)
    return lead.astype(np.int64), (spread << bits) & ~_CODE


def _encoded(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A book of the most frequent rows, every row's number in it and the rows it does not have."""
    # Small values of up to four columns make one number.
    key = np.zeros(len(columns[0]), dtype=np.uint32)
    small = np.ones(len(key), dtype=bool)
    for i, column in enumerate(columns):
        small &= column < 256
        key |= (column & 0xFF).astype(np.uint32) << np.uint32(8 * i)
    found, times = np.unique(key[small], return_counts=True)
    frequent = np.sort(found[np.argsort(-times, kind="stable")[:ESCAPE]])
    at = np.searchsorted(frequent, key)
    at[at == len(frequent)] = 0
    known = small & (frequent[at] == key) if len(frequent) else small & False
    book = np.zeros((len(columns), _BOOK), dtype=np.uint8)
    for i, column in enumerate(book):
        column[: len(frequent)] = (frequent >> np.uint32(8 * i)) & np.uint32(0xFF)
    return book, np.where(known, at, ESCAPE).astype(np.uint8), np.flatnonzero(~known)


class HashTable:
    """Look-ups in the files ``<folder>/<name>-<number>-*`` of ``per_file`` shards each.

    ``sizes`` has the rows of each shard; a row's place counts over all shards before it.
    ``value_names`` are the names of the values, in the order they were saved in.
    """

    def __init__(
        self, folder: str, name: str, sizes: list[int], value_names: list[str], per_file: int = 1
    ):
        if len(value_names) > 4:
            raise ValueError("a table has at most four values")
        self.folder, self.name, self.value_names = folder, name, value_names
        self.sizes, self.per_file = sizes, per_file
        self.starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        # Where the parts of a shard stand in its file, in units of their own types.
        rows = np.array(sizes, dtype=np.int64)
        bits = np.array([_prefix_bits(int(n)) for n in sizes], dtype=np.int64)
        some = rows > 0
        heads = _heads(bits)
        self._bits = bits.astype(np.uint64)
        self._row = self._in_file(rows)
        self._start = self._in_file(np.where(some, heads + 2 * rows, 0))
        self._first = (self._start + heads) // 2
        self._book = self._in_file(np.where(some, _BOOK * len(value_names), 0))

    def _in_file(self, lengths: np.ndarray) -> np.ndarray:
        """Sums of the lengths of the shards before each one in its file."""
        before = np.cumsum(lengths) - lengths
        return before - before[np.arange(len(lengths)) // self.per_file * self.per_file]

    def __len__(self) -> int:
        return int(self.starts[-1])

    def find(self, hashes: np.ndarray, *names: str, route: np.ndarray | None = None):
        """Place of every hash (-1: absent) and the named values (0 where absent).

        ``route`` gives the hashes that decide the shards, where those are not the keys.
        """
        place = np.full(len(hashes), -1, dtype=np.int64)
        values = [np.zeros(len(hashes), dtype=np.int64) for _ in names]
        home = shard_of(hashes if route is None else route, len(self.sizes))
        order = np.argsort(home.astype(np.uint16), kind="stable")
        home = home[order]
        some = np.diff(self.starts)[home] > 0
        if not some.all():
            home, order = home[some], order[some]
        lead, kept = _split(hashes[order] * _FACTOR, self._bits[home])
        lead += self._start[home]
        for number, here in self._files(home):
            shard = home[here]
            hit, at, code = self._search(number, self._first[shard], lead[here], kept[here])
            shard, part = shard[hit], order[here][hit]
            place[part] = at + self.starts[shard]
            found = self._values(number, shard, at, code, names)
            for column, value in zip(values, found, strict=True):
                column[part] = value
        return (place, *values)

    def at(self, places: np.ndarray, name: str) -> np.ndarray:
        """A value by place; 0 for places beyond the table."""
        home = np.searchsorted(self.starts, places, side="right") - 1
        found = np.zeros(len(places), dtype=np.int64)
        order = np.argsort(home, kind="stable")
        order = order[: np.searchsorted(home, len(self.sizes), sorter=order)]
        home = home[order]
        for number, here in self._files(home):
            shard, part = home[here], order[here]
            at = places[part] - self.starts[shard]
            found[part] = self._values(number, shard, at, self._codes(number, shard, at), [name])[0]
        return found

    def _files(self, home: np.ndarray):
        """The files of ascending shard numbers, and which of these each has."""
        edges = np.arange(-(-len(self.sizes) // self.per_file) + 1) * self.per_file
        edges = np.searchsorted(home, edges)
        for number in np.flatnonzero(np.diff(edges)):
            yield int(number), slice(edges[number], edges[number + 1])

    def _search(self, number: int, first, start, kept) -> tuple[np.ndarray, ...]:
        """Which of the hashes their shards have, where they stand in these, and the rows' codes."""
        data = load_bytes(self.folder, f"{self.name}-{number}-rows")
        heads, rows = data.view(np.uint32), data.view(np.uint64)
        low, end = first + heads.take(start), first + heads.take(start + 1)
        step = (1 << int((end - low).max(initial=0)).bit_length()) >> 1
        while step:
            # Places beyond the last are cut off by ``end``; codes do not change the order.
            less = rows.take(low + (step - 1), mode="clip") < kept
            less &= low + step <= end
            low += less * step
            step >>= 1
        code = rows.take(low, mode="clip") ^ kept
        hit = np.flatnonzero((low < end) & (code <= _CODE))
        return hit, (low - first)[hit], code[hit].astype(np.uint8)

    def _codes(self, number: int, shard, at) -> np.ndarray:
        try:
            data = load_bytes(self.folder, f"{self.name}-{number}-code")
        except FileNotFoundError:  # not a table by place alone
            rows = load_bytes(self.folder, f"{self.name}-{number}-rows").view(np.uint64)
            return rows.take(self._first[shard] + at).astype(np.uint8)
        return data.take(self._row[shard] + at)

    def _values(self, number: int, shard, at, code, names) -> list[np.ndarray]:
        data = load_bytes(self.folder, f"{self.name}-{number}-book")
        entry = self._book[shard] + code
        escaped = np.flatnonzero(code == ESCAPE)
        if len(escaped):
            more = np.asarray(load_array(self.folder, f"{self.name}-{number}-more"))
            row = self._row[shard[escaped]] + at[escaped]
            # In the type of the list, which is not copied then.
            exception = np.searchsorted(more[0], row.astype(more.dtype))
        out = []
        for name in names:
            i = self.value_names.index(name)
            value = data.take(entry + _BOOK * i).astype(np.int64)
            if len(escaped):
                value[escaped] = more[i + 1][exception]
            out.append(value)
        return out
