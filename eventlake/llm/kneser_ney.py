"""LM scoring: an interpolated modified Kneser-Ney n-gram model.

Counting is done in Spark, level by level. The model is a set of sorted hash arrays in the shared
folder, one shard per part of the contexts, which workers memory-map to score whole texts. Shards
grow in number with the corpus, each built within the memory of a task; the files they are appended
to, which a look-up goes through one by one, hardly do (see ``hash_table``).

* Tokens: A-Z lower-cased, runs of anything but white space, then one end per text. ``order - 1``
  starts stand before a text; they are contexts only.
* Tokens become numbers by a sorted array of their 64-bit hashes (the vocabulary, with counts).
* Every task sums its n-grams before they are dealt out by context, packed as compressed columns.
  So a word pair on a third of all rows sends one row per task, and each reducer, which takes the
  shards of a file one after another, sees whole contexts: it sums counts and derives each context's total and its n-grams seen once, twice,
  three times or more. Distinct n-grams give the continuation counts of the next lower level.
* Discounts come from the counts of counts of each level, in the usual closed form; where that is
  undefined or out of range (tiny corpora) they are 0.5, 1 and 1.5. Below level 1 stands the
  uniform distribution over the vocabulary and one unknown word, so probabilities sum to 1.

Contexts, like words, are told apart by 64-bit hashes (56 bits and the place in small shards, see
``hash_table``). The model grows with the corpus: 8 to 9 bytes for each distinct n-gram of level 2
and more, and as many for each distinct context.

Defined cases: a null or empty text is one end token. No training text: every token has
probability 1 (there is nothing but the unknown word). Rows count as they come, repeated ids too.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.hash_table import HashTable, ShardWriter, narrow, shard_of, shards_of_file
from eventlake.llm.shared import prepare, scratch, stored
from eventlake.llm.tokens import NOT_WHITE, Texts, as_bytes, chunks, mix
from eventlake.session import settings

ORDER = 3
TOKENS_PER_SHARD = 1_500_000
WORDS_PER_SHARD = 1_000_000
MAX_SHARDS = 65_535
LARGEST_SHORT = 0xFFFFFFFF  # beyond it word numbers take 8 bytes
END = np.uint64(0x656E64)
_STEP = np.uint64(0x9FB21C651E98DF25)
_PACKED = "shard long, grams binary, counts binary"
SCORES = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Level:
    """One order of the model. ``table`` has n-gram counts, ``contexts`` their contexts' sums."""

    discounts: tuple[float, float, float]
    table: HashTable
    contexts: HashTable | None  # level 1 has one context, the empty one
    total: int = 0  # of the empty context
    seen: tuple[int, int, int] = (0, 0, 0)


@dataclass(frozen=True)
class Model:
    order: int
    tokens: int
    vocabulary: HashTable
    levels: tuple[Level, ...]


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    """True for the rows whose id, as text, falls in the fold kept for testing; null is ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """A model of all texts of ``docs``."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    prepare(spark)
    # Every step's result is stored and read once, so its shuffle goes at its end. Else the files of
    # all steps lie on the disks until the driver happens to collect its garbage.
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return _built(docs.select("text"), order, scratch(spark, "ngram-model"))


def _built(texts: DataFrame, order: int, folder: str) -> Model:
    vocabulary, tokens = _vocabulary(texts, folder)
    levels = []
    packed = texts.mapInArrow(_gram_counter(vocabulary, order, _shards(tokens)), _PACKED)
    shards = _shards(tokens)
    per_file = shards_of_file(shards)
    for k in range(order, 1, -1):
        lower = (shards, None) if k > 2 else (len(vocabulary.sizes), vocabulary)
        build = _level_builder(folder, k, per_file, *lower)
        reduced = stored(_by_file(packed, per_file, build, _LEVEL), f"level-{k}")
        sizes = reduced.where("rows IS NOT NULL").drop("grams", "counts").collect()
        # All shards the n-grams were dealt over, also those that got none.
        rows, contexts = [0] * shards, [0] * shards
        for r in sizes:
            rows[r["shard"]], contexts[r["shard"]] = r["rows"], r["contexts"]
        levels.append(
            Level(
                _discounts(*(sum(r[c] for r in sizes) for c in _SMALL)),
                HashTable(folder, f"gram{k}", rows, ["count"], per_file),
                HashTable(
                    folder, f"context{k}", contexts, ["total", "one", "two", "more"], per_file
                ),
            )
        )
        packed = reduced.where("rows IS NULL").select("shard", "grams", "counts")
    levels.append(_lowest(packed, vocabulary, folder))
    return Model(order, tokens, vocabulary, tuple(reversed(levels)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and the columns of ``SCORES`` (logarithms to base 10)."""
    prepare(docs.sparkSession)
    docs = docs.drop(*[c for c in SCORES.fieldNames() if c in docs.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            parts = [_scored(texts[a:b], model) for a, b in chunks(texts)]
            columns = [
                pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)
            ] or [pa.array([], f) for f in (pa.int64(),) * 3 + (pa.float64(),) * 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *SCORES.fieldNames()]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *SCORES.fields]))


# -- counting -----------------------------------------------------------------------------


def _shards(tokens: int) -> int:
    return min(MAX_SHARDS, max(1, -(-tokens // TOKENS_PER_SHARD)))


def _by_file(
    frame: DataFrame, per_file: int, build: Callable[[Iterator[pa.RecordBatch]], Iterator], schema
) -> DataFrame:
    """What ``build`` makes of the rows of each task: whole files' shards in ascending order."""
    file = F.expr(f"shard div {per_file}")
    return frame.repartition(file).sortWithinPartitions("shard").mapInArrow(build, schema)


def _files(batches: Iterator[pa.RecordBatch], per_file: int) -> Iterator[tuple[int, Iterator]]:
    """Numbers of the files, and for each its shards: their numbers and the batches of their rows.

    The batches of a shard come one by one, and must be taken before the next shard is.
    """

    def parts():
        for batch in batches:
            shard = batch["shard"].to_numpy()
            edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield int(shard[a]), batch.slice(a, b - a)

    def shards(of_file):
        for number, of_shard in itertools.groupby(of_file, itemgetter(0)):
            yield number, map(itemgetter(1), of_shard)

    for number, of_file in itertools.groupby(parts(), lambda part: part[0] // per_file):
        yield number, shards(of_file)


def _vocabulary(texts: DataFrame, folder: str) -> tuple[HashTable, int]:
    """Distinct tokens and their counts, stored as the table ``word``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Grams(1)

        def taken() -> pa.RecordBatch:
            words, n = sums.take()
            return pa.record_batch({"word": words[0].astype(np.uint64).view(np.int64), "n": n})

        for batch in batches:
            column = as_bytes(batch["text"])
            for a, b in chunks(column):
                words, _ = Texts(column[a:b]).words(NOT_WHITE)
                if sums.add(np.append(words, np.full(b - a, END))[None]):
                    yield taken()
        yield taken()

    counted = stored(
        texts.mapInArrow(count, "word long, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    rows, tokens = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = min(MAX_SHARDS, max(1, -(-rows // WORDS_PER_SHARD)))
    # The upper half of the hash scaled to the shards, as shard_of does.
    home = F.shiftrightunsigned(F.shiftrightunsigned("word", 32) * shards, 32)

    per_file = shards_of_file(shards)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, of_file in _files(batches, per_file):
            with ShardWriter(folder, "word", number) as file:
                for shard, parts in of_file:
                    table = pa.Table.from_batches(parts)
                    file.add(table["word"].to_numpy().view(np.uint64), count=table["n"].to_numpy())
                    yield pa.record_batch({"shard": [shard], "rows": [len(table)]})

    sizes = [0] * shards
    homes = counted.select(home.alias("shard"), "word", "n")
    for r in _by_file(homes, per_file, build, "shard long, rows long").collect():
        sizes[r["shard"]] = r["rows"]
    return HashTable(folder, "word", sizes, ["count"], per_file), tokens


def _sequences(texts: list[bytes], vocabulary: HashTable, order: int) -> tuple[np.ndarray, ...]:
    """Numbers of all tokens with starts before and an end after each text, and where words stand.

    Unknown tokens get the number after that of the start.
    """
    words, counts = Texts(texts).words(NOT_WHITE)
    start, unknown = len(vocabulary), len(vocabulary) + 1
    distinct, which = np.unique(np.append(words, END), return_inverse=True)
    place, n = vocabulary.find(distinct, "count")
    place[place < 0] = unknown
    place, n = place[which], n[which]
    width = counts + order
    first = np.cumsum(width) - width
    ids = np.full(int(width.sum()), start, dtype=_number_type(unknown))
    inner = np.repeat(first + order - 1 - (np.cumsum(counts) - counts), counts)
    ids[inner + np.arange(len(words))] = place[:-1]
    ids[first + width - 1] = place[-1]
    seen = np.zeros(len(ids), dtype=np.int64)
    seen[inner + np.arange(len(words))] = n[:-1]
    seen[first + width - 1] = n[-1]
    targets = np.ones(len(ids), dtype=bool)
    for i in range(order - 1):
        targets[first + i] = False
    return ids, seen, np.flatnonzero(targets), counts + 1


def _number_type(largest: int) -> type:
    """Word numbers take 4 bytes as long as all of them fit."""
    return np.uint32 if largest <= LARGEST_SHORT else np.uint64


def _gram_counter(vocabulary: HashTable, order: int, shards: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Grams(order)
        for batch in batches:
            column = as_bytes(batch["text"])
            for a, b in chunks(column):
                ids, _, at, _ = _sequences(column[a:b], vocabulary, order)
                if sums.add(np.stack([ids[at - order + 1 + i] for i in range(order)])):
                    yield from _dealt(*sums.take(), shards)
        yield from _dealt(*sums.take(), shards)

    return count


def _context_hash(grams: np.ndarray) -> np.ndarray:
    """Hash of all words of each column but the last."""
    return _row_hash(grams[:-1])


def _row_hash(grams: np.ndarray) -> np.ndarray:
    value = np.full(grams.shape[1], np.uint64(len(grams)))
    for row in grams:
        value = mix(value * _STEP + row.astype(np.uint64) + np.uint64(1))
    return value


def _dealt(grams: np.ndarray, counts: np.ndarray, shards: int, by_word: HashTable | None = None):
    """Packed rows, one for each shard that has n-grams of this task."""
    if by_word is None:
        home = shard_of(_context_hash(grams), shards)
    else:
        home = np.searchsorted(by_word.starts, grams[-1], side="right") - 1
    order = np.argsort(home.astype(np.uint16), kind="stable")
    grams, counts, home = grams[:, order], counts[order], home[order]
    edges = np.flatnonzero(np.diff(home, prepend=-1, append=shards + 1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        columns = grams[:, a:b].copy()
        # Sorted by the first word: differences are small.
        columns[0, 1:] = np.diff(columns[0])
        yield pa.record_batch(
            {
                "shard": pa.array([int(home[a])], pa.int64()),
                "grams": pa.array([_pack(columns)], pa.binary()),
                "counts": pa.array([_pack(narrow(counts[a:b]))], pa.binary()),
            }
        )


def _pack(array: np.ndarray) -> bytes:
    """Compressed by byte planes: the upper bytes of most numbers are alike."""
    planes = np.ascontiguousarray(array).reshape(-1).view(np.uint8).reshape(-1, array.itemsize).T
    return bytes([array.itemsize]) + zstandard.compress(planes.tobytes(), 3)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[1:]), dtype=np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"u{data[0]}")


def _unpacked(batch: pa.RecordBatch, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for g, c in zip(batch["grams"], batch["counts"], strict=True):
        columns = _unpack(g.as_py()).reshape(k, -1).copy()
        columns[0] = np.cumsum(columns[0], dtype=columns.dtype)
        yield columns, _unpack(c.as_py()).astype(np.int64)


def _level_builder(
    folder: str, k: int, per_file: int, lower_shards: int, by_word: HashTable | None
):
    """Reduce shards of level k: store their arrays, return sizes and lower-level counts."""

    def dealt(lower: _Grams) -> Iterator[pa.RecordBatch]:
        for batch in _dealt(*lower.take(), lower_shards, by_word):
            yield _level_row(batch.to_pylist()[0])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = _Grams(k - 1)
        for number, of_file in _files(batches, per_file):
            with (
                ShardWriter(folder, f"gram{k}", number) as gram_file,
                ShardWriter(folder, f"context{k}", number) as context_file,
            ):
                for shard, parts in of_file:
                    pieces = [piece for part in parts for piece in _unpacked(part, k)]
                    grams = np.concatenate([g for g, _ in pieces], axis=1)
                    counts = np.concatenate([c for _, c in pieces])
                    del pieces
                    grams, counts = _summed(grams, counts)
                    context = _context_hash(grams)
                    # N-grams are in the order of their words, so those of a context are neighbours.
                    edges = np.flatnonzero(np.diff(context, prepend=~context[:1]))
                    gram_file.add(_row_hash(grams), count=counts)
                    context_file.add(
                        context[edges],
                        total=np.add.reduceat(counts, edges),
                        one=np.add.reduceat((counts == 1).astype(np.int64), edges),
                        two=np.add.reduceat((counts == 2).astype(np.int64), edges),
                        more=np.add.reduceat((counts > 2).astype(np.int64), edges),
                    )
                    sizes = {"shard": shard, "rows": len(counts), "contexts": len(edges)}
                    yield _level_row(
                        sizes | {n: int((counts == i + 1).sum()) for i, n in enumerate(_SMALL)}
                    )
                    if lower.add(grams[1:]):
                        yield from dealt(lower)
        yield from dealt(lower)

    return build


def _level_row(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([row], schema=_LEVEL_SCHEMA)


_SMALL = ("ones", "twos", "threes", "fours")
# The sizes of a shard, or n-grams of the next lower level for one of its shards.
_LEVEL_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("shard", "rows", "contexts", *_SMALL)]
    + [("grams", pa.binary()), ("counts", pa.binary())]
)
_LEVEL = (
    "shard long, rows long, contexts long, ones long, twos long, threes long, fours long, "
    "grams binary, counts binary"
)


def _lowest(packed: DataFrame, vocabulary: HashTable, folder: str) -> Level:
    """Continuation counts of single words, in arrays beside those of the vocabulary's shards."""
    per_file = vocabulary.per_file

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, of_file in _files(batches, per_file):
            with ShardWriter(folder, "gram1", number) as file:
                for shard, parts in of_file:
                    first, size = int(vocabulary.starts[shard]), vocabulary.sizes[shard]
                    dense = np.zeros(size, dtype=np.int64)
                    for part in parts:
                        for grams, counts in _unpacked(part, 1):
                            np.add.at(dense, grams[0].astype(np.int64) - first, counts)
                    file.add_values(count=dense)
                    row = {"shard": shard, "rows": size, "total": int(dense.sum())}
                    row |= {n: int((dense == i + 1).sum()) for i, n in enumerate(_SMALL)}
                    row["more"] = int((dense > 2).sum())
                    yield pa.RecordBatch.from_pylist([row])

    schema = "shard long, rows long, total long, " + ", ".join(f"{n} long" for n in _SMALL)
    rows = _by_file(packed, per_file, build, schema + ", more long").collect()
    sums = {n: sum(r[n] for r in rows) for n in ("total", *_SMALL, "more")}
    sizes = [0] * len(vocabulary.sizes)
    for r in rows:
        sizes[r["shard"]] = r["rows"]
    return Level(
        _discounts(*(sums[n] for n in _SMALL)),
        HashTable(folder, "gram1", sizes, ["count"], per_file),
        None,
        sums["total"],
        (sums["ones"], sums["twos"], sums["more"]),
    )


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < x < i + 1 for i, x in enumerate(d)):
            return d
    return (0.5, 1.0, 1.5)


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (columns) in the order of their words, and their summed counts."""
    key = _ordered_keys(grams)
    order = np.argsort(key) if key is not None else np.lexsort(grams[::-1])
    new = np.ones(len(order), dtype=bool)
    if key is not None:
        key = key[order]
        new[1:] = key[1:] != key[:-1]
    else:
        new[1:] = (grams[:, order[1:]] != grams[:, order[:-1]]).any(axis=0)
    edges = np.flatnonzero(new)
    counts = counts[order]
    return grams[:, order[edges]], np.add.reduceat(counts, edges) if len(edges) else counts


def _ordered_keys(grams: np.ndarray) -> np.ndarray | None:
    """One number for each n-gram, in the order of its words; None if they are too many for it.

    Where the words' bits do not fit, the ranks of the words before take the place of these.
    """
    key = grams[0].astype(np.uint64)
    if len(grams) == 1:
        return key
    bits = int(grams.max(initial=0)).bit_length()
    if bits > 32 or len(key) > LARGEST_SHORT:
        return None
    used = bits
    for row in grams[1:]:
        if used + bits > 64:
            key, used = _ranks(key), len(key).bit_length()
        key = (key << np.uint64(bits)) | row.astype(np.uint64)
        used += bits
    return key


def _ranks(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    rank = np.empty(len(key), dtype=np.uint64)
    ordered = key[order]
    rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1]) != 0)
    return rank


class _Grams:
    """Counts of n-grams of one task, added a chunk at a time."""

    FULL = 2_500_000  # rows at which the task hands on what it has, to bound its memory

    def __init__(self, k: int):
        self.k, self.parts, self.rows = k, [], 0

    def add(self, grams: np.ndarray, counts: np.ndarray | None = None) -> bool:
        """True when full."""
        if counts is None:
            counts = np.ones(grams.shape[1], dtype=np.int64)
        self.parts.append(_summed(grams, counts))
        self.rows += self.parts[-1][0].shape[1]
        return self.rows > self.FULL

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams and their counts; starts afresh."""
        if not self.parts:
            return np.zeros((self.k, 0), dtype=np.uint32), np.zeros(0, dtype=np.int64)
        grams = np.concatenate([p[0] for p in self.parts], axis=1)
        counts = np.concatenate([p[1] for p in self.parts])
        self.parts, self.rows = [], 0
        return _summed(grams, counts)


# -- scoring ------------------------------------------------------------------------------


def _scored(texts: list[bytes], model: Model) -> tuple[np.ndarray, ...]:
    ids, seen, at, counts = _sequences(texts, model.vocabulary, model.order)
    first = np.cumsum(counts) - counts
    seen = seen[at]
    size = len(model.vocabulary)
    base = np.log10((seen + 0.5) / (model.tokens + 0.5 * (size + 1)))
    chance = np.full(len(at), 1 / (size + 1))
    for k, level in enumerate(model.levels, start=1):
        grams = np.stack([ids[at - k + 1 + i] for i in range(k)])
        if k == 1:
            count = level.table.at(grams[0].astype(np.int64), "count")
            total, seen_few = level.total, level.seen
        else:
            context = _context_hash(grams)
            _, count = level.table.find(_row_hash(grams), "count", route=context)
            # A context of one word comes many times in a chunk.
            distinct, which = np.unique(context, return_inverse=True) if k == 2 else (context, ...)
            _, *sums = level.contexts.find(distinct, "total", "one", "two", "more")
            total, *seen_few = (s[which] for s in sums)
        chance = _interpolated(level.discounts, count, total, seen_few, chance)
    score_sum = np.add.reduceat(np.log10(chance), first)
    known = np.add.reduceat((seen > 0).astype(np.int64), first)
    tokens = np.full(len(counts), model.tokens)
    return counts, known, tokens, np.add.reduceat(base, first), score_sum


def _interpolated(discounts, count, total, seen, lower: np.ndarray) -> np.ndarray:
    """max(c - D(c), 0) / total + (sum of D_i N_i) / total * lower; lower where total is 0."""
    table = np.array([0.0, *discounts])
    left = count - table[np.minimum(count, 3)]
    weight = sum(d * n for d, n in zip(discounts, seen, strict=True))
    some = np.maximum(total, 1)
    return np.where(np.equal(total, 0), lower, (left + weight * lower) / some)
