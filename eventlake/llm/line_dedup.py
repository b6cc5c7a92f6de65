"""Line dedup: documents probe a sharded minimal perfect hash over all distinct line keys.

A line's key is the line without white space at its ends (space, tab to carriage return), A-Z
lower-cased. A key of at least ``min_chars`` code points that is in at least ``min_docs``
documents loses all its lines except those of the document with the largest id.

1. Tasks reduce every document to its distinct key hashes; a map-side combined group-by counts
   documents and finds the largest id, so a line on a third of all rows sends one row per task.
2. Each shard of hashes becomes a minimal perfect hash that indexes three arrays in the shared
   folder: a fingerprint from a second hash, the count, and the id that keeps the line.
3. Documents probe the memory-mapped arrays. Lines are neither shuffled nor joined again.

Keys are told apart by 64-bit hashes. The fingerprint turns away lines that were not counted,
when other documents than the counted ones are cleaned.

Defined cases: a null or empty text is one empty line and is returned as it is. Rows that share a
doc_id are documents of their own, and all of them keep the line if theirs is the largest id. A
null doc_id is below every other; a line that only such rows hold stays. Other columns are
passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm import perfect_hash
from eventlake.llm.shared import load_array, prepare, save_array, scratch, stored
from eventlake.llm.tokens import CHAR_START, NOT_WHITE, Texts, as_bytes, chunks, owners

MIN_CHARS, MIN_DOCS = 40, 5
KEYS_PER_SHARD = 400_000
MAX_COUNT = 65_535  # counts above are stored as this; min_docs must not exceed it
NO_KEEPER = np.iinfo(np.int64).min
INDEX_ARRAYS = ("levels", "bits", "rank", "print", "count", "keeper")
REPORT = T.StructType(
    [
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("kept_text", T.StringType()),
    ]
)


class LineIndex:
    """The stored arrays: ``folder/<shard>-<array>.npy`` for each of ``shards`` shards."""

    def __init__(self, folder: str, shards: int, min_chars: int, min_docs: int):
        self.folder, self.shards = folder, shards
        self.min_chars, self.min_docs = min_chars, min_docs

    def shard(self, number: int) -> dict[str, np.ndarray]:
        return {name: load_array(self.folder, f"{number}-{name}") for name in INDEX_ARRAYS}

    def dropped(self, keys: np.ndarray, prints: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """True for lines that their document, given by id, must give up."""
        drop = np.zeros(len(keys), dtype=bool)
        home = shard_of(keys, self.shards)
        order = np.argsort(home, kind="stable")
        edges = np.searchsorted(home[order], np.arange(self.shards + 1))
        for number in np.flatnonzero(np.diff(edges)):
            at = order[edges[number] : edges[number + 1]]
            arrays = self.shard(int(number))
            index = perfect_hash.lookup(arrays, keys[at])
            at, index = at[index >= 0], index[index >= 0]
            known = arrays["print"][index] == prints[at]
            at, index = at[known], index[known]
            keeper = arrays["keeper"][index]
            often = arrays["count"][index] >= self.min_docs
            drop[at] = often & (keeper != NO_KEEPER) & (keeper != ids[at])
        return drop


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def build_line_index(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> LineIndex:
    """Count the lines of ``docs`` (doc_id, text) and store the arrays in the shared folder."""
    if not 1 <= min_docs <= MAX_COUNT:
        raise ValueError(f"min_docs must be from 1 to {MAX_COUNT}")
    spark = docs.sparkSession
    prepare(spark)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _parts(batches):
            lines = _Lines(texts, min_chars)
            order = np.lexsort((lines.keys, lines.text))
            key, text = lines.keys[order], lines.text[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
            yield pa.record_batch(
                {
                    "key": key[new].view(np.int64),
                    "print": lines.prints[order][new].astype(np.int64),
                    "doc_id": ids.take(pa.array(text[new])),
                }
            )

    counted = stored(
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(keys, "key long, print long, doc_id long")
        .groupBy("key")
        .agg(
            F.max("print").alias("print"),
            F.least(F.count(F.lit(1)), F.lit(MAX_COUNT)).alias("count"),
            F.max("doc_id").alias("keeper"),
        ),
        "line-counts",
    )
    shards = max(1, -(-counted.count() // KEYS_PER_SHARD))
    folder = scratch(spark, "line-index")

    def build(table: pa.Table) -> pa.Table:
        key = table["key"].to_numpy().view(np.uint64)
        number = int(shard_of(key[:1], shards)[0])
        function = perfect_hash.build(key)
        place = perfect_hash.lookup(function, key)
        columns = {
            "print": table["print"].to_numpy().astype(np.uint32),
            "count": table["count"].to_numpy().astype(np.uint16),
            "keeper": table["keeper"].fill_null(NO_KEEPER).to_numpy(),
        }
        for name, values in columns.items():
            function[name] = np.empty_like(values)
            function[name][place] = values
        for name in INDEX_ARRAYS:
            save_array(folder, f"{number}-{name}", function[name])
        return pa.table({"shard": [number], "keys": [len(key)]})

    shard = F.pmod(F.shiftrightunsigned("key", 32), F.lit(shards))
    built = counted.groupBy(shard.alias("shard")).applyInArrow(build, "shard long, keys long")
    present = {row["shard"] for row in built.collect()}
    for number in set(range(shards)) - present:
        empty = perfect_hash.build(np.zeros(0, dtype=np.uint64))
        none = np.zeros(0, dtype=np.int64)
        for name, values in (empty | {"print": none, "count": none, "keeper": none}).items():
            save_array(folder, f"{number}-{name}", values)
    return LineIndex(folder, shards, min_chars, min_docs)


def drop_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """All columns of ``docs`` and n_lines, n_dropped, kept_sha256, kept_text."""
    prepare(docs.sparkSession)
    clash = [c for c in REPORT.fieldNames() if c in docs.columns]
    docs = docs.drop(*clash)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            ids = batch["doc_id"].cast(pa.int64()).fill_null(NO_KEEPER)
            ids = ids.to_numpy(zero_copy_only=False)
            rows = []
            for start, stop in chunks(texts):
                rows += _cleaned(texts[start:stop], ids[start:stop], index)
            whole = batch["text"].to_pylist()
            kept = [t if r[3] is None else r[3].decode() for t, r in zip(whole, rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.string()),
                    pa.array(kept, pa.string()),
                ],
                names=[*batch.schema.names, *REPORT.fieldNames()],
            )

    return docs.mapInArrow(clean, T.StructType([*docs.schema.fields, *REPORT.fields]))


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``drop_lines`` by an index over the same documents."""
    return drop_lines(docs, build_line_index(docs, min_chars, min_docs))


class _Lines:
    """Lines of a chunk of texts whose keys are long enough."""

    def __init__(self, texts: list[bytes], min_chars: int):
        chunk = Texts(texts)
        data = chunk.bytes
        breaks = np.flatnonzero(data == 0x0A) if texts else np.zeros(0, dtype=np.int64)
        begin = np.append(0, breaks + 1)
        end = np.append(breaks, len(data))
        if not texts:
            begin = end = breaks
        self.begin, self.end = begin, end
        self.counts = chunk.counts(begin)
        solid = np.flatnonzero(NOT_WHITE[data])
        first, last = np.searchsorted(solid, begin), np.searchsorted(solid, end)
        filled = first < last
        low, high = begin.copy(), begin.copy()
        low[filled] = solid[first[filled]]
        high[filled] = solid[last[filled] - 1] + 1
        points = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(CHAR_START[data], out=points[1:])
        self.long = np.flatnonzero(filled & (points[high] - points[low] >= min_chars))
        low, high = low[self.long], high[self.long]
        self.keys = chunk.hashes(low, high)
        self.prints = chunk.hashes(low, high, seed=1) >> np.uint64(32)
        self.text = owners(self.counts)[self.long]
        self.raw = chunk.raw


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    for batch in batches:
        texts = as_bytes(batch["text"])
        for start, stop in chunks(texts):
            yield batch["doc_id"].slice(start, stop - start), texts[start:stop]


def _cleaned(texts: list[bytes], ids: np.ndarray, index: LineIndex) -> list[tuple]:
    """Per text: lines, lines dropped, digest of the rest, and the rest (None: the whole text)."""
    lines = _Lines(texts, index.min_chars)
    gone = index.dropped(lines.keys, lines.prints, ids[lines.text])
    dropped = np.zeros(len(lines.begin), dtype=bool)
    dropped[lines.long[gone]] = True
    losses = np.bincount(lines.text[gone], minlength=len(texts))
    rows, first = [], 0
    for i, text in enumerate(texts):
        n = int(lines.counts[i])
        kept = None
        if losses[i]:
            stay = first + np.flatnonzero(~dropped[first : first + n])
            kept = b"\n".join(lines.raw[lines.begin[j] : lines.end[j]] for j in stay)
        digest = hashlib.sha256(text if kept is None else kept).hexdigest()
        rows.append((n, int(losses[i]), digest, kept))
        first += n
    return rows
