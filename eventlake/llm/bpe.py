"""BPE encoding and decoding through a table of distinct words.

A word is a run of white space with the text after it, cut only between a character that is surely
no white space and an ASCII white space. The tokenizer's own splits always include these places,
so the ids of a text are those of its words in order.

1. Tasks split blocks of whole texts into words. A block becomes one list of its distinct words
   and, per text, the numbers of its words: a frequent word appears once per block, whatever its
   share of the text.
2. The blocks' words are shuffled by a hash of the word, packed as one row per block and part of
   the hashes, and taken part by part. There each distinct word is encoded once, and its ids go
   back, packed the same way, to every block that has it. There are as many parts as the texts
   have ``PART_BYTES``, so what a task holds at once does not grow with the corpus.
3. There they are joined to the texts' words by number, in position order. Ids become bytes again
   by the id-to-piece table, which has as many rows as the vocabulary.

Words are numbered by the order of their hashes, so the side that needs positions makes no word
and the side that needs words makes no positions. Blocks are known by a digest of their texts, so
a recomputed block fits its words. The documents are read twice and must come in the same order,
as those of a stored table do. Words of a block are told apart by 64-bit hashes.

Defined cases: a null or empty text has no ids and decodes to the empty text. Repeated rows and
ids are rows of their own. Other columns are passed on; clashing ones are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventlake.llm.shared import prepare
from eventlake.llm.tokens import WHITE, Texts, as_bytes, chunks

BLOCK_BYTES = 8 << 20
# Text bytes a part of the word table stands for.
PART_BYTES = 24 << 20
# Texts and bytes of them that the library encodes in one call: its results take a multiple of them.
CALL_TEXTS, CALL_BYTES = 4_096, 256 << 10
# Bytes that stand for themselves in the pieces of byte-level vocabularies.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@functools.lru_cache(maxsize=4)
def pieces(path: str) -> list[bytes]:
    """The bytes each id stands for; special tokens stand for their own text."""
    loaded = tokenizer(path)
    byte_of = {chr(b): b for b in _PRINTABLE}
    others = (b for b in range(256) if b not in _PRINTABLE)
    byte_of |= {chr(256 + i): b for i, b in enumerate(others)}
    table = [b""] * loaded.get_vocab_size()
    special = loaded.get_added_tokens_decoder()
    for piece, i in loaded.get_vocab().items():
        whole = i in special or any(c not in byte_of for c in piece)
        table[i] = piece.encode() if whole else bytes(byte_of[c] for c in piece)
    return table


def encode_ids(library, texts: list[str]) -> Iterator[np.ndarray]:
    """The ids of each text, by calls of a bounded size."""
    start, size = 0, 0
    for i, text in enumerate(texts, start=1):
        size += len(text)
        if size >= CALL_BYTES or i - start == CALL_TEXTS or i == len(texts):
            for result in library.encode_batch_fast(texts[start:i], add_special_tokens=False):
                yield np.array(result.ids, dtype=np.int32)
            start, size = i, 0


def word_edges(data: np.ndarray) -> np.ndarray:
    """Places in the bytes of a text, or of joined texts, where a word may begin.

    White space beyond ASCII has two or three bytes. Where the bytes before the place could end
    such a character, the place is left out, which only makes a word longer.
    """
    n = len(data)
    padded = np.concatenate((np.zeros(3, dtype=np.uint8), data))
    before, two, three = padded[2 : n + 2], padded[1 : n + 1], padded[:n]
    doubtful = (two == 0xC2) & ((before == 0x85) | (before == 0xA0))
    doubtful |= (three >= 0xE1) & (three <= 0xE3) & np.isin(two, (0x80, 0x81, 0x9A))
    doubtful |= (before >= 0x1C) & (before <= 0x1F)
    cut = WHITE[data] & ~WHITE[before] & ~doubtful
    cut[:1] = False
    return np.flatnonzero(cut)


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of a block, numbers of all words in order, and words per text."""
    block = _Block(texts)
    return block.words(), block.positions, block.counts


def _word_spans(chunk: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word of a chunk of texts, and words per text."""
    # The newline between two texts may look like the begin of a word.
    inner = np.setdiff1d(word_edges(chunk.bytes), chunk.end[:-1])
    begin = np.union1d(inner, chunk.begin[chunk.end > chunk.begin])
    counts = chunk.counts(begin)
    end = np.minimum(np.append(begin[1:], len(chunk.bytes)), np.repeat(chunk.end, counts))
    return begin, end, counts


def encode(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs`` with ``ids`` (array<int>)."""

    def finish(positions: np.ndarray, counts: np.ndarray, ids: _Ids) -> dict[str, pa.Array]:
        flat = ids.flat.tobytes()
        spans = zip((4 * ids.begins).tolist(), (4 * ids.ends).tolist(), strict=True)
        raw = [flat[a:b] for a, b in spans]
        joined = np.frombuffer(b"".join([raw[i] for i in positions.tolist()]), dtype=np.int32)
        sizes = np.append(0, np.cumsum(_per_text(ids.sizes, positions, counts)))
        return {"ids": pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(joined))}

    return _by_words(docs, path, "ids array<int>", finish)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """The columns of ``docs`` but the text, and n_tokens with two digests of each text's round
    trip: of its decimal ids joined by commas, and of the text decoded from them."""

    def finish(positions: np.ndarray, counts: np.ndarray, ids: _Ids) -> dict[str, pa.Array]:
        edges = np.append(0, np.cumsum(counts)).tolist()
        at = positions.tolist()

        def digests(table: list[bytes], trim: int) -> pa.Array:
            """Of each text, whose ids stand for the entries of a table."""
            flat = ids.flat.tolist()
            spans = zip(ids.begins.tolist(), ids.ends.tolist(), strict=True)
            words = [b"".join([table[i] for i in flat[a:b]]) for a, b in spans]
            found = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                joined = b"".join([words[i] for i in at[a:b]])
                found.append(_digest(joined[:-1] if trim else _valid(joined)))
            return pa.array(found, pa.string())

        return {
            "n_tokens": pa.array(_per_text(ids.sizes, positions, counts)),
            "ids_sha256": digests(_decimals(path), trim=1),
            "decoded_sha256": digests(pieces(path), trim=0),
        }

    names = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _by_words(docs, path, names, finish, keep_text=False)


@functools.lru_cache(maxsize=4)
def _decimals(path: str) -> list[bytes]:
    """Each id as it is written, with a comma after it."""
    return [b"%d," % i for i in range(len(pieces(path)))]


def decode(rows: DataFrame, path: str) -> DataFrame:
    """All columns of ``rows`` with ``decoded``, the text of the ids in the column ``ids``."""
    prepare(rows.sparkSession)
    rows = rows.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        for batch in batches:
            joined = [b"".join([table[i] for i in ids or ()]) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_valid(x).decode() for x in joined], pa.string())],
                names=[*batch.schema.names, "decoded"],
            )

    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, schema)


class _Ids:
    """Ids of a block's words, one word's after the other's by number."""

    def __init__(self, sizes: np.ndarray, flat: np.ndarray):
        self.sizes, self.flat = sizes, flat
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.begins = self.ends - sizes


Finish = Callable[[np.ndarray, np.ndarray, _Ids], dict[str, pa.Array]]


def _by_words(
    docs: DataFrame, path: str, added: str, finish: Finish, keep_text: bool = True
) -> DataFrame:
    """Columns made from the positions of a block's words, the words per text and their ids."""
    prepare(docs.sparkSession)
    new = T.StructType.fromDDL(added)
    docs = docs.drop(*new.fieldNames())
    passed = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType([*passed, *new.fields])
    names, arrow_schema = [f.name for f in passed], to_arrow_schema(schema)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_BYTES))

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            yield pa.record_batch(
                {
                    "block": pa.array([block.name], pa.string()),
                    "rows": pa.array([_ipc(rows.select(names))], pa.binary()),
                    "counts": pa.array([_packed(block.counts)], pa.binary()),
                    "positions": pa.array([_packed(block.positions)], pa.binary()),
                }
            )

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in _blocks(batches):
            home = (block.hashes >> np.uint64(32)) % np.uint64(parts)
            order = np.argsort(home, kind="stable")
            edges = np.searchsorted(home[order], np.arange(parts + 1, dtype=np.uint64))
            every = block.words()
            for part in np.flatnonzero(np.diff(edges)):
                numbers = order[edges[part] : edges[part + 1]]  # ascending
                words = [every[i] for i in numbers.tolist()]
                yield pa.record_batch(
                    {
                        "part": pa.array([int(part)], pa.int32()),
                        "block": pa.array([block.name], pa.string()),
                        "numbers": pa.array([_packed(np.diff(numbers, prepend=0))], pa.binary()),
                        "sizes": pa.array([_packed(np.array(list(map(len, words))))], pa.binary()),
                        "words": pa.array([zstandard.compress(b"".join(words), 3)], pa.binary()),
                    }
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of the words, row by row; each distinct word of a part is encoded once."""
        library, part, known = tokenizer(path), None, {}
        for row in (r for batch in batches for r in batch.to_pylist()):
            if row["part"] != part:
                part, known = row["part"], {}
            ends = np.cumsum(_unpacked(row["sizes"])).tolist()
            joined = zstandard.decompress(row["words"])
            words = [joined[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            todo = [w for w in dict.fromkeys(words) if w not in known]
            results = encode_ids(library, [w.decode() for w in todo])
            for word, found in zip(todo, results, strict=True):
                known[word] = found.tobytes()
            ids = [known[w] for w in words]
            yield pa.record_batch(
                {
                    "block": pa.array([row["block"]]),
                    "numbers": pa.array([row["numbers"]]),
                    "sizes": pa.array([_packed(np.array(list(map(len, ids))) // 4)]),
                    "ids": pa.array([_packed(np.frombuffer(b"".join(ids), dtype=np.int32))]),
                }
            )

    def join_back(texts: pa.Table, words: pa.Table) -> pa.Table:
        ids = _gathered(words)
        made_parts = []
        for row in texts.to_pylist():  # more than one where blocks have the same texts
            rows = pa.ipc.open_stream(row["rows"]).read_all()
            made = finish(_unpacked(row["positions"]), _unpacked(row["counts"]), ids)
            for name, column in made.items():
                rows = rows.append_column(name, column)
            made_parts.append(rows.cast(arrow_schema))
        return pa.concat_tables(made_parts) if made_parts else arrow_schema.empty_table()

    blocks = docs.mapInArrow(
        texts_of, "block string, rows binary, counts binary, positions binary"
    )
    words = (
        docs.select("text")
        .mapInArrow(
            words_of, "part int, block string, numbers binary, sizes binary, words binary"
        )
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(encoded, "block string, numbers binary, sizes binary, ids binary")
    )
    together = blocks.groupBy("block").cogroup(words.groupBy("block"))
    return together.applyInArrow(join_back, schema)


def _gathered(words: pa.Table) -> _Ids:
    """The ids of a block from the rows of its parts; blocks with the same texts repeat them."""
    rows = words.to_pylist()
    numbers = [np.cumsum(_unpacked(row["numbers"])) for row in rows]
    sizes = [_unpacked(row["sizes"]).astype(np.int64) for row in rows]
    total = np.zeros(max((int(n[-1]) + 1 for n in numbers if len(n)), default=0), dtype=np.int64)
    for number, size in zip(numbers, sizes, strict=True):
        total[number] = size
    begin = np.cumsum(total) - total
    flat = np.zeros(int(total.sum()), dtype=np.int32)
    for number, size, row in zip(numbers, sizes, rows, strict=True):
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        flat[np.repeat(begin[number], size) + inside] = _unpacked(row["ids"])
    return _Ids(total, flat)


class _Block:
    """Words of a block of texts: hashes of the distinct ones in order, the numbers of all of them
    as they come, and words per text."""

    def __init__(self, texts: list[bytes]):
        self._chunks, hashes, counts = [], [], []
        digest = hashlib.blake2b(digest_size=16)
        for a, b in chunks(texts):
            chunk = Texts(texts[a:b], lower=False)
            begin, end, count = _word_spans(chunk)
            self._chunks.append((chunk.raw, begin, end))
            hashes.append(chunk.hashes(begin, end))
            counts.append(count)
            digest.update(np.array([len(t) for t in texts[a:b]]).tobytes())
            digest.update(b"".join(texts[a:b]))
        self.name = digest.hexdigest()
        self.hashes, self._first, self.positions = np.unique(
            np.concatenate([np.zeros(0, np.uint64), *hashes]), return_index=True, return_inverse=True
        )
        self.counts = np.concatenate([np.zeros(0, np.int32), *counts]).astype(np.int32)

    def words(self) -> list[bytes]:
        """The distinct words, by number."""
        found: list[bytes] = [b""] * len(self.hashes)
        start = 0
        for raw, begin, end in self._chunks:
            here = np.flatnonzero((self._first >= start) & (self._first < start + len(begin)))
            at = self._first[here] - start
            spans = zip(here.tolist(), begin[at].tolist(), end[at].tolist(), strict=True)
            for number, a, b in spans:
                found[number] = raw[a:b]
            start += len(begin)
        return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, pa.Table]]:
    """Blocks of whole rows. They end where the texts so far reach BLOCK_BYTES, however the rows
    are cut into batches, so that every reading of the same rows gives the same blocks."""
    gathered, texts, size = [], [], 0
    for batch in batches:
        column, start = as_bytes(batch["text"]), 0
        for i, text in enumerate(column, start=1):
            size += len(text)
            if size >= BLOCK_BYTES:
                gathered.append(batch.slice(start, i - start))
                yield _Block(texts + column[start:i]), pa.Table.from_batches(gathered)
                gathered, texts, size, start = [], [], 0, i
        if start < len(column):
            gathered.append(batch.slice(start))
            texts += column[start:]
    if gathered:
        yield _Block(texts), pa.Table.from_batches(gathered)


def _per_text(values: np.ndarray, positions: np.ndarray, counts: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values[positions], dtype=np.int64))
    ends = np.cumsum(counts, dtype=np.int64)
    return sums[ends] - sums[ends - counts]


def _packed(numbers: np.ndarray) -> bytes:
    """Compressed byte planes of 32-bit numbers."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _valid(data: bytes) -> bytes:
    """The bytes as UTF-8; what is not, replaced."""
    return data.decode("utf-8", "replace").encode()


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
