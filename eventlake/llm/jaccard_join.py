"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII; a document's
set has its distinct n-grams of five words, or its one shorter n-gram. Two documents are linked if
the Jaccard similarity of their sets is at least the threshold.

1. Each document becomes a digest of its set and the hashes of its bands. The numbers of bands and
   rows follow from the recall wanted at the threshold (``banding``).
2. Documents of equal sets are one node, so copies are neither compared nor expanded.
3. Nodes are shuffled on their band hashes. Every band hash ties its nodes to the least of them,
   and the components of these ties are the candidate groups: they hold every pair that shares a
   band, and each pair once.
4. Each group's texts come together, small groups packed, large ones in pairs of blocks, so that
   a task holds at most two blocks. It builds the full sets and decides every pair of nodes. Only
   a count per node and a spanning tree of the links leave the task.
5. Components of the links give the classes; copies are added to the counts.

A group of g different texts costs g*g/2 set comparisons, as exact link counts of it must; they
are products of small incidence matrices, and their pairs are never rows.

Defined cases: a document without words has no links and is a class of its own, named by its id.
Rows that share a doc_id are documents of their own. Null ids are compared too; a class's id is
the least id in it, null if it has none. Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.components import connected_components
from eventlake.llm.shared import broadcast_if_small, prepare, stored
from eventlake.llm.tokens import ALNUM, Texts, as_bytes, chunks, distinct, mix, ngrams

WORDS, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 128
BLOCK = 128  # nodes of a large group in one block
COLUMNS = 8192  # n-grams in one step of the incidence product


def banding(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands find the recall within the number of hashes."""
    if not 0 < threshold < 1 or not 0 < recall < 1:
        raise ValueError("threshold and recall must be between 0 and 1")
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall within max_hashes")
    return best


def sketches(
    docs: DataFrame,
    *,
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    max_hashes: int = MAX_HASHES,
) -> DataFrame:
    """(doc_id, node, bands): digest of the n-gram set, null without words, and band hashes."""
    bands, rows = banding(threshold, recall, max_hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            for a, b in chunks(texts):
                value, text, first, filled = _sets(texts[a:b], words)
                node = np.zeros(b - a, dtype=np.uint64)
                hashes = np.zeros((b - a, bands), dtype=np.uint64)
                if len(first):
                    node[filled] = _digest(value, first)
                    hashes[filled] = _bands(value, first, bands, rows)
                empty = np.ones(b - a, dtype=bool)
                empty[filled] = False
                offsets = np.arange(b - a + 1, dtype=np.int32) * bands
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].slice(a, b - a).cast(pa.int64()),
                        "node": pa.array(node.view(np.int64), mask=empty),
                        "bands": pa.ListArray.from_arrays(
                            pa.array(offsets), pa.array(hashes.ravel().view(np.int64))
                        ),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, node long, bands array<long>"
    )


def jaccard_links(
    docs: DataFrame,
    *,
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    max_hashes: int = MAX_HASHES,
) -> DataFrame:
    """One row per document: doc_id, class_id and n_links, the number of documents linked to it."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    options = {"words": words, "threshold": threshold, "recall": recall, "max_hashes": max_hashes}
    sketched = stored(sketches(docs, **options), "sketches")
    nodes = stored(
        sketched.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("doc_id").alias("least_id"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    groups = _candidate_groups(nodes)
    found = stored(_verified(docs, nodes, groups, words, threshold), "links")
    classes = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        nodes.select("node", "copies", "least_id")
        .join(links, "node", "left")
        .join(classes, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = stored(named, "classes")
    names = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    result = named.join(names, "root").select(
        "node",
        "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return (
        sketched.select("doc_id", "node")
        .join(result, "node", "left")
        .select(
            "doc_id",
            F.when(F.col("node").isNull(), F.col("doc_id"))
            .otherwise(F.col("class_id"))
            .alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def _candidate_groups(nodes: DataFrame) -> DataFrame:
    """(node, root) for every node that shares a band with another."""
    rows = nodes.select("node", F.explode("bands").alias("band"))
    buckets = (
        rows.groupBy("band")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .where("least < most")
        .select("band", "least")
    )
    ties = rows.join(buckets, "band").where("node <> least")
    return connected_components(ties.select(F.col("node").alias("a"), F.col("least").alias("b")))


def _verified(
    docs: DataFrame, nodes: DataFrame, groups: DataFrame, words: int, threshold: float
) -> DataFrame:
    """(node, root, links) per task and node that has links there."""
    groups = stored(groups, "groups")
    # Only groups of more than a block need their size known: few rows, whatever the groups are.
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK)
    large = broadcast_if_small(stored(sizes, "large-groups"))
    members = groups.join(large, "root", "left").join(
        nodes.select("node", "copies", "least_id"), "node"
    )
    # A node's text is that of its least id (of all null ids, if it has no other).
    texts = docs.join(
        members.select("least_id").distinct(),
        F.col("doc_id").eqNullSafe(F.col("least_id")),
        "left_semi",
    )

    def own_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = as_bytes(batch["text"])
            for a, b in chunks(column):
                value, _, first, filled = _sets(column[a:b], words)
                if len(first):
                    yield pa.record_batch(
                        {
                            "node": _digest(value, first).view(np.int64),
                            "text": batch["text"].slice(a, b - a).take(pa.array(filled)),
                        }
                    )

    first_text = texts.select("text").mapInArrow(own_node, "node long, text string")
    blocks = F.ceil(F.col("size") / BLOCK)
    small = F.col("size").isNull()
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), (blocks - 1).cast("int")),
        lambda other: F.concat_ws("-", F.least(mine, other), F.greatest(mine, other)),
    )
    total = members.count()
    packs = max(1, -(-total // BLOCK))
    placed = members.select(
        "node",
        "root",
        "copies",
        F.when(small, F.concat(F.lit("p"), F.pmod(F.xxhash64("root"), F.lit(packs))))
        .otherwise(F.lit(None))
        .alias("pack"),
        F.when(small, F.array(F.lit(None).cast("string"))).otherwise(pairs).alias("pairs"),
        F.when(~small, mine).alias("block"),
    )
    rows = (
        placed.join(first_text, "node")
        .select("node", "root", "copies", "block", "text", "pack", F.explode("pairs").alias("pair"))
        .select(
            "node",
            "root",
            "copies",
            "block",
            "text",
            "pair",
            F.coalesce("pack", F.concat_ws("-", "root", "pair")).alias("task"),
        )
    )
    width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), packs // 8)

    def decide(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        _, kept = np.unique(node, return_index=True)  # equal sets: any of the texts will do
        table = table.take(pa.array(kept))
        node, root = table["node"].to_numpy(), table["root"].to_numpy()
        copies = table["copies"].to_numpy()
        texts = as_bytes(table["text"].combine_chunks())
        block = table["block"].fill_null(-1).to_numpy()
        pair = table["pair"][0].as_py()
        crossing = pair is not None and len(set(pair.split("-"))) == 2
        out = []
        order = np.argsort(root, kind="stable")
        edges = np.flatnonzero(np.diff(root[order], prepend=~root[order][:1]))
        for part in np.split(order, edges[1:]):
            linked = _linked([texts[i] for i in part], words, threshold)
            if crossing:  # pairs within a block are counted by the block's own task
                linked &= block[part][:, None] != block[part][None, :]
            out.append((node[part], _roots(linked, node[part]), linked @ copies[part]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        some = columns[2] > 0
        names = ("node", "root", "links")
        return pa.table({n: c[some] for n, c in zip(names, columns, strict=True)})

    return (
        rows.repartition(width, "task")
        .groupBy("task")
        .applyInArrow(decide, "node long, root long, links long")
    )


def _sets(texts: list[bytes], words: int):
    """Distinct n-gram hashes by text, each set's begin, and the texts that have any."""
    hashes, counts = Texts(texts).words(ALNUM)
    value, text = distinct(*ngrams(hashes, counts, words))
    first = np.flatnonzero(np.diff(text, prepend=-1))
    return value, text, first, text[first]


def _digest(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set, from a sum, an exclusive or and the size."""
    total = np.add.reduceat(mix(value), first)
    other = np.bitwise_xor.reduceat(value, first)
    size = np.diff(np.append(first, len(value))).astype(np.uint64)
    return mix(mix(total + size) ^ other)


def _bands(value: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64))
    out = np.empty((len(first), bands), dtype=np.uint64)
    for band in range(bands):
        total = np.full(len(first), seeds[band])
        for row in range(rows):
            seed = seeds[band * rows + row]
            low = np.minimum.reduceat((value ^ seed) * (seed | np.uint64(1)), first)
            total = mix(total ^ mix(low)) + seed
        out[:, band] = total
    return out


def _linked(texts: list[bytes], words: int, threshold: float) -> np.ndarray:
    """Matrix: which different texts have similar sets."""
    n = len(texts)
    parts = [_sets(texts[a:b], words)[:2] + (a,) for a, b in chunks(texts)]
    value = np.concatenate([p[0] for p in parts])
    owner = np.concatenate([p[1] + p[2] for p in parts])
    size = np.bincount(owner, minlength=n)
    common = np.zeros((n, n), dtype=np.float64)
    grams, column, times = np.unique(value, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    rank = np.cumsum(times > 1) - 1
    owner, column = owner[shared], rank[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int((times > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        incidence = np.zeros((n, min(COLUMNS, int(column[b - 1]) - start + 1)), dtype=np.float32)
        incidence[owner[a:b], column[a:b] - start] = 1
        common += incidence @ incidence.T
    union = size[:, None] + size[None, :] - common
    linked = common / np.maximum(union, 1) >= threshold
    np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The least node that each can reach."""
    root, top = node.copy(), np.iinfo(np.int64).max
    while True:
        least = np.where(linked, root[None, :], top).min(axis=1, initial=top)
        new = np.minimum(root, least)
        if (new == root).all():
            return root
        root = new
