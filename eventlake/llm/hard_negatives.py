"""Hard negatives: rows of other labels that score just below an anchor's positives.

A row's score is its integer inner product with the anchor, of components ``floor(256 * x)``;
higher scores come first, ties by id. An anchor's positives are its first rows of the same label.
For each positive, the first rows of other labels with a score within given shares of the
positive's are its hard negatives.

1. Rows are packed into blocks of one label by their angle to reference directions (mean vectors
   of a bounded sample), with their norms and all these angles.
2. **Angular triangle filter.** Angles to the same direction bound the angle between anchor and
   row: at least their difference, at most their sum. The cosines of these, times both norms,
   rounded outwards, bound the score. First whole blocks are turned away by the range of their
   angles, then rows; only where the bounds overlap the window of scores an anchor still looks for
   are integer scores computed. The window narrows as a task finds rows.
3. Anchors go out in groups of bounded size, each a broadcast: a pass over the blocks for the
   positives, then one for the negatives. A task gives at most a few rows per anchor, whatever it
   reads; the best of all tasks are ranked by Spark. Each group's result is written at once.

Work is anchors times rows, as exact search needs; no pair leaves a task unless it is among the
task's best. A label with a third of all rows is many blocks.

Defined cases: rows with a null id, label or vector, or a null or non-finite component (also after
the factor 256) take no part. Vectors are compared with those of their length. Rows that share an
id are rows of their own, and none is a positive of an anchor with its id. Scores beyond 64 bits
are set to the ends of that range. Only the named columns are used. No anchors: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import prepare, scratch, stored

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
REFERENCES = 16  # directions: mean vectors of that many labels of the sample
REFERENCE_ROWS = 2_000  # the sample: the first rows by a hash of their ids
BLOCK_ROWS, BLOCK_BYTES = 2_048, 4 << 20
GROUP_ROWS, GROUP_BYTES = 8_192, 16 << 20  # anchors of a pass
ANCHORS_AT_ONCE = 128
# More than the rounding error of angles in float32 and of arc cosines near 0.
ANGLE_SLACK = 1e-5
_EXACT = 2.0**53
_LONG = np.iinfo(np.int64)
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def mine_hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
) -> DataFrame:
    """``RESULT`` for the rows (vec_id, label, embedding) of which ``anchor`` is true."""
    spark = rows.sparkSession
    prepare(spark)
    usable = stored(_usable(rows, anchor), "vectors")
    references = _references(usable)
    blocks = _blocks(usable, references)
    anchors = usable.where("anchor")
    size = anchors.agg(F.count(F.lit(1)), F.coalesce(F.max("dim"), F.lit(0))).first()
    at_once = max(1, min(GROUP_ROWS, GROUP_BYTES // (8 * max(size[1], 1))))
    groups = -(-size[0] // at_once)
    folder = scratch(spark, "hard-negatives")
    for group in range(groups):
        # Hashed row numbers: about ``at_once`` rows a group, also where ids repeat.
        own = anchors.where(F.pmod(F.xxhash64("row"), F.lit(groups)) == group)
        _search(
            blocks,
            _anchors(own, references),
            positives,
            negatives,
            (low_percent, high_percent),
            f"{folder}/group-{group}",
        )
    if not groups:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(*[f"{folder}/group-{g}" for g in range(groups)])


@dataclass
class Anchors:
    """The anchors of one length in a group; ``number`` counts over the whole group."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray


@dataclass
class Block:
    """Rows of one label and length, in the order of their ids."""

    dim: int
    label: int
    ids: np.ndarray
    rows: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray


def _usable(rows: DataFrame, anchor: Column) -> DataFrame:
    vector = F.col("embedding")
    huge = float("inf")
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * SCALE) == huge)
    )
    return (
        rows.withColumn("_anchor", F.coalesce(anchor, F.lit(False)))
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
        .where(~bad)
        .select(
            F.col("vec_id").cast("long").alias("id"),
            F.col("label").cast("long").alias("label"),
            vector.cast("array<double>").alias("vector"),
            F.size("embedding").alias("dim"),
            F.col("_anchor").alias("anchor"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def scaled(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors * SCALE)


def _references(usable: DataFrame) -> dict[int, dict[int, np.ndarray]]:
    """Per length of vectors the mean directions of labels, by label, from a bounded sample."""
    sample = usable.orderBy(F.xxhash64("id"), "row").limit(REFERENCE_ROWS)
    gathered: dict[int, dict[int, list]] = {}
    for r in sample.select("dim", "label", "vector").collect():
        gathered.setdefault(r["dim"], {}).setdefault(r["label"], []).append(r["vector"])
    found: dict[int, dict[int, np.ndarray]] = {}
    for dim, labels in gathered.items():
        often = sorted(labels, key=lambda x: (-len(labels[x]), x))[:REFERENCES]
        means = {x: scaled(_matrix(labels[x], dim)).mean(axis=0) for x in often}
        unit = {x: _unit(mean) for x, mean in means.items()}
        found[dim] = {x: u for x, u in unit.items() if u is not None}
    return found


def _unit(vector: np.ndarray) -> np.ndarray | None:
    norm = np.linalg.norm(vector)
    return vector / norm if 0 < norm < np.inf else None


def _directions(references: dict[int, dict[int, np.ndarray]], dim: int) -> np.ndarray:
    return _matrix(list(references.get(dim, {}).values()), dim)


def _matrix(vectors: list, dim: int) -> np.ndarray:
    return np.array(vectors, dtype=np.float64).reshape(len(vectors), dim)


def _norms_and_angles(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.linalg.norm(vectors, axis=1)
    # Vectors of norm 0 score 0 and those beyond the range of doubles have no angle; the norm
    # bounds them.
    safe = np.where((norms > 0) & np.isfinite(norms), norms, 1.0)
    with np.errstate(over="ignore", invalid="ignore"):
        cosines = np.nan_to_num((vectors / safe[:, None]) @ directions.T)
    return norms, np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)


def _blocks(usable: DataFrame, references: dict[int, dict[int, np.ndarray]]) -> DataFrame:
    """The rows packed into blocks: by length and label, then by the angle to the label's mean."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, dtype=np.float64)
            dims, labels = batch["dim"].to_numpy(), batch["label"].to_numpy()
            flat, ends = _flat(batch["vector"])
            for dim in np.unique(dims):
                for label, direction in references.get(int(dim), {}).items():
                    at = np.flatnonzero((dims == dim) & (labels == label))
                    if len(at):
                        vectors = scaled(flat[(ends[at] - dim)[:, None] + np.arange(dim)])
                        _, angles = _norms_and_angles(vectors, direction[None])
                        near[at] = angles[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near)], names=[*batch.schema.names, "near"]
            )

    columns = usable.select("id", "label", "vector", "dim", "row")
    schema = "id long, label long, vector array<double>, dim int, row long"
    near = columns.mapInArrow(measured, f"{schema}, near double")
    order = ["dim", "label", "near", "id", "row"]
    parts = max(1, usable.count() // (8 * BLOCK_ROWS))
    dealt = near.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, labels = batch["dim"].to_numpy(), batch["label"].to_numpy()
            ids, rows = batch["id"].to_numpy(), batch["row"].to_numpy()
            flat, ends = _flat(batch["vector"])
            change = np.flatnonzero((np.diff(dims) != 0) | (np.diff(labels) != 0)) + 1
            edges = [0, *change.tolist(), len(dims)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                dim = int(dims[a])
                step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(dim, 1))))
                for c in range(a, b, step):
                    at = np.arange(c, min(c + step, b))
                    at = at[np.lexsort((rows[at], ids[at]))]
                    vectors = scaled(flat[(ends[at] - dim)[:, None] + np.arange(dim)])
                    norms, angles = _norms_and_angles(vectors, _directions(references, dim))
                    narrow = _narrow(vectors)
                    yield pa.record_batch(
                        {
                            "dim": pa.array([dim], pa.int32()),
                            "label": pa.array([int(labels[c])]),
                            "ids": pa.array([ids[at].tobytes()]),
                            "rows": pa.array([rows[at].tobytes()]),
                            "kind": pa.array([narrow.dtype.str]),
                            "vectors": pa.array([narrow.tobytes()]),
                            "norms": pa.array([norms.tobytes()]),
                            "angles": pa.array([angles.tobytes()]),
                        }
                    )

    schema = (
        "dim int, label long, ids binary, rows binary, kind string, vectors binary, "
        "norms binary, angles binary"
    )
    return stored(dealt.mapInArrow(packed, schema), "vector-blocks")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All components of a column of vectors, and where each vector ends."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.cumsum(sizes)


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    most = np.abs(vectors).max(initial=0)
    for kind in (np.int16, np.int32):
        if most < np.iinfo(kind).max:
            return vectors.astype(kind)
    return vectors


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for r in batch.to_pylist():
            ids = np.frombuffer(r["ids"], dtype=np.int64)
            vectors = np.frombuffer(r["vectors"], dtype=r["kind"])
            yield Block(
                r["dim"],
                r["label"],
                ids,
                np.frombuffer(r["rows"], dtype=np.int64),
                vectors.reshape(len(ids), r["dim"]).astype(np.float64),
                np.frombuffer(r["norms"], dtype=np.float64),
                np.frombuffer(r["angles"], dtype=np.float32).reshape(len(ids), -1),
            )


def _anchors(own: DataFrame, references: dict[int, dict[int, np.ndarray]]) -> dict[int, Anchors]:
    """The anchors of a group, by the length of their vectors; a group is bounded."""
    rows = own.select("id", "label", "dim", "vector").orderBy("id", "row").collect()
    found = {}
    for dim in {r["dim"] for r in rows}:
        number = np.array([i for i, r in enumerate(rows) if r["dim"] == dim])
        vectors = scaled(_matrix([rows[i]["vector"] for i in number], dim))
        norms, angles = _norms_and_angles(vectors, _directions(references, dim))
        ids = np.array([rows[i]["id"] for i in number], dtype=np.int64)
        labels = np.array([rows[i]["label"] for i in number], dtype=np.int64)
        found[dim] = Anchors(number, ids, labels, vectors, norms, angles)
    return found


@dataclass
class Best:
    """The first ``keep`` rows of each of many lists, by score, id and row."""

    keep: int
    floor: np.ndarray  # the last kept score of a full list, else what the list asks for at least
    key: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    id: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    row: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, key: np.ndarray, score: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        good = score >= self.floor[key]
        if not good.any():
            return
        new = (key[good], score[good], id[good], row[good])
        old = (self.key, self.score, self.id, self.row)
        key, score, id, row = (np.concatenate(x) for x in zip(old, new, strict=True))
        order = np.lexsort((row, id, ~score, key))
        key = key[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        order, key = order[place < self.keep], key[place < self.keep]
        self.key, self.score, self.id, self.row = key, score[order], id[order], row[order]
        last = np.flatnonzero(place[place < self.keep] == self.keep - 1)
        self.floor[self.key[last]] = self.score[last]


def overlapping(
    anchors: Anchors, some: np.ndarray, low: np.ndarray, high: np.ndarray, block: Block
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, row of the block, score) of all pairs whose score bounds overlap [low, high].

    ``some`` are the anchors asked for, ``low`` and ``high`` their windows.
    """
    nearest, farthest = block.angles.min(axis=0), block.angles.max(axis=0)
    theirs = anchors.angles[some]
    zero = np.zeros((len(some), 1))
    gap = np.hstack([zero, theirs - farthest, nearest - theirs]).max(axis=1)
    total = np.hstack([zero + np.pi, _widest(theirs, nearest, farthest)]).min(axis=1)
    norms = anchors.norms[some]
    upper = _upper(gap, norms, block.norms.min(), block.norms.max())
    lower = -_upper(np.pi - total, norms, block.norms.min(), block.norms.max())
    some = np.flatnonzero((upper >= low) & (lower <= high)), some
    chosen, low, high = some[1][some[0]], low[some[0]], high[some[0]]
    for start in range(0, len(chosen), ANCHORS_AT_ONCE):
        own = chosen[start : start + ANCHORS_AT_ONCE]
        gap = np.zeros((len(own), len(block.ids)), dtype=np.float32)
        total = np.full_like(gap, np.pi)
        for a, b in zip(anchors.angles[own].T, block.angles.T, strict=True):
            np.maximum(gap, np.abs(a[:, None] - b), out=gap)
            np.minimum(total, a[:, None] + b, out=total)
            np.minimum(total, 2 * np.float32(np.pi) - a[:, None] - b, out=total)
        norms = anchors.norms[own][:, None]
        window = slice(start, start + ANCHORS_AT_ONCE)
        meet = _upper(gap, norms, block.norms, block.norms) >= low[window, None]
        meet &= -_upper(np.pi - total, norms, block.norms, block.norms) <= high[window, None]
        a, x = np.flatnonzero(meet.any(axis=1)), np.flatnonzero(meet.any(axis=0))
        if len(a):
            scores = products(anchors.vectors[own[a]], block.vectors[x])
            i, j = np.nonzero(meet[np.ix_(a, x)])
            yield own[a[i]], x[j], scores[i, j]


def _widest(theirs: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """The most that the angles of a block allow: the triangle's sum, or what a full turn leaves."""
    return np.minimum(theirs + farthest, 2 * np.pi - theirs - nearest)


def _upper(angle: np.ndarray, norms: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """An upper bound of the score at angles of at least ``angle``, rounded outwards."""
    cosine = np.cos(np.maximum(angle - ANGLE_SLACK, 0).astype(np.float64))
    with np.errstate(over="ignore", invalid="ignore"):
        bound = cosine * norms * np.where(cosine > 0, most, least)
        return np.nan_to_num(bound + np.abs(bound) * 1e-9 + 1, nan=np.inf, posinf=np.inf)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(left.shape[1], 1)
    if most < _EXACT:
        return (left @ right.T).astype(np.int64)
    exact = [[sum(int(p) * int(q) for p, q in zip(a, x, strict=True)) for x in right] for a in left]
    low, high = int(_LONG.min), int(_LONG.max)
    return np.array([[min(max(s, low), high) for s in row] for row in exact], dtype=np.int64)


def share_of(scores: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``percent`` of whole scores, rounded up or down, without leaving 64 bits."""
    whole, rest = np.divmod(scores, 100)
    part = percent * rest
    return percent * whole + (-(-part // 100) if up else part // 100)


def _search(
    blocks: DataFrame,
    anchors: dict[int, Anchors],
    positives: int,
    negatives: int,
    percents: tuple[int, int],
    path: str,
) -> None:
    spark: SparkSession = blocks.sparkSession
    total = sum(len(a.ids) for a in anchors.values())
    sent = spark.sparkContext.broadcast(anchors)

    def best_of_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(positives, np.full(total, _LONG.min))
        for block in _unpacked(batches):
            own = sent.value.get(block.dim)
            if own is None:
                continue
            some = np.flatnonzero(own.labels == block.label)
            low = best.floor[own.number[some]]
            high = np.full(len(some), _LONG.max)
            for a, x, score in overlapping(own, some, low, high, block):
                other = own.ids[a] != block.ids[x]
                a, x, score = a[other], x[other], score[other]
                best.add(own.number[a], score, block.ids[x], block.rows[x])
        yield _listed(best)

    found = _ranked(blocks.mapInArrow(best_of_label, _LIST), positives)
    # Bounded: ``positives`` rows for each anchor of the group.
    chosen = found.orderBy("key", "place").collect()
    if not chosen:
        spark.createDataFrame([], RESULT).write.parquet(path)
        return
    key = np.array([r["key"] for r in chosen], dtype=np.int64)
    score = np.array([r["score"] for r in chosen], dtype=np.int64)
    windows = Windows(
        key,
        np.array([r["id"] for r in chosen], dtype=np.int64),
        score,
        share_of(score, percents[0], up=True),
        share_of(score, percents[1], up=False),
    )
    asked = spark.sparkContext.broadcast(windows)

    def best_of_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = asked.value
        best = Best(negatives, w.low.copy())
        for block in _unpacked(batches):
            own = sent.value.get(block.dim)
            if own is None:
                continue
            some, low, high = w.of_anchors(own, block.label, best.floor)
            for a, x, score in overlapping(own, some, low, high, block):
                first, last = w.span(own.number[a])
                for k in range(int((last - first).max(initial=0))):
                    at = np.flatnonzero(first + k < last)
                    ask = first[at] + k
                    fits = (score[at] >= best.floor[ask]) & (score[at] <= w.high[ask])
                    at, ask = at[fits], ask[fits]
                    best.add(ask, score[at], block.ids[x[at]], block.rows[x[at]])
        yield _listed(best)

    ids = np.concatenate([a.ids for a in anchors.values()])
    number = np.concatenate([a.number for a in anchors.values()])
    id_of = ids[np.argsort(number)]
    asked_by = zip(id_of[key].tolist(), windows.ids.tolist(), score.tolist(), strict=True)
    names = spark.createDataFrame(
        [(i, *names) for i, names in enumerate(asked_by)],
        "key long, anchor_id long, positive_id long, positive_score long",
    )
    hits = _ranked(blocks.mapInArrow(best_of_others, _LIST), negatives)
    hits.join(F.broadcast(names), "key").select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    ).write.parquet(path)


@dataclass
class Windows:
    """Per anchor and positive, in the order of anchors: the scores its negatives may have."""

    key: np.ndarray
    ids: np.ndarray
    score: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def span(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First window of each anchor, and the one after its last."""
        return np.searchsorted(self.key, number), np.searchsorted(self.key, number, side="right")

    def of_anchors(
        self, anchors: Anchors, label: int, floor: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors of another label with an open window, and the range of these."""
        low, high = np.full(len(anchors.ids), _LONG.max), np.full(len(anchors.ids), _LONG.min)
        first, last = self.span(anchors.number)
        for k in range(int((last - first).max(initial=0))):
            at = np.flatnonzero(first + k < last)
            ask = first[at] + k
            at, ask = at[floor[ask] <= self.high[ask]], ask[floor[ask] <= self.high[ask]]
            low[at] = np.minimum(low[at], floor[ask])
            high[at] = np.maximum(high[at], self.high[ask])
        some = np.flatnonzero((anchors.labels != label) & (low <= high))
        return some, low[some], high[some]


_LIST = "key long, score long, id long, row long"


def _listed(best: Best) -> pa.RecordBatch:
    columns = {"key": best.key, "score": best.score, "id": best.id, "row": best.row}
    return pa.record_batch({name: pa.array(x, pa.int64()) for name, x in columns.items()})


def _ranked(rows: DataFrame, keep: int) -> DataFrame:
    """The first rows of each list over all tasks, with their place from 1."""
    order = Window.partitionBy("key").orderBy(F.desc("score"), "id", "row")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
