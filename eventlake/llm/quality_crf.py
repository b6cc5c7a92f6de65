"""Document quality from a linear-chain conditional random field over the lines of a text.

Every line is good or bad. Its score comes from features of the line itself and of the lines
before and after it: shares of kinds of characters, lengths, and how much of it the text repeats.
Transition weights tie neighbours together. Forward-backward gives each line's chance to be good;
their mean, weighted by length, is the quality of the document.

* **Training** maximises the conditional likelihood of the labels, each line having its
  document's, over a bounded sample: at most ``SAMPLE`` labelled documents of each label, the first
  by a hash of their ids, weighted back to the label's share. Their feature rows are written
  once; each step of the optimiser is a Spark job that sums value and gradient over them.
* **Scoring** is one pass over the documents, without a shuffle. The chains of a chunk of texts are
  evaluated together: running products of their 2 x 2 matrices, by doubling.

Defined cases: a null or empty text is one empty line. Labels other than 0 and 1, labels without an
id, and ids whose labels contradict each other teach nothing; of rows that share an id, training
takes the least text. If a label has no document, every score is 0.5. Repeated rows are scored as
rows of their own. Other columns are passed on, clashing ones replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.shared import broadcast_if_small, prepare, stored
from eventlake.llm.tokens import CHAR_START, NOT_WHITE, Texts, as_bytes, chunks, owners

SAMPLE = 5_000  # labelled documents of each label that train the model
ROUNDS = 60  # steps of the optimiser, at most
PENALTY = 1e-5  # of squared weights, against the mean likelihood of a document
THRESHOLD = 0.3
RESULT = "score double, predicted int"

_KINDS = {
    "upper": range(ord("A"), ord("Z") + 1),
    "lower": range(ord("a"), ord("z") + 1),
    "digit": range(ord("0"), ord("9") + 1),
    "stop": map(ord, ".,;:'\"-"),
    "mark": map(ord, "!?"),
    "wide": range(0x80, 0x100),
}
_KINDS = {name: list(members) for name, members in _KINDS.items()}
_OTHER = set(range(0x21, 0x80)).difference(*_KINDS.values())
_KINDS["other"] = sorted(_OTHER)
_TABLES = np.stack([np.isin(np.arange(256), members) for members in _KINDS.values()])
OWN = [
    *_KINDS,
    "chars",
    "words",
    "word_size",
    "marked_words",
    "bare_marks",
    "stuttered_words",
    "repeated_words",
    "known_pairs",
    "known_line",
]
# Words that end in one of these are marked: neither letters, digits nor sentence marks.
_SYMBOL = np.isin(np.arange(256), [*_KINDS["other"], *_KINDS["mark"]])
N_FEATURES = 3 * len(OWN) + 3


@dataclass(frozen=True)
class QualityModel:
    """``line``: a weight per feature; ``chain[a, b]``: of a line of state a before one of b, where
    1 is good."""

    line: np.ndarray
    chain: np.ndarray


def held_out(doc_id: Column) -> Column:
    """A fifth of all ids, by a hash of their decimal text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel | None:
    """The model for ``labels`` (doc_id, quality) of ``docs`` (doc_id, text); None without both
    labels."""
    prepare(docs.sparkSession)
    chosen = broadcast_if_small(stored(_draw(labels, sample), "quality-sample"))
    texts = stored(
        docs.select(F.col("doc_id").alias("id"), "text")
        .join(chosen, "id")
        .groupBy("id", "good", "rows")
        .agg(F.min("text").alias("text"))
        .sortWithinPartitions("id"),
        "quality-texts",
    )
    drawn = texts.groupBy("good", "rows").agg(F.count(F.lit(1)).alias("drawn")).collect()
    if len(drawn) < 2:
        return None
    total = sum(r["rows"] for r in drawn)
    share = np.zeros(2)  # what one document of a label counts, of 1 in all
    for r in drawn:
        share[r["good"]] = r["rows"] / r["drawn"] / total

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, good = as_bytes(batch["text"]), batch["good"].to_numpy()
            for a, b in chunks(column):
                own, counts, _ = line_features(column[a:b])
                arrays = [own, counts.astype(np.int64), good[a:b].astype(np.int64)]
                packed = [pa.array([x.tobytes()], pa.binary()) for x in arrays]
                yield pa.record_batch(packed, names=["own", "counts", "good"])

    rows = stored(
        texts.select("text", "good").mapInArrow(features, "own binary, counts binary, good binary"),
        "quality-features",
    )

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, gradient = 0.0, np.zeros(len(weights))
            for batch in batches:
                for own, counts, good in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    own = np.frombuffer(own, dtype=np.float32).reshape(-1, len(OWN))
                    counts, good = (np.frombuffer(x, dtype=np.int64) for x in (counts, good))
                    v, g = value_and_gradient(
                        weights, with_neighbours(own, counts), counts, good, share[good]
                    )
                    value, gradient = value + v, gradient + g
            yield pa.record_batch(
                {"value": pa.array([value]), "gradient": pa.array([gradient.tolist()])}
            )

        # One row per task over the bounded sample.
        parts = rows.mapInArrow(run, "value double, gradient array<double>").collect()
        value = sum(p["value"] for p in parts)
        gradient = np.sum([p["gradient"] for p in parts], axis=0)
        penalty = PENALTY * weights @ weights
        return penalty - value, 2 * PENALTY * weights - gradient

    return _model(_minimum(evaluate, np.zeros(N_FEATURES + 4)))


def score(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """All columns of ``docs``, the chance that its text is good, and whether that suffices."""
    prepare(docs.sparkSession)
    new = T.StructType.fromDDL(RESULT)
    docs = docs.drop(*new.fieldNames())
    if model is None:
        return docs.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            found = [text_scores(texts[a:b], model) for a, b in chunks(texts)]
            scores = np.concatenate([np.zeros(0), *found])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores),
                    pa.array((scores >= THRESHOLD).astype(np.int32)),
                ],
                names=[*batch.schema.names, *new.fieldNames()],
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *new.fields]))


def _draw(labels: DataFrame, sample: int) -> DataFrame:
    """(id, good, rows): up to ``sample`` ids of each label, with the rows the label has in all."""
    good = F.col("quality").cast("int")
    clear = stored(
        labels.where(F.col("doc_id").isNotNull() & good.isin(0, 1))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.min(good).alias("good"), F.max(good).alias("most"))
        .where("good = most")
        .drop("most"),
        "quality-labels",
    )
    sizes = clear.groupBy("good").agg(F.count(F.lit(1)).alias("rows"))  # two rows
    # About twice the sample of each label is ordered, all of a label that has no more.
    share = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("rows"))
    place = F.row_number().over(Window.partitionBy("good").orderBy("draw", "id"))
    return (
        clear.withColumn("draw", F.pmod(F.xxhash64("id"), F.lit(1 << 40)))
        .join(F.broadcast(sizes), "good")
        .where(F.col("draw") < share * F.lit(float(1 << 40)))
        .withColumn("place", place)
        .where(F.col("place") <= sample)
        .select("id", "good", "rows")
    )


def _minimum(evaluate: Callable, start: np.ndarray) -> np.ndarray:
    """The weights where ``evaluate`` (value and gradient) is least: limited-memory BFGS."""
    weights, (value, gradient) = start, evaluate(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []  # of the weights and of the gradient
    for _ in range(ROUNDS):
        direction, shares = -gradient, []
        for s, y in reversed(steps):
            shares.append(s @ direction / (s @ y))
            direction = direction - shares[-1] * y
        if steps:
            s, y = steps[-1]
            direction = direction * (s @ y) / (y @ y)
        for (s, y), share in zip(steps, reversed(shares), strict=True):
            direction = direction + (share - y @ direction / (s @ y)) * s
        slope, length = gradient @ direction, 1.0
        if not steps:
            length = min(1.0, 1.0 / max(np.linalg.norm(gradient), 1e-12))
        while True:
            moved = weights + length * direction
            new, turned = evaluate(moved)
            if new <= value + 1e-4 * length * slope or length < 1e-6:
                break
            length /= 2
        gain = value - new
        if gain <= 0:
            break
        s, y = moved - weights, turned - gradient
        if s @ y > 1e-12:
            steps = [*steps[-9:], (s, y)]
        weights, value, gradient = moved, new, turned
        if gain < 1e-5 * abs(value):
            break
    return weights


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of each line itself (float32), lines per text, and characters + 1 per line."""
    chunk = Texts(texts, lower=False)
    data = chunk.bytes
    breaks = np.flatnonzero(data == 0x0A)
    begin, end = np.append(0, breaks + 1), np.append(breaks, len(data))
    counts = chunk.counts(begin)
    text = owners(counts)

    def inside(members: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(members[data]))
        return (sums[end] - sums[begin]).astype(np.float64)

    solid = np.maximum(inside(NOT_WHITE), 1)
    own = [inside(members) / solid for members in _TABLES]
    chars = inside(CHAR_START)
    first, last = chunk.runs(NOT_WHITE)
    edges = np.searchsorted(first, np.append(begin, len(data) + 1))
    n_words = np.diff(edges).astype(np.float64)
    words = np.maximum(n_words, 1)
    line_of = np.repeat(np.arange(len(begin)), np.diff(edges))

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(line_of, flags, minlength=len(begin)) / words

    value = chunk.hashes(first, last)
    of_text = text[line_of]
    follows = np.append(of_text[1:] == of_text[:-1], False) if len(value) else value.astype(bool)
    pair = value * np.uint64(3) + np.append(value[1:], value[:1])
    marked = _SYMBOL[data[last - 1]]
    stutter = np.append(False, (value[1:] == value[:-1]) & follows[:-1]) if len(value) else follows
    solid_lines = inside(NOT_WHITE) > 0
    own += [
        np.log1p(chars) / 8,
        np.log1p(n_words) / 8,
        np.minimum(solid / words / 20, 1),
        share(marked),
        share(marked & (last - first == 1)),
        share(stutter),
        share(_seen_before(value, of_text)),
        share(_seen_before(pair, of_text) & follows),
        _seen_before(chunk.hashes(begin, end), text) & solid_lines,
    ]
    return np.stack(own, axis=1).astype(np.float32), counts, chars + 1


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Own features of each line, of the one before and the one after, and which of these exist."""
    has_before, has_after = _neighbours(counts)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[has_before] = own[np.flatnonzero(has_before) - 1]
    after[has_after] = own[np.flatnonzero(has_after) + 1]
    ends = np.stack([np.ones(len(own)), has_before, has_after], axis=1)
    return np.hstack([own, before, after, ends])


def _neighbours(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    has_before = np.ones(int(counts.sum()), dtype=bool)
    has_after = has_before.copy()
    has_before[(np.cumsum(counts) - counts)[counts > 0]] = False
    has_after[(np.cumsum(counts) - 1)[counts > 0]] = False
    return has_before, has_after


def _seen_before(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """True for values that an earlier place of the same text has."""
    order = np.lexsort((np.arange(len(values)), values, text))
    v, t = values[order], text[order]
    seen = np.zeros(len(values), dtype=bool)
    seen[order[1:]] = (v[1:] == v[:-1]) & (t[1:] == t[:-1])
    return seen


@dataclass(frozen=True)
class Chains:
    """What forward-backward says of each line (``good``), pair of neighbours (``pairs``, by its
    second line; 0 for first lines) and chain (``log_norm``)."""

    good: np.ndarray
    pairs: np.ndarray
    log_norm: np.ndarray


def forward_backward(score: np.ndarray, chain: np.ndarray, counts: np.ndarray) -> Chains:
    """Marginals of chains of two states; ``score`` is the weight of good against bad per line.

    A first line's matrix has equal rows, so running products forget what was before it, and
    products over the longest chain's length hold every chain whole.
    """
    n = len(score)
    head = np.zeros(n, dtype=bool)
    head[(np.cumsum(counts) - counts)[counts > 0]] = True
    high = np.maximum(score, 0)
    line = np.exp(np.stack([-high, score - high], axis=1))  # weights up to exp(high)
    step = np.exp(chain - chain.max())
    matrix = np.where(head[:, None, None], 1.0, step[None]) * line[:, None, :]
    longest = int(counts.max(initial=1))
    forward = _running(matrix, longest)[:, 0, :]
    forward /= forward.sum(axis=1, keepdims=True)
    # Backward: what follows a line, through the matrix of the next one.
    tail = np.append(head[1:], True)
    after = np.ones((n, 2, 2))
    after[:-1] = matrix[1:]
    after[tail] = 1.0
    backward = _running(after[::-1].transpose(0, 2, 1), longest)[::-1][:, 0, :]
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    previous = np.ones((n, 2))
    previous[1:] = forward[:-1]
    previous[head] = (1.0, 0.0)
    joint = previous[:, :, None] * matrix
    norm = joint.sum(axis=(1, 2))
    pairs = joint * backward[:, None, :]
    pairs /= pairs.sum(axis=(1, 2), keepdims=True)
    pairs[head] = 0.0
    logs = np.log(norm) + high + np.where(head, 0.0, chain.max())
    sums = np.append(0, np.cumsum(logs))
    ends = np.cumsum(counts)
    return Chains(good, pairs, sums[ends] - sums[ends - counts])


def _running(matrix: np.ndarray, longest: int) -> np.ndarray:
    """Products of each matrix with those before it, over at least ``longest`` of them."""
    product, width = matrix / matrix.max(axis=(1, 2), keepdims=True), 1
    while width < longest:
        ahead = product[:-width] @ product[width:]
        product = product.copy()
        product[width:] = ahead / ahead.max(axis=(1, 2), keepdims=True)
        width *= 2
    return product


def value_and_gradient(
    weights: np.ndarray, rows: np.ndarray, counts: np.ndarray, good: np.ndarray, share: np.ndarray
) -> tuple[float, np.ndarray]:
    """Weighted log likelihood of chains whose lines are all good or all bad, and its gradient."""
    model = _model(weights)
    score = np.clip(rows @ model.line, -30, 30)
    chains = forward_backward(score, model.chain, counts)
    text = owners(counts)
    ends = np.cumsum(counts)
    sums = np.append(0, np.cumsum(score))
    steps = np.maximum(counts - 1, 0)
    same = model.chain[good, good] * steps
    value = (share * ((sums[ends] - sums[ends - counts]) * good + same - chains.log_norm)).sum()
    line = rows.T @ (share[text] * (good[text] - chains.good))
    seen = np.zeros((2, 2))
    np.add.at(seen, (good, good), share * steps)
    expected = (share[text][:, None, None] * chains.pairs).sum(axis=0)
    return float(value), np.concatenate([line, (seen - expected).ravel()])


def _model(weights: np.ndarray) -> QualityModel:
    return QualityModel(weights[:N_FEATURES], weights[N_FEATURES:].reshape(2, 2))


def text_scores(texts: list[bytes], model: QualityModel) -> np.ndarray:
    own, counts, weight = line_features(texts)
    # As with_neighbours(own, counts) @ model.line, which would take three times the memory.
    here, before, after = model.line[: 3 * len(OWN)].reshape(3, -1)
    has_before, has_after = _neighbours(counts)
    total = own @ here + model.line[-3:] @ np.stack([np.ones(len(own)), has_before, has_after])
    total[has_before] += (own @ before)[np.flatnonzero(has_before) - 1]
    total[has_after] += (own @ after)[np.flatnonzero(has_after) + 1]
    good = forward_backward(np.clip(total, -30, 30), model.chain, counts).good
    text = owners(counts)
    return np.bincount(text, good * weight, len(texts)) / np.bincount(text, weight, len(texts))
