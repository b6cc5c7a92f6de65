"""Hard negatives against scoring every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import hard_negatives
from eventlake.llm.hard_negatives import mine_hard_negatives
from eventlake.llm.shared import prepare

SCHEMA = "vec_id long, label int, embedding array<float>, extra string"


def plain(rows, every=5, low=50, high=95):
    usable = []
    for vec_id, label, vector, *_ in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in vector]
        usable.append((vec_id, label, v))
    out = []
    for anchor_id, label, v in usable:
        if anchor_id % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w, strict=True)), other, kind)
            for other, kind, w in usable
            if len(w) == len(v)
        ]
        scored.sort(key=lambda s: s[:2])
        own = [s for s in scored if s[2] == label and s[1] != anchor_id][:5]
        for p, positive_id, _ in own:
            fit = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p]
            for rank, (n, negative_id, _) in enumerate(fit[:3], start=1):
                out.append((anchor_id, positive_id, rank, negative_id, -p, -n))
    return sorted(out)


def mined(spark, rows, every=5):
    prepare(spark)
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, mine_hard_negatives(frame, F.col("vec_id") % every == 0).collect()))


def vectors(rng, n, dim, kinds, spread=0.3):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(kinds)]
    for i in range(n):
        label = rng.randrange(kinds)
        near = centres[label] if rng.random() < 0.7 else rng.choice(centres)
        yield i, label, [c * 0.3 + rng.gauss(0, spread) for c in near], "x"


@pytest.mark.parametrize("seed", range(4))
def test_matches_plain_version(spark, seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:  # many blocks, groups and slices
        monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 7)
        monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 9)
        monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 2)
    rows = list(vectors(rng, 160, rng.choice([2, 3, 16]), rng.choice([1, 2, 4])))
    got = mined(spark, rows)
    assert got == plain(rows)


def test_bounds_turn_pairs_away(monkeypatch, spark):
    """Narrow clusters far apart: few pairs are scored, and no result is lost."""
    rng = random.Random(5)
    rows = list(vectors(rng, 300, 8, 6, spread=0.01))
    usable = hard_negatives._usable(
        spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0
    )
    references = hard_negatives._references(usable)
    (anchors,) = hard_negatives._anchors(usable.where("anchor"), references).values()
    blocks = hard_negatives._blocks(usable, references).toArrow().to_batches()
    scored = total = 0
    for block in hard_negatives._unpacked(iter(blocks)):
        some = np.arange(len(anchors.ids))
        exact = anchors.vectors @ block.vectors.T
        low = np.full(len(some), np.quantile(exact, 0.9))
        high = low + 50
        meet = np.zeros(exact.shape, dtype=bool)
        for a, x, score in hard_negatives.overlapping(anchors, some, low, high, block):
            assert (exact[a, x] == score).all()
            meet[a, x] = True
        inside = (exact >= low[:, None]) & (exact <= high[:, None])
        assert not (inside & ~meet).any()
        scored, total = scored + meet.sum(), total + meet.size
    assert scored < total / 2


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(2)
    rows = list(vectors(rng, 40, 3, 2))
    rows += [
        (45, None, [0.1, 0.2, 0.3], "x"),
        (50, 1, None, "x"),
        (55, 1, [0.1, None, 0.3], "x"),
        (60, 1, [0.1, nan, 0.3], "x"),
        (65, 1, [0.1, inf, 0.3], "x"),
        (None, 1, [0.1, 0.2, 0.3], "x"),
        (70, 1, [0.0, 0.0, 0.0], "x"),  # no angle; scores 0
        (75, 1, [], "x"),
        (76, 0, [], "x"),
        (77, 1, [], "x"),
        (80, 0, [0.5, 0.5], "x"),  # compared with vectors of its length only
        (81, 0, [0.5, 0.4], "x"),
        (82, 1, [0.5, 0.3], "x"),
        (83, 1, [0.5, 0.31], "x"),
    ]
    rows += [(90 + i, i % 2, [0.3, 0.3, 0.3], "x") for i in range(12)]  # ties
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == []
    assert mined(spark, rows, every=1000) == plain(rows, every=1000)


def test_repeated_rows(spark):
    """Copies are rows of their own; none is a positive of an anchor with its id."""
    rows = [(5, 0, [1.0, 0.0], "x")] * 2 + [(6, 0, [0.9, 0.1], "x")] * 2
    rows += [(7, 1, [0.7, 0.1], "x")] * 2
    got = mined(spark, rows)
    assert got == plain(rows)
    assert len(got) == 2 * 2 * 2


def test_large_components_are_exact(spark):
    rows = [
        (5, 0, [3e6, 1.0], "x"),
        (6, 0, [3e6, 7.0], "x"),
        (7, 1, [2e6, 3.0], "x"),
        (8, 1, [2e6, 3.1], "x"),
    ]
    assert mined(spark, rows) == plain(rows)


def test_shares_of_scores():
    scores = np.array([0, 1, 99, 100, -1, -99, 101, 2**62])
    low = hard_negatives.share_of(scores, 50, up=True).tolist()
    high = hard_negatives.share_of(scores, 95, up=False).tolist()
    assert low == [-(-50 * s // 100) for s in scores.tolist()]
    assert high == [95 * s // 100 for s in scores.tolist()]
