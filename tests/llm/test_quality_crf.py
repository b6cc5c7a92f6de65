"""The line model against enumerating all labellings, and on held-out documents."""

import itertools
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import quality_crf as crf
from eventlake.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.01")


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    for _ in range(20):
        counts = rng.integers(1, 6, 5)
        score, chain = rng.normal(size=counts.sum()) * 3, rng.normal(size=(2, 2)) * 2
        got = crf.forward_backward(score, chain, counts)
        first = 0
        for text, n in enumerate(counts.tolist()):
            total, good, pairs = 0.0, np.zeros(n), np.zeros((n, 2, 2))
            for labels in itertools.product((0, 1), repeat=n):
                own = sum(score[first + t] * labels[t] for t in range(n))
                steps = list(itertools.pairwise(labels))
                weight = np.exp(own + sum(chain[a, b] for a, b in steps))
                total += weight
                good += weight * np.array(labels)
                for t, (a, b) in enumerate(steps, start=1):
                    pairs[t, a, b] += weight
            assert np.allclose(got.log_norm[text], np.log(total))
            assert np.allclose(got.good[first : first + n], good / total)
            assert np.allclose(got.pairs[first : first + n], pairs / total)
            first += n


def test_long_chains_stay_finite():
    counts = np.array([1, 5000, 3])
    score = np.tile([30.0, -30.0], 2502)
    got = crf.forward_backward(score, np.array([[5.0, -5.0], [-5.0, 5.0]]), counts)
    assert np.isfinite(got.good).all() and np.isfinite(got.log_norm).all()


def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(9, crf.N_FEATURES))
    counts, good, share = np.array([3, 1, 5]), np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])
    weights = rng.normal(size=crf.N_FEATURES + 4) * 0.3
    _, gradient = crf.value_and_gradient(weights, rows, counts, good, share)
    for i in [0, 7, *range(crf.N_FEATURES, crf.N_FEATURES + 4)]:
        step = np.zeros_like(weights)
        step[i] = 1e-5
        above, below = (
            crf.value_and_gradient(weights + d, rows, counts, good, share)[0] for d in (step, -step)
        )
        assert abs((above - below) / 2e-5 - gradient[i]) < 1e-4


def test_chunks_do_not_change_features_or_scores():
    texts = [b"a b a b", b"", b"One line.\nOne line.\n\nSHOUT!! x | y", b"\xc3\xa4 9 9"]
    own, counts, weight = crf.line_features(texts)
    alone = [crf.line_features([t]) for t in texts]
    assert counts.tolist() == [1, 1, 4, 1]
    assert (own == np.concatenate([a[0] for a in alone])).all()
    assert (weight == np.concatenate([a[2] for a in alone])).all()
    model = crf._model(np.random.default_rng(0).normal(size=crf.N_FEATURES + 4))
    together = crf.text_scores(texts, model)
    assert np.allclose(together, [crf.text_scores([t], model)[0] for t in texts])
    rows = crf.with_neighbours(own, counts) @ model.line
    good = crf.forward_backward(np.clip(rows, -30, 30), model.chain, counts).good
    assert np.isclose(together[0], good[0])


def labelled(spark, documents):
    good = [(i, f"This is a fine text number {i}.\nIt has some lines.", "en") for i in range(60)]
    bad = [(100 + i, f"BAD!! {i} | BAD!! | BAD!!\nBAD!! $$$ ###", "en") for i in range(60)]
    docs = documents(good + bad)
    labels = docs.select("doc_id", (F.col("doc_id") < 100).cast("int").alias("quality"))
    return docs, labels


def test_sample_is_bounded_and_weighted(spark, documents, monkeypatch):
    _, labels = labelled(spark, documents)
    drawn = crf._draw(labels, 10).collect()
    by_label = {g: [r for r in drawn if r["good"] == g] for g in (0, 1)}
    assert {g: len(rows) for g, rows in by_label.items()} == {0: 10, 1: 10}
    assert all(r["rows"] == 60 for r in drawn)


def test_defined_cases(spark, documents):
    docs, labels = labelled(spark, documents)
    noise = spark.createDataFrame(
        [(0, None), (None, 1), (1, 7), (2, 0), (3, 1), (999, 0)], "doc_id long, quality int"
    )
    model = crf.fit(docs, labels.union(noise))
    rows = [
        (1, None),
        (2, ""),
        (3, "\n" * 5000),
        (3, "\n" * 5000),
        (None, "A fine text of some lines.\nIt goes on."),
        (5, "A fine line. " * 30_000),
        (6, "BAD!! | $$$ BAD!!"),
    ]
    frame = documents(rows).selectExpr("*", "'x' AS Score", "1 AS extra").coalesce(1)
    found = crf.score(frame, model)
    assert [c.lower() for c in found.columns].count("score") == 1
    got = found.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert got[0]["score"] == got[1]["score"] and got[2]["score"] == got[3]["score"]
    assert (got[4]["predicted"], got[6]["predicted"]) == (1, 0)
    assert crf.score(documents([]), model).count() == 0


def test_one_label_teaches_nothing(spark, documents):
    docs, labels = labelled(spark, documents)
    assert crf.fit(docs, labels.where("quality = 1")) is None
    assert crf.fit(documents([]), labels) is None
    scores = crf.score(docs, None).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in scores] == [(0.5, 1)]


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_held_out_accuracy(spark):
    found = QUERIES["op11_quality_crf"](spark, str(DATA)).toPandas()
    docs = duckdb.sql(f"SELECT count(*) FROM '{DATA}/documents.parquet'").fetchall()[0][0]
    assert len(found) == docs
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{DATA}/labels.parquet'").df()
    both = found[found["held_out"]].merge(labels, on="doc_id")
    right = both["predicted"] == both["quality"]
    assert right.mean() >= 0.95
    assert right[both["quality"] == 1].mean() >= 0.98
