"""Fusion against a plain version, accuracy on held-out documents, and odd rows."""

import math
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import language_id as lid
from eventlake.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")


def text_logs(text, model):
    """Tempered log likelihoods and the best mean, a trigram at a time."""
    data = bytes(
        b if b >= 0x80 or ord("a") <= b <= ord("z") else 0x20 for b in (text or "").encode().lower()
    )
    grams = [data[i : i + 3] for i in range(len(data) - 2) if data[i : i + 3] != b"   "]
    if not grams:
        return np.zeros(len(model.languages)), None
    value = np.array([int.from_bytes(g, "big") for g in grams], dtype=np.uint64)
    mean = model.table[(lid.mix(value) % np.uint64(lid.BUCKETS)).astype(int)].mean(axis=0)
    return mean * min(len(grams), lid.SATURATION), mean.max()


def plain(rows, model):
    """(language, confidence, accepted) of (text, declared, host) rows."""
    width = len(model.languages)
    logs = [text_logs(t, model) for t, _, _ in rows]
    shares = [np.exp(x - x.max()) / np.exp(x - x.max()).sum() for x, _ in logs]

    def levels(host):
        host = host or ""
        return [(), (host.split(".")[-1],), (".".join(host.split(".")[-2:]),), (host,)]

    def path(host):
        parts = levels(host)
        return [sum(parts[: i + 1], ()) for i in range(4)]

    sums, by_declared, total = {}, {}, np.zeros(width)
    for (_, declared, host), p in zip(rows, shares):
        for key in path(host):
            sums[key] = sums.get(key, 0) + p
        by_declared[declared] = by_declared.get(declared, 0) + p
        total = total + p
    out = []
    for (_, declared, host), (x, best) in zip(rows, logs):
        prior = np.full(width, 1 / width)
        for key in path(host):
            prior = (sums[key] + lid.SMOOTHING * prior) / (sums[key].sum() + lid.SMOOTHING)
        chance = (by_declared[declared] + 0.5) / (total + 0.5 * len(by_declared))
        score = x + np.log(prior) + np.log(chance)
        p = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
        fits = best is not None and best > -math.log(lid.BUCKETS)
        out.append((model.languages[p.argmax()], p.max(), bool(fits and p.max() >= 0.5)))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return lid.train_text_model(spark.read.parquet(f"{DATA}/documents.parquet"))


ROWS = [
    ("the and of that with this have from", "en", "a.example.com"),
    ("le la les des une dans pour que", "fr", "b.example.com"),
    ("le", "en", "a.example.com"),
    ("der die das und nicht", None, "x.de"),
    ("", "fr", "b.example.com"),
    (None, "en", None),
    ("12345 !!! 67", "en", ""),
    ("這是一個句子 這是另一個", "zh", "single"),
    ("the the the the", "de", "a.example.com"),
    ("the the the the", "de", "a.example.com"),
    ("z" * 50_000, None, None),
]


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_fusion_matches_the_plain_version(spark, model):
    rows = [(i, *r) for i, r in enumerate(ROWS)]
    frame = spark.createDataFrame(rows, "id long, body string, declared string, host string")
    frame = frame.selectExpr("*", "'old' AS language", "1 AS extra")
    got = lid.identify(frame, model, "body", F.col("declared"), F.col("host")).collect()
    want = plain(ROWS, model)
    assert len(got) == len(rows)
    for r in got:
        language, confidence, accepted = want[r.id]
        assert r.confidence == pytest.approx(confidence, abs=1e-9)
        assert r.extra == 1 and r.accepted == accepted
        if confidence > 0.3:
            assert r.language == language
    assert not any(r.accepted for r in got if r.id in (4, 5, 6, 7))


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_held_out_accuracy_from_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trained = lid.train_text_model(docs.where("doc_id % 2 = 0"), sample=300)
    none = F.lit(None).cast("string")
    rows = lid.identify(docs.where("doc_id % 2 = 1"), trained, "text", none, none).collect()
    assert sum(r.lang == r.language for r in rows) >= 0.98 * len(rows)
    assert sum(r.accepted for r in rows) >= 0.98 * len(rows)


def test_a_rare_label_is_a_language_whatever_the_size(documents):
    common = [(i, f"the and of that with this {i}", "en", "s") for i in range(2_000)]
    rare = [(5_000 + i, f"ja nie jest tego {i}", "pl", "s") for i in range(12)]
    few = [(9_000 + i, "og det er ikke", "da", "s") for i in range(9)]
    trained = lid.train_text_model(documents(common + rare + few), sample=50)
    assert trained.languages == ("en", "pl")
    # All rare documents are in the sample: their trigrams have far more than the pseudo count.
    bucket = lid._trigrams([b"jest"])[0][0]
    assert trained.table[bucket, 1] > trained.table[bucket, 0] + 3


def test_pages_are_read():
    page = '<html lang="EN-us"><script>var a="<p>";</script><p>One &amp; <!-- no --> two</p><style>x'
    assert lid.page_text(page).split() == ["One", "&", "two"]
    assert lid._LANG.search(page)[1] == "EN"


def test_odd_pages_and_empty_tables(spark, model):
    rows = [(1, None, None), (2, "http://H.Example.org:80/x", "<html lang=fr>le"), (None, "x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in lid.parsed_pages(pages).collect()}
    assert got[2].host == "h.example.org" and got[2].declared == "fr"
    assert got[1].host is None and got[1].text == "" and got[None].host is None
    empty = lid.parsed_pages(pages.limit(0))
    assert lid.identify(empty, model, "text", F.col("declared"), F.col("host")).count() == 0


def test_without_training_texts_all_is_rejected(spark, documents):
    untrained = lid.train_text_model(documents([(1, None), (2, "few")]))
    assert untrained.languages == ()
    docs = documents([(1, "some text")])
    row = lid.identify(docs, untrained, "text", F.col("lang"), F.col("source")).first()
    assert row.language is None and row.accepted is False


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_registered_query(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").count()
    rows = QUERIES["op7_language_id"](spark, str(DATA)).collect()
    assert len(rows) == pages == len({r["page_id"] for r in rows})
    accepted = [r for r in rows if r["accepted"]]
    assert len(accepted) >= 0.9 * pages
    assert all(r["language"] and 0.5 <= r["confidence"] <= 1 for r in accepted)


def test_arrays_of_a_chunk_are_bounded():
    """Several workers of an executor hold them at once."""
    texts = [b"some words of a text " * 5_000] * 40
    tracemalloc.start()
    for a, b in lid.chunks(texts):
        lid._trigrams(texts[a:b])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 80e6
