"""Runs of repeated words, against comparing every word with every later one."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

from eventlake.llm import period_runs
from eventlake.llm.period_runs import CommonExtensions, collapse_runs, find_runs
from eventlake.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=12):
    """All (start, length, period): for every period the stretches of words like the one before."""
    found = {}
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w = np.array([number[x] for x in words], dtype=np.int64)
    for p in range(1, len(w) // 2 + 1):
        same = np.concatenate(([0], (w[:-p] == w[p:]).astype(np.int8), [0]))
        step = np.diff(same)
        for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True):
            if b - a + p >= max(least, 2 * p):
                found.setdefault((int(a), int(b) - int(a) + p), p)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_report(text):
    words = WORD.findall(text or "")
    runs = plain_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        "".join(f"{s},{n},{p}\n" for s, n, p in runs),
        " ".join(w for i, w in enumerate(words) if i not in gone),
    )


def reports(frame):
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
    return [tuple(r) for r in frame.select(*columns).collect()]


def random_texts(rng, texts):
    for _ in range(texts):
        n, kinds = rng.choice([0, 1, 11, 12, 13, 40, 100, 300]), rng.choice([1, 2, 3, 5, 50])
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 20 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(3, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_plain_version(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(period_runs, "PAIRS", rng.choice([50, 1 << 20]))
    for _ in range(25):
        texts = list(random_texts(rng, rng.randint(0, 6)))
        least = rng.choice([4, 5, 7, 12, 12, 20])
        counts = np.array([len(t) for t in texts], dtype=np.int64)
        got = find_runs(np.array([w for t in texts for w in t], dtype=np.int64), counts, least)
        want = [[i, *r] for i, t in enumerate(texts) for r in plain_runs(t, least)]
        assert got.tolist() == want


@pytest.mark.parametrize("kinds", [1, 2, 3, 1000])
def test_common_extensions_match_plain_version(kinds):
    rng = np.random.default_rng(kinds)
    words = rng.integers(0, kinds, 400)
    words[250:350] = words[50:150]
    symbols = np.concatenate(([-1], words, [-2], rng.integers(0, kinds, 30), [-3]))
    index = CommonExtensions(symbols)
    i = rng.integers(1, 401, 3000)
    j = rng.integers(1, 401, 3000)
    i, j = i[i != j], j[i != j]

    def plain(a, b):
        n = 0
        while symbols[a + n] == symbols[b + n]:
            n += 1
        return n

    assert index.common(i, j).tolist() == [plain(a, b) for a, b in zip(i, j, strict=True)]


def test_only_samples_are_sorted():
    symbols = np.append(np.arange(2100) % 7, -1)
    index = CommonExtensions(symbols)
    assert len(index.rank) == len(index.places) <= len(symbols) * 5 // 21 + 5


def test_defined_cases(spark, documents):
    texts = [
        None,
        "",
        " \t\n",
        "one two three",
        "ab " * 11,
        "ab " * 12,
        "x " + "a b c " * 4 + "a y",
        "ä ö " * 13,  # a no-break space is part of a word
        ("a b " * 7 + "c ") * 3,  # runs inside a run
        "z " * 3000,
        " ".join(f"w{i % 700}" for i in range(2500)) + " end" * 20,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "ab " * 12), (None, "ab " * 12)]
    frame = documents(rows).coalesce(1)
    assert reports(collapse_runs(frame)) == [plain_report(t) for _, t in rows]


def test_empty_table_and_clashing_columns(spark, documents):
    assert collapse_runs(documents([])).count() == 0
    frame = documents([(1, "a " * 12)]).selectExpr("*", "'x' AS N_Runs", "7 AS start", "1 AS extra")
    found = collapse_runs(frame)
    assert found.columns.count("n_runs") == 1 and "N_Runs" not in found.columns
    row = found.first()
    assert (row["n_runs"], row["start"], row["extra"], row["n_words"]) == (1, 0, 1, 12)


def test_very_long_text(spark, documents):
    words = [f"w{i}" for i in range(300_000)]
    text = " ".join(words + words[-40_000:] * 2)
    (row,) = reports(collapse_runs(documents([(1, text)])))
    assert row[:5] == (1, 260_000, 120_000, 40_000, 3000)
    assert row[6] == " ".join(words)


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_query_matches_plain_version(spark):
    got = {r["doc_id"]: r for r in QUERIES["op12_period_runs"](spark, str(DATA)).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            planted += 1
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        *figures, runs, kept = plain_report(" ".join(words))
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (runs, kept)]
        assert list(got[doc_id])[1:] == [*figures, *digests], doc_id
    assert planted
