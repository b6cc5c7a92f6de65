"""Links and classes against brute force."""

import re
from collections import Counter
from pathlib import Path

import pytest

from eventlake.llm.components import connected_components
from eventlake.llm.jaccard_join import BLOCK, banding, jaccard_links
from eventlake.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")


def grams(text, n=5):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_force(rows, threshold=0.8):
    """Per row: (class members, links), by comparing all pairs."""
    sets = [grams(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) / len(a | b) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return Counter((doc_id, least.get(root(i)), links[i]) for i, (doc_id, _) in enumerate(rows))


def test_banding_meets_the_recall():
    bands, rows = banding(0.8, 0.9999, 128)
    assert bands * rows <= 128
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999
    with pytest.raises(ValueError):
        banding(0.8, 0.9999, 2)
    with pytest.raises(ValueError):
        banding(1.5, 0.9, 10)


def variants(n, words=60):
    """Texts that differ in their last word only, and so are all similar."""
    base = [f"w{i}" for i in range(words)]
    return [" ".join([*base, f"end{i}"]) for i in range(n)]


def test_links_match_brute_force(spark, documents):
    base = [f"v{i}" for i in range(40)]
    rows = [(i, t) for i, t in enumerate(variants(2 * BLOCK + 30))]  # a group of several blocks
    rows += [(1000 + i, " ".join(base[i:] + [f"x{j}" for j in range(i)])) for i in range(12)]
    rows += [(1100 + i, "same short text") for i in range(7)]
    rows += [(1200, None), (1201, ""), (1202, " .,!"), (1203, "one"), (1204, "One!")]
    rows += [(1300, variants(1)[0]), (1300, "another text under the same id here")]
    rows += [(None, "a text without an id that has no copy"), (None, "same short text")]
    got = jaccard_links(documents(rows)).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute_force(rows)


def test_very_long_text_and_extra_columns(spark, documents):
    long = " ".join(f"t{i % 977}x{i % 31}" for i in range(60_000))
    docs = documents([(1, long), (2, long + " more"), (3, "z" * 100_000)])
    docs = docs.selectExpr("*", "1 AS node", "2 AS class_id", "3 AS bands")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_links(docs).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}


def test_empty_table(documents):
    assert jaccard_links(documents([])).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (None, 3)]
    star = [(1000, 2000 + i) for i in range(50)]
    got = connected_components(spark.createDataFrame(chain + star, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 1000: 1000}
    want |= {2000 + i: 1000 for i in range(50)}
    assert len(got) == len(want) and {r.node: r.root for r in got} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_registered_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op5_ngram_jaccard"](spark, str(DATA)).collect()
    want = brute_force([(d.doc_id, d.text) for d in docs])
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == want
    assert sum(r.n_links for r in got) > 0
