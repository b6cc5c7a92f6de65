"""The n-gram model against a plain version of the same definition."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from eventlake.llm import hash_table, kneser_ney
from eventlake.llm.hash_table import HashTable
from eventlake.llm.queries import QUERIES
from eventlake.llm.shared import file_system

DATA = Path("/root/testdata/sf0.001")
START, END = object(), object()


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [END]


class Plain:
    def __init__(self, texts, order):
        self.order = order
        self.unigrams = Counter(t for x in texts for t in tokens(x))
        counts = Counter()
        for x in texts:
            seq = [START] * (order - 1) + tokens(x)
            counts.update(tuple(seq[i : i + order]) for i in range(len(seq) - order + 1))
        self.levels = {}
        for k in range(order, 0, -1):
            context = defaultdict(Counter)
            for gram, c in counts.items():
                context[gram[:-1]].update({"total": c, min(c, 3): 1})
            n = Counter(counts.values())
            self.levels[k] = (counts, context, self.discounts(n[1], n[2], n[3], n[4]))
            counts = Counter(gram[1:] for gram in counts)

    @staticmethod
    def discounts(n1, n2, n3, n4):
        if min(n1, n2, n3, n4) > 0:
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            if 0 < d[0] < 1 and 0 < d[1] < 2 and 0 < d[2] < 3:
                return [0, *d]
        return [0, 0.5, 1, 1.5]

    def chance(self, gram):
        if not gram:
            return 1 / (len(self.unigrams) + 1)
        lower = self.chance(gram[1:])
        counts, contexts, d = self.levels[len(gram)]
        context = contexts.get(gram[:-1])
        if not context:
            return lower
        c = counts.get(gram, 0)
        weight = sum(d[i] * context[i] for i in (1, 2, 3))
        return (c - d[min(c, 3)] + weight * lower) / context["total"]

    def score(self, text):
        seq = [START] * (self.order - 1) + tokens(text)
        grams = (tuple(seq[i : i + self.order]) for i in range(len(seq) - self.order + 1))
        return sum(math.log10(self.chance(g)) for g in grams)

    def base(self, text):
        n, v = sum(self.unigrams.values()), len(self.unigrams)
        return sum(math.log10((self.unigrams[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(text))


TEXTS = ["a b c a b", "the cat\tsat on the\n mat", "", None, "A b", "x" * 5000, "é É a b c", "a b c a b"] + [
    f"w{i % 7} w{i % 3} w{i % 5} w{i} end" for i in range(60)
]


def test_registered_model_counts_more_than_pairs(documents):
    # Both probes have the same words and the same pairs, but other triples.
    train = ["a b c a d b a"] * 9 + ["x y z"]
    probes = ["a b c a d b a", "a d b a b c a"]
    model = kneser_ney.train(documents(list(enumerate(train))))
    rows = kneser_ney.score(documents(list(enumerate(probes))), model).collect()
    scores = {r.doc_id: r.score for r in rows}
    assert scores[0] > scores[1] + 0.1


def test_empty_shards_do_not_lose_ngrams(documents, monkeypatch):
    docs = documents([(i, "a b a b c") for i in range(20)])

    def scores():
        return sorted(r.score for r in kneser_ney.score(docs, kneser_ney.train(docs)).collect())

    one = scores()
    for tokens in (1, 2, 3, 5):  # 120 to 24 shards for a handful of contexts
        monkeypatch.setattr(kneser_ney, "TOKENS_PER_SHARD", tokens)
        assert scores() == pytest.approx(one, abs=1e-9)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_match_the_plain_model(spark, documents, order):
    model = kneser_ney.train(documents(list(enumerate(TEXTS))), order)
    probes = [*TEXTS, "never seen words", "w1 w1 w2 cat", "the cat b c"]
    got = kneser_ney.score(documents(list(enumerate(probes))), model).collect()
    plain = Plain(TEXTS, order)
    assert len(got) == len(probes)
    for row in got:
        text = probes[row.doc_id]
        assert row.score == pytest.approx(plain.score(text), abs=1e-9)
        assert row.base_score == pytest.approx(plain.base(text), abs=1e-9)
        assert row.n_tokens == len(tokens(text))
        assert row.n_known == sum(t in plain.unigrams for t in tokens(text))
        assert row.train_tokens == sum(plain.unigrams.values())


def test_chances_sum_to_one(spark, documents):
    texts = [x for x in TEXTS if x]
    plain = Plain(texts, 2)
    words = [w for w in plain.unigrams if w is not END]
    model = kneser_ney.train(documents(list(enumerate(texts))), 2)
    # Pairs "a w" differ from "a" alone by P(w | a) and the end's chance after w.
    ends = {w: plain.chance((w, END)) for w in [*words, "zzz"]}
    probes = ["a " + w for w in [*words, "zzz"]] + ["a"]
    rows = kneser_ney.score(documents(list(enumerate(probes))), model).collect()
    by_text = {r.text: r.score for r in rows}
    first = by_text["a"] - math.log10(plain.chance(("a", END)))
    total = sum(10 ** (by_text["a " + w] - first) / ends[w] for w in ends)
    assert total + plain.chance(("a", END)) == pytest.approx(1)


def test_no_training_texts(spark, documents):
    model = kneser_ney.train(documents([]))
    row = kneser_ney.score(documents([(1, "some words")]), model).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score, row.base_score) == (3, 0, 0, 0, 0)
    assert kneser_ney.score(documents([]), model).count() == 0


def test_clashing_columns_are_replaced(spark, documents):
    docs = documents([(1, "a b"), (None, "a b")]).selectExpr("*", "'old' AS score", "1 AS extra")
    rows = kneser_ney.score(docs, kneser_ney.train(docs)).collect()
    assert len(rows) == 2 and all(isinstance(r.score, float) and r.extra == 1 for r in rows)


def test_clear_errors(documents):
    with pytest.raises(ValueError):
        kneser_ney.train(documents([]), order=1)


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_registered_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    kept = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 5 != 1]
    plain = Plain([d.text for d in kept], kneser_ney.ORDER)
    texts = {d.doc_id: d.text for d in docs}
    rows = QUERIES["op2_lm_scoring"](spark, str(DATA)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert r.score == pytest.approx(plain.score(texts[r.doc_id]), rel=1e-9)
        assert r.base_score == pytest.approx(plain.base(texts[r.doc_id]), rel=1e-9)
        assert r.n_known == sum(t in plain.unigrams for t in tokens(texts[r.doc_id]))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_word_numbers_widen_beyond_four_bytes():
    top = kneser_ney.LARGEST_SHORT
    assert kneser_ney._number_type(top) is np.uint32
    assert kneser_ney._number_type(top + 1) is np.uint64


def test_wide_word_numbers_are_summed_and_packed_alike():
    grams = np.random.default_rng(5).integers(0, 9, (2, 500))
    for k in (2, 1):
        short, wide = (
            kneser_ney._summed(grams[:k].astype(t), np.ones(500, dtype=np.int64))
            for t in (np.uint32, np.uint64)
        )
        assert (short[0] == wide[0]).all() and (short[1] == wide[1]).all()
        for columns in (short[0], wide[0]):
            back = kneser_ney._unpack(kneser_ney._pack(columns)).reshape(k, -1)
            assert back.dtype == columns.dtype and (back == columns).all()


@pytest.mark.parametrize("bits", [5, 22, 32, 40])
def test_ngrams_are_summed_in_the_order_of_their_words(bits):
    rng = np.random.default_rng(bits)
    words = rng.integers(0, 1 << bits, 6, dtype=np.uint64)
    words[0] = (1 << bits) - 1
    grams = words[rng.integers(0, 6, (3, 400))].astype(kneser_ney._number_type(int(words[0])))
    counts = rng.integers(1, 9, 400)
    plain = Counter()
    for gram, n in zip(grams.T.tolist(), counts.tolist(), strict=True):
        plain[tuple(gram)] += n
    summed, sums = kneser_ney._summed(grams, counts)
    assert [tuple(g) for g in summed.T.tolist()] == sorted(plain)
    assert sums.tolist() == [plain[g] for g in sorted(plain)]
    assert summed.dtype == grams.dtype


def test_repeated_words_and_their_contexts_are_looked_up_once(documents, monkeypatch):
    docs = documents([(1, "a b a b c")])
    model = kneser_ney.train(docs)
    looked_up = Counter()
    find = HashTable.find

    def counted(self, hashes, *names, **options):
        looked_up[self.name] += len(hashes)
        return find(self, hashes, *names, **options)

    monkeypatch.setattr(HashTable, "find", counted)
    kneser_ney._scored([b"a b " * 500], model)
    # The words a and b and the end; contexts of one word are the start, a and b.
    assert looked_up["word"] == looked_up["context2"] == 3


def test_training_leaves_no_shuffle_files(spark, documents):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    docs = documents([(i, f"a b w{i}") for i in range(50)])
    before = shuffles()
    kneser_ney.train(docs)
    assert not shuffles() - before


@pytest.mark.parametrize("order", [2, 3])
def test_look_ups_do_not_open_more_files_when_shards_grow(documents, monkeypatch, order):
    # One token a shard: some hundred shards, which were as many times six files of each level.
    monkeypatch.setattr(kneser_ney, "TOKENS_PER_SHARD", 1)
    monkeypatch.setattr(kneser_ney, "WORDS_PER_SHARD", 1)
    monkeypatch.setattr(hash_table, "FILES", 4)
    texts = [f"w{i % 11} w{i % 7} v{i} w{i % 5}" for i in range(80)]
    model = kneser_ney.train(documents(list(enumerate(texts))), order)
    names = os.listdir(file_system(model.vocabulary.folder)[1])
    kinds = Counter(re.sub(r"-\d+-", "-", n) for n in names if not n.startswith("."))
    tables = {"word", *(f"gram{k}" for k in range(1, order + 1))}
    assert len(model.levels[1].table.sizes) == 400
    assert tables < {kind.split("-")[0] for kind in kinds}
    # A file has 64 shards at most.
    assert max(kinds.values()) <= 7
    plain = Plain(texts, order)
    probes = [*texts, "never w1", "w1 w1 v3", ""]
    rows = kneser_ney.score(documents(list(enumerate(probes))), model).collect()
    assert len(rows) == len(probes)
    for row in rows:
        assert row.score == pytest.approx(plain.score(probes[row.doc_id]), abs=1e-9)
        assert row.base_score == pytest.approx(plain.base(probes[row.doc_id]), abs=1e-9)


def test_lower_counts_of_many_shards_are_dealt_together(documents, monkeypatch):
    # Each shard's went out alone, one row for every shard of the next level: the square of them.
    monkeypatch.setattr(kneser_ney, "TOKENS_PER_SHARD", 10)
    written = []
    kept = kneser_ney.stored

    def stored(frame, label):
        out = kept(frame, label)
        written.append((label, out))
        return out

    monkeypatch.setattr(kneser_ney, "stored", stored)
    texts = [f"w{i % 11} w{i % 7} v{i} w{i % 5}" for i in range(80)]
    kneser_ney.train(documents(list(enumerate(texts))), 3)
    level = next(frame for label, frame in written if label == "level-3")
    shards = level.where("rows IS NOT NULL").count()
    assert shards > 20
    # The session shuffles to two tasks.
    assert level.where("rows IS NULL").count() <= 2 * 40
