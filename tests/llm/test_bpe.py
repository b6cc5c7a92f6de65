"""Encoding and decoding against the tokenizer library on whole texts."""

import hashlib
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventlake.llm import bpe
from eventlake.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    None,
    "",
    " ",
    "a  b   c\n\n d\t\te \r\n f ",
    "It's we'll   don't 'S",
    "x<|endoftext|> y <|endoftext|>  z<|endoftext|>",
    "<|endoftext|> <|endof text|>",
    "non break  wide　 ideographic   line \u0085 next \x1c sep \x1f x",
    "é  ü  ​ ok “quoted” – dash",
    "日本語 テキスト 한국어 😀 👩‍👩‍👧 é \x00 nul",
    "word " * 20_000,
    "y" * 100_000,
    "same text",
    "same text",
]


def joined_words(text):
    words, numbers, counts = bpe.split_words([text.encode()])
    assert counts.sum() == len(numbers)
    return [words[i].decode() for i in numbers]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(
    st.text(
        alphabet=st.one_of(
            st.sampled_from(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0     　'sab1.<|>"),
            st.characters(codec="utf-8"),
        )
    )
)
def test_words_keep_the_ids(text):
    words = joined_words(text)
    assert "".join(words) == text
    assert [i for w in words for i in ids(w)] == ids(text)


def test_every_character_next_to_white_space():
    for start in range(0, 0x11000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c} {c}\n{c}  b" for c in chars)
        assert [i for w in joined_words(text) for i in ids(w)] == ids(text)


def test_encode_and_decode(spark, documents):
    docs = documents([(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id")])
    encoded = bpe.encode(docs.selectExpr("*", "1 AS block", "2 AS ids"), PATH)
    rows = bpe.decode(encoded, PATH).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert r.ids == ids(r.text)
        assert r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False)
        assert r.block == 1 and r.lang == "en"


def test_small_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 1)
    rows = bpe.encode(documents(list(enumerate(TEXTS))), PATH).collect()
    assert sorted((r.doc_id, r.ids) for r in rows) == [(i, ids(t)) for i, t in enumerate(TEXTS)]


def test_blocks_do_not_depend_on_batches(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 50)
    texts = [f"text number {i} " * (i % 4) for i in range(40)] + [None, "end"]
    whole = pa.table({"text": texts, "n": range(len(texts))})
    cuts = [[(b.name, t.num_rows) for b, t in bpe._blocks(iter(whole.to_batches(n)))] for n in (1, 3, 7, 99)]
    assert cuts[0] == cuts[1] == cuts[2] == cuts[3] and len(cuts[0]) > 5
    assert sum(rows for _, rows in cuts[0]) == len(texts)


def test_empty_table(documents):
    assert bpe.encode(documents([]), PATH).count() == 0
    assert bpe.encode_digests(documents([]), PATH).count() == 0


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_registered_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d in docs:
        i = ids(d.text)
        decoded = LIBRARY.decode(i, skip_special_tokens=False).encode()
        joined = ",".join(map(str, i)).encode()
        want[d.doc_id] = (len(i), *(hashlib.sha256(x).hexdigest() for x in (joined, decoded)))
    rows = QUERIES["op10_bpe_round_trip"](spark, str(DATA)).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_calls_of_the_library_are_bounded(monkeypatch):
    """Its results take many times the memory of the ids."""
    calls = []

    class Spy:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return LIBRARY.encode_batch_fast(texts, **options)

    monkeypatch.setattr(bpe, "CALL_TEXTS", 100)
    monkeypatch.setattr(bpe, "CALL_BYTES", 1_000)
    texts = ["a b", ""] * 150 + ["x " * 3_000, "end"]
    found = [ids.tolist() for ids in bpe.encode_ids(Spy(), texts)]
    whole = LIBRARY.encode_batch_fast(texts, add_special_tokens=False)
    assert found == [e.ids for e in whole]
    assert sum(calls) == len(texts) and max(calls) <= 100
    assert list(bpe.encode_ids(Spy(), [])) == []
