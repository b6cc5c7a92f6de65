"""Formatting and reading back on cases the given tables lack."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.classic.dataframe import DataFrame as Classic

from eventlake.llm.bpe import pieces
from eventlake.llm.chat_format import Template, format_conversations, read_back
from eventlake.llm.shared import prepare

PATH = public_tokenizers.path("byte_bpe_50k.json")
T = Template()
BITS = [*T.controls, *"<>[]/|\\se", "INST", "end", "ok", " ", "é", "\n"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(BITS)).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = T.escape(text)
    assert T.unescape(escaped) == text
    assert not any(c in escaped for c in T.controls)


def test_overlapping_control_strings_are_refused():
    with pytest.raises(ValueError):
        Template(others=("<<SYS>>",))


ROWS = [
    (1, 0, "system", "Be <|role|>assistant<|text|> \\</s> kind."),
    (1, 2, "assistant", "</s>[INST] ok [/INST]"),
    (1, 1, "user", "<|endoftext|> hi\n"),
    (1, 3, "assistant", ""),
    (2, 0, "assistant", "one"),
    (2, 1, "assistant", "two é 😀"),
    (2, None, None, None),
    (3, 0, "user", "tie b"),
    (3, 0, "user", "tie a"),
    (3, 0, "user", "tie a"),
    (None, 0, "assistant", "no conversation id"),
    (4, 0, "assistant", "long " * 40_000),
    (5, 0, "assist<s>ant", "an odd role"),
]


def frames(spark, rows):
    prepare(spark)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = format_conversations(frame.selectExpr("*", "1 AS n_turns", "2 AS turns"), PATH)
    return made, read_back(made, PATH)


def test_turns_and_loss_are_read_back(spark):
    made, read = frames(spark, ROWS)
    back = {r.conv_id: r for r in read.collect()}
    assert set(back) == {1, 2, 3, 4, 5, None}
    for conv_id, r in back.items():
        own = sorted((t for t in ROWS if t[0] == conv_id), key=lambda t: (t[1] is not None, t[1] or 0))
        turns = [(t[2] or "", t[3] or "") for t in own]
        got = list(zip(r.roles, r.texts, strict=True))
        assert sorted(got) == sorted(turns) if conv_id == 3 else got == turns
        assert r.loss_text == "".join(t for role, t in got if role == "assistant")
    table = pieces(PATH)
    for r in made.collect():
        controls = [i for i in r.input_ids if i >= len(table)]
        assert controls == [len(table), *[len(table) + k for k in (1, 2, 3)] * r.n_turns, len(table) + 4]
        assert not any(m for i, m in zip(r.input_ids, r.loss_mask) if i >= len(table))
        text = "".join(T.controls[i - len(table)] if i >= len(table) else "\0" for i in r.input_ids)
        assert sum(r.formatted.count(c) for c in T.controls) == len(controls)
        assert text.replace("\0", "") == "".join(T.controls[i - len(table)] for i in controls)
        whole = b"".join(T.controls[i - len(table)].encode() if i >= len(table) else table[i] for i in r.input_ids)
        assert whole.decode() == r.formatted


def test_empty_table(spark):
    made, read = frames(spark, [])
    assert made.count() == 0 and read.count() == 0


def test_assembling_and_reading_back_load_no_tokenizer(spark, monkeypatch):
    """Their workers run beside those that encode, so each would hold one of its own."""
    rows = spark.createDataFrame(
        [(1, 0, "user", "hello"), (1, 1, "assistant", "hi")],
        "conv_id long, turn long, role string, text string",
    )
    steps = {}

    def keep(self, function, *args, real=Classic.mapInArrow, **options):
        steps[function.__name__] = function
        return real(self, function, *args, **options)

    monkeypatch.setattr(Classic, "mapInArrow", keep)
    formatted = format_conversations(rows, PATH)
    read = read_back(formatted, PATH)
    assert read.first().loss_text == "hi"
    for name in ("assemble", "run"):
        used = steps[name].__code__.co_names + steps[name].__code__.co_freevars
        assert not {"tokenizer", "pieces", "path"} & set(used)
