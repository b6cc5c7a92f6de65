"""Chat formatting by token-level assembly.

Roles and texts are encoded as segments of their own; control strings become reserved ids beyond
the vocabulary, spliced in between. So no text, whatever it says, can produce a control id. The
loss mask is the running sum of +1 at the first and -1 after the last token of each assistant text.

In the text form a control string inside a role or text is broken by a backslash after its first
character; one that is broken already gets one more. Control strings have that character at their
begin only, so this can always be undone (``unescape``).

    <s><|role|>user<|text|>Hello<|end|><|role|>assistant<|text|>Hi<|end|></s>

Turns are encoded as single rows, wherever they lie; a conversation meets in one row because it is
one row of the result.

Defined cases: turns are in the order of ``turn`` (null first), then of role and encoded text. A
null role or text is empty. Repeated rows are turns of their own. Rows without conv_id are one
conversation. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.bpe import encode_ids, pieces, tokenizer
from eventlake.llm.shared import prepare

LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Template:
    """Control strings. The first five mark the turns; the others are only escaped in texts."""

    begin: str = "<s>"
    role: str = "<|role|>"
    text: str = "<|text|>"
    turn_end: str = "<|end|>"
    end: str = "</s>"
    others: tuple[str, ...] = ("[INST]", "[/INST]")

    def __post_init__(self):
        for c in self.controls:
            if len(c) < 2 or "\\" in c or any(d[0] in c[1:] for d in self.controls):
                raise ValueError(f"control string {c!r} could overlap with another")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.begin, self.role, self.text, self.turn_end, self.end, *self.others)

    def _pattern(self, slashes: str) -> re.Pattern:
        parts = (f"{re.escape(c[0])}{slashes}(?={re.escape(c[1:])})" for c in self.controls)
        return re.compile("|".join(parts))

    def escape(self, text: str) -> str:
        return self._pattern(r"\\*").sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._pattern(r"\\+").sub(lambda m: m[0][:-1], text)


def format_conversations(
    rows: DataFrame, path: str, template: Template = Template()
) -> DataFrame:
    """(conv_id, n_turns, formatted, input_ids, loss_mask) per conversation.

    ``rows`` has conv_id, turn, role and text; ``path`` is a byte-level BPE vocabulary.
    """
    prepare(rows.sparkSession)
    first_id = tokenizer(path).get_vocab_size()  # here, so that assembling tasks load none

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {}
            for name in ("role", "text"):
                whole = [template.escape(x or "") for x in batch[name].to_pylist()]
                columns[name] = pa.array(whole, pa.string())
                columns[f"{name}_ids"] = _ids(whole, path)
            yield pa.record_batch(
                {"conv_id": batch["conv_id"], "turn": batch["turn"], **columns}
            )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, role, text, turn_end, end = range(first_id, first_id + 5)
        escaped_loss_role = template.escape(LOSS_ROLE)
        for batch in batches:
            out = []
            for turns in batch["turns"]:
                segments, formatted, spans = [[begin]], [template.begin], []
                fields = turns.values
                role_ids, text_ids = (_lists(fields.field(f"{x}_ids")) for x in ("role", "text"))
                roles, texts = (fields.field(x).to_pylist() for x in ("role", "text"))
                for own in zip(roles, role_ids, texts, text_ids, strict=True):
                    if own[0] == escaped_loss_role:
                        spans.append(len(segments) + 3)
                    segments += [[role], own[1], [text], own[3], [turn_end]]
                    formatted += [template.role, own[0], template.text, own[2]]
                    formatted.append(template.turn_end)
                segments.append([end])
                formatted.append(template.end)
                starts = np.append(0, np.cumsum([len(s) for s in segments]))
                step = np.zeros(starts[-1] + 1, dtype=np.int32)
                np.add.at(step, starts[spans], 1)
                np.add.at(step, starts[np.array(spans, dtype=int) + 1], -1)
                out.append(
                    {
                        "n_turns": len(fields),
                        "formatted": "".join(formatted),
                        "input_ids": np.concatenate(segments).astype(np.int32),
                        "loss_mask": np.cumsum(step)[:-1].astype(bool),
                    }
                )
            made = pa.Table.from_pylist(out, schema=_FORMATTED).combine_chunks()
            columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in made.columns]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], *columns], names=["conv_id", *_FORMATTED.names]
            )

    encoded = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    ).mapInArrow(
        encode,
        "conv_id long, turn long, role string, role_ids array<int>, text string, "
        "text_ids array<int>",
    )
    turn = F.struct("turn", "role", "text_ids", "role_ids", "text")
    together = encoded.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return together.mapInArrow(
        assemble,
        "conv_id long, n_turns long, formatted string, input_ids array<int>, "
        "loss_mask array<boolean>",
    )


def read_back(formatted: DataFrame, path: str, template: Template = Template()) -> DataFrame:
    """(conv_id, roles, texts, loss_text, formatted_chars), read off the ids and the mask alone."""
    prepare(formatted.sparkSession)
    # Sent, so that a task holds the pieces and not the tokenizer.
    shared = formatted.sparkSession.sparkContext.broadcast(pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        role, text, turn_end = (len(table) + i for i in (1, 2, 3))
        for batch in batches:
            roles, texts, losses = [], [], []
            ids_column, mask_column = _lists(batch["input_ids"]), _lists(batch["loss_mask"])
            for ids, mask in zip(ids_column, mask_column, strict=True):
                at = [np.flatnonzero(ids == c) for c in (role, text, turn_end)]
                own_roles, own_texts = (
                    [
                        template.unescape(_decoded(ids[a + 1 : b], table))
                        for a, b in zip(low, high, strict=True)
                    ]
                    for low, high in ((at[0], at[1]), (at[1], at[2]))
                )
                edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                runs = [ids[a:b] for a, b in edges.reshape(-1, 2)]
                roles.append(own_roles)
                texts.append(own_texts)
                losses.append("".join(template.unescape(_decoded(x, table)) for x in runs))
            strings = pa.list_(pa.string())
            yield pa.record_batch(
                {
                    "conv_id": batch["conv_id"],
                    "roles": pa.array(roles, strings),
                    "texts": pa.array(texts, strings),
                    "loss_text": pa.array(losses, pa.string()),
                    "formatted_chars": pa.array(
                        [len(x) for x in batch["formatted"].to_pylist()], pa.int64()
                    ),
                }
            )

    return formatted.select("conv_id", "input_ids", "loss_mask", "formatted").mapInArrow(
        run,
        "conv_id long, roles array<string>, texts array<string>, loss_text string, "
        "formatted_chars long",
    )


_FORMATTED = pa.schema(
    [
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("input_ids", pa.list_(pa.int32())),
        ("loss_mask", pa.list_(pa.bool_())),
    ]
)


def _ids(texts: list[str], path: str) -> pa.ListArray:
    library = tokenizer(path)
    library.encode_special_tokens = True  # their strings in a text are ordinary text
    try:
        ids = list(encode_ids(library, texts))
    finally:
        library.encode_special_tokens = False
    edges = np.cumsum([0, *map(len, ids)])
    flat = np.concatenate([np.zeros(0, dtype=np.int32), *ids])
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat))


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The rows of a list column without nulls as numpy arrays, made one at a time."""
    for row in column:
        yield row.values.to_numpy(zero_copy_only=False)


def _decoded(ids: np.ndarray, table: list[bytes]) -> str:
    return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


