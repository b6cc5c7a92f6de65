"""Language ID by Bayesian evidence fusion.

    P(language | everything) ~ P(text | language) P(declared | language) P(language | address)

* Text: hashed byte trigrams of the letters, lower-cased, of the whole text, against tables
  trained on a bounded sample of each label's documents. Trigrams overlap, so their sum counts as at
  most ``SATURATION`` independent ones.
* Declared markup language: how often pages of a language declare which language, counted over
  all rows.
* Address: language shares of hosts, smoothed towards those of the host's domain, these towards
  its suffix's, these towards all rows'; each level weighs ``SMOOTHING`` rows.

The shares come from grouped sums of the text's own verdicts (soft counts), summed on the map side,
so a host with a third of all rows costs one row per task. Everything but the text goes into one
table of (host, declared), which is joined back; texts are not shuffled while it is small.

A text is rejected if it has no trigram of letters, if even its best language explains it worse
than chance (a uniform draw of trigrams, the model of an unknown language), or if no language
reaches ``CONFIDENCE``.

Defined cases: a null or empty text is rejected, its language and confidence are what declaration
and address say. Null declarations and hosts are values of their own. Repeated rows count as they
come. Other columns are passed on, clashing ones replaced. Without training texts all is rejected,
with a null language.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.shared import broadcast_if_small, prepare, stored
from eventlake.llm.tokens import Texts, as_bytes, chunks, mix

SAMPLE = 4_000  # labelled documents of each label that the trigram tables are trained on
LEAST_LABELLED = 10  # documents of the whole table that make a label a language
BUCKETS = 1 << 14
PSEUDO_COUNT = 0.05
SATURATION = 60
SMOOTHING = 20.0
CONFIDENCE = 0.5

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
RESULT = "language string, confidence double, accepted boolean"


@dataclass(frozen=True)
class TextModel:
    """``table[bucket, language]``: natural logarithms of trigram chances."""

    languages: tuple[str, ...]
    table: np.ndarray


def train_text_model(labelled: DataFrame, sample: int = SAMPLE) -> TextModel:
    """Trigram tables from ``labelled`` (doc_id, text, lang): at most ``sample`` documents of each
    label, the first by a hash of their ids. Every label with ``LEAST_LABELLED`` rows is a language.
    """
    prepare(labelled.sparkSession)
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    sizes = broadcast_if_small(stored(sizes.where(F.col("rows") >= LEAST_LABELLED), "labels"))
    # About twice the sample of each label is ordered, all of a label that has no more.
    share = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("rows"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    chosen = (
        rows.select("doc_id", "text", "lang", draw.alias("draw"))
        .join(sizes, "lang")
        .where(F.col("draw") < share * F.lit(float(1 << 40)))
        .withColumn("place", place)
        .where(F.col("place") <= sample)
        .select("text", "lang")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = as_bytes(batch["text"]), batch["lang"].to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                sums = np.zeros(BUCKETS, dtype=np.int64)
                for a, b in chunks(own):
                    bucket, _ = _trigrams(own[a:b])
                    sums += np.bincount(bucket, minlength=BUCKETS)
                yield pa.record_batch(
                    {
                        "lang": pa.array([lang]),
                        "sums": pa.array([sums.tolist()], pa.list_(pa.int64())),
                    }
                )

    # One row per language and batch of the bounded samples.
    counted = chosen.mapInArrow(count, "lang string, sums array<long>").collect()
    sums: dict[str, np.ndarray] = {}
    for r in counted:
        sums[r["lang"]] = sums.get(r["lang"], 0) + np.array(r["sums"])
    languages = tuple(sorted(sums))
    table = np.zeros((BUCKETS, len(languages)))
    for i, language in enumerate(languages):
        smooth = sums[language] + PSEUDO_COUNT
        table[:, i] = np.log(smooth / smooth.sum())
    return TextModel(languages, table)


def identify(
    rows: DataFrame, model: TextModel, text: str, declared: Column, host: Column
) -> DataFrame:
    """All columns of ``rows`` and language, confidence and accepted."""
    spark = rows.sparkSession
    prepare(spark)
    rows = rows.drop("language", "confidence", "accepted")
    rows = rows.withColumns({"_declared": declared, "_host": host})
    if not model.languages:
        rejected = {
            "language": F.lit(None).cast("string"),
            "confidence": F.lit(None).cast("double"),
            "accepted": F.lit(False),
        }
        return rows.drop("_declared", "_host").withColumns(rejected)
    keys = ["_host", "_declared"]
    verdicts = _scored(rows.select(text, *keys), model, text).select(
        *keys, _softmax(F.col("_text")).alias("shares")
    )
    evidence = stored(_summed(verdicts, keys, len(model.languages)), "evidence")
    known = _log_evidence(evidence, len(model.languages))
    same = [F.col(k).eqNullSafe(F.col(f"known{k}")) for k in keys]
    joined = _scored(rows, model, text).join(
        broadcast_if_small(known), same[0] & same[1], "left"
    )
    total = F.zip_with("_text", "known_logs", lambda a, b: a + b)
    shares = joined.withColumn("_shares", _softmax(total))
    best = F.array_max("_shares")
    place = F.array_position("_shares", best).cast("int")
    return shares.select(
        *[c for c in rows.columns if c not in keys],
        F.get(F.lit(list(model.languages)), place - 1).alias("language"),
        best.alias("confidence"),
        (F.col("_fits") & (best >= CONFIDENCE)).alias("accepted"),
    )


# -- pages --------------------------------------------------------------------------------

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"<[^>]*>?")
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)


def page_text(markup: str) -> str:
    """The text between the tags, without scripts, styles and comments."""
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", markup)))


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with text, declared and host instead of the markup."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = [x or "" for x in batch["html"].to_pylist()]
            found = [_LANG.search(x) for x in sources]
            yield pa.record_batch(
                {
                    "page_id": batch["page_id"].cast(pa.int64()),
                    "url": batch["url"],
                    "text": pa.array([page_text(x) for x in sources], pa.string()),
                    "declared": pa.array([m and m[1].lower() for m in found], pa.string()),
                }
            )

    parsed = pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, declared string"
    )
    host = F.lower(F.regexp_extract("url", r"(?s)^.*?://([^/?#:]*)", 1))
    return parsed.withColumn("host", F.when(host != "", host))


# -- scoring and fusion -------------------------------------------------------------------


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every byte trigram that has a letter; other bytes are spaces."""
    chunk = Texts(texts)
    letter = _LETTER[chunk.bytes]
    data = np.where(letter, chunk.bytes, 0x20).astype(np.uint64)
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    some = letter[:-2] | letter[1:-1] | letter[2:]
    # None that reaches over the newline between two texts.
    text = np.repeat(np.arange(len(texts)), np.diff(np.append(chunk.begin, len(data) + 1)))[: len(data)]
    at = np.flatnonzero(some & (text[2:] == text[:-2]) & (np.arange(2, len(data)) < chunk.end[text[:-2]]))
    value = (data[at] << np.uint64(16)) | (data[at + 1] << np.uint64(8)) | data[at + 2]
    return (mix(value) % np.uint64(BUCKETS)).astype(np.int64), text[at]


def _scored(rows: DataFrame, model: TextModel, text: str) -> DataFrame:
    """``rows`` with _text, the tempered log likelihood of each language, and _fits."""
    added = T.StructType.fromDDL("_text array<double>, _fits boolean")
    schema = T.StructType([*rows.schema.fields, *added.fields])
    width, chance = len(model.languages), -np.log(BUCKETS)
    shared = rows.sparkSession.sparkContext.broadcast(model.table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            texts = as_bytes(batch[text])
            logs, fits = [np.zeros((0, width))], [np.zeros(0, dtype=bool)]
            for a, b in chunks(texts):
                bucket, owner = _trigrams(texts[a:b])
                n = np.bincount(owner, minlength=b - a)
                sums = np.stack(
                    [np.bincount(owner, table[bucket, i], minlength=b - a) for i in range(width)],
                    axis=1,
                )
                mean = sums / np.maximum(n, 1)[:, None]
                logs.append(mean * np.minimum(n, SATURATION)[:, None])
                fits.append((n > 0) & (mean.max(axis=1) > chance))
            flat = np.concatenate(logs)
            offsets = np.arange(len(flat) + 1, dtype=np.int32) * width
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel())),
                    pa.array(np.concatenate(fits)),
                ],
                names=[*batch.schema.names, "_text", "_fits"],
            )

    return rows.mapInArrow(run, schema)


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda done, x: done + x)
    return F.transform(powers, lambda x: x / total)


def _summed(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``shares`` added up by key, place by place."""
    sums = [F.sum(F.col("shares")[i]).alias(f"_{i}") for i in range(width)]
    added = rows.groupBy(*keys).agg(*sums)
    return added.select(*keys, F.array(*[F.col(f"_{i}") for i in range(width)]).alias("shares"))


def _log_evidence(evidence: DataFrame, width: int) -> DataFrame:
    """(known_host, known_declared, known_logs): log of address shares and declaration chances."""
    host = F.coalesce("_host", F.lit(""))
    domain = F.when(host.contains("."), F.substring_index(host, ".", -2)).otherwise(host)
    levels = evidence.withColumns(
        {
            "host": host,
            "domain": domain,
            "suffix": F.substring_index(host, ".", -1),
            "root": F.lit(0),
        }
    )
    names = ["root", "suffix", "domain", "host"]
    shares: DataFrame | None = None
    for depth, name in enumerate(names, start=1):
        own = _summed(levels, names[:depth], width)
        if shares is None:
            prior = F.array(*[F.lit(1.0 / width)] * width)
        else:
            own = own.join(shares, names[: depth - 1])
            prior = F.col("prior")
        shares = own.select(*names[:depth], _smoothed(F.col("shares"), prior).alias("prior"))
    declared = _summed(evidence, ["_declared"], width).withColumnRenamed("shares", "of_declared")
    total = _summed(levels, ["root"], width).select(F.col("shares").alias("of_language"), "root")
    kinds = evidence.select("_declared").distinct().count()
    # P(declared | language), with half a row of each declaration added.
    pairs = (
        levels.select("_host", "_declared", *names)
        .join(shares, names)
        .join(total, "root")
        .withColumnRenamed("_declared", "known_declared")
    )
    joined = pairs.join(
        declared, F.col("known_declared").eqNullSafe(F.col("_declared"))
    )
    chance = F.zip_with("of_declared", "of_language", lambda d, n: (d + 0.5) / (n + 0.5 * kinds))
    logs = F.zip_with("prior", chance, lambda p, c: F.log(p) + F.log(c))
    return stored(
        joined.select(F.col("_host").alias("known_host"), "known_declared", logs.alias("known_logs")),
        "known",
    )


def _smoothed(sums: Column, prior: Column) -> Column:
    total = F.aggregate(sums, F.lit(0.0), lambda done, x: done + x)
    return F.zip_with(sums, prior, lambda n, p: (n + SMOOTHING * p) / (total + SMOOTHING))
