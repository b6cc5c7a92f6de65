"""Benchmark decontamination: a prefix-filtered join of documents with windows of item words.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A window is
``width`` consecutive words of an item; an item of fewer words, but not none, is one window. A
document word is hit if it lies inside any occurrence of a window.

A window occurs only where each of its words does, so its rarest word is the whole prefix that a
containment of 1 needs. The join is on that word; it gives one possible start per position of
the word (positional bound), which must leave room for the window (length bound). Then the words
from there on are compared with the window's. All of this is one pass of generated code over the
documents: they are not shuffled, and only hits and one row per document leave the join.

The windows are broadcast if they measure up to ``broadcast_bytes``. Beyond that the positions of
words are shuffled to the windows, without their texts, and the possible starts are shuffled back
to the documents to be compared there.

Defined cases: a null or empty text has no words and is not hit. Rows of one doc_id are documents
of their own. Items without an id hit words but are not listed; items of one id are one. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import (
    BROADCAST_BYTES,
    ascii_lower,
    broadcast_if_small,
    measured_bytes,
    prepare,
    stored,
)

WIDTH = 10
# The characters between words, after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def windows_of(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(window, items): distinct windows and the ids of the items that have them."""
    words = items.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    return (
        words.select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start") + 1, F.lit(width)).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item_id").alias("items"))
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    return _report(_hits(docs, items, width, broadcast_bytes)).drop("text_hash")


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` without the documents that have a hit word."""
    hit = (
        _report(_hits(docs, items, width, broadcast_bytes))
        .where("contaminated")
        .select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (_text_hash() == F.col("hit_hash"))
    return docs.join(hit, same, "left_anti")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _hits(docs: DataFrame, items: DataFrame, width: int, broadcast_bytes: int) -> DataFrame:
    """One row per occurrence of a window, and one (``whole``) per document."""
    prepare(docs.sparkSession)
    docs = docs.select(
        "doc_id", _text_hash().alias("text_hash"), words_of(F.col("text")).alias("words")
    )
    windows = stored(windows_of(items, width), "windows")
    vocabulary = stored(windows.select(F.explode("window").alias("word")).distinct(), "item-words")
    frequency = (
        docs.select(F.explode("words").alias("word"))
        .join(broadcast_if_small(vocabulary, broadcast_bytes), "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A window with a word that no document has gets no row here, and can have no occurrence.
    rarest = (
        windows.select("window", "items", F.posexplode("window").alias("place", "word"))
        .join(frequency, "word", "left")
        .groupBy("window")
        .agg(
            F.first("items").alias("items"),
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("rarest"),
        )
        .where("rarest.n > 0")
        .select("rarest.word", "rarest.place", "window", "items", F.size("window").alias("length"))
    )
    spark = docs.sparkSession
    # No word is empty: the empty word at a document's end meets this row, so no document is lost.
    whole = spark.createDataFrame(
        [("", 0, [], [], 0)],
        "word string, place int, window array<string>, items array<long>, length int",
    )
    prefixes = stored(rarest.unionByName(whole), "prefixes")
    words, length = F.concat("words", F.array(F.lit(""))), F.col("length")
    start = F.col("position") - F.col("place")
    fits = (length == 0) | ((start >= 0) & (start + length <= F.col("n_words")))
    same = (length == 0) | (F.slice("words", start + 1, length) == F.col("window"))
    keys, size = ["doc_id", "text_hash"], F.size("words").alias("n_words")
    if measured_bytes(prefixes) <= broadcast_bytes:
        # Words stay in their row until the join has thrown away what is no hit.
        placed = docs.select(*keys, "words", size, F.posexplode(words).alias("position", "word"))
        found = placed.join(F.broadcast(prefixes), "word").where(fits & same)
    else:
        placed = docs.select(*keys, size, F.posexplode(words).alias("position", "word"))
        possible = placed.join(prefixes, "word").where(fits)
        texts = docs.select(*(F.col(k).alias(f"own_{k}") for k in keys), "words").distinct()
        own = F.col("doc_id").eqNullSafe(F.col("own_doc_id"))
        own &= F.col("text_hash") == F.col("own_text_hash")
        found = possible.join(texts, own).where(same)
    return found.select(
        *keys,
        "n_words",
        (length == 0).alias("whole"),
        F.struct(start.alias("start"), (start + length).alias("stop")).alias("span"),
        "items",
    )


def _report(hits: DataFrame) -> DataFrame:
    rows = hits.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if("whole").alias("copies"),
        F.collect_set(F.when(~F.col("whole"), F.col("span"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # Length of the union of the spans: each adds what lies beyond the furthest end so far.
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda done, x: F.struct(
            (
                done["n"]
                + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], done["reach"]))
            ).alias("n"),
            F.greatest(done["reach"], x["stop"]).alias("reach"),
        ),
        lambda done: done["n"],
    )
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return rows.select(
        "doc_id",
        "text_hash",
        "n_words",
        covered.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")
