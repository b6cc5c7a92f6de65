"""Document fingerprints by I-Match, with several randomised lexicon subsets.

Terms are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. The lexicon
keeps the terms whose inverse document frequency, log2 of documents per document with the term,
lies within a band. A document's distinct lexicon terms, sorted, are hashed once per subset of the
lexicon; the fingerprint is the list of these hashes. Subsets come in families: a family's first
keeps a term with a chance of one half, and each further one half of the terms of the one before,
drawn from the term's own digest. Large subsets tell small documents apart, small ones find what
long documents share. A text that has terms, but none in any subset, is told by the digest of all
its distinct terms instead, the last entry of the list, which is empty for all others.

The likeness of two fingerprints is the share of agreeing entries, among those that either document
has; it is 1 if there are none, as then neither has terms. A subset weighs the inverse of its chance, so that
the subsets of a few terms decide, which a partial edit leaves alone.

The band's upper end bounds the lexicon: a term is in at least N / 2**max_idf documents, so there
are at most 2**max_idf times the mean number of distinct terms. Its measured size decides whether
it is broadcast or shuffled. Documents' terms meet in the task that split them, so with a broadcast
lexicon one row per document is shuffled, not its terms.

Defined cases: a null or empty text has no terms and the fingerprint of no terms, which only such
texts have. Rows of one
doc_id are documents of their own; equal texts have equal fingerprints. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.decontaminate import SEPARATORS
from eventlake.llm.shared import ascii_lower, broadcast_if_small, prepare, stored

# Each family takes a slice of the term's digest; its subsets have chances 1/2, 1/4 ... 1/512.
FAMILIES, CHANCES, SLICE_BITS = 6, 9, 10
FIRST_STEP = 3  # subsets of a family up to here are cut from its first, the others from the next
MIN_IDF, MAX_IDF = 2.0, 10.0
HASH_DIGITS = 8
WHOLE = "_all_terms"


@dataclass(frozen=True)
class Band:
    """Terms with an inverse document frequency from ``low`` to ``high`` (both kept)."""

    low: float = MIN_IDF
    high: float = MAX_IDF

    def __post_init__(self):
        if not 0 <= self.low <= self.high:
            raise ValueError("the band must rise from 0 or more")


def terms_of(text: Column) -> Column:
    """Distinct terms."""
    words = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(F.array_distinct(words), "")


def lexicon_of(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """(term, draw): the terms of the band, with the digest that decides on their subsets.

    The empty term, which no document has, stands for a document's end.
    """
    spark = docs.sparkSession
    prepare(spark)
    counted = docs.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term")
    total = docs.count()
    frequency = F.col("documents")
    kept = (
        counted.agg(F.count(F.lit(1)).alias("documents"))
        .where(frequency * 2.0**band.high >= total)
        .where(frequency * 2.0**band.low <= total)
    )
    digits = F.substring(F.md5("term"), 1, FAMILIES * SLICE_BITS // 4)
    draw = F.conv(digits, 16, 10).cast("long")
    end = spark.createDataFrame([("", 0)], "term string, draw long")
    return stored(kept.select("term", draw.alias("draw")).unionByName(end), "lexicon")


def fingerprints(texts: DataFrame, lexicon: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, the other columns of ``texts`` but the text, and ``hashes`` (array<string>).

    ``keys`` must name the rows. Where ``texts`` is partitioned by some of them already, nothing
    but the lexicon moves.
    """
    others = [c for c in texts.columns if c not in (*keys, "text")]
    rows = texts.withColumn("text", terms_of(F.col("text")))
    # The digest of all terms goes with the end, so it is stored once per document.
    ended = F.concat("text", F.array(F.lit("")))
    joined = (
        rows.select(*keys, *others, _all_terms(F.col("text")).alias(WHOLE), F.explode(ended).alias("term"))
        .withColumn(WHOLE, F.when(F.col("term") == "", F.col(WHOLE)))
        .join(broadcast_if_small(lexicon), "term")
    )
    term = F.when(F.col("term") != "", F.struct("term", "draw"))
    found = joined.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in others],
        F.max(WHOLE).alias(WHOLE),
        F.sort_array(F.collect_list(term)).alias("terms"),
    )
    hashed = _hashed(found, [*keys, *others, WHOLE])
    left = F.when(F.array_join("hashes", "") == "", F.col(WHOLE)).otherwise("")
    return hashed.select(*keys, *others, F.concat("hashes", F.array(left)).alias("hashes"))


def _all_terms(terms: Column) -> Column:
    """Digest of all distinct terms; empty without any."""
    whole = F.md5(F.array_join(F.sort_array(terms), " "))
    return F.when(F.size(terms) == 0, "").otherwise(whole)


def _hashed(found: DataFrame, names: list[str]) -> DataFrame:
    """``names`` and ``hashes``. Subsets are cut from larger ones, in steps that are kept apart."""
    families, step = range(FAMILIES), FIRST_STEP + 1
    wide = {f"wide{f}": _subset(F.col("terms"), f, 1) for f in families}
    narrow = {f"narrow{f}": _subset(F.col(f"wide{f}"), f, step) for f in families}
    hashes = [
        _hash(_subset(F.col(f"wide{f}" if size < step else f"narrow{f}"), f, size))
        for f in families
        for size in range(1, CHANCES + 1)
    ]
    cut = found.withColumns(wide).drop("terms").withColumns(narrow)
    return cut.select(*names, F.array(*hashes).alias("hashes"))


def _subset(terms: Column, family: int, size: int) -> Column:
    """The terms whose slice of the digest begins with ``size`` zeros."""
    mask = ((1 << size) - 1) << (family * SLICE_BITS)
    return F.filter(terms, lambda t: t["draw"].bitwiseAND(F.lit(mask)) == 0)


def _hash(terms: Column) -> Column:
    names = F.array_join(F.transform(terms, lambda t: t["term"]), " ")
    return F.when(F.size(terms) == 0, "").otherwise(F.substring(F.md5(names), 1, HASH_DIGITS))


def likeness(a: Column, b: Column) -> Column:
    """Weighted share of agreeing entries among those that either has."""
    subsets = [2 << k for _ in range(FAMILIES) for k in range(CHANCES)]
    weights = F.lit([*subsets, 2])  # the last: the digest of all terms, never beside others
    filled = F.filter(
        F.arrays_zip(a.alias("a"), b.alias("b"), weights.alias("weight")),
        lambda p: (p["a"] != "") | (p["b"] != ""),
    )

    def weight(pairs: Column) -> Column:
        return F.aggregate(pairs, F.lit(0), lambda total, p: total + p["weight"])

    agreeing = F.filter(filled, lambda p: p["a"] == p["b"])
    return F.when(F.size(filled) == 0, F.lit(1.0)).otherwise(weight(agreeing) / weight(filled))


# -- fingerprints of documents and of their edited texts ----------------------------------

ROWS_PER_BUCKET, MAX_BUCKETS = 1_000, 16_384


def edited_fingerprints(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """Each document's fingerprint beside that of an edited text and of the next document.

    The edited text has the last third of its characters replaced by the first ones of the next
    document in descending order of doc_id, after the last the first. Nulls come last in that
    order, rows of one id by descending text.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    lexicon = lexicon_of(docs, band)
    placed = _with_next(docs)
    size = F.char_length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), size - third), F.substr("next_text", F.lit(1), third)
    )
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), edited.alias("text")),
    )
    named = ["bucket", "row", "doc_id", "guest", "n_chars", "edited_sha256"]
    both = (
        placed.withColumns({"n_chars": size.cast("long"), "edited_sha256": F.sha2(edited, 256)})
        .select(*named, F.explode(kinds).alias("t"))
        .select(*named, "t.*")
        .where("kind = 0 OR NOT guest")
    )
    hashed = fingerprints(both, lexicon, ["bucket", "row", "kind"])
    # Rows of a bucket are still together: neither of these steps shuffles.
    wide = hashed.groupBy("bucket", "row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "guest", "n_chars", "edited_sha256")],
        F.max(F.when(F.col("kind") == 0, F.col("hashes"))).alias("own"),
        F.max(F.when(F.col("kind") == 1, F.col("hashes"))).alias("edited"),
    )
    following = F.lead("own").over(Window.partitionBy("bucket").orderBy("row"))
    return (
        wide.withColumn("following", following)
        .where("NOT guest")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            F.array_join("own", ".").alias("fingerprint"),
            F.array_join("edited", ".").alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("edited")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
        )
    )


def _with_next(docs: DataFrame) -> DataFrame:
    """(bucket, row, guest, doc_id, text, next_text): rows by descending id within buckets of ids.

    Buckets are cut at quantiles, so that no task orders more than its share. Each bucket has one
    guest at its end, the first row of the next bucket, whose text its last row needs.
    """
    count = docs.count()
    wanted = min(MAX_BUCKETS, max(1, count // ROWS_PER_BUCKET))
    shares = [i / wanted for i in range(1, wanted)]
    cuts = docs.approxQuantile("doc_id", shares, 0.25 / wanted) if shares and count else []
    bucketed = docs.withColumn("bucket", _bucket(F.col("doc_id"), sorted({int(c) for c in cuts})))
    tops = bucketed.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()
    tops = sorted(((r["bucket"], r["top"]) for r in tops), reverse=True)
    # The first row after each bucket: that of the next lower one, at last of the highest.
    follower = {
        bucket: tops[(i + 1) % len(tops)][1] for i, (bucket, _) in enumerate(tops)
    }
    ids = [t for _, t in tops if t is not None]
    heads = docs.where(F.col("doc_id").isin(ids)) if ids else docs.limit(0)
    if any(t is None for _, t in tops):
        heads = heads.unionByName(docs.where("doc_id IS NULL"))
    heads = heads.groupBy("doc_id").agg(F.max("text").alias("text"))
    homes = docs.sparkSession.createDataFrame(
        list(follower.items()), "bucket int, next_id long"
    )
    guests = homes.join(heads, F.col("next_id").eqNullSafe(F.col("doc_id"))).select(
        "doc_id", "text", "bucket", F.lit(True).alias("guest")
    )
    everyone = bucketed.withColumn("guest", F.lit(False)).unionByName(guests)
    order = Window.partitionBy("bucket").orderBy(
        "guest", F.desc_nulls_last("doc_id"), F.desc("text")
    )
    return everyone.select(
        "bucket",
        F.row_number().over(order).alias("row"),
        "guest",
        "doc_id",
        "text",
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text"),
    )


def _bucket(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts are at most the id, by binary search; -1 for null."""
    steps = []
    while 1 << len(steps) <= len(cuts):
        steps.append(1 << len(steps))
    if not steps:
        found = F.lit(0)
    else:
        padded = F.lit(cuts).cast("array<long>")
        found = F.aggregate(
            F.lit(steps[::-1]),
            F.lit(0),
            lambda low, step: F.when(
                (low + step <= len(cuts)) & (F.get(padded, low + step - 1) <= doc_id), low + step
            ).otherwise(low),
        )
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(found).cast("int")
