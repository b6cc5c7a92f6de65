"""URL filters: exact key membership by a cascade of Bloom filters, without joins.

Level 0 encodes the listed keys. Level 1 encodes the keys of the corpus that level 0 takes for
listed, level 2 the listed keys that level 1 takes for false positives, and so on, until a level
has no false positive in the key universe. A key is listed exactly if the first level that does
not know it has an odd number (or, if all know it, if the last has an even one). The universe
holds every key that will be asked for, so the answers are exact.

Filters are bitmaps aggregated by Spark and constants of the probing plan. The first level has at
least ``BITS_PER_KEY`` bits for each listed key and so many more that it takes no more other keys
for listed than there are listed ones; so all later levels together are about as large, whatever
the corpus. The size is known before a filter is built: up to ``MAX_FILTER_BYTES`` one cascade has
all keys. Beyond that keys are split by a hash into as many shards as it takes, each with its own
cascade, and the rows of one shard after the other are judged and written to the shared folder.

A page's keys are its host and parent domains (as many labels as the longest listed host), each
joined with the beginnings of its path in the lengths that the rules have.

Defined cases: a null url or one without ``://`` has an empty host and path, is fitted by no rule
and gets the default verdict. Repeated rows keep their own result. Other columns are passed on,
clashing ones replaced. Empty rule lists, block lists and tables are allowed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.shared import ascii_lower, prepare, stored

BITS_PER_KEY, HASHES = 8, 5
MAX_FILTER_BYTES = 4 << 20
BITMAP_BITS = 32_768  # Spark's bitmap functions make bitmaps of this size


@dataclass(frozen=True)
class Cascade:
    """``levels``: bit count and bytes of each filter."""

    levels: tuple[tuple[int, bytes], ...]

    def knows(self, key: Column, level: int) -> Column:
        size, bits = self.levels[level]
        found, bitmap = F.lit(True), F.lit(bits)  # one constant for all positions
        for position in _positions(key, level, size):
            byte = F.conv(F.hex(F.substr(bitmap, F.floor(position / 8) + 1, F.lit(1))), 16, 10)
            bit = F.call_function("shiftright", byte.cast("int"), (position % 8).cast("int"))
            found &= bit.bitwiseAND(F.lit(1)) == 1
        return found

    def contains(self, key: Column) -> Column:
        """True for listed keys; exact for keys of the universe. False for null, which has a hash too."""
        result = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            result = F.when(self.knows(key, level), result).otherwise(F.lit(level % 2 == 1))
        return key.isNotNull() & result


def _positions(key: Column, level: int, size: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(size)) for i in range(HASHES)]


def build_cascade(
    listed: DataFrame, universe: DataFrame, bits_per_key: int = BITS_PER_KEY
) -> Cascade:
    """A cascade for the keys of ``listed`` over those of ``universe`` (both: key, may repeat)."""
    inside, outside = _apart(listed, universe)
    first = _first_bits(inside.count(), outside.count(), bits_per_key)
    return _cascade(inside, outside, first, bits_per_key)


def mark_listed(
    frame: DataFrame,
    key: str,
    listed: DataFrame,
    name: str,
    *,
    bits_per_key: int = BITS_PER_KEY,
    limit: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``frame`` with the column ``name``: whether its ``key`` is in ``listed`` (key), exactly.

    A null key is not listed.
    """
    inside, outside = _apart(listed, frame.select(F.col(key).alias("key")))
    few, many = inside.count(), outside.count()
    first = _first_bits(few, many, bits_per_key)
    # Shards are not quite equal.
    shards = max(1, math.ceil(few * first / 8 / (0.8 * limit)))
    if shards == 1:
        cascade = _cascade(inside, outside, first, bits_per_key)
        return frame.withColumn(name, cascade.contains(F.col(key)))
    parts = []
    for shard in range(shards):
        here = F.pmod(F.xxhash64(F.lit("shard"), "key"), F.lit(shards)) == shard
        cascade = _cascade(inside.where(here), outside.where(here), first, bits_per_key)
        mine = F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards)) == shard
        marked = frame.where(mine).withColumn(name, cascade.contains(F.col(key)))
        parts.append(stored(marked, f"shard-{shard}"))
    return reduce(DataFrame.unionByName, parts)


def _apart(listed: DataFrame, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct listed keys, and the other distinct keys of the universe."""
    inside = stored(listed.where("key IS NOT NULL").select("key").distinct(), "listed")
    outside = universe.where("key IS NOT NULL").select("key").distinct()
    return inside, stored(outside.join(inside, "key", "left_anti"), "universe")


def _first_bits(few: int, many: int, bits_per_key: int) -> int:
    """Bits per listed key for which about ``few`` of ``many`` other keys pass the first level."""
    if many <= few or few == 0:
        return bits_per_key
    passing = (few / many) ** (1 / HASHES)  # for one hash; the share of bits set
    return max(bits_per_key, math.ceil(-HASHES / math.log1p(-passing)))


def _cascade(inside: DataFrame, outside: DataFrame, first: int, bits_per_key: int) -> Cascade:
    levels: list[tuple[int, bytes]] = []
    encoded, other = inside, outside
    while True:
        count = encoded.count()
        if count == 0:
            # The level before had no false positive.
            return Cascade(tuple(levels) if levels else ((64, bytes(8)),))
        levels.append(_filter(encoded, len(levels), count, bits_per_key if levels else first))
        test = Cascade(tuple(levels)).knows(F.col("key"), len(levels) - 1)
        encoded, other = stored(other.where(test), f"level-{len(levels)}"), encoded


def _filter(keys: DataFrame, level: int, count: int, bits_per_key: int) -> tuple[int, bytes]:
    size = max(64, count * bits_per_key)
    # The bitmap functions count from 1.
    place = F.explode(F.array(*[p + 1 for p in _positions(F.col("key"), level, size)]))
    bitmaps = (
        keys.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()
    )
    whole = bytearray(-(-size // BITMAP_BITS) * BITMAP_BITS // 8)
    for row in bitmaps:
        start = (row["bucket"] - 1) * BITMAP_BITS // 8
        whole[start : start + BITMAP_BITS // 8] = row["bits"]
    return size, bytes(whole[: -(-size // 8)])


# -- urls ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the url's path starts with ``path``."""

    action: str
    host: str
    path: str

    def __post_init__(self):
        if self.action not in ("allow", "block") or not self.path.startswith("/"):
            raise ValueError(f"not a rule: {self}")

    @property
    def key(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    begin = F.instr(url, "://")
    rest = F.coalesce(F.when(begin > 0, F.substr(url, begin + 3)), F.lit(""))
    parts = r"(?s)^([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(rest, parts, 1)), F.regexp_extract(rest, parts, 2)


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    blocked_hosts: DataFrame,
    default: str = "allow",
    limit: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """All columns of ``pages`` and host, path, rule and verdict.

    The longest fitting rule decides. Without one, hosts of ``blocked_hosts`` (column key) are
    blocked and others get the default.
    """
    spark = pages.sparkSession
    prepare(spark)
    pages = pages.drop("host", "path", "rule", "verdict", "_listed", "_best")
    host, path = host_and_path(F.col("url"))
    placed = pages.select("*", host.alias("host"), path.alias("path"))
    keys = _rule_keys(rules)
    asked = stored(placed.select(F.explode(keys).alias("key")).distinct(), "asked")
    cascades = {
        action: build_cascade(_keys(spark, [r.key for r in rules if r.action == action]), asked)
        for action in ("allow", "block")
    }
    found = F.filter(
        F.transform(
            keys,
            lambda key: F.struct(
                F.length(key).alias("length"),
                key.alias("key"),
                F.when(cascades["allow"].contains(key), "allow")
                .when(cascades["block"].contains(key), "block")
                .alias("action"),
            ),
        ),
        lambda x: x["action"].isNotNull(),
    )
    judged = mark_listed(placed, "host", blocked_hosts, "_listed", limit=limit)
    judged = judged.withColumn("_best", F.array_max(found))
    own = F.when(F.col("_listed"), "block").otherwise(F.lit(default))
    return judged.select(
        *placed.columns,
        F.col("_best.key").alias("rule"),
        F.coalesce(F.col("_best.action"), own).alias("verdict"),
    )


def _rule_keys(rules: list[Rule]) -> Column:
    """A page's keys: parent domains joined with path beginnings."""
    labels = F.split("host", r"\.")
    depth = max((r.host.count(".") + 1 for r in rules), default=0)
    sizes = sorted({len(r.path) for r in rules})
    if not rules:
        return F.array().cast("array<string>")
    first = F.greatest(F.size(labels) - depth + 1, F.lit(1))
    domains = F.transform(
        F.sequence(first, F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sizes]),
        lambda x: x.isNotNull(),
    )
    return F.flatten(F.transform(domains, lambda d: F.transform(starts, lambda s: F.concat(d, s))))


def _keys(spark: SparkSession, keys: list[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], "key string")
