"""Personal data: candidate spans scored by boosted trees, beside fixed base patterns.

Base spans are the leftmost non-overlapping matches of one pattern per kind that pass its check
(parts up to 255, digit counts, Luhn); they are always reported. Generators of high recall propose
further spans, which may overlap: addresses spelled out or without a top level, dotted numbers of
any size, long digit groups, dialling formats without a plus sign.

Boosted trees are fitted on candidates of this corpus. Positives are the base spans and rewritings of
them in place that the base patterns do not match: no plus sign, spelled-out @ and dots, other
separators. Against them stand the proposed spans. Most of these are unlabelled; some are known to
be wrong, as they fail their kind's check, stand in an identifier or behind a reference word, or lie
on a base span of another kind. As such spans may be easy, others are made: plain numbers, amounts
in groups of three and dates, put between two words of the running text, which mostly pass the
check of a phone or a card, and addresses without a top level or of a wrong number of parts.

A threshold per kind is set on held-out documents to the wanted precision: of rewritten spans
against wrong and made ones and those unlabelled ones that are likely wrong. How many of these are
is estimated from both sides: of a share p of right ones among them, as many should pass a threshold
as of the rewritten ones, so p is at most the least ratio of the two over all thresholds, and what
passes beyond that is an error. A proposed span above the threshold is added, unless it overlaps a
base span. Without enough examples of both sorts nothing is added.

The trees see about ``SAMPLE`` candidates, drawn by a hash of their document and place, of each kind
and sort the same number as far as there are; the thresholds see all held-out ones. Trees become one SQL expression, so each document is searched, scored and reported within its row.
Positions are code points.

Java's regular expressions try every begin of a long run anew and recurse in repeated groups. The
patterns below therefore begin only where a match can begin, and repeat without backtracking
where none is possible: same matches, linear time.

Defined cases: a null or empty text has no spans. Rows of one doc_id are documents of their own.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import prepare, stored

KINDS = ("email", "ip", "card", "phone")
# The base patterns of the contract, written for Java as described above.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@| ?[(\[](?:at|AT)[)\]] ?)"
    r"[A-Za-z0-9-]++(?:(?:\.| ?[(\[](?:dot|DOT)[)\]] ?)[A-Za-z0-9-]++)*+",
    "ip": r"(?:\G|(?<![0-9.]))[0-9]++(?:(?:\.| ?[(\[](?:\.|dot|DOT)[)\]] ?)[0-9]++){2,}+",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[ ._-]?[0-9]){11,}+",
    "phone": r"(?:\G|(?<![0-9(+]))[(+]*+[0-9](?:[ ().-]{0,2}[0-9]){6,}+",
}
# What every match of a generator has; texts without it are not searched.
LIKELY = {
    "email": r"@|[(\[](?:at|AT)[)\]]",
    "ip": r"[0-9](?:\.| ?[(\[])",
    "card": r"[0-9][ ._-]?[0-9]",
    "phone": r"[0-9][ ().-]{0,2}[0-9]",
}
CONTEXT = 32  # characters before a span that the features look at
# Words that often stand before personal data, in the languages of the tables.
CONTEXT_WORDS = r"(?i)\b(?:e-?mail|mail|contact|phone|tel|call|fax|mobile|card|visa|account|ip|host|server|kontakt|telefon|karte|tarjeta|carte|correo|courriel|llame|appel)"
REFERENCE_WORDS = r"(?i)(?:\bno|\bnr|\bid|\bref|order|version|build|isbn|page|item|key|token|password)[ .:#=\"]*$|[#=\"/_-]$"
TOP_LEVEL = r"(?:\.| ?[(\[](?:dot|DOT)[)\]] ?)[A-Za-z-]{2,}$"
FEATURES = (
    "is_email", "is_ip", "is_card", "is_phone", "chars", "digits", "groups", "longest_group",
    "first_digit", "dots", "separators", "near_word", "near_reference", "after_letter",
    "before_letter", "distinct_digits", "passes_check", "first_group", "last_group",
)
SAMPLE, LEAST_EXAMPLES, LEAST_HELD = 20_000, 50, 10
# What a candidate of the fit is.
IS_BASE, IS_REWRITTEN, IS_UNLABELLED, IS_WRONG, IS_MADE = range(5)
TREES, DEPTH = 10, 3
PRECISION = 0.98
DECIMALS = 3  # of margins, so that there are few different ones

_SPAN = "struct<kind:int,start:int,end:int,text:string>"


@dataclass(frozen=True)
class Model:
    """Boosted trees as (weight, tree); a tree is a number or (feature, threshold, left, right).

    ``thresholds`` has the least margin of each kind, None where nothing is to be added. ``held_out``
    has what it keeps there: (recall of rewritten spans, precision by the estimate above).
    """

    trees: tuple = ()
    thresholds: tuple = (None,) * len(KINDS)
    held_out: tuple = (None,) * len(KINDS)


NO_MODEL = Model()


def base_spans(text: Column) -> Column:
    """array of (kind, start, end, text) by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    checks = {"email": lambda t: F.lit(True), "ip": _small_parts, "card": _card, "phone": _phone}
    needs = {"email": "@", "phone": "+", "ip": ".", "card": ""}
    found = []
    for number, kind in enumerate(KINDS):
        own = _checked(_spans(text, number, BASE[kind]), checks[kind])
        likely = F.contains(text, F.lit(needs[kind])) & text.rlike("[@0-9]")
        found.append(F.when(likely, own).otherwise(_none()))
    return _ordered(F.concat(*found))


def proposed_spans(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.concat(
        *[
            F.when(text.rlike(LIKELY[k]), _spans(text, n, GENERATORS[k])).otherwise(_none())
            for n, k in enumerate(KINDS)
        ]
    )


def fit(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> Model:
    """Trees and thresholds from the spans of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    spans = docs.select(
        "doc_id", text.alias("text"), base_spans(text).alias("base"), proposed_spans(text).alias("new")
    ).where(F.size("new") + F.size("base") > 0)
    sorts = {
        IS_BASE: F.col("base"),
        IS_REWRITTEN: F.flatten(F.transform("base", _rewritten)),
        IS_UNLABELLED: _apart("new", "base"),
        IS_WRONG: _mistaken("new", "base"),
        IS_MADE: F.flatten(F.transform("base", lambda s: _made_wrong(F.col("text"), s))),
    }
    labelled = F.concat(*[_of_sort(x, sort) for sort, x in sorts.items()])
    found = spans.select("doc_id", "text", F.explode(labelled).alias("x")).select(
        F.xxhash64("doc_id", "x").alias("draw"),
        (F.pmod(F.xxhash64("doc_id", "text"), F.lit(5)) == 1).alias("held"),
        F.col("x.s.kind").alias("kind"),
        F.col("x.sort").alias("sort"),
        _features(F.col("text"), F.col("x.s")).alias("f"),
    )
    wrong = (F.col("sort") == IS_UNLABELLED) & _known_wrong(F.col("f"))
    rows = found.withColumn("sort", F.when(wrong, IS_WRONG).otherwise(F.col("sort"))).withColumn(
        "label", (F.col("sort") <= IS_REWRITTEN).cast("double")
    )
    candidates = stored(rows, "candidates")
    for_fit = candidates.where("NOT held")
    sizes = {
        (r["kind"], r["sort"]): r["count"] for r in for_fit.groupBy("kind", "sort").count().collect()
    }
    positive = sum(n for (_, sort), n in sizes.items() if sort <= IS_REWRITTEN)
    if min(positive, sum(sizes.values()) - positive) < LEAST_EXAMPLES:
        return NO_MODEL
    drawn = F.pmod("draw", F.lit(1 << 40)) < F.lit(float(1 << 40)) * _share(sizes, sample)
    taken = stored(for_fit.where(drawn), "sample")
    wide = taken.select("label", *[F.col("f")[n].alias(n) for n in FEATURES])
    wide = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(wide)
    # Leaves of several rows: a few personal spans among the unlabelled ones get none of their own.
    learner = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, minInstancesPerNode=LEAST_HELD
    )
    fitted = learner.fit(wide.coalesce(1))
    trees = tuple(
        (float(weight), _tree(tree._java_obj.rootNode()))
        for weight, tree in zip(fitted.treeWeights, fitted.trees, strict=True)
    )
    # All held-out candidates, as counts by kind and rounded margin.
    tested = candidates.where("held").where(F.col("sort") != IS_BASE)
    margin = F.round(_margin(trees, F.col("f")), DECIMALS).alias("margin")
    counted = tested.groupBy("kind", margin).agg(
        F.count_if(F.col("sort") == IS_REWRITTEN).alias("hits"),
        F.count_if(F.col("sort").isin(IS_WRONG, IS_MADE)).alias("wrong"),
        F.count_if(F.col("sort") == IS_UNLABELLED).alias("unlabelled"),
    )
    steps: list[list] = [[] for _ in KINDS]
    for r in counted.orderBy(F.desc("margin")).collect():  # few: margins are rounded
        steps[r["kind"]].append((r["margin"], r["hits"], r["wrong"], r["unlabelled"]))
    thresholds, kept = zip(*[_threshold(s, precision) for s in steps], strict=True)
    return Model(trees, thresholds, kept)


def find_spans(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``base`` and ``spans``, arrays of (kind, start, end, text)."""
    prepare(docs.sparkSession)
    docs = docs.drop("base", "spans")
    with_base = docs.withColumn("base", base_spans(F.col("text")))
    if all(t is None for t in model.thresholds):
        return with_base.withColumn("spans", F.col("base"))
    text = F.coalesce("text", F.lit(""))

    def good(x: Column) -> Column:
        margin = F.round(_margin(model.trees, x["f"]), DECIMALS)
        result = F.lit(False)
        for kind, threshold in enumerate(model.thresholds):
            if threshold is not None:
                result |= (x["s"]["kind"] == kind) & (margin >= threshold)
        return result

    # Features are an array of their own, as the trees name them many times.
    proposed = F.transform(
        _apart(proposed_spans(text), "base"),
        lambda s: F.struct(s.alias("s"), _features(text, s).alias("f")),
    )
    added = F.transform(F.filter(proposed, good), lambda x: x["s"])
    return with_base.withColumn("spans", _ordered(F.concat("base", added)))


def redact(found: DataFrame) -> DataFrame:
    """The result of ``find_spans`` with ``redacted``: each stretch of spans replaced by its kind."""
    state = "struct<out:string,reach:int>"
    text = F.coalesce("text", F.lit(""))
    mark = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(done: Column, s: Column) -> Column:
        gap = F.substr(text, done["reach"] + 1, F.greatest(s["start"] - done["reach"], F.lit(0)))
        more = F.when(s["start"] >= done["reach"], F.concat(gap, F.get(mark, s["kind"])))
        return F.struct(
            F.concat(done["out"], F.coalesce(more, F.lit(""))).alias("out"),
            F.greatest(done["reach"], s["end"]).alias("reach"),
        ).cast(state)

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("reach")).cast(state)
    whole = F.aggregate(
        "spans",
        start,
        step,
        lambda done: F.concat(done["out"], F.substr(text, done["reach"] + 1)),
    )
    return found.withColumn("redacted", F.when(F.col("text").isNotNull(), whole))


def listed(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


# -- spans --------------------------------------------------------------------------------


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _spans(text: Column, kind: int, pattern: str) -> Column:
    """All matches with their places, from the matches and the text between them."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    state = f"struct<at:int,found:array<{_SPAN}>>"

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["match"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["match"].alias("text")
        )
        return F.struct(end.alias("at"), F.concat(done["found"], F.array(span)).alias("found")).cast(state)

    pairs = F.arrays_zip(between.alias("gap"), matches.alias("match"))
    begin = F.struct(F.lit(0).alias("at"), _none().alias("found")).cast(state)
    return F.aggregate(
        F.filter(pairs, lambda x: x["match"].isNotNull()), begin, step, lambda done: done["found"]
    )


def _checked(spans: Column, check) -> Column:
    return F.filter(spans, lambda s: check(s["text"]))


def of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _ordered(spans: Column) -> Column:
    by_place = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["text"].alias("text")
        ),
    )
    return F.transform(
        F.array_sort(by_place),
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")
        ),
    ).cast(f"array<{_SPAN}>")


def _apart(spans: Column | str, others: Column | str) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(
        spans,
        lambda s: ~F.exists(others, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])),
    )


def _mistaken(spans: str, others: str) -> Column:
    """The spans that overlap others, but none of their own kind."""

    def touches(s: Column, o: Column) -> Column:
        return (s["start"] < o["end"]) & (o["start"] < s["end"])

    return F.filter(
        spans,
        lambda s: F.exists(others, lambda o: touches(s, o))
        & ~F.exists(others, lambda o: touches(s, o) & (s["kind"] == o["kind"])),
    )


def _matches(pattern: str):
    return lambda text: text.rlike(pattern)


def _rewritten(span: Column) -> Column:
    """Forms of a base span that its pattern does not match, at the same place."""
    text = span["text"]
    name, host = F.substring_index(text, "@", 1), F.substring_index(text, "@", -1)
    fours = [F.regexp_replace(_digits(text), "([0-9]{4})(?=[0-9])", f"$1{x}") for x in "._"]
    number = F.substring(text, 2, 1 << 30)
    forms = {
        "email": [
            F.concat(name, F.lit(" [at] "), F.replace(host, F.lit("."), F.lit(" [dot] "))),
            F.concat(name, F.lit("(at)"), host),
        ],
        "ip": [F.replace(text, F.lit("."), F.lit(x)) for x in ("[.]", " [dot] ")],
        "card": fours,
        "phone": [number, *[F.regexp_replace(number, "[ ().-]+", x) for x in ".-"]],
    }
    texts = F.lit(None).cast("array<string>")
    for n, kind in enumerate(KINDS):
        whole = f"^(?:{GENERATORS[kind]})$"
        proposed = F.filter(F.array(*forms[kind]), _matches(whole))
        texts = F.when(span["kind"] == n, proposed).otherwise(texts)
    return F.transform(
        texts,
        lambda t: F.struct(
            span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"), t.alias("text")
        ),
    )


def _made_wrong(text: Column, span: Column) -> Column:
    """Spans that the generators propose and that are no personal data, one set per base span.

    Numbers have digits of a hash and stand at a hashed place of the text, between two words.
    """
    own = span["text"]
    draw = F.xxhash64(own, span["start"], F.length(text))

    def part(size: int, least: int, step: int) -> Column:
        return (F.pmod(F.shiftright(draw, step), F.lit(size)) + least).cast("string")

    def two(size: int, step: int) -> Column:
        return F.lpad(part(size, 1, step), 2, "0")

    year, month, day, hour = part(200, 1900, 3), two(12, 5), two(28, 7), two(23, 9)
    digits = F.concat(part(9, 1, 11), F.lpad(part(10**17, 0, 1), 17, "0"))
    run = F.substr(digits, F.lit(1), (F.pmod(draw, F.lit(6)) + 10).cast("int"))
    # The sixteenth digit makes the number pass the check of a card.
    fifteen = F.substr(digits, F.lit(1), F.lit(15))
    rest = _luhn_total(F.concat(fifteen, F.lit("0"))) % 10
    sixteen = F.concat(fifteen, F.pmod(10 - rest, F.lit(10)).cast("string"))

    def in_threes(number: Column, separator: str) -> Column:
        return F.regexp_replace(number, "(?<=[0-9])(?=(?:[0-9]{3})+$)", separator)

    numbers = {
        "phone": [
            run,
            F.concat(year, month, day, hour, two(59, 13), two(59, 15)),
            in_threes(run, "."),
            in_threes(run, " "),
            F.concat_ws("-", year, month, F.concat_ws(" ", day, hour)),
            F.concat_ws(".", day, month, F.concat_ws(" ", year, hour)),
        ],
        "card": [in_threes(sixteen, "."), in_threes(sixteen, "_")],
    }
    name, host = F.substring_index(own, "@", 1), F.substring_index(own, "@", -1)
    label = F.substring_index(host, ".", 1)
    addresses = {
        "email": [F.concat(name, F.lit(x), label) for x in ("@", " (at) ", " [at] ")],
        "ip": [
            F.concat(F.replace(own, F.lit("."), F.lit("[.]")), F.lit("[.]"), part(200, 1, 3)),
            F.concat(F.substring_index(own, ".", 3), F.lit("[.]"), part(700, 256, 3)),
        ],
    }
    # The character before the number and the one after it are the blank found.
    place = F.position(F.lit(" "), text, (F.pmod(draw, F.length(text)) + 1).cast("int"))

    def made(kind: str, start: Column, end: Column, forms: list) -> Column:
        proposed = F.filter(F.array(*forms), _matches(f"^(?:{GENERATORS[kind]})$"))
        return F.transform(
            proposed,
            lambda t: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), end.alias("end"), t.alias("text")
            ),
        ).cast(f"array<{_SPAN}>")

    at_place = F.concat(*[made(k, place, F.greatest(place - 1, F.lit(0)), f) for k, f in numbers.items()])
    own_kind = _none()
    for kind, forms in addresses.items():
        here = span["kind"] == KINDS.index(kind)
        own_kind = F.when(here, made(kind, span["start"], span["end"], forms)).otherwise(own_kind)
    return F.concat(at_place, own_kind)


def _of_sort(spans: Column, sort: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s.alias("s"), F.lit(sort).alias("sort")))


def _known_wrong(f: Column) -> Column:
    """By features: fails the check of its kind, or is a number of an identifier or a reference."""
    named = (f["near_reference"] == 1) & (f["near_word"] == 0)
    attached = (f["after_letter"] == 1) | (f["before_letter"] == 1)
    return (f["passes_check"] == 0) | ((f["is_email"] == 0) & (attached | named))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _small_parts(text: Column) -> Column:
    parts = F.transform(F.split(text, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _phone(text: Column) -> Column:
    return F.length(_digits(text)).between(10, 15)


def _card(text: Column) -> Column:
    digits = _digits(text)
    return F.length(digits).between(14, 19) & (_luhn_total(digits) % 10 == 0)


def _luhn_total(digits: Column) -> Column:
    # From the right every second digit is doubled, and 9 taken off above 9.
    return F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda done, i: done + _luhn(F.substr(digits, -i, F.lit(1)).cast("int"), i % 2 == 0),
    )


def _luhn(digit: Column, doubled: Column) -> Column:
    twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
    return F.when(doubled, twice).otherwise(digit)


# -- features and trees -------------------------------------------------------------------


def _features(text: Column, span: Column) -> Column:
    """A struct of doubles with the names of FEATURES."""
    own = span["text"]
    digits = _digits(own)
    groups = F.filter(F.split(own, "[^0-9]+"), lambda g: g != "")
    before = F.substr(
        text,
        F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1,
        F.least(span["start"], F.lit(CONTEXT)),
    )
    after = F.substr(text, span["end"] + 1, F.lit(1))
    four_small = (F.size(groups) == 4) & F.forall(
        F.transform(groups, lambda g: F.ltrim(g, F.lit("0"))),
        lambda g: (F.length(g) < 3) | ((F.length(g) == 3) & (g <= "255")),
    )
    # In the order of KINDS.
    passes = (
        F.when(span["kind"] == 0, own.rlike(TOP_LEVEL))
        .when(span["kind"] == 1, four_small)
        .when(span["kind"] == 2, _card(own))
        .otherwise(_phone(own))
    )
    values = [
        *[span["kind"] == n for n in range(len(KINDS))],
        F.length(own),
        F.length(digits),
        F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        F.coalesce(F.substr(digits, F.lit(1), F.lit(1)).try_cast("int"), F.lit(-1)),
        F.length(own) - F.length(F.replace(own, F.lit("."))),
        F.length(own) - F.length(F.regexp_replace(own, "[ -]", "")),
        before.rlike(CONTEXT_WORDS),
        before.rlike(REFERENCE_WORDS),
        before.rlike("[A-Za-z]$"),
        after.rlike("^[A-Za-z]"),
        F.size(F.array_distinct(F.split(digits, ""))),
        passes,
        F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)),
        F.coalesce(F.length(F.get(groups, F.size(groups) - 1)), F.lit(0)),
    ]
    return F.struct(*[v.cast("double").alias(n) for n, v in zip(FEATURES, values, strict=True)])


def _share(sizes: dict[tuple[int, int], int], sample: int) -> Column:
    """The share of each kind and sort to draw: small ones whole, the others the same number."""
    share, left = F.lit(0.0), float(sample)
    for i, ((kind, sort), n) in enumerate(sorted(sizes.items(), key=lambda x: x[1])):
        wanted = min(float(n), left / (len(sizes) - i))
        left -= wanted
        here = (F.col("kind") == kind) & (F.col("sort") == sort)
        share = F.when(here, F.lit(wanted / n)).otherwise(share)
    return share


def _threshold(steps: list, precision: float) -> tuple:
    """(threshold, (recall, precision)) from (margin, hits, wrong, unlabelled), best margin first.

    It is set for the last hit at which the precision so far holds. No wrong span lies between it
    and the next wrong one below; the threshold is midway between these two, or between it and the
    trees' own boundary, 0, if that comes first.
    """
    all_hits, all_unlabelled = sum(s[1] for s in steps), sum(s[3] for s in steps)
    right = _right_share(steps, all_hits, all_unlabelled)
    hits = wrong = open_ = 0
    last, kept, below = None, None, 0.0
    for margin, more, mistakes, unlabelled in steps:
        hits, wrong, open_ = hits + more, wrong + mistakes, open_ + unlabelled
        errors = wrong + max(0.0, open_ - right * all_unlabelled * hits / max(1, all_hits))
        if more and hits >= LEAST_HELD and hits / (hits + errors) >= precision:
            last, below = margin, 0.0
            kept = hits / all_hits, hits / (hits + errors)
        elif last is not None and mistakes + unlabelled:
            below = max(below, margin)
    return (last if last is None or last <= below else (last + below) / 2), kept


def _right_share(steps: list, all_hits: int, all_unlabelled: int) -> float:
    """The most that can be right of the unlabelled spans, by the share of hits and of them above.

    Margins with fewer than LEAST_HELD hits above say nothing.
    """
    share, hits, open_ = 1.0, 0, 0
    for _, more, _, unlabelled in steps:
        hits, open_ = hits + more, open_ + unlabelled
        if hits >= LEAST_HELD and all_unlabelled:
            share = min(share, open_ / all_unlabelled * all_hits / hits)
    return share


def _tree(node):
    """A fitted tree in plain values."""
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return (
        int(split.featureIndex()),
        float(split.threshold()),
        _tree(node.leftChild()),
        _tree(node.rightChild()),
    )


def _margin(trees: tuple, features: Column) -> Column:
    def value(tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        feature, threshold, left, right = tree
        goes_left = features[FEATURES[feature]] <= threshold
        return F.when(goes_left, value(left)).otherwise(value(right))

    total = F.lit(0.0)
    for weight, tree in trees:
        total += F.lit(weight) * value(tree)
    return total
