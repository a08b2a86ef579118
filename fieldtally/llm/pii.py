"""Operator 2: personal data by bootstrapped contextual extraction.

Base patterns find e-mail addresses, IP addresses, card and phone numbers with
their places. They are the seeds: the two words in front of a seed, and the words
around it, are patterns of its kind. Every token with a digit or an @ that is no part
of a seed is an instance that may be met in the same patterns, without the
punctuation that encloses it. The words come from the whole text, so a place has the
same patterns whether a seed or a token stands there. Spark then scores the graph of
patterns and instances in rounds: a pattern is worth the share of its distinct
instances that are known, an instance one minus the product of what its patterns
leave open. Instances of a high score, met in a pattern of a high score, are
personal data of that kind that no base pattern knows. Built-in functions only.

Only edges of hashes are shuffled; the text is read once. Edges are distinct, so a
sentence that repeats in a third of all documents is one edge.

NULL and empty texts have no spans; rows without or with repeated ids keep their
own spans; an empty table gives an empty result; other columns pass through
`redact` and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, row_key, table
from fieldtally.llm.spans import (
    CHUNK,
    SPAN,
    Combine,
    apart,
    before_each,
    chunks,
    digest,
    find_spans,
    label,
    larger,
    let,
)


@dataclass(frozen=True)
class Bootstrap:
    """Rounds of scoring, seeds that a pattern needs, and what counts as sure."""

    rounds: int = 3
    least_seeds: int = 3
    pattern_score: float = 0.6
    instance_score: float = 0.8
    #: Code points of text looked at for a pattern's words.
    reach: int = 64


PLAN = Bootstrap()
KINDS = ("email", "ip", "card", "phone")

# Runs are possessive and begin where no earlier one could, so no text is read
# twice; the matches are those of the plain patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {
    "email": "@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": "[0-9][ -]?[0-9]",
    "phone": r"\+[0-9]",
}
#: A token with a digit or an @, and numbers that continue it unless punctuation ends it.
TOKEN = (
    r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
    r"(?:(?<![.,;:!?])\x20[(]?[0-9][0-9().-]*+)*+"
)
#: Punctuation in front of a token's own characters, and behind them.
OPENS = r"^[(\[{<\"'`]++"
CLOSES = r"(?<![.,;:!?)\]}>\"'`])[.,;:!?)\]}>\"'`]++$"
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
MENTION = "array<struct<kind:string,start:int,end:int,instance:bigint,patterns:array<bigint>>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(
        numbers,
        lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _counts(kind: str, value: Column) -> Column:
    """The condition beyond the pattern."""
    if kind == "ip":
        return value.rlike(OCTETS)
    if kind == "card":
        # a length outside never reaches the sum
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _patterns(span: Column, plan: Bootstrap) -> Column:
    """Hashes of the two words in front, and of the word in front with the one after."""

    def clean(text: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), r"[\x20\x09-\x0D]+", " ")

    front = F.trim(clean(F.right(span["before"], F.lit(plan.reach))))
    behind = F.trim(clean(F.left(span["after"], F.lit(plan.reach))))
    last = F.substring_index(front, " ", -1)
    return F.array(
        F.xxhash64(F.lit("front"), F.substring_index(front, " ", -2)),
        F.xxhash64(F.lit("around"), last, F.substring_index(behind, " ", 1)),
    )


def _mentions(found: Column, kind: str | None, plan: Bootstrap) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            F.lit(kind).cast("string").alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.xxhash64(F.lower(s["value"])).alias("instance"),
            _patterns(s, plan).alias("patterns"),
        ),
    )


def base_mentions(text: Column, plan: Bootstrap = PLAN) -> Column:
    """Base spans of a text, by kind as listed, then by place."""
    return F.concat(*(_mentions(_kept(text, k, plan), k, plan) for k in KINDS))


def _in_text(found: Column, plan: Bootstrap) -> Column:
    """`found` with `before` and `after` reaching over neighbouring matches.

    A match has a code point at least, so a chunk of `reach` matches spans all that the
    next chunk looks back at.
    """
    reach, none = F.lit(plan.reach), F.lit("")
    size = max(CHUNK, plan.reach)

    def joined(pieces: Column) -> Column:
        return F.array_join(pieces, "")

    def forward(part: Column, near: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            before = F.right(F.concat(state["near"], s["before"]), reach)
            spans = F.concat(state["spans"], F.array(s.withField("before", before)))
            return F.struct(F.right(F.concat(before, s["value"]), reach).alias("near"), spans.alias("spans"))

        return _walk(part, near, step)

    def backward(part: Column, near: Column) -> Column:
        """`part` from its end to its start."""

        def step(state: Column, s: Column) -> Column:
            after = F.left(F.concat(s["after"], state["near"]), reach)
            spans = F.concat(state["spans"], F.array(s.withField("after", after)))
            return F.struct(F.left(F.concat(s["value"], after), reach).alias("near"), spans.alias("spans"))

        return _walk(part, near, step)

    def tail(part: Column) -> Column:
        return F.right(joined(F.transform(part, lambda s: F.right(F.concat(s["before"], s["value"]), reach))), reach)

    def head(part: Column) -> Column:
        """The text from the first match of a reversed chunk on."""
        pieces = F.transform(F.reverse(part), lambda s: F.left(F.concat(s["value"], s["after"]), reach))
        return F.left(joined(pieces), reach)

    def over(ends: Callable[[Column], Column], walk: Combine) -> Callable[[Column], Column]:
        def chunked(parts: Column) -> Column:
            near = F.concat(F.array(none), F.transform(parts, ends))
            return F.flatten(F.zip_with(parts, F.slice(near, 1, F.size(parts)), walk))

        return chunked

    ahead = let(chunks(found, size), over(tail, forward))
    return let(
        F.reverse(ahead), lambda back: F.reverse(let(chunks(back, size), over(head, backward)))
    )


def _walk(part: Column, near: Column, step: Combine) -> Column:
    start = F.struct(near.alias("near"), F.array().cast(SPAN).alias("spans"))
    return F.aggregate(part, start, step, lambda s: s["spans"])


def _kept(text: Column, kind: str, plan: Bootstrap = PLAN) -> Column:
    found = _in_text(find_spans(text, PATTERNS[kind], text.rlike(HINTS[kind])), plan)
    return found if kind == "email" else F.filter(found, lambda s: _counts(kind, s["value"]))


def _trimmed(s: Column) -> Column:
    """A token's span without the punctuation that encloses it."""
    opens = F.regexp_extract(s["value"], OPENS, 0)
    closes = F.regexp_extract(s["value"], CLOSES, 0)
    size = F.length(s["value"]) - F.length(opens) - F.length(closes)
    return F.struct(
        (s["start"] + F.length(opens)).alias("start"),
        (s["end"] - F.length(closes)).alias("end"),
        F.substring(s["value"], F.length(opens) + 1, size).alias("value"),
        F.concat(s["before"], opens).alias("before"),
        F.concat(closes, s["after"]).alias("after"),
    )


def token_mentions(text: Column, plan: Bootstrap = PLAN) -> Column:
    found = _in_text(find_spans(text, TOKEN, text.rlike("[0-9@]")), plan)
    return _mentions(F.transform(found, _trimmed), None, plan)


def mentions(docs: DataFrame, plan: Bootstrap = PLAN) -> DataFrame:
    """doc_id, key, base and tokens (arrays of mentions) for every row.

    A token that overlaps a base span is that span, and not one of `tokens`.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select(
        "doc_id",
        row_key("doc_id", "text").alias("key"),
        base_mentions(text, plan).alias("base"),
        token_mentions(text, plan).alias("tokens"),
    )
    return found.withColumn("tokens", apart(F.col("tokens"), F.col("base")))


def _edges(found: DataFrame) -> DataFrame:
    """Distinct (pattern, instance) over base spans and tokens."""
    both = found.select(F.explode(F.concat("base", "tokens")).alias("m"))
    return both.select(F.explode("m.patterns").alias("pattern"), F.col("m.instance").alias("instance")).distinct()


def score_graph(edges: DataFrame, seeds: DataFrame, plan: Bootstrap = PLAN) -> tuple[DataFrame, DataFrame]:
    """Scored patterns (pattern, kind, score) and instances (instance, kind, score).

    `edges` are distinct (pattern, instance), `seeds` distinct (instance, kind).
    Seeds keep score 1.
    """
    degree = cut(
        edges.groupBy(F.col("pattern").alias("p")).agg(F.count(F.lit(1)).alias("degree"))
    )
    known = cut(seeds.select(F.col("instance").alias("i"), "kind", F.lit(1.0).alias("score")))
    instances, patterns = known, None
    for _ in range(plan.rounds):
        mass = (
            edges.join(instances, F.col("instance") == F.col("i"))
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("mass"))
            .where(F.col("mass") >= plan.least_seeds)
        )
        worth = F.round(F.col("mass") / (F.col("degree") + 1), 9)
        patterns = cut(
            mass.join(degree, F.col("pattern") == F.col("p"))
            .select("p", "kind", worth.alias("score"))
            .where(F.col("score") >= plan.pattern_score)
        )
        open_ = F.exp(F.sum(F.log(1 - F.col("score"))))
        met = (
            edges.join(patterns, F.col("pattern") == F.col("p"))
            .groupBy(F.col("instance").alias("i"), "kind")
            .agg(F.round(1 - open_, 9).alias("score"))
        )
        instances = cut(
            known.unionByName(met).groupBy("i", "kind").agg(F.max("score").alias("score"))
        )
    return patterns.withColumnRenamed("p", "pattern"), instances.withColumnRenamed("i", "instance")


def discovered(found: DataFrame, plan: Bootstrap = PLAN) -> DataFrame:
    """(key, extra): spans that the graph adds, per row that has any."""
    edges = cut(_edges(found))
    seeds = found.select(F.explode("base").alias("m")).select("m.instance", "m.kind").distinct()
    patterns, instances = score_graph(edges, seeds, plan)
    new = (
        instances.join(seeds.select("instance").distinct(), "instance", "left_anti")
        .where(F.col("score") >= plan.instance_score)
        .select(F.col("instance").alias("i"), "kind")
    )
    tokens = found.select("key", F.explode("tokens").alias("m")).select(
        "key", "m.start", "m.end", "m.instance", F.explode("m.patterns").alias("pattern")
    )
    hits = tokens.join(
        patterns.select(F.col("pattern").alias("p"), "kind"), F.col("pattern") == F.col("p")
    ).select("key", "start", "end", "instance", "kind")
    spans = hits.join(new.withColumnRenamed("kind", "k"), (F.col("instance") == F.col("i")) & (F.col("kind") == F.col("k")))
    return spans.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("extra")
    )


def find_pii(docs: DataFrame, plan: Bootstrap = PLAN) -> DataFrame:
    """doc_id, key, base and extra spans (kind, start, end) of every row.

    An added span never overlaps a base span.
    """
    found = cut(mentions(docs, plan))
    extra = cut(discovered(found, plan)).withColumnRenamed("key", "of")
    place = lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    rows = found.select("doc_id", "key", F.transform("base", place).alias("base"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    added = F.transform(apart(F.col("extra"), F.col("base")), place)
    return rows.join(extra, F.col("key") == F.col("of"), "left").select(
        "doc_id", "key", "base", F.coalesce(added, none).alias("extra")
    )


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _labels(spans: Column) -> Column:
    """kind:start:end by kind as listed, then by place."""
    parts = [F.array_sort(F.transform(_of_kind(spans, k), lambda s: F.struct(s["start"], s["end"]))) for k in KINDS]
    return F.concat(*(_named(p, k) for p, k in zip(parts, KINDS, strict=True)))


def _named(places: Column, kind: str) -> Column:
    return F.transform(places, lambda s: label(kind, s))


def op2_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(F.size(_of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in KINDS),
        digest(_labels(F.col("base"))).alias("base_sha256"),
        F.array_join(_labels(F.concat("base", "extra")), ",").alias("spans"),
    )


def _merged(spans: Column) -> Column:
    """Overlapping spans as one, of the kind that starts first, in order."""

    def over(order: Column) -> Column:
        # a span that begins before an earlier one ends is part of that one
        reaches = before_each(F.transform(order, lambda s: s["end"]), larger)
        begun = F.filter(
            F.zip_with(order, reaches, lambda s, r: F.struct(s["start"], r.alias("reach"), s["kind"])),
            lambda s: s["start"] >= s["reach"],
        )
        last = F.array_max(F.transform(order, lambda s: s["end"]))

        def closed(first: Column) -> Column:
            return F.transform(
                first,
                lambda s, i: F.struct(
                    s["start"].alias("start"),
                    F.coalesce(F.get(first, i + 1)["reach"], last).alias("end"),
                    s["kind"].alias("kind"),
                ),
            )

        return let(begun, closed)

    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    return let(order, over)


def _blanked(text: Column, begin: Column, spans: Column, levels: int = 2) -> Column:
    """`text`, which starts at place `begin`, with disjoint spans replaced by their kinds.

    A cut counts its place from the front, so a text is cut into pieces of many spans
    first, and these into smaller ones.
    """

    def piece(start: Column, end: Column) -> Column:
        return F.substring(text, start - begin + 1, end - start)

    def last_end(part: Column) -> Column:
        return F.element_at(part, -1)["end"]

    def ends_before(parts: Column, i: Column) -> Column:
        return F.when(i == 0, begin).otherwise(F.get(parts, i - 1))

    def pieces(parts: Column, ends: Column) -> Column:
        if not levels:
            return F.transform(
                parts,
                lambda s, i: F.concat(
                    piece(ends_before(ends, i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")
                ),
            )
        return F.transform(
            parts,
            lambda part, i: let(
                F.struct(ends_before(ends, i).alias("from"), part.alias("spans")),
                lambda p: let(
                    piece(p["from"], last_end(p["spans"])),
                    lambda t: _blanked(t, p["from"], p["spans"], levels - 1),
                ),
            ),
        )

    def whole(parts: Column) -> Column:
        ends = F.transform(parts, last_end if levels else (lambda s: s["end"]))
        return let(
            ends,
            lambda e: F.concat(
                F.array_join(pieces(parts, e), ""),
                F.substring(text, F.element_at(e, -1) - begin + 1, F.length(text)),
            ),
        )

    parts = chunks(spans, CHUNK**levels) if levels else spans
    return F.when(F.size(spans) > 0, let(parts, whole)).otherwise(text)


def redact(docs: DataFrame, plan: Bootstrap = PLAN) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets.

    Overlapping spans are one, under the kind that starts first; `n_chars`, if
    there is one, follows the new text.
    """
    found = find_pii(docs, plan).select("key", F.concat("base", "extra").alias("__spans"))
    found = cut(found.where(F.size("__spans") > 0).dropDuplicates(["key"]).withColumnRenamed("key", "__of"))
    clean = let(_merged(F.col("__spans")), lambda spans: _blanked(F.col("text"), F.lit(0), spans))
    joined = docs.withColumn("__key", row_key("doc_id", "text")).join(
        found, F.col("__key") == F.col("__of"), "left"
    )
    out = joined.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        n = F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
        out = out.withColumn("n_chars", n)
    return out.select(*docs.columns)
