"""Regular-expression matches with their places, in built-in functions.

`split` gives what lies between the matches and `regexp_extract_all` the
matches, so running lengths give the places, in code points. Nothing leaves the
row: no shuffle, no Python.

Work in a row grows in proportion to its matches. What runs over an array does so in
chunks of `CHUNK` elements, and over the chunks in the same way, since appending to
an array copies it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
CHUNK = 64
#: Levels of chunks; CHUNK ** (LEVELS + 1) elements cost a chunk's time each.
LEVELS = 3

Combine = Callable[[Column, Column], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunks(items: Column, size: int = CHUNK) -> Column:
    """The array as an array of arrays of `size` elements; one empty one for none."""

    def cut_up(all_: Column) -> Column:
        last = F.floor((F.greatest(F.size(all_), F.lit(1)) - 1) / size).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda k: F.slice(all_, k * size + 1, size)
        )

    return let(items, cut_up)


def before_each(numbers: Column, combine: Combine, levels: int = LEVELS) -> Column:
    """For each number of an array, all in front of it combined, from 0 on.

    `combine` is addition or the larger of two, for numbers that are not negative.
    """
    zero = F.lit(0)

    def one_chunk(some: Column, begin: Column) -> Column:
        state = F.struct(begin.alias("now"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(
            some,
            state,
            lambda s, x: F.struct(
                combine(s["now"], x).alias("now"),
                F.concat(s["all"], F.array(s["now"])).alias("all"),
            ),
            lambda s: s["all"],
        )

    if not levels:
        return one_chunk(numbers, zero)

    def over_chunks(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, zero, combine))
        return F.flatten(F.zip_with(parts, before_each(totals, combine, levels - 1), one_chunk))

    return let(chunks(numbers), over_chunks)


def added(a: Column, b: Column) -> Column:
    return a + b


def larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def find_spans(text: Column, pattern: str, hint: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of `pattern` in order.

    Each has `start`, `end` (exclusive), `value`, and the text `before` it since
    the match in front and `after` it until the next. `hint`, if given, is a cheap
    condition that any text with a match meets. A NULL text has no matches.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(pieces: Column) -> Column:
        lengths = F.zip_with(
            pieces["found"], pieces["gaps"], lambda value, gap: F.length(gap) + F.length(value)
        )
        # the last gap has no match behind it
        lengths = F.slice(lengths, 1, F.size(pieces["found"]))

        def spans(begins: Column) -> Column:
            def span(value: Column, i: Column) -> Column:
                gap = F.get(pieces["gaps"], i)
                start = F.get(begins, i) + F.length(gap)
                return F.struct(
                    start.alias("start"),
                    (start + F.length(value)).alias("end"),
                    value.alias("value"),
                    gap.alias("before"),
                    F.get(pieces["gaps"], i + 1).alias("after"),
                )

            return F.transform(pieces["found"], span)

        return let(before_each(lengths, added), spans)

    none = F.array().cast(SPAN)
    spans = F.coalesce(let(F.struct(gaps.alias("gaps"), found.alias("found")), placed), none)
    return spans if hint is None else F.when(hint, spans).otherwise(none)


def apart(items: Column, base: Column) -> Column:
    """Those of `items` that overlap none of `base`, in order; both have `start` and `end`.

    Beginnings of base spans and ends of items lie in one order; an item is apart if
    no base span that begins before its end reaches beyond its start.
    """

    def sorted_out(both: Column) -> Column:
        ends = F.transform(
            both["items"],
            lambda t, i: F.struct(
                t["end"].alias("at"), F.lit(0).alias("reach"), t["start"].alias("start"), i.alias("i")
            ),
        )
        begins = F.transform(
            both["base"],
            lambda b: F.struct(
                b["start"].alias("at"), b["end"].alias("reach"), F.lit(0).alias("start"), F.lit(-1).alias("i")
            ),
        )
        # of equal places an end comes first: its reach is 0
        def judged(events: Column) -> Column:
            reaches = before_each(F.transform(events, lambda e: e["reach"]), larger)
            marked = F.zip_with(
                events, reaches, lambda e, r: F.when((e["i"] >= 0) & (r <= e["start"]), e["i"])
            )
            free = F.array_sort(F.filter(marked, lambda i: i.isNotNull()))
            return F.transform(free, lambda i: F.get(both["items"], i))

        return let(F.array_sort(F.concat(ends, begins)), judged)

    chosen = let(F.struct(items.alias("items"), base.alias("base")), sorted_out)
    return F.when((F.size(items) > 0) & (F.size(base) > 0), chosen).otherwise(items)


def label(kind: str, span: Column) -> Column:
    return F.concat_ws(":", F.lit(kind), span["start"].cast("string"), span["end"].cast("string"))


def digest(labels: Column) -> Column:
    """SHA-256 of comma-joined labels, lower-case hex."""
    return F.sha2(F.array_join(labels, ","), 256)
