"""Where a pattern matches in a text, as DataFrame expressions.

Arrays grow by copying, so a list of a million matches must not be built one by
one. What depends on all earlier elements is worked out in blocks of `BLOCK`
elements, and the blocks are put together by their totals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string,inner:string>"
BLOCK = 256
CHUNK = 1024


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with `value` worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array, what `combine` makes of all before it, from 0 on; it has to be associative."""
    nothing = F.expr("CAST(array() AS array<bigint>)")

    def fold(some: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("before"))
        return F.aggregate(
            some,
            start,
            lambda s, v: F.struct(
                combine(s["at"], v.cast("long")).alias("at"), F.array_append(s["before"], s["at"]).alias("before")
            ),
        )

    def in_blocks(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / BLOCK).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda b: fold(F.slice(all_, b * BLOCK + 1, BLOCK)),
        )
        return let(blocks, joined)

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: block["at"])
        return F.flatten(
            F.zip_with(
                blocks,
                fold(totals)["before"],
                lambda block, total: F.transform(block["before"], lambda one: combine(total, one)),
            )
        )

    return let(values, lambda v: F.when(F.size(v) <= BLOCK, fold(v)["before"]).otherwise(in_blocks(v)))


def _add(a: Column, b: Column) -> Column:
    return a + b


def largest_before(values: Column) -> Column:
    """For each number of an array of numbers from 0 on, the largest before it, 0 for the first."""
    return running(values, lambda a, b: F.greatest(a, b))


def found(text: Column, pattern: str, group: int = 0, before: int = 0, after: int = 0) -> Column:
    """The leftmost non-overlapping matches of a pattern, as an array of `SPAN`.

    Positions count code points, the end is exclusive, `inner` is the text of
    `group`. The text between the matches tells where they are. With `before` or
    `after` the spans also have so many characters of the text around them under
    these names. Texts without a match are searched once only.
    """
    regex = F.lit(pattern)
    values = F.regexp_extract_all(text, regex, F.lit(0))
    fields = [F.split(text, pattern, -1).alias("gaps"), values.alias("values")]
    if group:
        fields.append(F.regexp_extract_all(text, regex, F.lit(group)).alias("inner"))
    kind = SPAN[:-1] + (",before:string" if before else "") + (",after:string" if after else "") + ">"
    nothing = F.expr(f"CAST(array() AS array<{kind}>)")

    def spans(m: Column) -> Column:
        gaps, values = m["gaps"], m["values"]
        inner = m["inner"] if group else values
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.length(g) + F.length(v))
        placed = F.zip_with(
            running(lengths, _add),
            F.zip_with(gaps, values, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))),
            lambda at, one: F.struct(
                (at + F.length(one["gap"])).cast("int").alias("start"), one["value"].alias("value"), one["gap"].alias("gap")
            ),
        )
        parts = {"inner": inner}
        if before:
            parts["before"] = let(
                F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.right(F.concat(g, v), F.lit(before))),
                lambda pieces: F.transform(
                    F.slice(gaps, F.lit(1), F.size(values)),
                    lambda gap, k: F.when(F.length(gap) >= before, F.right(gap, F.lit(before))).otherwise(
                        F.right(F.concat(_joined(pieces, k - before, k), gap), F.lit(before))
                    ),
                ),
            )
        if after:
            parts["after"] = let(
                F.zip_with(gaps, values, lambda g, v: F.left(F.concat(g, F.coalesce(v, F.lit(""))), F.lit(after))),
                lambda pieces: F.transform(values, lambda _, k: F.left(_joined(pieces, k + 1, k + 1 + after), F.lit(after))),
            )
        together = F.arrays_zip(placed.alias("at"), *(part.alias(name) for name, part in parts.items()))
        complete = F.filter(together, lambda one: one["inner"].isNotNull())
        return F.transform(
            complete,
            lambda one: F.struct(
                one["at"]["start"].alias("start"),
                (one["at"]["start"] + F.length(one["at"]["value"])).alias("end"),
                one["at"]["value"].alias("value"),
                *(one[name].alias(name) for name in parts),
            ),
        )

    return F.when(text.rlike(pattern), let(F.struct(*fields), spans)).otherwise(nothing)


def _joined(pieces: Column, start: Column, end: Column) -> Column:
    """The pieces from `start` on and before `end`, put together."""
    first = F.greatest(start, F.lit(0))
    return F.array_join(F.slice(pieces, first + 1, F.greatest(end - first, F.lit(0))), "")


def distinct_sorted(items: Column) -> Column:
    """The elements of a sorted array, each once."""
    return let(
        items,
        lambda all_: F.filter(
            all_, lambda one, k: (k == 0) | ~one.eqNullSafe(F.get(all_, F.greatest(k - 1, F.lit(0))))
        ),
    )


def code(span: Column) -> Column:
    """A span as one number, ascending with start and end."""
    return span["start"].cast("long") * (1 << 31) + span["end"]


def without(spans: Column, codes: Column) -> Column:
    """The spans whose `code` is not among `codes`, by start and end."""
    def merged(all_: Column) -> Column:
        known = F.transform(codes, lambda c: F.struct(c.alias("code"), F.lit(-1).alias("k")))
        tried = F.transform(all_, lambda s, k: F.struct(code(s).alias("code"), k.alias("k")))
        return let(F.array_sort(F.concat(known, tried)), lambda both: picked(all_, both))

    def picked(all_: Column, both: Column) -> Column:
        # Known codes come first among equals, so the last known one is the same if there is one.
        last = largest_before(F.transform(both, lambda one: F.when(one["k"] < 0, one["code"]).otherwise(0)))
        fresh = F.filter(
            F.zip_with(both, last, lambda one, c: F.when((one["k"] >= 0) & (one["code"] != c), one["k"])),
            lambda k: k.isNotNull(),
        )
        return F.transform(fresh, lambda k: F.get(all_, k))

    return let(spans, merged)


def cut_text(text: Column, use: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """`use(cut)`, where `cut(a, b)` is the text from code point `a` on and before `b`.

    Counting from the start of a long text for every cut would take its length
    each time, so the text is divided once.
    """
    def with_chunks(chunks: Column) -> Column:
        def cut(a: Column, b: Column) -> Column:
            first = F.floor(a / CHUNK).cast("int")
            some = _joined(chunks, first, F.floor(b / CHUNK).cast("int") + 1)
            return F.substring(some, a - first * CHUNK + 1, b - a)

        return use(cut)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), with_chunks)


def listed(kind: str, spans: Column) -> Column:
    """`kind:start:end` of each span."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")
