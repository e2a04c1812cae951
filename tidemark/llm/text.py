"""Column expressions shared by the operators that stay on built-in functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that separate words (space, tab to carriage return).
GAP = r"[\x20\x09-\x0D]+"
_BLOCK = 256
SPAN = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda that mentions an outer expression may have it inlined and computed
    again for each element; binding it to a lambda variable rules that out.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shield(
    docs: DataFrame, needs: Sequence[str], outputs: Sequence[str] = ()
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with free names for the columns an operator doesn't read, and a function that gives the names back.

    So an operator's inner names clash with none of the caller's. ``outputs`` are names that the
    operator adds; a caller's column of such a name is left out.
    """
    read, gone = {c.lower() for c in needs}, {c.lower() for c in outputs}
    kept = [c for c in docs.columns if c.lower() not in gone]
    free = {c: c if c.lower() in read else f"_caller_{i}" for i, c in enumerate(kept)}
    back = {new: c for c, new in free.items() if new != c}
    inner = docs.select(*[F.col(f"`{c}`").alias(free[c]) for c in kept])
    return inner, lambda out: out.withColumnsRenamed(back)


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def running_totals(values: Column) -> Column:
    """Inclusive running sums of an int array, in blocks so that cost stays near linear."""

    def within(part: Column, start: Column) -> Column:
        grown = F.aggregate(
            part, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
        )
        return F.slice(grown, 2, F.size(part))

    def total(v: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), ((F.size(v) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)),
        )
        return let(
            blocks,
            lambda bs: let(
                F.aggregate(
                    bs,
                    F.array(F.lit(0)),
                    lambda acc, part: F.concat(
                        acc,
                        F.array(F.element_at(acc, -1) + F.aggregate(part, F.lit(0), lambda s, x: s + x)),
                    ),
                ),
                lambda starts: F.flatten(
                    F.transform(bs, lambda part, i: within(part, F.element_at(starts, i + 1)))
                ),
            ),
        )

    return let(values, lambda v: F.when(F.size(v) > 0, total(v)).otherwise(F.array().cast("array<int>")))


def spans(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as (start, end, value) structs.

    Offsets count code points; the end is exclusive. ``gate`` is a cheap condition
    that every text with a match fulfils. ``pattern`` must not match the empty string.
    """

    def located(found: Column, pieces: Column) -> Column:
        lengths = F.zip_with(
            F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.length(p) + F.length(m)
        )
        return F.zip_with(
            running_totals(lengths),
            found,
            lambda end, m: F.struct(
                (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")
            ),
        )

    def search(t: Column) -> Column:
        return let(
            F.regexp_extract_all(t, F.lit(pattern), F.lit(0)),
            lambda found: F.when(
                F.size(found) > 0, located(found, F.split(t, pattern, -1))
            ).otherwise(F.array().cast(SPAN)),
        )

    condition = F.lit(True) if gate is None else gate
    return F.when(condition, let(text, search)).otherwise(F.array().cast(SPAN))


def tagged(found: Column, kind: str, rank: int) -> Column:
    """Spans with their kind; ``rank`` orders kinds that start at the same place."""
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def joined(found: Column) -> Column:
    """``kind:start:end`` of tagged spans by start, then rank, comma-joined."""
    return F.array_join(
        F.transform(
            F.sort_array(found),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
