"""Places of regular-expression matches, as column expressions.

A match is put between two private-use characters and the text is cut at the first of them; running
lengths of the cuts are the positions. The text's own private-use marks are replaced beforehand by a
third one, so lengths stay as they are. Nothing here takes the square of a text's matches: running
values are found by doubling steps, and a place in a text is reached through pieces of equal length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ue002"
PIECE = 64  # code points of the pieces that a text is reached through


def unmarked(text: Column) -> Column:
    """``text`` with its own marks replaced, code point by code point."""
    for mark in (OPEN, CLOSE):
        text = F.replace(text, F.lit(mark), F.lit(OTHER))
    return text


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often and deep in lambdas it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Array of the values merged up to each place; ``merge`` must be associative.

    Step k merges every value with the one 2^k places before, so n values take n times log2(n) merges.
    """
    backs = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda k: F.pow(F.lit(2), k).cast("int"))

    def step(sofar: Column, back: Column) -> Column:
        return F.transform(sofar, lambda x, i: F.when(i >= back, merge(F.get(sofar, i - back), x)).otherwise(x))

    return let(values, lambda own: F.aggregate(F.filter(backs, lambda back: back < F.size(own)), own, step))


def pieces(text: Column) -> Column:
    """The text cut into pieces of ``PIECE`` code points, for ``part``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(cut: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end``, exclusive, of the text that ``pieces`` cut; work grows with their number only."""
    first = F.floor(start / PIECE).cast("int")
    size = F.floor((end - 1) / PIECE).cast("int") - first + 1
    whole = F.array_join(F.slice(cut, first + 1, size), "")
    return F.when(end > start, F.substring(whole, start - first * PIECE + 1, end - start)).otherwise("")


def matches(text: Column, pattern: Column, measure=F.length) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches; the text must be unmarked.

    ``measure`` gives the length of a piece of text; lengths must add up and the marks must not
    count in it, or count 1 each as they do in ``length``.
    """
    mark = 1 if measure is F.length else 0
    cuts = F.split(F.regexp_replace(text, pattern, F.lit(f"{OPEN}$0{CLOSE}")), OPEN, -1)
    own = lambda cut: measure(cut) - F.when(F.instr(cut, CLOSE) > 0, mark).otherwise(0)

    def place(cut: Column, start: Column) -> Column:
        value = F.substring(cut, F.lit(1), F.instr(cut, CLOSE) - 1)
        return F.struct(start.alias("start"), (start + measure(value)).alias("end"), value.alias("value"))

    def places(cuts: Column) -> Column:
        return let(running(F.transform(cuts, own), lambda a, b: a + b), lambda upto: F.transform(
            F.slice(cuts, 2, F.greatest(F.size(cuts) - 1, F.lit(0))), lambda cut, i: place(cut, F.get(upto, i))
        ))

    return let(cuts, places)
