"""Folds and cuts of long arrays and texts inside one row, as column expressions
whose work does not grow with the square of the length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points of the parts that a text is cut from.
PART = 2048


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it
    inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blocks_of(items: Column, body) -> Column:
    """``body(blocks)``: ``items`` cut into about as many blocks as each has
    items. Folds that grow an array copy it at every step; over blocks, n items
    cost n times the root of n small copies instead of n times n."""
    def cut(all_items):
        n = F.size(all_items)
        return let(F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1)), lambda size: F.transform(
            F.when(n > 0, F.sequence(F.lit(0), ((n - 1) / size).cast("int"))).otherwise(F.array().cast("array<int>")),
            lambda i: F.slice(all_items, i * size + 1, size)))
    return let(let(items, cut), body)


def folded(items: Column, start: Column, step, kind: str) -> Column:
    """Fold ``step(at, item) -> (at, output or null)`` over ``items``; the
    outputs (of type ``kind``), in order, and the last ``at``."""
    def whole(blocks):
        def inner(acc, block):
            def one(state, item):
                at, out = step(state["at"], item)
                return F.struct(at.alias("at"), F.concat(state["out"], F.array(out)).alias("out"))
            zero = F.struct(acc["at"].alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
            return F.aggregate(block, zero, one, lambda s: F.struct(
                s["at"].alias("at"), F.concat(acc["out"], F.array(s["out"])).alias("out")))
        zero = F.struct(start.alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.aggregate(blocks, zero, inner, lambda s: F.struct(s["at"].alias("at"), F.flatten(s["out"]).alias("out")))
    return blocks_of(items, whole)


def parts_of(text: Column) -> Column:
    """The text in parts of ``PART`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))


def between(parts: Column, a: Column, b: Column) -> Column:
    """Code points a to b of a text from its parts: taking them from the whole
    text would count from its beginning each time."""
    first = (a / PART).cast("int")
    cut = F.transform(F.sequence(first, F.greatest(first, ((b - 1) / PART).cast("int"))), lambda c: F.substring(
        F.get(parts, c), F.greatest(a - c * PART, F.lit(0)) + 1, F.least(b - c * PART, F.lit(PART)) - F.greatest(a - c * PART, F.lit(0))))
    return F.when(b > a, F.array_join(cut, "")).otherwise("")
