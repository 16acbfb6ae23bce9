"""Folds over arrays whose elements depend on those before, as Column expressions: the work grows with the array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions.text import bind

#: Elements that a fold gathers before it begins a new list, so that no long list is copied at every step.
_BLOCK = 64


def fold(n: Column, start: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The elements that ``step(state, i)`` gives for i from 0 to n - 1, each with the next state: (state, array of elements).

    Lists are gathered in blocks and put together at the end, so the work grows with n.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(acc: Column, i: Column) -> Column:
        state, found = step(acc["at"], i)
        return F.struct(state.alias("at"), F.concat(acc["out"], found).alias("out"))

    def block(acc: Column, b: Column) -> Column:
        inner = F.aggregate(F.sequence(b * _BLOCK, F.least(b * _BLOCK + (_BLOCK - 1), n - 1)), F.struct(acc["at"].alias("at"), none.alias("out")), one)
        return bind(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    nothing = F.array().cast(f"array<array<{kind}>>")
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int"))
    return F.when(n <= 0, none).otherwise(F.aggregate(blocks, F.struct(start.alias("at"), nothing.alias("out")), block, lambda acc: F.flatten(acc["out"])))
