"""Array expressions that Spark lacks: a value bound once, and a running state over an array's items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Items are worked off in blocks of so many.
BLOCK = 256


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body's functions use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(items: Column, zero: Column, carry: Callable[[Column, Column], Column], emit: Callable[[Column, Column, Column], Column], state: str, kind: str) -> Column:
    """``emit(state, item, state at the begin of the item's block)`` of every item, where ``carry`` takes the state
    from item to item; ``state`` and ``kind`` are the types of states and results.

    Items are taken in blocks of ``BLOCK``: one pass finds the state at each block's begin, a second one
    works off the blocks, so no array that grows is longer than a block or the number of blocks.
    """

    def blocks(all_items: Column) -> Column:
        begins = F.sequence(F.lit(1), F.greatest(F.size(all_items), F.lit(1)), F.lit(BLOCK))
        return F.transform(begins, lambda at: F.slice(all_items, at, BLOCK))

    def run(blocked: Column) -> Column:
        begins = F.aggregate(
            blocked,
            F.struct(zero.alias("now"), F.array().cast(f"array<{state}>").alias("begins")),
            lambda st, block: F.struct(F.aggregate(block, st["now"], carry).alias("now"), F.concat(st["begins"], F.array(st["now"])).alias("begins")),
            lambda st: st["begins"],
        )

        def inside(block: Column, begin: Column) -> Column:
            return F.aggregate(
                block,
                F.struct(begin.alias("now"), F.array().cast(f"array<{kind}>").alias("out")),
                lambda st, x: F.struct(carry(st["now"], x).alias("now"), F.concat(st["out"], F.array(emit(st["now"], x, begin))).alias("out")),
                lambda st: st["out"],
            )

        return F.flatten(F.zip_with(blocked, begins, inside))

    return bound(bound(items, blocks), run)
