"""Running totals that never put a whole group in one task.

A window ordered inside a group needs all rows of that group in one task, so
one hot auction or user would stall the stage. Here the order is cut into
blocks: totals run inside each block, and each block's carry-in is the prefix
sum of its predecessors' totals, taken over pre-aggregated rows. Nesting
block levels bounds every window partition by the block width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bids and auction ids are 32-bit, so one level of this width leaves at most
# 2**16 rows in a block and 2**15 blocks in a group.
WIDTH = 1 << 16


def block_of(col: Column, width: int = WIDTH) -> Column:
    return F.floor(col / F.lit(width)).cast("long")


def double_blocks(df: DataFrame, col: Column, prefix: str) -> tuple[DataFrame, list[str]]:
    """`df` with nested block columns that follow the order of a double, and their names.

    The levels are the value's power of two with 5 bits behind it, 16 bits more
    and 16 bits more, so however close the values lie, no block holds more than
    2**16 distinct lower blocks or, innermost, 2**15 distinct values.
    """
    size = F.abs(col)
    power = F.floor(F.log2(size))
    # Close to a power of two the logarithm may be rounded past it: such values join the block at that end.
    digits = F.least(F.greatest(size / F.pow(F.lit(2.0), power), F.lit(1.0)), F.lit(2.0 - 2.0**-52))
    levels = [power * 32 + F.lit(1100 * 32) + F.floor(digits * 32) - 32, F.floor(digits * F.lit(2.0**21)), F.floor(digits * F.lit(2.0**37))]
    names = [f"{prefix}_{i}" for i in range(len(levels))]
    # Null for zero, which lies between both signs.
    signed = [F.coalesce(F.signum(col).cast("long") * level, F.lit(0).cast("long")) for level in levels]
    return df.withColumns(dict(zip(names, signed))), names


def carry_in(df: DataFrame, keys: list[str], block: str, measures: dict[str, Column]) -> DataFrame:
    """Per (keys, block): the totals of `measures` over all earlier blocks."""
    totals = df.groupBy(*keys, block).agg(*[F.sum(c).alias(f"_{n}") for n, c in measures.items()])
    by = f"PARTITION BY {', '.join(keys)}" if keys else ""
    earlier = f"({by} ORDER BY {block} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return totals.selectExpr(*keys, block, *[f"coalesce(sum(_{n}) OVER {earlier}, 0) AS {n}" for n in measures])


def running(
    df: DataFrame,
    keys: list[str],
    blocks: list[str],
    order: list[str],
    measures: dict[str, Column],
) -> DataFrame:
    """`df` plus, per measure, its inclusive running total within `keys`.

    `blocks` lists block columns from coarse to fine; each must be constant or
    increasing along the order. `order` must be unique inside the last block.
    """
    levels = []
    for depth, block in enumerate(blocks):
        above = keys + blocks[:depth]
        renamed = {f"{n}_{depth}": c for n, c in measures.items()}
        levels.append(carry_in(df, above, block, renamed))
    inside = (
        Window.partitionBy(*keys, *blocks)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    out = df.select("*", *[F.sum(c).over(inside).alias(f"{n}_in") for n, c in measures.items()])
    for depth, carry in enumerate(levels):
        out = out.join(carry, keys + blocks[: depth + 1])
    scratch = [f"{n}_in" for n in measures] + [
        f"{n}_{d}" for n in measures for d in range(len(blocks))
    ]
    totals = [
        sum((F.col(f"{n}_{d}") for d in range(len(blocks))), F.col(f"{n}_in")).alias(n)
        for n in measures
    ]
    kept = [c for c in out.columns if c not in scratch]
    return out.select(*kept, *totals)
