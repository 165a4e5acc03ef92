"""Cut rows into consecutive ranges of a numeric key, so that a global order needs no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROWS_PER_RANGE = 2_000
MOST_RANGES = 16_384  # bounds are sent with the plan, so their number is bounded; ranges grow beyond it
COARSE = 128


def range_bounds(df: DataFrame, key: str) -> list[int]:
    """Ascending bounds that cut the non-NULL keys into ranges of about equal size (from one scan of the key)."""
    df = df.select(key)
    n = df.select(F.count(key)).first()[0]
    ranges = min(MOST_RANGES, -(-n // ROWS_PER_RANGE))
    if ranges < 2:
        return []
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    return sorted(set(df.select(F.percentile_approx(key, shares, 10 * ranges)).first()[0]))


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range of a key: how many bounds are less than it.  A NULL key is in range 0.

    Bounds are searched in two levels, so a key is compared with about twice the root of their number.
    """
    if not bounds:
        return F.lit(0)
    blocks = [bounds[i:i + COARSE] for i in range(0, len(bounds), COARSE)]
    firsts = F.array(*[F.lit(b[0]).cast("long") for b in blocks])
    block = F.greatest(F.size(F.filter(firsts, lambda x: x < key)) - 1, F.lit(0))
    inner = F.array(*[F.array(*[F.lit(x).cast("long") for x in b]) for b in blocks])[block]
    return F.coalesce(block * COARSE + F.size(F.filter(inner, lambda x: x < key)), F.lit(0))
