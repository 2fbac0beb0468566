"""Where values stand among sorted cut points of their own type: a binary search as a built-in expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sampled values behind each cut, and the characters of a text that make a cut point.
SAMPLED, CUT_CHARS = 20, 128
_APART = "\x01"


def steps_before(value: Column, cuts: Column, count: int, before: Callable[[Column, Column], Column]) -> Column:
    """How many of `count` sorted cuts are before the value; 0 for null. `before(cut, value)` holds for none after one it fails."""
    if count == 0:
        return F.lit(0)
    widths = F.array(*[F.lit(1 << k) for k in reversed(range(count.bit_length()))])

    def further(at: Column, width: Column) -> Column:
        return F.when(before(F.get(cuts, at + width - 1), value), at + width).otherwise(at)

    return F.aggregate(widths, F.lit(0), further)


def text_cuts(frame: DataFrame, value: Column, cells: int) -> list[str]:
    """At most `cells - 1` different beginnings of values, in order, with about equally many rows between them."""
    held = frame.select(F.substring(value, 1, CUT_CHARS).alias("v")).filter(F.col("v").isNotNull() & ~F.contains("v", F.lit(_APART)))
    share = min(1.0, SAMPLED * cells / max(1, held.count()))
    found = sorted(r[0] for r in held.sample(share, seed=5).collect())
    return sorted({found[k * len(found) // cells] for k in range(1, cells)}) if found else []


def text_array(cuts: Sequence[str]) -> Column:
    """The texts as one literal, however many there are."""
    return F.split(F.lit(_APART.join(cuts)), _APART)
