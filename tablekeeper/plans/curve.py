"""Clustering by several columns at once: rows sorted along a curve through the grid of their quantiles.

Each column's value becomes the number of its part among parts of about equally many rows. The numbers' bits, taken in turn from
the highest, are a row's place on the curve. Rows near each other there are near in every column, so a file of a range of places
has a narrow minimum and maximum in each of them, and a filter on any one skips most files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeeper.functions.predicates import col
from tablekeeper.plans.conditions import Parts

#: Bits of each column's part number, and of a place in all.
BITS, PLACE_BITS = 8, 60


def place(frame: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """A row's place on the curve; a null counts as the least value."""
    bits = min(bits, PLACE_BITS // len(columns))
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    numbers = [F.least(Parts(frame, col(c), kinds[c], 1 << bits).number(col(c)), F.lit((1 << bits) - 1)).cast("long") for c in columns]
    out = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for number in numbers:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(number, bit).bitwiseAND(F.lit(1)))
    return out


def write_clustered(frame: DataFrame, path: str, columns: Sequence[str], files: int, mode: str = "overwrite") -> None:
    """Write parquet in about so many files, each a stretch of the curve, sorted inside by it."""
    if not columns:
        raise ValueError("clustering needs a column at least")
    placed = frame.withColumn("__place", place(frame, columns))
    placed.repartitionByRange(files, "__place").sortWithinPartitions("__place").drop("__place").write.mode(mode).parquet(path)
