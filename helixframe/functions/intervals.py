"""Bins by length for joins of intervals (1-based, inclusive) of any length.

The bins of a level are ``BRANCH`` times as wide as those of the level below. An interval's own level is the
lowest whose bins are at least as wide as the interval, so it touches at most two of them there and at every
level above. Two intervals that overlap share a bin at the higher of their own levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BRANCH = 16
LEVELS = 8  # from 1000 bases up, the highest bins are 268 billion bases wide


def widths(bin_size: int) -> list[int]:
    return [bin_size * BRANCH**level for level in range(LEVELS)]


def own_level(start: Column, end: Column, bin_size: int) -> Column:
    """The lowest level with bins as wide as the interval; the highest one if none is."""
    level = F.lit(LEVELS - 1)
    for at, width in reversed(list(enumerate(widths(bin_size)[:-1]))):
        level = F.when(end - start < width, at).otherwise(level)
    return level.cast("int")


def bin_of(place: Column, level: Column, bin_size: int) -> Column:
    width = F.get(F.array(*[F.lit(w).cast("long") for w in widths(bin_size)]), level)
    return F.floor((place - 1) / width).cast("long")


def levels_present(df: DataFrame, start: str, end: str, bin_size: int) -> list[int]:
    """The own levels of a table's intervals: one number is aggregated, at most ``LEVELS`` come back."""
    level = own_level(F.col(start), F.col(end), bin_size)
    bit = F.element_at(F.array(*[F.lit(1 << at) for at in range(LEVELS)]), level + 1)
    bits = df.where(F.col(start) <= F.col(end)).agg(F.bit_or(bit).alias("bits")).first()["bits"]
    return [at for at in range(LEVELS) if (bits or 0) >> at & 1]


def places(start: Column, end: Column, entries: Column, bin_size: int) -> Column:
    """A row per bin that the interval touches, for ``entries`` of (level, side): structs of level, side and bin."""
    def touched(entry: Column) -> Column:
        first, last = (bin_of(x, entry["level"], bin_size) for x in (start, end))
        return F.transform(F.sequence(first, last), lambda b: F.struct(entry["level"].alias("level"), entry["side"].alias("side"), b.alias("bin")))
    return F.explode(F.flatten(F.transform(entries, touched)))


def entry(level: Column, side: int) -> Column:
    return F.struct(level.cast("int").alias("level"), F.lit(side).alias("side"))
