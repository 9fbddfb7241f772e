"""Running aggregates over the rows of a key that don't need all rows of the key in one task.

A window partitioned by the key alone sends a key that holds a third of all rows to one task. Here the axis is cut into
slices: each (key, slice) is summed up first (with map-side combining), the summaries - at most one row per key and slice -
run through the window of the key, and what comes from the slices before or after is joined back to the rows. Row-level
windows are then partitioned by (key, slice). The join and those windows share one partitioning, so rows move once.

The width of the slices follows the amount of data, so that a slice of a hot key fits in a task at any size. Where even the whole
of a hot key does, one slice holds the axis: there is nothing to bring, and summaries and join are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


#: bytes, as the planner estimates them, of one key in one slice
SLICE_BYTES = 64 << 20


def slice_width(df: DataFrame, span: int = 180 * DAY_US, widest: int = 0, slice_bytes: int = SLICE_BYTES) -> int:
    """Width of slices such that a key with a third of df, spread over `span`, has at most slice_bytes in one; 0: one slice is
    enough. widest: a width not to exceed, if not 0. The size is the planner's estimate; no job runs."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:  # not known
        return widest or 8 * DAY_US
    slices = -(-size // (3 * slice_bytes))
    width = 0 if slices <= 1 else max(1, span // slices)
    return min(width, widest) if width and widest else width or widest


def sliced(df: DataFrame, axis: Column | str, width: int, name: str = "part") -> tuple[DataFrame, list[str]]:
    """df with the number of the slice, and the name of that column in a list; df and an empty list if one slice is enough."""
    return (df.withColumn(name, slice_of(axis, width)), [name]) if width else (df, [])


def slice_of(axis: Column | str, width: int) -> Column:
    """Number of the slice of `width` units that holds the value."""
    col = F.col(axis) if isinstance(axis, str) else axis
    return F.floor(col / F.lit(width)).cast("long")


@dataclass(frozen=True)
class Carry:
    """A value brought into each slice of a key: `of` sums up one slice (null: nothing to bring), `how` combines the
    slices (last, min, max), `back` is True if it comes from the slices after."""

    name: str
    of: Column
    how: str = "last"
    back: bool = False

    def over(self, keys: Sequence[str], part: str) -> Column:
        order = F.col(part).desc() if self.back else F.col(part).asc()
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        col = F.col(self.name)
        return {"last": F.last(col, ignorenulls=True), "min": F.min(col), "max": F.max(col)}[self.how].over(w).alias(self.name)


def with_carried(df: DataFrame, keys: Sequence[str], part: Sequence[str], carries: Sequence[Carry]) -> DataFrame:
    """df with one column per carry. Keys and slices must not be null. part: the slice's column, see `sliced`; without one, the
    carries are null."""
    if not part:
        kinds = df.agg(*[c.of.alias(c.name) for c in carries]).schema
        return df.withColumns({c.name: F.lit(None).cast(kinds[c.name].dataType) for c in carries})
    summed = df.groupBy(*keys, *part).agg(*[c.of.alias(c.name) for c in carries])
    brought = summed.select(*keys, *part, *[c.over(keys, part[0]) for c in carries])
    return df.join(brought, [*keys, *part])
