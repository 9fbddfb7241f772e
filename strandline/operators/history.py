"""Bitemporal history of changing attributes.

Every change of an entity says from when a value holds (valid time, the effect) and reaches us at some point of arrival
(recorded time, the seq). The ledger keeps every belief ever held: when a late change arrives inside a known interval, that
interval's row is closed in recorded time and superseded by a shorter one, never overwritten.

Method: a sweep over the changes of an entity from the latest effect to the earliest. A change ends, when it arrives, at the
next later effect that had arrived before it; and it cuts off, when it arrives, the next earlier effect that had arrived
before it. Changes that no change of later effect preceded in arrival ("in order") do so with their direct neighbours, found
by windows; runs of late changes between two of them are swept in Python with a stack as deep as late changes are nested.
All windows work on slices of an entity (see sliced), so one entity may hold any share of the rows. Rows that several branches
need are stored in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.feed import distinct_changes
from strandline.operators.sliced import Carry, slice_width, sliced, with_carried
from strandline.session import stored

OPEN = -1
LEDGER = "table_name string, key string, value string, live boolean, valid_from long, valid_to long, recorded_from long"


def attribute_changes(feed: DataFrame, table_name: str, key: str, attribute: str) -> DataFrame:
    """(table_name, key, eff, seq, live, value): one row per change; value is the attribute as text, null as null."""
    value = F.col(attribute)
    if dict(feed.dtypes)[attribute] in ("double", "float"):
        value = value + 0.0  # one zero
    rows = distinct_changes(feed.select("op", "ts_ms", "seq", "updated_at", F.col(key).cast("string").alias("k"), value.cast("string").alias("value")), "k", ["value"])
    return rows.select(F.lit(table_name).alias("table_name"), "key", "eff", "seq", "live", F.when(F.col("live"), F.col("value")).alias("value"))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks in descending order of effect, each an in-order change and the late ones right before it."""
    stack: list[tuple] = []
    block, before = None, None
    out: list[tuple] = []

    def emit(row: tuple, end: int, at: int) -> None:
        out.append((row[0], row[1], row[2], row[3], row[4], end, at))

    def finish() -> None:
        # what is left arrived after the in-order change before the block, and cuts that one off
        if before is not None:
            for row in stack:
                emit(before, row[4], row[5])
        stack.clear()

    for pdf in batches:
        for table, key, value, live, eff, seq, anchor, prev in zip(*(pdf[c] for c in ("table_name", "key", "value", "live", "eff", "seq", "anchor", "prev")), strict=True):
            if (table, key, anchor) != block:
                finish()
                block = (table, key, anchor)
                before = None if prev is None else (table, key, prev["value"], prev["live"], prev["eff"])
            row = (table, key, value, live, eff, seq)
            while stack and stack[-1][5] > seq:
                cut = stack.pop()
                emit(row, cut[4], cut[5])
            emit(row, stack[-1][4] if stack else OPEN, seq)
            stack.append(row)
        if len(out) >= 10_000:
            yield _frame(out)
            out = []
    finish()
    if out:
        yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["table_name", "key", "value", "live", "valid_from", "valid_to", "recorded_from"])


def bitemporal_ledger(changes: DataFrame, slice_us: int | None = None) -> DataFrame:
    """(table_name, key, value, live, valid_from, valid_to, recorded_from, recorded_to) from attribute_changes rows.

    One row per belief: from valid_from to valid_to (-1: open) the key had the value (live False: was deleted), believed from
    arrival recorded_from until recorded_to (-1: still). Valid times are epoch microseconds, recorded times are seqs.
    Whatever the order of arrival, the rows with recorded_to -1 are the intervals between successive effects. slice_us: width of
    the slices, 0 for one; by default as the size of changes asks for.
    """
    keys = ["table_name", "key"]
    slice_us = slice_width(changes) if slice_us is None else slice_us
    rows, part = sliced(stored(changes, "changes") if slice_us else changes, "eff", slice_us)
    rows = with_carried(rows, keys, part, [Carry("least_after", F.min("seq"), "min", back=True)])
    within = Window.partitionBy(*keys, *part).orderBy("eff")
    after = F.least("least_after", F.min("seq").over(within.rowsBetween(1, Window.unboundedFollowing)))
    rows = rows.withColumn("late", F.coalesce(F.col("seq") > after, F.lit(False))).drop("least_after")

    image = F.struct("eff", "value", "live")
    in_order = F.when(~F.col("late"), image)
    rows = with_carried(
        rows,
        keys,
        part,
        [
            Carry("prev_far", F.max_by(in_order, F.when(~F.col("late"), F.col("eff")))),
            Carry("next_far", F.min(F.when(~F.col("late"), F.col("eff"))), "last", back=True),
            Carry("late_far", F.max_by("late", "eff")),
        ],
    )
    earlier, later = within.rowsBetween(Window.unboundedPreceding, -1), within.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.select(
        *keys,
        "value",
        "live",
        "eff",
        "seq",
        "late",
        F.coalesce(F.last(in_order, ignorenulls=True).over(earlier), "prev_far").alias("prev"),
        F.coalesce(F.first(F.when(~F.col("late"), F.col("eff")), ignorenulls=True).over(later), "next_far").alias("anchor"),
        (F.col("late") | F.coalesce(F.lag("late").over(within), "late_far", F.lit(False))).alias("entangled"),
    )
    rows = stored(rows, "beliefs")
    plain = rows.where("not entangled").select(
        *keys,
        F.inline(
            F.array(
                F.struct("value", "live", F.col("eff").alias("valid_from"), F.lit(OPEN).cast("long").alias("valid_to"), F.col("seq").alias("recorded_from")),
                F.struct(F.col("prev.value").alias("value"), F.col("prev.live").alias("live"), F.col("prev.eff").alias("valid_from"), F.col("eff").alias("valid_to"), F.col("seq").alias("recorded_from")),
            )
        ),
    ).where("valid_from is not null")
    swept = rows.where("entangled").repartition(*keys, "anchor").sortWithinPartitions(*keys, "anchor", F.col("eff").desc()).mapInPandas(_sweep, LEDGER)
    beliefs = plain.unionByName(swept)
    w = Window.partitionBy(*keys, "valid_from").orderBy("recorded_from")
    return beliefs.withColumn("recorded_to", F.coalesce(F.lead("recorded_from").over(w), F.lit(OPEN).cast("long")))


def believed_at(ledger: DataFrame, recorded: int | None = None) -> DataFrame:
    """The ledger's rows as believed when message `recorded` had arrived; None: now."""
    if recorded is None:
        return ledger.where(F.col("recorded_to") == OPEN)
    return ledger.where((F.col("recorded_from") <= recorded) & ((F.col("recorded_to") == OPEN) | (F.col("recorded_to") > recorded)))


def versions(believed: DataFrame, slice_us: int | None = None) -> DataFrame:
    """(table_name, entity_id, value, valid_from_us, valid_to_us): longest runs of one value, not crossing a delete.

    believed: rows of the ledger that hold at one recorded time. valid_to_us is -1 for the run that still holds.
    """
    keys = ["table_name", "key"]
    state = F.struct("live", "value")
    slice_us = slice_width(believed) if slice_us is None else slice_us
    rows, part = sliced(stored(believed, "believed") if slice_us else believed, "valid_from", slice_us)
    rows = with_carried(rows, keys, part, [Carry("state_far", F.max_by(state, "valid_from"))])
    within = Window.partitionBy(*keys, *part).orderBy("valid_from")
    before = F.coalesce(F.lag(state).over(within), "state_far")
    turns = rows.withColumn("before", before).where(~F.col("before").eqNullSafe(state)).drop("before", "state_far")
    turns = with_carried(stored(turns, "turns") if part else turns, keys, part, [Carry("next_far", F.min("valid_from"), "last", back=True)])
    ends = F.coalesce(F.lead("valid_from").over(within), "next_far", F.lit(OPEN).cast("long"))
    return turns.withColumn("valid_to_us", ends).where("live").select("table_name", F.col("key").alias("entity_id"), "value", F.col("valid_from").alias("valid_from_us"), "valid_to_us")


def attribute_history(feeds: Sequence[tuple[DataFrame, str, str, str]], slice_us: int | None = None) -> DataFrame:
    """Current history of several attributes; feeds: (feed, table_name, key, attribute)."""
    if slice_us is None:
        narrow = [slice_width(feed.select(key, attribute, "seq", "updated_at")) for feed, _, key, attribute in feeds]
        slice_us = min(filter(None, narrow), default=0)
    rows = None
    for feed, name, key, attribute in feeds:
        one = attribute_changes(feed, name, key, attribute)
        rows = one if rows is None else rows.unionByName(one)
    return versions(believed_at(bitemporal_ledger(rows, slice_us)), slice_us)
