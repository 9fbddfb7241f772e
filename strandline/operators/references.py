"""References to records that do not exist when the referring message is captured.

Method: the distinct (parent, key, period) of all references are anti-joined against the keys the parent feeds ever set
(`missing`) and held against the parents' state per period; only references in periods through which their parent doesn't
simply live are joined back to the rows, and only in periods with a change of the parent is the instant looked up. The parents'
feeds are read once and the referring feeds twice: for the distinct keys, and to join back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.feed import UPSERTS, changes
from strandline.operators.sliced import DAY_US, slice_of, slice_width
from strandline.session import stored


#: period of references without a capture time
NO_PERIOD = -(1 << 40)


@dataclass(frozen=True)
class Reference:
    """`field` of the feed called `table_name` refers to keys of the feed called `parent`."""

    table_name: str
    field: str
    parent: str


def _rows(feeds: dict[str, DataFrame], refs: Sequence[Reference], width: int) -> DataFrame:
    out = None
    for table in dict.fromkeys(r.table_name for r in refs):
        own = [r for r in refs if r.table_name == table]
        pairs = F.array(*[F.struct(F.lit(r.field).alias("field"), F.lit(r.parent).alias("parent"), F.col(r.field).alias("key")) for r in own])
        rows = (
            feeds[table]
            .where(F.col("op").isin(*UPSERTS))
            .select(F.lit(table).alias("table_name"), "seq", (F.col("ts_ms") * F.lit(1000)).alias("at"), F.inline(pairs))
            .where("key is not null")
        )
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("part", F.coalesce(slice_of("at", width), F.lit(NO_PERIOD)))


def orphan_references(feeds: dict[str, DataFrame], keys: dict[str, str], refs: Sequence[Reference], period_us: int | None = None) -> DataFrame:
    """(table_name, field, seq, at, kind) of each non-null reference of an upsert whose key isn't live at the capture instant.

    feeds: the change feeds by name; keys: the key column of each parent feed; period_us: width of the periods, by default four
    days, and less where the feeds are so large that a hot key's period wouldn't fit in a task.
    kind is `missing` (no upsert has the key at all), `late` (the key's first change takes effect after the capture) or
    `deleted`. Keys are compared as written, so a blank is a key. A reference without a capture time is reported only if
    its key is missing. Repeated messages are reported each; rows without op, and delete and null-op messages, refer to
    nothing. Empty feeds: no rows; an empty parent feed makes every reference to it missing.
    """
    period_us = period_us or min(slice_width(feeds[r.table_name], widest=4 * DAY_US) for r in refs)
    rows = _rows(feeds, refs, period_us)
    parents = None
    for name in dict.fromkeys(r.parent for r in refs):
        one = changes(feeds[name], keys[name]).select(F.lit(name).alias("parent"), "key", "eff", "live")
        parents = one if parents is None else parents.unionByName(one)
    parents = stored(parents.groupBy("parent", "key", "eff").agg(F.max("live").alias("live")).withColumn("part", slice_of("eff", period_us)), "parents")
    where = ["parent", "key", "part"]

    probes = rows.select(*where).distinct()
    existing = parents.where("live").select("parent", "key").distinct()
    missing = probes.join(existing, ["parent", "key"], "left_anti").select(*where, F.lit(None).cast("boolean").alias("entering"), F.lit(False).alias("changing"), F.lit(None).cast("long").alias("first_eff"))

    # State per period: what each period leaves behind, brought forward over the periods that references fall in.
    left = parents.groupBy(*where).agg(F.max_by("live", "eff").alias("left_live"), F.min("eff").alias("least"), F.max("live").alias("sets"))
    marks = left.select(*where, "left_live", "least", "sets", F.lit(False).alias("probe")).unionByName(probes.withColumn("probe", F.lit(True)), allowMissingColumns=True)
    of_key = Window.partitionBy("parent", "key")
    in_order = of_key.orderBy("part")
    spine = marks.select(
        *where,
        "probe",
        F.last("left_live", ignorenulls=True).over(in_order.rangeBetween(Window.unboundedPreceding, -1)).alias("entering"),
        F.max(F.col("left_live").isNotNull()).over(in_order.rangeBetween(0, 0)).alias("changing"),
        F.min("least").over(of_key).alias("first_eff"),
        F.max("sets").over(of_key).alias("sets"),
    )
    doubtful = spine.where(f"probe and sets and part <> {NO_PERIOD} and (changing or not coalesce(entering, false))").select(*where, F.coalesce("entering", F.lit(False)).alias("entering"), "changing", "first_eff")

    doubtful = stored(missing.unionByName(doubtful), "doubtful")
    suspects = stored(rows.join(doubtful, where), "suspects")
    settled = suspects.where("not changing").select("table_name", "field", "seq", "at", "first_eff", F.col("entering").isNull().alias("never"))

    # Periods with a change: the last change at or before the instant, within (parent, key, period).
    timed = suspects.where("changing").select(*where, F.col("at").alias("t"), F.lit(1).alias("side"), "table_name", "field", "seq", "entering", "first_eff", F.lit(None).cast("boolean").alias("live"))
    # only the changes of periods in doubt are needed beside them
    beside = parents.join(doubtful.where("changing").select(*where), where, "left_semi")
    both = timed.unionByName(beside.select(*where, F.col("eff").alias("t"), F.lit(0).alias("side"), "live"), allowMissingColumns=True)
    w = Window.partitionBy(*where).orderBy("t", "side").rowsBetween(Window.unboundedPreceding, 0)
    looked = both.withColumn("then", F.last("live", ignorenulls=True).over(w)).where("side = 1 and not coalesce(then, entering)")
    looked = looked.select("table_name", "field", "seq", F.col("t").alias("at"), "first_eff", F.lit(False).alias("never"))

    found = settled.unionByName(looked)
    kind = F.when(F.col("never"), "missing").when(F.col("first_eff") > F.col("at"), "late").otherwise("deleted")
    return found.select("table_name", "field", "seq", "at", kind.alias("kind"))


def orphan_report(orphans: DataFrame, period_us: int = DAY_US) -> DataFrame:
    """(table_name, field, kind, period_start_us, orphans): counts per table, field and period of capture; a null period for
    references without a capture time."""
    start = slice_of("at", period_us) * F.lit(period_us)
    return orphans.groupBy("table_name", "field", "kind", start.alias("period_start_us")).agg(F.count("*").alias("orphans"))
