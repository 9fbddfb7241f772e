"""Dropping events that repeat what their key said last.

An event is NEW if its key has no state, DROP if its content equals the state, else UPDATE; the state is the content of the last
event of the key in order of arrival, dropped or not, so comparing with the previous row is the same. Event time and versions
play no part. With a time to live, the state of a key lapses that long after its last event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.text import content_hash, dedup_key
from strandline.operators.sliced import Carry, slice_width, sliced, with_carried


def with_content(events: DataFrame) -> DataFrame:
    """events with `dedup_key` and `content_hash`."""
    return events.withColumn("dedup_key", dedup_key(F.col("source"), F.col("source_event_id"))).withColumn("content_hash", content_hash(F.col("event_time")))


def decisions(events: DataFrame, order: str = "seq", arrival: str | None = None, ttl_s: int | None = None, slice_seqs: int | None = None, held: DataFrame | None = None) -> DataFrame:
    """events with `dedup_key`, `content_hash` and `decision`. order: number of arrival, unique within a key; arrival: timestamp
    the time to live is measured by. Events without a key are NEW each.

    A key is cut into slices of slice_seqs arrivals, each entered with the last state of the slices before, so that one key may
    hold any share of the events. By default there is one slice (0) where a hot key fits in a task, else they are of a million
    arrivals. Events without a key pass through the same plan, each a key of its own. held: the state before the first event
    (dedup_key, content_hash, at in epoch microseconds), at most one row a key.
    """
    state = F.struct(F.col("content_hash"), (F.unix_micros(arrival) if arrival else F.lit(None).cast("long")).alias("at"))
    rows = with_content(events)
    if slice_seqs is None:
        slice_seqs = 1_000_000 if slice_width(events) else 0
    lone = F.col("dedup_key").isNull()
    keyed = rows.withColumn("_lone", lone).withColumn("_key", F.when(lone, F.col(order).cast("string")).otherwise(F.col("dedup_key"))).withColumn("_state", state)
    keyed, part = sliced(keyed, order, slice_seqs, "_part")
    keyed = with_carried(keyed, ["_lone", "_key"], part, [Carry("_far", F.max_by("_state", order))])
    w = Window.partitionBy("_lone", "_key", *part).orderBy(order)
    keyed = keyed.withColumn("_before", F.coalesce(F.lag("_state").over(w), "_far"))
    if held is not None:
        own = held.select("dedup_key", F.struct("content_hash", "at").alias("_held"))
        keyed = keyed.join(own, "dedup_key", "left").withColumn("_before", F.coalesce("_before", "_held"))
    new = F.col("_lone") | F.col("_before").isNull()
    if ttl_s is not None:
        new = new | (F.col("_state.at") - F.col("_before.at") >= ttl_s * 1_000_000)
    decided = F.when(new, "NEW").when(F.col("_before.content_hash") == F.col("content_hash"), "DROP").otherwise("UPDATE")
    return keyed.withColumn("decision", decided).select(*rows.columns, "decision")


def deduplicated(events: DataFrame, order: str = "seq", arrival: str | None = None, ttl_s: int | None = None) -> DataFrame:
    """The events that are NEW or UPDATE, unchanged."""
    return decisions(events, order, arrival, ttl_s).where("decision <> 'DROP'").drop("dedup_key", "content_hash", "decision")
