"""Attributes as they were at the time of an event.

Method: entities are hash-partitioned into buckets, and each bucket runs an embedded DuckDB ASOF LEFT JOIN of its events with
its versions, ordered by when they became valid; versions of one instant are one change, represented by the smallest seq,
before they get there. A bucket holds slices of entities, each with the version that enters the slice, so an entity with a
third of all rows spreads over all tasks, however much that is (see sliced.slice_width); and a task passes its sorted rows to DuckDB
in blocks, each led by the version in force, so memory doesn't grow with the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.operators.sliced import slice_of, slice_width

BLOCK_ROWS = 200_000


def _joined(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "256MB"})
    carried: pa.Table | None = None

    def run(rows: pa.Table) -> pa.Table:
        nonlocal carried
        block = rows if carried is None else pa.concat_tables([carried, rows])
        con.register("block", block)
        try:
            out = con.sql(
                "SELECT e.id, e.entity, e.t, v.seq, v.live FROM (SELECT * FROM block WHERE side = 1) e "
                "ASOF LEFT JOIN (SELECT * FROM block WHERE side = 0) v ON e.entity = v.entity AND e.part = v.part AND e.t >= v.t"
            ).to_arrow_table()
        finally:
            con.unregister("block")
        # rows come sorted, so only the last version can be in force in the next block
        versions = pc.indices_nonzero(pc.equal(block["side"], 0))
        carried = block.slice(versions[-1].as_py(), 1) if len(versions) else None
        return out

    gathered: list[pa.RecordBatch] = []
    size = 0
    for batch in blocks:
        gathered.append(batch)
        size += batch.num_rows
        if size >= BLOCK_ROWS:
            yield from run(pa.Table.from_batches(gathered)).to_batches()
            gathered, size = [], 0
    if size:
        yield from run(pa.Table.from_batches(gathered)).to_batches()


def _part(slice_us: int):
    return slice_of("t", slice_us) if slice_us else F.lit(0).cast("long")


def _with_entering(vs: DataFrame, ev: DataFrame) -> DataFrame:
    """vs with the version that enters each slice that has events."""
    left = vs.groupBy("entity", "part").agg(F.max_by(F.struct("t", "seq", "live"), "t").alias("left"))
    asked = ev.select("entity", "part").distinct()
    order = Window.partitionBy("entity").orderBy("part").rangeBetween(Window.unboundedPreceding, -1)
    spine = left.withColumn("asked", F.lit(False)).unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True)
    entering = spine.withColumn("enters", F.last("left", ignorenulls=True).over(order)).where("asked and enters is not null")
    return vs.unionByName(entering.select("entity", "part", F.col("enters.t").alias("t"), F.col("enters.seq").alias("seq"), F.col("enters.live").alias("live")))


def asof_versions(events: DataFrame, versions: DataFrame, slice_us: int | None = None) -> DataFrame:
    """(id, entity, t, seq, live) of each event with the version of its entity with the latest eff at or before t.

    events: id, entity, t (epoch microseconds); versions: entity, eff, seq, live, one row per entity and eff. seq and live are
    null if there is no such version; a deleted entity gives live False. Events with a null entity or time match nothing and
    are left out; repeated events are kept. Other columns of either side are ignored. slice_us: width of the slices, 0 for one; by
    default as the size of both sides asks for.
    """
    if slice_us is None:
        slice_us = min(filter(None, (slice_width(events), slice_width(versions))), default=0)
    ev = events.where("entity is not null and t is not null").select("id", "entity", "t").withColumn("part", _part(slice_us))
    vs = versions.where("entity is not null and eff is not null").select("entity", F.col("eff").alias("t"), "seq", "live").withColumn("part", _part(slice_us))
    known = (_with_entering(vs, ev) if slice_us else vs).withColumn("side", F.lit(0))
    both = known.unionByName(ev.withColumn("side", F.lit(1)), allowMissingColumns=True).select("entity", "part", "t", "side", "id", "seq", "live")
    sorted_rows = both.repartition("entity", "part").sortWithinPartitions("entity", "part", "t", "side")
    schema = T.StructType([T.StructField("id", ev.schema["id"].dataType), T.StructField("entity", ev.schema["entity"].dataType), T.StructField("t", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("live", T.BooleanType())])
    return sorted_rows.mapInArrow(_joined, schema)
