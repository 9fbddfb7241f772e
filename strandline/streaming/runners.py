"""Structured Streaming runners of the stateful stages. Each reads a stream, keeps its place in a checkpoint folder, and ends once
the input is used up unless a processing-time trigger is given. Late records are processed like any others.

Each batch is judged and stamped by the time at which it is processed; `clock` gives another time, for tests and replays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.config import Settings
from strandline.operators import correlate, ingest, quality, state
from strandline.operators.dedup import decisions, with_content
from strandline.operators.late_events import EventLedger
from strandline.schemas import OPERATIONAL
from strandline.sources.keyed import KeyedTable
from strandline.sources.logs import stream_changes

Clock = Callable[[], datetime]


def system_clock() -> datetime:
    return datetime.now(timezone.utc)


def _start(writer, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def normalize_stream(raw: DataFrame, good: str, audit: str, checkpoint: str, clock: Clock = system_clock, settings: Settings = Settings(), every: str | None = None) -> StreamingQuery:
    """Route raw envelopes to the normalized log or the audit log; each batch is checked once and written audit first. A batch
    that is repeated after a failure replaces its own folders."""

    def write(batch: DataFrame, number: int) -> None:
        now = clock()
        checked = quality.checked(batch, now, settings.normalize_skew_s).persist()
        try:
            quality.violations(checked, now).write.mode("overwrite").parquet(f"{audit}/batch={number}")
            quality.normalized(checked, now).write.mode("overwrite").parquet(f"{good}/batch={number}")
        finally:
            checked.unpersist()

    return _start(raw.writeStream.foreachBatch(write), checkpoint, every)


def poll_stream(feeds: DataFrame, raw: str, audit: str, markers: str, checkpoint: str, clock: Clock = system_clock, settings: Settings = Settings(), every: str | None = None) -> StreamingQuery:
    """Take in polls of a GeoJSON feed (value: the text): audit and raw records are written first, and only then are the markers of
    what was written put into the marker table, so a batch that fails midway is tried again whole. A marker counts for
    settings.marker_ttl_s after it was set; lapsed ones leave the table when their bucket is next written."""

    def write(batch: DataFrame, number: int) -> None:
        spark, now = batch.sparkSession, clock()
        table = KeyedTable(spark, markers, ["source_event_id"], "source_event_id string, seen string, set_at timestamp")
        polled = ingest.parse_features(ingest.features(batch)).persist()
        try:
            known = table.matching(polled.select("source_event_id"), before=number)
            alive = known.where(F.col("set_at") > F.lit(now) - F.expr(f"INTERVAL {settings.marker_ttl_s} SECONDS"))
            judged = ingest.classified(polled, alive, now, settings.ingest_skew_s).persist()
            quality.ingest_violations(judged, now).write.mode("overwrite").parquet(f"{audit}/batch={number}")
            new = judged.where("outcome = 'new'")
            quality.raw_envelope(new, now).write.mode("overwrite").parquet(f"{raw}/batch={number}")
            fresh = ingest.committed(alive.limit(0), judged, new).withColumn("set_at", F.lit(now).cast("timestamp"))
            keep = F.col("set_at") > F.lit(now) - F.expr(f"INTERVAL {settings.marker_ttl_s} SECONDS")
            table.upsert(fresh, number, lambda rows: state.latest(rows.where(keep), ["source_event_id"], "set_at"))
            judged.unpersist()
        finally:
            polled.unpersist()

    return _start(feeds.writeStream.foreachBatch(write), checkpoint, every)


def dedup_stream(events: DataFrame, out: str, held: str, checkpoint: str, order: str = "seq", arrival: str = "ingested_at", ttl_s: int | None = None, every: str | None = None) -> StreamingQuery:
    """Emit the events whose content differs from what their key said last; events without a key are emitted each.

    The state is a table of one digest and one time per key in `held`. Each batch is decided in the order of `order` by the
    same plan as a whole log, with the state before it; the buckets of its keys are then written anew, without the keys
    whose last event is ttl_s or more older than the newest one of the batch, by `arrival`.
    """

    def write(batch: DataFrame, number: int) -> None:
        table = KeyedTable(batch.sparkSession, held, ["dedup_key"], "dedup_key string, content_hash string, at long, batch long")
        rows = batch.persist()
        try:
            known = table.matching(with_content(rows).select("dedup_key"), before=number)
            decided = decisions(rows, order, arrival, ttl_s, held=known)
            decided.where("decision <> 'DROP'").select(*batch.columns).write.mode("overwrite").parquet(f"{out}/batch={number}")
            at = F.unix_micros(arrival)
            last = with_content(rows).groupBy("dedup_key").agg(F.max_by(F.struct("content_hash", at.alias("at")), order).alias("s")).select("dedup_key", "s.*")
            newest = rows.agg(F.max(at)).first()[0]
            alive = F.lit(True) if ttl_s is None or newest is None else F.col("at") > newest - ttl_s * 1_000_000
            table.upsert(last.withColumn("batch", F.lit(number).cast("long")), number, lambda both: state.latest(both.where(alive), ["dedup_key"], "batch"))
        finally:
            rows.unpersist()

    return _start(events.writeStream.foreachBatch(write), checkpoint, every)


def current_state_stream(changes: DataFrame, key: Sequence[str], table: str, checkpoint: str, every: str | None = None, buckets: int = 64) -> StreamingQuery:
    """Keep `table` at the latest change of every key, deletes included. A batch rewrites the buckets of keys it touches; see KeyedTable."""

    def write(batch: DataFrame, number: int) -> None:
        kept = KeyedTable(batch.sparkSession, table, key, batch.schema, buckets)
        kept.upsert(batch, number, lambda rows: state.latest(rows, key))

    return _start(changes.writeStream.foreachBatch(write), checkpoint, every)


def operational_streams(spark, feeds: str, tables: str, checkpoints: str, every: str | None = None) -> list[StreamingQuery]:
    """One query for each operational table, from its change feed below `feeds` to its state table below `tables`; hand them to
    statement_set."""
    return [current_state_stream(stream_changes(spark, feeds, name), key, f"{tables}/{name}", f"{checkpoints}/{name}", every) for name, (_, key) in OPERATIONAL.items()]


def read_state(spark, table: str, key: Sequence[str], schema) -> DataFrame:
    """The live rows of a state table; none while it is empty."""
    return KeyedTable(spark, table, key, schema).rows().where("not deleted").drop("deleted")


def correlate_stream(events: DataFrame, facilities: str, facility_schema, out: str, checkpoint: str, clock: Clock = system_clock, every: str | None = None) -> StreamingQuery:
    """Impact candidates of each batch of events with the facilities as they are when the batch is processed; none while no
    facility is known."""

    def write(batch: DataFrame, number: int) -> None:
        known = read_state(batch.sparkSession, facilities, ["facility_id"], facility_schema).select("facility_id", "supplier_id", "latitude", "longitude")
        correlate.correlate(batch, known, clock()).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _start(events.writeStream.foreachBatch(write), checkpoint, every)


def ledger_stream(messages: DataFrame, ledger: EventLedger, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Feed an EventLedger: each batch corrects the daily figures of the periods it touches."""
    return _start(messages.writeStream.foreachBatch(lambda batch, number: ledger.apply(batch, number) and None), checkpoint, every)


def statement_set(queries: Sequence[StreamingQuery], poll_s: float = 0.2) -> None:
    """Wait for several queries that were started side by side. If one fails, the others are stopped and its failure is raised."""
    left = list(queries)
    try:
        while left:
            for q in list(left):
                if q.awaitTermination(poll_s):  # raises what the query failed of
                    left.remove(q)
    except BaseException:
        for q in left:
            q.stop()
        raise


def lag_metrics(events: DataFrame, name: str = "event_time_lag") -> DataFrame:
    """events, observed: count and greatest lag in seconds between event time and receipt, without dropping anything."""
    lag = (F.unix_micros("ingested_at") - F.unix_micros("event_time")) / 1e6
    return events.observe(name, F.count(F.lit(1)).alias("n"), F.max(lag).alias("greatest_lag_s"))
