"""Per-period aggregates by event time that late messages correct until a cut-off.

Method: each new batch is routed (on time, late, too late), its accepted messages are added to the retained raw events, the
periods it touches are recomputed entirely from those raw events, and the recomputed periods replace the old ones in one
atomic step. `EventLedger` does so over files; `replayed` feeds it a whole log batch by batch; `daily_revisions` gives the figures
after every batch as one plan.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.sliced import DAY_US


@dataclass(frozen=True)
class LatenessRules:
    """A period of period_us closes grace_us after its end; messages are taken up to cutoff_us after its end."""

    period_us: int = DAY_US
    grace_us: int = 300_000_000
    cutoff_us: int = 2 * DAY_US


def period_number(event_time: str, rules: LatenessRules) -> Column:
    return F.floor(F.unix_micros(event_time) / F.lit(rules.period_us)).cast("long")


def route(messages: DataFrame, rules: LatenessRules = LatenessRules(), event_time: str = "event_time", ingested_at: str = "ingested_at") -> DataFrame:
    """messages with `period` (number of the UTC period of event_time) and `verdict`.

    verdict: `on_time` up to and including the grace after the period's end, `late` up to and including the cut-off,
    `too_late` after it, `unplaced` if either time is null. Every row is kept.
    """
    behind = F.unix_micros(ingested_at) - (F.col("period") + 1) * F.lit(rules.period_us)
    verdict = (
        F.when(behind.isNull(), "unplaced").when(behind <= rules.grace_us, "on_time").when(behind <= rules.cutoff_us, "late").otherwise("too_late")
    )
    return messages.withColumn("period", period_number(event_time, rules)).withColumn("verdict", verdict)


def daily_figures(accepted: DataFrame, by: Sequence[str] = ("period", "event_type")) -> DataFrame:
    """Figures per period and event type over routed messages: distinct messages and the sum, count and maximum of severity.

    Repeated deliveries of an event_id count once; a null or NaN severity counts in n_messages only. The first aggregate
    collapses repeats with map-side combining, so no group is gathered in one task.
    """
    severity = F.when(~F.isnan("payload.severity"), F.col("payload.severity"))
    once = accepted.groupBy(*by, "event_id").agg(F.max(severity).alias("severity"))
    return once.groupBy(*by).agg(F.count("*").alias("n_messages"), F.count("severity").alias("n_severity"), F.round(F.sum("severity"), 6).alias("sum_severity"), F.max("severity").alias("max_severity"))


def daily_revisions(messages: DataFrame, rules: LatenessRules = LatenessRules()) -> DataFrame:
    """(period, event_type, batch, figures): what each touched period came to after each batch, batches being the periods of
    ingestion.

    Each touched (period, batch) is recomputed entirely from the raw messages accepted by then. As messages are taken up
    to the cut-off only, a period is touched by at most 2 + cutoff/period batches, which bounds the copies of a message.
    A message ingested before its own period (clock skew) counts from the period's own batch on.
    """
    taken = route(messages.select("event_id", "event_type", "event_time", "ingested_at", F.struct("payload.severity").alias("payload")), rules).where("verdict in ('on_time', 'late')")
    taken = taken.withColumn("batch", F.greatest(F.floor(F.unix_micros("ingested_at") / F.lit(rules.period_us)).cast("long"), F.col("period")))
    first_seen = taken.groupBy("period", "event_type", "event_id").agg(F.min("batch").alias("batch"), F.max_by("payload", "batch").alias("payload"))
    touched = first_seen.select("period", F.col("batch").alias("revision")).distinct()
    recomputed = first_seen.join(touched, "period").where("revision >= batch").drop("batch").withColumnRenamed("revision", "batch")
    severity = F.when(~F.isnan("payload.severity"), F.col("payload.severity"))
    return recomputed.groupBy("period", "event_type", "batch").agg(
        F.count("*").alias("n_messages"), F.count(severity).alias("n_severity"), F.round(F.sum(severity), 6).alias("sum_severity"), F.max(severity).alias("max_severity")
    )


class EventLedger:
    """Raw events and daily figures below one folder, kept up to date batch by batch.

    Layout: raw/period=P/batch_id=B/ (accepted messages), aside/verdict=V/batch_id=B/ (set apart), figures/period=P/version=N/ and
    CURRENT, a small JSON file with the last batch and, for every period, the version that holds its figures. A batch writes its
    messages and its recomputed periods beside what is there and then replaces CURRENT by a rename (atomic where the file system's
    is), so readers see all of a batch or nothing of it. Batches come in ascending order of their ids. One that failed midway
    is applied again whole and replaces its own files; one that was applied already changes nothing. A superseded version is
    kept for readers until the next batch that touches its period, and then deleted.
    """

    def __init__(self, spark: SparkSession, root: str, rules: LatenessRules = LatenessRules()):
        self.spark, self.root, self.rules = spark, root.rstrip("/"), rules
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utils = jvm.org.apache.commons.io.IOUtils

    def _current(self) -> dict:
        p = self._path(f"{self.root}/CURRENT")
        if not self._fs.exists(p):
            return {"batch": None, "version": 0, "periods": {}}
        stream = self._fs.open(p)
        try:
            return json.loads(self._utils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _swap(self, state: dict) -> None:
        new, now = self._path(f"{self.root}/CURRENT.new"), self._path(f"{self.root}/CURRENT")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(now.toUri(), self.spark._jsc.hadoopConfiguration())
        overwrite = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        flags = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        flags[0] = overwrite
        context.rename(new, now, flags)

    def _folders(self, pattern: str) -> list[str]:
        return [str(s.getPath()) for s in self._fs.globStatus(self._path(f"{self.root}/{pattern}")) or []]

    def _discard(self, folders: Iterable[str]) -> None:
        for folder in folders:
            self._fs.delete(self._path(folder), True)

    def _read(self, name: str, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*folders)

    def apply(self, batch: DataFrame, batch_id: int) -> list[int]:
        """Take in one batch; gives the touched periods. The list is bounded: accepted messages fall into periods that were
        open since the last batch. All batches have the same columns."""
        state = self._current()
        if state["batch"] is not None and batch_id <= state["batch"]:
            return []
        self._discard([*self._folders(f"raw/period=*/batch_id={batch_id}"), *self._folders(f"aside/verdict=*/batch_id={batch_id}")])
        # each period's rows go to few files; a period with most of the rows is split by size, not put into one task
        routed = route(batch, self.rules).withColumn("batch_id", F.lit(batch_id)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            routed.where("verdict in ('on_time', 'late')").hint("rebalance", "period").write.mode("append").partitionBy("period", "batch_id").parquet(f"{self.root}/raw")
            routed.where("verdict in ('too_late', 'unplaced')").write.mode("append").partitionBy("verdict", "batch_id").parquet(f"{self.root}/aside")
        finally:
            routed.unpersist()
        touched = sorted(int(f.rsplit("/", 2)[1].split("=")[1]) for f in self._folders(f"raw/period=*/batch_id={batch_id}"))
        periods, version = dict(state["periods"]), state["version"] + 1
        if touched:
            kept = [f for p in touched for f in self._folders(f"raw/period={p}/batch_id=*") if int(f.rsplit("=", 1)[1]) <= batch_id]
            figures = daily_figures(self._read("raw", kept)).withColumn("version", F.lit(version))
            stale = [f for p in touched for f in self._folders(f"figures/period={p}/version=*") if int(f.rsplit("=", 1)[1]) != periods.get(str(p))]
            self._discard(stale)
            figures.hint("rebalance", "period").write.mode("append").partitionBy("period", "version").parquet(f"{self.root}/figures")
            periods |= {str(p): version for p in touched}
        self._swap({"batch": batch_id, "version": version, "periods": periods})
        return touched

    def _applied(self, name: str) -> list[str]:
        last = self._current()["batch"]
        return [f for f in self._folders(f"{name}/*/batch_id=*") if last is not None and int(f.rsplit("=", 1)[1]) <= last]

    def _messages(self, name: str) -> DataFrame:
        folders = self._applied(name)
        if not folders:
            raise ValueError(f"no batch with messages in {name} has been applied yet")
        return self._read(name, folders)

    def raw(self) -> DataFrame:
        """The retained raw messages of the batches applied; filters on period prune files."""
        return self._messages("raw")

    def aside(self) -> DataFrame:
        """Messages past the cut-off and messages without a time, of the batches applied."""
        return self._messages("aside")

    def figures(self) -> DataFrame:
        """The current figures of every period."""
        periods = self._current()["periods"]
        if not periods:
            raise ValueError("no batch with accepted messages has been applied yet")
        return self._read("figures", [f"{self.root}/figures/period={p}/version={v}" for p, v in sorted(periods.items())]).drop("version")

    def late(self) -> DataFrame:
        """(event_id, verdict) of each message that is late, from the retained raw events, or too late, from those set apart; a
        repeated delivery counts once."""
        out = self.spark.createDataFrame([], "event_id string, verdict string")
        for name, verdict in (("raw", "late"), ("aside", "too_late")):
            if self._applied(name):
                out = out.unionByName(self._messages(name).where(F.col("verdict") == verdict).select("event_id", "verdict"))
        return out.distinct()


def ingest_periods(messages: DataFrame, width_us: int, ingested_at: str = "ingested_at") -> list[int]:
    """Numbers of the periods of ingestion, width_us long each, from the first message's to the last one's."""
    low, high = messages.agg(F.min(F.unix_micros(ingested_at)), F.max(F.unix_micros(ingested_at))).first()
    return [] if low is None else list(range(low // width_us, high // width_us + 1))


def replayed(ledger: EventLedger, messages: DataFrame, width_us: int, ingested_at: str = "ingested_at") -> EventLedger:
    """The ledger after all messages, taken in by period of ingestion, width_us long each; those without a time of ingestion come last."""
    periods = ingest_periods(messages, width_us, ingested_at)
    for n in periods:
        low, high = (F.timestamp_micros(F.lit(b * width_us)) for b in (n, n + 1))
        ledger.apply(messages.where((F.col(ingested_at) >= low) & (F.col(ingested_at) < high)), n)
    ledger.apply(messages.where(F.col(ingested_at).isNull()), periods[-1] + 1 if periods else 0)
    return ledger
