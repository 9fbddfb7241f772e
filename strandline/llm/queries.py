"""Queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import best_record, byte_bpe, packing, subjects
from strandline.operators.feed import instant_us
from strandline.sources.tables import table

SEVERITY_RANGE = (-2.0, 12.0)
SEQUENCE_TOKENS = 1024


def _messages(spark: SparkSession, root: str) -> tuple[DataFrame, list[Column]]:
    """Hazard messages and the order of trust among those of one event."""
    payload = ("severity", "severity_scale", "depth_km", "place", "source_url")
    rows = table(spark, root, "events_normalized").select(
        "source",
        "source_event_id",
        "event_id",
        instant_us("source_version").alias("_version"),
        sum(F.col(f"payload.{c}").isNotNull().cast("int") for c in payload).alias("_filled"),
        "ingested_at",
        *[F.col(f"payload.{c}").alias(c) for c in payload],
        F.col("payload.status").alias("status"),
    )
    return rows, [F.col("_version").desc_nulls_last(), F.col("_filled").desc(), F.col("ingested_at").desc_nulls_last()]


def _severity_ok() -> Column:
    return F.col("severity").between(*SEVERITY_RANGE)


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    rows, order = _messages(spark, root)
    narrow = rows.select("source", "source_event_id", "event_id", "_version", "_filled", "ingested_at", "severity")
    best = best_record.best_records(narrow, ["source", "source_event_id"], "event_id", order, {"severity": _severity_ok()})
    return best.select("source", "source_event_id", "event_id", F.coalesce("severity_event_id", F.lit("")).alias("severity_event_id"))


def p6_records(spark: SparkSession, root: str) -> DataFrame:
    """The surviving record itself, every field from the best message that has it."""
    rows, order = _messages(spark, root)
    fields = {"severity": _severity_ok(), "severity_scale": None, "depth_km": None, "place": None, "source_url": None, "status": None}
    best = best_record.best_records(rows, ["source", "source_event_id"], "event_id", order, fields)
    return best.select("source", "source_event_id", "event_id", *fields)


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", byte_bpe.token_ids(F.col("text")).alias("ids"))


def _sized(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", byte_bpe.token_count(F.col("text")).alias("n_tokens"))


def p9_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(_sized(spark, root), SEQUENCE_TOKENS)


def p9_quality(spark: SparkSession, root: str) -> DataFrame:
    return packing.quality(_sized(spark, root), SEQUENCE_TOKENS)


def _subjects(spark: SparkSession, root: str) -> DataFrame:
    return subjects.document_subjects(table(spark, root, "documents"), table(spark, root, "subjects"))


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return _subjects(spark, root).select("doc_id", "subject").distinct()


def p10_composition(spark: SparkSession, root: str) -> DataFrame:
    """Documents and mean proportion by subject."""
    return _subjects(spark, root).groupBy("subject").agg(F.count("*").alias("documents"), F.round(F.avg("share"), 3).alias("mean_share"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p6_found, p6_records, p8_ids, p9_packing, p9_quality, p10_found, p10_composition)}

_RANKED = """SELECT *, TRY_CAST(source_version AS TIMESTAMPTZ) AS ver, payload.severity AS severity, payload.severity_scale AS severity_scale, payload.depth_km AS depth_km, payload.place AS place, payload.source_url AS source_url, payload.status AS status,
(payload.severity IS NOT NULL)::INT + (payload.severity_scale IS NOT NULL)::INT + (payload.depth_km IS NOT NULL)::INT + (payload.place IS NOT NULL)::INT + (payload.source_url IS NOT NULL)::INT AS filled
FROM events_normalized WHERE source IS NOT NULL AND source_event_id IS NOT NULL AND event_id IS NOT NULL"""
_NUMBERED = f"SELECT *, row_number() OVER (PARTITION BY source, source_event_id ORDER BY ver DESC NULLS LAST, filled DESC, ingested_at DESC NULLS LAST, event_id) AS n FROM ({_RANKED})"
_VALID = "severity BETWEEN -2 AND 12"

ORACLES: dict[str, str] = {
    "p6_found": f"SELECT source, source_event_id, arg_min(event_id, n) AS event_id, coalesce(arg_min(event_id, n) FILTER ({_VALID}), '') AS severity_event_id FROM ({_NUMBERED}) GROUP BY ALL HAVING count(DISTINCT event_id) > 1",
    "p6_records": "SELECT source, source_event_id, arg_min(event_id, n) AS event_id, "
    + ", ".join(f"arg_min({c}, n) FILTER ({_VALID if c == 'severity' else c + ' IS NOT NULL'}) AS {c}" for c in ("severity", "severity_scale", "depth_km", "place", "source_url", "status"))
    + f" FROM ({_NUMBERED}) GROUP BY source, source_event_id HAVING count(DISTINCT event_id) > 1",
}
