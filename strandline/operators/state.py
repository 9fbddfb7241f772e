"""Current state from change messages in order of arrival, and its form as an upsert log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unwrapped(messages: DataFrame, image: T.StructType, key: Sequence[str]) -> DataFrame:
    """(*key, deleted, after, ts_ms, seq) of change messages (value: JSON with before, after, op, ts_ms; seq).

    c, r and u upsert `after`; d deletes the key of `before`; a null value changes nothing. Malformed JSON fails the query.
    """
    envelope = T.StructType([T.StructField("before", image), T.StructField("after", image), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])
    parsed = messages.where("value is not null").select(F.from_json("value", envelope, {"mode": "FAILFAST"}).alias("m"), "seq").select("m.*", "seq")
    known = parsed.where(F.col("op").isin("c", "r", "u", "d"))
    return known.select(*[F.coalesce(f"after.{k}", f"before.{k}").alias(k) for k in key], (F.col("op") == "d").alias("deleted"), F.when(F.col("op") != "d", F.col("after")).alias("after"), "ts_ms", "seq")


def latest(changes: DataFrame, key: Sequence[str], order: str = "seq") -> DataFrame:
    """The last change of every key in order of arrival, deletes included; map-side combined, hot keys cost one row a task."""
    known = changes.dropna(subset=list(key))
    return known.groupBy(*key).agg(F.max_by(F.struct(*[c for c in changes.columns if c not in key]), F.col(order)).alias("_last")).select(*key, "_last.*")


def current_state(changes: DataFrame, key: Sequence[str], order: str = "seq") -> DataFrame:
    """The rows that hold after all changes (deleted: boolean)."""
    return latest(changes, key, order).where("not deleted").drop("deleted")


def tombstones(changes: DataFrame, key: Sequence[str], order: str = "seq") -> DataFrame:
    """The keys whose last change is a delete."""
    return latest(changes, key, order).where("deleted").select(*key)


def upsert_log(changes: DataFrame, key: Sequence[str], order: str = "seq") -> DataFrame:
    """(key, value): JSON of the key, and JSON of the row with its nulls, or null for a deleted key."""
    rows = latest(changes, key, order)
    value = F.struct(*[c for c in rows.columns if c not in ("deleted", order)])
    plain = {"ignoreNullFields": "false"}
    return rows.select(F.to_json(F.struct(*key)).alias("key"), F.when(~F.col("deleted"), F.to_json(value, plain)).alias("value"))


def merged(state: DataFrame | None, batch: DataFrame, key: Sequence[str], order: str = "seq") -> DataFrame:
    """The latest change of every key over an earlier result of `latest` and a new batch."""
    return latest(batch if state is None else state.unionByName(batch), key, order)
