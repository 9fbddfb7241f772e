"""Change-feed basics: when a message takes effect, and which messages are changes at all.

A message is (seq, op, ts_ms, image). op c, r and u set the whole row at the instant in updated_at, d removes it at ts_ms.
Messages with another op, without a key or without a readable instant change nothing and are left out by `changes`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPSERTS = ("c", "r", "u")


def instant_us(text: Column | str) -> Column:
    """ISO-8601 text of any form as epoch microseconds; null if it can't be read. Text without an offset is UTC (session zone)."""
    return F.unix_micros(F.col(text).try_cast("timestamp") if isinstance(text, str) else text.try_cast("timestamp"))


def effect_us() -> Column:
    """When the message takes effect, in epoch microseconds; null for messages that change nothing."""
    return F.when(F.col("op") == "d", F.col("ts_ms") * F.lit(1000)).when(F.col("op").isin(*UPSERTS), instant_us("updated_at"))


def changes(feed: DataFrame, key: str, values: Sequence[str] = ()) -> DataFrame:
    """(key, eff, seq, live, *values) of each message that changes something.

    `values` are image columns and must not be called key, eff, seq or live; other columns of the feed, whatever their
    names, are ignored. Repeated messages are kept; an empty feed gives no rows.
    """
    return feed.select(F.col(key).alias("key"), effect_us().alias("eff"), "seq", (F.col("op") != "d").alias("live"), *values).where("key is not null and eff is not null")


def distinct_changes(feed: DataFrame, key: str, values: Sequence[str] = ()) -> DataFrame:
    """One row per key and instant: messages of the same instant are one change, represented by its smallest seq.

    The aggregate combines on the map side, so a key that holds much of the feed costs no more than its distinct instants.
    """
    rows = changes(feed, key, values)
    picked = [F.min_by(F.struct(F.col(v).alias("v")), "seq")["v"].alias(v) for v in ("live", *values)]
    return rows.groupBy("key", "eff").agg(F.min("seq").alias("seq"), *picked)


def current_image(feed: DataFrame, key: str, values: Sequence[str] = ()) -> DataFrame:
    """(key, eff, seq, *values) of each key whose change with the latest effect isn't a delete; the smallest seq on ties."""
    rows = changes(feed, key, values).withColumn("img", F.struct("eff", "seq", "live", *values))
    best = rows.groupBy("key").agg(F.max_by("img", F.struct(F.col("eff"), (-F.col("seq")).alias("s"))).alias("img"))
    return best.where("img.live").select("key", "img.eff", "img.seq", *[f"img.{v}" for v in values])
