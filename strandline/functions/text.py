"""Identifiers, digests, time texts and small scalar rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shown(value: Column) -> Column:
    """The value as text, the word null for a null."""
    return F.coalesce(value.cast("string"), F.lit("null"))


def content_hash(event_time: Column, payload: str = "payload") -> Column:
    """SHA-256 over what an event says, without its version and ids: fields joined by a bar, unescaped."""
    fields = ("latitude", "longitude", "severity", "severity_scale", "depth_km", "place", "source_url", "status")
    parts = [shown(F.unix_millis(event_time)), *[shown(F.col(f"{payload}.{f}")) for f in fields]]
    return F.sha2(F.concat_ws("|", *parts), 256)


def payload_hash(**fields: Column) -> Column:
    """SHA-256 over the fields as JSON in the order of their names, nulls included."""
    ordered = F.struct(*[col.alias(name) for name, col in sorted(fields.items())])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def marker(version: Column, digest: Column) -> Column:
    return F.concat(version, F.lit(":"), digest)


def dedup_key(source: Column, source_event_id: Column) -> Column:
    return F.concat(source, F.lit(":"), source_event_id)


def impact_id(source_event_id: Column, asset_id: Column) -> Column:
    return F.concat(source_event_id, F.lit("::"), asset_id)


def operation_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by a bar; parts must not be null."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def isoformat_utc(ts: Column) -> Column:
    """ISO-8601 with Z; six digits of fraction, or none if it is zero. The session's zone must be UTC."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(whole, F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))), F.lit("Z"))


def epoch_ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def inventory_days_remaining(on_hand: Column, daily_usage: Column) -> Column:
    """Days the stock lasts; infinite if nothing is used."""
    return F.when(daily_usage <= 0, F.lit(float("inf"))).otherwise(on_hand / daily_usage)


def consume_inventory(quantity: Column, daily_usage: Column, tick_s: float, factor: Column) -> Column:
    """Stock after tick_s seconds at factor times the daily usage (none if null), never below zero, to four decimals."""
    return F.round(F.greatest(F.lit(0.0), quantity - F.coalesce(daily_usage, F.lit(0.0)) * (tick_s / 86400) * factor), 4)


def drift_eta(eta: Column, uniform: Column) -> Column:
    """The arrival moved by -30 to +90 minutes, as uniform goes from 0 to 1."""
    return F.timestamp_micros(F.unix_micros(eta) + F.floor((uniform * 120 - 30) * 60_000_000).cast("long"))


def retry_delay(attempt: Column, base: float, most: float) -> Column:
    """Seconds to wait before the attempt after this one (from 1): doubling from base up to most."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(most))


def blank(text: Column) -> Column:
    """True for null, empty and white-space text, tabs and line ends included."""
    return F.coalesce(text.rlike(r"^\s*$"), F.lit(True))


def stable_uuid(namespace: str, name: Column) -> Column:
    """Version 5 UUID of the name within a namespace (a UUID)."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    part = lambda at, size: F.substring(digest, at, size)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))
