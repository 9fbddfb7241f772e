"""Validation and normalization of raw events.

There are two checks with rules of their own: `ingest_reasons` writes sentences and wants a magnitude, `normalize_reasons`
writes codes and allows none. Neither stops at the first problem.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.text import blank, isoformat_utc

#: fixed values: the range of magnitudes and the names written into records
MAGNITUDES = (-2.0, 12.0)
EVENT_TYPE = "earthquake"
RAW_TYPE = "usgs.earthquake.raw"
SCALE = "magnitude_mw"
DETECTOR = "external-event-normalizer"
INGESTION = "ingestion-usgs"
VIOLATION_TYPE = "data_quality.violation"


def _outside(value: Column, low: float, high: float) -> Column:
    return (value < low) | (value > high) | F.isnan(value)


def _reasons(*cases: tuple[Column, Column | str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), why if isinstance(why, Column) else F.lit(why)) for bad, why in cases]))


def ingest_reasons(event_id: Column, latitude: Column, longitude: Column, magnitude: Column, event_time: Column, now: datetime, tolerance_s: int = 300) -> Column:
    """Why a parsed event is bad, as sentences in a fixed order; an empty array for a good one. NaN is out of every range."""
    text = lambda v: v.cast("string")
    limit = F.lit(now) + F.expr(f"INTERVAL {tolerance_s} SECONDS")
    # fixed values: the sentences
    return _reasons(
        (F.coalesce(event_id == "", F.lit(True)), "source_event_id is empty"),
        (_outside(latitude, -90, 90), F.concat(F.lit("latitude "), text(latitude), F.lit(" out of range [-90, 90]"))),
        (_outside(longitude, -180, 180), F.concat(F.lit("longitude "), text(longitude), F.lit(" out of range [-180, 180]"))),
        (magnitude.isNull(), "magnitude is missing"),
        (_outside(magnitude, *MAGNITUDES), F.concat(F.lit("magnitude "), text(magnitude), F.lit(f" out of range [{MAGNITUDES[0]}, {MAGNITUDES[1]}]"))),
        (event_time > limit, F.concat(F.lit("event_time "), isoformat_utc(event_time), F.lit(" is too far in the future"))),
    )


def normalize_reasons(now: datetime, skew_s: int = 3600) -> Column:
    """Codes of what is wrong with a raw envelope, in a fixed order. A missing magnitude is fine; NaN is not compared, hence in
    range; a null position is out of range."""
    lat, lon, mag = F.col("payload.latitude"), F.col("payload.longitude"), F.col("payload.magnitude")
    off = lambda v, low, high: ((v < low) | (v > high)) & ~F.isnan(v)
    # fixed values: the codes
    return _reasons(
        (blank(F.col("source_event_id")), "missing_source_event_id"),
        (lat.isNull() | off(lat, -90, 90), "latitude_out_of_range"),
        (lon.isNull() | off(lon, -180, 180), "longitude_out_of_range"),
        (off(mag, *MAGNITUDES), "magnitude_out_of_range"),
        (F.col("event_time") > F.lit(now) + F.expr(f"INTERVAL {skew_s} SECONDS"), "event_time_in_future"),
    )


def checked(raw: DataFrame, now: datetime, skew_s: int = 3600) -> DataFrame:
    """raw with `reasons`; computed once, so that both outputs can be taken from one pass."""
    return raw.withColumn("reasons", normalize_reasons(now, skew_s))


def normalized(checked_raw: DataFrame, now: datetime) -> DataFrame:
    """Canonical events of the rows without reasons; columns of raw beyond the envelope are passed through."""
    p = F.col("payload")
    payload = F.struct(
        p["latitude"].alias("latitude"), p["longitude"].alias("longitude"), p["magnitude"].alias("severity"), F.when(p["magnitude"].isNotNull(), SCALE).alias("severity_scale"), p["depth_km"].alias("depth_km"), p["place"].alias("place"), p["source_url"].alias("source_url"), F.lit("active").alias("status"),
    )
    good = checked_raw.where(F.size("reasons") == 0).drop("reasons")
    return good.withColumns({"event_type": F.lit(EVENT_TYPE), "event_version": F.lit(1), "normalized_at": F.lit(now), "payload": payload})


def violations(checked_raw: DataFrame, now: datetime) -> DataFrame:
    """Audit envelopes of the rows with reasons; event_id is random."""
    known = F.when(~blank(F.col("source_event_id")), F.col("source_event_id"))
    payload = F.struct(F.col("source").alias("origin_source"), known.alias("source_event_id"), F.col("reasons"), F.to_json(F.struct(*[c for c in checked_raw.columns if c != "reasons"]), {"ignoreNullFields": "false"}).alias("raw"))
    return checked_raw.where(F.size("reasons") > 0).select(
        F.uuid().alias("event_id"), F.lit(VIOLATION_TYPE).alias("event_type"), F.lit(1).alias("event_version"), F.lit(DETECTOR).alias("source"), F.coalesce(known, F.lit("unknown")).alias("source_event_id"), "source_version", F.lit(now).alias("event_time"), "ingested_at", "trace_id", "correlation_id", "tenant_id", payload.alias("payload"),
    )


def raw_envelope(parsed: DataFrame, now: datetime, tenant: str = "demo") -> DataFrame:
    """Raw envelopes of parsed feed events (see ingest.parse_features); ids are random."""
    payload = F.struct(
        "source_event_id", "magnitude", "latitude", "longitude", "depth_km", "place", isoformat_utc(F.col("event_time")).alias("event_time"), isoformat_utc(F.col("updated_time")).alias("updated_time"), "source_url",
    )
    return parsed.select(
        F.uuid().alias("event_id"), F.lit(RAW_TYPE).alias("event_type"), F.lit(1).alias("event_version"), F.lit("usgs").alias("source"), "source_event_id", isoformat_utc(F.col("updated_time")).alias("source_version"), "event_time", F.lit(now).alias("ingested_at"), F.uuid().alias("trace_id"), F.lit(None).cast("string").alias("correlation_id"), F.lit(tenant).alias("tenant_id"), payload.alias("payload"),
    )


def ingest_violations(polled: DataFrame, now: datetime, tenant: str = "demo") -> DataFrame:
    """Audit envelopes of the invalid rows of a poll (see ingest.classified); what couldn't be parsed has no raw text."""
    parsed = F.struct(*sorted(["source_event_id", "magnitude", "latitude", "longitude", "depth_km", "place", "source_url", "event_time", "updated_time"]))
    raw = F.when(F.col("problem").isNull(), F.to_json(parsed, {"ignoreNullFields": "false"}))
    payload = F.struct(F.lit("usgs").alias("origin_source"), "source_event_id", "reasons", raw.alias("raw"))
    return polled.where("outcome = 'invalid'").select(
        F.uuid().alias("event_id"), F.lit(VIOLATION_TYPE).alias("event_type"), F.lit(1).alias("event_version"), F.lit(INGESTION).alias("source"), F.coalesce("source_event_id", F.lit("unknown")).alias("source_event_id"), F.lit(None).cast("string").alias("source_version"), F.lit(now).alias("event_time"), F.lit(now).alias("ingested_at"), F.uuid().alias("trace_id"), F.lit(None).cast("string").alias("correlation_id"), F.lit(tenant).alias("tenant_id"), payload.alias("payload"),
    )


def shipment_reasons(shipments: DataFrame, suppliers: DataFrame | None = None, facilities: DataFrame | None = None) -> DataFrame:
    """shipments with `reasons`: arrival before departure, unknown status, negative value, and - where the tables are given -
    supplier_id or origin_facility_id without a row there. Nulls are not judged."""
    eta, departure = F.col("estimated_arrival_at").try_cast("timestamp"), F.col("planned_departure_at").try_cast("timestamp")
    known = ("created", "in_transit", "customs", "out_for_delivery", "delivered", "cancelled")
    cases = [(eta < departure, "eta_before_departure"), (~F.col("status").isin(*known), "unknown_status"), (F.col("shipment_value") < 0, "negative_value")]
    rows, absent = _with_absent(shipments, (("supplier_id", suppliers, "supplier_id", "unknown_supplier"), ("origin_facility_id", facilities, "facility_id", "unknown_facility")))
    return rows.withColumn("reasons", _reasons(*cases, *absent)).select(*shipments.columns, "reasons")


def inventory_reasons(inventory: DataFrame, warehouses: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """inventory with `reasons`: negative quantity on hand or daily usage, and - where the tables are given - warehouse_id or
    product_id without a row there. Nulls are not judged."""
    cases = [(F.col("quantity_on_hand") < 0, "negative_quantity"), (F.col("average_daily_usage") < 0, "negative_usage")]
    rows, absent = _with_absent(inventory, (("warehouse_id", warehouses, "warehouse_id", "unknown_warehouse"), ("product_id", products, "product_id", "unknown_product")))
    return rows.withColumn("reasons", _reasons(*cases, *absent)).select(*inventory.columns, "reasons")


def _with_absent(rows: DataFrame, parents: Sequence[tuple[str, DataFrame | None, str, str]]) -> tuple[DataFrame, list[tuple[Column, str]]]:
    """rows with a mark per parent table given (column, table, key, reason), and the cases of rows whose key isn't there."""
    cases = []
    for n, (column, table, key, reason) in enumerate(parents):
        if table is not None:
            rows = rows.join(table.select(F.col(key).alias(column)).distinct().withColumn(f"_there{n}", F.lit(True)), column, "left")
            cases.append((F.col(column).isNotNull() & F.col(f"_there{n}").isNull(), reason))
    return rows, cases
