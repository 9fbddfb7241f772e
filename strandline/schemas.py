"""Schemas of the logs and tables, declared up front, and the rule by which they may evolve."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I, _B, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


def _envelope(payload: T.StructType, *extra: tuple[str, T.DataType, bool]) -> T.StructType:
    return _struct(
        ("event_id", _S, False), ("event_type", _S, False), ("event_version", _I, False), ("source", _S, False), ("source_event_id", _S, False), ("source_version", _S, True),
        ("event_time", _TS, False), ("ingested_at", _TS, False), *extra, ("trace_id", _S, False), ("correlation_id", _S, True), ("tenant_id", _S, False), ("payload", payload, False),
    )


RAW_PAYLOAD = _struct(
    ("source_event_id", _S, False), ("magnitude", _D, True), ("latitude", _D, False), ("longitude", _D, False), ("depth_km", _D, True), ("place", _S, True), ("event_time", _S, False), ("updated_time", _S, False), ("source_url", _S, True),
)
EVENT_PAYLOAD = _struct(
    ("latitude", _D, False), ("longitude", _D, False), ("severity", _D, True), ("severity_scale", _S, True), ("depth_km", _D, True), ("place", _S, True), ("source_url", _S, True), ("status", _S, False),
)
VIOLATION_PAYLOAD = _struct(("origin_source", _S, False), ("source_event_id", _S, True), ("reasons", T.ArrayType(_S), False), ("raw", _S, True))

SUPPLIERS = _struct(*[(c, _S, True) for c in ("supplier_id", "supplier_name", "normalized_name", "country_code")], ("supplier_tier", _I, True), ("criticality_score", _D, True), *[(c, _S, True) for c in ("status", "created_at", "updated_at")])
FACILITIES = _struct(
    *[(c, _S, True) for c in ("facility_id", "supplier_id", "facility_name", "facility_type")], ("latitude", _D, True), ("longitude", _D, True), *[(c, _S, True) for c in ("h3_index", "country_code")], ("capacity_score", _D, True), *[(c, _S, True) for c in ("status", "created_at", "updated_at")],
)
SHIPMENTS = _struct(
    *[(c, _S, True) for c in ("shipment_id", "purchase_order_id", "supplier_id", "origin_facility_id", "destination_warehouse_id", "status", "transport_mode", "planned_departure_at", "planned_arrival_at", "estimated_arrival_at", "actual_arrival_at")], ("shipment_value", _D, True), ("updated_at", _S, True),
)
INVENTORY = _struct(("warehouse_id", _S, True), ("product_id", _S, True), ("quantity_on_hand", _D, True), ("average_daily_usage", _D, True), ("safety_stock", _D, True), ("updated_at", _S, True))
PURCHASE_ORDERS = _struct(
    *[(c, _S, True) for c in ("purchase_order_id", "supplier_id", "product_id")], ("quantity", _D, True), ("unit_price", _D, True), ("status", _S, True), ("required_by_date", _I, True), ("created_at", _S, True), ("updated_at", _S, True),
)
IMPACT = _struct(
    *[(c, _S, False) for c in ("impact_id", "event_id", "source", "source_event_id", "event_type")], ("event_time", _TS, False), ("asset_type", _S, False), ("asset_id", _S, False), ("supplier_id", _S, True),
    *[(c, _D, False) for c in ("event_latitude", "event_longitude", "asset_latitude", "asset_longitude", "distance_km", "radius_km")], ("inside_affected_area", _B, False), ("severity", _D, True), ("geospatial_score", _D, False),
    ("trace_id", _S, False), ("tenant_id", _S, False), ("calculated_at", _TS, False),
)

#: The current-state tables and their keys.
OPERATIONAL = {
    "suppliers": (SUPPLIERS, ("supplier_id",)),
    "facilities": (FACILITIES, ("facility_id",)),
    "shipments": (SHIPMENTS, ("shipment_id",)),
    "inventory": (INVENTORY, ("warehouse_id", "product_id")),
    "purchase_orders": (PURCHASE_ORDERS, ("purchase_order_id",)),
}
TOPICS = {
    "ext.usgs.raw.v1": _envelope(RAW_PAYLOAD),
    "events.normalized.v1": _envelope(EVENT_PAYLOAD, ("normalized_at", _TS, False)),
    "events.deduplicated.v1": _envelope(EVENT_PAYLOAD, ("normalized_at", _TS, False)),
    "audit.data_quality.v1": _envelope(VIOLATION_PAYLOAD),
    "risk.impact_candidates.v1": IMPACT,
}


def topic_schema(topic: str) -> T.StructType:
    """The schema of a topic's values; KeyError for a topic that isn't declared."""
    if topic not in TOPICS:
        raise KeyError(f"no schema is declared for topic {topic!r}")
    return TOPICS[topic]


def backward_compatible(old: T.DataType, new: T.DataType) -> list[str]:
    """Why records written with old can't be read with new; empty if they can. Fields may be added if they are nullable;
    none may be removed, renamed, retyped or made required."""
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return backward_compatible(old.elementType, new.elementType)
    if not (isinstance(old, T.StructType) and isinstance(new, T.StructType)):
        return [] if type(old) is type(new) else [f"type changed from {old.simpleString()} to {new.simpleString()}"]
    before, after = {f.name: f for f in old}, {f.name: f for f in new}
    out = [f"{n} was removed" for n in before if n not in after]
    out += [f"{n} was added but is required" for n, f in after.items() if n not in before and not f.nullable]
    for n in before.keys() & after.keys():
        if before[n].nullable and not after[n].nullable:
            out.append(f"{n} became required")
        out += [f"{n}: {why}" for why in backward_compatible(before[n].dataType, after[n].dataType)]
    return sorted(out)
