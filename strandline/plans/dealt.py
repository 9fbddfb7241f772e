"""Queries on the change feeds, hazard messages and impact candidates: references, lateness, proximity, history, state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import asof, changefeed, feed, history, late_events, proximity, references
from strandline.operators.sliced import DAY_US
from strandline.session import scratch_path
from strandline.sources.tables import table

KEYS = {"suppliers_cdc": "supplier_id", "facilities_cdc": "facility_id", "purchase_orders_cdc": "purchase_order_id", "shipments_cdc": "shipment_id"}
REFERENCES = (
    references.Reference("shipments_cdc", "origin_facility_id", "facilities_cdc"),
    references.Reference("shipments_cdc", "supplier_id", "suppliers_cdc"),
    references.Reference("shipments_cdc", "purchase_order_id", "purchase_orders_cdc"),
    references.Reference("facilities_cdc", "supplier_id", "suppliers_cdc"),
)
NEAR_KM = 5.0


def _orphans(spark: SparkSession, root: str) -> DataFrame:
    return references.orphan_references({n: table(spark, root, n) for n in KEYS}, KEYS, REFERENCES)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return _orphans(spark, root).select("table_name", "field", "seq", "kind")


def p1_report(spark: SparkSession, root: str) -> DataFrame:
    return references.orphan_report(_orphans(spark, root))


#: Messages are taken into the ledger by four weeks of ingestion.
BATCH_US = 28 * DAY_US


def _ledger(spark: SparkSession, root: str) -> late_events.EventLedger:
    messages = table(spark, root, "events_normalized").select("event_id", "event_type", "event_time", "ingested_at", F.struct("payload.severity").alias("payload"))
    return late_events.replayed(late_events.EventLedger(spark, scratch_path(spark, "events")), messages, BATCH_US)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return _ledger(spark, root).late()


def p2_daily(spark: SparkSession, root: str) -> DataFrame:
    """The figures of every day after all batches."""
    return _ledger(spark, root).figures().select("period", "event_type", "n_messages", "n_severity", "sum_severity", "max_severity")


def p2_revisions(spark: SparkSession, root: str) -> DataFrame:
    """The figures of every day after each daily batch that touched it."""
    return late_events.daily_revisions(table(spark, root, "events_normalized"))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    epicentres = table(spark, root, "impact_candidates").where("event_id is not null").select(F.col("event_id").alias("left_id"), F.col("event_latitude").alias("lat"), F.col("event_longitude").alias("lon"))
    live = feed.current_image(table(spark, root, "facilities_cdc"), "facility_id", ["latitude", "longitude"])
    facilities = live.select(F.col("key").alias("right_id"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    near = proximity.near_pairs(epicentres, facilities, NEAR_KM)
    return near.select(F.col("left_id").alias("event_id"), F.col("right_id").alias("facility_id"))


#: Half widths in degrees of the region around an epicentre and of the hole in its middle.
REGION_DEG, HOLE_DEG = 0.08, 0.03


def _rings(lat: str) -> Column:
    """A diamond around a latitude with a diamond-shaped hole, longitudes relative to its middle."""

    def ring(r: float) -> list[Column]:
        at = [(F.lit(x * r), F.col(lat) + y * r) for x, y in ((1.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (0.0, -1.0))]
        return [F.struct(a[0].alias("x0"), a[1].alias("y0"), b[0].alias("x1"), b[1].alias("y1")) for a, b in zip(at, at[1:] + at[:1], strict=True)]

    return F.array(*ring(REGION_DEG), *ring(HOLE_DEG))


def p3_regions(spark: SparkSession, root: str) -> DataFrame:
    """The facilities in the region around each epicentre but not in its hole; regions may lie across the antimeridian."""
    at = table(spark, root, "impact_candidates").select(F.col("event_latitude").alias("lat"), F.col("event_longitude").alias("rlon")).distinct()
    regions = at.select(F.struct("lat", "rlon").alias("rid"), "rlon", _rings("lat").alias("edges"))
    live = feed.current_image(table(spark, root, "facilities_cdc"), "facility_id", ["latitude", "longitude"])
    found = proximity.points_in_regions(live.select(F.col("key").alias("pid"), F.col("latitude").alias("plat"), F.col("longitude").alias("plon")), regions)
    return found.select(F.col("rid.lat").alias("event_latitude"), F.col("rid.rlon").alias("event_longitude"), F.col("pid").alias("facility_id"))


def _attributes(spark: SparkSession, root: str) -> list[tuple[DataFrame, str, str, str]]:
    return [(table(spark, root, n), n, KEYS[n], a) for n, a in (("facilities_cdc", "status"), ("suppliers_cdc", "criticality_score"))]


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return history.attribute_history(_attributes(spark, root)).select("table_name", "entity_id", "valid_from_us", "valid_to_us")


def p4_ledger(spark: SparkSession, root: str) -> DataFrame:
    rows = [history.attribute_changes(*x) for x in _attributes(spark, root)]
    return history.bitemporal_ledger(rows[0].unionByName(rows[1]))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    out = None
    for name in ("facilities_cdc", "shipments_cdc"):
        rows = changefeed.current_rows(table(spark, root, name), KEYS[name])
        one = rows.select(F.lit(name).alias("table_name"), F.col("key").alias("entity_id"), "seq")
        out = one if out is None else out.unionByName(one)
    return out


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "impact_candidates").where("event_id is not null").select(F.col("event_id").alias("id"), F.col("asset_id").alias("entity"), F.unix_micros("event_time").alias("t")).distinct()
    versions = feed.distinct_changes(table(spark, root, "facilities_cdc"), "facility_id").withColumnRenamed("key", "entity")
    known = asof.asof_versions(events, versions).where("live")
    return known.select(F.col("id").alias("event_id"), F.col("entity").alias("asset_id"), "seq")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_report, p2_found, p2_daily, p2_revisions, p3_found, p3_regions, p4_found, p4_ledger, p5_found, p7_found)}


_CHANGES = {
    n: f"""SELECT {k} AS k, seq, op <> 'd' AS live, {{cols}} CASE WHEN op = 'd' THEN ts_ms * 1000 ELSE epoch_us(TRY_CAST(updated_at AS TIMESTAMPTZ)) END AS eff
FROM {n} WHERE op IN ('c', 'r', 'u', 'd') AND {k} IS NOT NULL"""
    for n, k in KEYS.items()
}


def _orphan_sql() -> str:
    refs = " UNION ALL ".join(
        f"SELECT '{r.table_name}' AS table_name, '{r.field}' AS field, '{r.parent}' AS parent, {r.field} AS k, seq, ts_ms * 1000 AS captured FROM {r.table_name} WHERE op IN ('c', 'r', 'u') AND {r.field} IS NOT NULL" for r in REFERENCES
    )
    parents = " UNION ALL ".join(f"SELECT '{n}' AS parent, k, live, eff FROM ({_CHANGES[n].format(cols='')}) WHERE eff IS NOT NULL" for n in ("facilities_cdc", "suppliers_cdc", "purchase_orders_cdc"))
    return f"""WITH refs AS ({refs}), ch AS (SELECT DISTINCT * FROM ({parents})),
known AS (SELECT parent, k, bool_or(live) AS ever, min(eff) AS first_eff FROM ch GROUP BY ALL),
found AS (SELECT r.*, ch.live FROM refs r ASOF LEFT JOIN ch ON r.parent = ch.parent AND r.k = ch.k AND r.captured >= ch.eff)
SELECT table_name, field, seq, captured, CASE WHEN NOT coalesce(ever, false) THEN 'missing' WHEN first_eff > captured THEN 'late' ELSE 'deleted' END AS kind
FROM found LEFT JOIN known USING (parent, k) WHERE NOT coalesce(found.live, false)"""


def _history_sql(name: str, attribute: str) -> str:
    return f"""SELECT '{name}' AS table_name, * FROM (
WITH c AS (SELECT k, eff, bool_or(live) AS live, arg_min(struct_pack(x := v), seq).x AS v FROM ({_CHANGES[name].format(cols=f'{attribute} AS v,')}) WHERE eff IS NOT NULL GROUP BY k, eff),
p AS (SELECT *, lag(live) OVER w AS pl, lag(v) OVER w AS pv FROM c WINDOW w AS (PARTITION BY k ORDER BY eff)),
t AS (SELECT * FROM p WHERE live IS DISTINCT FROM pl OR (live AND v IS DISTINCT FROM pv)),
e AS (SELECT k, eff, live, coalesce(lead(eff) OVER (PARTITION BY k ORDER BY eff), -1) AS till FROM t)
SELECT k AS entity_id, eff AS valid_from_us, till AS valid_to_us FROM e WHERE live)"""


def _ledger_sql(name: str, attribute: str) -> str:
    """A change ends, when it arrives, at the nearest later effect that arrived before; each nearer one that arrives cuts it again."""
    return f"""SELECT '{name}' AS table_name, * FROM (
WITH c AS (SELECT k, eff, min(seq) AS s, bool_or(live) AS live, arg_min(struct_pack(x := v), seq).x AS v FROM ({_CHANGES[name].format(cols=f'{attribute} AS v,')}) WHERE eff IS NOT NULL GROUP BY k, eff),
p AS (SELECT i.k, i.eff, i.s, j.eff AS je, j.s AS js, min(j.eff) OVER (PARTITION BY i.k, i.eff ORDER BY j.s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS near FROM c i JOIN c j ON i.k = j.k AND j.eff > i.eff),
b AS (SELECT c.k, c.eff, c.s AS rf, coalesce(min(je) FILTER (js < c.s), -1) AS vt FROM c LEFT JOIN p ON p.k = c.k AND p.eff = c.eff GROUP BY ALL UNION ALL SELECT k, eff, js, je FROM p WHERE js > s AND (near IS NULL OR je < near))
SELECT b.k AS key, CASE WHEN live THEN CAST(v AS VARCHAR) END AS value, live, b.eff AS valid_from, vt AS valid_to, rf AS recorded_from, coalesce(lead(rf) OVER (PARTITION BY b.k, b.eff ORDER BY rf), -1) AS recorded_to FROM b JOIN c ON c.k = b.k AND c.eff = b.eff)"""


def _state_sql(name: str) -> str:
    return f"""SELECT '{name}' AS table_name, k AS entity_id, seq FROM (
SELECT *, row_number() OVER (PARTITION BY k ORDER BY eff DESC, seq) AS n FROM ({_CHANGES[name].format(cols='')}) WHERE eff IS NOT NULL) WHERE n = 1 AND live"""


_ROUTED = """SELECT *, epoch_us(event_time) // 86400000000 AS period, epoch_us(ingested_at) - (epoch_us(event_time) // 86400000000 + 1) * 86400000000 AS behind FROM events_normalized"""

ORACLES: dict[str, str] = {
    "p1_found": f"SELECT table_name, field, seq, kind FROM ({_orphan_sql()})",
    "p1_report": f"SELECT table_name, field, kind, captured // 86400000000 * 86400000000 AS period_start_us, count(*) AS orphans FROM ({_orphan_sql()}) GROUP BY ALL",
    "p2_found": f"SELECT DISTINCT event_id, CASE WHEN behind <= 172800000000 THEN 'late' ELSE 'too_late' END AS verdict FROM ({_ROUTED}) WHERE behind > 300000000",
    "p2_daily": f"""SELECT period, event_type, count(*) AS n_messages, count(s) AS n_severity, round(sum(s), 6) AS sum_severity, max(s) AS max_severity FROM (
SELECT period, event_type, event_id, max(payload.severity) FILTER (NOT isnan(payload.severity)) AS s FROM ({_ROUTED}) WHERE behind <= 172800000000 GROUP BY ALL) GROUP BY ALL""",
    "p2_revisions": f"""WITH m AS (SELECT period, event_type, event_id, min(greatest(epoch_us(ingested_at) // 86400000000, period)) AS b, any_value(payload.severity) AS s FROM ({_ROUTED}) WHERE behind <= 172800000000 GROUP BY ALL),
t AS (SELECT DISTINCT period, b AS batch FROM m)
SELECT m.period, event_type, batch, count(*) AS n_messages, count(s) AS n_severity, round(sum(s), 6) AS sum_severity, max(s) AS max_severity FROM m JOIN t ON m.period = t.period AND batch >= b GROUP BY ALL""",
    "p3_found": f"""WITH f AS (SELECT k AS facility_id, latitude AS la, longitude AS lo FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY eff DESC, seq) AS n FROM ({_CHANGES['facilities_cdc'].format(cols='latitude, longitude,')}) WHERE eff IS NOT NULL) WHERE n = 1 AND live AND abs(latitude) <= 90 AND abs(longitude) <= 180),
e AS (SELECT DISTINCT event_id, event_latitude AS ea, event_longitude AS eo FROM impact_candidates WHERE event_id IS NOT NULL AND abs(event_latitude) <= 90 AND abs(event_longitude) <= 180),
c AS (SELECT *, cos(radians(la)) * cos(radians(lo)) AS x, cos(radians(la)) * sin(radians(lo)) AS y, sin(radians(la)) AS z FROM f),
q AS (SELECT *, cos(radians(ea)) * cos(radians(eo)) AS u, cos(radians(ea)) * sin(radians(eo)) AS v, sin(radians(ea)) AS w FROM e)
SELECT DISTINCT event_id, facility_id FROM q JOIN c ON la BETWEEN ea - 0.05 AND ea + 0.05 AND 2 * 6371.0088 * asin(least(1, sqrt((x - u) ** 2 + (y - v) ** 2 + (z - w) ** 2) / 2)) <= {NEAR_KM}""",
    "p3_regions": f"""WITH f AS (SELECT k AS facility_id, latitude AS la, longitude AS lo FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY eff DESC, seq) AS n FROM ({_CHANGES['facilities_cdc'].format(cols='latitude, longitude,')}) WHERE eff IS NOT NULL) WHERE n = 1 AND live AND abs(latitude) <= 90 AND abs(longitude) <= 180),
e AS (SELECT DISTINCT event_latitude, event_longitude FROM impact_candidates WHERE event_latitude IS NOT NULL AND event_longitude IS NOT NULL),
j AS (SELECT *, abs(la - event_latitude) + least(abs(lo - event_longitude), 360 - abs(lo - event_longitude)) AS d FROM e JOIN f ON la BETWEEN event_latitude - {REGION_DEG} AND event_latitude + {REGION_DEG})
SELECT event_latitude, event_longitude, facility_id FROM j WHERE d <= {REGION_DEG} AND d >= {HOLE_DEG}""",
    "p4_found": _history_sql("facilities_cdc", "status") + " UNION ALL " + _history_sql("suppliers_cdc", "criticality_score"),
    "p4_ledger": _ledger_sql("facilities_cdc", "status") + " UNION ALL " + _ledger_sql("suppliers_cdc", "criticality_score"),
    "p5_found": _state_sql("facilities_cdc") + " UNION ALL " + _state_sql("shipments_cdc"),
    "p7_found": f"""WITH c AS (SELECT k, eff, min(seq) AS seq, bool_or(live) AS live FROM ({_CHANGES['facilities_cdc'].format(cols='')}) WHERE eff IS NOT NULL GROUP BY k, eff),
e AS (SELECT DISTINCT event_id, asset_id, epoch_us(event_time) AS t FROM impact_candidates WHERE event_id IS NOT NULL)
SELECT e.event_id, e.asset_id, c.seq FROM e ASOF JOIN c ON e.asset_id = c.k AND e.t >= c.eff WHERE c.live""",
}
