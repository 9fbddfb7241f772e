"""Queries of the event pipeline, current state, operational context and retrieval, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import geo, text
from strandline.operators import correlate, dedup, features, feed, ingest, quality, retrieval, state
from strandline.plans import views
from strandline.plans.dealt import KEYS
from strandline.plans.views import FACILITY_SQL, INVENTORY_SQL, NOW, NOW_SQL, RAW_SQL, UPDATES_SQL, polled_sql
from strandline.session import stored
from strandline.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


HAVERSINE = "2 * 6371.0088 * atan2(sqrt({a}), sqrt(greatest(0, 1 - {a})))"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"(sin(radians({lat2} - {lat1}) / 2) ** 2 + cos(radians({lat1})) * cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) ** 2)"
    return HAVERSINE.format(a=a)


RADIUS = "CASE WHEN {t} <> 'earthquake' OR isnan({s}) THEN NULL WHEN {s} >= 7 THEN 250.0 WHEN {s} >= 6 THEN 120.0 WHEN {s} >= 5 THEN 50.0 END"
REASONS = f"""chk AS (SELECT *, concat_ws(',', CASE WHEN trim(source_event_id) = '' THEN 'missing_source_event_id' END, CASE WHEN latitude IS NULL OR abs(latitude) > 90 THEN 'latitude_out_of_range' END, CASE WHEN longitude IS NULL OR abs(longitude) > 180 THEN 'longitude_out_of_range' END,
CASE WHEN magnitude < -2 OR magnitude > 12 THEN 'magnitude_out_of_range' END, CASE WHEN event_time > {NOW_SQL} + INTERVAL 1 HOUR THEN 'event_time_in_future' END) AS reasons FROM raw),
norm AS (SELECT * FROM chk WHERE reasons = '')"""
PREVIOUS = """prev AS (SELECT *, lag(h) OVER w AS before, lag(event_time) OVER w AS before_time FROM (SELECT *, concat_ws('|', epoch_ms(event_time), latitude, longitude, coalesce(CAST(magnitude AS VARCHAR), 'null'), coalesce(CAST(depth_km AS VARCHAR), 'null')) AS h FROM norm) WINDOW w AS (PARTITION BY source_event_id ORDER BY seq))"""
DECISION = "CASE WHEN before IS NULL THEN 'NEW' WHEN before = h THEN 'DROP' ELSE 'UPDATE' END"
TTL_S = 5 * 86400
PIPE = f"WITH {RAW_SQL}, {REASONS}, {PREVIOUS}, {FACILITY_SQL}"
EMITTED = f"emitted AS (SELECT *, {RADIUS.format(t=chr(39) + 'earthquake' + chr(39), s='magnitude')} AS radius_km FROM prev WHERE {DECISION} <> 'DROP')"
IMPACTS = f"SELECT e.source_event_id || '::' || f.facility_id AS impact_id, e.seq, round({haversine_sql('e.latitude', 'e.longitude', 'f.latitude', 'f.longitude')}, 6) AS distance_km, e.radius_km FROM emitted e JOIN {{fac}} f ON e.radius_km IS NOT NULL AND {haversine_sql('e.latitude', 'e.longitude', 'f.latitude', 'f.longitude')} <= e.radius_km"


# --- scalar rules -------------------------------------------------------------------------------------------------------------


@query(f"SELECT DISTINCT event_id, asset_id, round({haversine_sql('event_latitude', 'event_longitude', 'asset_latitude', 'asset_longitude')}, 6) AS distance_km FROM impact_candidates")
def haversine_km(spark, root):
    i = table(spark, root, "impact_candidates")
    d = geo.haversine_km(F.col("event_latitude"), F.col("event_longitude"), F.col("asset_latitude"), F.col("asset_longitude"))
    return i.select("event_id", "asset_id", F.round(d, 6).alias("distance_km")).distinct()


@query(f"SELECT DISTINCT event_id, {RADIUS.format(t='event_type', s='payload.severity')} AS radius_km FROM events_normalized")
def impact_radius_km(spark, root):
    return table(spark, root, "events_normalized").select("event_id", geo.impact_radius_km(F.col("event_type"), F.col("payload.severity")).alias("radius_km")).distinct()


@query("SELECT impact_id, event_id, round(CASE WHEN radius_km <= 0 THEN 0 ELSE greatest(0, least(1, 1 - distance_km / radius_km)) END, 9) AS score FROM impact_candidates")
def geo_score(spark, root):
    return table(spark, root, "impact_candidates").select("impact_id", "event_id", F.round(geo.geo_score(F.col("distance_km"), F.col("radius_km")), 9).alias("score"))


@query("SELECT source_event_id || '::' || asset_id AS impact_id, count(*) AS n FROM impact_candidates GROUP BY 1")
def impact_id(spark, root):
    return table(spark, root, "impact_candidates").groupBy(text.impact_id(F.col("source_event_id"), F.col("asset_id")).alias("impact_id")).agg(F.count("*").alias("n"))


@query("SELECT event_id, sha256(concat_ws('|', event_id, source, tenant_id)) AS operation_id FROM events_normalized")
def operation_id(spark, root):
    return table(spark, root, "events_normalized").select("event_id", text.operation_id(F.col("event_id"), F.col("source"), F.col("tenant_id")).alias("operation_id"))


@query("SELECT source || ':' || source_event_id AS dedup_key, count(*) AS n FROM events_normalized GROUP BY 1")
def dedup_key(spark, root):
    return table(spark, root, "events_normalized").groupBy(text.dedup_key(F.col("source"), F.col("source_event_id")).alias("dedup_key")).agg(F.count("*").alias("n"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') END || 'Z' AS iso FROM events")
def isoformat_utc(spark, root):
    return table(spark, root, "events").select("event_id", text.isoformat_utc(F.col("ts")).alias("iso"))


@query("SELECT seq, ts_ms * 1000 AS captured_us FROM facilities_cdc WHERE ts_ms IS NOT NULL")
def epoch_ms_to_ts(spark, root):
    return table(spark, root, "facilities_cdc").where("ts_ms is not null").select("seq", F.unix_micros(text.epoch_ms_to_ts(F.col("ts_ms"))).alias("captured_us"))


@query(f"WITH {INVENTORY_SQL} SELECT product_id, round(CASE WHEN average_daily_usage <= 0 THEN 'inf'::DOUBLE ELSE quantity_on_hand / average_daily_usage END, 6) AS days FROM inv")
def inventory_days_remaining(spark, root):
    return views.inventory(spark, root).select("product_id", F.round(text.inventory_days_remaining(F.col("quantity_on_hand"), F.col("average_daily_usage")), 6).alias("days"))


@query(f"WITH {INVENTORY_SQL} SELECT product_id, round(greatest(0, quantity_on_hand - coalesce(average_daily_usage, 0) * (3701e0 / 86400) * (0.6 + (product_id % 9 + 1) / 13e0)), 4) AS quantity FROM inv")
def consume_inventory(spark, root):
    factor = 0.6 + (F.col("product_id") % 9 + 1) / F.lit(13.0)
    return views.inventory(spark, root).select("product_id", text.consume_inventory(F.col("quantity_on_hand"), F.col("average_daily_usage"), 3701, factor).alias("quantity"))


@query("SELECT o_orderkey, epoch_us(o_orderdate) + CAST(floor(((o_orderkey % 100) / 100e0 * 120 - 30) * 60000000) AS BIGINT) AS eta_us FROM orders")
def drift_eta(spark, root):
    return table(spark, root, "orders").select("o_orderkey", F.unix_micros(text.drift_eta(F.col("o_orderdate"), F.col("o_orderkey") % 100 / F.lit(100.0))).alias("eta_us"))


@query("SELECT l_linenumber AS attempt, least(2e0 * pow(2, l_linenumber - 1), 60) AS delay_s, count(*) AS n FROM lineitem GROUP BY ALL")
def retry_delay(spark, root):
    return table(spark, root, "lineitem").groupBy(F.col("l_linenumber").alias("attempt")).agg(F.count("*").alias("n")).withColumn("delay_s", text.retry_delay(F.col("attempt"), 2.0, 60.0))


# --- raw to normalized --------------------------------------------------------------------------------------------------------


@query(f"WITH {RAW_SQL}, {REASONS} SELECT seq, reasons FROM chk")
def dq_normalize(spark, root):
    return quality.checked(views.raw_events(spark, root), NOW).select("seq", F.concat_ws(",", "reasons").alias("reasons"))


@query(f"WITH {RAW_SQL}, {REASONS} SELECT seq, source_event_id, 'earthquake' AS event_type, magnitude AS severity, CASE WHEN magnitude IS NOT NULL THEN 'magnitude_mw' END AS severity_scale, depth_km, latitude, longitude, 'active' AS status FROM norm")
def normalize(spark, root):
    n = quality.normalized(quality.checked(views.raw_events(spark, root), NOW), NOW)
    return n.select("seq", "source_event_id", "event_type", *[f"payload.{c}" for c in ("severity", "severity_scale", "depth_km", "latitude", "longitude", "status")])


@query(f"WITH {RAW_SQL}, {REASONS} SELECT source_event_id, 'data_quality.violation' AS event_type, 'external-event-normalizer' AS source, 'drv' AS origin_source, reasons, count(*) AS n FROM chk WHERE reasons <> '' GROUP BY ALL")
def dq_violation(spark, root):
    v = quality.violations(quality.checked(views.raw_events(spark, root), NOW), NOW)
    return v.groupBy("source_event_id", "event_type", "source", "payload.origin_source", F.concat_ws(",", "payload.reasons").alias("reasons")).agg(F.count("*").alias("n"))


@query(f"""WITH {RAW_SQL} SELECT seq, concat_ws('; ', CASE WHEN abs(latitude) > 90 THEN 'latitude ' || round(latitude, 2) || ' out of range [-90, 90]' END, CASE WHEN magnitude IS NULL THEN 'magnitude is missing' END,
CASE WHEN magnitude < -2 OR magnitude > 12 THEN 'magnitude ' || magnitude || ' out of range [-2.0, 12.0]' END, CASE WHEN event_time > {NOW_SQL} + INTERVAL 300 SECONDS THEN 'event_time ' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(epoch_us(event_time) % 1000000 AS VARCHAR), 6, '0') END || 'Z is too far in the future' END) AS reasons FROM raw""")
def dq_ingest(spark, root):
    r = views.raw_events(spark, root)
    why = quality.ingest_reasons(F.col("source_event_id"), F.round("payload.latitude", 2), F.col("payload.longitude"), F.col("payload.magnitude"), F.col("event_time"), NOW)
    return r.select("seq", F.concat_ws("; ", why).alias("reasons"))


def _normalized(spark, root):
    return quality.normalized(quality.checked(views.raw_events(spark, root), NOW), NOW)


@query(f"{PIPE} SELECT seq FROM prev WHERE {DECISION} <> 'DROP'")
def dedup_content(spark, root):
    return dedup.deduplicated(_normalized(spark, root)).select("seq")


@query(f"{PIPE} SELECT seq, source_event_id, {DECISION} AS decision FROM prev")
def dedup_decision(spark, root):
    return dedup.decisions(_normalized(spark, root)).select("seq", "source_event_id", "decision")


@query(f"{PIPE} SELECT {DECISION} AS decision, count(*) AS n FROM prev GROUP BY 1")
def dedup_counts(spark, root):
    return dedup.decisions(_normalized(spark, root)).groupBy("decision").agg(F.count("*").alias("n"))


@query(f"{PIPE} SELECT seq, CASE WHEN before IS NULL OR epoch_us(event_time) - epoch_us(before_time) >= {TTL_S}000000 THEN 'NEW' WHEN before = h THEN 'DROP' ELSE 'UPDATE' END AS decision FROM prev")
def dedup_ttl(spark, root):
    return dedup.decisions(_normalized(spark, root), arrival="event_time", ttl_s=TTL_S).select("seq", "decision")


# --- impacts ------------------------------------------------------------------------------------------------------------------


def impacts_of(spark, root):
    """The whole pipeline: raw, normalized, deduplicated, correlated."""
    return correlate.correlate(dedup.deduplicated(_normalized(spark, root)), views.facilities(spark, root), NOW)


@query(f"{PIPE}, {EMITTED} {IMPACTS.format(fac='fac')}")
def geo_correlate(spark, root):
    return impacts_of(spark, root).select("impact_id", "seq", F.round("distance_km", 6).alias("distance_km"), "radius_km")


@query(f"""{PIPE}, {EMITTED}, x AS ({IMPACTS.format(fac='fac').replace('SELECT ', "SELECT 'm' || e.seq AS event_id, 'drv' AS source, e.source_event_id, 'earthquake' AS event_type, epoch_us(e.event_time) AS event_us, 'facility' AS asset_type, f.facility_id AS asset_id, f.supplier_id, round(e.latitude, 6) AS event_latitude, round(e.longitude, 6) AS event_longitude, round(f.latitude, 6) AS asset_latitude, round(f.longitude, 6) AS asset_longitude, true AS inside_affected_area, round(e.magnitude, 6) AS severity, 't' || e.seq AS trace_id, 'demo' AS tenant_id, ", 1)})
SELECT *, round(1 - distance_km / radius_km, 5) AS geospatial_score, epoch_us({NOW_SQL}) AS calculated_us FROM x""")
def impact_project(spark, root):
    i = impacts_of(spark, root)
    rounded = {c: F.round(c, 6) for c in ("event_latitude", "event_longitude", "asset_latitude", "asset_longitude", "distance_km", "severity")} | {"geospatial_score": F.round("geospatial_score", 5)}
    return i.withColumns(rounded | {"event_us": F.unix_micros("event_time"), "calculated_us": F.unix_micros("calculated_at")}).drop("event_time", "calculated_at")


@query(f"{PIPE}, {EMITTED} SELECT count(*) AS events_correlated, (SELECT count(*) FROM ({IMPACTS.format(fac='fac')})) AS impacts_emitted FROM emitted WHERE radius_km IS NOT NULL")
def geo_counts(spark, root):
    events = dedup.deduplicated(_normalized(spark, root))
    emitted = correlate.correlate(events, views.facilities(spark, root), NOW).agg(F.count("*").alias("impacts_emitted"))
    return correlate.with_radius(events).agg(F.count("*").alias("events_correlated")).join(emitted, F.lit(True))


@query(f"{PIPE}, {EMITTED} SELECT radius_km, count(*) AS n FROM emitted WHERE radius_km IS NOT NULL GROUP BY 1")
def filter_radius_rule(spark, root):
    return correlate.with_radius(dedup.deduplicated(_normalized(spark, root))).groupBy("radius_km").agg(F.count("*").alias("n"))


@query(f"{PIPE}, {EMITTED}, {UPDATES_SQL}, near AS ({IMPACTS.format(fac='per').replace('SELECT ', 'SELECT f.seq AS from_seq, f.to_seq, f.deleted, ', 1)}) SELECT impact_id, seq, distance_km FROM near WHERE NOT deleted AND seq >= from_seq AND (to_seq IS NULL OR seq < to_seq)")
def geo_correlate_asof(spark, root):
    out = correlate.correlate_asof(dedup.deduplicated(_normalized(spark, root)), views.facility_updates(spark, root), NOW)
    return out.select("impact_id", "seq", F.round("distance_km", 6).alias("distance_km"))


@query(f"WITH {RAW_SQL}, {REASONS}, {FACILITY_SQL} SELECT event_id, facility_id, round({haversine_sql('e.latitude', 'e.longitude', 'f.latitude', 'f.longitude')}, 6) AS distance_km FROM norm e JOIN fac f ON {haversine_sql('e.latitude', 'e.longitude', 'f.latitude', 'f.longitude')} <= 60")
def facilities_near_event(spark, root):
    return correlate.facilities_near(_normalized(spark, root), views.facilities(spark, root), 60.0, digits=6)


@query(f"WITH {RAW_SQL}, {REASONS}, {FACILITY_SQL} SELECT facility_id, count(*) AS n_events FROM norm e JOIN fac f ON event_time >= TIMESTAMP '2024-01-15' AND {haversine_sql('e.latitude', 'e.longitude', 'f.latitude', 'f.longitude')} <= 60 GROUP BY 1")
def events_near_facility(spark, root):
    recent = _normalized(spark, root).where("event_time >= timestamp '2024-01-15 00:00:00'")
    return correlate.events_per_facility(recent, views.facilities(spark, root), 60.0)


# --- current state ------------------------------------------------------------------------------------------------------------


def _arrivals(spark, root, name):
    rows = table(spark, root, name).where(F.col("op").isin("c", "r", "u", "d"))
    return rows.withColumn("deleted", F.col("op") == "d").drop("op")


def _last_sql(name: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS[name]} ORDER BY seq DESC) AS n FROM {name} WHERE op IN ('c', 'r', 'u', 'd') AND {KEYS[name]} IS NOT NULL) WHERE n = 1)"


def _current(name: str, columns: tuple[str, ...]) -> None:
    def run(spark, root):
        return state.current_state(_arrivals(spark, root, name).select(KEYS[name], "seq", "deleted", *columns), [KEYS[name]])

    run.__name__ = f"current_state_{name.removesuffix('_cdc')}"
    query(f"SELECT {KEYS[name]}, seq, {', '.join(columns)} FROM {_last_sql(name)} WHERE op <> 'd'")(run)


_current("suppliers_cdc", ("supplier_name", "normalized_name", "country_code", "criticality_score", "status"))
_current("facilities_cdc", ("supplier_id", "latitude", "longitude", "status"))
_current("purchase_orders_cdc", ("supplier_id", "quantity", "unit_price", "status"))
_current("shipments_cdc", ("purchase_order_id", "supplier_id", "status", "shipment_value"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, {KEYS[n]} AS id FROM {_last_sql(n)} WHERE op = 'd'" for n in KEYS))
def cdc_tombstones(spark, root):
    out = None
    for name, key in KEYS.items():
        one = state.tombstones(_arrivals(spark, root, name).select(key, "seq", "deleted"), [key]).select(F.lit(name).alias("table_name"), F.col(key).alias("id"))
        out = one if out is None else out.unionByName(one)
    return out


_IMAGES = {"suppliers_cdc": "status", "facilities_cdc": "status", "purchase_orders_cdc": "status", "shipments_cdc": "status"}


@query(" UNION ALL ".join(f"SELECT '{n.removesuffix('_cdc')}' AS table_name, {KEYS[n]} AS id, op = 'd' AS deleted, CASE WHEN op <> 'd' THEN {c} END AS shown, seq FROM {n} WHERE op IN ('c', 'r', 'u', 'd')" for n, c in _IMAGES.items())
       + f" UNION ALL SELECT 'inventory', x.warehouse_id || '|' || x.product_id, deleted, CASE WHEN NOT deleted THEN CAST(CAST(quantity_on_hand AS BIGINT) AS VARCHAR) END, seq FROM (WITH {views.STOCK_SQL} SELECT *, false AS deleted, 1 AS seq FROM stock UNION ALL SELECT *, true, 2 FROM stock WHERE average_daily_usage < 0) x")
def cdc_op(spark, root):
    """The change feeds of all five operational tables, written as change messages and read again."""
    from strandline.schemas import OPERATIONAL
    from strandline.sources.logs import change_feed

    out = None
    for name in OPERATIONAL:
        image, key = OPERATIONAL[name]
        if name == "inventory":
            stock = views.warehouse_stock(spark, root).withColumns({"safety_stock": F.lit(None).cast("double"), "updated_at": F.lit(None).cast("string"), "ts_ms": F.lit(0).cast("long")})
            snapshot = stock.withColumns({"op": F.lit("r"), "seq": F.lit(1).cast("long")})
            m = snapshot.unionByName(stock.where("average_daily_usage < 0").withColumns({"op": F.lit("d"), "seq": F.lit(2).cast("long")}))
        else:
            m = table(spark, root, f"{name}_cdc")
        row = F.struct(*image.names)
        value = F.when(F.col("op").isNotNull(), F.to_json(F.struct(F.when(F.col("op") == "d", row).alias("before"), F.when(F.col("op") != "d", row).alias("after"), "op", "ts_ms")))
        shown = F.col("after.quantity_on_hand").cast("long").cast("string") if name == "inventory" else F.col("after.status")
        one = change_feed(m.select(value.alias("value"), F.col("seq").cast("long").alias("seq")), name)
        one = one.select(F.lit(name).alias("table_name"), F.concat_ws("|", *key).alias("id"), "deleted", shown.alias("shown"), "seq")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT '{{\"supplier_id\":\"' || supplier_id || '\"}}' AS key, CASE WHEN op <> 'd' THEN '{{\"supplier_id\":\"' || supplier_id || '\",\"status\":' || coalesce('\"' || status || '\"', 'null') || '}}' END AS value FROM {_last_sql('suppliers_cdc')}")
def sink_upsert(spark, root):
    return state.upsert_log(_arrivals(spark, root, "suppliers_cdc").select("supplier_id", "status", "deleted", "seq"), ["supplier_id"])


@query("SELECT CAST(s_suppkey AS VARCHAR) AS facility_id, CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 0e0 ELSE s_suppkey / 10e0 END AS latitude, s_suppkey % 7 = 0 AS deleted FROM supplier WHERE s_suppkey % 11 <> 0")
def src_facility_kv(spark, root):
    from strandline.sources.logs import facility_records

    s = table(spark, root, "supplier")
    records = s.selectExpr(
        "CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 11 = 0 THEN NULL ELSE to_json(named_struct('facility_id', cast(s_suppkey AS string))) END AS key",
        "CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 11 = 0 THEN '{\"latitude\":1}' WHEN s_suppkey % 5 = 0 THEN to_json(named_struct('facility_id', cast(s_suppkey AS string), 'latitude', 'x')) ELSE to_json(named_struct('facility_id', cast(s_suppkey AS string), 'latitude', s_suppkey / 10D)) END AS value",
        "s_suppkey",
    )
    records = records.withColumn("key", F.when(F.col("s_suppkey") % 11 == 0, F.lit(None)).when(F.col("s_suppkey") % 7 == 0, F.concat(F.lit('{"facility_id":"'), F.col("s_suppkey"), F.lit('"}'))).otherwise(F.col("key")))
    return facility_records(records).select("facility_id", "latitude", "deleted")


# --- feed polls ---------------------------------------------------------------------------------------------------------------


def _parsed(spark, root):
    return ingest.parse_features(ingest.features(views.feed_documents(spark, root)))


def _polled(spark, root):
    return ingest.classified(_parsed(spark, root), spark.createDataFrame([], "source_event_id string, seen string"), NOW)


def _delivered(spark, root):
    """The ids of two thirds of the events: what a poll got acknowledged."""
    return table(spark, root, "events").where("event_id % 3 <> 0").select(F.concat(F.lit("us"), "event_id").alias("source_event_id"))


@query(polled_sql("source_event_id, problem, CASE WHEN problem IS NULL THEN magnitude END AS magnitude, CASE WHEN problem IS NULL THEN lat::DOUBLE END AS latitude, CASE WHEN problem IS NULL THEN ms ELSE -1 END AS event_ms"))
def parse_feature(spark, root):
    p = ingest.parse_features(ingest.features(views.feed_documents(spark, root)))
    fine = F.col("problem").isNull()
    return p.select("source_event_id", "problem", F.when(fine, F.col("magnitude")).alias("magnitude"), F.when(fine, F.col("latitude")).alias("latitude"), F.when(fine, F.unix_millis("event_time")).otherwise(-1).alias("event_ms"))


@query(polled_sql("count(*) AS n, count(problem) AS n_problems"))
def src_geojson_features(spark, root):
    p = ingest.parse_features(ingest.features(views.feed_documents(spark, root)))
    return p.agg(F.count("*").alias("n"), F.count("problem").alias("n_problems"))


_OK = f"problem IS NULL AND lat <= 90 AND magnitude IS NOT NULL AND magnitude BETWEEN -2 AND 12 AND epoch_us(ts) <= epoch_us({NOW_SQL}) + 300000000"


@query(polled_sql(f"count(*) AS fetched, count(*) FILTER ({_OK} AND event_id % 3 <> 0) AS produced, 0::BIGINT AS duplicates, count(*) FILTER (NOT coalesce({_OK}, false)) AS invalid, count(*) FILTER ({_OK} AND event_id % 3 = 0) AS undelivered"))
def poll_stats(spark, root):
    return ingest.poll_stats(_polled(spark, root), _delivered(spark, root))


@query(polled_sql(f"source_event_id, CASE WHEN NOT coalesce({_OK}, false) THEN 'invalid' WHEN event_id % 3 <> 0 THEN 'duplicate' ELSE 'new' END AS outcome"))
def cursor_dedup_join(spark, root):
    # the feed is parsed once for both polls
    parsed = stored(_parsed(spark, root), "feed")
    none = spark.createDataFrame([], "source_event_id string, seen string")
    markers = ingest.committed(none, ingest.classified(parsed, none, NOW), _delivered(spark, root))
    return ingest.classified(parsed, markers, NOW).select("source_event_id", "outcome")


@query(polled_sql(f"max(ms) + 1000 AS last_updated_ms, epoch_ms({NOW_SQL}) - max(ms) - 1000 AS lag_ms").replace("FROM events))", f"FROM events)) WHERE {_OK} AND event_id % 3 <> 0"))
def cursor_max(spark, root):
    return ingest.cursor_max(_polled(spark, root), _delivered(spark, root), None, NOW)


# --- operational context ------------------------------------------------------------------------------------------------------


def _state(spark, root, name, *columns):
    return state.current_state(_arrivals(spark, root, name).select(KEYS[name], "seq", "deleted", *columns), [KEYS[name]])


@query(f"SELECT shipment_id, status FROM {_last_sql('shipments_cdc')} WHERE op <> 'd' AND status NOT IN ('delivered', 'cancelled')")
def filter_active_shipments(spark, root):
    return features.active_shipments(_state(spark, root, "shipments_cdc", "status")).select("shipment_id", "status")


@query(f"""WITH {INVENTORY_SQL} SELECT 'inventory' AS source, CAST(product_id AS VARCHAR) AS id FROM inv UNION ALL SELECT 'shipment', shipment_id FROM {_last_sql('shipments_cdc')} WHERE op <> 'd' AND status NOT IN ('delivered', 'cancelled')
UNION ALL SELECT 'facility', min(facility_id) FROM {_last_sql('facilities_cdc')} WHERE op <> 'd'""")
def src_oltp_scan(spark, root):
    """The three scans of the operational tables: all stock, the shipments under way, the first facility."""
    stock = views.inventory(spark, root).select(F.lit("inventory").alias("source"), F.col("product_id").cast("string").alias("id"))
    moving = features.active_shipments(_state(spark, root, "shipments_cdc", "status")).select(F.lit("shipment"), "shipment_id")
    first = _state(spark, root, "facilities_cdc").orderBy("facility_id").limit(1).select(F.lit("facility"), "facility_id")
    return stock.union(moving).union(first)


@query(f"""WITH s AS (SELECT * FROM {_last_sql('shipments_cdc')} WHERE op <> 'd'), j AS (
SELECT shipment_id, concat_ws(',', CASE WHEN TRY_CAST(estimated_arrival_at AS TIMESTAMPTZ) < TRY_CAST(planned_departure_at AS TIMESTAMPTZ) THEN 'eta_before_departure' END, CASE WHEN status NOT IN ('created', 'in_transit', 'customs', 'out_for_delivery', 'delivered', 'cancelled') THEN 'unknown_status' END, CASE WHEN shipment_value < 0 THEN 'negative_value' END,
CASE WHEN supplier_id NOT IN (SELECT supplier_id FROM {_last_sql('suppliers_cdc')} WHERE op <> 'd') THEN 'unknown_supplier' END, CASE WHEN origin_facility_id NOT IN (SELECT facility_id FROM {_last_sql('facilities_cdc')} WHERE op <> 'd') THEN 'unknown_facility' END) AS reasons FROM s)
SELECT * FROM j""")
def dq_shipment(spark, root):
    s = _state(spark, root, "shipments_cdc", "estimated_arrival_at", "planned_departure_at", "status", "shipment_value", "supplier_id", "origin_facility_id")
    judged = quality.shipment_reasons(s, _state(spark, root, "suppliers_cdc"), _state(spark, root, "facilities_cdc"))
    return judged.select("shipment_id", F.concat_ws(",", "reasons").alias("reasons"))


@query(f"WITH {INVENTORY_SQL} SELECT product_id, concat_ws(',', CASE WHEN quantity_on_hand < 0 THEN 'negative_quantity' END, CASE WHEN average_daily_usage - 25 < 0 THEN 'negative_usage' END, CASE WHEN product_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48) THEN 'unknown_product' END) AS reasons FROM inv")
def dq_inventory(spark, root):
    """Usage is shifted by 25 so that some is negative; products are those with a large order line, so that some don't exist."""
    stock = views.inventory(spark, root).withColumn("average_daily_usage", F.col("average_daily_usage") - 25)
    products = table(spark, root, "lineitem").where("l_quantity > 48").select("l_partkey").distinct()
    judged = quality.inventory_reasons(stock, products=products.withColumnRenamed("l_partkey", "product_id"))
    return judged.select("product_id", F.concat_ws(",", "reasons").alias("reasons"))


@query(f"SELECT facility_id, supplier_id FROM {_last_sql('facilities_cdc')} f WHERE op <> 'd' AND supplier_id IS NOT NULL AND supplier_id NOT IN (SELECT supplier_id FROM {_last_sql('suppliers_cdc')} WHERE op <> 'd')")
def dq_referential(spark, root):
    return features.without_parent(_state(spark, root, "facilities_cdc", "supplier_id").select("facility_id", "supplier_id"), "supplier_id", _state(spark, root, "suppliers_cdc"), "supplier_id").select("facility_id", "supplier_id")


def _latest_impacts(spark, root):
    return state.latest(table(spark, root, "impact_candidates").select("impact_id", "event_id", "asset_id", "supplier_id", "source_event_id", F.struct("calculated_at", "event_id").alias("o")), ["impact_id"], "o").drop("o")


_LATEST_IMPACTS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY impact_id ORDER BY calculated_at DESC, event_id DESC) AS n FROM impact_candidates) WHERE n = 1)"


@query(f"""WITH po AS (SELECT supplier_id, round(sum(quantity * unit_price), 4) AS v, count(*) AS c FROM {_last_sql('purchase_orders_cdc')} WHERE op <> 'd' AND status = 'open' GROUP BY 1),
sh AS (SELECT origin_facility_id, count(*) AS c FROM {_last_sql('shipments_cdc')} WHERE op <> 'd' AND status NOT IN ('delivered', 'cancelled') GROUP BY 1),
sup AS (SELECT supplier_id, criticality_score FROM {_last_sql('suppliers_cdc')} WHERE op <> 'd'), src AS (SELECT source_event_id, count(DISTINCT source) AS c FROM events_normalized GROUP BY 1)
SELECT impact_id, i.event_id, round(coalesce(po.v, 0), 2) AS open_order_value, coalesce(po.c, 0) AS open_order_count, coalesce(sh.c, 0) AS active_shipment_count, coalesce(src.c, 0) AS source_confirmation_count, sup.criticality_score AS supplier_criticality
FROM {_LATEST_IMPACTS} i LEFT JOIN po USING (supplier_id) LEFT JOIN sh ON sh.origin_facility_id = i.asset_id LEFT JOIN sup USING (supplier_id) LEFT JOIN src USING (source_event_id)""")
def feature_build(spark, root):
    out = features.feature_build(_latest_impacts(spark, root), _state(spark, root, "suppliers_cdc", "criticality_score"), _state(spark, root, "purchase_orders_cdc", "supplier_id", "status", "quantity", "unit_price"), _state(spark, root, "shipments_cdc", "status", "origin_facility_id", "shipment_value"), table(spark, root, "events_normalized"))
    return out.select("impact_id", "event_id", F.round("open_order_value", 2).alias("open_order_value"), "open_order_count", "active_shipment_count", "source_confirmation_count", "supplier_criticality")


@query(f"SELECT impact_id, shipment_id FROM {_LATEST_IMPACTS} i JOIN {_last_sql('shipments_cdc')} s ON s.origin_facility_id = i.asset_id WHERE s.op <> 'd' AND s.status NOT IN ('delivered', 'cancelled')")
def shipment_ids(spark, root):
    return features.shipment_ids(_latest_impacts(spark, root), _state(spark, root, "shipments_cdc", "status", "origin_facility_id"))


@query(f"SELECT supplier_id, purchase_order_id FROM {_last_sql('purchase_orders_cdc')} WHERE op <> 'd' AND status = 'open' AND supplier_id IN (SELECT supplier_id FROM {_LATEST_IMPACTS} WHERE supplier_id IS NOT NULL)")
def order_ids(spark, root):
    return features.order_ids(_latest_impacts(spark, root), _state(spark, root, "purchase_orders_cdc", "supplier_id", "status"))


_DAYS = "CASE WHEN average_daily_usage <= 0 THEN 'inf'::DOUBLE ELSE quantity_on_hand / average_daily_usage END"


@query(f"""WITH {views.STOCK_SQL}, g AS (SELECT DISTINCT origin_facility_id AS asset_id, o.product_id, s.destination_warehouse_id AS warehouse_id FROM {_last_sql('shipments_cdc')} s JOIN {_last_sql('purchase_orders_cdc')} o USING (purchase_order_id)
WHERE s.op <> 'd' AND o.op <> 'd' AND s.status NOT IN ('delivered', 'cancelled') AND origin_facility_id IS NOT NULL AND o.product_id IS NOT NULL)
SELECT asset_id, round(min({_DAYS}), 6) AS inventory_days_remaining, count(DISTINCT product_id) AS products FROM g LEFT JOIN stock USING (warehouse_id, product_id) GROUP BY 1""")
def feature_join_chain(spark, root):
    """Facility, active shipments, their orders, the products and the stock where they go."""
    shipments = _state(spark, root, "shipments_cdc", "status", "origin_facility_id", "purchase_order_id", "destination_warehouse_id")
    out = features.stock_exposure(shipments, _state(spark, root, "purchase_orders_cdc", "product_id"), views.warehouse_stock(spark, root))
    return out.withColumn("inventory_days_remaining", F.round("inventory_days_remaining", 6))


@query(f"""WITH p AS (SELECT DISTINCT supplier_id, product_id FROM {_last_sql('purchase_orders_cdc')} WHERE op <> 'd' AND status = 'open' AND supplier_id IS NOT NULL AND product_id IS NOT NULL)
SELECT supplier_id, min(n - 1) AS alternative_supplier_count FROM p JOIN (SELECT product_id, count(*) AS n FROM p GROUP BY 1) USING (product_id) GROUP BY 1""")
def alternative_suppliers(spark, root):
    return features.alternative_suppliers(_state(spark, root, "purchase_orders_cdc", "supplier_id", "status", "product_id"))


@query(f"WITH {views.STOCK_SQL} SELECT warehouse_id, product_id, round(quantity_on_hand / average_daily_usage, 6) AS days FROM stock WHERE average_daily_usage > 0 AND quantity_on_hand / average_daily_usage <= 15 ORDER BY quantity_on_hand / average_daily_usage, warehouse_id, product_id LIMIT 50")
def inventory_exposure(spark, root):
    return features.inventory_exposure(views.warehouse_stock(spark, root), 15.0).withColumn("days", F.round("days", 6))


@query(f"SELECT purchase_order_id, supplier_id, required_by_date FROM {_last_sql('purchase_orders_cdc')} WHERE op <> 'd' AND status = 'open' AND supplier_id IN (SELECT supplier_id FROM impact_candidates) ORDER BY required_by_date NULLS LAST, purchase_order_id LIMIT 50")
def open_orders(spark, root):
    return features.open_orders(_state(spark, root, "purchase_orders_cdc", "supplier_id", "status", "required_by_date"), table(spark, root, "impact_candidates"))


@query("""WITH f AS (SELECT impact_id, event_id, unnest([struct_pack(feature := 'distance', c := round(0.15 * geospatial_score, 9)), struct_pack(feature := 'severity', c := round(0.02 * severity, 9)), struct_pack(feature := 'spread', c := round(0.001 * radius_km, 9))]) AS x FROM (SELECT impact_id, event_id, max(geospatial_score) AS geospatial_score, max(severity) AS severity, max(radius_km) AS radius_km FROM impact_candidates GROUP BY ALL)),
r AS (SELECT impact_id, event_id, x.feature AS feature, x.c AS contribution, row_number() OVER (PARTITION BY impact_id, event_id ORDER BY x.c DESC, x.feature) AS n FROM f WHERE x.c IS NOT NULL)
SELECT impact_id, event_id, feature, contribution FROM r WHERE n <= 2""")
def top_factors(spark, root):
    """The two greatest of three contributions to a score."""
    i = table(spark, root, "impact_candidates").groupBy("impact_id", "event_id").agg(*[F.max(c).alias(c) for c in ("geospatial_score", "severity", "radius_km")])
    parts = {"distance": 0.15 * F.col("geospatial_score"), "severity": 0.02 * F.col("severity"), "spread": 0.001 * F.col("radius_km")}
    best = features.top_factors({n: F.round(c, 9) for n, c in parts.items()}, 2)
    return i.select("impact_id", "event_id", F.inline(best))


@query(f"SELECT shipment_id, supplier_id, shipment_value FROM {_last_sql('shipments_cdc')} WHERE op <> 'd' AND status NOT IN ('delivered', 'cancelled') AND origin_facility_id IN (SELECT asset_id FROM impact_candidates) ORDER BY shipment_value DESC NULLS LAST, shipment_id LIMIT 50")
def affected_shipments(spark, root):
    return features.affected_shipments(table(spark, root, "impact_candidates"), _state(spark, root, "shipments_cdc", "supplier_id", "status", "origin_facility_id", "shipment_value"), 50)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def pagination(spark, root):
    return features.page(table(spark, root, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 2, 20)


@query()
def sample_shipments(spark, root):
    return features.sample_half(features.active_shipments(_state(spark, root, "shipments_cdc", "status")).select("shipment_id"), seed=7)


@query("""SELECT event_type, count(*) AS n, round(quantile_cont(x, 0.5), 6) AS p50_s, round(quantile_cont(x, 0.95), 6) AS p95_s, round(quantile_cont(x, 0.99), 6) AS p99_s FROM (SELECT event_type, floor((epoch_us(normalized_at) - epoch_us(ingested_at)) / 1e3) / 1e3 AS x FROM events_normalized) GROUP BY 1""")
def latency_quantiles(spark, root):
    return features.latency(table(spark, root, "events_normalized"), "ingested_at", "normalized_at", ["event_type"])


@query("WITH x AS (SELECT (epoch_us(normalized_at) - epoch_us(ingested_at)) / 1e6 AS s FROM events_normalized), b AS (SELECT unnest([0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 8.0, 10.0, NULL]::DOUBLE[]) AS le_s) SELECT le_s, count(*) FILTER (le_s IS NULL OR s <= le_s) AS n FROM x, b GROUP BY 1")
def latency_histogram(spark, root):
    return features.latency_histogram(table(spark, root, "events_normalized"), "ingested_at", "normalized_at")


def _links(spark, root):
    s = table(spark, root, "suppliers_cdc")
    aliases = s.where(F.col("op").isin("c", "r", "u") & F.col("supplier_name").isNotNull()).select(F.col("supplier_id").alias("entity_id"), F.col("supplier_name").alias("alias"))
    name, n = F.col("normalized_name"), F.length("normalized_name")
    changed = F.when(n % 7 == 0, F.substr(name, F.lit(2))).when(n % 7 == 1, F.concat(F.lit("x"), F.regexp_replace(name, "a", "aa"))).otherwise(name)
    mentions = s.where("normalized_name is not null").select(changed.alias("mention")).distinct()
    return features.link_entities(mentions, aliases)


@query("""WITH n AS (SELECT min(supplier_id) AS entity_id, trim(regexp_replace(regexp_replace(lower(supplier_name), '[^\\p{L}\\p{N} ]+', ' ', 'g'), ' +', ' ', 'g')) AS name FROM suppliers_cdc WHERE supplier_name IS NOT NULL AND op IN ('c', 'r', 'u') GROUP BY 2),
m0 AS (SELECT DISTINCT CASE length(normalized_name) % 7 WHEN 0 THEN substr(normalized_name, 2) WHEN 1 THEN 'x' || replace(normalized_name, 'a', 'aa') ELSE normalized_name END AS mention FROM suppliers_cdc WHERE normalized_name IS NOT NULL),
m AS (SELECT mention, trim(regexp_replace(regexp_replace(lower(mention), '[^\\p{L}\\p{N} ]+', ' ', 'g'), ' +', ' ', 'g')) AS name FROM m0),
d AS (SELECT m.name, min(struct_pack(d := levenshtein(m.name, n.name), id := n.entity_id)).id AS near_id FROM (SELECT DISTINCT name FROM m WHERE name <> '' AND name NOT IN (SELECT name FROM n)) m JOIN n ON n.name <> '' AND levenshtein(m.name, n.name) <= 2 GROUP BY 1)
SELECT mention, coalesce(n.entity_id, near_id) AS entity_id, CASE WHEN n.entity_id IS NOT NULL THEN 'exact' WHEN near_id IS NOT NULL THEN 'near' END AS how FROM m LEFT JOIN n ON n.name = m.name AND n.name <> '' LEFT JOIN d ON d.name = m.name""")
def entity_link(spark, root):
    """Every mention with what it is linked to and how, also near ones and those left unlinked. Each seventh mention has lost or
    gained letters, so that there are near and unlinked ones."""
    return _links(spark, root).select("mention", "entity_id", "how")


_CATEGORIES = {"factory_fire": "fire|blaze|smoke", "labour": "strike|walkout|union", "weather": "storm|flood|frost|snow"}
_SHORT = "array_to_string(string_split(supplier_name, ' ')[1:2], ' ')"
_PLAIN = "trim(regexp_replace(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}} ]+', ' ', 'g'), ' +', ' ', 'g'))"


@query(f"""WITH n AS (SELECT min(supplier_id) AS entity_id, {_PLAIN.format(c=_SHORT)} AS mention FROM suppliers_cdc WHERE supplier_name IS NOT NULL AND op IN ('c', 'r', 'u') GROUP BY 2 HAVING mention <> ''),
d AS (SELECT doc_id, {" ".join(["CASE", *(f"WHEN regexp_matches(lower(text), '{p}') THEN '{c}'" for c, p in _CATEGORIES.items()), "END"])} AS category, ' ' || {_PLAIN.format(c='text')} || ' ' AS t FROM documents),
m AS (SELECT doc_id, mention, entity_id FROM d JOIN n ON contains(t, ' ' || mention || ' ')) SELECT d.doc_id, category, mention, entity_id FROM d LEFT JOIN m USING (doc_id)""")
def enrich_events(spark, root):
    """Texts call suppliers by the first two words of their names."""
    s = table(spark, root, "suppliers_cdc").where(F.col("op").isin("c", "r", "u") & F.col("supplier_name").isNotNull())
    return features.enriched(table(spark, root, "documents"), _CATEGORIES, s.select(F.col("supplier_id").alias("entity_id"), F.substring_index("supplier_name", " ", 2).alias("alias")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 + 1 >= 4 THEN 'dead_letter' ELSE 'retry' END AS route, CASE WHEN o_orderkey % 5 + 1 < 4 THEN 1000000 + CAST(least(pow(2, o_orderkey % 5), 60) * 1000 AS BIGINT) ELSE -1 END AS next_retry_at_ms FROM orders")
def sink_retry_dlq(spark, root):
    failed = table(spark, root, "orders").select("o_orderkey", (F.col("o_orderkey") % 5 + 1).cast("int").alias("attempt"), F.lit("x").alias("last_error"))
    return features.retry_envelopes(failed, 1_000_000).select("o_orderkey", "route", F.coalesce("next_retry_at_ms", F.lit(-1)).alias("next_retry_at_ms"))


# --- retrieval ----------------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', ' ', 'g'), '<[^<>]+>', ' ', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), '^ +| +$', '', 'g') AS content FROM documents WHERE text IS NOT NULL")
def doc_parse(spark, root):
    return table(spark, root, "documents").where("text is not null").select("doc_id", retrieval.parsed_text(F.col("text")).alias("content"))


@query()
def doc_chunk(spark, root):
    return retrieval.chunks(table(spark, root, "documents"))


@query("SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL")
def content_hash_chunk(spark, root):
    return table(spark, root, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("content_hash"))


@query("SELECT CAST(vec_id AS VARCHAR) AS chunk_id FROM embeddings WHERE vec_id % 4 <> 0")
def embed_idempotent(spark, root):
    e = table(spark, root, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"))
    done = e.where("chunk_id % 4 = 0").withColumn("model_version", F.lit("m1")).unionByName(e.where("chunk_id % 4 = 1").withColumn("model_version", F.lit("m0")))
    return retrieval.unembedded(e, done, "m1")


def _knn(spark, root, k):
    e = table(spark, root, "embeddings")
    queries = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return retrieval.knn(queries, e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector")), k)


_KNN = """knn AS (SELECT * FROM (SELECT q.vec_id AS query_id, i.vec_id AS item_id, round(list_cosine_similarity(q.embedding::DOUBLE[], i.embedding::DOUBLE[]), 6) AS similarity, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], i.embedding::DOUBLE[]), 6) DESC, i.vec_id) AS place
FROM embeddings q, embeddings i WHERE q.vec_id % 50 = 0) WHERE place <= 10)"""


@query(f"WITH {_KNN} SELECT * FROM knn")
def vector_knn(spark, root):
    return _knn(spark, root, 10).withColumn("place", F.col("place").cast("long"))


@query()
def vector_knn_indexed(spark, root):
    """Recall of the inverted file against the exact search, over all queries."""
    e = table(spark, root, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    asked = e.where("item_id % 50 = 0").withColumnRenamed("item_id", "query_id")
    found = retrieval.knn_indexed(asked, e, 10).select("query_id", "item_id", F.lit(1).alias("hit"))
    return retrieval.knn(asked, e, 10).join(found, ["query_id", "item_id"], "left").agg(F.count("*").alias("neighbours"), F.round(F.avg(F.coalesce("hit", F.lit(0))), 4).alias("recall"))


ASKED = ((1, "container vessel congestion at the terminal"), (2, "aftershock cracked the floor"), (3, "credit downgrade of the supplier"))
_ASKED_SQL = "(VALUES " + ", ".join(f"({n}, '{q}')" for n, q in ASKED) + ") a(query_id, query)"
_BM25 = f"""w AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'), []) AS t FROM documents), o AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM w), q AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(query), '[a-z0-9]+')) AS term FROM {_ASKED_SQL}),
p AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS len, unnest(t) AS term FROM w) WHERE term IN (SELECT term FROM q) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
bm AS (SELECT query_id, doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len / mean))) AS score FROM p JOIN f USING (term) JOIN q USING (term), o GROUP BY ALL)"""


def _bm25(spark, root):
    return retrieval.bm25(table(spark, root, "documents"), spark.createDataFrame(list(ASKED), "query_id int, query string"))


@query(f"WITH {_BM25} SELECT query_id, doc_id, round(score, 4) AS score FROM bm")
def bm25(spark, root):
    return _bm25(spark, root).withColumn("score", F.round("score", 4))


def _priors(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "source", "published_at")
    age = (F.lit(1782777600) - F.unix_seconds("published_at")) / F.lit(86400.0 * 181)
    return docs.select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - age)).alias("recency"), F.when(F.col("source").like("%-wire"), 0.9).otherwise(0.5).alias("reliability"))


#: The tables hold no embeddings of questions: that of vec_id 50 n stands in for question n, and vec_id for doc_id.
_UNION = f"""{_BM25}, ve AS (SELECT CAST(q.vec_id / 50 AS INT) AS query_id, i.vec_id AS doc_id, round(list_cosine_similarity(q.embedding::DOUBLE[], i.embedding::DOUBLE[]), 6) AS v FROM embeddings q, embeddings i WHERE q.vec_id IN ({", ".join(str(50 * n) for n, _ in ASKED)})),
s AS (SELECT a.query_id, d.doc_id, coalesce(score, 0) AS score, coalesce(v, 0) AS v, greatest(0, least(1, 1 - (1782777600 - floor(epoch(published_at))) / (86400e0 * 181))) AS recency, CASE WHEN source LIKE '%-wire' THEN 0.9 ELSE 0.5 END AS rel
FROM documents d CROSS JOIN {_ASKED_SQL} LEFT JOIN bm ON bm.query_id = a.query_id AND bm.doc_id = d.doc_id LEFT JOIN ve ON ve.query_id = a.query_id AND ve.doc_id = d.doc_id),
fz AS (SELECT query_id, doc_id, 0.55 * (v - min(v) OVER q) / (max(v) OVER q - min(v) OVER q) + 0.30 * (score - min(score) OVER q) / (max(score) OVER q - min(score) OVER q) + 0.10 * recency + 0.05 * rel AS final_score FROM s WINDOW q AS (PARTITION BY query_id))"""


@query(f"WITH {_UNION} SELECT query_id, doc_id, round(final_score, 4) AS final_score FROM fz")
def hybrid_fusion(spark, root):
    """Every document for every question, also those without a query term."""
    asked = spark.createDataFrame([(n, 50 * n) for n, _ in ASKED], "query_id int, vec_id long")
    e = table(spark, root, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    vector = retrieval.similarities(asked.join(e, "vec_id").select("query_id", "vector"), e.withColumnRenamed("vec_id", "item_id")).withColumnRenamed("similarity", "vector")
    lexical = _bm25(spark, root).select("query_id", F.col("doc_id").alias("item_id"), F.col("score").alias("bm25"))
    scored = retrieval.candidates(_priors(spark, root).withColumnRenamed("doc_id", "item_id"), asked, vector, lexical)
    return retrieval.fused(scored).select("query_id", F.col("item_id").alias("doc_id"), F.round("final_score", 4).alias("final_score"))


@query("""WITH r AS (SELECT l_linenumber AS query_id, l_orderkey AS doc_id, l_partkey AS item_id, sum(l_quantity) AS s FROM lineitem GROUP BY ALL) SELECT query_id, doc_id, item_id, s AS final_score FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY s DESC, item_id) AS n FROM r) WHERE n = 1""")
def dedupe_same_doc(spark, root):
    ranked = table(spark, root, "lineitem").groupBy(F.col("l_linenumber").alias("query_id"), F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("item_id")).agg(F.sum("l_quantity").alias("final_score"))
    return retrieval.best_per_document(ranked)


@query(f"WITH {_KNN} SELECT query_id, item_id, used_tokens FROM (SELECT query_id, item_id, sum(100 + item_id % 300) OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id)::BIGINT AS used_tokens FROM knn) WHERE used_tokens <= 1500")
def token_budget(spark, root):
    ranked = _knn(spark, root, 10).select("query_id", "item_id", F.col("similarity").alias("final_score"), (100 + F.col("item_id") % 300).alias("n_tokens"))
    return retrieval.within_budget(ranked, 1500).select("query_id", "item_id", "used_tokens")


def _mmr_sql(k: int) -> str:
    """The greedy choice unrolled: step n takes the best of what the steps before left."""
    parts = ["p1 AS (SELECT query_id, item_id, vec FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, item_id) AS n FROM c) WHERE n = 1), g1 AS (SELECT *, 1 AS place FROM p1)"]
    for n in range(2, k + 1):
        parts.append(f"""g{n} AS (SELECT * FROM g{n - 1} UNION ALL SELECT query_id, item_id, vec, {n} AS place FROM (SELECT c.query_id, c.item_id, c.vec, row_number() OVER (PARTITION BY c.query_id ORDER BY 0.7 * c.s - 0.3 * greatest(0, max(list_cosine_similarity(c.vec, g.vec))) DESC, c.s DESC, c.item_id) AS n
FROM c JOIN g{n - 1} g ON g.query_id = c.query_id WHERE NOT EXISTS (SELECT 1 FROM g{n - 1} h WHERE h.query_id = c.query_id AND h.item_id = c.item_id) GROUP BY c.query_id, c.item_id, c.vec, c.s) WHERE n = 1)""")
    knn = _KNN.replace("place <= 10", "place <= 20")
    return f"WITH {knn}, c AS (SELECT query_id, item_id, similarity AS s, embedding::DOUBLE[] AS vec FROM knn JOIN embeddings ON vec_id = item_id), {', '.join(parts)} SELECT query_id, item_id, place FROM g{k}"


@query(_mmr_sql(5))
def mmr(spark, root):
    items = table(spark, root, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    ranked = _knn(spark, root, 20).withColumnRenamed("similarity", "final_score").join(items, "item_id")
    return retrieval.diverse(ranked.select("query_id", "item_id", "final_score", "vector"), 5)


@query("SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'de') AND source LIKE '%-wire' AND epoch_us(published_at) >= epoch_us(TIMESTAMP '2026-04-01') AND supplier_id IS NOT NULL")
def metadata_filter(spark, root):
    d = table(spark, root, "documents")
    return d.where(F.col("lang").isin("en", "de") & F.col("source").like("%-wire") & (F.col("published_at") >= F.lit("2026-04-01 00:00:00").cast("timestamp")) & F.col("supplier_id").isNotNull()).select("doc_id", "lang", "source")


@query("""WITH c AS (SELECT impact_id AS claim_id, event_id AS evidence_id, asset_id FROM impact_candidates), e AS (SELECT event_id, bool_or(payload.status = 'active') AS is_active FROM events_normalized GROUP BY 1)
SELECT DISTINCT claim_id, evidence_id, CASE WHEN is_active IS NULL THEN 'unknown' WHEN evidence_id LIKE 'a%' THEN 'not_in_context' ELSE 'inactive' END AS problem FROM c LEFT JOIN e ON event_id = evidence_id WHERE is_active IS NULL OR evidence_id LIKE 'a%' OR NOT is_active""")
def validate_citations(spark, root):
    claims = table(spark, root, "impact_candidates").select(F.col("impact_id").alias("claim_id"), F.array("event_id").alias("evidence_ids"))
    evidence = table(spark, root, "events_normalized").groupBy(F.col("event_id").alias("evidence_id")).agg(F.max(F.col("payload.status") == "active").alias("is_active"))
    context = evidence.where(~F.col("evidence_id").startswith("a")).select("evidence_id")
    return retrieval.citation_problems(claims, evidence, context).distinct()


@query(f"""WITH i AS (SELECT DISTINCT impact_id AS claim_id, event_id AS fact_id, CASE WHEN radius_km < 100 THEN severity + 0.5 ELSE severity END AS value FROM impact_candidates), f AS (SELECT event_id AS fact_id, max(CASE WHEN depth <> 0 THEN severity END) AS fact FROM (SELECT event_id, payload.severity AS severity, coalesce(payload.depth_km, 0) AS depth FROM events_normalized WHERE event_id NOT LIKE 'a%') GROUP BY 1)
SELECT claim_id, i.fact_id, CASE WHEN f.fact_id IS NULL THEN 'unknown' WHEN value IS NULL OR fact IS NULL THEN 'missing' ELSE 'mismatch' END AS problem FROM i LEFT JOIN f ON i.fact_id = f.fact_id WHERE f.fact_id IS NULL OR value IS NULL OR fact IS NULL OR abs(value - fact) > 1e-6 * greatest(1, abs(fact))""")
def validate_numbers(spark, root):
    """Severities that impacts claim, those of small radius half a degree too high, held against those of the events; some of the
    events are unknown, and those without a depth have no severity."""
    claimed = F.when(F.col("radius_km") < 100, F.col("severity") + 0.5).otherwise(F.col("severity"))
    claims = table(spark, root, "impact_candidates").select(F.col("impact_id").alias("claim_id"), F.col("event_id").alias("fact_id"), claimed.alias("value")).distinct()
    known = table(spark, root, "events_normalized").where("event_id not like 'a%'")
    facts = known.groupBy(F.col("event_id").alias("fact_id")).agg(F.max(F.when(F.coalesce("payload.depth_km", F.lit(0.0)) != 0, F.col("payload.severity"))).alias("value"))
    return retrieval.number_problems(claims, facts)


@query("""WITH d AS (SELECT doc_id AS answer_id, text, CASE WHEN source LIKE '%-wire' THEN 'other' ELSE 'demo' END AS tenant_id FROM documents)
SELECT answer_id, 'email' AS problem FROM d WHERE regexp_matches(text, '[\\w.+-]+@[\\w-]+\\.[\\w.]+') UNION ALL SELECT answer_id, 'phone' FROM d WHERE regexp_matches(text, '\\+\\d[\\d ()-]{7,}\\d') UNION ALL SELECT answer_id, 'other_tenant' FROM d WHERE tenant_id <> 'demo'""")
def validate_policy(spark, root):
    d = table(spark, root, "documents").select(F.col("doc_id").alias("answer_id"), "text", F.when(F.col("source").like("%-wire"), "other").otherwise("demo").alias("tenant_id"))
    return retrieval.policy_problems(d, "demo")


@query("SELECT seq, purchase_order_id FROM shipments_cdc WHERE purchase_order_id IS NOT NULL AND purchase_order_id NOT IN (SELECT purchase_order_id FROM purchase_orders_cdc WHERE op IN ('c', 'r', 'u') AND purchase_order_id IS NOT NULL)")
def validate_ids(spark, root):
    """Claimed order ids that no order ever had."""
    orders = table(spark, root, "purchase_orders_cdc").where(F.col("op").isin("c", "r", "u"))
    return features.without_parent(table(spark, root, "shipments_cdc").select("seq", "purchase_order_id"), "purchase_order_id", orders, "purchase_order_id").select("seq", "purchase_order_id")
