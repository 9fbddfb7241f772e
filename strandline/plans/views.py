"""The pipelines' inputs expressed over the tables of a directory, in Spark and in SQL."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.sources.tables import table

#: The moment the pipelines run at.
NOW = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)
NOW_SQL = "TIMESTAMP '2024-01-30 12:00:00'"


def raw_events(spark: SparkSession, root: str) -> DataFrame:
    """Raw envelopes in order of arrival (seq), with replays: every fifth event again at once, every fiftieth much later."""
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    base = table(spark, root, "events").select("*", F.inline(F.array(F.struct(k))))  # as a plain column it is parsed again for each term of a filter
    copies = base.selectExpr("inline(filter(array(struct(event_id * 10 AS seq, true AS kept), struct(event_id * 10 + 1 AS seq, event_id % 5 = 0 AS kept), struct(event_id * 10 + 2000005 AS seq, event_id % 50 = 0 AS kept)), x -> x.kept))", "*")
    return copies.selectExpr(
        "seq",
        "concat('m', seq) AS event_id",
        "'raw' AS event_type",
        "1 AS event_version",
        "'drv' AS source",
        "concat(user_id, '-', event_type) AS source_event_id",
        "cast(ts AS string) AS source_version",
        "ts AS event_time",
        "ts AS ingested_at",
        "concat('t', seq) AS trace_id",
        "cast(null AS string) AS correlation_id",
        "'demo' AS tenant_id",
        """struct(concat(user_id, '-', event_type) AS source_event_id, CASE WHEN k = 7 THEN NULL ELSE value / 40D END AS magnitude,
           10D * (user_id % 10) - 45D + (k - 50) / 50D + CASE WHEN k >= 97 THEN 900D ELSE 0D END AS latitude,
           30D * (user_id % 10) - 135D + (event_id % 21 - 10) / 10D AS longitude, CASE WHEN k % 3 = 0 THEN NULL ELSE cast(k AS double) END AS depth_km,
           cast(null AS string) AS place, cast(ts AS string) AS event_time, cast(ts AS string) AS updated_time, cast(null AS string) AS source_url) AS payload""",
    )


RAW_SQL = """b AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
r0 AS (SELECT event_id * 10 AS seq, * FROM b UNION ALL SELECT event_id * 10 + 1, * FROM b WHERE event_id % 5 = 0 UNION ALL SELECT event_id * 10 + 2000005, * FROM b WHERE event_id % 50 = 0),
raw AS (SELECT seq, 'm' || seq AS event_id, user_id || '-' || event_type AS source_event_id, ts AS event_time, 10e0 * (user_id % 10) - 45e0 + (k - 50) / 50e0 + CASE WHEN k >= 97 THEN 900e0 ELSE 0e0 END AS latitude,
30e0 * (user_id % 10) - 135e0 + (event_id % 21 - 10) / 10e0 AS longitude, CASE WHEN k = 7 THEN NULL ELSE value / 40e0 END AS magnitude, CASE WHEN k % 3 = 0 THEN NULL ELSE k * 1e0 END AS depth_km FROM r0)"""


def facilities(spark: SparkSession, root: str) -> DataFrame:
    """One facility per supplier."""
    return table(spark, root, "supplier").selectExpr(
        "cast(s_suppkey AS string) AS facility_id", "cast(s_suppkey AS string) AS supplier_id", "10D * (s_suppkey % 10) - 45D + 0.05D * ((s_suppkey div 10) % 20) AS latitude", "30D * (s_suppkey % 10) - 135D AS longitude", "CASE WHEN s_acctbal < 0 THEN 'paused' ELSE 'active' END AS status",
    )


FACILITY_SQL = """fac AS (SELECT CAST(s_suppkey AS VARCHAR) AS facility_id, CAST(s_suppkey AS VARCHAR) AS supplier_id, 10e0 * (s_suppkey % 10) - 45e0 + 0.05e0 * ((s_suppkey // 10) % 20) AS latitude, 30e0 * (s_suppkey % 10) - 135e0 AS longitude FROM supplier)"""


def facility_updates(spark: SparkSession, root: str) -> DataFrame:
    """Arrivals of facility rows among the events: a snapshot before all, moves of every third and deletes of every seventh later."""
    base = facilities(spark, root)
    n = F.col("facility_id").cast("long")
    snapshot = base.withColumn("deleted", F.lit(False)).withColumn("seq", -n)
    moved = base.where(n % 3 == 0).withColumn("latitude", F.col("latitude") + 0.5).withColumn("deleted", F.lit(False)).withColumn("seq", n * 97 + 3)
    gone = base.where(n % 7 == 0).withColumn("deleted", F.lit(True)).withColumn("seq", n * 131 + 40004)
    return snapshot.unionByName(moved).unionByName(gone).drop("status")


UPDATES_SQL = """upd AS (SELECT *, false AS deleted, -CAST(facility_id AS BIGINT) AS seq FROM fac UNION ALL SELECT facility_id, supplier_id, latitude + 0.5, longitude, false, CAST(facility_id AS BIGINT) * 97 + 3 FROM fac WHERE CAST(facility_id AS BIGINT) % 3 = 0
UNION ALL SELECT *, true, CAST(facility_id AS BIGINT) * 131 + 40004 FROM fac WHERE CAST(facility_id AS BIGINT) % 7 = 0),
per AS (SELECT *, lead(seq) OVER (PARTITION BY facility_id ORDER BY seq) AS to_seq FROM upd)"""


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Stock of every part, and its mean use per order line."""
    use = table(spark, root, "lineitem").groupBy("l_partkey").agg(F.round(F.avg("l_quantity"), 6).alias("average_daily_usage"))
    part = table(spark, root, "part").selectExpr("p_partkey", "p_size * 10D - 30D AS quantity_on_hand", "cast(p_size AS double) AS safety_stock")
    return part.join(use, F.col("p_partkey") == F.col("l_partkey"), "left").select(F.lit("w1").alias("warehouse_id"), F.col("p_partkey").alias("product_id"), "quantity_on_hand", "average_daily_usage", "safety_stock")


INVENTORY_SQL = "inv AS (SELECT p_partkey AS product_id, p_size * 10e0 - 30e0 AS quantity_on_hand, (SELECT round(avg(l_quantity), 6) FROM lineitem WHERE l_partkey = p_partkey) AS average_daily_usage FROM part)"


def warehouse_stock(spark: SparkSession, root: str) -> DataFrame:
    """Stock of most products in most warehouses of the operational tables; some products aren't used."""
    goods = table(spark, root, "purchase_orders_cdc").where("product_id is not null").select("product_id").distinct()
    houses = table(spark, root, "shipments_cdc").where("destination_warehouse_id is not null").select(F.col("destination_warehouse_id").alias("warehouse_id")).distinct()
    code = lambda c, at: F.ascii(F.substring(c, at, 1))
    # a catalogue: both lists are bounded, whatever the number of orders
    stock = houses.crossJoin(goods).where((code("warehouse_id", 2) + code("product_id", 2)) % 5 != 0)
    return stock.withColumns({"quantity_on_hand": code("warehouse_id", 1) * F.lit(10.0), "average_daily_usage": code("product_id", 1) - F.lit(50.0)})


STOCK_SQL = """stock AS (SELECT warehouse_id, product_id, ascii(substr(warehouse_id, 1, 1)) * 10e0 AS quantity_on_hand, ascii(substr(product_id, 1, 1)) - 50e0 AS average_daily_usage FROM (SELECT DISTINCT destination_warehouse_id AS warehouse_id FROM shipments_cdc WHERE destination_warehouse_id IS NOT NULL),
(SELECT DISTINCT product_id FROM purchase_orders_cdc WHERE product_id IS NOT NULL) WHERE (ascii(substr(warehouse_id, 2, 1)) + ascii(substr(product_id, 2, 1))) % 5 <> 0)"""


def feed_documents(spark: SparkSession, root: str) -> DataFrame:
    """GeoJSON feeds as text, one per user: the events' features, some of them malformed."""
    e = table(spark, root, "events").withColumn("ms", F.unix_millis("ts")).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    feature = F.expr(
        """concat('{"type":"Feature","id":', CASE WHEN event_id % 41 = 0 THEN 'null' ELSE concat('"us', event_id, '"') END,
        ',"properties":{"mag":', CASE WHEN k = 7 THEN 'null' WHEN k = 8 THEN 'true' ELSE cast(value / 40 AS string) END, ',"place":', CASE WHEN k = 9 THEN '5' ELSE '"near"' END, ',"time":', CASE WHEN k = 10 THEN '"soon"' ELSE cast(ms AS string) END, ',"updated":', ms + 1000, ',"url":null},
        "geometry":', CASE WHEN event_id % 37 = 0 THEN 'null' ELSE concat('{"type":"Point","coordinates":[', user_id % 360 - 180, ',', cast(CASE WHEN k >= 97 THEN 999 ELSE k - 45 END AS string), CASE WHEN k % 3 = 0 THEN '' ELSE concat(',', k, '.5') END, ']}') END, '}')"""
    )
    # a feed has at most 500 features, whatever number of events a user has
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.collect_list(feature)), F.lit("]}"))
    number = F.row_number().over(Window.partitionBy("user_id", F.pmod(F.xxhash64("event_id"), F.lit(64))).orderBy("event_id"))
    paged = e.select("*", F.floor(number / 500).alias("page"), F.pmod(F.xxhash64("event_id"), F.lit(64)).alias("share"))
    return paged.groupBy("user_id", "share", "page").agg(whole.alias("value")).select("user_id", "value")


def polled_sql(columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT *, CASE WHEN event_id % 41 = 0 THEN NULL ELSE 'us' || event_id END AS source_event_id,
CASE WHEN event_id % 41 = 0 THEN 'feature has no string ''id''' WHEN event_id % 37 = 0 THEN '''geometry'' missing or not an object' WHEN k = 8 THEN '''magnitude'' must be a number, got True' WHEN k = 10 THEN '''time'' must be epoch milliseconds, got ''soon''' END AS problem,
CASE WHEN k IN (7, 8) THEN NULL ELSE value / 40 END AS magnitude, CASE WHEN k >= 97 THEN 999 ELSE k - 45 END AS lat, epoch_us(ts) // 1000 AS ms FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""
