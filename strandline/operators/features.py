"""Operational context of impact candidates, and lookups on the operational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.text import inventory_days_remaining


def active_shipments(shipments: DataFrame) -> DataFrame:
    """Shipments under way: neither delivered nor cancelled; a null status doesn't count as under way."""
    return shipments.where(~F.col("status").isin("delivered", "cancelled"))


def feature_build(impacts: DataFrame, suppliers: DataFrame, orders: DataFrame, shipments: DataFrame, confirmations: DataFrame) -> DataFrame:
    """Per impact_id: supplier criticality, value and count of open orders, count and value of active shipments, distinct sources.

    impacts: impact_id, event_id, asset_id, supplier_id, source_event_id (the latest row per impact_id). Each branch is
    aggregated by its key before it is joined, so nothing fans out. The ids are rows of shipment_ids and order_ids.
    """
    open_orders = orders.where("status = 'open'").groupBy("supplier_id").agg(F.round(F.sum(F.col("quantity") * F.col("unit_price")), 4).alias("open_order_value"), F.count("*").alias("open_order_count"))
    moving = active_shipments(shipments).groupBy(F.col("origin_facility_id").alias("asset_id")).agg(F.count("*").alias("active_shipment_count"), F.round(F.sum("shipment_value"), 2).alias("active_shipment_value"))
    sources = confirmations.groupBy("source_event_id").agg(F.countDistinct("source").alias("source_confirmation_count"))
    criticality = suppliers.select("supplier_id", F.col("criticality_score").alias("supplier_criticality"))
    out = impacts.select("impact_id", "event_id", "asset_id", "supplier_id", "source_event_id")
    for side, key in ((criticality, "supplier_id"), (open_orders, "supplier_id"), (moving, "asset_id"), (sources, "source_event_id")):
        out = out.join(side, key, "left")
    return out.fillna(0, ["open_order_value", "open_order_count", "active_shipment_count", "active_shipment_value", "source_confirmation_count"])


def stock_exposure(shipments: DataFrame, orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """(asset_id, inventory_days_remaining, products) of each facility with active shipments: the fewest days that the stock of a
    product under way lasts in the warehouse it goes to, and the number of different products under way. Null days where no
    stock is known.

    shipments: status, origin_facility_id, purchase_order_id, destination_warehouse_id; orders: purchase_order_id, product_id;
    inventory: warehouse_id, product_id, quantity_on_hand, average_daily_usage. Equal (facility, product, warehouse) are
    collapsed before the stock is joined.
    """
    product = orders.select("purchase_order_id", "product_id").where("product_id is not null")
    moving = active_shipments(shipments).select(F.col("origin_facility_id").alias("asset_id"), "purchase_order_id", F.col("destination_warehouse_id").alias("warehouse_id")).where("asset_id is not null")
    goods = moving.join(product, "purchase_order_id").select("asset_id", "product_id", "warehouse_id").distinct()
    days = inventory.select("warehouse_id", "product_id", inventory_days_remaining(F.col("quantity_on_hand"), F.col("average_daily_usage")).alias("_days"))
    held = goods.join(days, ["warehouse_id", "product_id"], "left").groupBy("asset_id", "product_id").agg(F.min("_days").alias("_days"))
    return held.groupBy("asset_id").agg(F.min("_days").alias("inventory_days_remaining"), F.count("*").alias("products"))


def alternative_suppliers(orders: DataFrame) -> DataFrame:
    """(supplier_id, alternative_supplier_count) of suppliers with open orders: over the products ordered of it, the fewest other
    suppliers of whom the same product is on order. orders: status, supplier_id, product_id."""
    pairs = orders.where("status = 'open' and supplier_id is not null and product_id is not null").select("supplier_id", "product_id").distinct()
    others = pairs.groupBy("product_id").agg((F.count("*") - 1).alias("_others"))
    return pairs.join(others, "product_id").groupBy("supplier_id").agg(F.min("_others").alias("alternative_supplier_count"))


def inventory_exposure(inventory: DataFrame, most_days: float, limit: int = 50) -> DataFrame:
    """The stock that lasts at most most_days, the shortest first, at most `limit` rows; ties by warehouse and product."""
    rows = inventory.withColumn("days", inventory_days_remaining(F.col("quantity_on_hand"), F.col("average_daily_usage"))).where(F.col("days") <= most_days)
    return rows.orderBy("days", "warehouse_id", "product_id").limit(limit).select("warehouse_id", "product_id", "days")


def open_orders(orders: DataFrame, suppliers: DataFrame, limit: int = 50) -> DataFrame:
    """The open orders of the suppliers (supplier_id), the most urgent first, at most `limit`; orders without a date come last."""
    own = orders.where("status = 'open'").join(suppliers.select("supplier_id").distinct(), "supplier_id", "left_semi")
    return own.select("purchase_order_id", "supplier_id", "required_by_date").orderBy(F.col("required_by_date").asc_nulls_last(), "purchase_order_id").limit(limit)


def top_factors(parts: dict[str, Column], k: int) -> Column:
    """The k greatest contributions as an array of (feature, contribution), the greatest first; ties by name, nulls left out."""
    named = F.array_compact(F.array(*[F.when(c.isNotNull(), F.struct((-c).alias("order"), F.lit(n).alias("feature"), c.alias("contribution"))) for n, c in sorted(parts.items())]))
    return F.transform(F.slice(F.sort_array(named), 1, k), lambda x: F.struct(x["feature"].alias("feature"), x["contribution"].alias("contribution")))


def shipment_ids(impacts: DataFrame, shipments: DataFrame) -> DataFrame:
    """(impact_id, shipment_id) of the active shipments from the facility of each impact: one row each instead of one list."""
    moving = active_shipments(shipments).select(F.col("origin_facility_id").alias("asset_id"), "shipment_id")
    return impacts.select("impact_id", "asset_id").distinct().join(moving, "asset_id").select("impact_id", "shipment_id")


def order_ids(impacts: DataFrame, orders: DataFrame) -> DataFrame:
    """(supplier_id, purchase_order_id) of the open orders of each affected supplier. An impact's orders are those of its
    supplier, once for all its impacts: repeated for each they would grow with impacts times orders."""
    hit = impacts.select("supplier_id").distinct()
    return orders.where("status = 'open'").join(hit, "supplier_id", "left_semi").select("supplier_id", "purchase_order_id")


def affected_shipments(impacts: DataFrame, shipments: DataFrame, limit: int = 50) -> DataFrame:
    """The most valuable active shipments from affected facilities, at most `limit`; shipment_id breaks ties."""
    hit = active_shipments(shipments).join(impacts.select(F.col("asset_id").alias("origin_facility_id")).distinct(), "origin_facility_id", "left_semi")
    return hit.select("shipment_id", "supplier_id", "shipment_value").orderBy(F.col("shipment_value").desc_nulls_last(), "shipment_id").limit(limit)


def page(rows: DataFrame, order: Sequence[Column | str], number: int, size: int) -> DataFrame:
    """Page `number` (from 0) of `size` rows in an order that must be total."""
    return rows.orderBy(*order).offset(number * size).limit(size)


def sample_half(rows: DataFrame, seed: int = 0, bins: int = 4096) -> DataFrame:
    """A random half of the rows without replacement, rounded down, but at least one row of a table that has any.

    Rows are in the order of a hash with the seed, cut into equal bins: those of the lower bins are taken without moving them,
    and only of the one bin in which the half ends the first few are looked for. Equal rows are interchangeable.
    """
    at = F.pmod(F.xxhash64(F.lit(seed), *rows.columns), F.lit(1 << 40))
    placed = rows.withColumn("_at", at).withColumn("_bin", F.floor(F.col("_at") / F.lit((1 << 40) // bins)).cast("int"))
    counts = sorted((r["_bin"], r["n"]) for r in placed.groupBy("_bin").agg(F.count("*").alias("n")).collect())  # at most `bins` rows
    left = max(1, sum(n for _, n in counts) // 2) if counts else 0
    last = -1
    for last, n in counts:
        if n >= left:
            break
        left -= n
    whole = placed.where(F.col("_bin") < last)
    return whole.unionByName(placed.where(F.col("_bin") == last).orderBy("_at").limit(left)).select(*rows.columns)


def without_parent(rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference has no parent row."""
    return rows.where(F.col(column).isNotNull()).join(parents.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def latency(rows: DataFrame, start: str, end: str, by: Sequence[str], quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Quantiles of end - start in seconds by group, with the count. Latencies are taken in whole milliseconds and counted first, so
    that a group's state is as small as its number of different milliseconds."""
    ms = F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1000)
    counted = rows.groupBy(*by, ms.alias("_ms")).agg(F.count("*").alias("_n")).where("_ms is not null")
    named = [F.round(F.percentile(F.col("_ms"), q, F.col("_n")) / 1000, 6).alias(f"p{round(q * 100)}_s") for q in quantiles]
    return counted.groupBy(*by).agg(F.sum("_n").alias("n"), *named)


#: fixed values: upper bounds in seconds of the latency histogram
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 8.0, 10.0)


def latency_histogram(rows: DataFrame, start: str, end: str) -> DataFrame:
    """(le_s, n): latencies up to each bound, cumulative; le_s null counts all."""
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / 1e6
    counts = F.array(*[F.struct(F.lit(b).alias("le_s"), F.count_if(seconds <= b).alias("n")) for b in LATENCY_BUCKETS], F.struct(F.lit(None).cast("double").alias("le_s"), F.count(seconds).alias("n")))
    return rows.agg(counts.alias("h")).select(F.inline("h"))


def normalized_name(name: Column) -> Column:
    """Lower case, one space between words, no punctuation."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N} ]+", " "), " +", " "))


def _pieces(name: Column, most_edits: int) -> Column:
    """most_edits + 1 consecutive pieces of a name with their numbers, of equal length up to one letter."""
    n, parts = F.length(name), most_edits + 1
    start = lambda i: F.floor(n * i / parts).cast("int")
    return F.array(*[F.struct(F.lit(i).alias("i"), name.substr(start(i) + 1, start(i + 1) - start(i)).alias("piece")) for i in range(parts)])


def near_names(open_: DataFrame, names: DataFrame, most_edits: int) -> DataFrame:
    """(_name, _other, _id, _d) of each _name of open_ with each name of names (_other, _id) at most most_edits edits away, once each.

    Complete: edits touch at most most_edits of the most_edits + 1 pieces of _other, so one piece stands unchanged in _name, moved by
    at most most_edits places. Pairs are joined on length of _other, number of the piece and the piece, and then held against
    the exact distance.
    """
    shift = F.sequence(F.lit(-most_edits), F.lit(most_edits))
    own = names.select("_other", "_id", F.length("_other").alias("_len"), F.inline(_pieces(F.col("_other"), most_edits)))
    # of _name, what stands where a piece of a name of each possible length would be
    asked = open_.select("_name", F.explode(F.transform(shift, lambda d: F.length("_name") + d)).alias("_len")).where("_len > 0")
    start = lambda i: F.floor(F.col("_len") * F.col(i) / (most_edits + 1)).cast("int")
    asked = asked.select("_name", "_len", F.explode(F.sequence(F.lit(0), F.lit(most_edits))).alias("i")).withColumn("_from", start("i"))
    asked = asked.withColumn("_size", F.floor(F.col("_len") * (F.col("i") + 1) / (most_edits + 1)).cast("int") - F.col("_from"))
    asked = asked.select("_name", "_len", "i", "_size", F.explode(F.transform(shift, lambda d: F.col("_from") + d)).alias("_at")).where("_at >= 0")
    asked = asked.select("_name", "_len", "i", F.col("_name").substr(F.col("_at") + 1, F.col("_size")).alias("piece")).distinct()
    pairs = asked.join(own, ["_len", "i", "piece"]).select("_name", "_other", "_id").distinct()
    return pairs.withColumn("_d", F.levenshtein("_name", "_other", most_edits)).where("_d >= 0")


def link_entities(mentions: DataFrame, aliases: DataFrame, most_edits: int = 2) -> DataFrame:
    """mentions with entity_id and how (exact, near or null): by normalized name, else by the nearest name at most most_edits
    edits away, ties to the smallest entity_id. Unknown names stay unlinked.

    mentions: mention; aliases: entity_id, alias. The nearest name is kept by an aggregate per distinct unlinked name.
    """
    names = aliases.select("entity_id", normalized_name(F.col("alias")).alias("_name")).where("_name <> ''").groupBy("_name").agg(F.min("entity_id").alias("entity_id"))
    asked = mentions.withColumn("_name", normalized_name(F.col("mention")))
    exact = asked.join(names, "_name", "left")
    open_ = exact.where("entity_id is null and _name <> ''").select("_name").distinct()
    near = near_names(open_, names.select(F.col("_name").alias("_other"), F.col("entity_id").alias("_id")), most_edits).groupBy("_name").agg(F.min(F.struct("_d", "_id")).alias("_best"))
    linked = exact.join(near, "_name", "left")
    how = F.when(F.col("entity_id").isNotNull(), "exact").when(F.col("_best").isNotNull(), "near")
    return linked.select(*mentions.columns, F.coalesce("entity_id", "_best._id").alias("entity_id"), how.alias("how"))


def named_entities(texts: DataFrame, aliases: DataFrame, most_words: int = 5) -> DataFrame:
    """(doc_id, mention, entity_id) of each different name of aliases (entity_id, alias) that stands in a text (doc_id, text), word for
    word after normalization; names of more than most_words words are left out. The smallest entity_id has the name.

    Runs of words of each text are joined with the names, so cost is in proportion to the texts' words. Null texts name nothing.
    """
    names = aliases.select("entity_id", normalized_name(F.col("alias")).alias("mention")).where(f"mention <> '' and size(split(mention, ' ')) <= {most_words}")
    names = names.groupBy("mention").agg(F.min("entity_id").alias("entity_id"))
    words = F.split(normalized_name(F.col("text")), " ")
    starts = F.sequence(F.lit(1), F.size("_w"))
    runs = F.flatten(F.transform(starts, lambda at: F.transform(F.sequence(F.lit(1), F.least(F.lit(most_words), F.size("_w") - at + 1)), lambda n: F.concat_ws(" ", F.slice("_w", at, n)))))
    spoken = texts.where("text is not null").select("doc_id", words.alias("_w")).select("doc_id", F.explode(F.array_distinct(runs)).alias("mention"))
    return spoken.join(names, "mention").select("doc_id", "mention", "entity_id").distinct()


def categorized(texts: DataFrame, categories: dict[str, str]) -> DataFrame:
    """texts (text) with `category`: the first of categories (name: pattern over lower-case text) that is found; null if none is."""
    cases = [F.when(F.lower("text").rlike(pattern), F.lit(name)) for name, pattern in categories.items()]
    return texts.withColumn("category", F.coalesce(*cases))


def enriched(texts: DataFrame, categories: dict[str, str], aliases: DataFrame) -> DataFrame:
    """(doc_id, category, mention, entity_id): classified texts with the entities they name, one row each; mention is null where a
    text names none."""
    found = categorized(texts.select("doc_id", "text"), categories).select("doc_id", "category")
    return found.join(named_entities(texts, aliases), "doc_id", "left")


def retry_envelopes(failed: DataFrame, now_ms: int, base_s: float = 1.0, most_s: float = 60.0, attempts: int = 4) -> DataFrame:
    """failed (attempt, last_error, error_type, ...) with next_retry_at_ms and route: retry, or dead_letter after the last attempt."""
    from strandline.functions.text import retry_delay

    route = F.when(F.col("attempt") >= attempts, "dead_letter").otherwise("retry")
    due = F.lit(now_ms) + (retry_delay(F.col("attempt"), base_s, most_s) * 1000).cast("long")
    return failed.withColumn("route", route).withColumn("next_retry_at_ms", F.when(F.col("route") == "retry", due))
