"""One poll of a GeoJSON feed: parse, check, leave out what was seen, remember what was delivered."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.text import isoformat_utc, marker, payload_hash
from strandline.operators.quality import ingest_reasons


def features(feeds: DataFrame, value: str = "value") -> DataFrame:
    """`feature` (variant), one row for each element of the feed's features. A feed that isn't JSON, or has no array of that
    name, fails the query."""
    elements = F.try_variant_get(F.try_parse_json(value), "$.features", "array<variant>")
    return feeds.select(F.explode(F.coalesce(elements, F.raise_error(F.lit("payload has no 'features' array")).cast("array<variant>"))).alias("feature"))


def _numeric(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)")


def _shown(value: Column, kind: Column, text: Column) -> Column:
    """A value as problem texts show it: quoted text, True, False and None; arrays and objects as JSON."""
    plain = F.replace(F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    double = text.contains("'") & ~text.contains('"')
    quoted = F.when(double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.when(kind == "STRING", quoted).when(kind == "BOOLEAN", F.initcap(value)).when(kind == "VOID", F.lit("None")).otherwise(value)


def parse_features(rows: DataFrame) -> DataFrame:
    """Feed events: source_event_id, magnitude, latitude, longitude, depth_km, place, event_time, updated_time, source_url and
    `problem`, the first thing that is structurally wrong (null: nothing), with the value that was got. rows: feature, a variant. Types are strict: numbers
    only where numbers are due (no text, no booleans); a place or url that isn't text is null; other fields are ignored.
    """
    # each path is looked up once a row and its kind told once: the rules below name them many times over
    paths = ["$", "$.id", "$.properties", "$.properties.mag", "$.properties.time", "$.properties.updated", "$.properties.place", "$.properties.url", "$.geometry", *[f"$.geometry.coordinates{i}" for i in ("", "[0]", "[1]", "[2]")]]
    rows = rows.select(*[F.try_variant_get("feature", path, "variant").alias(f"_at{n}") for n, path in enumerate(paths)])
    rows = rows.select("*", *[F.coalesce(F.schema_of_variant(f"_at{n}"), F.lit("VOID")).alias(f"_kind{n}") for n in range(len(paths))])
    at = lambda path, to: F.try_variant_get(f"_at{paths.index(path)}", "$", to)
    kind = lambda path: F.col(f"_kind{paths.index(path)}")
    text = lambda path: F.when(kind(path) == "STRING", at(path, "string"))
    number = lambda path: F.when(_numeric(kind(path)), at(path, "double"))
    event_id = text("$.id")
    bad = lambda path: ~_numeric(kind(path))
    off = lambda path: bad(path) & (kind(path) != "VOID")
    coordinates = "$.geometry.coordinates"
    got = lambda why, path: F.concat(F.lit(f"{why}, got "), _shown(at(path, "string"), kind(path), text(path)))
    # fixed values: the texts of problems
    short = ~kind(coordinates).startswith("ARRAY") | (F.coalesce(F.size(at(coordinates, "array<variant>")), F.lit(0)) < 2)
    problem = (
        F.when(~kind("$").startswith("OBJECT"), "feature is not an object")
        .when(event_id.isNull() | (event_id == ""), "feature has no string 'id'")
        .when(~kind("$.properties").startswith("OBJECT"), "'properties' missing or not an object")
        .when(~kind("$.geometry").startswith("OBJECT"), "'geometry' missing or not an object")
        .when(short, "'geometry.coordinates' must be [lon, lat, depth]")
        .when(bad(f"{coordinates}[0]"), got("'longitude' must be a number", f"{coordinates}[0]"))
        .when(bad(f"{coordinates}[1]"), got("'latitude' must be a number", f"{coordinates}[1]"))
        .when(off(f"{coordinates}[2]"), got("'depth_km' must be a number", f"{coordinates}[2]"))
        .when(off("$.properties.mag"), got("'magnitude' must be a number", "$.properties.mag"))
        .when(bad("$.properties.time"), got("'time' must be epoch milliseconds", "$.properties.time"))
        .when(bad("$.properties.updated"), got("'updated' must be epoch milliseconds", "$.properties.updated"))
    )
    moment = lambda path: F.timestamp_micros((number(path) * 1000).try_cast("long"))
    return rows.select(
        event_id.alias("source_event_id"), number("$.properties.mag").alias("magnitude"), number(f"{coordinates}[1]").alias("latitude"), number(f"{coordinates}[0]").alias("longitude"), number(f"{coordinates}[2]").alias("depth_km"), text("$.properties.place").alias("place"), moment("$.properties.time").alias("event_time"), moment("$.properties.updated").alias("updated_time"), text("$.properties.url").alias("source_url"), problem.alias("problem"),
    )


def classified(parsed: DataFrame, markers: DataFrame, now: datetime, tolerance_s: int = 300) -> DataFrame:
    """parsed with `marker`, `reasons` and `outcome`: invalid (a problem or a reason), duplicate (the marker seen last for the
    id) or new. markers: source_event_id, seen. Ids that come twice in one poll are judged by the earlier polls only."""
    fields = {c: F.col(c) for c in ("source_event_id", "magnitude", "latitude", "longitude", "depth_km", "place", "source_url")} | {c: isoformat_utc(F.col(c)) for c in ("event_time", "updated_time")}
    reasons = ingest_reasons(*[F.col(c) for c in ("source_event_id", "latitude", "longitude", "magnitude", "event_time")], now, tolerance_s)
    judged = parsed.withColumn("reasons", F.when(F.col("problem").isNotNull(), F.array("problem")).otherwise(reasons)).withColumn("marker", marker(fields["updated_time"], payload_hash(**fields)))
    seen = markers.select("source_event_id", F.col("seen").alias("_seen"))
    joined = judged.join(seen, "source_event_id", "left")
    outcome = F.when(F.size("reasons") > 0, "invalid").when(F.col("_seen").eqNullSafe(F.col("marker")), "duplicate").otherwise("new")
    return joined.withColumn("outcome", outcome).drop("_seen")


def _of_delivered(rows: DataFrame, delivered: DataFrame) -> DataFrame:
    """The rows whose id was delivered. The ids may be as many as the rows, though a column of them looks small in files: they are
    merged, never gathered on the driver for a broadcast."""
    return rows.join(delivered.select("source_event_id").distinct().hint("merge"), "source_event_id", "left_semi")


def committed(markers: DataFrame, polled: DataFrame, delivered: DataFrame) -> DataFrame:
    """Markers after a poll: those of the new events that were delivered (source_event_id) replace earlier ones; the others stay, so
    that what wasn't delivered is tried again."""
    fresh = _of_delivered(polled.where("outcome = 'new'"), delivered)
    fresh = fresh.groupBy("source_event_id").agg(F.max_by("marker", "updated_time").alias("seen"))
    kept = markers.join(fresh.hint("merge"), "source_event_id", "left_anti").select("source_event_id", "seen")
    return kept.unionByName(fresh)


def poll_stats(polled: DataFrame, delivered: DataFrame) -> DataFrame:
    """One row: fetched, produced, duplicates, invalid, undelivered."""
    sent = delivered.select("source_event_id").distinct().withColumn("_sent", F.lit(True)).hint("merge")
    rows = polled.join(sent, "source_event_id", "left")
    new = F.col("outcome") == "new"
    got = F.coalesce("_sent", F.lit(False))
    return rows.agg(F.count("*").alias("fetched"), F.count_if(new & got).alias("produced"), F.count_if(F.col("outcome") == "duplicate").alias("duplicates"), F.count_if(F.col("outcome") == "invalid").alias("invalid"), F.count_if(new & ~got).alias("undelivered"))


def cursor_max(polled: DataFrame, delivered: DataFrame, before_ms: int | None, now: datetime) -> DataFrame:
    """One row: the latest update in epoch ms among the new events that were delivered (source_event_id) and the cursor before, and
    how far it lies behind now. What wasn't delivered doesn't move the cursor past itself; null if there is neither."""
    sent = _of_delivered(polled.where("outcome = 'new'"), delivered)
    newest = F.greatest(F.max(F.unix_millis("updated_time")), F.lit(before_ms).cast("long"))
    return sent.agg(newest.alias("last_updated_ms")).withColumn("lag_ms", F.unix_millis(F.lit(now)) - F.col("last_updated_ms"))
