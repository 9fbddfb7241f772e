"""Impact candidates: events with the facilities within their radius.

Events meet the facilities of nearby cells only, in an equi-join: a cell is a latitude band, a little wider than the radius, cut at
longitudes as far apart, and each class of radii has cells of its own size. Cells full of facilities are split. Neither side is
broadcast by force nor compared with all of the other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.geo import EARTH_RADIUS_KM, QUAKE_RADII, cell_of, cell_width, cells_between, geo_score, haversine_km, impact_radius_km, valid_position
from strandline.functions.text import impact_id
from strandline.operators.proximity import points_in_regions
from strandline.operators.sliced import Carry, slice_width, sliced, with_carried
from strandline.session import stored

#: arrivals of one slice of a facility's updates
SLICE_SEQS = 1_000_000

KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180


def with_radius(events: DataFrame) -> DataFrame:
    """The events for which a radius rule holds, with `radius_km`."""
    radius = impact_radius_km(F.col("event_type"), F.col("payload.severity"))
    return events.withColumn("radius_km", radius).where("radius_km is not null")


#: Right rows per cell beyond which the cell is split.
CELL_ROWS = 20_000


def cell_join(left: DataFrame, right: DataFrame, left_at: tuple[str, str], right_at: tuple[str, str], reaches_km: Sequence[float], within: Column, extra: Column | None = None, cell_rows: int = CELL_ROWS, tasks: int | None = None) -> DataFrame:
    """left x right rows with `distance_km` at most `within`, which must never exceed the greatest of reaches_km. Rows without a
    position on the globe, and left rows without a `within`, meet nothing.

    reaches_km are the classes: a left row is in the class of the least reach that is not below its `within`, and is copied to its
    band there and the two beside it, and in each to the cells that points within reach can lie in: two or three, more only
    around the poles. A right row is in one cell of each class. Cells with more than cell_rows right rows are split by those, and
    left rows are copied to the parts; left rows of one cell that are too many for a task are the planner's to split (skew join).
    """
    reaches = sorted({float(r) for r in reaches_km})
    lat, lon = F.col(left_at[0]), F.col(left_at[1])
    widths = F.array(*[F.lit(r / KM_PER_DEGREE * 1.01) for r in reaches])
    sines = F.array(*[F.lit(math.sin(min(math.pi / 2, r / EARTH_RADIUS_KM / 2))) for r in reaches])
    width, reach = widths[F.col("_class")], sines[F.col("_class")]
    band = lambda latitude: F.floor(latitude / width).cast("int")
    chosen = F.coalesce(*[F.when(within <= r, n) for n, r in enumerate(reaches)])
    near = left.where(valid_position(lat, lon)).withColumn("_class", chosen).where("_class is not null")
    near = near.withColumn("_band", F.explode(F.array(*[band(lat) + d for d in (-1, 0, 1)])))
    # two points of these bands within reach differ by no more than this in longitude
    far = F.least(F.lit(90.0), F.greatest(F.abs(F.col("_band") * width), F.abs((F.col("_band") + 1) * width)) + width)
    half = F.asin(F.least(F.lit(1.0), reach / F.greatest(F.cos(F.radians(far)), F.lit(1e-9))))
    spread = F.degrees(half * 2) * 1.000001
    near = near.withColumn("_cell", F.explode(cells_between(lon - spread, lon + spread, cell_width(F.col("_band"), width))))

    there = right.where(valid_position(F.col(right_at[0]), F.col(right_at[1]))).withColumn("_class", F.explode(F.array(*[F.lit(n) for n in range(len(reaches))])))
    there = there.withColumn("_band", band(F.col(right_at[0]))).withColumn("_cell", cell_of(F.col(right_at[1]), cell_width(F.col("_band"), width)))
    place = ["_class", "_band", "_cell"]
    # at most right rows / cell_rows of them; left to the planner to broadcast if they are few
    full = there.groupBy(*place).agg(F.count("*").alias("_n")).where(F.col("_n") > cell_rows).select(*place, F.ceil(F.col("_n") / cell_rows).cast("int").alias("_parts"))
    there = there.join(full, place, "left").withColumn("_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*right.columns), F.coalesce("_parts", F.lit(1))).cast("int"))).drop("_parts")
    near = near.join(full, place, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    if tasks:  # a class that is the only one is no key of the join, as the optimizer sees it
        keys = [*place[len(reaches) == 1 :], "_part"]
        near, there = near.repartition(tasks, *keys), there.repartition(tasks, *keys)
    met = near.join(there, [*place, "_part"])
    met = met if extra is None else met.where(extra)
    distance = haversine_km(lat, lon, F.col(right_at[0]), F.col(right_at[1]))
    return met.withColumn("distance_km", distance).where(F.col("distance_km") <= within).drop(*place, "_part")


def _sides(events: DataFrame, facilities: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    own = [c for c in ("event_id", "source", "source_event_id", "event_type", "event_time", "trace_id", "tenant_id", "seq") if c in events.columns]
    left = with_radius(events).select(*own, "radius_km", F.col("payload.severity").alias("severity"), F.col("payload.latitude").alias("event_latitude"), F.col("payload.longitude").alias("event_longitude"))
    right = facilities.select(F.col("facility_id").alias("asset_id"), "supplier_id", F.col("latitude").alias("asset_latitude"), F.col("longitude").alias("asset_longitude"), *more)
    return left, right


def _candidates(met: DataFrame, now: datetime) -> DataFrame:
    own = [c for c in ("event_id", "source", "source_event_id", "event_type", "event_time", "trace_id", "tenant_id", "seq") if c in met.columns]
    return met.select(
        impact_id(F.col("source_event_id"), F.col("asset_id")).alias("impact_id"), *own, F.lit("facility").alias("asset_type"), "asset_id", "supplier_id", "event_latitude", "event_longitude", "asset_latitude", "asset_longitude", "distance_km", "radius_km", (F.col("distance_km") <= F.col("radius_km")).alias("inside_affected_area"), "severity", geo_score(F.col("distance_km"), F.col("radius_km")).alias("geospatial_score"), F.lit(now).alias("calculated_at"),
    )


AT = (("event_latitude", "event_longitude"), ("asset_latitude", "asset_longitude"))
REACHES_KM = tuple(r for _, r in QUAKE_RADII)


def correlate(events: DataFrame, facilities: DataFrame, now: datetime) -> DataFrame:
    """Candidates of each event with each facility at most the event's radius away. Facilities of any status count; rows
    without a position, and events without a radius, give nothing; repeated events give repeated candidates."""
    left, right = _sides(events, facilities)
    return _candidates(cell_join(left, right, *AT, REACHES_KM, F.col("radius_km")), now)


def facility_periods(updates: DataFrame) -> DataFrame:
    """facility rows with [from_seq, to_seq): from each update to the next one of the facility; deletes end a period and start
    none. updates: facility_id, supplier_id, latitude, longitude, deleted, seq. A facility with many updates is cut into slices."""
    known, part = sliced(updates.where("facility_id is not null"), "seq", SLICE_SEQS if slice_width(updates) else 0, "_part")
    known = with_carried(known, ["facility_id"], part, [Carry("_next", F.min("seq"), "last", back=True)])
    w = Window.partitionBy("facility_id", *part).orderBy("seq")
    ended = known.withColumn("to_seq", F.coalesce(F.lead("seq").over(w), "_next")).withColumnRenamed("seq", "from_seq")
    return ended.where("not deleted").drop("deleted", "_part", "_next")


def correlate_asof(events: DataFrame, updates: DataFrame, now: datetime) -> DataFrame:
    """Candidates with the facilities as known when the event arrived; later updates don't change earlier candidates.
    events: with seq on the same scale of arrival as updates."""
    left, right = _sides(events, facility_periods(updates), "from_seq", "to_seq")
    known = (F.col("seq") >= F.col("from_seq")) & (F.col("to_seq").isNull() | (F.col("seq") < F.col("to_seq")))
    return _candidates(cell_join(left, right, *AT, REACHES_KM, F.col("radius_km"), known), now)


def _positions(events: DataFrame, facilities: DataFrame) -> tuple[DataFrame, DataFrame]:
    left = events.select("event_id", F.col("payload.latitude").alias("event_latitude"), F.col("payload.longitude").alias("event_longitude"))
    right = facilities.select("facility_id", F.col("latitude").alias("asset_latitude"), F.col("longitude").alias("asset_longitude"))
    return left, right


#: events, and facilities, of one position that are listed in one row; event lists per cell beyond which the cell is split; tasks of
#: the last stage for each shuffle partition, as it gives many more rows than it reads
EVENT_ROWS, PLACE_ROWS, CELL_PLACES, LIST_TASKS = 16, 500, 200, 8


def _listed(rows: DataFrame, key: str, at: tuple[str, str], most: int) -> DataFrame:
    """(at, `_<key>s`): the keys of each position on the globe in lists of at most so many; null keys are kept."""
    known = rows.where(valid_position(*[F.col(c) for c in at])).select(key, *at)
    number = F.row_number().over(Window.partitionBy(*at).orderBy(key))
    return known.withColumn("_list", F.floor((number - 1) / most)).groupBy(*at, "_list").agg(F.collect_list(F.struct(key)).alias(f"_{key}s")).drop("_list")


def facilities_near(events: DataFrame, facilities: DataFrame, radius_km: float, digits: int | None = None) -> DataFrame:
    """(event_id, facility_id, distance_km) within one radius, in either direction of looking; the distance to so many decimals.
    Events of one position and facilities of one meet in lists: the distance is told once for all pairs of two lists. Facilities, of
    which there are fewer, are copied to the cells around them, and events are not."""
    left, right = _positions(events, facilities)
    listed = stored(_listed(left, "event_id", AT[0], EVENT_ROWS), "events-listed")  # counted by cell first
    there = _listed(right, "facility_id", AT[1], PLACE_ROWS)
    tasks = LIST_TASKS * int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = cell_join(there, listed, AT[1], AT[0], (radius_km,), F.lit(radius_km), cell_rows=CELL_PLACES, tasks=tasks)
    distance = F.col("distance_km") if digits is None else F.round("distance_km", digits)
    met = met.select(distance.alias("distance_km"), "_event_ids", "_facility_ids").select(F.inline("_event_ids"), "_facility_ids", "distance_km")
    return met.select("event_id", F.inline("_facility_ids"), "distance_km")


def events_per_facility(events: DataFrame, facilities: DataFrame, radius_km: float) -> DataFrame:
    """(facility_id, n_events): the number of events within one radius; facilities without any have no row. Events of one position,
    and facilities of one, are counted before they meet: pairs of positions are compared, not pairs of rows."""
    left, right = _positions(events, facilities)
    left = left.groupBy(*AT[0]).agg(F.count("*").alias("_events"))
    near = cell_join(left, right.select(*AT[1]).distinct(), *AT, (radius_km,), F.lit(radius_km)).groupBy(*AT[1]).agg(F.sum("_events").alias("_events"))
    return right.join(near, list(AT[1])).groupBy("facility_id").agg(F.sum("_events").alias("n_events"))


def correlate_regions(events: DataFrame, facilities: DataFrame, now: datetime) -> DataFrame:
    """Candidates of each flood of alert red with each facility in its region; they have no distance and no radius, and the score 1.

    events: as correlate takes them, with `alert` and `region` - a struct of rlon and edges as proximity.points_in_regions takes
    them; unique event_id. Facilities on the region's border are in it.
    """
    floods = events.where("event_type = 'flood' and lower(alert) = 'red' and region is not null")
    inside = points_in_regions(
        facilities.select(F.col("facility_id").alias("pid"), F.col("latitude").alias("plat"), F.col("longitude").alias("plon")),
        floods.select(F.col("event_id").alias("rid"), F.col("region.rlon").alias("rlon"), F.col("region.edges").alias("edges")),
    ).select(F.col("rid").alias("event_id"), F.col("pid").alias("asset_id"))
    own = [c for c in ("event_id", "source", "source_event_id", "event_type", "event_time", "trace_id", "tenant_id", "seq") if c in events.columns]
    left = floods.select(*own, F.col("payload.severity").alias("severity"), F.col("payload.latitude").alias("event_latitude"), F.col("payload.longitude").alias("event_longitude"))
    right = facilities.select(F.col("facility_id").alias("asset_id"), "supplier_id", F.col("latitude").alias("asset_latitude"), F.col("longitude").alias("asset_longitude"))
    met = inside.join(left, "event_id").join(right, "asset_id").withColumns({"distance_km": F.lit(None).cast("double"), "radius_km": F.lit(None).cast("double")})
    return _candidates(met, now).withColumns({"inside_affected_area": F.lit(True), "geospatial_score": F.lit(1.0)})
