"""Points in regions by crossing parity, and points within a distance of other points.

Method: the edges of every region are binned into latitude strips; a point meets the edges of its own strip only, and the
crossings of the eastward ray from the point are grouped by (point, region) and counted: odd means inside. Points on an edge are found
explicitly and count as inside (regions are closed). Within a strip, points and edges also share a longitude cell, whose
width grows towards the poles so that a small region touches a bounded number of cells. Longitudes are taken relative to the
middle of the region, modulo 360, so regions across the antimeridian need no copies of points, and a region that holds a pole
is the whole band of longitudes down to its southern (northern) edge.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.geo import EARTH_RADIUS_KM, cell_of, cell_width, cells_between, haversine_km, valid_position

#: Points per cell beyond which the cell is split.
CELL_POINTS = 20_000
CORNERS = 8


def _strip(lat: Column, strip_deg: float) -> Column:
    return F.floor(lat / F.lit(strip_deg)).cast("int")


def points_in_regions(points: DataFrame, regions: DataFrame, strip_deg: float = 0.05, cell_points: int = CELL_POINTS) -> DataFrame:
    """(pid, rid) of each point in each region.

    points: pid, plat, plon (in degrees; unique pid). regions: rid, rlon, edges - an array of (x0, y0, x1, y1), x in degrees
    east of the meridian rlon within [-180, 180], y latitude; the edges form closed rings, of which holes are just more rings.
    Points without a position on the globe, and regions with a null, are in nothing. A point on an edge or corner is inside.
    Each rid must come once. Empty tables give no rows; other columns are ignored.
    Cells with more than cell_points points are split by point, and the edges there are copied to the parts.
    """
    pts = points.where(valid_position(F.col("plat"), F.col("plon"))).select("pid", "plat", "plon")
    pts = pts.withColumn("strip", _strip(F.col("plat"), strip_deg)).withColumn("cell", cell_of(F.col("plon"), cell_width(F.col("strip"), strip_deg)))

    # an edge counts in every strip that its latitudes touch, both ends included
    low_high = lambda e: (F.least(e["y0"], e["y1"]), F.greatest(e["y0"], e["y1"]))
    cut = regions.where("rid is not null and rlon is not null and size(edges) > 0 and not exists(edges, e -> e.x0 + e.y0 + e.x1 + e.y1 is null)").select(
        "rid",
        "rlon",
        "edges",
        F.array_min(F.transform("edges", lambda e: F.least(e["x0"], e["x1"]))).alias("west"),
        F.array_max(F.transform("edges", lambda e: F.greatest(e["x0"], e["x1"]))).alias("east"),
        F.explode(F.sequence(_strip(F.array_min(F.transform("edges", lambda e: low_high(e)[0])), strip_deg), _strip(F.array_max(F.transform("edges", lambda e: low_high(e)[1])), strip_deg))).alias("strip"),
    )
    touching = F.filter("edges", lambda e: (_strip(low_high(e)[0], strip_deg) <= F.col("strip")) & (_strip(low_high(e)[1], strip_deg) >= F.col("strip")))
    cells = cells_between(F.col("rlon") + F.col("west"), F.col("rlon") + F.col("east"), cell_width(F.col("strip"), strip_deg))
    cut = cut.select("rid", "rlon", "strip", touching.alias("edges"), F.explode(cells).alias("cell"))

    # full cells: at most points / cell_points of them; left to the planner to broadcast if they are few
    full = pts.groupBy("strip", "cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_points).select("strip", "cell", F.ceil(F.col("n") / cell_points).cast("int").alias("parts"))
    pts = pts.join(full, ["strip", "cell"], "left").withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("pid"), F.coalesce("parts", F.lit(1))).cast("int"))).drop("parts")
    cut = cut.join(full, ["strip", "cell"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")

    # a point is in one strip, cell and part, and there meets all edges of a region in one row: that row is the group of the
    # crossings of its ray with the region, so they are counted without moving rows again
    x = F.pmod(F.col("plon") - F.col("rlon") + 180, F.lit(360.0)) - 180
    met = pts.join(cut, ["strip", "cell", "part"]).select("pid", "rid", "plat", x.alias("x"), "edges")
    y, x = F.col("plat"), F.col("x")

    def crossing(e: Column) -> Column:
        """Where the latitude of the point meets the edge, null for a level one."""
        return e["x0"] + (y - e["y0"]) / F.when(e["y0"] != e["y1"], e["y1"] - e["y0"]) * (e["x1"] - e["x0"])

    def crossed(e: Column) -> Column:
        low, high = low_high(e)
        return F.coalesce((y >= low) & (y < high) & (crossing(e) > x), F.lit(False))

    def on_edge(e: Column) -> Column:
        low, high = low_high(e)
        within = lambda v: (v >= F.least(e["x0"], e["x1"])) & (v <= F.greatest(e["x0"], e["x1"]))
        sides = F.abs(x) == 180  # the meridian opposite is both of its sides
        level = within(x) | (sides & within(-x))
        slope = (crossing(e) == x) | (sides & (crossing(e) == -x))
        return (y >= low) & (y <= high) & F.when(e["y0"] == e["y1"], level).otherwise(slope)

    return met.where((F.size(F.filter("edges", crossed)) % 2 == 1) | F.exists("edges", on_edge)).select("pid", "rid")


def disc_regions(centres: DataFrame, radius_km: float) -> DataFrame:
    """(rid, rlon, edges) of a polygon around each disc, as points_in_regions takes them. centres: rid, rlat, rlon.

    An octagon about the disc's box in latitude and longitude, widened by 2 % for the bend of the disc in that plane, which is about a
    fifth of reach * tan(latitude); where that may be more than 1 %, for reaches over 0.2 and beyond 75 degrees the box itself, whose half width is the disc's exact one; if the disc reaches a pole, the band of all
    longitudes. Each holds the whole disc, so an exact distance may cut it down.
    """
    reach = radius_km / EARTH_RADIUS_KM
    dy = math.degrees(reach) * 1.000001
    lat = F.col("rlat")
    polar = F.abs(lat) + dy >= 90
    dx = F.when(polar, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(reach)) / F.cos(F.radians(lat))))) * 1.000001)
    step = 2 * math.pi / CORNERS
    grow = 1.02 / math.cos(step / 2)
    octagon = [(grow * math.cos((k + 0.5) * step), grow * math.sin((k + 0.5) * step)) for k in range(CORNERS)]
    box = [(1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0)]

    def ring(corners: list[tuple[float, float]]) -> Column:
        at = [(dx * u, F.greatest(F.lit(-90.0), F.least(F.lit(90.0), lat + F.lit(dy * v)))) for u, v in corners]
        return F.array(*[F.struct(a[0].alias("x0"), a[1].alias("y0"), b[0].alias("x1"), b[1].alias("y1")) for a, b in zip(at, at[1:] + at[:1], strict=True)])

    bent = F.tan(F.radians(F.abs(lat))) * reach > 0.05
    edges = F.when(polar | bent | F.lit(reach > 0.2) | (F.abs(lat) > 75), ring(box)).otherwise(ring(octagon))
    return centres.where(valid_position(lat, F.col("rlon"))).select("rid", "rlon", edges.alias("edges"))


def near_pairs(left: DataFrame, right: DataFrame, radius_km: float) -> DataFrame:
    """(left_id, right_id) of each left row with each right row at most radius_km away, once each.

    left: left_id, lat, lon; right: right_id, lat, lon. Rows without a position on the globe are near nothing. Rows at one
    position are joined as one point and expanded at the end. Equal ids at several positions count wherever they are.
    """
    at = lambda df, i, a, b: df.where(valid_position(F.col("lat"), F.col("lon"))).select(F.col(i), (F.col("lat") + 0.0).alias(a), (F.col("lon") + 0.0).alias(b)).distinct()
    lefts, rights = at(left, "left_id", "rlat", "rlon"), at(right, "right_id", "plat", "plon")
    centres = lefts.select("rlat", "rlon").distinct().select(F.struct("rlat", "rlon").alias("rid"), "rlat", "rlon")
    points = rights.select("plat", "plon").distinct().select(F.struct("plat", "plon").alias("pid"), "plat", "plon")
    found = points_in_regions(points, disc_regions(centres, radius_km), strip_deg=max(0.02, 2 * math.degrees(radius_km / EARTH_RADIUS_KM)))
    found = found.select("pid.*", "rid.*")
    close = found.where(haversine_km(F.col("rlat"), F.col("rlon"), F.col("plat"), F.col("plon")) <= radius_km)
    return close.join(rights, ["plat", "plon"]).join(lefts, ["rlat", "rlon"]).select("left_id", "right_id").distinct()
