"""Great-circle distance and impact rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: mean earth radius, the least severity and radius in km of the earthquake rule, and the radius of the wildfire rule
EARTH_RADIUS_KM = 6371.0088
QUAKE_RADII = ((7.0, 250.0), (6.0, 120.0), (5.0, 50.0))
WILDFIRE_KM = 40.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; null if any coordinate is."""
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))


def impact_radius_km(event_type: Column, severity: Column) -> Column:
    """Radius of the area an event affects; null if no rule holds, or the severity is null or NaN."""
    rule = None
    usable = (event_type == "earthquake") & ~F.isnan(severity)
    for least, radius in QUAKE_RADII:
        case = usable & (severity >= least)
        rule = F.when(case, F.lit(radius)) if rule is None else rule.when(case, F.lit(radius))
    return rule


def wildfire_radius_km(event_type: Column, confidence: Column) -> Column:
    """Radius of the area a wildfire of high confidence affects; null for others."""
    return F.when((event_type == "wildfire") & (F.lower(confidence) == "high"), F.lit(WILDFIRE_KM))


def geo_score(distance_km: Column, radius_km: Column) -> Column:
    """1 at the centre, 0 at the radius and beyond; 0 for a radius that isn't positive."""
    return F.when(radius_km <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - distance_km / radius_km)))


def valid_position(lat: Column, lon: Column) -> Column:
    """True for a position on the globe; false for null, NaN and out-of-range coordinates."""
    return F.coalesce((lat >= -90) & (lat <= 90) & (lon >= -180) & (lon <= 180), F.lit(False))


def cell_width(strip: Column, strip_deg: Column | float) -> Column:
    """Width in degrees of the longitude cells of a latitude strip: strip_deg at the equator, wider towards the poles, 360 where the
    strip reaches one."""
    high = strip_deg if isinstance(strip_deg, Column) else F.lit(strip_deg)
    far = F.least(F.lit(90.0), F.greatest(F.abs(strip * high), F.abs((strip + 1) * high)))
    return F.least(F.lit(360.0), high / F.greatest(F.cos(F.radians(far)), F.lit(1e-9)))


def cell_of(longitude: Column, width: Column) -> Column:
    """Cell of a longitude, counted from the antimeridian; 180 and -180 are one meridian."""
    return F.floor(F.pmod(longitude + 180, F.lit(360.0)) / width).cast("int")


def cells_between(west: Column, east: Column, width: Column) -> Column:
    """All cells from one longitude eastward to another, each once. west may lie below -180 and east at 180 or beyond: there the
    range wraps around. A hair is added at either end to make up for rounding."""
    low, high = west + (180 - 1e-7), east + (180 + 1e-7)
    count = F.ceil(F.lit(360.0) / width)
    at = lambda degrees: F.floor(degrees / width)
    none = F.array().cast("array<bigint>")
    inside = F.sequence(at(F.least(F.greatest(low, F.lit(0.0)), F.lit(360 - 1e-9))), at(F.greatest(F.least(high, F.lit(360 - 1e-9)), F.lit(0.0))))
    before = F.when(low < 0, F.sequence(at(F.greatest(low + 360, F.lit(0.0))), count - 1)).otherwise(none)
    beyond = F.when(high >= 360, F.sequence(F.lit(0).cast("bigint"), F.least(at(high - 360), count - 1))).otherwise(none)
    return F.array_distinct(F.concat(inside, before, beyond)).cast("array<int>")
