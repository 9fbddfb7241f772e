import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline.functions.geo import EARTH_RADIUS_KM
from strandline.operators import proximity as P


def distance(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def near_by_hand(left, right, km):
    ok = lambda r: r[1] is not None and r[2] is not None and abs(r[1]) <= 90 and abs(r[2]) <= 180
    return {(a[0], b[0]) for a in left if ok(a) for b in right if ok(b) and distance(a[1], a[2], b[1], b[2]) <= km}


CENTRES = [(0, 0), (37.4, 100), (-59.5, 179.99), (89.98, 10), (90, 0), (-90, 5), (-89.9, -170), (75.01, -180), (0.01, 180), (60, -179.99), (82, 45), (-75, 0)]


@pytest.mark.parametrize("km", [5.0, 300.0])
def test_near_pairs_everywhere(spark, km):
    rng = random.Random(4)
    spread = 4 * km / 111

    def around(n):
        out = []
        for i in range(n):
            lat, lon = CENTRES[i % len(CENTRES)]
            lat = max(-90.0, min(90.0, lat + rng.uniform(-1, 1) * spread))
            lon = (lon + rng.uniform(-1, 1) * spread / max(0.02, math.cos(math.radians(lat))) + 540) % 360 - 180
            out.append((f"r{i}", lat, lon))
        return out

    bad = [("nolat", None, 1.0), ("nolon", 1.0, None), ("far", 91.0, 0.0), ("wide", 0.0, 180.5), ("nan", float("nan"), 0.0)]
    left, right = around(240) + [("pole", 90.0, 77.0), ("r0", 0.0, 0.0)], around(240) + [("pole", 90.0, -120.0), ("anti", 0.01, -180.0), ("copy", 0.0, -0.0)]
    make = lambda rows, name: spark.createDataFrame(rows + bad, f"{name} string, lat double, lon double").withColumn("rid", F.lit("x")).withColumn("strip", F.lit("y"))
    got = [(r.left_id, r.right_id) for r in P.near_pairs(make(left, "left_id"), make(right, "right_id"), km).collect()]
    assert len(got) == len(set(got))
    assert set(got) == near_by_hand(left, right, km) and len(got) > 100


def test_full_cells_are_split(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(f"p{i}", 10 + rng.uniform(-0.03, 0.03), 20 + rng.uniform(-0.03, 0.03)) for i in range(60)]
    left, right = spark.createDataFrame(rows, "left_id string, lat double, lon double"), spark.createDataFrame(rows, "right_id string, lat double, lon double")
    original = P.points_in_regions
    monkeypatch.setattr(P, "points_in_regions", lambda *a, **k: original(*a, **k, cell_points=7))
    assert {(r.left_id, r.right_id) for r in P.near_pairs(left, right, 2.0).collect()} == near_by_hand(rows, rows, 2.0)


def ring(*corners):
    return [(float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(corners, corners[1:] + corners[:1])]


def test_regions_with_holes_edges_and_the_antimeridian(spark):
    square = ring((-2, 0), (2, 0), (2, 4), (-2, 4))
    hole = ring((-1, 1), (1, 1), (1, 3), (-1, 3))
    regions = spark.createDataFrame(
        [("plain", 10.0, square), ("holed", 10.0, square + hole), ("date", 179.0, square), ("void", 5.0, []), ("null", None, square)], "rid string, rlon double, edges array<struct<x0:double,y0:double,x1:double,y1:double>>"
    )
    points = [("in", 0.5, 9.0), ("hole", 2.0, 10.0), ("corner", 4.0, 12.0), ("edge", 2.0, 8.0), ("top", 4.0, 10.5), ("rim", 1.0, 10.0), ("out", 4.001, 10.0), ("west", 2.0, 7.99), ("over", 2.0, -179.5), ("before", 2.0, 178.0), ("beyond", 2.0, -178.9), ("none", None, 1.0)]
    got = {(r.pid, r.rid) for r in P.points_in_regions(spark.createDataFrame(points, "pid string, plat double, plon double"), regions, strip_deg=0.3).collect()}
    plain = {"in", "hole", "corner", "edge", "top", "rim"}
    assert got == {(p, "plain") for p in plain} | {(p, "holed") for p in plain - {"hole"}} | {("over", "date"), ("before", "date")}


def test_empty_sides(spark):
    none = spark.createDataFrame([], "left_id string, lat double, lon double")
    some = spark.createDataFrame([("a", 1.0, 1.0)], "right_id string, lat double, lon double")
    assert P.near_pairs(none, some, 5.0).count() == 0
    assert P.near_pairs(some.withColumnRenamed("right_id", "left_id"), some.limit(0), 5.0).count() == 0


@pytest.mark.parametrize("km", [5.0, 250.0, 4000.0, 15000.0])
def test_facilities_near_everywhere(spark, km):
    from strandline.operators.correlate import facilities_near

    rng = random.Random(6)
    spread = 3 * km / 111
    rows = []
    for i in range(180):
        lat, lon = CENTRES[i % len(CENTRES)]
        lat = max(-90.0, min(90.0, lat + rng.uniform(-1, 1) * spread))
        rows.append((f"r{i}", lat, (lon + rng.uniform(-1, 1) * spread / max(0.02, math.cos(math.radians(lat))) + 540) % 360 - 180))
    rows += [("pole", 90.0, 0.0), ("anti", 0.0, 180.0), ("same", 0.0, -180.0), ("none", None, 1.0), ("off", 99.0, 1.0)]
    ev = spark.createDataFrame([(i, (a, b)) for i, a, b in rows], "event_id string, payload struct<latitude:double,longitude:double>")
    fac = spark.createDataFrame(rows, "facility_id string, latitude double, longitude double")
    got = [(r.event_id, r.facility_id) for r in facilities_near(ev, fac, km).collect()]
    assert len(got) == len(set(got)) and set(got) == near_by_hand(rows, rows, km)


def crowded(spark):
    """Events and facilities of which many share a position, zeros of either sign and ids that are null or come twice among them."""
    rng = random.Random(9)
    spots = [(0.0, 0.0), (-0.0, 180.0), (0.3, -0.0), (0.0, -180.0), (89.9, 5.0), (None, 1.0), (float("nan"), 1.0), (99.0, 1.0)]
    ev = [(f"e{i}", (*rng.choice(spots),)) for i in range(120)]
    fac = [(rng.choice([None, *(f"f{n}" for n in range(30))]), *rng.choice(spots)) for _ in range(90)]
    pairs = [(e, f) for e, (a, b) in ev for f, c, d in fac if None not in (a, c) and abs(a) <= 90 and abs(c) <= 90 and near_by_hand([("l", a, b)], [("r", c, d)], 60.0)]
    events = spark.createDataFrame(ev, "event_id string, payload struct<latitude:double,longitude:double>")
    return events, spark.createDataFrame(fac, "facility_id string, latitude double, longitude double"), pairs


def test_events_per_facility(spark):
    from strandline.operators.correlate import events_per_facility

    events, facilities, pairs = crowded(spark)
    got = [tuple(r) for r in events_per_facility(events, facilities, 60.0).collect()]
    assert len(got) == len(set(got)) and dict(got) == Counter(f for _, f in pairs) and len(got) > 20


def test_events_of_one_place_are_counted_before_they_meet(spark):
    from strandline.operators.correlate import events_per_facility

    n = 3_000_000  # by pairs of rows: 3e10
    events = spark.range(n).selectExpr("id AS event_id", "named_struct('latitude', 1D, 'longitude', 2D) AS payload")
    facilities = spark.range(10_000).selectExpr("id AS facility_id", "1D AS latitude", "2.1D AS longitude")
    assert {r.n_events for r in events_per_facility(events, facilities, 60.0).collect()} == {n}


def test_facilities_of_one_position_meet_an_event_together(spark, monkeypatch):
    from strandline.operators import correlate

    monkeypatch.setattr(correlate, "PLACE_ROWS", 4)
    monkeypatch.setattr(correlate, "CELL_PLACES", 3)
    events, facilities, pairs = crowded(spark)
    got = correlate.facilities_near(events, facilities, 60.0, digits=3).collect()
    assert Counter((r.event_id, r.facility_id) for r in got) == Counter(pairs) and {r.distance_km for r in got} == {0.0, 33.359}


def test_events_of_one_position_are_listed_in_many_tasks(spark, monkeypatch):
    from pyspark.sql import functions as F

    from strandline.operators import correlate

    events, facilities, pairs = crowded(spark)
    monkeypatch.setattr(correlate, "EVENT_ROWS", 3)
    got = correlate.facilities_near(events, facilities, 60.0, digits=3).collect()
    assert Counter((r.event_id, r.facility_id) for r in got) == Counter(pairs)

    monkeypatch.undo()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.range(40_000).selectExpr("id AS event_id", "named_struct('latitude', 1D, 'longitude', 2D) AS payload")
        facilities = spark.range(10).selectExpr("id AS facility_id", "1D AS latitude", "2.1D AS longitude")
        sizes = [r["count"] for r in correlate.facilities_near(events, facilities, 60.0).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(sizes) == 400_000 and max(sizes) < 200_000  # in one task: all of one cell


def test_a_raw_event_is_parsed_once(spark):
    from strandline.plans.pipeline import _normalized

    near = _normalized(spark, "/root/testdata/sf0.001").where("payload.latitude >= -90 and payload.longitude <= 180")
    assert near._jdf.queryExecution().optimizedPlan().toString().count("get_json_object(") == 1


@pytest.mark.parametrize(("lat", "km"), [(74.9, 200.0), (74.9, 250.0), (-70.0, 250.0), (60.0, 500.0)])
def test_the_rim_of_a_wide_disc(spark, lat, km):
    centre = [("centre", lat, 179.0)]
    rim = []
    for i in range(360):
        a, r, p = math.radians(i), 0.9999 * km / 6371.0088, math.radians(lat)
        y = math.asin(math.sin(p) * math.cos(r) + math.cos(p) * math.sin(r) * math.cos(a))
        x = 179 + math.degrees(math.atan2(math.sin(a) * math.sin(r) * math.cos(p), math.cos(r) - math.sin(p) * math.sin(y)))
        rim.append((f"p{i}", math.degrees(y), (x + 540) % 360 - 180))
    left, right = spark.createDataFrame(centre, "left_id string, lat double, lon double"), spark.createDataFrame(rim, "right_id string, lat double, lon double")
    assert {r.right_id for r in P.near_pairs(left, right, km).collect()} == {r[0] for r in rim}
