import math
import random
import uuid
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from strandline import config, schemas
from strandline.functions import geo, text
from strandline.operators import correlate, dedup, features, ingest, quality, retrieval, state
from strandline.sources import logs

NOW = datetime(2026, 7, 1, tzinfo=timezone.utc)


def raw(spark, **change):
    base = {"seq": 1, "event_id": "m1", "event_type": "raw", "event_version": 1, "source": "drv", "source_event_id": "ev-77", "source_version": "v", "event_time": NOW - timedelta(minutes=10), "ingested_at": NOW, "trace_id": "t", "correlation_id": None, "tenant_id": "demo"}
    payload = {"latitude": -12.4, "longitude": 96.8, "magnitude": 5.7, "depth_km": 44.5, "place": None, "source_url": None}
    payload |= {k: change.pop(k) for k in list(change) if k in payload}
    row = base | change | {"payload": Row(**payload)}
    return spark.createDataFrame([Row(**row)], "seq long, event_id string, event_type string, event_version int, source string, source_event_id string, source_version string, event_time timestamp, ingested_at timestamp, trace_id string, correlation_id string, tenant_id string, payload struct<latitude:double,longitude:double,magnitude:double,depth_km:double,place:string,source_url:string>")


def reasons(df):
    return quality.checked(df, NOW).collect()[0].reasons


def test_normalize_reasons(spark):
    assert reasons(raw(spark)) == []
    assert reasons(raw(spark, magnitude=None)) == []
    assert reasons(raw(spark, magnitude=float("nan"))) == []
    assert reasons(raw(spark, magnitude=42.0)) == ["magnitude_out_of_range"]
    assert reasons(raw(spark, latitude=200.0, longitude=999.0)) == ["latitude_out_of_range", "longitude_out_of_range"]
    assert reasons(raw(spark, latitude=None)) == ["latitude_out_of_range"]
    assert reasons(raw(spark, event_time=NOW + timedelta(hours=5))) == ["event_time_in_future"]
    assert reasons(raw(spark, event_time=NOW + timedelta(hours=1))) == []
    assert reasons(raw(spark, source_event_id="  ", latitude=91.0)) == ["missing_source_event_id", "latitude_out_of_range"]
    assert reasons(raw(spark, source_event_id="\t\n")) == ["missing_source_event_id"]


def test_normalized_and_violation(spark):
    n = quality.normalized(quality.checked(raw(spark, magnitude=None), NOW), NOW).collect()[0]
    assert (n.event_type, n.payload.severity, n.payload.severity_scale, n.payload.status, n.payload.depth_km) == ("earthquake", None, None, "active", 44.5)
    assert quality.normalized(quality.checked(raw(spark), NOW), NOW).collect()[0].payload.severity_scale == "magnitude_mw"
    v = quality.violations(quality.checked(raw(spark, source_event_id=" ", latitude=99.0), NOW), NOW).collect()[0]
    assert (v.source, v.source_event_id, v.payload.source_event_id, v.payload.origin_source) == ("external-event-normalizer", "unknown", None, "drv")
    assert v.payload.reasons == ["missing_source_event_id", "latitude_out_of_range"] and '"latitude":99.0' in v.payload.raw


def test_ingest_reasons(spark):
    def why(i="x", lat=1.0, lon=1.0, mag=1.0, at=NOW):
        row = spark.createDataFrame([(i, lat, lon, mag, at)], "i string, lat double, lon double, mag double, at timestamp")
        return row.select(quality.ingest_reasons(*[F.col(c) for c in ("i", "lat", "lon", "mag", "at")], NOW).alias("r")).collect()[0].r

    assert why() == [] and why(i="  ") == []
    assert why(i="") == ["source_event_id is empty"]
    assert why(lat=999.0, mag=None) == ["latitude 999.0 out of range [-90, 90]", "magnitude is missing"]
    assert why(lon=float("nan")) == ["longitude NaN out of range [-180, 180]"]
    assert why(mag=12.5) == ["magnitude 12.5 out of range [-2.0, 12.0]"]
    assert why(at=NOW + timedelta(seconds=300)) == [] and len(why(at=NOW + timedelta(seconds=301))) == 1


FEED = """{"features":[
{"type":"Feature","id":"ev-good","properties":{"mag":5.4,"place":"p","time":1782889200000,"updated":1782889275000,"url":"u"},"geometry":{"coordinates":[-70.3,-22.9,61.0]}},
{"id":"ev-small","properties":{"mag":-1.1,"place":12,"time":1782890000000,"updated":1782890000000},"geometry":{"coordinates":[14.2,40.8,2.5]}},
{"id":"ev-off","properties":{"mag":3.1,"time":1782891000000,"updated":1782891000000},"geometry":{"coordinates":[25.0,-140.5,9.0]}},
{"id":"ev-nowhere","properties":{"mag":2.7,"time":1782892000000,"updated":1782892000000},"geometry":null}]}"""
LATER = datetime(2026, 7, 1, 12, tzinfo=timezone.utc)


def poll(spark, feed, markers):
    parsed = ingest.parse_features(ingest.features(spark.createDataFrame([(feed,)], "value string")))
    return ingest.classified(parsed, markers, LATER)


def test_polls(spark):
    none = spark.createDataFrame([], "source_event_id string, seen string")
    first = poll(spark, FEED, none)
    by = {r.source_event_id: r for r in first.collect()}
    assert {k: r.outcome for k, r in by.items()} == {"ev-good": "new", "ev-small": "new", "ev-off": "invalid", "ev-nowhere": "invalid"}
    assert by["ev-good"].marker.startswith("2026-07-01T07:01:15Z:") and by["ev-small"].place is None and by["ev-nowhere"].problem.startswith("'geometry'")
    all_ = first.select("source_event_id")
    assert tuple(ingest.poll_stats(first, all_).collect()[0]) == (4, 2, 0, 2, 0)
    again = poll(spark, FEED, ingest.committed(none, first, all_))
    assert tuple(ingest.poll_stats(again, all_).collect()[0]) == (4, 0, 2, 2, 0)
    nobody = all_.limit(0)
    assert tuple(ingest.poll_stats(first, nobody).collect()[0]) == (4, 0, 0, 2, 2)
    retry = poll(spark, FEED, ingest.committed(none, first, nobody))
    assert tuple(ingest.poll_stats(retry, all_).collect()[0]) == (4, 2, 0, 2, 0)
    cursor = lambda sent, before: ingest.cursor_max(first, sent, before, LATER).collect()[0].last_updated_ms
    assert cursor(all_, None) == 1782890000000 and cursor(all_, 1782890000001) == 1782890000001
    # the newest event wasn't delivered, and is tried again: it doesn't move the cursor
    assert cursor(all_.where("source_event_id <> 'ev-small'"), None) == 1782889275000
    assert cursor(nobody, None) is None and cursor(nobody, 5) == 5
    seen = quality.ingest_violations(first, LATER).collect()
    assert {r.source for r in seen} == {"ingestion-usgs"} and {r.source_event_id for r in seen} == {"ev-off", "ev-nowhere"}


def test_delivered_ids_are_merged_and_not_broadcast(spark):
    none = spark.createDataFrame([], "source_event_id string, seen string")
    first = poll(spark, FEED, none)
    sent = first.select("source_event_id")
    for df in (ingest.committed(none, first, sent), ingest.poll_stats(first, sent), ingest.cursor_max(first, sent, None, LATER)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_feed_that_is_polled_twice_is_parsed_once(spark):
    from strandline.plans.pipeline import QUERIES

    plan = QUERIES["cursor_dedup_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "parseJson" not in plan and "Broadcast" not in plan


@pytest.mark.parametrize(("value", "shown"), [('"soon"', "'soon'"), ("true", "True"), ("null", "None"), ('"it\'s"', '"it\'s"'), ("[1]", "[1]"), ('"a\\\\b"', "'a\\\\b'")])
def test_problem_texts_show_the_value(spark, value, shown):
    feed = '{"features":[{"id":"x","properties":{"mag":1,"time":%s,"updated":1},"geometry":{"coordinates":[1,2]}}]}' % value
    got = ingest.parse_features(ingest.features(spark.createDataFrame([(feed,)], "value string"))).first().problem
    assert got == f"'time' must be epoch milliseconds, got {shown}"


@pytest.mark.parametrize(
    "feature, problem",
    [
        ("5", "feature is not an object"), ('{"id":7}', "feature has no string 'id'"), ('{"id":""}', "feature has no string 'id'"), ('{"id":"a"}', "'properties' missing"), ('{"id":"a","properties":{}}', "'geometry' missing"), ('{"id":"a","properties":{},"geometry":{"coordinates":[1]}}', "'geometry.coordinates'"), ('{"id":"a","properties":{},"geometry":{"coordinates":["1",2]}}', "'longitude'"),
        ('{"id":"a","properties":{},"geometry":{"coordinates":[1,true]}}', "'latitude'"), ('{"id":"a","properties":{},"geometry":{"coordinates":[1,2,"x"]}}', "'depth_km'"), ('{"id":"a","properties":{"mag":true},"geometry":{"coordinates":[1,2]}}', "'magnitude'"), ('{"id":"a","properties":{"mag":1,"time":"t"},"geometry":{"coordinates":[1,2]}}', "'time'"), ('{"id":"a","properties":{"time":1},"geometry":{"coordinates":[1,2,null]}}', "'updated'"),
    ],
)
def test_structural_problems(spark, feature, problem):
    r = ingest.parse_features(ingest.features(spark.createDataFrame([(f'{{"features":[{feature}]}}',)], "value string"))).collect()[0]
    assert r.problem.startswith(problem)


@pytest.mark.parametrize("feed", ["{}", '{"features":{}}', "nonsense"])
def test_a_feed_without_features_fails(spark, feed):
    with pytest.raises(Exception, match="features"):
        ingest.features(spark.createDataFrame([(feed,)], "value string")).collect()


def events(spark, *rows):
    """rows: (seq, id, severity, status, arrival minute)."""
    made = [(s, "usgs", i, NOW, NOW + timedelta(minutes=m), (1.0, 2.0, v, None, None, None, None, st)) for s, i, v, st, m in rows]
    return spark.createDataFrame(made, "seq long, source string, source_event_id string, event_time timestamp, ingested_at timestamp, payload struct<latitude:double,longitude:double,severity:double,severity_scale:string,depth_km:double,place:string,source_url:string,status:string>")


def test_dedup(spark):
    rows = events(spark, (1, "a", 6.2, "active", 0), (2, "a", 6.2, "active", 1), (3, "a", 6.5, "active", 2), (4, "a", 6.2, "active", 3), (5, "a", 6.2, "cancelled", 4), (6, "b", None, "active", 5), (7, "b", None, "active", 50), (8, "b", None, "active", 109))
    assert [r.decision for r in dedup.decisions(rows).orderBy("seq").collect()] == ["NEW", "DROP", "UPDATE", "UPDATE", "UPDATE", "NEW", "DROP", "DROP"]
    assert [r.decision for r in dedup.decisions(rows, arrival="ingested_at", ttl_s=3600).orderBy("seq").collect()][-3:] == ["NEW", "DROP", "DROP"]
    assert [r.decision for r in dedup.decisions(rows, arrival="ingested_at", ttl_s=45 * 60).orderBy("seq").collect()][-3:] == ["NEW", "NEW", "NEW"]
    for width in (1, 2, 3):
        assert [r.decision for r in dedup.decisions(rows, slice_seqs=width).orderBy("seq").collect()] == ["NEW", "DROP", "UPDATE", "UPDATE", "UPDATE", "NEW", "DROP", "DROP"]
    lost = dedup.decisions(events(spark, (1, None, 1.0, "active", 0), (2, None, 1.0, "active", 0)))
    assert [r.decision for r in lost.collect()] == ["NEW", "NEW"]
    once = dedup.deduplicated(rows)
    assert once.columns == rows.columns
    assert sorted(r.seq for r in dedup.deduplicated(once).collect()) == sorted(r.seq for r in once.collect())


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).collect()[0])


def test_geo_rules(spark):
    at = lambda *x: geo.haversine_km(*[F.lit(float(v)) for v in x])
    d = one(spark, at(35.681, 139.767, 35.466, 139.622), at(0, 0, 1, 0), at(5, 5, 5, 5), at(35.466, 139.622, 35.681, 139.767), at(0, 0, 0, 180))
    assert abs(d[0] - 27.2676) < 1e-3 and abs(d[1] - 111.195) < 1e-2 and d[2] == 0 and d[3] == d[0] and abs(d[4] - math.pi * geo.EARTH_RADIUS_KM) < 1e-6
    radius = lambda s, t="earthquake": geo.impact_radius_km(F.lit(t), F.lit(s).cast("double"))
    assert one(spark, radius(7.0), radius(6.99), radius(6.0), radius(5.0), radius(4.99), radius(None), radius(float("nan")), radius(8.0, "flood")) == (250.0, 120.0, 120.0, 50.0, None, None, None, None)
    score = lambda a, b: geo.geo_score(F.lit(float(a)), F.lit(float(b)))
    assert one(spark, score(0, 10), score(5, 10), score(10, 10), score(20, 10), score(1, 0)) == (1.0, 0.5, 0.0, 0.0, 0.0)


def test_correlate(spark):
    ev = spark.createDataFrame([("m", "usgs", "ev-77", "earthquake", NOW, "t", "demo", 10, (35.681, 139.767, 6.2)), ("n", "usgs", "x", "earthquake", NOW, "t", "demo", 11, (35.681, 139.767, 4.0))], "event_id string, source string, source_event_id string, event_type string, event_time timestamp, trace_id string, tenant_id string, seq long, payload struct<latitude:double,longitude:double,severity:double>")
    fac = spark.createDataFrame([("fac-1", "s", 35.466, 139.622), ("far", "s", -35.0, 139.0), ("none", "s", None, None)], "facility_id string, supplier_id string, latitude double, longitude double")
    i = correlate.correlate(ev, fac, NOW).collect()
    assert len(i) == 1 and i[0].impact_id == "ev-77::fac-1" and i[0].radius_km == 120.0 and 0.7 < i[0].geospatial_score < 1 and i[0].inside_affected_area
    updates = spark.createDataFrame([("fac-1", "s", 35.466, 139.622, False, 1), ("fac-1", "s", 0.0, 0.0, False, 20), ("fac-2", "s", 35.4, 139.6, False, 1), ("fac-2", "s", 35.4, 139.6, True, 9)], "facility_id string, supplier_id string, latitude double, longitude double, deleted boolean, seq long")
    assert [r.asset_id for r in correlate.correlate_asof(ev, updates, NOW).collect()] == ["fac-1"]


def test_current_state(spark):
    image = "struct<id:string,sub:string,v:int>"
    messages = [
        (1, '{"op":"r","ts_ms":1,"after":{"id":"a","sub":"x","v":1}}'), (2, '{"op":"c","ts_ms":2,"after":{"id":"b","sub":"x","v":1}}'), (3, '{"op":"u","ts_ms":3,"before":{"id":"a","sub":"x","v":1},"after":{"id":"a","sub":"x","v":null}}'),
        (4, '{"op":"d","ts_ms":4,"before":{"id":"b","sub":"x"}}'), (5, None), (6, '{"op":"d","ts_ms":6,"before":{"id":"c","sub":"x"}}'), (7, '{"op":"c","ts_ms":7,"after":{"id":"c","sub":"x","v":9}}'),
    ]
    schema = spark.createDataFrame([], f"x {image}").schema["x"].dataType
    changes = state.unwrapped(spark.createDataFrame(messages, "seq long, value string"), schema, ["id", "sub"])
    assert {(r.id, r.after.v) for r in state.current_state(changes, ["id", "sub"]).collect()} == {("a", None), ("c", 9)}
    assert [r.id for r in state.tombstones(changes, ["id", "sub"]).collect()] == ["b"]
    flat = changes.select("id", "deleted", "after.v", "seq")
    assert {r.key: r.value for r in state.upsert_log(flat, ["id"]).collect()} == {'{"id":"a"}': '{"id":"a","v":null}', '{"id":"b"}': None, '{"id":"c"}': '{"id":"c","v":9}'}
    halves = state.merged(state.merged(None, flat.where("seq > 3"), ["id"]), flat.where("seq <= 3"), ["id"])
    assert {tuple(r) for r in halves.collect()} == {tuple(r) for r in state.latest(flat, ["id"]).collect()}
    with pytest.raises(Exception):
        state.unwrapped(spark.createDataFrame([(1, "{oops")], "seq long, value string"), schema, ["id", "sub"]).collect()


def test_text_rules(spark):
    at = lambda us: F.timestamp_micros(F.lit(us))
    assert one(spark, text.isoformat_utc(at(0)), text.isoformat_utc(at(1_500_000)), text.isoformat_utc(at(-1))) == ("1970-01-01T00:00:00Z", "1970-01-01T00:00:01.500000Z", "1969-12-31T23:59:59.999999Z")
    delay = lambda n: text.retry_delay(F.lit(n), 0.5, 5.0)
    assert one(spark, delay(1), delay(2), delay(9)) == (0.5, 1.0, 5.0)
    assert one(spark, text.inventory_days_remaining(F.lit(310.0), F.lit(100.0)), text.inventory_days_remaining(F.lit(1.0), F.lit(0.0))) == (3.1, float("inf"))
    assert one(spark, text.consume_inventory(F.lit(1.0), F.lit(864000.0), 2.0, F.lit(1.4))) == (0.0,)
    assert one(spark, *[text.blank(F.lit(t).cast("string")) for t in (None, "", " \t\n", "x")]) == (True, True, True, False)
    space = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    assert one(spark, *[text.stable_uuid(space, F.lit(n)) for n in ("", "supplier-1", "é")]) == tuple(str(uuid.uuid5(uuid.UUID(space), n)) for n in ("", "supplier-1", "é"))
    a, b = text.payload_hash(b=F.lit(1), a=F.lit(None)), text.payload_hash(a=F.lit(None), b=F.lit(1))
    assert len(set(one(spark, a, b))) == 1


def test_schemas_and_settings(monkeypatch):
    old = schemas.topic_schema("events.normalized.v1")
    assert schemas.backward_compatible(old, old) == []
    more = type(old)(old.fields + schemas.INVENTORY.fields[:1])
    assert schemas.backward_compatible(old, more) == [] and schemas.backward_compatible(more, old) == ["warehouse_id was removed"]
    assert schemas.backward_compatible(schemas.INVENTORY, schemas._struct(*[(f.name, schemas._S, f.nullable) for f in schemas.INVENTORY])) != []
    with pytest.raises(KeyError):
        schemas.topic_schema("nothing.v1")
    monkeypatch.setenv("STRANDLINE_DEDUP_TTL_S", "60")
    assert config.resolve().dedup_ttl_s == 60 and config.resolve(dedup_ttl_s=5).dedup_ttl_s == 5 and config.resolve(ingest_skew_s=None).ingest_skew_s == 300
    with pytest.raises(ValueError):
        config.resolve(nothing=1)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", NOW), ("b", NOW + timedelta(days=1))], "event_id string, event_time timestamp")
    logs.append_keyed(df, str(tmp_path / "log"), "event_id")
    logs.append_keyed(df, str(tmp_path / "log"), "event_id")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    with pytest.raises(Exception, match="no key"):
        logs.append_keyed(df.withColumn("event_id", F.lit(None).cast("string")), str(tmp_path / "bad"), "event_id")
    logs.lakehouse(df, str(tmp_path / "lake"))
    assert spark.read.parquet(str(tmp_path / "lake")).where("event_date = date '2026-07-02'").count() == 1


def test_linking(spark):
    aliases = spark.createDataFrame([("1", "Galvary Systems, Inc."), ("2", "Ekko Optics"), ("3", "Ekko Optic")], "entity_id string, alias string")
    names = spark.createDataFrame([("galvary systems inc",), ("Galvary Sistems Inc",), ("Ekko  OPTICS",), ("Nobody",), (None,), ("",)], "mention string")
    got = {r.mention: (r.entity_id, r.how) for r in features.link_entities(names, aliases).collect()}
    assert got == {"galvary systems inc": ("1", "exact"), "Galvary Sistems Inc": ("1", "near"), "Ekko  OPTICS": ("2", "exact"), "Nobody": (None, None), None: (None, None), "": (None, None)}


def test_named_entities(spark):
    aliases = spark.createDataFrame([("1", "Galvary Systems, Inc."), ("3", "Galvary systems inc"), ("2", "Ekko"), ("4", "a b c d e f"), ("5", None), ("6", "...")], "entity_id string, alias string")
    texts = spark.createDataFrame([(1, "At GALVARY  Systems inc; Ekko and Ekko again."), (2, "Ekkoo systems"), (3, None), (4, ""), (5, "a b c d e f")], "doc_id long, text string").withColumn("mention", F.lit("clash"))
    got = sorted((r.doc_id, r.mention, r.entity_id) for r in features.named_entities(texts, aliases).collect())
    assert got == [(1, "ekko", "2"), (1, "galvary systems inc", "1")]
    rows = {(r.doc_id, r.category, r.mention) for r in features.enriched(texts, {"x": "again", "y": "at "}, aliases).collect()}
    assert rows == {(1, "x", "ekko"), (1, "x", "galvary systems inc"), (2, None, None), (3, None, None), (4, None, None), (5, None, None)}


def test_chunks_keep_sentences_whole(spark):
    sentence = [f"Sentence {i} has some words in it." for i in range(300)]
    rows = [(1, " ".join(sentence), "T"), (2, None, "T"), (3, " ", None), (4, "word " * 1200, None)]
    got = retrieval.chunks(spark.createDataFrame(rows, "doc_id long, text string, title string"), 100, 20).orderBy("doc_id", "chunk_no").collect()
    first = [r for r in got if r.doc_id == 1]
    assert all(r.content.startswith("T\n") and r.n_tokens <= 100 for r in first) and {r.doc_id for r in got} == {1, 4}
    bodies = [r.content[2:] for r in first]
    assert all(s in " ".join(bodies) for s in sentence) and all(b.endswith(".") for b in bodies)
    assert bodies[1].split(".")[0] + "." in bodies[0] and first[3].chunk_id == "1::v1::chunk-0003"
    assert sum(r.n_tokens for r in got if r.doc_id == 4) == 1200


def test_chunks_without_spaces(spark):
    import hashlib

    sentence = [f"第{i}便の貨物は港で三時間待ちました。" for i in range(60)]
    one = "長" * 700  # a sentence longer than a chunk
    rows = [(1, "".join(sentence), None), (2, one, None)]
    got = retrieval.chunks(spark.createDataFrame(rows, "doc_id long, text string, title string"), 120, 30).orderBy("doc_id", "chunk_no").collect()
    first = [r for r in got if r.doc_id == 1]
    assert all(r.n_tokens <= 120 for r in got) and len(first) > 10
    assert all(r.content.endswith("。") for r in first) and all(any(s in r.content for r in first) for s in sentence)
    assert "".join(r.content.replace(" ", "") for r in got if r.doc_id == 2) == one
    assert all(r.content_hash == hashlib.sha256(r.content.encode()).hexdigest() for r in got)


def test_selection(spark):
    ranked = spark.createDataFrame([(1, 10, 0.9, 400, [1.0, 0.0]), (1, 11, 0.8, 500, [1.0, 0.01]), (1, 12, 0.7, 300, [0.0, 1.0])], "query_id long, item_id long, final_score double, n_tokens int, vector array<double>")
    assert [r.item_id for r in retrieval.within_budget(ranked, 1000).orderBy("item_id").collect()] == [10, 11]
    assert [r.item_id for r in retrieval.diverse(ranked, 2, 0.5).orderBy("place").collect()] == [10, 12]
    bad = retrieval.citation_problems(
        spark.createDataFrame([("c1", ["e1"]), ("c2", []), ("c3", ["e2", "e3"]), ("c4", ["e9"])], "claim_id string, evidence_ids array<string>"),
        spark.createDataFrame([("e1", True), ("e2", False), ("e3", True)], "evidence_id string, is_active boolean"),
        spark.createDataFrame([("e1",), ("e2",)], "evidence_id string"),
    )
    assert {tuple(r) for r in bad.select("claim_id", "evidence_id", "problem").collect()} == {("c2", None, "no_evidence"), ("c3", "e2", "inactive"), ("c3", "e3", "not_in_context"), ("c4", "e9", "unknown")}


def test_fusion_reaches_documents_without_a_query_term(spark):
    items = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 1.0, 1.0)], "item_id long, recency double, reliability double")
    queries = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, vector array<double>")
    vectors = spark.createDataFrame([(1, [0.0, 1.0]), (2, [2.0, 0.0])], "item_id long, vector array<double>")
    cosine = retrieval.similarities(queries, vectors).withColumnRenamed("similarity", "vector")
    lexical = spark.createDataFrame([(7, 1, 3.0)], "query_id long, item_id long, bm25 double")
    got = {r.item_id: round(r.final_score, 6) for r in retrieval.fused(retrieval.candidates(items, queries, cosine, lexical)).collect()}
    assert got == {1: 0.45, 2: 0.7, 3: 0.15}


def test_linking_finds_every_name_within_two_edits(spark):
    rng = random.Random(4)
    known = ["a", "ab", "kite", "galvary systems inc", "fenwold circuits ab", "nordspan foundry oy"] + ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 9))).strip() or "c" for _ in range(40)]
    asked = ["xalvary systems inc", "glavary systems inc", "alvary systems in"]
    for name in known:
        for _ in range(4):
            at, kind = rng.randrange(len(name) + 1), rng.choice("ids")
            asked.append(" ".join((name[:at] + rng.choice("abx") * (kind != "d") + name[at + (kind != "i") :]).split()) or "x")
    names = {}
    for i, name in enumerate(known):
        names.setdefault(" ".join(name.split()), f"{i:03d}")

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def want(m):
        return (names[m], "exact") if m in names else (lambda near: (near[1], "near") if near[0] <= 2 else (None, None))(min((edits(m, n), i) for n, i in names.items()))

    aliases = spark.createDataFrame([(i, n) for n, i in names.items()], "entity_id string, alias string")
    got = {r.mention: (r.entity_id, r.how) for r in features.link_entities(spark.createDataFrame([(m,) for m in set(asked)], "mention string"), aliases).collect()}
    assert got == {m: want(m) for m in set(asked)}


def test_ids_of_an_impact(spark):
    import __spark_entry__

    assert {"shipment_ids", "order_ids"} <= set(__spark_entry__.queries())
    impacts = spark.createDataFrame([("i", "f", "s"), ("j", "f", "s"), ("k", "g", None)], "impact_id string, asset_id string, supplier_id string")
    shipments = spark.createDataFrame([("a", "f", "in_transit"), ("b", "f", "delivered"), ("c", "f", None), ("d", "h", "planned")], "shipment_id string, origin_facility_id string, status string")
    orders = spark.createDataFrame([("p", "s", "open"), ("q", "s", "closed"), ("r", "t", "open"), ("u", None, "open")], "purchase_order_id string, supplier_id string, status string")
    assert sorted(tuple(r) for r in features.shipment_ids(impacts, shipments).collect()) == [("i", "a"), ("j", "a")]
    assert [tuple(r) for r in features.order_ids(impacts, orders).collect()] == [("s", "p")]


def test_avro_values_round_trip(spark):
    from datetime import datetime as dt

    from strandline.sources import avro

    at = dt(2026, 3, 1, 12, 30, 15, 123000, tzinfo=timezone.utc)
    schema = schemas.topic_schema("events.normalized.v1")
    good = (1.5, -70.25, None, None, 33.0, "naïve 港", None, "active")
    rows = [("e1", "earthquake", 1, "s", "x", None, at, at, at, "t", "c" * 300, "demo", good), ("e2", "flood", -2_000_000_000, "s", "", "v", at, at, at, "t", None, "demo", (0.0, 0.0, float("inf"), "", 0.0, "", "", ""))]
    df = spark.createDataFrame(rows, schema)
    records = avro.encoded(df.withColumn("extra", F.lit(1)), schema, "source_event_id", 7)
    found = records.collect()
    assert [bytes(r.value[:5]) for r in found] == [b"\x00\x00\x00\x00\x07"] * 2 and {bytes(r.key) for r in found} == {b"x", b""}
    assert [h.key for h in found[0].headers] == ["trace_id", "event_type"] and bytes(found[0].headers[0].value) == b"t"
    back = avro.decoded(records.unionByName(spark.createDataFrame([(None, None, [])], records.schema)), schema)
    assert back.schema.simpleString() == schema.simpleString()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    violation = schemas.topic_schema("audit.data_quality.v1")
    assert '"items": "string"' in avro.avro_schema(violation, "violation")
    with pytest.raises(Exception, match="no key"):
        avro.encoded(df.withColumn("source_event_id", F.lit(None).cast("string")), schema, "source_event_id", 7).collect()
    with pytest.raises(Exception, match="not a framed"):
        avro.decoded(spark.createDataFrame([(bytearray(b"abc"),)], "value binary"), schema).collect()


def test_floods_and_wildfires(spark):
    ring = [(-1.0, 10.0, 1.0, 10.0), (1.0, 10.0, 1.0, 12.0), (1.0, 12.0, -1.0, 12.0), (-1.0, 12.0, -1.0, 10.0)]
    schema = "event_id string, event_type string, source string, source_event_id string, alert string, payload struct<severity:double,latitude:double,longitude:double>, region struct<rlon:double,edges:array<struct<x0:double,y0:double,x1:double,y1:double>>>"
    rows = [(i, kind, "s", i, alert, (2.0, 11.0, 179.5), (179.5, ring)) for i, kind, alert in (("a", "flood", "RED"), ("b", "flood", "green"), ("c", "storm", "red"))]
    places = spark.createDataFrame([("in", "p", 11.0, -179.8), ("edge", "p", 10.0, 179.0), ("out", "p", 11.0, -179.0), ("none", "p", None, 1.0)], "facility_id string, supplier_id string, latitude double, longitude double")
    got = correlate.correlate_regions(spark.createDataFrame(rows, schema), places, NOW).collect()
    assert {(r.event_id, r.asset_id) for r in got} == {("a", "in"), ("a", "edge")} and all(r.inside_affected_area and r.geospatial_score == 1.0 and r.radius_km is None for r in got)
    fires = spark.createDataFrame([("wildfire", "High"), ("wildfire", "low"), ("flood", "high"), ("wildfire", None)], "t string, c string")
    assert [r[0] for r in fires.select(geo.wildfire_radius_km(F.col("t"), F.col("c"))).collect()] == [40.0, None, None, None]


def test_radius_classes_and_full_cells(spark):
    rng = random.Random(4)
    at = [(f"f{i}", "s", *p) for i, p in enumerate([(rng.uniform(30, 34), rng.uniform(-180, 180)) for _ in range(300)] + [(32.0, 179.99 - i / 1e4) for i in range(300)])]
    ev = [(f"e{i}", "d", f"e{i}", "earthquake", NOW, "t", "demo", i, (rng.uniform(30, 34), rng.choice([-1, 1]) * rng.uniform(178, 180), rng.choice([4.0, 5.0, 6.5, 7.9]))) for i in range(60)]
    schema = "event_id string, source string, source_event_id string, event_type string, event_time timestamp, trace_id string, tenant_id string, seq long, payload struct<latitude:double,longitude:double,severity:double>"
    events_, places = spark.createDataFrame(ev, schema), spark.createDataFrame(at, "facility_id string, supplier_id string, latitude double, longitude double")
    left, right = correlate._sides(events_, places)
    got = sorted((r.event_id, r.asset_id) for r in correlate.cell_join(left, right, *correlate.AT, correlate.REACHES_KM, F.col("radius_km"), cell_rows=20).collect())
    far = lambda a, b, c, d: 2 * 6371.0088 * math.asin(math.sqrt(math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2))
    radius = lambda m: 250 if m >= 7 else 120 if m >= 6 else 50 if m >= 5 else -1
    assert got == sorted((e[0], f[0]) for e in ev for f in at if far(*e[8][:2], *f[2:]) <= radius(e[8][2])) and len(got) > 100


def test_half_of_the_rows(spark):
    for n, bins in ((0, 16), (1, 16), (2, 4), (999, 16), (1000, 4096)):
        df = spark.range(n).withColumn("same", F.lit(1))
        got = [r.id for r in features.sample_half(df, 3, bins).collect()]
        assert len(got) == len(set(got)) == (max(1, n // 2) if n else 0)
    assert features.sample_half(df.select("same"), 3).count() == 500
    assert sorted(got) != sorted(r.id for r in features.sample_half(df, 4).collect())


def test_the_index_finds_what_is_near(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(600, 8)) + 4 * np.eye(8)[rng.integers(0, 8, 600)]
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(700, None), (None, m[0].tolist()), (701, [])]
    items = spark.createDataFrame(rows, "item_id long, vector array<double>").withColumn("cell", F.lit("clash"))
    asked = items.where("item_id % 20 = 0").withColumnRenamed("item_id", "query_id")
    exact = {(r.query_id, r.item_id) for r in retrieval.knn(asked, items, 5).collect()}
    found = [(r.query_id, r.item_id) for r in retrieval.knn_indexed(asked, items, 5, cells=12, sample_rows=200).collect()]
    assert len(found) == len(set(found)) == len(exact) and len(exact & set(found)) >= 0.9 * len(exact)
    # as many cells as any query of the sample, here nearly all items, needs
    assert {(r.query_id, r.item_id) for r in retrieval.knn_indexed(asked, items, 5, cells=12, recall=1.0).collect()} == exact
    assert retrieval.knn_indexed(asked, items.limit(0), 5).count() == 0
