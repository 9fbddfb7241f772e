import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strandline.operators import correlate, dedup, quality, state
from strandline.operators.late_events import EventLedger, daily_figures, route
from strandline.plans import views
from strandline.sources.tables import table
from strandline.streaming import runners

ROOT = "/root/testdata/sf0.001"
NOW = views.NOW


def folder(df, path, parts, order):
    """Write df as `parts` files whose order of arrival follows `order`."""
    n = df.count()
    ranked = df.orderBy(order).rdd.zipWithIndex().map(lambda x: (*x[0], x[1] * parts // n)).toDF(StructType([*df.schema.fields, StructField("_p", LongType())]))
    for p in range(parts):
        ranked.where(f"_p = {p}").drop("_p").coalesce(1).write.mode("append").parquet(path)
    return df.schema


def run(query):
    query.awaitTermination(240)
    assert query.exception() is None


@pytest.fixture(scope="module")
def raw(spark):
    return views.raw_events(spark, ROOT).persist()


def test_normalize_stream(spark, raw, tmp_path):
    source = str(tmp_path / "raw")
    schema = folder(raw, source, 3, "seq")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    run(runners.normalize_stream(stream, str(tmp_path / "good"), str(tmp_path / "audit"), str(tmp_path / "c"), lambda: NOW))
    checked = quality.checked(raw, NOW)
    assert spark.read.parquet(str(tmp_path / "good")).count() == quality.normalized(checked, NOW).count() == 1177
    assert spark.read.parquet(str(tmp_path / "audit")).count() == quality.violations(checked, NOW).count() == 1220 - 1177


def test_dedup_stream(spark, raw, tmp_path):
    events = quality.normalized(quality.checked(raw, NOW), NOW).drop("raw")
    source = str(tmp_path / "events")
    schema = folder(events, source, 3, "seq")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    for name, ttl in (("a", None), ("b", 86400)):
        run(runners.dedup_stream(stream(), str(tmp_path / name), str(tmp_path / f"h{name}"), str(tmp_path / f"c{name}"), ttl_s=ttl))
        got = sorted(r.seq for r in spark.read.parquet(str(tmp_path / name)).select("seq").collect())
        assert got == sorted(r.seq for r in dedup.deduplicated(events, arrival="ingested_at", ttl_s=ttl).select("seq").collect())
    # started again, it has nothing more to do
    run(runners.dedup_stream(stream(), str(tmp_path / "a"), str(tmp_path / "ha"), str(tmp_path / "ca")))
    assert len(got) and spark.read.parquet(str(tmp_path / "a")).count() == 75 + 908


def test_state_and_correlation_streams(spark, raw, tmp_path):
    updates = views.facility_updates(spark, ROOT)
    source, facts = str(tmp_path / "updates"), str(tmp_path / "state")
    schema = folder(updates, source, 3, "seq")
    run(runners.current_state_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source), ["facility_id"], facts, str(tmp_path / "c1")))
    want = state.current_state(updates, ["facility_id"])
    got = runners.read_state(spark, facts, ["facility_id"], schema)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))
    facility_schema = schema

    events = dedup.deduplicated(quality.normalized(quality.checked(raw, NOW), NOW))
    log = str(tmp_path / "events")
    schema = folder(events, log, 2, "seq")
    runners.statement_set([runners.correlate_stream(spark.readStream.schema(schema).parquet(log), facts, facility_schema, str(tmp_path / "impacts"), str(tmp_path / "c2"), lambda: NOW)])
    batch = correlate.correlate(events, want, NOW)
    assert sorted(r.impact_id for r in spark.read.parquet(str(tmp_path / "impacts")).collect()) == sorted(r.impact_id for r in batch.collect())


def test_ledger_stream(spark, tmp_path):
    messages = table(spark, ROOT, "events_normalized")
    source = str(tmp_path / "messages")
    schema = folder(messages, source, 3, "ingested_at")
    ledger = EventLedger(spark, str(tmp_path / "ledger"))
    run(runners.ledger_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source), ledger, str(tmp_path / "c")))
    want = daily_figures(route(messages).where("verdict in ('on_time', 'late')"))
    order = ["period", "event_type", "n_messages", "n_severity", "sum_severity", "max_severity"]
    assert sorted(map(tuple, ledger.figures().select(order).collect()), key=repr) == sorted(map(tuple, want.select(order).collect()), key=repr)


def test_poll_stream(spark, tmp_path):
    from strandline.sources.logs import stream_feeds
    from tests.test_pipeline import FEED, LATER

    drop = tmp_path / "drop"
    drop.mkdir()
    paths = [str(tmp_path / n) for n in ("raw", "audit", "markers", "c")]
    (drop / "1.json").write_text(FEED)
    run(runners.poll_stream(stream_feeds(spark, str(drop)), *paths, lambda: LATER))
    (drop / "2.json").write_text(FEED)
    (drop / "3.json").write_text(FEED.replace("1782889275000", "1782889276000"))
    for n in (2, 3):  # the source takes files in the order of their times
        os.utime(drop / f"{n}.json", (2_000_000_000 + n, 2_000_000_000 + n))
    run(runners.poll_stream(stream_feeds(spark, str(drop)), *paths, lambda: LATER))
    ids = sorted(r.source_event_id for r in spark.read.parquet(paths[0]).collect())
    assert ids == ["ev-good", "ev-good", "ev-small"]
    assert spark.read.parquet(paths[1]).count() == 6


def test_the_clock_is_read_for_each_batch(spark, raw, tmp_path):
    source = str(tmp_path / "raw")
    fixed = raw.withColumn("event_time", F.lit(NOW + timedelta(hours=3)))
    schema = folder(fixed.limit(40), source, 2, "seq")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    times = iter([NOW, NOW + timedelta(hours=5)])
    run(runners.normalize_stream(stream, str(tmp_path / "good"), str(tmp_path / "audit"), str(tmp_path / "c"), lambda: next(times)))
    good = spark.read.parquet(str(tmp_path / "good"))
    # in the future for the first batch, past for the second
    assert {r.batch for r in good.select("batch").distinct().collect()} == {1}
    assert {r.normalized_at.replace(tzinfo=timezone.utc) for r in good.select("normalized_at").distinct().collect()} == {NOW + timedelta(hours=5)}


def test_markers_lapse(spark, tmp_path):
    from strandline.config import Settings
    from strandline.sources.logs import stream_feeds
    from tests.test_pipeline import FEED, LATER

    drop = tmp_path / "drop"
    drop.mkdir()
    paths = [str(tmp_path / n) for n in ("raw", "audit", "markers", "c")]
    for n in (1, 2, 3):
        (drop / f"{n}.json").write_text(FEED)
        os.utime(drop / f"{n}.json", (2_000_000_000 + n, 2_000_000_000 + n))
    times = iter([LATER, LATER + timedelta(seconds=50), LATER + timedelta(seconds=120)])
    run(runners.poll_stream(stream_feeds(spark, str(drop)), *paths, lambda: next(times), Settings(marker_ttl_s=60)))
    assert {(r.batch, r.source_event_id) for r in spark.read.parquet(paths[0]).collect()} == {(b, e) for b in (0, 2) for e in ("ev-good", "ev-small")}


def test_a_lapsed_key_leaves_the_state(spark, raw, tmp_path):
    from strandline.sources.keyed import KeyedTable

    source, held = str(tmp_path / "events"), str(tmp_path / "held")
    one = quality.normalized(quality.checked(raw, NOW), NOW).drop("raw").where("source_event_id is not null").limit(1)
    made = lambda n, key, hours: one.withColumns({"seq": F.lit(n).cast("long"), "source_event_id": F.lit(key), "ingested_at": F.lit(NOW + timedelta(hours=hours))})
    for n, (key, hours) in enumerate([("a", 0), ("b", 1), ("a", 2), ("b", 30), ("a", 31), ("a", 32)]):
        made(n, key, hours).coalesce(1).write.mode("append").parquet(source)
        run(runners.dedup_stream(spark.readStream.schema(one.schema).parquet(source), str(tmp_path / "out"), held, str(tmp_path / "c"), ttl_s=86400))
        state_ = KeyedTable(spark, held, ["dedup_key"], "dedup_key string, content_hash string, at long, batch long", 1)
    assert sorted(r.seq for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 3, 4]
    assert {r.dedup_key.split(":")[1] for r in state_.rows().collect()} == {"a", "b"}
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], "k string, at long", 1)
    for n, rows in enumerate([[("a", 0), ("b", 50)], [("c", 100)]]):
        table.upsert(spark.createDataFrame(rows, "k string, at long"), n, lambda both, n=n: state.latest(both.where(F.col("at") > 100 * n - 60), ["k"], "at"))
    assert {r.k for r in table.rows().collect()} == {"b", "c"}
    # as they were before batch 1, for a batch that is repeated
    assert {r.k for r in table.matching(spark.createDataFrame([("a",), ("c",)], "k string"), before=1).collect()} == {"a"}
    table.upsert(spark.createDataFrame([("d", 900)], "k string, at long"), 2, lambda both: both.limit(0))
    assert table.rows().count() == 0


def test_state_of_nothing_and_touched_buckets(spark, tmp_path):
    from strandline.sources.keyed import KeyedTable

    schema = "k string, v long, deleted boolean, seq long"
    assert runners.read_state(spark, str(tmp_path / "none"), ["k"], schema).count() == 0
    path = tmp_path / "t"
    table = lambda: KeyedTable(spark, str(path), ["k"], schema, 16)
    merge = lambda rows: state.latest(rows, ["k"])
    table().upsert(spark.range(200).selectExpr("cast(id AS string) AS k", "id AS v", "false AS deleted", "id AS seq"), 0, merge)
    before = {f: os.path.getmtime(f) for f in path.rglob("*.parquet")}
    one = spark.createDataFrame([("7", 700, False, 1000), (None, 1, False, 1001)], schema)
    for _ in range(2):  # repeated, it changes nothing
        table().upsert(one, 1, merge)
    rows = {r.k: r.v for r in table().rows().collect()}
    assert rows == {str(i): i for i in range(200)} | {"7": 700}
    after = set(path.rglob("*.parquet")) - set(before)
    assert len({f.parent.parent.name for f in after}) == 1
    # old versions go when their bucket is written again
    for n in range(2, 6):
        table().upsert(spark.createDataFrame([("7", n, False, 1000 + n)], schema), n, merge)
    assert max(len(list(b.glob("version=*"))) for b in path.glob("bucket=*")) == 2
    assert {r.k: r.v for r in table().matching(spark.createDataFrame([("7",), ("x",), (None,)], "k string"), before=99).collect()} == {"7": 5}


def test_statement_set_stops_the_others():
    class Query:
        def __init__(self, ends):
            self.ends, self.stopped = ends, False

        def awaitTermination(self, timeout):  # noqa: N802
            if isinstance(self.ends, Exception):
                raise self.ends
            return self.ends

        def stop(self):
            self.stopped = True

    done, running = Query(True), Query(False)
    with pytest.raises(ValueError, match="no"):
        runners.statement_set([done, running, Query(ValueError("no"))], 0)
    assert running.stopped and not done.stopped
    runners.statement_set([Query(True), Query(True)], 0)


def test_lag_metrics(spark):
    at = datetime(2026, 1, 1, tzinfo=timezone.utc)
    df = spark.createDataFrame([(at, at + timedelta(seconds=5)), (at, at)], "event_time timestamp, ingested_at timestamp")
    assert runners.lag_metrics(df).count() == 2
