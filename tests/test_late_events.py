from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from strandline.operators import late_events as L

DAY = datetime(2026, 2, 3, tzinfo=timezone.utc)
SCHEMA = "event_id string, event_type string, event_time timestamp, ingested_at timestamp, payload struct<severity:double>, period string, batch string"


def rows(*cases):
    return [(i, t, DAY + timedelta(hours=at), None if got is None else DAY + timedelta(hours=got), (s,), "p", "b") for i, t, at, got, s in cases]


CASES = rows(
    ("ok", "quake", 10, 11, 1.0), ("grace", "quake", 23, 24 + 5 / 60, 2.0), ("late", "quake", 23, 24.1, 3.0), ("late", "quake", 23, 24.1, 3.0), ("edge", "flood", 1, 72, None), ("too", "quake", 1, 72.01, 9.0), ("skew", "flood", 30, 20, 4.0), ("none", "quake", 1, None, 5.0),
)


def test_verdicts(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    assert {r.event_id: r.verdict for r in L.route(df).select("event_id", "verdict").collect()} == {"ok": "on_time", "grace": "on_time", "late": "late", "edge": "late", "too": "too_late", "skew": "on_time", "none": "unplaced"}
    assert L.route(df.limit(0)).count() == 0


def test_revisions(spark):
    got = {(r.event_type, r.batch - r.period): (r.n_messages, r.n_severity, r.sum_severity) for r in L.daily_revisions(spark.createDataFrame(CASES, SCHEMA)).where("event_type = 'quake'").collect()}
    # a revision of the day follows whatever message touched it, of any type
    assert got == {("quake", 0): (1, 1, 1.0), ("quake", 1): (3, 3, 6.0), ("quake", 3): (3, 3, 6.0)}


def test_ledger_corrects_days_and_seals_them(spark, tmp_path):
    ledger = L.EventLedger(spark, str(tmp_path / "ledger"))
    with pytest.raises(ValueError):
        ledger.figures()
    df = spark.createDataFrame(CASES, SCHEMA).drop("period", "batch")
    first, second = df.where("event_id in ('ok', 'skew', 'none')"), df.where("event_id not in ('ok', 'skew', 'none')")
    day = int(DAY.timestamp()) // 86400
    assert ledger.apply(first, 1) == [day, day + 1]
    before = {(r.period, r.event_type): r.n_messages for r in ledger.figures().collect()}
    assert before == {(day, "quake"): 1, (day + 1, "flood"): 1}
    for touched in ([day], []):  # applied again, it changes nothing
        assert ledger.apply(second, 2) == touched
        now = {(r.period, r.event_type): (r.n_messages, r.sum_severity) for r in ledger.figures().collect()}
        assert now == {(day, "quake"): (3, 6.0), (day, "flood"): (1, None), (day + 1, "flood"): (1, 4.0)}
    assert {(r.event_id, r.verdict) for r in ledger.aside().collect()} == {("none", "unplaced"), ("too", "too_late")}
    whole = {(r.period, r.event_type): r.n_messages for r in L.daily_figures(L.route(df).where("verdict in ('on_time', 'late')")).collect()}
    assert whole == {k: v[0] for k, v in now.items()}


def test_a_batch_with_nothing_to_accept(spark, tmp_path):
    ledger = L.EventLedger(spark, str(tmp_path / "ledger"))
    df = spark.createDataFrame(CASES, SCHEMA).drop("period", "batch")
    assert ledger.apply(df.where("event_id = 'too'"), 1) == []
    assert ledger.apply(df.limit(0), 2) == []
    with pytest.raises(ValueError):
        ledger.figures()
    assert ledger.late().collect() == [("too", "too_late")]


def test_a_reader_sees_no_half_of_a_batch(spark, tmp_path, monkeypatch):
    ledger = L.EventLedger(spark, str(tmp_path / "ledger"))
    df = spark.createDataFrame(CASES, SCHEMA).drop("period", "batch")
    first, second = df.where("event_id in ('ok', 'skew')"), df.where("event_id not in ('ok', 'skew')")
    ledger.apply(first, 1)
    seen = lambda: (sorted(map(tuple, ledger.figures().select("period", "event_type", "n_messages").collect())), sorted(r.event_id for r in ledger.raw().collect()), ledger.late().count())
    before = seen()
    # all files of the batch are written, and then it fails before the swap
    monkeypatch.setattr(L.EventLedger, "_swap", lambda *_: 1 / 0)
    for _ in range(2):
        with pytest.raises(ZeroDivisionError):
            ledger.apply(second, 2)
        assert seen() == before
    monkeypatch.undo()
    assert len(ledger.apply(second, 2)) == 1
    assert sorted(r.event_id for r in ledger.raw().collect()) == ["edge", "grace", "late", "late", "ok", "skew"]
    assert ledger.late().count() == 3


def test_old_versions_are_deleted(spark, tmp_path):
    ledger = L.EventLedger(spark, str(tmp_path / "ledger"))
    one = spark.createDataFrame(CASES, SCHEMA).drop("period", "batch").where("event_id = 'ok'")
    for n in range(1, 5):
        ledger.apply(one.withColumn("event_id", F.lit(f"ok{n}")), n)
        assert ledger.figures().first().n_messages == n
    assert len(list((tmp_path / "ledger" / "figures").glob("period=*/version=*"))) == 2


def test_replay_by_ingestion(spark, tmp_path):
    df = spark.createDataFrame(CASES, SCHEMA).drop("period", "batch")
    whole = {(r.period, r.event_type): (r.n_messages, r.sum_severity) for r in L.daily_figures(L.route(df).where("verdict in ('on_time', 'late')")).collect()}
    for hours in (6, 24, 24 * 30):
        ledger = L.replayed(L.EventLedger(spark, str(tmp_path / f"by{hours}")), df, hours * 3_600_000_000)
        assert {(r.period, r.event_type): (r.n_messages, r.sum_severity) for r in ledger.figures().collect()} == whole
        assert {(r.event_id, r.verdict) for r in ledger.late().collect()} == {("late", "late"), ("edge", "late"), ("too", "too_late")}
        assert {r.event_id for r in ledger.aside().collect()} == {"too", "none"}
    assert L.replayed(L.EventLedger(spark, str(tmp_path / "none")), df.limit(0), 1).late().count() == 0
