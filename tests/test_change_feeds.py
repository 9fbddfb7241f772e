import pytest
from pyspark.sql import functions as F

from strandline.operators import asof, changefeed, feed, history, references
from strandline.operators.sliced import DAY_US, slice_width
from tests.feeds import SCHEMA, changes, random_feed

SEEDS = [1, 2, 3]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state_at(own, t):
    known = [c for c in own if c[0] <= t]
    return known[-1] if known else None


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize(("days", "steps"), [(45, 3), (7, 2), (7, 20), (400, 0)])
def test_newest_first(spark, seed, days, steps):
    rows = random_feed(seed)
    got = sorted((r.key, r.seq) for r in changefeed.current_rows(frame(spark, rows), "k", (), days * DAY_US, steps).collect())
    assert got == sorted((k, c[-1][1]) for k, c in changes(rows).items() if c[-1][2])


def test_newest_first_keeps_tombstones_and_values(spark):
    rows = random_feed(9)
    got = {r.key: (r.seq, r.v if r.live else None, r.live) for r in changefeed.newest_first(frame(spark, rows), "k", ["v"], 10 * DAY_US).collect()}
    assert got == {k: (c[-1][1], c[-1][3] if c[-1][2] else None, c[-1][2]) for k, c in changes(rows).items()}


@pytest.mark.parametrize("seed", SEEDS)
def test_orphans(spark, seed):
    children, parents = random_feed(seed), random_feed(seed + 50)
    refs = [references.Reference("child", "parent", "top"), references.Reference("child", "k", "top")]
    feeds = {"child": frame(spark, children), "top": frame(spark, parents)}
    got = sorted((r.field, r.seq, r.kind) for r in references.orphan_references(feeds, {"top": "k"}, refs).collect())
    assert got == sorted((r.field, r.seq, r.kind) for r in references.orphan_references(feeds, {"top": "k"}, refs, DAY_US).collect())
    own = changes(parents)
    want = []
    for r in children:
        if r[1] not in ("c", "u", "r"):
            continue
        for field, key in (("parent", r[4]), ("k", r[3])):
            if key is None:
                continue
            known = own.get(key, [])
            if not any(c[2] for c in known):
                want.append((field, r[0], "missing"))
                continue
            at = state_at(known, r[2] * 1000)
            if at is None or not at[2]:
                want.append((field, r[0], "late" if known[0][0] > r[2] * 1000 else "deleted"))
    assert got == sorted(want)
    assert references.orphan_references(feeds | {"top": feeds["top"].limit(0)}, {"top": "k"}, refs).where("kind <> 'missing'").count() == 0


def test_orphans_without_capture_time(spark):
    child = spark.createDataFrame([(1, "u", None, "gone", None), (2, "u", None, "there", None), (3, "d", 5, "gone", None)], "seq long, op string, ts_ms long, p string, updated_at string")
    top = spark.createDataFrame([(1, "c", 1, "there", "2026-01-01T00:00:00Z")], "seq long, op string, ts_ms long, k string, updated_at string")
    got = references.orphan_references({"c": child, "t": top}, {"t": "k"}, [references.Reference("c", "p", "t")])
    assert [(r.seq, r.kind) for r in got.collect()] == [(1, "missing")]
    assert references.orphan_report(got).collect()[0].asDict() == {"table_name": "c", "field": "p", "kind": "missing", "period_start_us": None, "orphans": 1}


def ledger_by_hand(own):
    """Beliefs after each arrival, from scratch."""
    out, before = {}, {}
    for seq in sorted(c[1] for c in own):
        known = [c for c in own if c[1] <= seq]
        now = {c[0]: (c[2], c[3] if c[2] else None, nxt[0] if nxt else -1) for c, nxt in zip(known, [*known[1:], None])}
        for start, what in now.items():
            if before.get(start) != what:
                if start in before:
                    out[start, before[start][2]][-1] = seq
                out[start, what[2]] = [what[0], what[1], seq, -1]
        before = now
    return {(start, end, *what) for (start, end), what in out.items()}


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("width", [0, DAY_US, 30 * DAY_US])
def test_ledger(spark, seed, width):
    rows = random_feed(seed)
    ledger = history.bitemporal_ledger(history.attribute_changes(frame(spark, rows), "t", "k", "v"), width).collect()
    for key, own in changes(rows).items():
        got = {(r.valid_from, r.valid_to, r.live, r.value, r.recorded_from, r.recorded_to) for r in ledger if r.key == key}
        assert got == ledger_by_hand(own), key
    assert {r.key for r in ledger} == set(changes(rows))


def test_ledger_of_a_history_that_arrives_backwards(spark):
    rows = [(100 - i, "u", 0, "k", None, "ab"[i % 2], None, f"2026-01-{i + 1:02d}T00:00:00Z", "", "", "") for i in range(20)]
    ledger = history.bitemporal_ledger(history.attribute_changes(frame(spark, rows), "t", "k", "v"))
    got = {(r.valid_from, r.valid_to, r.live, r.value, r.recorded_from, r.recorded_to) for r in ledger.collect()}
    assert got == ledger_by_hand(changes(rows)["k"])
    assert history.believed_at(ledger, 90).count() == 10


@pytest.mark.parametrize("width", [0, DAY_US])
@pytest.mark.parametrize("seed", SEEDS)
def test_versions(spark, seed, width):
    rows = random_feed(seed)
    got = sorted((r.entity_id, r.valid_from_us, r.valid_to_us) for r in history.attribute_history([(frame(spark, rows), "t", "k", "v")], width).collect())
    want = []
    for key, own in changes(rows).items():
        turns = [c for i, c in enumerate(own) if i == 0 or (own[i - 1][2], own[i - 1][3] if own[i - 1][2] else None) != (c[2], c[3] if c[2] else None)]
        want += [(key, c[0], n[0] if n else -1) for c, n in zip(turns, [*turns[1:], None]) if c[2]]
    assert got == sorted(want)


@pytest.mark.parametrize("width", [0, DAY_US])
@pytest.mark.parametrize("seed", SEEDS)
def test_asof(spark, seed, width):
    rows = random_feed(seed)
    versions = feed.distinct_changes(frame(spark, rows), "k").withColumnRenamed("key", "entity")
    events = [(f"e{i}", r[3], (r[2] or 0) * 1000) for i, r in enumerate(random_feed(seed + 7))] + [("none", "hot", None), ("same", "hot", changes(rows)["hot"][3][0])]
    got = sorted((r.id, r.seq, r.live) for r in asof.asof_versions(spark.createDataFrame(events, "id string, entity string, t long"), versions, width).collect())
    own = changes(rows)
    want = []
    for i, key, t in events:
        if key is not None and t is not None:
            at = state_at(own.get(key, []), t)
            want.append((i, at[1] if at else None, at[2] if at else None))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_asof_in_blocks():
    import pyarrow as pa

    rows = [("a", 0, t, side, f"i{t}" if side else None, None if side else t, None if side else True) for t in range(0, 900, 3) for side in ((0, 1) if t % 30 == 0 else (1,))]
    table = pa.Table.from_pylist([dict(zip(("entity", "part", "t", "side", "id", "seq", "live"), r)) for r in rows], schema=pa.schema([("entity", pa.string()), ("part", pa.int64()), ("t", pa.int64()), ("side", pa.int32()), ("id", pa.string()), ("seq", pa.int64()), ("live", pa.bool_())]))
    asof_rows, asof.BLOCK_ROWS = asof.BLOCK_ROWS, 7
    try:
        out = pa.Table.from_batches(list(asof._joined(iter(table.to_batches(max_chunksize=5))))).to_pylist()
    finally:
        asof.BLOCK_ROWS = asof_rows
    assert {(r["id"], r["seq"]) for r in out} == {(f"i{t}", t // 30 * 30) for t in range(0, 900, 3)} and len(out) == 300


def test_empty_feeds(spark):
    none = frame(spark, [])
    assert changefeed.current_rows(none, "k").count() == 0
    assert history.attribute_history([(none, "t", "k", "v"), (none, "u", "k", "w")]).count() == 0
    assert references.orphan_references({"a": none, "b": none}, {"b": "k"}, [references.Reference("a", "parent", "b")]).count() == 0
    versions = feed.distinct_changes(none, "k").withColumnRenamed("key", "entity")
    assert asof.asof_versions(spark.createDataFrame([], "id string, entity string, t long"), versions).count() == 0
    assert feed.current_image(none, "k", ["v"]).count() == 0


def test_double_attribute(spark):
    rows = [(1, "c", 0, "k", None, None, 0.0, "2026-01-01T00:00:00Z", "", "", ""), (2, "u", 0, "k", None, None, -0.0, "2026-01-02T00:00:00Z", "", "", ""), (3, "u", 0, "k", None, None, 0.25, "2026-01-03T00:00:00Z", "", "", "")]
    got = history.attribute_history([(frame(spark, rows), "t", "k", "w")]).orderBy("valid_from_us").select("value", (F.col("valid_to_us") == -1).alias("o")).collect()
    assert [tuple(r) for r in got] == [("0.0", False), ("0.25", True)]


def test_slices_follow_the_amount_of_data(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).selectExpr("uuid() AS k", "id AS at").write.parquet(path)
    df = spark.read.parquet(path)
    assert slice_width(df) == 0 and slice_width(df, widest=7) == 7
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # a third of the table in 100 slices
    assert abs(slice_width(df, span=100_000, slice_bytes=size // 300) - 1000) <= 10
    assert slice_width(df, span=100_000, widest=500, slice_bytes=size // 300) == 500
    assert slice_width(df, span=10, slice_bytes=1) == 1
