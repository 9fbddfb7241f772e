import random

import pytest
from pyspark.sql import functions as F

from strandline.llm.best_record import best_records

SCHEMA = "source string, sid string, event_id string, ver int, filled int, a double, b string, _kind string, _n string"


def by_hand(rows, valid):
    groups = {}
    for r in rows:
        if None not in (r[0], r[1], r[2]):
            groups.setdefault((r[0], r[1]), []).append(r)
    out = set()
    for key, own in groups.items():
        if len({r[2] for r in own}) > 1:
            own.sort(key=lambda r: (r[3] is None, -(r[3] or 0), -r[4], r[2]))
            first = lambda ok: next((r for r in own if ok(r)), None)
            a, b = first(lambda r: r[5] is not None and valid(r[5])), first(lambda r: r[6] is not None)
            out.add((*key, own[0][2], a and a[5], a and a[2], b and b[6], b and b[2]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        source, sid = ("hot", "1") if rng.random() < 0.4 else (rng.choice(["s", "t", None]), rng.choice(["1", "2", "", None, *map(str, range(3, 40))]))
        row = (source, sid, rng.choice([f"e{i}", f"e{i}", None]), rng.choice([1, 2, 3, None]), rng.randrange(3), rng.choice([None, 1.5, 99.0, float(i % 7)]), rng.choice([None, "x", f"y{i % 5}"]), "k", "n")
        rows += [row] * rng.choice([1, 1, 2])
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).drop("_kind", "_n")
    got = best_records(df, ["source", "sid"], "event_id", [F.col("ver").desc_nulls_last(), F.col("filled").desc()], {"a": F.col("a") < 12, "b": None})
    assert {tuple(r) for r in got.select("source", "sid", "event_id", "a", "a_event_id", "b", "b_event_id").collect()} == by_hand(rows, lambda v: v < 12)


def test_empty_and_single(spark):
    df = spark.createDataFrame([("s", "1", "e", 1, 1, 1.0, "x", "", ""), ("s", "1", "e", 1, 1, 1.0, "x", "", "")], SCHEMA).drop("_kind", "_n")
    for rows in (df, df.limit(0)):
        assert best_records(rows, ["source", "sid"], "event_id", [F.col("ver").desc()], {"a": None}).count() == 0


def test_each_task_keeps_one_row_per_group(spark):
    df = spark.createDataFrame([("s", "1", f"e{i}", i, 1, 1.0, "x", "", "") for i in range(50)], SCHEMA).drop("_kind", "_n")
    plan = best_records(df, ["source", "sid"], "event_id", [F.col("ver").desc()], {"a": None})._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
