"""Small random change feeds and plain-Python answers."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
SCHEMA = "seq long, op string, ts_ms long, k string, parent string, v string, w double, updated_at string, live string, eff string, part string"


def iso(us: int, form: int) -> str:
    at = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=us)
    zone = [timezone.utc, timezone(timedelta(hours=9)), timezone(-timedelta(hours=5))][form % 3]
    text = at.astimezone(zone).isoformat()
    return text.replace("+00:00", "Z") if form % 2 == 0 else text


def random_feed(seed: int, n: int = 160, keys: int = 6) -> list[tuple]:
    """Rows of SCHEMA: one key has a third of all rows; late, repeated, keyless, unreadable and null-op messages; columns called
    like the operators' own."""
    rng = random.Random(seed)
    start = int(START.timestamp()) * 1_000_000
    rows, used = [], set()
    for _ in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice([*(f"k{i}" for i in range(keys)), None, ""])
        op = rng.choices(["c", "u", "r", "d", None], [2, 5, 1, 1, 1])[0]
        at = start + rng.randrange(0, 60 * 86400) * 1_000_000
        while (key, at) in used:
            at += 1_000_000
        used.add((key, at))
        value = rng.choice(["a", "b", "c", None])
        text = None if op in ("d", None) else rng.choice([iso(at, rng.randrange(6))] * 12 + ["soon"])
        captured = at // 1000 if op == "d" else at // 1000 + rng.choice([0, 5, 86_400_000, 900_000_000])
        row = (op, None if op is None else captured, key, rng.choice(["hot", "k1", "k2", "nobody", "", None]), value, rng.choice([0.5, 1.5, None]), text, "x", "y", "z")
        rows += [row] * rng.choice([1, 1, 1, 2])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1] or 0) + rng.choice([0, 0, 0, 10**9]))
    return [(n + 1, *rows[i]) for n, i in enumerate(order)]


def effect(row: tuple) -> int | None:
    _, op, ts_ms, *_ = row
    if op == "d":
        return ts_ms * 1000 if ts_ms is not None else None
    if op not in ("c", "u", "r") or row[7] in (None, "soon"):
        return None
    at = datetime.fromisoformat(row[7].replace("Z", "+00:00"))
    return round((at - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))


def changes(rows: list[tuple]) -> dict[str, list[tuple]]:
    """By key the changes (eff, seq, live, v) in order of effect, repeated ones once with the smallest seq."""
    by: dict[str, dict[int, tuple]] = {}
    for r in sorted(rows):
        e = effect(r)
        if r[3] is not None and e is not None:
            by.setdefault(r[3], {}).setdefault(e, (e, r[0], r[1] != "d", r[5]))
    return {k: sorted(c.values()) for k, c in by.items()}
