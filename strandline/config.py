"""Settings of the pipelines; a value is taken from the argument, else from the environment, else the default."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Settings:
    """ingest_skew_s and normalize_skew_s: how far in the future an event may lie at either check. Times in seconds."""

    ingest_skew_s: int = 300
    normalize_skew_s: int = 3600
    dedup_ttl_s: int = 30 * 86400
    marker_ttl_s: int = 30 * 86400
    poll_interval_s: int = 60
    out_of_orderness_s: int = 300
    idleness_s: int = 60


def resolve(prefix: str = "STRANDLINE_", **given: int | None) -> Settings:
    """Settings from arguments (None: not given), then variables such as STRANDLINE_DEDUP_TTL_S, then the defaults."""
    base = Settings()
    known = {f.name for f in fields(base)}
    if unknown := set(given) - known:
        raise ValueError(f"no such settings: {sorted(unknown)}")
    values = {n: given[n] if given.get(n) is not None else int(os.environ[prefix + n.upper()]) for n in known if given.get(n) is not None or prefix + n.upper() in os.environ}
    return replace(base, **values)
