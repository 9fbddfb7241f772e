"""Current state of a table from a feed of inserts, updates and deletes, resolved newest first.

Method: the feed's changes fall into batches by effect, of each of which one pass over the feed keeps every key's last change. The
newest batch is resolved first; each older batch only contributes keys that no newer batch has resolved (anti-join), as
first-seen images or tombstones; what the oldest batch, the base, holds of untouched keys is appended at last. Deleted keys are
resolved by their tombstones and never come back from older batches. What is resolved is written step by step, so that a lost
executor costs one step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.feed import changes
from strandline.operators.sliced import DAY_US, slice_of
from strandline.session import discard, scratch_path, subfolders


def newest_first(feed: DataFrame, key: str, values: Sequence[str] = (), batch_us: int = 45 * DAY_US, steps: int = 3) -> DataFrame:
    """(key, eff, seq, live, *values) of the latest change of every key; live False: a tombstone.

    The newest `steps` periods of effect, batch_us long each, that hold changes are batches of their own; all before is the base.
    The result doesn't depend on either. Of messages with one instant the smallest seq represents the change. Order of arrival
    plays no part; messages without op, key or readable instant change nothing; an empty feed gives no rows. The pass over the
    feed combines on the map side, so a hot key costs one row per task and period.
    """
    spark = feed.sparkSession
    columns = ["eff", "seq", "live", *values]
    latest = F.max_by(F.struct(*columns), F.struct(F.col("eff"), (-F.col("seq")).alias("s"))).alias("img")
    rows = changes(feed, key, values)
    schema = rows.select("key", *columns).schema
    by_batch, resolved = scratch_path(spark, "changes"), scratch_path(spark, "resolved")
    rows.groupBy("key", slice_of("eff", batch_us).alias("batch")).agg(latest).select("key", "img.*", "batch").write.partitionBy("batch").parquet(by_batch)
    batches = subfolders(spark, by_batch, "batch")[::-1]
    read = lambda part: spark.read.schema(schema).parquet(*[f"{by_batch}/batch={b}" for b in part])
    for step, part in enumerate([*([b] for b in batches[:steps]), *([batches[steps:]] if batches[steps:] else [])]):
        seen = read(part)
        if step:
            seen = seen.join(spark.read.schema(schema).parquet(resolved).select("key"), "key", "left_anti")
        if len(part) > 1:
            seen = seen.groupBy("key").agg(latest).select("key", "img.*")
        seen.write.parquet(f"{resolved}/step={step}")
    discard(spark, by_batch)
    return spark.read.schema(schema).parquet(resolved) if batches else spark.createDataFrame([], schema)


def current_rows(feed: DataFrame, key: str, values: Sequence[str] = (), batch_us: int = 45 * DAY_US, steps: int = 3) -> DataFrame:
    """The live rows of newest_first."""
    return newest_first(feed, key, values, batch_us, steps).where("live").drop("live")
