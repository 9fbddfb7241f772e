"""One surviving record per duplicate group, filled field by field.

Method: the records of a group are ranked by recency, completeness and trust with a deterministic tie-break in a window
ordering, and the top record is kept - once for the survivor and once for each field over the records whose value of that
field can be trusted. Spark limits each task to the top record of every group before the shuffle (window group limit), so
a group that holds a third of all rows reaches its window with one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_records(rows: DataFrame, group: Sequence[str], record_id: str, order: Sequence[Column], fields: dict[str, Column | None]) -> DataFrame:
    """(*group, <record_id>, and per field <field>, <field>_<record_id>) of every group with two or more distinct record ids.

    order: ranking columns, best first, each with its direction; record_id breaks ties (smallest first). fields: the
    condition under which a record's value of the field may be used, None for "not null"; the value comes from the first record
    in the ranking that meets it, and <field>_<record_id> names that record. Both are null if no record does. A repeated
    record (same id) is one record. Rows with a null in the group or the id belong to no group. Empty input: no rows. Columns of
    rows called _kind or _n are ignored and must not be used in the order, nor must the columns of fields (give it a copy).
    """
    known = rows.dropna(subset=[*group, record_id])
    kinds = F.array(
        F.lit(0),
        *[F.when(F.coalesce(ok if ok is not None else F.col(name).isNotNull(), F.lit(False)), F.lit(i + 1)) for i, (name, ok) in enumerate(fields.items())],
    )
    # a row that stands for a field carries the value of that field only
    tagged = known.withColumn("_kind", F.explode(F.array_compact(kinds)))
    tagged = tagged.withColumns({name: F.when(F.col("_kind") == i + 1, F.col(name)) for i, name in enumerate(fields)})
    w = Window.partitionBy(*group, "_kind").orderBy(*order, F.col(record_id).asc())
    top = tagged.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    picked = [F.max(F.when(F.col("_kind") == 0, F.col(record_id))).alias(record_id)]
    for i, name in enumerate(fields):
        mine = F.col("_kind") == i + 1
        picked += [F.max(F.when(mine, F.col(name))).alias(name), F.max(F.when(mine, F.col(record_id))).alias(f"{name}_{record_id}")]
    survivors = top.groupBy(*group).agg(*picked)
    several = known.groupBy(*group).agg(F.min(record_id).alias("_a"), F.max(record_id).alias("_b")).where("_a <> _b").select(*group)
    return survivors.join(several, list(group), "left_semi")
