"""Filling sequences of fixed capacity with documents as tightly as possible.

Method: all that matters about the documents is how many there are of each length, a histogram of at most `capacity` entries.
Over it the configuration linear program - how often to use each way to fill a sequence - is solved by multiplicative
weights: every length has a price, a knapsack by dynamic programming finds the filling of the highest price, that filling is
used a little, and the prices of the lengths it served fall in proportion to the share of their demand. The fractional
solution is rounded down, the rest is packed best-fit decreasing, and the documents, numbered within their length in
parallel, take the places. The plan is as small as the histogram, whatever the number of documents; `least_sequences` says how
far it can be from the best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.session import settled

#: pieces of one length that are numbered in one task
BUCKET_PIECES = 1_000_000


@dataclass(frozen=True)
class Plan:
    """Places by length: copy number r of a length goes to the run with the greatest first <= r, and there to sequence
    sequence + (r - first) // copies, at position + ((r - first) % copies) * length."""

    length: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    position: np.ndarray
    sequences: int


def best_filling(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """How often to take each length for the highest total price within the capacity (unbounded knapsack, exact)."""
    dense = np.full(capacity + 1, -1.0)
    dense[lengths] = prices
    number = np.zeros(capacity + 1, dtype=np.int64)
    number[lengths] = np.arange(len(lengths))
    # backwards holds the best value of `room` at capacity - room, so that candidates for a room are one contiguous sum
    backwards = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1, dtype=np.int64)
    value = np.empty(capacity)
    for room in range(int(lengths[0]), capacity + 1):
        np.add(dense[1 : room + 1], backwards[capacity - room + 1 :], out=value[:room])
        at = int(value[:room].argmax())
        if value[at] > backwards[capacity - room + 1]:
            backwards[capacity - room], took[room] = value[at], number[at + 1]
        else:
            backwards[capacity - room] = backwards[capacity - room + 1]
    counts = np.zeros(len(lengths), dtype=np.int64)
    room = capacity
    while room >= lengths[0]:
        if took[room] < 0:
            room -= 1
            continue
        counts[took[room]] += 1
        room -= lengths[took[room]]
    return counts


def configuration_lp(lengths: np.ndarray, demand: np.ndarray, capacity: int, sharpness: float = 3.0, rounds: int = 6000) -> list[tuple[np.ndarray, float]]:
    """(filling, how often) that together cover the demand fractionally, by multiplicative weights.

    Prices start at the lengths - with them every full sequence is worth the same - and a length served fraction c of its
    demand costs exp(-sharpness * c) of that. A length served in full is worth nothing. Each round uses the best filling until
    some length in it gains a step of its demand. The rounds needed are about the number of lengths over the step, so the fewer
    lengths, the smaller it is: a 3000th per length. What is uncovered after `rounds` is left to the rounding.
    """
    step = min(0.3, max(0.01, len(lengths) / 3000))
    volume = lengths / capacity
    covered = np.zeros(len(lengths))
    out: list[tuple[np.ndarray, float]] = []
    for _ in range(rounds):
        open_ = covered < 1 - 1e-9
        if not open_.any():
            break
        own = np.flatnonzero(open_)
        counts = np.zeros(len(lengths), dtype=np.int64)
        counts[own] = best_filling(volume[own] * np.exp(-sharpness * covered[own]), lengths[own], capacity)
        used = counts > 0
        amount = float(min(step * (demand[used] / counts[used]).min(), ((1 - covered[used]) * demand[used] / counts[used]).min()))
        covered[used] += amount * counts[used] / demand[used]
        out.append((counts, amount))
    return out


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Fillings for what is left: the longest item first, then ever the longest that still fits, used as often as it can be."""
    left = left.copy()
    out = []
    while left.any():
        counts = np.zeros(len(lengths), dtype=np.int64)
        room = capacity
        for at in range(len(lengths) - 1, -1, -1):
            if left[at] and lengths[at] <= room:
                counts[at] = min(left[at], room // lengths[at])
                room -= counts[at] * lengths[at]
        used = counts > 0
        times = int((left[used] // counts[used]).min())
        left -= counts * times
        out.append((counts, times))
    return out


def plan_sequences(histogram: dict[int, int], capacity: int) -> Plan:
    """The plan for so many items of each length (1 to capacity)."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[n] for n in lengths], dtype=np.int64)
    fillings: list[tuple[np.ndarray, int]] = []
    left = demand.copy()
    if len(lengths):
        merged: dict[bytes, list] = {}
        for counts, amount in configuration_lp(lengths, demand, capacity):
            merged.setdefault(counts.tobytes(), [counts, 0.0])[1] += amount
        for counts, amount in sorted(merged.values(), key=lambda x: -x[1]):
            used = counts > 0
            times = min(int(amount + 1e-6), int((left[used] // counts[used]).min()))
            if times:
                left -= counts * times
                fillings.append((counts, times))
        fillings += _best_fit(lengths, left, capacity)
    runs, sequence, served = [], 0, np.zeros(len(lengths), dtype=np.int64)
    for counts, times in fillings:
        position = 0
        for at in np.flatnonzero(counts):
            runs.append((lengths[at], served[at], counts[at], sequence, position))
            served[at] += counts[at] * times
            position += int(counts[at] * lengths[at])
        sequence += times
    runs.sort(key=lambda r: (r[0], r[1]))
    columns = np.array(runs, dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=sequence)


def least_sequences(histogram: dict[int, int], capacity: int) -> int:
    """A number of sequences that no packing can go below: over all thresholds, the lengths that leave less than the threshold
    take a sequence each, and those from the threshold on their share of the room that is left beside half-full ones."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return 0
    demand = np.array([histogram[n] for n in lengths], dtype=np.int64)
    best = 0
    for least in {0, *(int(n) for n in lengths if 2 * n <= capacity)}:
        alone, large, small = lengths > capacity - least, (lengths <= capacity - least) & (2 * lengths > capacity), (2 * lengths <= capacity) & (lengths >= least)
        room = int(demand[large].sum()) * capacity - int((demand * lengths)[large].sum())
        more = max(0, -(-(int((demand * lengths)[small].sum()) - room) // capacity))
        best = max(best, int(demand[alone | large].sum()) + more)
    return best


def sizes(items: DataFrame) -> DataFrame:
    """(doc_id, size) of items (doc_id, n_tokens), null and negative numbers as 0, kept in the shared folder: counting may be dear."""
    return settled(items.select("doc_id", F.greatest(F.lit(0), F.coalesce(F.col("n_tokens"), F.lit(0))).cast("int").alias("size")))


def pieces_of(sized: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece, length) of sizes: pieces of the capacity and a rest where a document is longer, else one."""
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / capacity).cast("int") - 1)
    pieces = sized.select("doc_id", "size", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    return pieces.select("doc_id", "piece", F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity).alias("length"))


def histogram_of(pieces: DataFrame) -> dict[int, int]:
    """Number of pieces of each length: at most capacity + 1 entries."""
    return {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}


def pack(items: DataFrame, capacity: int, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """(doc_id, piece, sequence_id, position, n_tokens) of every piece of every document.

    items: doc_id, n_tokens. A document longer than the capacity is cut into pieces of the capacity and a rest; no other
    document is. Pieces of one sequence don't overlap and stay within the capacity. An empty document (0 or null tokens) takes
    no place: one row with n_tokens 0 and null sequence and position. Repeated doc_ids are packed each. Other columns are ignored.

    Pieces are numbered within (length, bucket), with as many buckets as keep one at about bucket_pieces, so that no length is
    gathered in one task; where a bucket's numbers start comes from a running sum over the counts, not from the driver.
    """
    spark = items.sparkSession
    pieces = pieces_of(sizes(items), capacity)
    histogram = histogram_of(pieces)
    buckets = -(-max(histogram.values(), default=1) // bucket_pieces)
    histogram.pop(0, None)
    plan = spark.sparkContext.broadcast(plan_sequences(histogram, capacity))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece"))
    numbered = pieces.withColumn("n", number).join(starts, ["length", "bucket"]).select("doc_id", "piece", "length", (F.col("start") + F.col("n") - 1).alias("copy"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = plan.value
        stride = int(p.first.max(initial=0)) + 1 if len(p.first) else 1
        # runs are sorted by (length, first): one search over a combined key finds the run of every row
        keys = p.length.astype(object) * stride + p.first if stride > (1 << 50) else p.length * stride + p.first
        for pdf in batches:
            length, copy = pdf["length"].to_numpy(np.int64), pdf["copy"].to_numpy(np.int64)
            placed = length > 0
            sequence, position = np.full(len(pdf), -1, dtype=np.int64), np.full(len(pdf), -1, dtype=np.int64)
            if placed.any():
                size, at = length[placed], np.minimum(copy[placed], stride - 1)
                run = np.searchsorted(keys, size * stride + at, side="right") - 1
                beyond = copy[placed] - p.first[run]
                sequence[placed] = p.sequence[run] + beyond // p.copies[run]
                position[placed] = p.position[run] + beyond % p.copies[run] * size
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "piece": pdf["piece"], "sequence_id": pd.Series(sequence, dtype="Int64").mask(~placed), "position": pd.Series(position, dtype="Int64").mask(~placed).astype("Int32"), "n_tokens": pdf["length"]}
            )

    id_type = items.schema["doc_id"].dataType.simpleString()
    return numbered.mapInPandas(place, f"doc_id {id_type}, piece int, sequence_id bigint, position int, n_tokens int")


def quality(items: DataFrame, capacity: int) -> DataFrame:
    """One row: tokens, sequences of the plan, and the number no packing can go below."""
    histogram = histogram_of(pieces_of(sizes(items), capacity))
    histogram.pop(0, None)
    row = (sum(n * length for length, n in histogram.items()), plan_sequences(histogram, capacity).sequences, least_sequences(histogram, capacity))
    return items.sparkSession.createDataFrame([row], "n_tokens long, sequences long, least_sequences long")
