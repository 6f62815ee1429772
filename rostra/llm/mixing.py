"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are numbered in the order of a hash of their id and cut into
blocks of ``block_rows`` (the last one holds the rest). With weight w, the k-th block of a
source (from 1) is released at slot floor((k - 1) / w) and due at ceil(k / w); every slot
takes, of the released blocks, the one with the earliest deadline. In every prefix each
source is then less than one block away from its share. When a source has no block left,
the weights of the others are scaled up and a new segment of the schedule begins with their
releases counted from there; so every document is placed once, and within each segment the
bound holds.

The schedule needs the number of rows per source only. Weights are exact fractions. The
driver works out one slot per block and hands them on in parts of ``PART_SLOTS``; the rows
meet them in a join. With a ``period`` weights are rounded to multiples of 1 / period.

Defined cases: a null source is a source of its own; a source without a target gets the
default (the share of its rows to the power ``temperature``); a target of a source that has
no rows is ignored; a null id has a place like others; rows that repeat an id, or have none,
are numbered one by one and fill as many blocks as they need.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.llm.common import small
from rostra.runtime import dense_row_number, scratch_path

BLOCK_ROWS = 64
PART_SLOTS = 1 << 18
TEMPERATURE = 0.7


@dataclass(frozen=True)
class Segment:
    """Slots between two sources' ends: per source its whole part of their sum, and first block."""

    first_slot: int
    parts: dict[int, int]
    first_block: dict[int, int]


def rounded(weights: dict[int, float], period: int) -> dict[int, int]:
    """Whole parts of the period, one at least, by the largest remainders."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (parts[s] - exact[s], s))
    while sum(parts.values()) < period:
        for s in order:
            if sum(parts.values()) < period:
                parts[s] += 1
    while sum(parts.values()) > period:
        s = max(parts, key=lambda s: (parts[s] - exact[s] if parts[s] > 1 else -1, s))
        parts[s] -= 1
    return parts


def one_period(parts: dict[int, int], period: int, length: int) -> dict[int, list[int]]:
    """Earliest deadline first over released blocks, for ``length`` slots of a period."""
    taken: dict[int, list[int]] = {s: [] for s in parts}
    waiting = [(0, s) for s in parts]  # by release
    ready: list[tuple[int, int]] = []  # by deadline
    heapq.heapify(waiting)
    for slot in range(length):
        while waiting and waiting[0][0] <= slot:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(len(taken[s]) + 1) * period // parts[s]), s))
        s = heapq.heappop(ready)[1]
        taken[s].append(slot)
        heapq.heappush(waiting, (len(taken[s]) * period // parts[s], s))
    return taken


def exact(weights: dict[int, float]) -> dict[int, int]:
    """Whole numbers in the very proportions of the weights."""
    fractions = {s: Fraction(w) for s, w in weights.items()}
    common = math.lcm(*(f.denominator for f in fractions.values()))
    return {s: int(f * common) for s, f in fractions.items()}


def slots(
    blocks: dict[int, int], weights: dict[int, float], period: int | None = None
) -> Iterator[tuple[Segment, int, int]]:
    """(segment, source, block) of every slot: earliest deadline first over released blocks."""
    left, done, slot = dict(blocks), dict.fromkeys(blocks, 0), 0
    while left:
        own = {s: weights[s] for s in left}
        parts = rounded(own, max(period, 8 * len(left))) if period else exact(own)
        total, begin, used = sum(parts.values()), slot, dict.fromkeys(left, 0)
        segment = Segment(begin, parts, {s: done[s] for s in left})
        waiting = [(0, s) for s in left]  # by release
        ready: list[tuple[int, int]] = []  # by deadline
        heapq.heapify(waiting)
        while True:
            while waiting and waiting[0][0] <= slot - begin:
                s = heapq.heappop(waiting)[1]
                heapq.heappush(ready, (-(-(used[s] + 1) * total // parts[s]), s))
            s = heapq.heappop(ready)[1]
            yield segment, s, done[s]
            slot += 1
            used[s] += 1
            done[s] += 1
            left[s] -= 1
            if not left[s]:
                del left[s]
                break
            heapq.heappush(waiting, (used[s] * total // parts[s], s))


def schedule(
    blocks: dict[int, int], weights: dict[int, float], period: int | None = None
) -> list[Segment]:
    """The segments for so many blocks per source."""
    return [segment for segment, _ in groupby(s for s, _, _ in slots(blocks, weights, period))]


def _slot_table(spark: SparkSession, found: Iterator[tuple[Segment, int, int]]) -> DataFrame:
    """The slots as a stored table, written in parts so that the driver holds one of them."""
    path = scratch_path(spark, "slots")
    schema = "_sid int, _block long, _segment int, _release long, _deadline long, _slot long"
    spark.createDataFrame([], schema).write.parquet(path)
    number, last, slot = -1, None, 0
    while part := list(islice(found, PART_SLOTS)):
        rows = []
        for segment, s, block in part:
            if segment is not last:
                number, last, total = number + 1, segment, sum(segment.parts.values())
            k, begin = block - segment.first_block[s], segment.first_slot
            release = begin + k * total // segment.parts[s]
            deadline = begin - (-(k + 1) * total // segment.parts[s])
            rows.append((s, block, number, release, deadline, slot))
            slot += 1
        frame = pa.table(list(map(pa.array, zip(*rows))), names=[f"c{i}" for i in range(6)])
        spark.createDataFrame(frame).toDF(*(f.split()[0] for f in schema.split(", "))).select(
            F.col("_sid").cast("int"), "_block", F.col("_segment").cast("int"), "_release", "_deadline", "_slot"
        ).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _hash(doc_id: str, seed: int) -> Column:
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(seed))


def _placed(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    period: int | None = None,
    temperature: float = TEMPERATURE,
    seed: int = 1,
) -> DataFrame:
    """(row, block, segment, release, deadline, slot); the row is a struct of all columns."""
    spark = docs.sparkSession
    counts = docs.groupBy("source").agg(F.count("*").alias("n")).orderBy("source").collect()
    names = [r["source"] for r in counts]
    total = sum(r["n"] for r in counts)
    blocks = {i: -(-r["n"] // block_rows) for i, r in enumerate(counts)}
    weights = {
        i: float((targets or {}).get(r["source"], (r["n"] / total) ** temperature))
        for i, r in enumerate(counts)
    }
    if any(w <= 0 for w in weights.values()):
        raise ValueError("target weights are above zero")
    source = spark.createDataFrame(list(enumerate(names)), "_sid int, _name string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("source").alias("_source"),
        _hash("doc_id", seed).alias("_hash"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    rows = rows.join(small(source), F.expr("_source <=> _name")).drop("_source", "_name")
    numbered = dense_row_number(rows, "_number", [F.col(c) for c in ("_sid", "_hash", "_tie")])
    # Rows are numbered source by source, in the order of their sids.
    before = [0, *accumulate(r["n"] for r in counts)]
    first = spark.createDataFrame(list(enumerate(before[:-1])), "_sid int, _before long")
    placed = numbered.join(small(first), "_sid").withColumn(
        "_block", F.expr(f"(_number - _before) div {int(block_rows)}")
    )
    table = _slot_table(spark, slots(blocks, weights, period))
    return placed.join(small(table), ["_sid", "_block"]).select(
        "row",
        F.col("_block").alias("block"),
        F.col("_segment").alias("segment"),
        F.col("_release").alias("release"),
        F.col("_deadline").alias("deadline"),
        F.col("_slot").alias("slot"),
    )


def mix(docs: DataFrame, *args, **settings) -> DataFrame:
    """doc_id, source, block, segment, release, deadline and slot of every document.

    Blocks, segments and slots count from 0. Release and deadline are slots: those of the
    k-th block since the segment's begin.
    """
    return _placed(docs.select("doc_id", "source"), *args, **settings).select(
        "row.doc_id", "row.source", "block", "segment", "release", "deadline", "slot"
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """All of ``docs`` in the order of the mix, columns as they are."""
    return (
        _placed(docs, **settings)
        .orderBy("slot", F.xxhash64(F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))))
        .select("row.*")
    )
