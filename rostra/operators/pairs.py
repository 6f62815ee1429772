"""Most similar pairs of entities by the cosine of their TF-IDF vectors.

Entities stand in blocks, in the order of their names. Pairs of blocks, not terms, are what
work is dealt out by: a task gets the rows of two blocks and multiplies them. For the most
similar pairs most of these products are not computed. The greatest weight of every term in
a block bounds the similarity of any entity with any of that block; pairs of blocks whose
bound lies below the current n-th best similarity are left out, and a task keeps only what can be
among the n best.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.functions.scores import rank_key, round2
from rostra.runtime import dense_row_number, fits_broadcast, materialize
from rostra.schemas import RANK_DECIMALS, SIMILAR_PAIRS, SIMILAR_PAIRS_SHOWN

BLOCK = 256  # entities per block at most: a task holds BLOCK x BLOCK sums
ENTRIES_PER_BLOCK = 4_000_000  # weights of a block in all of its slices, about
ENTRIES_PER_TASK = 250_000  # weights of a block and slice that a task holds, about
FIRST_WAVE = 4  # pairs of blocks per core whose products raise the n-th best first
_CHUNK = 2048  # terms multiplied at a time
_PAIRS = "no_a long, no_b long, similarity double"


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


class Blocks:
    """Entities in blocks, and the weights of every block term by term, cut into slices.

    The slices cut blocks by term where they are larger than a task should hold, or where few
    pairs of blocks would leave cores idle.
    """

    def __init__(self, vectors: DataFrame, numbers: DataFrame, size: int, slices: int):
        self.numbers, self.size, self.slices = numbers, size, slices
        placed = vectors.select("entity", "term", "weight").join(_small(numbers), "entity")
        entry = F.struct((F.col("no") % size).cast("int").alias("pos"), "weight")
        block = F.floor(F.col("no") / size).alias("block")
        part = F.pmod(F.xxhash64("term"), F.lit(slices)).alias("slice")
        rows = placed.groupBy(block, part, "term").agg(F.collect_list(entry).alias("entries"))
        self.rows = materialize(rows, "packed")  # at most `size` entries in a row
        self.count = -(-numbers.count() // size)

    def most(self) -> DataFrame:
        """The greatest weight of every term in a block, in the form of block rows."""
        entry = F.struct((F.col("block") % BLOCK).cast("int").alias("pos"), F.array_max("entries.weight").alias("weight"))
        group = F.floor(F.col("block") / BLOCK).alias("block")
        return self.rows.groupBy(group, "term").agg(F.collect_list(entry).alias("entries"))

    def all_pairs(self) -> DataFrame:
        """(block_a, block_b) with block_a <= block_b; one row per pair of blocks."""
        first = self.rows.sparkSession.range(self.count).withColumnRenamed("id", "block_a")
        second = F.explode(F.sequence("block_a", F.lit(self.count - 1).cast("long")))
        return first.withColumn("block_b", second)


def _sliced(rows: DataFrame, slices: int) -> DataFrame:
    return rows.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(slices)))


def _products(
    left: DataFrame, right: DataFrame, pairs: DataFrame, slices: int, shape: tuple[int, int], found: Callable, schema: str
) -> DataFrame:
    """``found`` on the products of both blocks of every pair, whose rows stand in ``slices``.

    The products of a slice are one packed matrix; those of a pair of blocks are added up one by one.
    """
    keys = ["block_a", "block_b"]
    pairs = _small(pairs.select(*keys))
    a = left.withColumnRenamed("block", "block_a").join(pairs, "block_a")
    b = right.withColumnRenamed("block", "block_b").join(pairs, "block_b")
    b = b.select(*[F.col(c).alias(c) for c in b.columns])  # both sides may be one table

    def whole(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return found(key[0].as_py(), key[1].as_py(), _sums(left, right, *shape))

    def part(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        total = _sums(left, right, *shape)
        packed = [total.tobytes()] if total.any() else []
        block_a, block_b = ([key[i].as_py()] * len(packed) for i in (0, 1))
        return pa.table(
            {"block_a": pa.array(block_a, pa.int64()), "block_b": pa.array(block_b, pa.int64()),
             "total": pa.array(packed, pa.binary())}
        )

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for packed in batch.column("total"):
                total += np.frombuffer(packed.as_buffer()).reshape(shape)
        yield from found(key[0].as_py(), key[1].as_py(), total).to_batches()

    cut = a.groupBy(*keys, "slice").cogroup(b.groupBy(*keys, "slice"))
    if slices == 1:
        return cut.applyInArrow(whole, schema)
    parts = cut.applyInArrow(part, "block_a long, block_b long, total binary")
    return parts.groupBy(*keys).applyInArrow(added, schema)


def _dense(entries: pa.ListArray, size: int) -> np.ndarray:
    """Entities x terms of some rows."""
    lengths = np.diff(entries.offsets.to_numpy())
    flat = entries.flatten()
    matrix = np.zeros((size, len(entries)))
    matrix[flat.field("pos").to_numpy(), np.repeat(np.arange(len(entries)), lengths)] = flat.field("weight").to_numpy()
    return matrix


def _sums(left: pa.Table, right: pa.Table, rows: int, columns: int) -> np.ndarray:
    """The products of all entities of two blocks over the terms that both hold."""
    total = np.zeros((rows, columns))
    left, right = left.combine_chunks(), right.combine_chunks()
    if not left.num_rows or not right.num_rows:
        return total
    found = pc.index_in(right.column("term"), value_set=left.column("term").combine_chunks())
    at = found.to_numpy()
    both = np.flatnonzero(~np.isnan(at.astype(float)))
    a, b = left.column("entries").combine_chunks(), right.column("entries").combine_chunks()
    for start in range(0, len(both), _CHUNK):
        part = both[start : start + _CHUNK]
        own = a.take(pa.array(at[part].astype(np.int64)))
        total += _dense(own, rows) @ _dense(b.take(pa.array(part)), columns).T
    return total


def _multiplied(size: int, keep: int | None) -> Callable:
    """Similarities of two blocks; with ``keep`` only those that can be among so many best."""

    def found(block_a: int, block_b: int, total: np.ndarray) -> pa.Table:
        if block_a == block_b:
            total = np.triu(total, 1)
        rows, columns = np.nonzero(total)
        values = total[rows, columns]
        if keep is not None and len(values) > keep:
            # in the order of the ranking: rounded similarity, then the entities
            best = np.lexsort((columns, rows, -np.round(values, RANK_DECIMALS)))[:keep]
            rows, columns, values = rows[best], columns[best], values[best]
        return pa.table(
            {
                "no_a": pa.array(rows + block_a * size, pa.int64()),
                "no_b": pa.array(columns + block_b * size, pa.int64()),
                "similarity": pa.array(values, pa.float64()),
            }
        )

    return found


def _bounded(blocks: int) -> Callable:
    """Per block of a group of ``blocks``: the greatest product of its maxima with an entity."""

    def found(block: int, group: int, total: np.ndarray) -> pa.Table:
        most = total.max(axis=0)
        at = np.flatnonzero(most)
        return pa.table(
            {
                "block": pa.array(np.full(len(at), block, np.int64)),
                "other": pa.array(at + group * blocks, pa.int64()),
                "bound": pa.array(most[at], pa.float64()),
            }
        )

    return found


def _numbered(vectors: DataFrame) -> DataFrame:
    """(entity, no) in the order of the names, so no_a < no_b means entity_a < entity_b."""
    names = vectors.select("entity").distinct()
    return materialize(dense_row_number(names, "no", [F.col("entity")]), "entities")


def _blocks(vectors: DataFrame) -> Blocks:
    numbers = _numbered(vectors)
    counts = vectors.groupBy("entity").agg(F.count("*").alias("n"))
    widest = counts.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    size = min(BLOCK, max(1, ENTRIES_PER_BLOCK // widest))
    count = numbers.count()
    blocks = max(-(-count // size), 1)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    slices = max(
        -(-min(size, count) * widest // ENTRIES_PER_TASK), -(-2 * cores // (blocks * (blocks + 1) // 2)), 1
    )
    return Blocks(vectors, numbers, size, slices)


def _similarities(blocks: Blocks, pairs: DataFrame, keep: int | None = None) -> DataFrame:
    """(no_a, no_b, similarity) of the pairs of entities of some pairs of blocks."""
    found, shape = _multiplied(blocks.size, keep), (blocks.size, blocks.size)
    return _products(blocks.rows, blocks.rows, pairs, blocks.slices, shape, found, _PAIRS)


def entity_similarities(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cosines of all pairs of entities that share a term, and the entity numbers.

    ``vectors`` holds unit vectors ``(entity, term, weight)``. Returns
    ``(no_a, no_b, similarity)`` with ``no_a < no_b``, and ``(entity, no)``.
    """
    blocks = _blocks(vectors)
    return _similarities(blocks, blocks.all_pairs()), blocks.numbers


def block_bounds(blocks: Blocks) -> DataFrame:
    """(block_a, block_b, bound) for block_a < block_b: no similarity between them is above.

    The blocks' maxima are multiplied with the entities, for 1/BLOCK of the cost of all
    products; the lower of both directions counts. A group of blocks has more terms than a
    block, so it is cut into more slices.
    """
    spark, group = blocks.rows.sparkSession, -(-blocks.count // BLOCK)
    pairs = spark.range(blocks.count).withColumnRenamed("id", "block_a")
    pairs = pairs.withColumn("block_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(group - 1).cast("long"))))
    most = materialize(blocks.most(), "block-maxima")
    entries = most.groupBy("block").agg(F.sum(F.size("entries")).alias("n")).agg(F.max("n")).first()[0] or 0
    slices = max(blocks.slices, -(-entries // ENTRIES_PER_TASK))
    found = _products(
        _sliced(blocks.rows, slices), _sliced(most, slices), pairs, slices, (blocks.size, BLOCK), _bounded(BLOCK),
        "block long, other long, bound double",
    )
    one_way = found.where("block <> other")
    # no row means a bound of 0: then the other direction has none either
    return one_way.groupBy(
        F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b")
    ).agg(F.min("bound").alias("bound"))


def _best(pairs: DataFrame, n: int, name: str) -> DataFrame:
    order = [F.desc(rank_key(F.col("similarity"))), F.asc("no_a"), F.asc("no_b")]
    return materialize(pairs.orderBy(*order).limit(n), name)


def _least(best: DataFrame, n: int) -> float:
    """The n-th best similarity; minus infinity while there are fewer."""
    row = best.agg(F.count("*").alias("n"), F.min("similarity").alias("least")).first()
    return row["least"] if row["n"] >= n else float("-inf")


def best_pairs(vectors: DataFrame, n_pairs: int) -> tuple[DataFrame, DataFrame, int]:
    """The ``n_pairs`` most similar pairs, the entity numbers, and how many pairs of blocks
    were multiplied.

    Blocks with themselves come first, then the pairs of blocks of the greatest bounds, then
    the others whose bound still reaches the n-th best.
    """
    blocks = _blocks(vectors)
    spark = vectors.sparkSession
    own = spark.range(blocks.count).select(F.col("id").alias("block_a"), F.col("id").alias("block_b"))
    best = _best(_similarities(blocks, own, n_pairs), n_pairs, "best-pairs")
    multiplied = blocks.count
    if blocks.count > 1:
        bounds = materialize(block_bounds(blocks), "block-bounds")
        first = FIRST_WAVE * spark.sparkContext.defaultParallelism
        slack = 10.0**-RANK_DECIMALS  # similarities that close count as equal
        order = [F.desc("bound"), F.asc("block_a"), F.asc("block_b")]
        open_pairs = bounds
        for wave in (first, None):
            reach = open_pairs.where(F.col("bound") >= _least(best, n_pairs) - slack)
            now = materialize(reach.orderBy(*order).limit(wave) if wave else reach, "block-pairs")
            count = now.count()
            if not count:
                break
            multiplied += count
            found = _similarities(blocks, now, n_pairs)
            best = _best(best.unionByName(found), n_pairs, "best-pairs")
            open_pairs = reach.join(now.select("block_a", "block_b"), ["block_a", "block_b"], "left_anti")
    return best, blocks.numbers, multiplied


def similar_entities(vectors: DataFrame, n_pairs: int = SIMILAR_PAIRS) -> DataFrame:
    """The ``n_pairs`` most similar pairs, similarity rounded to two places."""
    best, numbers, _ = best_pairs(vectors, n_pairs)
    # n_pairs rows at most
    return (
        numbers.select(F.col("entity").alias("entity_b"), F.col("no").alias("no_b"))
        .join(
            F.broadcast(
                numbers.select(F.col("entity").alias("entity_a"), F.col("no").alias("no_a")).join(
                    F.broadcast(best), "no_a"
                )
            ),
            "no_b",
        )
        .select(
            "entity_a",
            "entity_b",
            "similarity",
            round2(F.col("similarity")).alias("similarity_rounded"),
        )
    )


def top_pairs(pairs: DataFrame, k: int = SIMILAR_PAIRS_SHOWN) -> DataFrame:
    """The first ``k`` of a list of similar pairs."""
    return pairs.orderBy(F.desc(rank_key(F.col("similarity"))), "entity_a", "entity_b").limit(k)
