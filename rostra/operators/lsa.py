"""Latent semantic vectors: truncated SVD of TF-IDF documents, and cosine search."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rostra.functions.scores import rank_key
from rostra.functions.text import Preprocess
from rostra.operators.index import tfidf_rows, with_term_id
from rostra.operators.search import drop_last_hit, query_terms
from rostra.runtime import dense_row_number, discard, fits_broadcast, materialize, rank_within, scratch_path
from rostra.schemas import SCORE_THRESHOLD, SVD_COMPONENTS, SVD_KEPT
from rostra.sources.tables import write_keyed, write_table

OVERSAMPLES = 10
POWER_ITERATIONS = 5
DOCS_PER_BLOCK = 16_000  # at most; fewer where their terms would pass BLOCK_BYTES
BLOCK_BYTES = 512 * 1024 * 1024  # rows of the basis and of the sums for the distinct terms of a block
PROJECT_BYTES = 128 * 1024 * 1024  # the same in ``project``, whose vectors are doubles
_BUCKETS = 512  # four a block up to these: few blocks share a bucket, none waits for another
RARE = 10  # documents of a term that few share
SETTLED = 1e-4  # singular values that change less, against the greatest, end the iteration
WIRE = np.float32  # numbers of the last basis; sums are taken in doubles
SHORT = np.int16  # numbers of the bases before it, as parts of the greatest of their row
_COLUMNS_PER_STEP = 28  # columns of a basis multiplied at a time
_ROWS_PER_STEP = 65_536
_ENTRIES_PER_STEP = 16_384  # entries multiplied at a time: bounds the memory of a product
_LONG_GROUP = 64  # entries of a group that is multiplied by itself
_GROUPS_PER_STEP = 1_024  # shorter groups that are added up side by side: their sums stay in the cache
_ROWS_PER_BUCKET = 100_000  # vectors summed in one task
_BLOCKS_PER_SUM = 256  # rows of one term that a task sums, about
_RANK_TOLERANCE = 1e-12
QUERY_BYTES = 8 * 1024 * 1024  # query vectors that go to all tasks at once
VECTORS_PER_STEP = 4_096


# --- Arrow helpers --------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(0, rows * width + 1, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def _unpack(column: pa.ChunkedArray | pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """A column of packed numbers as a matrix of doubles, without a step per number."""
    if kind is SHORT:
        packed = _numbers(column, width + 2, SHORT)
        unit = np.ascontiguousarray(packed[:, :2]).view(np.float32).astype(np.float64)
        return packed[:, 2:] * unit
    return _numbers(column, width, kind).astype(np.float64, copy=False)


def _numbers(column: pa.ChunkedArray | pa.Array, width: int, kind: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, size = column.buffers()[2], np.dtype(kind).itemsize
    if not len(column) or data is None:
        return np.zeros((0, width), kind)
    numbers = np.frombuffer(data, np.uint8)
    start = column.offset * width * size
    return numbers[start : start + len(column) * width * size].view(kind).reshape(-1, width)


def _pack(matrix: np.ndarray, kind: type = np.float64) -> pa.Array:
    """Rows of a matrix as binary values: Spark moves each as one block of bytes.

    Short numbers stand behind their unit, the greatest of the row by size over 32,767.
    """
    if kind is SHORT:
        short = np.zeros((matrix.shape[0], matrix.shape[1] + 2), SHORT)
        for start in range(0, len(matrix), _ROWS_PER_STEP):
            part = matrix[start : start + _ROWS_PER_STEP]
            unit = (np.abs(part).max(1, initial=0) / 32_767).astype(np.float32)
            parts = np.divide(part, unit[:, None], out=np.zeros(part.shape), where=unit[:, None] > 0)
            at = slice(start, start + len(part))
            short[at, :2] = unit[:, None].view(SHORT)
            short[at, 2:] = np.clip(np.rint(parts), -32_767, 32_767)
        matrix = short
    rows, width = matrix.shape
    size = np.dtype(kind).itemsize
    offsets = pa.py_buffer(np.arange(0, (rows + 1) * width * size, width * size, dtype=np.int32))
    data = pa.py_buffer(np.ascontiguousarray(matrix, kind))
    return pa.Array.from_buffers(pa.binary(), rows, [None, offsets, data])


def _grouped_sums(
    group: np.ndarray, n_groups: int, index: np.ndarray, weights: np.ndarray, dense: np.ndarray
) -> np.ndarray:
    """``out[g] = sum of weights * dense[index]`` over the entries of group ``g``, in order of g.

    A long group is one product of its weights with its rows. Short groups stand by their
    length, and their first entries are added at once, then their second ones, and so on.
    """
    out = np.zeros((n_groups, dense.shape[1]))
    if not len(group):
        return out
    first = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    ids, many = group[first[:-1]], np.diff(first)
    for i in np.flatnonzero(many >= _LONG_GROUP).tolist():
        for start in range(first[i], first[i + 1], _ENTRIES_PER_STEP):
            part = slice(start, min(start + _ENTRIES_PER_STEP, first[i + 1]))
            out[ids[i]] += weights[part] @ dense.take(index[part], axis=0, mode="clip")
    short = np.flatnonzero(many < _LONG_GROUP)
    short = short[np.argsort(-many[short], kind="stable")]
    for start in range(0, len(short), _GROUPS_PER_STEP):
        some = short[start : start + _GROUPS_PER_STEP]
        begin, size = first[some], many[some]
        sums = np.zeros((len(some), dense.shape[1]))
        for place in range(size[0]):
            at = begin[: np.searchsorted(-size, -place)] + place
            rows = dense.take(index.take(at), axis=0, mode="clip")
            rows *= weights.take(at)[:, None]
            sums[: len(at)] += rows
        out[ids[some]] = sums
    return out


def _block_entries(docs: pa.Table, term_ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, column and weight of every entry of a block of documents, in order of the row."""
    ids = docs.column("term_ids").combine_chunks()
    row = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(ids.offsets.to_numpy()))
    column = pc.index_in(ids.flatten(), pa.array(term_ids)).to_numpy(zero_copy_only=False)
    weights = docs.column("weights").combine_chunks().flatten()
    return row, column, weights.to_numpy(zero_copy_only=False)


# --- Truncated SVD --------------------------------------------------------------------------


@dataclass(frozen=True)
class Lsa:
    """A fitted model: all parts are tables, the singular values are a short list."""

    docs: DataFrame  # doc_id, vec (the kept dimensions)
    terms: DataFrame  # term, term_id, df, idf, comp (all components)
    singular_values: list[float]
    kept: int


def write_lsa(model: Lsa, root: str) -> None:
    """Store a model below ``root``: documents and terms by key, singular values by place."""
    write_keyed(model.docs, f"{root}/lsa_docs", "doc_id")
    write_keyed(model.terms, f"{root}/lsa_terms", "term")
    values = list(enumerate(model.singular_values))
    spark = model.docs.sparkSession
    write_table(spark.createDataFrame(values, "place int, value double").coalesce(1), f"{root}/lsa_values")


def read_lsa(spark: SparkSession, root: str) -> Lsa:
    """A model as ``write_lsa`` stored it."""
    values = spark.read.parquet(f"{root}/lsa_values").orderBy("place").collect()  # one per component
    docs = spark.read.parquet(f"{root}/lsa_docs")
    kept = docs.select(F.size("vec")).first()
    return Lsa(
        docs, spark.read.parquet(f"{root}/lsa_terms"), [r["value"] for r in values], kept[0] if kept else 0
    )


def _start(term_ids: np.ndarray, width: int, seed: int, columns: slice = slice(None)) -> np.ndarray:
    """Reproducible uniform numbers in [-1, 1) from term number, column and seed."""
    x = term_ids.astype(np.uint64)[:, None] * np.uint64(width) + np.arange(width, dtype=np.uint64)[columns]
    x = x + np.uint64(seed + 1) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x = x ^ (x >> np.uint64(31))
    return x.astype(np.float64) / 2.0**63 - 1.0


def _basis_columns(
    terms: pa.Table, mix: np.ndarray | None, width: int, seed: int, kind: type
) -> Iterator[tuple[slice, np.ndarray]]:
    """Some columns at a time of the basis times ``mix``, or of the random start."""
    n = width if mix is None else mix.shape[1]
    for start in range(0, n, _COLUMNS_PER_STEP):
        columns = slice(start, min(start + _COLUMNS_PER_STEP, n))
        dense = np.empty((terms.num_rows, columns.stop - start))
        for first in range(0, terms.num_rows, _ROWS_PER_STEP):
            part = terms.slice(first, _ROWS_PER_STEP)
            if mix is None:
                rows = _start(part.column("term_id").to_numpy(), width, seed, columns)
            else:
                rows = _unpack(part.column("vec"), mix.shape[0], kind) @ mix[:, columns]
            dense[first : first + len(rows)] = rows
        yield columns, dense


def _gram_step(mix: np.ndarray | None, width: int, seed: int, comes: type, goes: type) -> Callable:
    """Per block of documents X: the part of ``X'X (Z mix)`` that the block adds.

    ``comes`` and ``goes`` are the kinds of numbers of the basis and of the sums.
    """

    def step(docs: pa.Table, terms: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _EMPTY_BASIS
        term_ids = terms.column("term_id").to_numpy()
        row, column, weight = _block_entries(docs, term_ids)
        order = np.argsort(column, kind="stable")
        by_column = column[order], row[order], weight[order]
        del order
        back = np.empty((len(term_ids), width if mix is None else mix.shape[1]), np.float32)
        for columns, basis in _basis_columns(terms, mix, width, seed, comes):
            image = _grouped_sums(row, docs.num_rows, column, weight, basis)
            group, index, weights = by_column
            back[:, columns] = _grouped_sums(group, len(term_ids), index, weights, image)
        return pa.table({"term_id": term_ids, "vec": _pack(back, goes)})

    return step


_EMPTY_BASIS = pa.table({"term_id": pa.array([], pa.int64()), "vec": pa.array([], pa.binary())})


def _summed(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal ids added up."""
    order = np.argsort(ids, kind="stable")
    ids, many = np.unique(ids, return_counts=True)
    group = np.repeat(np.arange(len(ids)), many)
    return ids, _grouped_sums(group, len(ids), order, np.ones(len(order)), rows) if len(ids) else rows


def _sum_step(width: int, kind: type) -> Callable:
    """Sum the rows of each term within a bucket of terms, batch by batch.

    The first row of a term takes the next place, those after it are added there.
    """

    def step(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        ids, places, sums = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width))
        for batch in batches:
            own, part = _summed(batch.column("term_id").to_numpy(), _unpack(batch.column("vec"), width, kind))
            at = np.searchsorted(ids, own)
            old = np.zeros(len(own), bool)
            inside = at < len(ids)
            old[inside] = ids[at[inside]] == own[inside]
            sums[places[at[old]]] += part[old]
            used, new = len(ids), int((~old).sum())
            if used + new > len(sums):
                more = np.zeros((max(used + new, len(sums) * 3 // 2), width))
                more[:used] = sums[:used]
                sums = more
            sums[used : used + new] = part[~old]
            ids = np.concatenate([ids, own[~old]])
            places = np.concatenate([places, np.arange(used, used + new)])
            order = np.argsort(ids, kind="stable")
            ids, places = ids[order], places[order]
        found = np.empty(len(ids), np.int64)
        found[places] = ids
        yield pa.RecordBatch.from_arrays([pa.array(found), _pack(sums[: len(ids)], kind)], names=["term_id", "vec"])

    return step


def _project_step(mix: np.ndarray, kind: type = WIRE) -> Callable:
    """Per block of documents X: the rows of ``X (Z mix)``."""

    def step(docs: pa.Table, terms: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "vec": pa.array([], pa.binary())})
        row, column, weight = _block_entries(docs, terms.column("term_id").to_numpy())
        image = np.empty((docs.num_rows, mix.shape[1]))
        for columns, basis in _basis_columns(terms, mix, 0, 0, kind):
            image[:, columns] = _grouped_sums(row, docs.num_rows, column, weight, basis)
        return pa.table({"doc_id": docs.column("doc_id"), "vec": _pack(image)})

    return step


def _small_gram(vectors: DataFrame, width: int, kind: type) -> np.ndarray:
    """``V'V`` of a tall table of vectors: every task sends one ``width x width`` matrix."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            block = _unpack(batch.column("vec"), width, kind)
            total += block.T @ block
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int64()), _pack(total)], names=["term_id", "vec"]
        )

    parts = vectors.select("vec").mapInArrow(partial, _BASIS)
    sums = parts.groupBy("term_id").applyInArrow(_sum_step(width, np.float64), _BASIS)
    return np.array([np.frombuffer(row["vec"]) for row in sums.orderBy("term_id").collect()])


_BASIS = "term_id long, vec binary"


def _vector_sum(vec: Column, width: int) -> Column:
    """Element-wise sum of equally long arrays, one native sum per element."""
    return F.array(*[F.sum(F.get(vec, F.lit(j))) for j in range(width)])


def _whiten(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``M`` such that ``Z M`` has orthonormal columns, and the singular values of ``Z``.

    Directions without weight drop out.
    """
    values, vectors = np.linalg.eigh(gram)
    keep = values > values.max() * _RANK_TOLERANCE
    return vectors[:, keep] / np.sqrt(values[keep]), np.sqrt(values[keep])[::-1]


def _has_settled(now: np.ndarray, before: np.ndarray | None, n: int) -> bool:
    """Whether the first ``n`` singular values of X changed little; those of X'X are given."""
    if before is None or len(now) != len(before):
        return False
    now, before = np.sqrt(now[:n]), np.sqrt(before[:n])
    return bool(np.abs(now - before).max() <= SETTLED * now[0])


def _hashed_blocks(docs: DataFrame, n_docs: int, width: int, docs_per_block: int):
    """Documents with their block, the distinct ``(block, term_id)``, and the number of blocks.

    Blocks are cut until the basis rows of the terms of each stay within ``PROJECT_BYTES``.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(-(-n_docs // docs_per_block), cores)
    most = max(PROJECT_BYTES // (width * np.dtype(WIRE).itemsize), 1)
    while True:
        block = F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).alias("block")
        placed = docs.select(block, "doc_id", "term_ids", "weights")
        terms = placed.select("block", F.explode("term_ids").alias("term_id")).distinct()
        needed = materialize(terms, "needed")
        largest = needed.groupBy("block").count().agg(F.max("count")).first()[0] or 0
        if largest <= most or n_blocks >= n_docs:
            return placed, needed, n_blocks
        n_blocks = min(n_blocks * -(-largest // most), n_docs)


def _alike(entries: str, n_docs: int) -> list[Column]:
    """What documents are ordered by, so that neighbours share terms.

    The heaviest of the terms that a tenth of the documents hold tells the language, the
    heaviest of the terms between shows the topic, and near copies share the least hash of
    their rare terms.
    """

    def heaviest(of: Callable[[Column], Column]) -> Column:
        weights = F.transform(F.filter(entries, of), lambda e: F.struct(e["weight"], e["term_id"]))
        return F.array_max(weights)["term_id"]

    rare = F.filter(entries, lambda e: e["df"].between(2, RARE))
    return [
        heaviest(lambda e: e["df"] * 10 >= n_docs).alias("common"),
        heaviest(lambda e: (e["df"] > RARE * RARE) & (e["df"] * 10 < n_docs)).alias("topic"),
        F.array_min(F.transform(rare, lambda e: F.xxhash64(e["term_id"]))).alias("rare"),
    ]


def _needed_terms(rows: DataFrame, n_docs: int, width: int, docs_per_block: int):
    """Documents stored by block, the distinct ``(block, term_id)``, and the number of blocks.

    Documents are cut into blocks of one size in the order of ``_alike``, which leaves fewer
    pairs of a block and a term than chance does, and blocks are made smaller until the rows
    of the terms of each stay within ``BLOCK_BYTES``. The table is bucketed by
    block: no pass shuffles a document.
    """
    spark = rows.sparkSession
    order = ["common", "topic", "rare", "doc_id"]
    places = dense_row_number(rows.select(*order), "place", [F.col(c) for c in order])
    places = materialize(places.select(F.col("doc_id").alias("of"), "place"), "places")
    if fits_broadcast(places):
        places = F.broadcast(places)
    placed = rows.join(places, F.col("doc_id").eqNullSafe(F.col("of"))).drop("of", *order[:-1])
    n_blocks = max(-(-n_docs // docs_per_block), spark.sparkContext.defaultParallelism)
    most = max(BLOCK_BYTES // (2 * width * np.dtype(WIRE).itemsize), 1)
    while True:
        block = F.floor(F.col("place") * n_blocks / max(n_docs, 1)).cast("int").alias("block")
        terms = placed.select(block, F.explode("term_ids").alias("term_id")).groupBy("block")
        largest = terms.agg(F.approx_count_distinct("term_id", 0.02).alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= most or n_blocks >= n_docs:
            docs = _bucketed(placed.select(block, "doc_id", "term_ids", "weights"), n_blocks)
            terms = docs.select("block", F.explode("term_ids").alias("term_id")).distinct()
            needed = materialize(terms, "needed")
            largest = needed.groupBy("block").count().agg(F.max("count")).first()[0] or 0
            if largest <= most or n_blocks >= n_docs:
                return docs, needed, n_blocks
        n_blocks = min(n_blocks * max(-(-largest // most), 2), n_docs)


def _bucketed(docs: DataFrame, n_blocks: int) -> DataFrame:
    """``docs`` stored so that a block lies in one bucket: grouping by block moves nothing."""
    spark, buckets = docs.sparkSession, max(n_blocks, min(4 * n_blocks, _BUCKETS))
    name = f"rostra_blocks_{uuid.uuid4().hex}"
    rows = docs.repartition(buckets, "block").write.option("path", scratch_path(spark, "blocks"))
    rows.bucketBy(buckets, "block").sortBy("block").format("parquet").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name; its files stay until drop_scratch
    return stored


def _unpacked(df: DataFrame, mix: np.ndarray, keep: list[str], name: str, kind: type) -> DataFrame:
    """``(keep..., name)``: the packed vectors, times ``part`` if there is one, times a small matrix."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            product = _scaled(batch, mix, kind)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), _lists(product)], names=[*keep, name]
            )

    columns = [*keep, *(c for c in ("vec", "part") if c in df.columns)]
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keep)
    return df.select(*columns).mapInArrow(multiply, f"{kinds}, {name} array<double>")


def _scaled(batch: pa.RecordBatch, mix: np.ndarray, kind: type) -> np.ndarray:
    product = _unpack(batch.column("vec"), mix.shape[0], kind) @ mix
    if "part" in batch.schema.names:
        product *= batch.column("part").to_numpy()[:, None]
    return product


def _signs(basis: DataFrame, mix: np.ndarray) -> np.ndarray:
    """Per component the sign of its largest entry by size, the first term winning ties.

    Every task sends one candidate per component.
    """

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("term_id").to_numpy()
                entries = _scaled(batch, mix, WIRE)
                sizes = np.round(np.abs(entries), 9)
                at = np.lexsort((np.broadcast_to(ids[:, None], sizes.shape), -sizes), axis=0)[0]
                dims = np.arange(len(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(dims, pa.int32()),
                        pa.array(sizes[at, dims]),
                        pa.array(ids[at], pa.int64()),
                        pa.array(np.sign(entries[at, dims])),
                    ],
                    names=["dim", "size", "term_id", "sign"],
                )

    found = basis.mapInArrow(candidates, "dim int, size double, term_id long, sign double")
    first = F.max_by("sign", F.struct("size", -F.col("term_id"))).alias("sign")
    rows = found.groupBy("dim").agg(first).orderBy("dim").collect()
    return np.array([-1.0 if row["sign"] < 0 else 1.0 for row in rows])


def lsa_fit(
    postings: DataFrame,
    vocab: DataFrame,
    n_components: int = SVD_COMPONENTS,
    kept: int = SVD_KEPT,
    min_df: int = 1,
    iterations: int = POWER_ITERATIONS,
    oversamples: int = OVERSAMPLES,
    docs_per_block: int = DOCS_PER_BLOCK,
    seed: int = 0,
    doc_ids: DataFrame | None = None,
) -> Lsa:
    """Truncated SVD of the L2-normalised TF-IDF matrix by randomised subspace iteration.

    The basis (terms x columns) stays a table. Documents are cut into blocks; each block
    meets the basis rows of its own terms only and sends back one summed row per term, so
    the shuffle grows with the distinct terms of the blocks, not with the postings times the
    columns; documents are stored by block and stay there (``_needed_terms``). Terms of a single document go as one (``_merged``). Blocks are cut by the memory
    their terms need, and the iteration ends early when the singular values rest; its last
    basis is in single precision, those before it in 16 bits. The driver sees matrices of
    columns x columns. Every product is written to the shared folder; what the next one
    replaces is deleted there, so the passes take the room of one. ``vocab`` holds
    ``term, df, idf``. Documents of ``doc_ids`` that have no term get a zero vector.
    """
    width = n_components + oversamples
    cores = postings.sparkSession.sparkContext.defaultParallelism
    numbered = materialize(with_term_id(vocab.where(F.col("df") >= min_df)), "terms")
    rows, members = _merged(tfidf_rows(postings, numbered, "term_id", "df"))
    docs, needed, n_blocks = _needed_terms(rows, rows.count(), width, docs_per_block)
    discard(rows)
    single = docs.withColumn("weights", F.col("weights").cast("array<float>"))
    n_buckets = max(-(-needed.count() // _ROWS_PER_BUCKET), cores)
    bucket = F.pmod(F.xxhash64("term_id"), F.lit(n_buckets)).alias("bucket")
    salts = -(-n_blocks // _BLOCKS_PER_SUM)
    salt = F.pmod(F.xxhash64("vec"), F.lit(salts)).alias("salt")

    basis, mix, values, kind, last = None, None, None, SHORT, iterations == 0
    for step in range(iterations + 1):
        goes = WIRE if last else SHORT
        part = _gram_step(mix, width, seed, kind, goes)
        back = _per_block(single, needed, basis).applyInArrow(part, _BASIS)
        rank, kind = width if mix is None else mix.shape[1], goes
        if salts > 1:  # a term of many blocks is summed in parts first
            back = back.groupBy(bucket, salt).applyInArrow(_sum_step(rank, kind), _BASIS)
        summed = back.groupBy(bucket).applyInArrow(_sum_step(rank, kind), _BASIS)
        spent, basis = basis, materialize(summed, f"basis-{step}")
        if spent is not None:
            discard(spent)
        before = values if step > 1 else None  # the first basis is not orthonormal yet
        mix, values = _whiten(_small_gram(basis, rank, kind))
        if last:
            break
        last = step + 1 == iterations or _has_settled(values, before, n_components)

    image = materialize(
        _per_block(docs, needed, basis).applyInArrow(
            _project_step(mix), "doc_id long, vec binary"
        ),
        "image",
    )
    discard(docs)
    values, rotation = np.linalg.eigh(_small_gram(image, mix.shape[1], np.float64))
    best = np.argsort(values)[::-1][: min(n_components, len(values))]
    rotation = rotation[:, best]
    every = _parted(numbered, basis, members)
    rotation = rotation * _signs(every, mix @ rotation)
    terms = _unpacked(every, mix @ rotation, ["term_id", "term", "df", "idf"], "comp", WIRE)
    kept = min(kept, len(best))
    vectors = _unpacked(image, rotation[:, :kept], ["doc_id"], "vec", np.float64)
    if doc_ids is not None:
        zeros = F.array_repeat(F.lit(0.0), kept)
        vectors = doc_ids.select("doc_id").join(vectors, "doc_id", "left").select(
            "doc_id", F.coalesce("vec", zeros).alias("vec")
        )
    return Lsa(
        docs=vectors,
        terms=terms,
        singular_values=np.sqrt(np.maximum(values[best], 0)).tolist(),
        kept=kept,
    )


def _merged(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``(doc_id, term_ids, weights)`` and what to order by, with the terms of one document merged.

    Columns of X with one entry each, in the same row, span what a single column of their
    length spans: X X' stays as it is, and a term's row of the basis is its part of the merged
    one. That stands at the heaviest of the terms; ``members`` holds ``term_id, at, part``.
    A vocabulary that counts another corpus may call a term of several documents single: then
    nothing is merged, and there are no members.
    """
    alone = F.filter("entries", lambda e: (e["df"] == 1) & (e["weight"] > 0))
    length = F.sqrt(F.aggregate("alone", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"]))
    heaviest = F.array_max(F.transform("alone", lambda e: F.struct(e["weight"], -e["term_id"])))
    split = rows.select("doc_id", "entries", alone.alias("alone")).select(
        "doc_id", "entries", "alone", length.alias("length"), (-heaviest["col2"]).alias("at")
    )
    stored = materialize(split, "tfidf")
    order = _alike("entries", stored.count())
    found = stored.select("at", "length", F.inline("alone"))
    part = (F.col("weight") / F.col("length")).alias("part")
    members = materialize(found.select("term_id", "at", part), "members")
    times = members.groupBy("term_id").agg(F.count("*").alias("n"))
    if not times.where("n > 1").isEmpty():
        return stored.select(
            "doc_id", F.col("entries.term_id").alias("term_ids"), F.col("entries.weight").alias("weights"), *order
        ), None
    rest = F.filter("entries", lambda e: ~((e["df"] == 1) & (e["weight"] > 0)))
    has = F.col("at").isNotNull()
    return stored.withColumn("rest", rest).select(
        "doc_id",
        F.when(has, F.concat("rest.term_id", F.array("at"))).otherwise(F.col("rest.term_id")).alias("term_ids"),
        F.when(has, F.concat("rest.weight", F.array("length"))).otherwise(F.col("rest.weight")).alias("weights"),
        *order,
    ), members


def _parted(numbered: DataFrame, basis: DataFrame, members: DataFrame | None) -> DataFrame:
    """The rows of ``numbered`` with ``vec`` and ``part``: each term has its part of the row it
    was merged into. Terms find that row first, so a row of the basis is sent once only."""
    if members is None:
        return numbered.join(basis, "term_id").withColumn("part", F.lit(1.0))
    found = numbered.join(members, "term_id", "left").select(
        "term_id", *(c for c in numbered.columns if c != "term_id"),
        F.coalesce("at", "term_id").alias("at"), F.coalesce("part", F.lit(1.0)).alias("part"),
    )
    return found.join(basis.withColumnRenamed("term_id", "at"), "at").drop("at")


def _per_block(docs: DataFrame, needed: DataFrame, basis: DataFrame | None):
    """Each block of documents together with the basis rows of its terms."""
    # A term has one basis row and a row per block at most.
    rows = needed if basis is None else needed.join(basis, "term_id")
    return docs.groupBy("block").cogroup(rows.groupBy("block"))


def _plain_step(docs: pa.Table, terms: pa.Table) -> pa.Table:
    """Per block of documents: their entries times the vectors of the terms, in doubles.

    Vectors of the same term add up. A missing number adds nothing, and is missing in the sum
    if nothing was added.
    """
    flat = terms.column("vec").combine_chunks().flatten()
    given = flat.is_valid().to_numpy(zero_copy_only=False)
    shape = (terms.num_rows, -1) if terms.num_rows else (0, 0)
    numbers = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False).reshape(shape)
    ids, dense = _summed(terms.column("term_id").to_numpy(), numbers)
    found = pc.is_in(docs.column("term_ids").combine_chunks().flatten(), pa.array(ids))
    found = found.to_numpy(zero_copy_only=False)
    row, column, weight = _block_entries(docs, ids)
    row, column, weight = row[found], column[found].astype(np.int64), weight[found]
    n = docs.num_rows
    image = _grouped_sums(row, n, column, weight, dense)
    missing = None
    if not given.all():
        _, given = _summed(terms.column("term_id").to_numpy(), given.reshape(shape).astype(float))
        missing = _grouped_sums(row, n, column, np.ones(len(row)), given) == 0
    some = np.unique(row)
    image = image[some]
    offsets = pa.array(np.arange(0, image.size + 1, max(image.shape[1], 1), dtype=np.int32)[: len(some) + 1])
    values = pa.array(image.ravel(), mask=None if missing is None else missing[some].ravel())
    vectors = pa.ListArray.from_arrays(offsets, values)
    return pa.table({"doc_id": docs.column("doc_id").combine_chunks().take(pa.array(some)), "vec": vectors})


def project(
    postings: DataFrame,
    numbered: DataFrame,
    terms: DataFrame,
    kept: int,
    docs_per_block: int = DOCS_PER_BLOCK,
) -> DataFrame:
    """``(doc_id, vec)``: the TF-IDF rows times the first ``kept`` numbers of the terms' vectors.

    ``numbered`` is the vocabulary ``term, term_id, df, idf`` that documents are weighted by,
    ``terms`` holds ``term_id, comp``. A block of documents meets one vector per distinct term,
    so no vector is copied to every posting.
    """
    rows = tfidf_rows(postings, numbered, "term_id").select(
        "doc_id", F.col("entries.term_id").alias("term_ids"), F.col("entries.weight").alias("weights")
    )
    rows = materialize(rows, "tfidf")
    docs, needed, _ = _hashed_blocks(rows, rows.count(), 2 * kept, docs_per_block)
    vec = F.transform(F.sequence(F.lit(0), F.lit(kept - 1)), lambda j: F.get("comp", j)).alias("vec")
    vectors = needed.join(terms.select("term_id", vec), "term_id")
    return docs.groupBy("block").cogroup(vectors.groupBy("block")).applyInArrow(
        _plain_step, "doc_id long, vec array<double>"
    )


# --- What a fit must fulfil -----------------------------------------------------------------


def component_products(terms: DataFrame, n: int) -> np.ndarray:
    """The product of every component with every other over all terms: every task sends one
    ``n x n`` matrix."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("comp"))
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n), pa.int64()), _pack(total)], names=["term_id", "vec"]
        )

    parts = terms.select("comp").mapInArrow(partial, _BASIS)
    sums = parts.groupBy("term_id").applyInArrow(_sum_step(n, np.float64), _BASIS)
    return np.array([np.frombuffer(row["vec"]) for row in sums.orderBy("term_id").collect()])


def is_orthonormal(products: np.ndarray, most: float = 1e-6) -> bool:
    return bool(np.abs(products - np.eye(len(products))).max(initial=0) < most)


def products_wrong(docs: DataFrame, plain: DataFrame, kept: int, most: float = 1e-6) -> DataFrame:
    """Documents whose vector is not ``plain``; those without a row there must have zeros."""
    zeros = F.array_repeat(F.lit(0.0), kept)
    both = docs.join(plain, "doc_id", "left").withColumn("plain", F.coalesce("plain", zeros))
    off = F.exists(F.arrays_zip("vec", "plain"), lambda p: F.coalesce(F.abs(p["vec"] - p["plain"]) > most, F.lit(True)))
    return both.where(off)


# --- Search ---------------------------------------------------------------------------------


def fold_in(
    queries: DataFrame, pre: Preprocess, terms: DataFrame, kept: int, query_id: str = "query_id"
) -> DataFrame:
    """``(query_id, vec)``: the TF-IDF vector of each query in the kept dimensions.

    Unknown terms are ignored; a query without known terms has no row.
    """
    asked = query_terms(queries, pre, query_id)
    small = F.broadcast(asked) if fits_broadcast(asked) else asked
    weight = F.col("qtf") * F.col("idf")
    known = terms.select("term", "idf", "comp").join(small, "term").withColumn("_w", weight)
    part = F.transform(F.slice("comp", 1, kept), lambda c: c * F.col("_w"))
    summed = known.withColumn("_part", part).groupBy("query_id").agg(
        _vector_sum(F.col("_part"), kept).alias("vec"),
        F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"),
    )
    return summed.select(
        "query_id", F.transform("vec", lambda v: v / F.col("_norm")).alias("vec")
    )


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _cosines(asked: list[tuple[int, bytes]], threshold: float, top_k: int | None) -> Callable:
    """Per batch of documents: cosines above the threshold with every query."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids = np.array([query_id for query_id, _ in asked])
        queries = _unit(np.array([np.frombuffer(vec) for _, vec in asked]))
        for batch in batches:
            for start in range(0, batch.num_rows, VECTORS_PER_STEP):
                part = batch.slice(start, VECTORS_PER_STEP)
                scores = queries @ _unit(_matrix(part.column("vec")).astype(float)).T
                ids = part.column("doc_id").to_numpy()
                at, doc = np.nonzero(scores > threshold)
                if top_k is not None:
                    # a step keeps what could be among the best of all
                    order = np.lexsort((ids[doc], -np.round(scores[at, doc], 9), at))
                    at, doc = at[order], doc[order]
                    first = np.searchsorted(at, at)
                    best = np.arange(len(at)) - first < top_k
                    at, doc = at[best], doc[best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[at]), pa.array(ids[doc]), pa.array(scores[at, doc])],
                    names=["query_id", "doc_id", "score"],
                )

    return step


def query_doc_product(
    query_vectors: DataFrame,
    doc_vectors: DataFrame,
    threshold: float = SCORE_THRESHOLD,
    top_k: int | None = None,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``(query_id, doc_id, score)``: cosines above the threshold.

    The vectors of the documents stay where they are: a batch of queries of a bounded size
    goes to all tasks, and each batch of documents is one matrix product. More queries than
    that are asked in several passes. Pairs below the threshold never become rows.
    """
    schema = "query_id long, doc_id long, score double"
    asked = materialize(query_vectors.select("query_id", "vec"), "asked")
    size = asked.agg(F.coalesce(F.sum(F.size("vec") * 8 + 8), F.lit(0))).first()[0]
    passes = size // query_bytes + 1
    part = F.pmod(F.xxhash64("query_id"), F.lit(passes))
    found = doc_vectors.sparkSession.createDataFrame([], schema)
    docs = doc_vectors.select("doc_id", "vec")
    for number in range(passes):
        rows = asked.where(part == number).collect()  # about query_bytes
        packed = [(r["query_id"], np.array(r["vec"], float).tobytes()) for r in rows]
        if packed:
            found = found.unionByName(docs.mapInArrow(_cosines(packed, threshold, top_k), schema))
    return found


def lsa_rank(hits: DataFrame, top_k: int | None = None) -> DataFrame:
    """Number the hits of each query: cosine descending, then document."""
    best = [F.desc(rank_key(F.col("score"))), F.asc("doc_id")]
    if top_k is None:
        return rank_within(hits, ["query_id"], best, "rank")
    order = Window.partitionBy("query_id").orderBy(*best)
    ranked = hits.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top_k)


def latent_hits(
    queries: DataFrame, pre: Preprocess, model: Lsa, threshold: float = SCORE_THRESHOLD
) -> DataFrame:
    """``(query_id, doc_id, score, first_pos)`` as the keyword search gives them."""
    asked = fold_in(queries, pre, model.terms, model.kept)
    hits = query_doc_product(asked, model.docs, threshold)
    return hits.withColumn("first_pos", F.lit(0))


def search_lsa(
    queries: DataFrame,
    pre: Preprocess,
    model: Lsa,
    top_k: int | None = None,
    threshold: float = SCORE_THRESHOLD,
    drop_last: bool = False,
) -> DataFrame:
    """All ranked hits ``(query_id, rank, doc_id, score)`` by cosine in the latent space."""
    asked = fold_in(queries, pre, model.terms, model.kept)
    hits = query_doc_product(asked, model.docs, threshold, None if drop_last else top_k)
    if drop_last:
        hits = drop_last_hit(hits.withColumn("first_pos", F.lit(0)))
    return lsa_rank(hits, top_k).select("query_id", "rank", "doc_id", "score")
