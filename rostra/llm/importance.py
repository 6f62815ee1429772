"""Quality by importance resampling.

Two generative models over hashed n-grams (words and pairs of neighbours, in ``BUCKETS``
buckets) are estimated: of the target, the texts labelled as good, and of the raw
collection, all texts. The log of the ratio of a text's probabilities under both is its
importance weight; with a Gumbel draw of the row's key added, the k greatest are a sample
without replacement in proportion to the weights (Gumbel top-k).

Counts cover all texts and are summed in the tasks; models are two vectors of ``BUCKETS``
numbers. The k greatest are found by one sort of (key, id) across the cluster.

Defined cases: null and empty texts have no n-gram and weigh 0 (in logs); without target
rows all texts weigh 0; equal keys rank by id, nulls last; rows that repeat an id draw alike.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import Batches, by_bytes, held_out, map_batches, small, whole_text, written
from rostra.runtime import dense_row_number

BUCKETS = 10_000
SMOOTHING = 1.0
SEED = 1
REMEMBERED = 500_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Hasher:
    """Buckets of the n-grams of texts."""

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, {}

    def __call__(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text.lower())
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for token in set(tokens).difference(self.known):
            self.known[token] = zlib.crc32(token.encode())
        one = np.fromiter(map(self.known.__getitem__, tokens), np.uint64, len(tokens))
        two = (one[:-1] * np.uint64(0x9E3779B1) + one[1:] * np.uint64(0x85EBCA77)) >> np.uint64(7)
        return (np.concatenate([one, two]) % np.uint64(self.buckets)).astype(np.int64)


def _count(buckets: int):
    def run(batches: Batches) -> Batches:
        hasher = Hasher(buckets)
        counts = np.zeros((2, buckets), np.int64)
        for batch in by_bytes(batches, "text"):
            target = batch.column("target").to_pylist()
            for text, good in zip(batch.column("text").to_pylist(), target):
                found = np.bincount(hasher(text), minlength=buckets)
                counts[1] += found
                if good:
                    counts[0] += found
        place = np.arange(buckets)
        for begin in range(0, buckets, 10_000):
            part = slice(begin, begin + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[part]), pa.array(counts[0, part]), pa.array(counts[1, part])],
                ["bucket", "target", "raw"],
            )

    return run


def log_ratios(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Of every bucket, from (text, target); zeros without target rows."""
    counts = (
        map_batches(texts, _count(buckets), "bucket long, target long, raw long")
        .groupBy("bucket")
        .agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
        .collect()  # one row per bucket
    )
    table = np.zeros((2, buckets))
    for row in counts:
        table[:, row["bucket"]] = row["target"], row["raw"]
    if not table[0].sum():
        return np.zeros(buckets)
    share = (table + SMOOTHING) / (table.sum(1, keepdims=True) + SMOOTHING * buckets)
    return np.log(share[0]) - np.log(share[1])


def _weigh(ratios: np.ndarray):
    def run(batches: Batches) -> Batches:
        hasher = Hasher(len(ratios))
        for batch in by_bytes(batches, "text"):
            weights = [float(ratios[hasher(t)].sum()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(weights, pa.float64())], ["doc_id", "log_weight"]
            )

    return run


def importance(docs: DataFrame, labels: DataFrame, seed: int = SEED, k: int | None = None) -> DataFrame:
    """doc_id, log_weight, draw_key (with the Gumbel draw), place (from 1) and kept (place <= k).

    The target are labelled rows of quality 1 that are not held out. ``k`` is by default the
    share of such rows among those labelled, of all documents.
    """
    known = labels.filter(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    good = small(known.filter("quality = 1").select(F.col("doc_id").alias("_id")))
    with_target = rows.join(good, rows["doc_id"] == good["_id"], "left").select(
        "text", F.col("_id").isNotNull().alias("target")
    )
    ratios = log_ratios(with_target)
    weights = map_batches(rows, _weigh(ratios), "doc_id long, log_weight double")
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    drawn = weights.withColumn("draw_key", F.col("log_weight") - F.log(-F.log(uniform)))
    drawn = written(drawn, "importance")
    if k is None:
        n = known.agg(F.count("quality"), F.sum((F.col("quality") == 1).cast("long"))).first()
        k = math.ceil(drawn.count() * (n[1] or 0) / n[0]) if n[0] else drawn.count()
    order = [F.desc("draw_key"), F.asc_nulls_last("doc_id")]
    return dense_row_number(drawn, "place", order, 1).withColumn("kept", F.col("place") <= k)
