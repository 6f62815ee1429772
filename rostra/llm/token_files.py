"""Token ids of documents in ORC files, and the way back.

``write_tokens`` deals the texts out by ranges of doc_id, encodes each range in order and
writes one ORC file per range: doc_id, first (place of the document's first id in its
file) and ids. ORC stores the integer columns run-length encoded, keeps row indexes with
the least and greatest value of each stride, and here Bloom filters on doc_id.
``read_tokens`` reads stripes in parallel; with ids it reads the stripes and strides whose
indexes and filters allow them.

Defined cases: a null text is empty and holds only the end id; a null id sorts before all
others; rows that repeat an id follow each other by text; an empty table gives no row.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostra.llm.common import Batches, by_bytes, map_batches, small, whole_text, written

END_ID = 2
# Entries a worker remembers; it starts anew beyond that.
REMEMBERED = 1_000_000
# Not a boundary of tokens: a space between white space, or after it at the end.
_INNER_SPACE = re.compile(r" (?<=\s )(?:\s|\Z)")


def _strings(column: pa.Array) -> list[str]:
    """What ``to_pylist`` gives, without a step per value in Python."""
    return column.to_numpy(zero_copy_only=False).tolist()


class SpacedEncoder:
    """Encodes texts piece by piece, each distinct piece once.

    The tokenizer's pattern never lets a token reach over the place before a space that
    follows a non-space, or before the last space of white space. A piece is such a space
    with what follows. Texts with other spaces or with a special token's string, and the
    first words of texts, are encoded as they are.
    """

    def __init__(self, vocabulary: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        space = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ")[0][0]
        self.opens = np.array(
            [(self.tokenizer.id_to_token(i) or "").startswith(space) for i in range(size)]
        )
        self.end_id = end_id
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.count = np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, np.int32)
        self.entries = self.used = 0

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Store ids of new entries; the numbers of the entries."""
        begin, end, total = self.entries, self.entries + len(sizes), len(ids)
        while end > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[begin:end] = self.used + np.cumsum(sizes) - sizes
        self.count[begin:end] = sizes
        self.flat[self.used : self.used + total] = ids
        self.used, self.entries = self.used + total, end
        return np.arange(begin, end)

    def _whole(self, texts: list[str]) -> np.ndarray:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return self._add(np.array([i for ids in found for i in ids], np.int32), sizes)

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces side by side: each begins at the one token that begins with a space."""
        closed, rest = [], []
        for piece in pieces:
            (closed if piece and not piece[-1].isspace() else rest).append(piece)
        for begin in range(0, len(closed), 1000):
            group = closed[begin : begin + 1000]
            run = self.tokenizer.encode_batch_fast([" " + " ".join(group)], add_special_tokens=False)
            ids = np.array(run[0].ids, np.int32)
            first = np.flatnonzero(self.opens[ids])
            assert len(first) == len(group)
            self.known.update(zip(group, self._add(ids, np.diff(first, append=len(ids))).tolist()))
        self.known.update(zip(rest, self._whole([" " + p for p in rest]).tolist()))

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The entry of every piece."""
        coded = pieces.dictionary_encode()
        distinct = _strings(coded.dictionary)
        at = list(map(self.known.get, distinct))  # one look at the pieces that are known
        fresh = [i for i, number in enumerate(at) if number is None]
        if fresh:
            self._learn([distinct[i] for i in fresh])
            for i in fresh:
                at[i] = self.known[distinct[i]]
        return np.array(at, np.int64)[coded.indices.to_numpy()] if at else np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, each text's with the end id, and how many it has."""
        if self.entries > REMEMBERED or self.used > 16 * REMEMBERED:
            self._reset()
        values = _strings(texts)
        whole = [
            bool(_INNER_SPACE.search(t)) or any(s in t for s in self.special) for t in values
        ]
        split = pc.split_pattern(pc.if_else(pa.array(whole, pa.bool_()), "", texts), " ")
        offsets = split.offsets.to_numpy()
        heads = [t if w else t.partition(" ")[0] for t, w in zip(values, whole)]
        # The pieces of a text, its head in the place of the first, and its end.
        at = self._numbers(split.flatten())
        at[offsets[:-1]] = self._whole(heads)
        end = self._add(np.array([self.end_id], np.int32), np.array([1]))[0]
        at = np.insert(at, offsets[1:], end)
        sizes = self.count[at]
        upto = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.start[at] - upto + sizes, sizes) + np.arange(upto[-1])]
        last = offsets[1:] + np.arange(len(values))
        return ids, np.diff(upto[last], prepend=0)


# One encoder per worker process: a later task finds the pieces of earlier ones.
_encoders: dict[tuple[str, int], SpacedEncoder] = {}


def _encoder(vocabulary: str, end_id: int) -> SpacedEncoder:
    if (vocabulary, end_id) not in _encoders:
        _encoders.clear()
        _encoders[vocabulary, end_id] = SpacedEncoder(vocabulary, end_id)
    return _encoders[vocabulary, end_id]


def _encode(vocabulary: str, end_id: int):
    def run(batches: Batches) -> Batches:
        encoder, place = _encoder(vocabulary, end_id), 0
        for batch in by_bytes(batches, "text"):
            ids, totals = encoder.encode(batch.column("text"))
            offsets = np.concatenate([[0], np.cumsum(totals)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(place + offsets[:-1]),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                ],
                ["doc_id", "first", "ids"],
            )
            place += int(offsets[-1])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    files: int | None = None,
    stripe_bytes: int = 64 << 20,
    stride_rows: int = 1000,
) -> None:
    """Encode ``docs`` (doc_id, text) into ORC files under ``path``, in order of doc_id.

    ``files`` is the number of ranges, by default the session's shuffle partitions; a file
    is never in memory as a whole.
    """
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    encode = _encode(vocabulary or public_tokenizers.path("byte_bpe_50k.json"), end_id)
    (
        map_batches(ordered, encode, "doc_id long, first long, ids array<int>")
        .write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", stride_rows)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, first, ids) of all documents or of some; stripes without them are not read."""
    tokens = spark.read.schema("doc_id long, first long, ids array<int>").orc(path)
    return tokens if doc_ids is None else tokens.filter(F.col("doc_id").isin(doc_ids))


def _digest(batches: Batches) -> Batches:
    for batch in batches:
        ids = batch.column("ids")
        ends = ids.offsets.to_numpy()
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("first"),
                pa.array(np.diff(ends).astype(np.int64)),
                pa.array(crc, pa.int64()),
                batch.column("file"),
            ],
            ["doc_id", "first", "n_tokens", "ids_crc32", "file"],
        )


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, all from the files.

    Files follow each other by range of doc_id; what lies before a file is a sum over one
    row per file.
    """
    tokens = read_tokens(spark, path).withColumn("file", F.col("_metadata.file_path"))
    schema = "doc_id long, first long, n_tokens long, ids_crc32 long, file string"
    digest = written(map_batches(tokens, _digest, schema), "token-digest")
    files = digest.groupBy("file").agg(
        F.min("doc_id").alias("least"), F.sum("n_tokens").alias("total")
    )
    before = Window.orderBy(F.asc_nulls_first("least"), "file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("off"))
    return digest.join(small(offsets), "file").select(
        "doc_id", (F.col("first") + F.col("off")).alias("start"), "n_tokens", "ids_crc32"
    )
