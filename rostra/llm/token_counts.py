"""Token counts by a two-tier lookup of pre-token lengths on the map side.

The tokenizer cuts a text into pre-tokens and encodes each by itself, so a text has as many
tokens as its pre-tokens together. The first tier is a compact table of frequent pre-tokens
and their numbers of tokens, broadcast to the workers: at most ``TABLE_SIZE`` entries of at
most ``LONGEST`` characters, so its size is bounded whatever the corpus. The second tier is a
cache in each worker process, which outlives a task: what both lack is encoded, all misses of
a batch at once. Nothing is shuffled per pre-token. The table comes from a sample of about
``SAMPLE_ROWS`` documents and decides the speed only, never a count.

Pre-tokens are found by the tokenizer's own pattern. Texts with characters outside
``KNOWN`` (about which Unicode versions may differ) or with the string of a special token go
to the tokenizer as a whole.

Defined cases: null and empty texts have 0 bytes and 0 tokens; very long texts and very long
pre-tokens are counted whole (a pre-token above ``LONGEST`` characters is not remembered);
rows that repeat an id, or have none, are counted each; an empty table gives no row; of the
input only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import os
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import Batches, by_bytes, map_batches, whole_text

LIMIT = 1024
SAMPLE_ROWS = 10_000
TABLE_SIZE = 65_536
# Pre-tokens a task of the sample sends on, and characters of those that are remembered.
TASK_ENTRIES = 16_384
LONGEST = 32
# Entries of a worker's cache; it starts anew beyond that.
REMEMBERED = 200_000
BATCH_BYTES = 4 << 20
# The pattern of byte-level tokenizers of this family, and the blocks of code
# points whose classes no Unicode version has changed since.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN = (
    (0x0000, 0x02FF), (0x0370, 0x0556), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x20A0, 0x20BF),
    (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
)


def _outside() -> str:
    return "[^" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in KNOWN) + "]"


class Lengths(dict):
    """Numbers of tokens by pre-token: the frequent ones always, others while there is room."""

    def __init__(self, vocabulary: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        super().__init__(frequent)
        self.frequent = frequent
        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([_outside(), *map(re.escape, added)])
        self.cut = regex.compile(PRE_TOKEN).findall

    def encoded(self, texts: list[str]) -> list[int]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [len(e.ids) for e in found]

    def learn(self, pieces: list[str]) -> dict[str, int]:
        """Encode pre-tokens that no tier holds; those too long to remember are returned."""
        if len(self) > len(self.frequent) + REMEMBERED:
            self.clear()
            self.update(self.frequent)
        found = dict(zip(pieces, self.encoded(pieces)))
        long = {p: found.pop(p) for p in pieces if len(p) > LONGEST}
        self.update(found)
        return long

    def count(self, texts: pa.Array) -> list[int]:
        """Tokens of each text."""
        whole = np.asarray(pc.match_substring_regex(texts, self.whole).to_pylist(), bool)
        values = texts.to_pylist()
        totals = [0] * len(values)
        at = np.flatnonzero(whole).tolist()
        for i, n in zip(at, self.encoded([values[i] for i in at])):
            totals[i] = n
        cut = [[] if w else self.cut(t) for w, t in zip(whole.tolist(), values)]
        known = [list(map(self.get, pieces)) for pieces in cut]
        fresh = {p for pieces, n in zip(cut, known) if None in n for p in pieces if p not in self}
        long = self.learn(list(fresh)) if fresh else {}
        for i, (pieces, n) in enumerate(zip(cut, known)):
            if None in n:
                n = [long[p] if m is None and p in long else m or self[p] for p, m in zip(pieces, n)]
            totals[i] += sum(n)
        return totals


_worker: dict[tuple, Lengths] = {}


def _lengths(vocabulary: str, table: Broadcast) -> Lengths:
    """The lookup of this worker process; a later task of the same job finds it filled."""
    key = (vocabulary, table._path if hasattr(table, "_path") else id(table))
    if key not in _worker:
        _worker.clear()
        blob, ends, counts = table.value
        text = blob.decode("utf-8", "surrogatepass")
        cuts = zip([0, *ends.tolist()], ends.tolist())
        _worker[key] = Lengths(vocabulary, dict(zip((text[a:b] for a, b in cuts), counts.tolist())))
    return _worker[key]


def _frequent(vocabulary: str):
    """Per task the most frequent pre-tokens of its part of the sample."""

    def run(batches: Batches) -> Batches:
        lengths, counts = Lengths(vocabulary, {}), Counter()
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            for text in batch.column("text").to_pylist():
                counts.update(p for p in lengths.cut(text) if len(p) <= LONGEST)
            if len(counts) > 16 * TASK_ENTRIES:
                counts = Counter(dict(counts.most_common(4 * TASK_ENTRIES)))
        best = counts.most_common(TASK_ENTRIES)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())],
            ["piece", "n"],
        )

    return run


def frequent_pieces(
    docs: DataFrame, vocabulary: str, sample_rows: int = SAMPLE_ROWS, size: int = TABLE_SIZE
) -> list[str]:
    """At most ``size`` pre-tokens, the most frequent ones of a sample of the documents."""
    rows = docs.count()
    sample = docs.sample(min(1.0, sample_rows / rows), seed=1) if rows else docs
    sample = sample.select(whole_text().alias("text"))
    counts = map_batches(sample, _frequent(vocabulary), "piece string, n long")
    best = counts.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece")
    return [r["piece"] for r in best.limit(size).collect()]


def _compact(pieces: list[str], counts: list[int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All pre-tokens as one text, the places where they end, and their numbers of tokens."""
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int32, len(pieces)), dtype=np.int32)
    return "".join(pieces).encode("utf-8", "surrogatepass"), ends, np.array(counts, np.uint8)


def _counted(vocabulary: str, table: Broadcast, limit: int):
    def run(batches: Batches) -> Batches:
        lengths = _lengths(vocabulary, table)
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            texts = batch.column("text")
            tokens = np.array(lengths.count(texts), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every document."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    pieces = frequent_pieces(docs, vocabulary)
    counts = Lengths(vocabulary, {}).encoded(pieces)
    table = docs.sparkSession.sparkContext.broadcast(_compact(pieces, counts))
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(docs, _counted(vocabulary, table, limit), schema)
