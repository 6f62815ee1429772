"""Substring dedup by sliding spans of sentences.

From every sentence the span goes on, and back, over as many consecutive sentences, two at
least, as hold ``least_words`` words; each span is hashed (128 bits), and so is a sentence of
``alone_words`` by itself. Any passage of several whole sentences with that many words is
covered by spans within it, so it is found wherever it stands. Spans
are joined by their hashes over all documents; the first one, by doc_id and place, stays,
and sentences that another one covers are removed. The rest of the text is as it was.

Counting is summed before the shuffle; the spans meet the repeated hashes in a join whose
other side has one row per hash. No group of spans is gathered anywhere.

Defined cases: null texts count as empty and stay null; texts without a span are unchanged;
a row without an id takes no part and is unchanged; rows that repeat an id with the same
text are the same document and lose the same sentences; other texts of an id are documents
of their own, ordered by a hash of the text; a span repeated in its own document goes as well.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import Batches, by_bytes, map_batches, small, whole_text, written

LEAST_WORDS = 12  # of two or more sentences
ALONE_WORDS = 40  # of one sentence
BROADCAST_BYTES = 8 << 20  # of repeated hashes; more are joined by a shuffle
# A run of stops is read once: it is no start in its own middle, and gives nothing back.
_BREAK = re.compile(r"(?<![.!?])[.!?]++\s+|\n+")


def sentences(text: str) -> list[str]:
    """The text cut after each sentence or line; joined again they are the text."""
    cuts = [0, *(m.end() for m in _BREAK.finditer(text))]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def spans(
    parts: list[str], least_words: int, alone_words: int = ALONE_WORDS
) -> list[tuple[int, int, int]]:
    """(hash, first sentence, sentence after the last) of every span, by place."""
    words = [part.lower().split() for part in parts]
    upto = np.cumsum([0, *map(len, words)])
    if upto[-1] < min(least_words, alone_words):
        return []
    hashes = b"".join(xxhash.xxh3_128_digest(" ".join(w)) if w else b"" for w in words)
    place = np.cumsum([0, *(16 if w else 0 for w in words)])
    begin = np.flatnonzero(np.diff(upto))  # sentences with words
    alone = begin[upto[begin + 1] - upto[begin] >= alone_words]
    pairs = {(int(a), int(a) + 1) for a in alone}
    if len(begin) > 1:
        # Far enough for the words, and over one more sentence with words at least.
        forward = np.maximum(np.searchsorted(upto, upto[begin[:-1]] + least_words), begin[1:] + 1)
        pairs |= {(int(a), int(b)) for a, b in zip(begin, forward) if b < len(upto)}
        backward = np.searchsorted(upto, upto[begin[1:] + 1] - least_words, side="right") - 1
        backward = np.minimum(backward, begin[:-1])
        pairs |= {(int(a), int(b) + 1) for a, b in zip(backward, begin[1:]) if a >= 0}
    return [(xxhash.xxh3_128_intdigest(hashes[place[a] : place[b]]), a, b) for a, b in sorted(pairs)]


def _find(least_words: int):
    def run(batches: Batches) -> Batches:
        for batch in by_bytes(batches, "text"):
            ids, keys, found, again = [], [], [], []
            columns = (batch.column(n).to_pylist() for n in ("doc_id", "text_key", "text"))
            for doc, key, text in zip(*columns):
                own = spans(sentences(text), least_words)
                seen: set[int] = set()
                for span in own:
                    again.append(span[0] in seen)
                    seen.add(span[0])
                ids += [doc] * len(own)
                keys += [key] * len(own)
                found += own
            low = (1 << 64) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array([h >> 64 for h, _, _ in found], np.uint64).view(np.int64)),
                    pa.array(np.array([h & low for h, _, _ in found], np.uint64).view(np.int64)),
                    pa.array(ids, pa.int64()),
                    pa.array(keys, pa.int64()),
                    # Both ends and whether the document had it before, in one number.
                    pa.array(
                        [a << 32 | b << 1 | r for (_, a, b), r in zip(found, again)], pa.int64()
                    ),
                ],
                ["h1", "h2", "doc_id", "text_key", "place"],
            )

    return run


def text_key(name: str = "text") -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(whole_text(name))


def covered(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, text_key, cuts: array of (start, end)) of documents with sentences to remove."""
    texts = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        whole_text().alias("text"),
    )
    schema = "h1 long, h2 long, doc_id long, text_key long, place long"
    found = map_batches(texts, _find(least_words), schema)
    several = texts.groupBy("doc_id").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"))
    # A minimum of pairs is slower to count; the id orders documents if each has one text.
    order = F.col("doc_id") if several.filter("a <> b").isEmpty() else F.struct("doc_id", "text_key")
    repeated = written(
        found.groupBy("h1", "h2")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "spans-repeated",
    )
    later = found.join(small(repeated, BROADCAST_BYTES), ["h1", "h2"]).filter(
        (order > F.col("first")) | (F.col("place") % 2 == 1)
    )
    start = F.shiftright("place", 32).cast("int").alias("start")
    end = (F.shiftright("place", 1) % (1 << 31)).cast("int").alias("end")
    return later.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct(start, end)).alias("cuts")
    )


def _cut(batches: Batches) -> Batches:
    for batch in by_bytes(batches, "_text"):
        kept, total, gone = [], [], []
        for text, cuts in zip(batch.column("_text").to_pylist(), batch.column("_cuts").to_pylist()):
            parts = sentences(text or "")
            drop = np.zeros(len(parts) + 1, np.int64)
            for cut in cuts or ():
                drop[cut["start"]] += 1
                drop[cut["end"]] -= 1
            out = np.cumsum(drop[:-1]) > 0
            kept.append("".join(p for p, o in zip(parts, out) if not o) if out.any() else text)
            total.append(len(parts))
            gone.append(np.flatnonzero(out).tolist())
        names = [n for n in batch.schema.names if n not in ("_text", "_cuts")]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n) for n in names),
                pa.array(kept, pa.string()),
                pa.array(total, pa.int32()),
                pa.array(gone, pa.list_(pa.int32())),
            ],
            [*names, "_text", "_sentences", "_removed"],
        )


def substring_dedup(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, text without the repeated sentences, n_sentences, removed (their numbers)."""
    names = {"doc_id": "_id", "text_key": "_key", "cuts": "_cuts"}
    cuts = covered(docs, least_words).withColumnsRenamed(names)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("_text"))
    same = (rows["doc_id"] == cuts["_id"]) & (text_key("_text") == cuts["_key"])
    joined = rows.join(cuts, same, "left").drop("_id", "_key")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, _text string, _sentences int, _removed array<int>"
    return map_batches(joined, _cut, schema).select(
        "doc_id",
        F.col("_text").alias("text"),
        F.col("_sentences").alias("n_sentences"),
        F.col("_removed").alias("removed"),
    )
