"""Groups of spelling variants by Bloom-guided neighbourhoods.

Words are counted over all texts. Every word of the vocabulary generates its edits (each
deletion of one code point, each replacement by a letter that comes later in the alphabet;
the links of insertions and of other replacements are those of the other word, turned
round). The hash of an edit follows from the word's own by a few operations, so edits are
probed as numbers, a whole batch at once, against blocked Bloom filters, one per word length:
sixteen bits a word, all bits of a word in one block of 64 bytes. Only positives become rows; an exact join with
the vocabulary removes the false ones.

The filters are built in parts of at most ``PART_BLOCKS`` blocks, a task each, and broadcast
in passes of at most ``FILTER_BYTES``: a vocabulary of any size takes more passes, never a
larger broadcast. A word has at most (letters + 1) x length neighbours, so no group grows with
the corpus. Roots are found by pointer doubling: counts at least double from a word to its
form, hence a few joins suffice.

Defined cases: null texts have no word; a null id counts as the empty text in front of the
colon; rows that repeat an id are counted each; equal counts fall to the smaller word in
code-point order; very long words are edited whole, in steps of bounded memory; an empty
table gives no row; only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import Batches, map_batches, temporary, whole_text, written

LEAST_LENGTH = 5
LEAST_COUNT = 3
DELETE_EVERY = 97
FORM_FACTOR = 2
BITS_PER_WORD = 16
BLOCK_WORDS = 8  # 64-bit words: a block is 64 bytes
PART_BLOCKS = 8192  # blocks that a task builds and a broadcast holds at once
FILTER_BYTES = 32 << 20
PROBES_PER_STEP = 1 << 18
_LOWER = {chr(65 + i): chr(97 + i) for i in range(26)}
_BASE = np.uint64(0xD1B54A32D192ED03)  # odd, so it has an inverse
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SALTS = np.arange(1, 2 * BLOCK_WORDS, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def occurrences(docs: DataFrame) -> DataFrame:
    """(word) for every run of letters that is long enough, after the fixed deletions."""
    run = f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(whole_text(), F.lit(run), F.lit(0))).alias("run"),
    )
    lower = F.translate("run", "".join(_LOWER), "".join(_LOWER.values()))
    runs = runs.select("id", lower.alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    cut = F.expr("concat(left(run, int(h % length(run))), substring(run, int(h % length(run)) + 2))")
    word = F.when(F.col("h") % DELETE_EVERY == 0, cut).otherwise(F.col("run"))
    return runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words with enough occurrences; tasks add up their own first."""
    counted = occurrences(docs).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


# --- Hashes of words and of their edits -------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_LETTER = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)


def _by_length(words: list[str]):
    """The words of each length as a matrix of code points, with their places in the list."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        letters = np.frombuffer("".join([words[i] for i in at]).encode("latin-1"), np.uint8)
        yield int(size), at, letters.reshape(len(at), size)


def _terms(letters: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """What every letter adds to the hash of its word."""
    with np.errstate(over="ignore"):
        return _LETTER[letters] * powers[: letters.shape[1]]


def _hashed(batches: Batches) -> Batches:
    """(word, n, size, block hash): the hash as a signed number."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        hashes = np.zeros(len(words), np.uint64)
        for size, at, letters in _by_length(words):
            for rows in _steps(len(at), size):
                terms = _terms(letters[rows], _powers(size))
                hashes[at[rows]] = terms.sum(axis=1, dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("word"),
                batch.column("n"),
                pa.array(list(map(len, words)), pa.int32()),
                pa.array(_mixed(hashes).view(np.int64)),
            ],
            ["word", "n", "size", "hash"],
        )


def _steps(rows: int, width: int):
    """Slices of rows that stay within the bound on probes; a row alone may be above it."""
    step = max(1, PROBES_PER_STEP // max(width, 1))
    return [slice(a, min(a + step, rows)) for a in range(0, rows, step)]


# --- Blocked Bloom filters --------------------------------------------------------------------


def blocks_for(words: int) -> int:
    return -(-words * BITS_PER_WORD // (64 * BLOCK_WORDS))


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _bit(hashes: np.ndarray, k: int) -> np.ndarray:
    """The one bit that a word sets in the k-th 64-bit word of its block."""
    with np.errstate(over="ignore"):
        return np.uint64(1) << ((hashes * _SALTS[k]) >> np.uint64(58))


def _in_parts(blocks: dict[int, int]):
    """(size, part, hash): the part of its length's filter that a word belongs to."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            many = np.array([blocks[s] for s in sizes.tolist()], np.uint64)
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            part = ((hashes >> np.uint64(32)) * many >> np.uint64(32)).astype(np.int64) // PART_BLOCKS
            yield pa.RecordBatch.from_arrays(
                [batch.column("size"), pa.array(part.astype(np.int32)), batch.column("hash")],
                ["size", "part", "hash"],
            )

    return run


def _build(blocks: dict[int, int]):
    def run(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        size, part = key[0].as_py(), key[1].as_py()
        first = part * PART_BLOCKS
        bits = np.zeros((min(PART_BLOCKS, blocks[size] - first), BLOCK_WORDS), np.uint64)
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            block = _block(hashes, blocks[size]) - first
            for k in range(BLOCK_WORDS):
                np.bitwise_or.at(bits[:, k], block, _bit(hashes, k))
        yield pa.RecordBatch.from_arrays(
            [pa.array([size], pa.int32()), pa.array([part], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
            ["size", "part", "bits"],
        )

    return run


class Filter:
    """A run of blocks of the filter of one word length."""

    def __init__(self, blocks: int, first: int, bits: np.ndarray):
        self.blocks, self.first, self.bits = blocks, first, bits.reshape(-1, BLOCK_WORDS)

    def positives(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes whose bits are all set."""
        hashes = _mixed(hashes)
        block = _block(hashes, self.blocks) - self.first
        at = np.flatnonzero((block >= 0) & (block < len(self.bits)))
        for k in range(BLOCK_WORDS):
            if not len(at):
                break
            bit = _bit(hashes[at], k)
            at = at[(self.bits[block[at], k] & bit) != 0]
        return at


def _edits(words: list[str], letters_used: np.ndarray, filters: dict[int, Filter]):
    """(place of the word, edited word) of all edits that the filters let pass."""
    found: list[tuple[int, str]] = []
    for size, at, letters in _by_length(words):
        same, shorter = filters.get(size), filters.get(size - 1)
        if not same and not shorter:
            continue
        powers = _powers(size)
        for rows in _steps(len(at), size + len(letters_used)):
            part, place = letters[rows], at[rows]
            terms = _terms(part, powers)
            whole = terms.sum(axis=1, dtype=np.uint64)
            before = np.zeros(len(part), np.uint64)
            for i in range(size):
                with np.errstate(over="ignore"):
                    if shorter:
                        # of equal letters in a row only the first is deleted
                        own = np.arange(len(part)) if not i else np.flatnonzero(part[:, i] != part[:, i - 1])
                        after = (whole[own] - before[own] - terms[own, i]) * _INVERSE
                        for k in own[shorter.positives(before[own] + after)]:
                            word = words[place[k]]
                            found.append((place[k], word[:i] + word[i + 1 :]))
                    if same:
                        later = letters_used[None, :] > part[:, i, None]
                        row, letter = np.nonzero(later)
                        rest = whole - terms[:, i]
                        hashes = rest[row] + (_LETTER[letters_used] * powers[i])[letter]
                        for k in same.positives(hashes):
                            word = words[place[row[k]]]
                            other = chr(letters_used[letter[k]])
                            found.append((place[row[k]], word[:i] + other + word[i + 1 :]))
                before += terms[:, i]
    return found


def _probed(letters_used: np.ndarray, shared: Broadcast):
    def run(batches: Batches) -> Batches:
        filters = {
            size: Filter(blocks, first, np.frombuffer(bits, np.uint64))
            for size, (blocks, first, bits) in shared.value.items()
        }
        for batch in batches:
            words = batch.column("word").to_pylist()
            found = _edits(words, letters_used, filters)
            at = pa.array([i for i, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word").take(at),
                    batch.column("n").take(at),
                    pa.array([w for _, w in found], pa.string()),
                ],
                ["word", "n", "near"],
            )

    return run


def _passes(blocks: dict[int, int], most_bytes: int) -> list[list[tuple[int, int, int]]]:
    """(size, first part, parts) of the filters that go out together, within the bound."""
    most = max(1, most_bytes // (PART_BLOCKS * BLOCK_WORDS * 8))
    passes: list[list[tuple[int, int, int]]] = [[]]
    room = most
    for size in sorted(blocks):
        part, parts = 0, -(-blocks[size] // PART_BLOCKS)
        while part < parts:
            if not room:
                passes.append([])
                room = most
            take = min(room, parts - part)
            passes[-1].append((size, part, take))
            part, room = part + take, room - take
    return [p for p in passes if p]


def near_words(vocab: DataFrame, filter_bytes: int | None = None) -> DataFrame:
    """(word, n, near, near_n) of all pairs one edit apart, in both directions.

    ``vocab`` (word, n) is a stored table: it is read once per pass and once for the join.
    """
    spark = vocab.sparkSession
    words = written(map_batches(vocab, _hashed, "word string, n long, size int, hash long"), "spelling-words")
    sizes = {r["size"]: r["n"] for r in words.groupBy("size").agg(F.count("*").alias("n")).collect()}
    used = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").distinct()
    letters_used = np.array(sorted(ord(r["letter"]) for r in used.collect()), np.uint8)
    blocks = {size: blocks_for(n) for size, n in sizes.items()}
    parts = map_batches(words, _in_parts(blocks), "size int, part int, hash long")
    built = parts.groupBy("size", "part").applyInArrow(_build(blocks), "size int, part int, bits binary")
    built = written(built, "spelling-filters")
    positives = None
    for group in _passes(blocks, filter_bytes or FILTER_BYTES):
        shared, lengths = {}, set()
        for size, first, parts in group:
            lengths |= {size, size + 1} if sizes[size] > 1 else {size + 1}
            own = built.filter((F.col("size") == size) & F.col("part").between(first, first + parts - 1))
            bits = b"".join(r["bits"] for r in own.orderBy("part").collect())
            shared[size] = (blocks[size], first * PART_BLOCKS, bits)
        probe = _probed(letters_used, spark.sparkContext.broadcast(shared))
        rows = words.filter(F.col("size").isin(sorted(lengths))).select("word", "n")
        found = map_batches(rows, probe, "word string, n long, near string")
        positives = found if positives is None else positives.unionByName(found)
    if positives is None:
        positives = spark.createDataFrame([], "word string, n long, near string")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = positives.join(known, "near")
    both = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(
            F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
        ),
    )
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, doubling the steps."""
    current = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        ahead = written(current.join(onward, "root", "left"), "spelling-roots")
        current = ahead.select("word", F.coalesce("onward", "root").alias("root"))
        if ahead.filter("onward IS NOT NULL").isEmpty():
            return current


def spelling_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    vocab = written(vocabulary(docs), "spelling-vocabulary", keep=True)
    with temporary(docs.sparkSession):
        nearest = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near")))
        near = near_words(vocab).groupBy("word").agg(F.count("*").alias("n_near"), nearest.alias("best"))
        joined = vocab.join(near, "word", "left")
        best = -F.col("best.m")
        is_form = best >= FORM_FACTOR * F.col("n")
        formed = written(
            joined.select(
                "word",
                F.when(is_form, F.col("best.near")).alias("form"),
                "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(is_form, best).alias("form_n"),
            ),
            "spelling-forms",
            keep=True,
        )
        last = written(roots(formed.filter("form IS NOT NULL")), "spelling-last", keep=True)
    root = F.coalesce("root", "word").alias("root")
    return formed.join(last, "word", "left").select("word", "form", root, "n", "n_near", "form_n")
