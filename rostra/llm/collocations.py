"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into shards that are scanned in a cycle. Single words are counted from
the first shard on. At every stop between two shards, the phrases whose running count has
reached the threshold are noted with that stop; from the next shard on, a longer phrase is
active as soon as both its subphrases (without its last and without its first word) are
noted. Every phrase is counted for one full cycle from its own start, so lengths interleave
and counts are exact. The scans end when no noted phrase can open a longer one any more.

Words are 64-bit keys of (language, word); that no two words share one is checked over the
whole vocabulary by a second hash, and a new seed is taken if any do. Phrases are tuples of keys, counted in
the tasks before any shuffle. The noted phrases go to the tasks as sorted arrays while they fit
``NOTED_BYTES``; beyond that as Bloom filters of that size, and a join on the counts settles
exactly what was active. What never reaches a share of the threshold in any shard (the
threshold divided by the shards) is never added up again.

Defined cases: null texts have no word; a null language is ``und``; ids play no part, so
repeated rows count as often as they stand; ties fall to the smaller cut and to the phrase
first in UTF-8; very long texts are counted whole; an empty table gives no row; only
``lang`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostra.llm.common import (
    Batches,
    by_bytes,
    forget,
    map_batches,
    small,
    temporary,
    whole_text,
    written,
)
from rostra.llm.spelling import BLOCK_WORDS, PART_BLOCKS, Filter, _build, _in_parts, blocks_for

SHARDS = 2
THRESHOLD = 30
MOST_WORDS = 4
REPORTED = 2000
CONTAINED = (100, 80)  # dropped if 100 * f(longer) >= 80 * a
SCALE = 2_000_000
NOTED_BYTES = 64 << 20
LISTED = 800_000  # phrases that a join broadcasts: 32 MB of keys
BATCH_BYTES = 4 << 20
WORDS_PER_COUNT = 2 << 20  # word places counted at a time
WORDS = ["w1", "w2", "w3", "w4"]
COUNTS = "w1 long, w2 long, w3 long, w4 long, n long"
# Word keys repeat: a large dictionary keeps a place at about two bytes.
DICTIONARY = {"parquet.dictionary.page.size": str(16 << 20)}
_BREAK = 0  # the key of the end of a piece
_SPACES = bytes.maketrans(b"\t.,;:!?\x0b\x0c\r", b" " + b"\n" * 9)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The key of a phrase from that of its beginning and of its last word."""
    with np.errstate(over="ignore"):
        return _mixed(left * _MIX + right)


# --- From texts to keys -----------------------------------------------------------------------


def _marked(texts: pa.Array) -> pa.ListArray:
    """The words of each text, lower-cased, with ``\\n`` at the end of pieces and empty strings."""
    lower = pc.ascii_lower(texts)
    _, offsets, data = lower.buffers()
    clean = pa.py_buffer(data.to_pybytes().translate(_SPACES)) if data else data
    clean = pa.Array.from_buffers(pa.string(), len(lower), [None, offsets, clean], offset=lower.offset)
    return pc.split_pattern(pc.replace_substring(clean, "\n", " \n "), " ")


def _keyed(seed: int):
    """Per text its word keys with breaks; per batch (lang, word, key, mark, n) of its words.

    ``mark`` is a second hash of language and word.
    """

    def run(batches: Batches) -> Batches:
        import xxhash

        def hashes(values: list[str], turn: int = 0) -> np.ndarray:
            own = 2 * seed + turn
            found = [xxhash.xxh64_intdigest(v.encode("utf-8", "surrogatepass"), own) for v in values]
            return np.array(found, np.uint64)

        for batch in by_bytes(batches, "text", BATCH_BYTES):
            parts = _marked(batch.column("text"))
            offsets = parts.offsets.to_numpy()
            coded = parts.flatten().dictionary_encode()
            codes = coded.indices.to_numpy()
            words = coded.dictionary.to_pylist()
            place = {w: i for i, w in enumerate(words)}
            langs = batch.column("lang").dictionary_encode()
            own = hashes(words)
            of_lang = _mixed(hashes(langs.dictionary.to_pylist()))
            lang = np.repeat(langs.indices.to_numpy(), np.diff(offsets))
            with np.errstate(over="ignore"):
                keys = _mixed(own[codes] + of_lang[lang])
            keys = np.maximum(keys, np.uint64(1))
            is_break = codes == place.get("\n", -1)
            keys[is_break] = _BREAK
            keep = codes != place.get("", -1)
            upto = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(upto), pa.array(keys[keep].view(np.int64)))
            yield _row(keys=lists)
            real = keep & ~is_break
            pair = lang[real].astype(np.int64) * len(words) + codes[real]
            pairs, first, n = np.unique(pair, return_index=True, return_counts=True)
            own_lang, own_word = pairs // max(len(words), 1), pairs % max(len(words), 1)
            marks = _joined(hashes(langs.dictionary.to_pylist(), 1)[own_lang], hashes(words, 1)[own_word])
            yield _row(
                lang=langs.dictionary.take(pa.array(own_lang)),
                word=coded.dictionary.take(pa.array(own_word)),
                key=pa.array(keys[real][first].view(np.int64)),
                mark=pa.array(marks.view(np.int64)),
                n=pa.array(n.astype(np.int64)),
            )

    return run


_KEYED = {
    "lang": pa.string(), "word": pa.string(), "key": pa.int64(), "mark": pa.int64(), "n": pa.int64(),
    "keys": pa.list_(pa.int64()),
}


def _row(**columns: pa.Array) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    arrays = [columns[c] if c in columns else pa.nulls(rows, t) for c, t in _KEYED.items()]
    return pa.RecordBatch.from_arrays(arrays, list(_KEYED))


# --- Counting a shard -------------------------------------------------------------------------


class Noted:
    """The stop at which each noted phrase of one length was noted."""

    def __init__(self, keys: np.ndarray, stops: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.stops = keys[order], stops[order].astype(np.int16)
        bits = max(int(len(keys)).bit_length() + 1, 1)
        self.shift = np.uint64(64 - bits)
        # Where keys with the same leading bits begin; few share them.
        self.opens = np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def stop(self, keys: np.ndarray) -> np.ndarray:
        """-1 for phrases that are not noted."""
        last = len(self.keys) - 1
        if last < 0:
            return np.full(len(keys), -1, np.int16)
        at = np.minimum(self.opens[keys >> self.shift], last)
        todo = np.flatnonzero((self.keys[at] < keys) & (at < last))
        while len(todo):
            at[todo] += 1
            todo = todo[(self.keys[at[todo]] < keys[todo]) & (at[todo] < last)]
        return np.where(self.keys[at] == keys, self.stops[at], np.int16(-1))


class Guessed:
    """A Bloom filter of noted phrases: their stops are settled later."""

    def __init__(self, blocks: int, bits: bytes):
        self.filter = Filter(blocks, 0, np.frombuffer(bits, np.uint64))

    def stop(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int16)
        found[self.filter.positives(keys)] = 0
        return found


def phrase_places(words: np.ndarray, noted: dict[int, Noted | Guessed]):
    """Per length from 2: places where both subphrases are noted, keys and stops there."""
    keys, stops = words, np.full(len(words), -1, np.int16)
    real = np.flatnonzero(words != _BREAK)
    stops[real] = noted[1].stop(words[real]) if 1 in noted else np.int16(-1)
    for size in range(2, MOST_WORDS + 1):
        at = np.flatnonzero((stops[:-1] >= 0) & (stops[1:] >= 0))
        found = _joined(keys[at], words[at + size - 1])
        yield size, at, found, np.maximum(stops[at], stops[at + 1])
        if size not in noted or not len(at):
            return
        keys = np.zeros(len(keys) - 1, np.uint64)
        keys[at] = found
        longer = np.full(len(keys), -1, np.int16)
        longer[at] = noted[size].stop(found)
        stops = longer


def _summed(words: np.ndarray, size: int, at: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """(w1 .. w4, n) of the phrases at some places; equal phrases stand side by side."""
    at = at[np.argsort(keys)]
    columns = [words[at + i] for i in range(size)]
    new = np.zeros(len(at), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    first = np.flatnonzero(new)
    columns = [c[first].view(np.int64) for c in columns]
    columns += [np.zeros(len(first), np.int64)] * (MOST_WORDS - size)
    n = np.diff(first, append=len(at)).astype(np.int64)
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(n)], [*WORDS, "n"])


def _counted(shared: Broadcast, after: int):
    """Counts of active phrases; active are those noted at a stop above ``after``."""

    def flush(lists: list[np.ndarray], noted) -> Batches:
        words = np.concatenate(lists)
        for size, at, keys, stops in phrase_places(words, noted):
            active = stops > after
            if active.any():
                yield _summed(words, size, at[active], keys[active])

    def run(batches: Batches) -> Batches:
        noted = {
            size: Guessed(*found) if isinstance(found[1], bytes) else Noted(*found)
            for size, found in shared.value.items()
        }
        waiting, many, end = [], 0, np.array([_BREAK], np.uint64)
        for batch in batches:
            lists = batch.column("keys")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for a, b in zip(offsets[:-1], offsets[1:]):
                if b > a:
                    waiting += [flat[a:b].view(np.uint64), end]
                    many += b - a
                if many >= WORDS_PER_COUNT:
                    yield from flush(waiting, noted)
                    waiting, many = [], 0
            waiting = [np.concatenate(waiting)] if waiting else []  # lets the batch go
        if waiting:
            yield from flush(waiting, noted)

    return run


# --- The cycle of scans -----------------------------------------------------------------------


def _size(words: list[str] = WORDS) -> Column:
    return sum(((F.col(w) != 0).cast("int") for w in words), F.lit(0))


def _phrase_keys(rows: pa.Table, size: int) -> np.ndarray:
    columns = [rows.column(w).to_numpy().view(np.uint64) for w in WORDS[:size]]
    keys = columns[0]
    for column in columns[1:]:
        keys = _joined(keys, column)
    return keys


class _Scan:
    """The state between two shards: tables in the shared folder, and few numbers here."""

    def __init__(self, docs: DataFrame, seed: int, shards: int, threshold: int):
        self.docs, self.seed, self.shards, self.threshold = docs, seed, shards, threshold
        self.spark: SparkSession = docs.sparkSession
        self.keyed: list[DataFrame] = []
        self.counts: list[DataFrame | None] = []
        self.marks: list[DataFrame] = []  # w1, lang, word, n and the least and greatest mark
        self.rich: list[DataFrame | None] = []  # the counts that reach a share of the threshold
        self.noted: DataFrame | None = None  # w1 .. w4, stop
        self.arrays: dict[int, list] = {}  # per length: keys and stops, while they fit
        self.many = {size: 0 for size in range(1, MOST_WORDS + 1)}
        self.last_stop = 0

    def run(self) -> None:
        step = 0
        while step < max(self.shards, self.last_stop + self.shards):
            if step < self.shards:
                shard = F.pmod(F.xxhash64("text"), F.lit(self.shards)) == step
                keyed = map_batches(
                    self.docs.filter(shard), _keyed(self.seed),
                    "lang string, word string, key long, mark long, n long, keys array<long>",
                )
                self.keyed.append(written(keyed, "phrases-keyed", **DICTIONARY))
            self.counts.append(self._count(step))
            self._note(step)
            step += 1

    def _count(self, step: int) -> DataFrame | None:
        """(w1 .. w4, n) of what is active in the shard of this step."""
        shard = self.keyed[step % self.shards]
        found = None
        if step < self.shards:
            zero = F.lit(0).cast("long")
            words = shard.filter("word IS NOT NULL").groupBy(F.col("key").alias("w1"), "lang", "word")
            words = words.agg(F.sum("n").alias("n"), F.min("mark").alias("a"), F.max("mark").alias("b"))
            self.marks.append(written(words, "phrases-words", **DICTIONARY))
            found = self.marks[-1].select("w1", *(zero.alias(w) for w in WORDS[1:]), "n")
        if self.many[1]:
            after = step - self.shards
            shared, exact = self._shared()
            run = _counted(shared, after if exact else -1)
            phrases = map_batches(shard.filter("keys IS NOT NULL").select("keys"), run, COUNTS)
            # dealt out as they come: a task's rows are added up already, and hardly repeat
            phrases = _added(phrases.repartition(*WORDS))
            if not exact:
                phrases = self._settled(phrases, after)
            counts = written(phrases, "phrases-counts", **DICTIONARY)
            shared.destroy()
            found = counts if found is None else found.unionByName(counts)
        return found

    def _note(self, step: int) -> None:
        """Note the phrases that have reached the threshold at the stop after this step.

        A sum of n parts reaches the threshold only if one part reaches its n-th share; what
        a phrase has in the other parts is then below that share. So few phrases are hopeful,
        and only theirs are added up.
        """
        share = -(-self.threshold // self.shards)
        now = self.counts[-1]
        self.rich.append(None if now is None else written(now.filter(F.col("n") >= share), "phrases-rich"))
        recent = [c for c in self.counts[-self.shards :] if c is not None]
        hopeful = _added(_union(self.rich[-self.shards :]), F.count("*").alias("parts"))
        most = F.col("n") + (len(recent) - F.col("parts")) * (share - 1)
        hopeful = hopeful.filter(most >= self.threshold).select(WORDS)
        if self.noted is not None:
            hopeful = hopeful.join(self._listed(), WORDS, "left_anti")
        hopeful = written(hopeful, "phrases-hopeful")
        many = hopeful.count()
        if not many:
            return
        listed = F.broadcast(hopeful) if many <= LISTED else hopeful
        reached = _added(_union(recent).join(listed, WORDS, "left_semi"))
        reached = reached.filter(F.col("n") >= self.threshold)
        new = written(reached.select(*WORDS, F.lit(step + 1).alias("stop")), "phrases-noted")
        forget(hopeful)
        sizes = {r["size"]: r["n"] for r in new.groupBy(_size().alias("size")).agg(F.count("*").alias("n")).collect()}
        if not sizes:
            return
        self.noted = new if self.noted is None else self.noted.unionByName(new)
        for size, n in sizes.items():
            self.many[size] += n
        if any(size < MOST_WORDS for size in sizes):
            self.last_stop = step + 1
        if self._fit():
            self._keep(new.filter(_size() < MOST_WORDS).select(WORDS).toArrow(), step + 1)

    def _keep(self, rows: pa.Table, stop: int) -> None:
        size = sum((rows.column(w).to_numpy() != 0).astype(np.int32) for w in WORDS)
        for s in np.unique(size).tolist():
            keys = _phrase_keys(rows.filter(pa.array(size == s)), s)
            self.arrays.setdefault(s, []).append((keys, np.full(len(keys), stop, np.int16)))

    def _listed(self) -> DataFrame:
        """The noted phrases, to be broadcast while they are few."""
        noted = self.noted.select(WORDS)
        return F.broadcast(noted) if sum(self.many.values()) <= LISTED else noted

    def _fit(self) -> bool:
        return 10 * sum(n for size, n in self.many.items() if size < MOST_WORDS) <= NOTED_BYTES

    def _shared(self) -> tuple[Broadcast, bool]:
        """What the tasks look phrases up in, and whether it is exact."""
        if self._fit():
            exact = {
                size: tuple(map(np.concatenate, zip(*parts))) for size, parts in self.arrays.items()
            }
            return self.spark.sparkContext.broadcast(exact), True
        self.arrays.clear()
        most = max(1, NOTED_BYTES // (8 * BLOCK_WORDS * (MOST_WORDS - 1)))
        blocks = {s: min(blocks_for(n), most) for s, n in self.many.items() if n and s < MOST_WORDS}

        def hashed(batches: Batches) -> Batches:
            from rostra.llm.spelling import _mixed as filter_hash

            for batch in batches:
                rows = pa.Table.from_batches([batch])
                size = sum((rows.column(w).to_numpy() != 0).astype(np.int32) for w in WORDS)
                for s in np.unique(size):
                    keys = _phrase_keys(rows.filter(pa.array(size == s)), int(s))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), s, np.int32)), pa.array(filter_hash(keys).view(np.int64))],
                        ["size", "hash"],
                    )

        rows = map_batches(self.noted.filter(_size() < MOST_WORDS).select(WORDS), hashed, "size int, hash long")
        parts = map_batches(rows, _in_parts(blocks), "size int, part int, hash long")
        built = parts.groupBy("size", "part").applyInArrow(_build(blocks), "size int, part int, bits binary")
        bits: dict[tuple[int, int], bytes] = {(r["size"], r["part"]): r["bits"] for r in built.collect()}
        filters = {}
        for size, many in blocks.items():
            ends = [min(PART_BLOCKS, many - p) for p in range(0, many, PART_BLOCKS)]
            found = [bits.get((size, i), bytes(8 * BLOCK_WORDS * n)) for i, n in enumerate(ends)]
            filters[size] = (many, b"".join(found))
        return self.spark.sparkContext.broadcast(filters), False

    def _settled(self, counts: DataFrame, after: int) -> DataFrame:
        """The counts of those phrases whose subphrases are noted, the later one not before."""
        size = _size()
        first = [F.when(size > i + 1, F.col(w)).otherwise(0).alias(f"s{i}") for i, w in enumerate(WORDS)]
        rest = [F.col(w).alias(f"s{i}") for i, w in enumerate(WORDS[1:])] + [F.lit(0).alias("s3")]
        places = [f"s{i}" for i in range(MOST_WORDS)]
        noted = self.noted.select(*(F.col(w).alias(s) for w, s in zip(WORDS, places)), "stop")
        found = counts.select("*", *first).join(noted, places).drop(*places)
        found = found.withColumnRenamed("stop", "stop1").select("*", *rest).join(noted, places)
        active = F.greatest("stop1", "stop") > after
        return found.filter(active).select(*WORDS, "n")

    def clash(self) -> bool:
        """Whether two different words share a key: their marks then differ."""
        marks = _union(self.marks).groupBy("w1").agg(F.min("a").alias("a"), F.max("b").alias("b"))
        return not marks.filter("a <> b").isEmpty()

    def words(self) -> DataFrame:
        """(lang, word, key, n), once per shard: batches of texts are added up."""
        return _union(self.marks).select("lang", "word", F.col("w1").alias("key"), "n")

    def totals(self) -> DataFrame:
        """(w, f): the noted phrases and words as arrays of keys, with their exact counts."""
        found = _union(self.counts)
        found = found.limit(0) if self.noted is None else found.join(self._listed(), WORDS, "left_semi")
        words = F.filter(F.array(*WORDS), lambda w: w != 0)
        return _added(found).select(words.alias("w"), F.col("n").alias("f"))


def _union(parts: list[DataFrame | None]) -> DataFrame:
    known = [p for p in parts if p is not None]
    found = known[0]
    for part in known[1:]:
        found = found.unionByName(part)
    return found


def _added(counts: DataFrame, *more: Column) -> DataFrame:
    return counts.groupBy(*WORDS).agg(F.sum("n").alias("n"), *more)


def _scored(totals: DataFrame) -> DataFrame:
    """(w, a, l, r, score) of every phrase at its lowest-scoring cut."""
    phrases = totals.filter(F.size("w") > 1).withColumnRenamed("f", "a")
    size = F.size("w")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = phrases.select("w", "a", cut).select(
        "w", "a", "k", F.expr("slice(w, 1, k)").alias("left"), F.expr("slice(w, k + 1, size(w) - k)").alias("right")
    )
    for side, name in (("left", "l"), ("right", "r")):
        known = small(totals.select(F.col("w").alias(side), F.col("f").alias(name)))
        cuts = cuts.join(known, side)
    # 38 digits hold the product exactly
    score = F.expr(f"CAST(a AS DECIMAL(30,0)) * CAST({SCALE} AS DECIMAL(7,0)) div CAST(l + r AS DECIMAL(30,0))")
    best = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("best")
    found = cuts.groupBy("w", "a").agg(best)
    return found.select("w", "a", "best.l", "best.r", "best.score")


def _without_contained(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases that no longer phrase holds about as often."""
    longer = totals.filter(F.size("w") > 2)
    parts = F.expr(
        "flatten(transform(sequence(2, size(w) - 1),"
        " n -> transform(sequence(1, size(w) - n + 1), i -> slice(w, i, n))))"
    )
    inside = longer.select(F.explode(parts).alias("w"), "f").groupBy("w").agg(F.max("f").alias("longest"))
    whole, share = CONTAINED
    gone = F.coalesce(F.col("longest") * whole >= F.col("a") * share, F.lit(False))
    return phrases.join(inside, "w", "left").filter(~gone).drop("longest")


def collocations(
    docs: DataFrame,
    shards: int = SHARDS,
    threshold: int = THRESHOLD,
    reported: int = REPORTED,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("text"))
    seed, session = 0, docs.sparkSession
    while True:
        with temporary(session):
            scan = _Scan(docs, seed, shards, threshold)
            scan.run()
            if not scan.clash():
                return written(_report(scan, reported), "phrases-found", keep=True)
        seed += 1


def _report(scan: _Scan, reported: int) -> DataFrame:
    totals = written(scan.totals(), "phrases-totals")
    phrases = _without_contained(_scored(totals), totals)
    phrases = written(phrases, "phrases-scored")
    single = phrases.select(F.explode("w").alias("key")).distinct()
    names = scan.words().join(small(single), "key", "left_semi").select("key", "lang", "word").distinct()
    names = written(names, "phrases-names")
    placed = phrases.select("*", F.posexplode("w").alias("place", "key")).join(small(names), "key")
    spelled = placed.groupBy("w", "a", "l", "r", "score").agg(
        F.min("lang").alias("lang"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda p: p["word"]), " "
        ).alias("phrase"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = spelled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= reported)
    n = scan.words().groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
