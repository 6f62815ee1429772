"""N-gram Jaccard join by chosen paths.

Texts are sets of runs of five words. A run of the join splits the sets recursively: a set
of n elements goes on with every element whose hash on the path so far lies below
1 / (similarity * n), so similar sets choose shared elements together and others part.
Buckets of at most ``small_bucket`` sets are compared outright. A larger one splits again,
unless most of its parent went into it: then its members are near copies of each other,
splitting does not help, and it is compared in blocks. Runs are repeated until a pair at
the threshold is missed with a probability below 1 - ``recall`` (``runs_for``).

Sets that are equal are one class from the start, so copies cost nothing. Blocks are
compared by matrix products inside the tasks; a pair counts in the first bucket (by key)
that its two sets share, so each link counts once and no pair becomes a row. A block emits
per set its number of links and one edge to a smaller set it is linked with, which is
enough for the classes. A bucket of any size is dealt out as pairs of blocks.

Before sets are read in full, buckets are compared by 64-slot minwise sketches of 8 bits,
as the published join does, and only memberships with a partner go on; the margin makes a
pair at the threshold fail there with a probability below 1e-6. Counted links are exact.

Defined cases: words are lower-case runs of word characters, or what white space separates
where a text has none; a text of one to four words has one element, all its words; texts
without words (null, empty) have no link and form classes of their own; a null id takes no
part; rows that repeat an id and its text are one document; the texts of an id that differ
are documents of their own, told apart and ordered by a hash of the text.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
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

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
SMALL_BUCKET = 128
DENSE = 0.5
MOST_LEVELS = 6
BLOCK = 1024
BATCH_BYTES = 1 << 20  # of text, whose sets are in memory together
SLOTS = 64
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def runs_for(similarity: float, recall: float, levels: int = 2) -> int:
    """Runs until a pair at the threshold is missed by less than 1 - recall.

    A level keeps such a pair together with probability 1 - exp(-share / similarity), where
    share is the part of its elements that each set has in common with the other.
    """
    share = 2 * similarity / (1 + similarity)
    once = (1 - math.exp(-share / similarity)) ** levels
    return math.ceil(math.log(1 - recall) / math.log(1 - once))


def elements(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of words."""
    found = _WORD.findall(text.lower()) or text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    runs = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    return np.unique(np.array([xxhash.xxh3_64_intdigest(r) for r in set(runs)], np.uint64))


def mix(x: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of numbers, different for each salt."""
    with np.errstate(over="ignore"):
        x = (x ^ np.asarray(salt, np.uint64)) * _MIX
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chosen(own: np.ndarray, path: int, similarity: float) -> np.ndarray:
    """Paths that a set takes from ``path``."""
    salt = mix(np.array([path], np.uint64), 7)[0]
    hashes = mix(own, salt)
    limit = 2.0**64 / (similarity * len(own))
    return hashes if limit >= 2.0**64 else hashes[hashes < np.uint64(limit)]


def sketch(own: np.ndarray) -> np.ndarray:
    """Eight bits of the least hash in each slot."""
    salts = mix(np.arange(SLOTS, dtype=np.uint64), 99)
    least = np.full(SLOTS, np.iinfo(np.uint64).max)
    for begin in range(0, len(own), 4096):
        part = mix(own[None, begin : begin + 4096], salts[:, None]).min(1)
        least = np.minimum(least, part)
    return (least & np.uint64(255)).astype(np.uint8)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _signatures(words: int, similarity: float, runs: int):
    """What the first level needs of a text: digest, size, sketch and paths of its set."""

    def run(batches: Batches) -> Batches:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            digests, sizes, sketches, paths = [], [], [], []
            for text in batch.column("text").to_pylist():
                own = elements(text, words)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                sketches.append(sketch(own).tobytes() if len(own) else None)
                paths.append(
                    np.concatenate([chosen(own, r, similarity) for r in range(1, runs + 1)])
                    if len(own)
                    else own
                )
            offsets = np.cumsum([0, *map(len, paths)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sketches, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), _signed(np.concatenate(paths))
                    ),
                ],
                ["doc_id", "text_key", "digest", "size", "sketch", "paths"],
            )

    schema = "doc_id long, text_key long, digest binary, size int, sketch binary, paths array<long>"
    return run, schema


def _with_sets(words: int):
    """(id, own) of rows (id, digest, text) whose text has the set of that digest."""

    def run(batches: Batches) -> Batches:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            sets = [elements(t, words) for t in batch.column("text").to_pylist()]
            wanted = batch.column("digest").to_pylist()
            meant = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(sets, wanted)]
            if not all(meant):  # two texts of an id with one key
                sets = [s for s, m in zip(sets, meant) if m]
                batch = batch.filter(pa.array(meant))
            offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            own = pa.ListArray.from_arrays(offsets, _signed(np.concatenate([*sets, np.zeros(0, np.uint64)])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), own], ["id", "own"])

    return run


def _lists(column: pa.Array) -> list[np.ndarray]:
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy().view(np.uint64)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _deeper(similarity: float):
    """Children of a bucket's members (path, id, own)."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            paths = batch.column("path").to_numpy().view(np.uint64)
            found = [chosen(s, p, similarity) for s, p in zip(_lists(batch.column("own")), paths)]
            times = [len(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("id").to_numpy(), times)),
                    pa.array(np.repeat(batch.column("path").to_numpy(), times)),
                    _signed(np.concatenate([*found, np.zeros(0, np.uint64)])),
                ],
                ["id", "parent", "path"],
            )

    return run


def leaf_buckets(first: DataFrame, sets_of, similarity: float, small_bucket: int) -> DataFrame:
    """(path, id, members): the buckets to compare, of two sets at least.

    ``first`` has (id, path) of the first level; ``sets_of`` gives the sets of some ids.
    """
    rows = first.withColumn("parent", F.lit(None).cast("long"))
    leaves, parents = [], None
    for level in range(MOST_LEVELS):
        counts = rows.groupBy("path").agg(
            F.count("*").alias("members"), F.first("parent").alias("parent")
        )
        counts = counts.filter("members > 1")
        dense = F.lit(False)
        if parents is not None:
            above = parents.select(F.col("path").alias("parent"), F.col("members").alias("above"))
            counts = counts.join(small(above), "parent")
            dense = F.col("members") >= DENSE * F.col("above")
        final = (F.col("members") <= small_bucket) | dense | F.lit(level == MOST_LEVELS - 1)
        counts = written(counts.select("path", "members", final.alias("final")), "buckets")
        at = rows.select("path", "id").join(small(counts), "path")
        leaves.append(at.filter("final").select("path", "id", "members"))
        parents = counts.filter("NOT final")
        if parents.isEmpty():
            break
        going = written(at.filter("NOT final").select("id", "path"), "open")
        deeper = going.join(sets_of(going.select("id").distinct()), "id").select("id", "path", "own")
        schema = "id long, parent long, path long"
        rows = written(map_batches(deeper, _deeper(similarity), schema), "paths")
    result = leaves[0]
    for part in leaves[1:]:
        result = result.unionByName(part)
    return result


def _block_pairs(members: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of (path, id, members) dealt to pairs of blocks of their bucket.

    Small buckets stay whole, many in one group; a set of a larger one goes to the pairs
    that its block is in.
    """
    blocks = F.ceil(F.col("members") / F.lit(float(BLOCK))).cast("int")
    own = F.pmod(F.xxhash64("id", "path"), blocks).cast("int")
    rows = members.withColumn("_blocks", blocks).withColumn("_own", own)
    only = [F.lit(0).alias("left"), F.lit(0).alias("right"), F.lit(True).alias("first")]
    whole = rows.filter("_blocks = 1").select("path", *only, *columns)
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    dealt = rows.filter("_blocks > 1").select("path", "_own", other, *columns)
    dealt = dealt.select(
        "path",
        F.least("_own", "_other").alias("left"),
        F.greatest("_own", "_other").alias("right"),
        (F.col("_own") <= F.col("_other")).alias("first"),
        *columns,
    )
    return whole.unionByName(dealt)


def _estimates(similarity: float):
    """Memberships with a partner by sketch, in the first bucket that the two share."""
    # Six deviations of the share of equal slots below the threshold.
    least = similarity - 6 * math.sqrt(similarity * (1 - similarity) / SLOTS)

    def pairs(rows, keys):
        own = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS)
        size = rows.column("size").to_numpy()
        if len(own) <= 48:
            same = (own[:, None] == own[None]).sum(2)
        else:
            same = np.zeros((len(own), len(own)), np.uint8)
            for slot in range(SLOTS):
                same += own[:, slot, None] == own[None, :, slot]
        close = same >= least * SLOTS
        ratio = np.minimum(size[:, None], size[None]) >= similarity * np.maximum(size[:, None], size[None])
        return close & ratio

    return pairs


def _exact(similarity: float):
    """Which sets of a block pair are linked, by a product of their incidence matrices."""

    def pairs(rows, keys):
        sets = _lists(rows.column("own"))
        size = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), size)
        values, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count[code] > 1  # an element of one set alone is in no intersection
        code, row = np.unique(code[shared], return_inverse=True)[1], row[shared]
        both = np.zeros((len(sets), len(sets)), np.float32)
        width = int(code.max()) + 1 if len(code) else 0
        for begin in range(0, width, 8192):
            part = np.zeros((len(sets), min(8192, width - begin)), np.float32)
            take = (code >= begin) & (code < begin + 8192)
            part[row[take], code[take] - begin] = 1
            both += part @ part.T
        return both >= similarity * (size[:, None] + size[None] - both) - 1e-6

    return pairs


def _first_shared(keys: list[np.ndarray], path: int) -> np.ndarray:
    """Pairs of sets whose least shared bucket is ``path``."""
    earlier = [k[k < path] for k in keys]
    flat = np.concatenate(earlier)
    if not len(flat):
        return np.ones((len(keys), len(keys)), bool)
    _, code = np.unique(flat, return_inverse=True)
    part = np.zeros((len(keys), int(code.max()) + 1), np.float32)
    part[np.repeat(np.arange(len(keys)), [len(k) for k in earlier]), code] = 1
    return part @ part.T == 0


def _compare(pairs, emit):
    def run(table: pa.Table) -> pa.Table:
        rows = table.combine_chunks().to_batches()[0]
        found = []
        order = np.lexsort((rows.column("id").to_numpy(), rows.column("path").to_numpy()))
        rows = rows.take(pa.array(order))
        path = rows.column("path").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1), len(path)]
        for a, b in zip(cuts, cuts[1:]):
            part = rows.slice(a, b - a)
            keys = [np.array(k, np.int64) for k in part.column("keys").to_pylist()]
            linked = pairs(part, keys) & _first_shared(keys, path[a])
            np.fill_diagonal(linked, False)
            first = part.column("first").to_numpy(zero_copy_only=False)
            if not first.all():  # across two blocks: what lies inside one is compared there
                linked &= first[:, None] != first[None]
            found.append(emit(part, linked))
        return pa.concat_tables(found)

    return run


def _partnered(part, linked) -> pa.Table:
    return pa.table([part.column("path"), part.column("id")], ["path", "id"]).filter(
        pa.array(linked.any(1))
    )


def _links(part, linked) -> pa.Table:
    ids = part.column("id").to_numpy()
    has = linked.any(1)
    # The least id of what is connected within these rows.
    least = ids.copy()
    while True:
        near = np.where(linked, least[None], least[:, None]).min(1)
        if (near == least).all():
            break
        least = near
    return pa.table(
        [ids, least, linked.sum(1), linked @ part.column("copies").to_numpy()],
        ["id", "other", "texts", "documents"],
    ).filter(pa.array(has))


def _bins(rows: DataFrame, rows_in_bin: int):
    """Large buckets by themselves, small ones some to a bin."""
    bins = max(256, rows.count() // rows_in_bin)
    return F.when(
        F.col("members") <= SMALL_BUCKET, F.pmod(F.xxhash64("path"), F.lit(bins))
    ).otherwise(F.col("path"))


def links(texts: DataFrame, sets_of, similarity: float, small_bucket: int) -> DataFrame:
    """(id, other, texts, documents) of sets with links, several rows per set.

    ``texts`` and ``documents`` sum up to the links of a set; the edges from ``id`` to
    ``other`` connect whatever is linked.
    """
    first = texts.select("id", F.explode("paths").alias("path"))
    leaves = written(leaf_buckets(first, sets_of, similarity, small_bucket), "leaves")
    keys = leaves.groupBy("id").agg(F.collect_set("path").alias("keys"))
    about = written(texts.join(keys, "id").select("id", "copies", "sketch", "size", "keys"), "about")
    short = leaves.join(about, "id").withColumn("bin", _bins(leaves, 1024))
    partnered = (
        _block_pairs(short, ["bin", "id", "sketch", "size", "keys"])
        .groupBy("bin", "left", "right")
        .applyInArrow(_compare(_estimates(similarity), _partnered), "path long, id long")
        .distinct()
    )
    going = written(partnered, "partnered")
    sizes = going.groupBy("path").agg(F.count("*").alias("members"))
    sets = sets_of(going.select("id").distinct()).join(about.select("id", "copies", "keys"), "id")
    full = (
        going.join(small(sizes), "path").join(sets, "id").withColumn("bin", _bins(going, 256))
    )
    return (
        _block_pairs(full, ["bin", "id", "copies", "own", "keys"])
        .groupBy("bin", "left", "right")
        .applyInArrow(
            _compare(_exact(similarity), _links), "id long, other long, texts long, documents long"
        )
    )


def classes(edges: DataFrame) -> DataFrame:
    """(id, class_id): the least id that edges lead to, by hooking and pointer jumping."""
    back = edges.select(F.col("other").alias("id"), F.col("id").alias("other"))
    both = written(edges.select("id", "other").unionByName(back).distinct(), "edges")
    labels = written(both.select("id").distinct().withColumn("class_id", F.col("id")), "labels")
    while True:
        other = labels.select(F.col("id").alias("other"), F.col("class_id").alias("seen"))
        least = both.join(other, "other").groupBy("id").agg(F.min("seen").alias("seen"))
        # Each label's own label follows, so that long chains shrink by halves.
        hooked = labels.join(least, "id").select(
            "id", F.col("class_id").alias("before"), F.least("class_id", "seen").alias("class_id")
        )
        hooks = hooked.groupBy("before").agg(F.min("class_id").alias("better"))
        hooks = hooks.withColumnRenamed("before", "class_id")
        better = F.least("class_id", F.coalesce("better", "class_id")).alias("class_id")
        jumped = hooked.join(hooks, "class_id", "left").select("id", "before", better)
        new = written(jumped, "labels")
        changed = not new.filter("before <> class_id").isEmpty()
        forget(labels)
        labels = new.select("id", "class_id")
        if not changed:
            return labels


def text_key() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(whole_text())


def joined(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    words: int = WORDS,
    recall: float = RECALL,
    small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """``jaccard_join`` with text_key, and kept: whether it is the first of its class."""
    rows = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        whole_text().alias("text"),
    )
    describe, schema = _signatures(words, similarity, runs_for(similarity, recall))
    found = written(map_batches(rows, describe, schema), "signatures")
    members = written(found.select("doc_id", "text_key", "digest").distinct(), "members")
    # With one text per id the least document names its set, and its class.
    several = not members.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    copies = (
        members.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.count("*").alias("copies"))
        .select(
            "digest",
            (F.xxhash64("digest") if several else F.col("first.doc_id")).alias("id"),
            F.col("first.doc_id").alias("first_id"),
            F.col("first.text_key").alias("first_key"),
            "copies",
        )
    )
    firsts = {"doc_id": "first_id", "text_key": "first_key"}
    texts = written(
        found.withColumnsRenamed(firsts)
        .join(copies, ["first_id", "first_key", "digest"])
        .dropDuplicates(["id"]),
        "texts",
    )
    forget(found)

    def sets_of(ids: DataFrame) -> DataFrame:
        """Computed anew from the texts: all sets together are larger than the texts."""
        wanted = small(texts.select("id", "first_id", "first_key", "digest").join(ids, "id"))
        body = rows.withColumnsRenamed(firsts).join(wanted, ["first_id", "first_key"])
        sets = map_batches(
            body.select("id", "digest", "text"), _with_sets(words), "id long, own array<long>"
        )
        return sets.dropDuplicates(["id"]) if repeated else sets

    repeated = rows.count() > members.count()
    pairs = written(links(texts, sets_of, similarity, small_bucket), "links")
    degree = pairs.groupBy("id").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    about = texts.join(degree, "id", "left").join(classes(pairs), "id", "left").select(
        "digest", "first_id", "first_key", "copies", "texts", "documents",
        F.coalesce("class_id", "id").alias("class"),
    )
    if several:
        about = written(about, "classes-of-texts")
        least = about.groupBy("class").agg(F.min(F.struct("first_id", "first_key")).alias("least"))
        about = about.join(small(least), "class")
        about = about.withColumns({"class": F.col("least.first_id"), "class_key": F.col("least.first_key")})
    else:
        about = about.withColumn("class_key", F.lit(None).cast("long"))
    zero = F.lit(0).cast("long")
    other_text = F.coalesce(F.col("text_key") != F.col("class_key"), F.lit(False))
    gone = (F.col("doc_id") != F.col("class")) | other_text
    return members.join(about, "digest", "left").select(
        "doc_id",
        "text_key",
        F.coalesce("first_id", "doc_id").alias("text_id"),
        F.coalesce("class", "doc_id").alias("class_id"),
        (F.coalesce("documents", zero) + F.coalesce(F.col("copies") - 1, zero)).alias("n_links"),
        F.coalesce("texts", zero).alias("n_text_links"),
        F.coalesce(~gone, F.lit(True)).alias("kept"),
    )


def jaccard_join(docs: DataFrame, **settings) -> DataFrame:
    """One row per document, which is an id with one text.

    doc_id; text_id, the least document with the same set; class_id, the least document of
    its connected class; n_links, the other documents with a similarity of ``similarity`` or
    more, copies included; n_text_links, the linked sets that differ.
    """
    return joined(docs, **settings).drop("text_key", "kept")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the least document of each class; rows without an id stay."""
    with temporary(docs.sparkSession):
        found = written(joined(docs, **settings), "classes", keep=True)
    gone = found.filter("NOT kept").select(
        F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")
    )
    gone = small(gone)
    same = (docs["doc_id"] == gone["_gone_id"]) & (text_key() == gone["_gone_key"])
    return docs.join(gone, same, "left_anti")
