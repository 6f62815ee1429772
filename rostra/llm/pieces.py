"""Sampled segmentations into the pieces of a SentencePiece model, and the way back.

A text becomes pieces by forward filtering and backward sampling over its piece lattice:
forward, every place gets the total weight of all segmentations up to it; backward from
the end, a piece is drawn in proportion to the weight of what lies before it. So each whole
segmentation is drawn with its exact probability. No piece reaches over the place before a
space that follows another character, hence the lattice falls apart at such places, and
each distinct word of a batch is filtered once. Both directions take one step for all
words of the batch together.

The model file holds ranks, not probabilities: a piece of rank r (from 0) weighs
(r + 3) ** -1, Zipf's law, and ``temperature`` raises weights to its inverse. Draws come
from a hash of the row's key, the seed and the place in the text, so a row is segmented
alike in any partitioning. Characters that the model lacks become their UTF-8 bytes, as
byte pieces; U+2581, which stands for a space, does as well, so decoding gives every text
back.

Defined cases: null and empty texts have no piece; rows with a null key draw as the key -1;
rows that repeat a key draw alike.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import Batches, by_bytes, map_batches, whole_text

SPACE = "▁"
LITERAL = "\udc00"  # no text holds it: stands for a real U+2581
BATCH_BYTES = 1 << 19  # of text, whose lattices are in memory together
SEED = 1
TEMPERATURE = 0.5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1B54A32D192ED03)  # odd, so it has an inverse
_LEADING = 19  # bits
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _uniform(*parts: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from integers."""
    x = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            x = (x ^ part.astype(np.uint64)) * _MIX
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)) * 2.0**-53


_known_powers: list[np.ndarray] = [np.ones(0, np.uint64)] * 2


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the inverse of the base and of the base, from 1.

    Those for the letters of one batch are kept.
    """
    found = _known_powers
    if len(found[0]) < n:
        exponents = np.arange(1, max(n, BATCH_BYTES) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            found = [_INVERSE**exponents, _BASE**exponents]
        if n <= BATCH_BYTES:
            _known_powers[:] = found
    return found[0][:n], found[1][:n]


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """The pieces of a model, their weights, and all their beginnings by hash."""

    def __init__(self, model: str, temperature: float):
        import sentencepiece

        piece = sentencepiece.SentencePieceProcessor(model_file=model)
        size, rank = piece.vocab_size(), 0
        self.bytes = np.full(256, -1, np.int32)
        self.texts = [b""] * size
        self.weight = np.full(size, -np.inf)  # logarithms
        known: dict[str, int] = {}
        for i in range(size):
            text = piece.id_to_piece(i)
            if piece.is_byte(i):
                self.bytes[int(text[3:5], 16)] = i
                self.texts[i] = bytes([int(text[3:5], 16)])
            elif not (piece.is_control(i) or piece.is_unknown(i) or piece.is_unused(i)):
                known[text] = i
                self.weight[i] = -np.log(rank + 3.0) / temperature
                self.texts[i] = text.replace(SPACE, " ").encode()
                rank += 1
        self.ids = known
        self.weight_of_bytes = -np.log(rank + 3.0) / temperature
        self.longest = max(map(len, known))
        begins = {text[:n]: -1 for text in known for n in range(1, len(text) + 1)} | known
        hashes = np.array([int(self.prefixes(_letters(t))[-1]) for t in begins], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.piece = np.array(list(begins.values()), np.int32)[order]
        self.powers = _BASE ** np.arange(self.longest + 1, dtype=np.uint64)
        # Where hashes with the same leading bits begin; few share them.
        leading = np.arange(1 << _LEADING, dtype=np.uint64) << np.uint64(64 - _LEADING)
        self.opens = np.searchsorted(self.hashes, leading)

    def find(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are of beginnings, and the pieces they are, -1 for none."""
        last = len(self.hashes) - 1
        at = np.minimum(self.opens[own >> np.uint64(64 - _LEADING)], last)
        todo = np.flatnonzero((self.hashes[at] < own) & (at < last))
        while len(todo):
            at[todo] += 1
            todo = todo[(self.hashes[at[todo]] < own[todo]) & (at[todo] < last)]
        found = self.hashes[at] == own
        return found, np.where(found, self.piece[at], -1)

    @staticmethod
    def prefixes(letters: np.ndarray) -> np.ndarray:
        """Polynomial hashes of all beginnings, the empty one included."""
        turns, back = _powers(len(letters))
        with np.errstate(over="ignore"):
            mixed = (letters.astype(np.uint64) + np.uint64(1)) * _MIX
            mixed ^= mixed >> np.uint64(29)
            # h(n) = sum of mixed[i] * base^(n - 1 - i), by way of the inverse of the base
            mixed *= turns
            sums = np.empty(len(letters) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(mixed, out=sums[1:])
            sums[1:] *= back
        return sums

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.texts[i] for i in ids]).decode("utf-8", "replace")


class Lattices:
    """The filtered lattices of some words, side by side.

    Every letter is a node, for the place behind it; all first letters come first, then all
    second ones, words in the order of their length. The edges of a node are the pieces that
    end there, with running totals of their shares; ``goes`` is the node an edge comes from,
    -1 at the word's begin. An edge numbered below -1 is a letter as bytes.
    """

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        letters = _letters("".join(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        place = np.arange(len(letters)) - np.repeat(ends - sizes, sizes)
        longest = int(sizes.max(initial=0))
        # Words that have a letter at a place are the first ones in the order of length.
        many_at = len(words) - np.cumsum(np.bincount(sizes, minlength=longest + 1))[:longest]
        steps = np.concatenate([[0], np.cumsum(many_at)])
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(-sizes, kind="stable")] = np.arange(len(words))
        node = steps[place] + np.repeat(rank, sizes)  # of each letter
        self.last = node[ends - 1] if len(words) else node  # the node behind each word
        found = self._edges(vocabulary, letters, np.repeat(ends, sizes) - np.arange(len(letters)))
        # Edges by node, those from farther back first.
        count = np.zeros(len(letters), np.int64)
        for starts, length, _ in found:
            count[node[starts + length - 1]] += 1
        upto = np.cumsum(count)
        first, free = upto - count, upto - count
        edges = int(count.sum())
        pieces, goes = np.empty(edges, np.int64), np.empty(edges, np.int64)
        for starts, length, piece in reversed(found):
            to = node[starts + length - 1]
            at = free[to]
            free[to] = at + 1
            pieces[at] = piece
            goes[at] = np.where(place[starts] > 0, node[starts - 1], -1)
        weight = np.where(pieces >= 0, vocabulary.weight[pieces], vocabulary.weight_of_bytes)
        # Forward filtering, in logarithms, all words one place further at a time.
        alpha = np.zeros(len(letters) + 1)  # the last one is that of a word's begin
        share = np.empty(edges)
        bounds = np.concatenate([[0], upto])
        for a, b in zip(steps, steps[1:]):
            here, cuts, many = slice(bounds[a], bounds[b]), first[a:b] - bounds[a], count[a:b]
            own = weight[here] + alpha[goes[here]]
            most = np.maximum.reduceat(own, cuts)
            own = np.exp(own - np.repeat(most, many))
            total = np.add.reduceat(own, cuts)
            alpha[a:b] = most + np.log(total)
            share[here] = own / np.repeat(total, many)
        share = np.cumsum(share)
        share += np.repeat(np.arange(len(letters)) - np.concatenate([[0.0], share])[first], count)
        self.total = share
        self.total[upto - 1] = np.arange(len(letters)) + 1.0
        self.piece, self.goes, self.first = pieces, goes, first

    def draw(self, node: np.ndarray, uniform: np.ndarray) -> np.ndarray:
        """An edge of each node, in proportion to the shares."""
        edge, value = self.first[node], node + uniform
        todo = np.flatnonzero(self.total[edge] <= value)
        while len(todo):
            edge[todo] += 1
            todo = todo[self.total[edge[todo]] <= value[todo]]
        return edge

    def spelled(self, ids: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """With the bytes of letters in place of the edges that stand for them."""
        sizes = np.array([len(f) for f in self.fallbacks], np.int64)
        flat = np.array([i for f in self.fallbacks for i in f], np.int64)
        letter = np.where(ids < 0, -2 - ids, 0)
        times = np.where(ids < 0, sizes[letter], 1)
        upto = np.cumsum(times)
        within = np.arange(upto[-1]) - np.repeat(upto - times, times)
        whole = np.repeat(ids, times)
        at = np.flatnonzero(whole < 0)
        begins = (np.cumsum(sizes) - sizes)[-2 - whole[at]]
        whole[at] = flat[begins + within[at]]
        return whole, np.repeat(owners, times)

    def _edges(self, vocabulary: Vocabulary, letters: np.ndarray, room: np.ndarray):
        """Starts, length and numbers of all pieces within the words, by rising length."""
        prefix = vocabulary.prefixes(letters)
        active = np.arange(len(letters))
        edges: list[tuple[np.ndarray, int, np.ndarray]] = []
        self.fallbacks: list[list[int]] = []
        for length in range(1, vocabulary.longest + 1):
            active = active[room[active] >= length]
            if not len(active):
                break
            with np.errstate(over="ignore"):
                own = prefix[active + length] - prefix[active] * vocabulary.powers[length]
            found, piece = vocabulary.find(own)
            good = piece >= 0
            if length == 1:
                alone = np.flatnonzero(~good)
                kinds, which = np.unique(letters[active[alone]], return_inverse=True)
                self.fallbacks = [
                    vocabulary.bytes[list((SPACE if chr(c) == LITERAL else chr(c)).encode())].tolist()
                    for c in kinds.tolist()
                ]
                edges.append((active[alone], 1, -2 - which))
            edges.append((active[good], length, piece[good]))
            active = active[found]
        return edges


def words(text: str) -> list[str]:
    """The text cut before every space that follows another character, spaces marked."""
    parts = text.replace(SPACE, LITERAL).split(" ")
    if "" not in parts:
        return [parts[0], *[SPACE + p for p in parts[1:]]]
    if len(parts) == 1:
        return []
    found, spaces = [parts[0]] if parts[0] else [], ""
    for part in parts[1:]:
        spaces += SPACE
        if part:
            found.append(spaces + part)
            spaces = ""
    return [*found, spaces] if spaces else found


class Sampler:
    def __init__(self, model: str, seed: int, temperature: float):
        self.vocabulary, self.seed = _vocabulary(model, temperature), seed

    def sample(self, keys: list[int | None], texts: list[str]) -> list[np.ndarray]:
        """The ids of the pieces drawn for each text."""
        cut = [words(t) for t in texts]
        distinct = list(set().union(*cut) - {""})
        lattices = Lattices(self.vocabulary, distinct)
        known = dict(zip(distinct, lattices.last.tolist()))
        piece, goes = lattices.piece, lattices.goes
        counts = np.array([len(c) for c in cut])
        flat = [w for c in cut for w in c]
        node = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
        key = np.repeat(np.array([-1 if k is None else k for k in keys], np.int64), counts)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        seed = np.array([self.seed])
        alive, step = np.arange(len(flat)), 0
        drawn, owner = [], []
        while len(alive):
            draw = _uniform(seed, key[alive], place[alive], np.array([step]))
            edge = lattices.draw(node[alive], draw)
            drawn.append(piece[edge])
            owner.append(alive)
            came = goes[edge]
            node[alive] = came
            alive = alive[came >= 0]
            step += 1
        if not drawn:
            return [np.zeros(0, np.int32) for _ in texts]
        # Pieces were drawn from the ends of words backward.
        many = np.bincount(np.concatenate(owner), minlength=len(flat))
        after = np.cumsum(many)
        ids = np.empty(after[-1], np.int64)
        for step, (own, found) in enumerate(zip(owner, drawn)):
            ids[after[own] - 1 - step] = found
        owners = np.repeat(np.arange(len(flat)), many)
        if (ids < 0).any():
            ids, owners = lattices.spelled(ids, owners)
        sizes = np.bincount(owners, minlength=len(flat))
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ends = upto[np.cumsum(counts)]
        return np.split(ids.astype(np.int32), ends[:-1])

    def decode(self, ids: np.ndarray) -> str:
        return self.vocabulary.decode(ids.tolist())


# One table of pieces per worker process: it is the same for all tasks.
_vocabularies: dict[tuple[str, float], Vocabulary] = {}


def _vocabulary(model: str, temperature: float) -> Vocabulary:
    if (model, temperature) not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[model, temperature] = Vocabulary(model, temperature)
    return _vocabularies[model, temperature]


def _encode(model: str, seed: int, temperature: float):
    def run(batches: Batches) -> Batches:
        sampler = Sampler(model, seed, temperature)
        for batch in by_bytes(batches, "_text", BATCH_BYTES):
            texts = batch.column("_text").to_pylist()
            found = sampler.sample(batch.column("_key").to_pylist(), texts)
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            flat = np.concatenate([*found, np.zeros(0, np.int32)])
            names = [n for n in batch.schema.names if n not in ("_key", "_text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                    pa.array([sampler.decode(ids) == t for ids, t in zip(found, texts)], pa.bool_()),
                ],
                [*names, "ids", "lossless"],
            )

    return run


def _decode(model: str):
    def run(batches: Batches) -> Batches:
        vocabulary = _vocabulary(model, 1.0)
        for batch in batches:
            texts = [vocabulary.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            names = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string())], [*names, "text"]
            )

    return run


def _fields(df: DataFrame, *without: str) -> list[str]:
    kept = [f for f in df.schema.fields if f.name not in without]
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]


def encode(
    docs: DataFrame,
    model: str | None = None,
    seed: int = SEED,
    temperature: float = TEMPERATURE,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The kept columns, ids (array of int) and lossless (decoding gave the text back)."""
    rows = docs.select(
        *keep, F.col("doc_id").cast("long").alias("_key"), whole_text().alias("_text")
    )
    schema = ", ".join([*_fields(rows, "_key", "_text"), "ids array<int>", "lossless boolean"])
    run = _encode(model or public_tokenizers.path("piece_bpe_32k.model"), seed, temperature)
    return map_batches(rows, run, schema)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The other columns with the text in place of ``ids``; null ids give the empty text."""
    schema = ", ".join([*_fields(encoded, "ids", "text"), "text string"])
    rows = encoded.drop("text") if "text" in encoded.columns else encoded
    return map_batches(rows, _decode(model or public_tokenizers.path("piece_bpe_32k.model")), schema)
