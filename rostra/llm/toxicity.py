"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

The lexicon is learned from labelled rows: words and word beginnings that toxic rows hold
far more often than others. It forms a trie, in which whole words stay beside the beginnings
that cover them. Levenshtein automata of all its entries at once are intersected with that
trie: a state is a set of (trie node, edits so far, letter that came too early), an edit
inserts, deletes, replaces or swaps letters, and a bounded number of the states reached are
kept, so that an ordinary word leaves the automaton after a few letters.
A misspelling counts less than the word itself, and not at all where clean training rows
hold it. Each hit is weighed by its context: in quotation marks or after a reporting word it
is a quotation and counts little; other hits within the window make it count more.

A logistic model over what hits a text has gives the score. The lexicon and the model are
fitted on at most ``TRAINING_ROWS`` labelled rows of each class, those of least hash; every
whole text is scored. Each worker gets the lexicon (at most ``LEXICON_SIZE`` entries).

Defined cases: null and empty texts have no hit and get the score of such texts; without
labelled rows of both classes every score is 0; rows that repeat an id are scored each, and
so are rows without an id; very long texts, words and quotations are read whole, in time
that grows with their length; of equally near entries the smaller one counts; an empty table
gives no row; other columns may have any name and pass ``keep_clean`` as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import Batches, by_bytes, forget, held_out, map_batches, whole_text, written

TRAINING_ROWS = 10_000
LEXICON_SIZE = 2_000
# Letters of the word beginnings that may become entries.
SHORTEST, LONGEST = 3, 8
LEAST_ROWS = 3
LEAST_LOG_ODDS = 2.0
LEAST_DEVIATIONS = 3.2
# Words on either side of a hit that are its context.
WINDOW = 6
QUOTED = 0.25
MISSPELLED = 0.7
# Toxic rows for each clean one, from which on misspellings of an entry count.
CLEAR = 8
COMPANY = 0.25
REMEMBERED = 500_000  # words, and states of the automaton, that a task keeps
SPILLED = 100_000  # counted words that a task holds before it passes them on
BATCH_BYTES = 1 << 20
# Columns that no table of documents has.
_BODY, _SCORE = "\u2020body", "\u2020score"
COUNTS = "entry string, clean long, toxic long"
# Words that announce somebody else's words, and quotation marks.
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes term word slur citation cite "
    "sagte schrieb wort zitat dit écrit mot citation dijo escribió palabra cita".split()
)
QUOTES = re.compile(
    r"[\"“”„«»](?:[^\"“”„«»\n]++)[\"“”„«»]|(?<!\w)'[^'\n]++'(?!\w)|^>.*$", re.M
)
WORD = re.compile(r"\w+(?:[@$*]+\w+)*")


def edits_allowed(entry: str) -> int:
    """Edits of an entry, swaps among them; a beginning needs a letter more than a word."""
    if entry.endswith("*"):
        return 0 if len(entry) < 6 else 1
    return 0 if len(entry) < 4 else 1 if len(entry) < 9 else 2


def _without_one(word: str) -> list[str]:
    """The word without each of its letters in turn."""
    return [word[:i] + word[i + 1 :] for i in range(len(word))]


@dataclass
class Lexicon:
    """Entries ending in ``*`` are word beginnings, others words; each with its counts."""

    entries: dict[str, tuple[int, int]]
    clean_rows: int
    toxic_rows: int
    exceptions: frozenset[str] = frozenset()
    children: list[dict[str, int]] = field(default_factory=list)
    words: dict[int, str] = field(default_factory=dict)
    begins: dict[int, str] = field(default_factory=dict)
    allowed: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.children, self.allowed = [{}], [0]
        # clear terms only: what clean rows begin with as well has no misspellings of its own
        self.edits = {
            entry: edits_allowed(entry) if toxic >= CLEAR * (clean + 0.5) else 0
            for entry, (clean, toxic) in self.entries.items()
        }
        for entry, edits in self.edits.items():
            if not edits:  # found as it is, or as a beginning, without an automaton
                continue
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for letter in entry.removesuffix("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], edits)
            (self.begins if entry.endswith("*") else self.words)[node] = entry
        self.letters = set().union(*self.children)
        self._list_remains()
        self._steps: dict[tuple[frozenset, str], frozenset] = {}
        self._ends: dict[frozenset, tuple[list, list]] = {}
        self._kept = 0
        self._start = self._closed({(0, 0, "")})

    def _list_remains(self) -> None:
        """What must be left of an entry in any word that is near it.

        A word one edit away has a remainder without one letter in common with the entry. Of
        an entry cut into one part more than it has edits, with a letter between parts so
        that a swap breaks one only, some part stands whole in the word, shifted by its edits at most.
        """
        self.once: set[str] = set()
        self.longest = 0
        self.parts: dict[tuple[bool, int, int], set[tuple[int, str]]] = {}
        for entry, edits in self.edits.items():
            word, begins = entry.removesuffix("*"), entry.endswith("*")
            if not edits:
                continue
            if edits < 2 and not begins:
                self.once.update(_without_one(word), [word])
                self.longest = max(self.longest, len(word) + edits)
                continue
            size, more = divmod(len(word) - edits, edits + 1)
            at = 0
            for part in range(edits + 1):
                end = at + size + (part < more)
                self.parts.setdefault((begins, len(word), edits), set()).add((at, word[at:end]))
                at = end + 1
        self.furthest = max((size + edits for _, size, edits in self.parts), default=0) + 1
        self._probes: dict[int, list[tuple[int, int, set[str]]]] = {}

    def _probes_of(self, length: int) -> list[tuple[int, int, set[str]]]:
        """Places of a word of some length, and the parts that may stand there."""
        found: dict[tuple[int, int], set[str]] = {}
        for (begins, size, edits), parts in self.parts.items():
            if length < size - edits or (length > size + edits and not begins):
                continue
            for at, part in parts:
                for start in range(max(at - edits, 0), at + edits + 1) if at else (0,):
                    found.setdefault((start, start + len(part)), set()).add(part)
        return [(start, end, parts) for (start, end), parts in found.items()]

    def may_be_near(self, word: str) -> bool:
        """False only for words that no automaton accepts."""
        if len(word) <= self.longest:
            if word in self.once or not self.once.isdisjoint(_without_one(word)):
                return True
        length = min(len(word), self.furthest)  # beyond it only beginnings matter
        probes = self._probes.get(length)
        if probes is None:
            probes = self._probes[length] = self._probes_of(length)
        return any(word[start:end] in parts for start, end, parts in probes)

    def _closed(self, states: set[tuple[int, int, str]]) -> frozenset:
        """With the states that skip letters of the lexicon's word."""
        todo = [s for s in states if not s[2]]
        while todo:
            node, edits, _ = todo.pop()
            for child in self.children[node].values():
                after = (child, edits + 1, "")
                if edits < self.allowed[child] and after not in states:
                    states.add(after)
                    todo.append(after)
        return frozenset(states)

    def _step(self, states: frozenset, letter: str) -> frozenset:
        after: set[tuple[int, int, str]] = set()
        for node, edits, early in states:
            if early:  # the letter read before stands behind this one in the word
                child = self.children[node].get(letter)
                end = self.children[child].get(early) if child is not None else None
                if end is not None and edits <= self.allowed[end]:
                    after.add((end, edits, ""))
                continue
            for other, child in self.children[node].items():
                if other == letter:
                    after.add((child, edits, ""))
                elif edits < self.allowed[child]:
                    after.add((child, edits + 1, ""))
                    if letter in self.children[child]:
                        after.add((node, edits + 1, letter))
            if edits < self.allowed[node]:
                after.add((node, edits + 1, ""))
        return self._closed(after)

    def _after(self, states: frozenset, letter: str) -> frozenset:
        key = (states, letter if letter in self.letters else "")
        after = self._steps.get(key)
        if after is None:
            if self._kept > REMEMBERED:
                self._steps.clear()
                self._ends.clear()
                self._kept = 0
            after = self._steps[key] = self._step(*key)
            self._kept += 1 + len(after)
        return after

    def near(self, word: str) -> tuple[str, int] | None:
        """The entry within its allowed edits of the word, or of how it begins, and how many."""
        if not self.may_be_near(word):
            return None
        states = self._start
        found: list[tuple[int, str]] = []
        for letter in word:
            states = self._after(states, letter)
            if not states:
                break
            found += self._reached(states)[0]
        found += self._reached(states)[1]
        return min(found)[::-1] if found else None

    def _reached(self, states: frozenset) -> tuple[list, list]:
        """Beginnings and words whose ends are among the states, with their edits."""
        known = self._ends.get(states)
        if known is None:
            known = self._ends[states] = tuple(
                [
                    (edits, ends[node])
                    for node, edits, early in states
                    if not early and node in ends and edits <= self.edits[ends[node]]
                ]
                for ends in (self.begins, self.words)
            )
        return known

    def match(self, word: str) -> tuple[str, float] | None:
        """The entry a word stands for, and how much of its weight: exact, begun or misspelled."""
        if word in self.entries:
            return word, 1.0
        for n in range(SHORTEST, min(len(word), LONGEST) + 1):
            if word[:n] + "*" in self.entries:
                return word[:n] + "*", 1.0
        if word in self.exceptions or len(word) < 4:
            return None
        found = self.near(word)
        return (found[0], MISSPELLED ** found[1]) if found else None

    def weight(self, entry: str, label: int | None = None) -> float:
        """Log odds of an entry; with a label, as if its row had not been counted."""
        clean, toxic = self.entries[entry]
        toxic, clean = toxic - (label == 1), clean - (label == 0)
        if toxic < LEAST_ROWS:
            return 0.0
        rate = (toxic + 0.5) / (self.toxic_rows + 1), (clean + 0.5) / (self.clean_rows + 1)
        return max(0.0, float(np.log(rate[0] / rate[1])))


class Reader:
    """Turns texts into numbers about their hits."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.seen: set[str] = set()
        self.hits: dict[str, tuple[str, float]] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
            self.hits.clear()
        fresh = words - self.seen
        self.seen |= fresh
        for word in fresh:
            found = self.lexicon.match(word)
            if found:
                self.hits[word] = found

    def features(self, text: str, label: int | None = None) -> list[float]:
        lower = text.lower()
        words = WORD.findall(lower)
        distinct = set(words)
        self._learn(distinct)
        if not any(w in self.hits for w in distinct):
            return [0.0] * 6
        if len(lower) != len(text):  # lower case moved the places: quotes are sought there too
            text = lower
        quotes = [m.span() for m in QUOTES.finditer(text)]
        found = []
        for at, place in enumerate(WORD.finditer(lower)):
            hit = self.hits.get(place[0])
            if hit:
                weight = hit[1] * self.lexicon.weight(hit[0], label)
                found.append((at, place.start(), place[0], weight))
        total = best = quoted = 0.0
        kinds: dict[str, float] = {}
        for k, (at, place, word, weight) in enumerate(found):
            around = found[max(0, k - 4) : k + 5]
            near = sum(abs(other[0] - at) <= WINDOW for other in around)
            said = REPORTING.intersection(words[max(0, at - WINDOW) : at])
            if said or any(a <= place < b for a, b in quotes):
                quoted += weight
                weight *= QUOTED
            else:
                weight *= 1 + COMPANY * min(near - 1, 4)
            total += weight
            best = max(best, weight)
            kinds[word] = max(weight, kinds.get(word, 0.0))
        several = sum(kinds.values())
        return [
            float(np.log1p(total)),
            best,
            float(np.log1p(several)),
            total / float(np.sqrt(len(words))),
            float(np.log1p(quoted)),
            float(np.log1p(len(kinds))),
        ]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[1:] + self.weights[0], -30, 30)))


def _beginnings(text: str) -> set[str]:
    found = set()
    for word in set(WORD.findall(text.lower())):
        if len(word) >= SHORTEST:
            found.add(word)
            found.update(word[:n] + "*" for n in range(SHORTEST, min(len(word), LONGEST) + 1))
    return found


def _count(batches: Batches) -> Batches:
    """Rows of each class that hold a word or beginning, summed in the task part by part."""
    clean, toxic = Counter(), Counter()
    for batch in by_bytes(batches, "text", BATCH_BYTES):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            (toxic if label else clean).update(_beginnings(text))
            if len(clean) + len(toxic) > SPILLED:
                yield _counts(clean, toxic)
                clean.clear()
                toxic.clear()
    yield _counts(clean, toxic)


def _counts(clean: Counter, toxic: Counter) -> pa.RecordBatch:
    names = list(clean.keys() | toxic.keys())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.string()),
            pa.array([clean[w] for w in names], pa.int64()),
            pa.array([toxic[w] for w in names], pa.int64()),
        ],
        ["entry", "clean", "toxic"],
    )


def _misspelled(lexicon: Lexicon):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.filter(
                pa.array([bool(lexicon.near(w)) for w in batch.column("entry").to_pylist()], pa.bool_())
            )

    return run


def _features(lexicon: Lexicon):
    names = [f"f{i}" for i in range(6)]

    def run(batches: Batches) -> Batches:
        reader = Reader(lexicon)
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            labels = batch.column("toxic")
            rows = [
                reader.features(t, y)
                for t, y in zip(batch.column("text").to_pylist(), labels.to_pylist())
            ]
            columns = np.array(rows, float).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays([labels, *map(pa.array, columns)], ["toxic", *names])

    return run, "toxic int, " + ", ".join(f"{n} double" for n in names)


def _fit(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1.0):
    """Logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(features)), features])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (labels - p)) - penalty * beta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents of each class, held-out ones never."""
    usable = labels.filter(~held_out() & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = usable.filter("toxic = 1").orderBy(*order).limit(rows)
    chosen = chosen.unionByName(usable.filter("toxic = 0").orderBy(*order).limit(rows))
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model | None:
    """Fit the lexicon and the model; None without rows of both classes."""
    train = written(training_rows(docs, labels, rows), "toxic-train")
    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return None
    counts = written(
        map_batches(train, _count, COUNTS)
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "toxic-counts",
    )
    odds = F.log(((F.col("toxic") + 0.5) / (n1 + 1)) / ((F.col("clean") + 0.5) / (n0 + 1)))
    deviation = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = (
        counts.withColumn("odds", odds)
        .filter((F.col("toxic") >= LEAST_ROWS) & (F.col("odds") >= LEAST_LOG_ODDS))
        .filter(F.col("odds") >= LEAST_DEVIATIONS * deviation)
        .orderBy(F.desc(F.col("toxic") * F.col("odds")), F.length("entry"), "entry")
        .limit(LEXICON_SIZE)
        .collect()
    )
    lexicon = Lexicon(_fewest(found), n0, n1)
    near = map_batches(
        counts.filter("clean > 0 AND entry NOT LIKE '%*'"), _misspelled(lexicon), COUNTS
    )
    # words of at most ``rows`` clean texts: bounded like the training rows
    lexicon.exceptions = frozenset(r["entry"] for r in near.select("entry").collect())
    run, schema = _features(lexicon)
    data = np.array(map_batches(train, run, schema).collect(), float)
    # The classes were chosen apart: give each the weight it has among all labels.
    share = labels.filter(~held_out()).groupBy("toxic").agg(F.count("*").alias("n")).collect()
    every = {r["toxic"]: r["n"] for r in share}
    y, x = data[:, 0], data[:, 1:]
    weights = np.where(y == 1, every[1] / n1, every[0] / n0)
    weights *= len(y) / weights.sum()
    mean, scale = x.mean(0), x.std(0) + 1e-9
    forget(train)
    forget(counts)
    return Model(lexicon, _fit((x - mean) / scale, y, weights), mean, scale)


def _fewest(found: list) -> dict[str, tuple[int, int]]:
    """The most specific beginnings: none that one longer entry covers nearly as well, and none
    that a shorter one covers about as well. Whole words all stay, for their own edits."""
    rows = {r["entry"]: r for r in found}

    def beginnings(entry: str) -> list[str]:
        word = entry.removesuffix("*")
        return [word[:n] + "*" for n in range(SHORTEST, len(word) + (entry == word))]

    longer = Counter()
    for row in found:
        for begin in beginnings(row["entry"]):
            longer[begin] = max(longer[begin], row["toxic"])
    kept = {}
    for row in sorted(found, key=lambda r: (len(r["entry"]), r["entry"])):
        entry = row["entry"]
        if not entry.endswith("*"):
            kept[entry] = (row["clean"], row["toxic"])
        elif longer[entry] < 0.95 * row["toxic"] and all(
            rows[s]["odds"] + 0.7 < row["odds"] for s in beginnings(entry) if s in kept
        ):
            kept[entry] = (row["clean"], row["toxic"])
    return kept


def _scored(model: Model | None):
    def run(batches: Batches) -> Batches:
        reader = Reader(model.lexicon) if model else None
        for batch in by_bytes(batches, _BODY, BATCH_BYTES):
            if model:
                rows = [reader.features(t) for t in batch.column(_BODY).to_pylist()]
                score = model.scores(np.array(rows, float).reshape(-1, 6))
            else:
                score = np.zeros(batch.num_rows)
            names = [n for n in batch.schema.names if n != _BODY]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(score)], [*names, _SCORE]
            )

    return run


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with the score in a column of its own; all columns pass through as they are."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    schema = ", ".join([*fields, f"`{_SCORE}` double"])
    return map_batches(docs.withColumn(_BODY, whole_text(text)), _scored(model), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = learn(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col(_SCORE).alias("score"),
        (F.col(_SCORE) >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted as toxic."""
    model = learn(docs, labels)
    return score(docs, model).filter(F.col(_SCORE) < 0.5).drop(_SCORE)
