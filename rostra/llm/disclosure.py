"""Personal data: patterns, and words that reveal it by co-occurrence.

Base spans come from four patterns. Information-theoretic sanitisation then asks of every
word near them how much it tells about what stands beside it. Protected entities are the
values and the classes they belong to: the local part and the domain of an address, the
issuer's digits of a card, the prefix of a phone number, the network of an ip. Over the
whole corpus, with N documents, n(t) of them with word t, n(e) with entity e and n(t, e) with
t within ``WINDOW`` words of e, the word discloses log2(n(t, e) N / (n(t) n(e))) bits about
e. The entity itself holds log2(N / n(e)) bits, so frequent ones are protected like rare
ones. A word goes if it discloses ``LEAST_PART`` of those bits, if documents with it have the
entity beside it with a probability of ``LEAST_SHARE``, and if it does so in
``LEAST_CONTEXTS`` different contexts (verbatim copies of a text are one context). It is
removed where it reveals one value, and generalised to the kind of data where it reveals
several values or a class.

Pairs are counted per task before they are shuffled, and pairs exist only within windows
around values. Word lists go to the tasks in parts of ``PART_BYTES``, in several passes if
they are longer.

Defined cases: null and empty texts have no span; rows are treated one by one, so repeated
ids and null ids give a row each; without words to remove the spans are the base spans; very
long texts, digit runs and words are read whole, in time that grows with their length; an
empty table gives no row; only ``doc_id`` and ``text`` are read, so other columns may have
any name.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import Batches, by_bytes, forget, map_batches, small, whole_text, written

KINDS = ("email", "ip", "card", "phone")
CLASS_DIGITS = {"card": 6, "phone": 5}  # leading digits: the issuer, the area
WINDOW = 6
LEAST_PART = 0.8
LEAST_SHARE = 0.5
LEAST_CONTEXTS = 2
LEAST_LETTERS = 3
PART_BYTES = 16 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is read once: it is no start in its own middle, and gives nothing back.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\w+")

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from their @: the local part is the run of letters before it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            found.append(("email", begin, match.end()))
            free = match.end()
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """By start, then kind."""
    found = emails(text) if "@" in text else []
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match[0].split(".")):
                found.append(("ip", match.start(), match.end()))
        for match in _CARD.finditer(text):
            digits = match[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", match.start(), match.end()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
                    found.append(("phone", match.start(), match.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def value_of(text: str, span: Span) -> str:
    """The value a span stands for, however it is written."""
    kind, begin, end = span
    raw = text[begin:end]
    return f"{kind}:{raw.lower() if kind == 'email' else raw if kind == 'ip' else re.sub(r'[^0-9]', '', raw)}"


def entities_of(text: str, span: Span) -> list[str]:
    """The value of a span and the classes it belongs to, each as kind and value."""
    value = value_of(text, span)
    kind, _, raw = value.partition(":")
    if kind == "email":
        local, _, domain = raw.partition("@")
        return [value, f"email/local:{local}", f"email/domain:{domain}"]
    if kind == "ip":
        return [value, f"ip/network:{raw.rpartition('.')[0]}"]
    digits = CLASS_DIGITS[kind]
    return [value, f"{kind}/class:{raw[:digits]}"]


def _free_words(text: str, base: list[Span]) -> list[tuple[str, int, int]]:
    """Lower-case words outside of base spans, with their places."""
    found, k = [], 0
    upto = 0  # the furthest end of spans that begin before the word
    for match in _WORD.finditer(text):
        while k < len(base) and base[k][1] < match.end():
            upto = max(upto, base[k][2])
            k += 1
        if match.start() >= upto:
            found.append((match[0].lower(), match.start(), match.end()))
    return found


def _near(batches: Batches) -> Batches:
    """Documents per (value, word, context), per word near any value, and per value."""
    for batch in by_bytes(batches, "text"):
        counts: Counter = Counter()
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            if not base:
                continue
            words = _free_words(text, base)
            starts = [w[1] for w in words]
            values, any_value = {}, set()
            for span in base:
                at = bisect_left(starts, span[1])
                around = [w[0] for w in words[max(0, at - WINDOW) : at + WINDOW]]
                terms = {w for w in around if len(w) >= LEAST_LETTERS and not w.isdigit()}
                context = xxhash.xxh3_64_intdigest(" ".join(around)) >> 1
                for entity in entities_of(text, span):
                    values.setdefault(entity, {}).update(dict.fromkeys(terms, context))
                any_value |= terms
            for value, terms in values.items():
                counts[value, None, 0] += 1
                for term, context in terms.items():
                    counts[value, term, context] += 1
            for term in any_value:
                counts[None, term, 0] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.string()),
                pa.array([k[2] for k in keys], pa.int64()),
                pa.array([counts[k] for k in keys], pa.int64()),
            ],
            ["value", "term", "context", "n"],
        )


def _holders(terms: frozenset[str]):
    """Documents of the task with each of the words."""

    def run(batches: Batches) -> Batches:
        counts: Counter = Counter()
        for batch in by_bytes(batches, "text"):
            for text in batch.column("text").to_pylist():
                counts.update(terms.intersection(_WORD.findall(text.lower())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["term", "n_term"],
        )

    return run


def _parts(terms: DataFrame) -> list[DataFrame]:
    """A list of words in parts that are small enough for the tasks."""
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0]
    count = size // PART_BYTES + 1
    part = F.pmod(F.xxhash64("term"), F.lit(count))
    return [terms.filter(part == i) for i in range(count)] if size else []


def revealing_terms(
    docs: DataFrame,
    least_part: float = LEAST_PART,
    least_share: float = LEAST_SHARE,
    least_contexts: int = LEAST_CONTEXTS,
) -> DataFrame:
    """(term, action, bits): words over the thresholds and what becomes of them."""
    texts = docs.select(whole_text().alias("text"))
    near = written(
        map_batches(texts, _near, "value string, term string, context long, n long")
        .groupBy("value", "term", "context")
        .agg(F.sum("n").alias("n")),
        "disclosure-near",
    )
    values = near.filter("term IS NULL").select("value", F.col("n").alias("n_value"))
    anywhere = near.filter("value IS NULL").select("term", F.col("n").alias("n_any"))
    pairs = (
        near.filter("value IS NOT NULL AND term IS NOT NULL")
        .groupBy("value", "term")
        .agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts"))
        .filter(F.col("contexts") >= least_contexts)
    )
    # A word stands in at least the documents where it is near a value.
    pairs = pairs.join(anywhere, "term").filter(F.col("n_both") >= least_share * F.col("n_any"))
    pairs = written(pairs.join(values, "value"), "disclosure-pairs")
    total = texts.count()
    counts = docs.sparkSession.createDataFrame([], "term string, n_term long")
    for part in _parts(pairs.select("term").distinct()):
        listed = frozenset(r["term"] for r in part.collect())  # at most PART_BYTES
        if listed:
            counts = counts.unionByName(map_batches(texts, _holders(listed), "term string, n_term long"))
    counts = counts.groupBy("term").agg(F.sum("n_term").alias("n_term"))
    bits = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_term") * F.col("n_value")))
    own = F.log2(F.lit(float(total)) / F.col("n_value"))  # 0 for what stands in all documents
    is_class = F.split_part("value", F.lit(":"), F.lit(1)).contains("/")
    kind = F.regexp_extract(F.min("value"), "^[a-z]+", 0)
    one_value = F.countDistinct(F.when(~is_class, F.col("value"))) == 1
    found = (
        pairs.join(counts, "term")
        .withColumn("bits", bits)
        .filter((own > 0) & (F.col("bits") >= least_part * own - 1e-9))
        .filter(F.col("n_both") >= least_share * F.col("n_term"))
        .groupBy("term")
        .agg(
            F.when(one_value, F.lit("")).otherwise(F.concat(F.lit("["), kind, F.lit("]"))).alias("action"),
            F.max("bits").alias("bits"),
        )
    )
    found = written(found, "disclosure-terms")
    forget(near)
    forget(pairs)
    return found


def _clean(actions: dict[str, str] | None):
    """Spans and the text without them; with no actions each row brings its own."""

    def run(batches: Batches) -> Batches:
        for batch in by_bytes(batches, "_text"):
            out: dict[str, list] = {k: [] for k in (*KINDS, "term", "base", "spans", "text")}
            texts = batch.column("_text").to_pylist()
            own = batch.column("_actions").to_pylist() if actions is None else [actions] * len(texts)
            for text, known in zip(texts, own):
                if actions is None:
                    known = {r["term"]: r["action"] for r in known or ()}
                base = base_spans(text)
                terms = []
                if known and not known.keys().isdisjoint(_WORD.findall(text.lower())):
                    terms = [("term", a, b) for w, a, b in _free_words(text, base) if w in known]
                spans = sorted([*base, *terms], key=lambda s: (s[1], (*KINDS, "term").index(s[0])))
                kinds = Counter(s[0] for s in spans)
                for kind in (*KINDS, "term"):
                    out[kind].append(kinds[kind])
                listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
                out["base"].append(hashlib.sha256(listed.encode()).hexdigest())
                out["spans"].append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
                pieces, upto = [], 0
                for kind, a, b in spans:
                    if a >= upto:
                        pieces += [text[upto:a], known[text[a:b].lower()] if kind == "term" else f"[{kind}]"]
                    upto = max(upto, b)
                out["text"].append("".join([*pieces, text[upto:]]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(out[k], pa.int64()) for k in (*KINDS, "term")),
                    *(pa.array(out[k], pa.string()) for k in ("base", "spans", "text")),
                ],
                ["doc_id", *(f"n_{k}" for k in (*KINDS, "term")), "base_sha256", "spans", "text"],
            )

    return run


def _terms_in(terms: frozenset[str]):
    """(row, term) for the listed words of a text."""

    def run(batches: Batches) -> Batches:
        for batch in by_bytes(batches, "_text"):
            rows, found = [], []
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("_text").to_pylist()):
                own = terms.intersection(_WORD.findall(text.lower()))
                rows += [row] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.string()), pa.array(found, pa.string())], ["_row", "term"]
            )

    return run


def sanitise(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """One row per row: doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans, text.

    ``terms`` are those of ``revealing_terms``, by default of ``docs``. In ``text`` base
    spans are replaced by their kind, words by what their action says.
    """
    terms = revealing_terms(docs) if terms is None else terms
    rows = docs.select("doc_id", whole_text().alias("_text"))
    parts = _parts(terms)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in (*KINDS, "term"))
    schema = f"doc_id {kind}, {counts}, base_sha256 string, spans string, text string"
    if len(parts) <= 1:
        actions = {r["term"]: r["action"] for p in parts for r in p.collect()}
        return map_batches(rows, _clean(actions), schema)
    # More words than a task should hold: each text gets its own, found part by part.
    rows = rows.withColumn("_row", F.sha2("_text", 256))
    hits = docs.sparkSession.createDataFrame([], "_row string, term string")
    for part in parts:
        listed = frozenset(r["term"] for r in part.collect())
        hits = hits.unionByName(map_batches(rows.select("_row", "_text"), _terms_in(listed), "_row string, term string"))
    own = hits.distinct().join(small(terms.select("term", "action")), "term").groupBy("_row").agg(
        F.collect_list(F.struct("term", "action")).alias("_actions")
    )
    return map_batches(rows.join(own, "_row", "left").drop("_row"), _clean(None), schema)
