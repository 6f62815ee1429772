"""Text normalisation as column expressions.

Everything here is a native Spark expression, so cleaning runs inside the scan
stage, needs no shuffle and is identical for documents and for queries.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters, digits and underscores; a term has two or more of them.
WORD_PATTERN = r"[\p{L}\p{N}_]+"
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"
NON_WORD_PATTERN = r"[^\p{L}\p{N}_]+"
# A full stop ends a sentence unless a digit follows it.
SENTENCE_END_PATTERN = r"\.(?!\d)"
MIN_TERM_LENGTH = 2

# Default stop words: accent-free and lower case, because accents are removed first.
STOPWORDS = (
    # English
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of",
    "on", "or", "that", "the", "this", "to", "was", "were", "with",
    # French
    "au", "aux", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le",
    "les", "ou", "par", "pour", "que", "qui", "sur", "un", "une",
    # German
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "und",
    "von", "zu",
    # Spanish
    "como", "con", "del", "el", "las", "los", "para", "por", "se", "una", "y",
    # Greek
    "και", "να", "το", "τα", "τη", "την", "τησ", "τον", "του", "των", "τουσ", "στη", "στην",
    "στο", "στον", "στα", "για", "με", "απο", "που", "ο", "η", "οι", "τισ", "δεν", "θα",
)

# Default inflectional endings, removed when at least MIN_STEM letters stay.
SUFFIXES = (
    "ing", "edly", "ed", "ies", "es", "s",
    "ουσ", "οσ", "ων", "ασ", "εσ", "ησ", "εισ", "ου", "οι", "α", "η", "ο", "ι",
)
MIN_STEM = 3


@lru_cache(maxsize=1)
def accent_map() -> tuple[str, str]:
    """The (from, to) arguments of ``translate`` that remove accents.

    Built from the Unicode decompositions of Latin and Greek letters. The combining
    marks come last and have no counterpart, so ``translate`` deletes them.
    """
    source, target = [], []
    for first, last in ((0x00C0, 0x0250), (0x0370, 0x0400), (0x1E00, 0x2000)):
        for code in range(first, last):
            char = chr(code)
            parts = unicodedata.normalize("NFD", char)
            if char.isalpha() and len(parts) > 1:
                source.append(char)
                target.append(parts[0])
    marks = [chr(code) for code in range(0x0300, 0x0370)]
    return "".join(source + marks), "".join(target)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that refers to a computed column may compute it again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def case_fold(text: Column) -> Column:
    """Lower case, with the Greek final sigma written as the ordinary one."""
    return F.translate(F.lower(text), "ς", "σ")


def strip_accents(text: Column) -> Column:
    source, target = accent_map()
    return F.translate(text, source, target)


def strip_punctuation(text: Column) -> Column:
    """Every run of characters that are no word characters becomes one space."""
    return F.regexp_replace(text, NON_WORD_PATTERN, " ")


def tokenize(text: Column) -> Column:
    """The terms of a text, in order: runs of two or more word characters."""
    return F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0))


def remove_stopwords(words: Column, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    return F.filter(words, lambda word: ~word.isin(*stopwords)) if stopwords else words


def stem_pattern(suffixes: tuple[str, ...], min_stem: int) -> str:
    # The lazy prefix makes the longest ending win.
    return r"^(.{%d,}?)(?:%s)$" % (min_stem, "|".join(suffixes))


def stem(
    word: Column, suffixes: tuple[str, ...] = SUFFIXES, min_stem: int = MIN_STEM
) -> Column:
    return F.regexp_replace(word, stem_pattern(suffixes, min_stem), "$1")


@dataclass(frozen=True)
class Preprocess:
    """Parameters of the cleaning step; use one instance for documents and queries."""

    lowercase: bool = True
    accents: bool = True
    stopwords: tuple[str, ...] = STOPWORDS
    suffixes: tuple[str, ...] = SUFFIXES
    min_stem: int = MIN_STEM

    def words(self, text: Column) -> Column:
        """Cleaned words in text order, one-letter words included."""
        if self.lowercase:
            text = case_fold(text)
        if self.accents:
            text = strip_accents(text)
        words = remove_stopwords(
            F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)), self.stopwords
        )
        if self.suffixes:
            words = F.transform(words, lambda word: stem(word, self.suffixes, self.min_stem))
        return words

    def text(self, text: Column) -> Column:
        """Cleaned text: the words joined with one space."""
        return F.array_join(self.words(text), " ")

    def terms(self, text: Column) -> Column:
        """Same as ``tokenize(self.text(text))`` without building the text in between."""
        return F.filter(self.words(text), lambda word: F.length(word) >= MIN_TERM_LENGTH)


def term_counts(terms: Column) -> Column:
    """``array<string>`` to ``array<struct<term, tf>>``, ordered by term.

    Sorts the array and measures the runs of equal terms, so counting the terms of a
    document stays within its row: no shuffle on (document, term).
    """

    def run_starts(ordered: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )

    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, k: F.struct(
                F.get(ordered, start).alias("term"),
                (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - start)
                .cast("long")
                .alias("tf"),
            ),
        )

    def count(ordered: Column) -> Column:
        return let(run_starts(ordered), lambda starts: runs(ordered, starts))

    empty = F.expr("CAST(array() AS array<struct<term: string, tf: bigint>>)")
    return let(
        F.sort_array(terms),
        lambda ordered: F.when(F.size(ordered) > 0, count(ordered)).otherwise(empty),
    )


def sentence_split(text: Column) -> Column:
    """Sentences of a text after its quotation marks are removed."""
    return F.split(F.translate(text, "\"'", ""), SENTENCE_END_PATTERN)


def word_count(text: Column) -> Column:
    """Number of pieces between single spaces."""
    return F.size(F.split(text, " "))


def strip_quotes(text: Column) -> Column:
    return F.btrim(text, F.lit('"'))
