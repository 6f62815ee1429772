"""Extractive summaries: the sentences with the heaviest terms, in their own order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rostra.functions.scores import int_truncate, rank_key
from rostra.functions.text import Preprocess, sentence_split, strip_quotes, term_counts, word_count
from rostra.runtime import join_vocabulary, materialize
from rostra.schemas import SPEECH

BUDGET_DIVISOR = 1.5


def _parts(text: str) -> Column:
    return F.transform(sentence_split(F.col(text)), lambda part: F.trim(part))


def sentences(corpus: DataFrame, text: str = SPEECH) -> DataFrame:
    """``(doc_id, max_words, pos, sentence)`` of all sentences that have a word."""
    budget = int_truncate(word_count(F.col(text)) / BUDGET_DIVISOR)
    # In two steps: next to the generator the budget would be counted again per sentence.
    whole = corpus.where(F.col(text).isNotNull()).select(
        "doc_id", budget.alias("max_words"), _parts(text).alias("parts")
    )
    split = whole.select("doc_id", "max_words", F.posexplode_outer("parts").alias("pos", "sentence"))
    return split.where(F.length("sentence") > 0)


def score_sentences(rows: DataFrame, pre: Preprocess, vocab: DataFrame) -> DataFrame:
    """``(doc_id, pos, score)``: mean idf of the terms of each sentence, repeats counted.

    Terms are counted within the row and stored, because the join reads them twice.
    """
    counts = term_counts(pre.terms(F.col("sentence")))
    found = rows.select("doc_id", "pos", F.inline_outer(counts)).dropna(subset=["term"])
    terms = materialize(found, "sentence-terms")
    weighted = join_vocabulary(terms, vocab.select("term", "df", "idf"))
    return weighted.groupBy("doc_id", "pos").agg(
        (F.sum(F.col("tf") * F.col("idf")) / F.sum("tf")).alias("score")
    )


def summarize(
    corpus: DataFrame, pre: Preprocess, vocab: DataFrame, text: str = SPEECH
) -> DataFrame:
    """``(doc_id, summary)``: best sentences while their words fit words / 1.5 of the text.

    A text without a sentence has an empty summary; a null text has no row.

    Sentences are taken by score until the running word count passes the budget, and joined
    in text order. The best sentence is always taken, so every text with a sentence has a
    summary. Choosing moves numbers only, in windows per document; the texts meet the chosen
    positions at the end.
    """
    rows = sentences(corpus, text)
    scores = score_sentences(rows, pre, vocab)
    sizes = rows.select("doc_id", "pos", "max_words", word_count(F.col("sentence")).alias("words"))
    scored = sizes.join(scores, ["doc_id", "pos"], "left").fillna({"score": 0.0})
    order = Window.partitionBy("doc_id").orderBy(F.desc(rank_key(F.col("score"))), "pos")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = (
        scored.withColumn("used", F.sum("words").over(running))
        .withColumn("rank", F.row_number().over(order))
        .where((F.col("used") <= F.col("max_words")) | (F.col("rank") == 1))
    )
    chosen = taken.groupBy("doc_id").agg(F.collect_list("pos").alias("chosen"))
    whole = corpus.where(F.col(text).isNotNull()).select("doc_id", _parts(text).alias("parts"))
    picked = whole.join(chosen, "doc_id", "left")
    # The chosen positions in order, each looked up once.
    places = F.sort_array(F.coalesce("chosen", F.array().cast("array<int>")))
    kept = F.transform(places, lambda at: F.get("parts", at))
    return picked.select("doc_id", strip_quotes(F.array_join(kept, ". ")).alias("summary"))


def summarize_with(
    corpus: DataFrame, model: Callable[[list[str]], list[str]], text: str = SPEECH
) -> DataFrame:
    """``(doc_id, summary)`` from a caller's own model, applied batch by batch in the tasks."""

    def apply(batches):
        for batch in batches:
            yield batch[["doc_id"]].assign(summary=model(batch["text"].tolist()))

    rows = corpus.where(F.col(text).isNotNull()).select("doc_id", F.col(text).alias("text"))
    return rows.mapInPandas(apply, "doc_id long, summary string")
