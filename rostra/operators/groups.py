"""Term counts, vectors and keywords per member, party and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rostra.functions.scores import parse_year
from rostra.functions.text import Preprocess
from rostra.operators.index import postings
from rostra.runtime import SPLIT_BYTES, fits_broadcast, materialize
from rostra.schemas import DATE, KEYWORDS_PER_GROUP, MEMBER, PARTY, SPEECH

KEY = ["grouping", "entity", "year"]
# Rows of the finest grain that a task multiplies by the groupings and sums.
_ROWS_PER_TASK = 400_000
# grouping name -> the columns that form its key
GROUPINGS = {
    "member": [MEMBER],
    "party": [PARTY],
    "member_year": [MEMBER, "year"],
    "party_year": [PARTY, "year"],
    "year": ["year"],
}


def with_year(corpus: DataFrame) -> DataFrame:
    return corpus.withColumn("year", parse_year(F.col(DATE)))


def group_base(corpus: DataFrame, pre: Preprocess) -> DataFrame:
    """Term counts at the finest grain, from which every grouping is summed.

    Counting first per document, then per (member, party, year, term), shrinks the rows
    before they are multiplied by the five groupings.
    """
    rows = with_year(corpus.where(F.col(SPEECH).isNotNull()))
    counts = postings(rows, pre, keep=(MEMBER, PARTY, "year"))
    return counts.groupBy(MEMBER, PARTY, "year", "term").agg(F.sum("tf").alias("tf"))


def _key_columns(name: str) -> list[Column]:
    keys = GROUPINGS[name]
    return [
        F.lit(name).alias("grouping"),
        F.col(keys[0]).cast("string").alias("entity"),
        (F.col("year") if "year" in keys else F.lit(None).cast("int")).alias("year"),
    ]


def group_term_counts(base: DataFrame, name: str) -> DataFrame:
    """``(grouping, entity, year, term, tf)`` of one grouping; null keys form no group."""
    keyed = base.dropna(subset=GROUPINGS[name]).select(*_key_columns(name), "term", "tf")
    return keyed.groupBy(*KEY, "term").agg(F.sum("tf").alias("tf"))


def all_groupings(base: DataFrame) -> DataFrame:
    """All five groupings in one pass over ``base``.

    The rows of a term come together before they are multiplied by the groupings, so the
    counts are summed where they are made; null keys form no group. ``base`` is a stored
    table: its rows are counted for the number of tasks.
    """
    named = []
    for name, keys in GROUPINGS.items():
        given = F.lit(True)
        for key in keys:
            given = given & F.col(key).isNotNull()
        named.append(F.when(given, F.struct(*_key_columns(name))))
    keys = F.filter(F.array(*named), lambda key: key.isNotNull())
    least = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-base.count() // _ROWS_PER_TASK))
    rows = base.repartition(parts, "term").select("term", "tf", F.inline(keys))
    return rows.groupBy(*KEY, "term").agg(F.sum("tf").alias("tf")).select(*KEY, "term", "tf")


def group_keys(corpus: DataFrame) -> DataFrame:
    """The groups of a corpus, those without any term included."""
    rows = with_year(corpus.where(F.col(SPEECH).isNotNull())).select(MEMBER, PARTY, "year")
    rows = rows.distinct()
    parts = [
        rows.dropna(subset=GROUPINGS[name]).select(*_key_columns(name)) for name in GROUPINGS
    ]
    keys = parts[0]
    for part in parts[1:]:
        keys = keys.unionByName(part)
    return keys.distinct()


def _same_key(left: str, right: str) -> Column:
    same = F.lit(True)
    for key in KEY:
        same = same & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return same


def _weighted(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    # A term has at most a row per group: as many as members and years, not as documents.
    # Counts that stand by term stay where they are, unsorted; a task hashes its part of the terms.
    joined = counts.join(vocab.select("term", "idf").hint("shuffle_hash"), "term")
    return joined.withColumn("raw", F.col("tf") * F.col("idf"))


def _norms(weighted: DataFrame) -> DataFrame:
    return weighted.groupBy(*KEY).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))


def group_vectors(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(grouping, entity, year, term, weight)``, L2-normalised per group."""
    weighted = materialize(_weighted(counts, vocab).drop("tf", "idf"), "weighted", SPLIT_BYTES)
    norms = materialize(_norms(weighted), "group-norms", SPLIT_BYTES)
    if fits_broadcast(norms):  # a large group then stays in its own tasks
        norms = F.broadcast(norms)
    joined = weighted.alias("w").join(norms.alias("n"), _same_key("w", "n"))
    return joined.select(
        *[F.col(f"w.{k}") for k in KEY], "w.term", (F.col("raw") / F.col("norm")).alias("weight")
    )


def top_keywords(
    counts: DataFrame,
    vocab: DataFrame,
    k: int = KEYWORDS_PER_GROUP,
    pad: bool = False,
    groups: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` heaviest terms per group, ties in term order.

    The ranking uses ``tf * idf``: the norm is one number per group and joins the few rows
    that are left. ``pad`` fills short groups with weight-0 terms in vocabulary order; it
    needs ``groups``, the keys of all groups.
    """
    # Stored, because the ranking and the norms both read it.
    weighted = materialize(_weighted(counts, vocab).drop("tf", "idf"), "weighted", SPLIT_BYTES)
    rows = weighted.select(*KEY, "term", "raw")
    if pad:
        rows = rows.unionByName(_padding(rows, vocab, groups, k))
    order = Window.partitionBy(*KEY).orderBy(F.desc("raw"), "term")
    top = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # A task sorts its whole split to find its own best.
    top = materialize(top, "top", SPLIT_BYTES)
    norms = materialize(_norms(weighted), "group-norms", SPLIT_BYTES)
    joined = top.alias("t").join(norms.alias("n"), _same_key("t", "n"), "left")
    weight = F.when(F.col("raw") == 0, F.lit(0.0)).otherwise(F.col("raw") / F.col("norm"))
    return joined.select(
        *[F.col(f"t.{key}") for key in KEY], "rank", "t.term", weight.alias("weight")
    )


def _padding(rows: DataFrame, vocab: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """Weight-0 candidates: the first ``k`` terms of the vocabulary that a group lacks."""
    first = vocab.select("term").orderBy("term").limit(k)
    terms = first.agg(F.sort_array(F.collect_list("term")).alias("terms")).scalar()
    candidates = groups.withColumn("term", F.explode(terms)).withColumn("raw", F.lit(0.0))
    # Only the own rows of those k terms can clash.
    own = rows.join(F.broadcast(first), "term", "left_semi")
    same = _same_key("c", "o") & (F.col("c.term") == F.col("o.term"))
    return candidates.alias("c").join(own.alias("o"), same, "left_anti")


def keywords(corpus: DataFrame, pre: Preprocess, vocab: DataFrame, **options) -> DataFrame:
    """Keywords of every grouping."""
    groups = group_keys(corpus) if options.get("pad") else None
    base = materialize(group_base(corpus, pre), "group-base", SPLIT_BYTES)
    return top_keywords(all_groupings(base), vocab, groups=groups, **options)
