"""Sinks and keyed reads of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERM_BUCKETS = 32  # the least number of term buckets
_MOST_BUCKETS = 4096
DOC_BUCKETS = 64  # folders of a document store, unless it is written with another number
LISTED_IDS = 1_000  # ids that a filter names one by one
_POSTINGS_PER_BUCKET = 5_000_000
_DOCS_PER_BUCKET = 250_000
_DOCS_PER_CLASS = 1_000_000
_CLASSES_PER_OCTAVE = 8
_DOCS_PER_SLICE = 50_000_000
_POSTINGS_PER_TASK = 4_000_000  # sorted in one task


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_keyed(df: DataFrame, path: str, key: str, *then: str) -> None:
    """A table ordered by key, so that a lookup reads the row groups of that key only.

    ``then`` columns take part in the range split: a key with very many rows spreads over
    several files. The bloom filter answers for keys inside a row group's min-max range.
    """
    (
        df.repartitionByRange(key, *then)
        .sortWithinPartitions(key, *then)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .parquet(path)
    )


def write_keywords(keywords: DataFrame, path: str) -> None:
    """Keyword lists, one folder per grouping, ordered by entity."""
    (
        keywords.repartitionByRange("grouping", "entity", "year")
        .sortWithinPartitions("grouping", "entity", "year", "rank")
        .write.mode("overwrite")
        .partitionBy("grouping")
        .parquet(path)
    )


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Similar pairs, ordered by their first entity."""
    write_keyed(pairs, path, "entity_a", "entity_b")


def write_clusters(clustered: DataFrame, path: str) -> None:
    """Labelled vectors, ordered by cluster: a cluster of any size spreads over several files."""
    write_keyed(clustered, path, "cluster", "doc_id")


def term_bucket(term: Column, buckets: int = TERM_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def bucket_count(n_postings: int) -> int:
    """Term buckets of about equal, moderate size."""
    return min(max(TERM_BUCKETS, n_postings // _POSTINGS_PER_BUCKET), _MOST_BUCKETS)


def slice_count(n_docs: int) -> int:
    """Document slices that keep even a term of all documents in moderate tasks."""
    return max(2, -(-n_docs // _DOCS_PER_SLICE))


def write_term_postings(postings: DataFrame, path: str, buckets: int, slices: int) -> None:
    """Postings by term bucket, so that a query reads the folders of its own terms.

    ``slices`` splits every bucket by document: a term in a third of the documents does not
    end up in one task.
    """
    doc_slice = F.pmod(F.xxhash64("doc_id"), F.lit(slices))
    (
        postings.withColumn("term_bucket", term_bucket(F.col("term"), buckets))
        .repartition("term_bucket", doc_slice)
        .sortWithinPartitions("term_bucket", "term", "doc_id")
        .write.mode("overwrite")
        .partitionBy("term_bucket")
        .parquet(path)
    )


def slice_parts(n_docs: int) -> int:
    """Parts of a class of lengths, so that slices stay moderate."""
    return max(1, n_docs // _DOCS_PER_CLASS)


def doc_slice(norm: Column, doc_id: Column, parts: int) -> Column:
    """The slice of a document: documents of similar length, a class cut into ``parts``.

    Short documents score high and long ones low, so slices by length have tight bounds.
    """
    length_class = F.floor(_CLASSES_PER_OCTAVE * F.log2(F.greatest(norm, F.lit(1.0))))
    return (length_class * parts + F.pmod(F.xxhash64(doc_id), F.lit(parts))).cast("int")


def write_sliced_postings(postings: DataFrame, path: str, parts: int, n_postings: int = 0) -> None:
    """Postings by document slice, ordered by term: a search reads the slices it needs.

    The range split cuts a large slice into files of disjoint terms; ``n_postings`` asks for
    more tasks than the session's shuffles have where those would sort too much each.
    """
    placed = postings.withColumn("doc_slice", doc_slice(F.col("norm"), F.col("doc_id"), parts))
    tasks = -(-n_postings // _POSTINGS_PER_TASK)
    more = [tasks] if tasks > int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    (
        placed.repartitionByRange(*more, "doc_slice", "term", "doc_id")
        .sortWithinPartitions("doc_slice", "term", "doc_id")
        .write.mode("overwrite")
        .partitionBy("doc_slice")
        .parquet(path)
    )


def doc_bucket(doc_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


def document_bucket_count(n_docs: int) -> int:
    """Folders of about equal, moderate size."""
    return min(max(DOC_BUCKETS, n_docs // _DOCS_PER_BUCKET), _MOST_BUCKETS)


def write_documents(corpus: DataFrame, path: str, buckets: int = DOC_BUCKETS) -> None:
    """The texts by document bucket, ordered by document: a fetch reads few folders.

    The range split cuts a large bucket into several files of disjoint ids, so the least and
    greatest ids of row groups rule out most of a folder; the Bloom filter answers for ids
    in between.
    """
    (
        corpus.withColumn("doc_bucket", doc_bucket(F.col("doc_id"), buckets))
        .repartitionByRange("doc_bucket", "doc_id")
        .sortWithinPartitions("doc_bucket", "doc_id")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#doc_id", "true")
        .partitionBy("doc_bucket")
        .parquet(path)
    )


def in_buckets_of(corpus: DataFrame, wanted: DataFrame) -> DataFrame:
    """The part of a stored corpus that can hold the documents of ``wanted``.

    ``wanted`` has ``doc_bucket`` and ``doc_id``. The driver sees the distinct bucket
    numbers (never more than there are folders) and the least and greatest id; a list of ids
    goes along while it is short. As literals they reach the scan in every plan, whatever
    the join after it.
    """
    found = wanted.groupBy("doc_bucket").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    rows = found.collect()
    if not rows:
        return corpus.limit(0)
    part = corpus.where(F.col("doc_bucket").isin([r["doc_bucket"] for r in rows]))
    part = part.where(F.col("doc_id").between(min(r["lo"] for r in rows), max(r["hi"] for r in rows)))
    ids = [r["doc_id"] for r in wanted.select("doc_id").distinct().limit(LISTED_IDS + 1).collect()]
    return part.where(F.col("doc_id").isin(ids)) if len(ids) <= LISTED_IDS else part


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key; on a keyed table the filter reaches the Parquet reader."""
    return df.where(F.col(key) == F.lit(value))
