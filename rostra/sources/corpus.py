"""Reading a corpus: CSV scans, dense document ids, limits, column choice, null rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rostra.functions.text import Preprocess, let
from rostra.runtime import fits_broadcast, materialize
from rostra.schemas import LEADING_COLUMNS, SPEECH, corpus_schema

_WHITESPACE = " \t\r\n\f\v"
_FIELD_BREAK = "\u0001"


def corpus_scan(spark: SparkSession, path: str, n_columns: int = 11) -> DataFrame:
    """A CSV corpus with a header line, one record per line, quotes removed.

    The speech is the last field of its line, however many there are. The reader only drops
    the header line of every file: no separator occurs in a line, so a line is one value.
    """
    lines = (
        spark.read.schema("value string")
        .option("header", True)
        .option("sep", _FIELD_BREAK)
        .option("quote", "")
        .csv(path)
    )
    names = corpus_schema(n_columns).names
    fields = lines.select(split_outside_quotes(F.col("value")).alias("_fields"))
    leading = [F.get("_fields", F.lit(i)) for i in range(len(names) - 1)]
    columns = [*leading, F.element_at("_fields", -1)]
    return fields.select(*[_unquoted(c).alias(n) for c, n in zip(columns, names)])


def _unquoted(field: Column) -> Column:
    """A CSV field without its quotes; an empty one without quotes is null."""
    quoted = field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
    inner = F.substr(field, F.lit(2), F.length(field) - 2)
    inner = F.replace(inner, F.lit('""'), F.lit('"'))
    return F.when(quoted, inner).otherwise(F.nullif(field, F.lit("")))


def split_outside_quotes(line: Column) -> Column:
    """Fields of a CSV line with their quotes kept.

    A comma separates fields when an even number of quotes follows it. Splitting at the
    quotes first keeps this linear in the length of the line.
    """

    def mark(parts: Column) -> Column:
        return F.transform(
            parts,
            lambda part, i: F.when(
                (F.size(parts) - 1 - i) % 2 == 0, F.translate(part, ",", _FIELD_BREAK)
            ).otherwise(part),
        )

    parts = F.split(F.btrim(line, F.lit(_WHITESPACE)), '"')
    return F.split(F.array_join(let(parts, mark), '"'), _FIELD_BREAK)


def corpus_scan_quoted(spark: SparkSession, path: str, n_columns: int = 11) -> DataFrame:
    """Like ``corpus_scan`` with quotes kept; the speech is the last field of its line.

    Comes with ``doc_id``, because finding the header lines needs the line numbers.
    """
    lines = _number_lines(spark.read.text(path))
    body = lines.where("_line > 0").withColumn("_fields", split_outside_quotes(F.col("value")))
    names = corpus_schema(n_columns).names
    leading = [F.get("_fields", F.lit(i)).alias(name) for i, name in enumerate(names[:-1])]
    return body.select(
        (F.col("_position") - F.col("_file_no")).alias("doc_id"),
        *leading,
        F.element_at("_fields", -1).alias(names[-1]),
    )


def assign_doc_id(df: DataFrame) -> DataFrame:
    """Number the rows of a file scan from 0 in file order, densely.

    A first pass only counts the rows of every input split; the second adds to each row's
    place in its split the rows of the splits before it. Nothing but counts is stored, and no row is
    sorted or shuffled.
    """
    numbered = _number_lines(df).withColumnRenamed("_position", "doc_id")
    return numbered.select("doc_id", *df.columns)


def _in_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their place in their split, however a task's splits were put together."""
    split, seen = None, 0
    for batch in batches:
        place = np.zeros(batch.num_rows, np.int64)
        if batch.num_rows:
            files = batch.column("_file").dictionary_encode().indices.to_numpy()
            blocks = batch.column("_block").to_numpy()
            new = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
            for first, end in zip([0, *new], [*new, batch.num_rows]):
                own = (batch.column("_file")[int(first)].as_py(), int(blocks[first]))
                seen = seen if own == split else 0
                place[first:end] = np.arange(seen, seen + end - first)
                split, seen = own, seen + int(end - first)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(place)], names=[*batch.schema.names, "_in_split"]
        )


def _number_lines(df: DataFrame) -> DataFrame:
    """Add ``_position`` (over all files), ``_line`` (within the file) and ``_file_no`` (from 1).

    A split that the second pass cuts where the first did not has no offset and ends the
    job: numbers are right or missing, never wrong.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    # One row per input split, whatever the number of lines.
    splits = materialize(tagged.groupBy("_file", "_block").agg(F.count("*").alias("_n")), "splits")
    by_file = Window.partitionBy("_file").orderBy("_block")
    overall = Window.orderBy("_file", "_block")
    earlier = (Window.unboundedPreceding, -1)
    offsets = splits.select(
        "_file",
        "_block",
        F.coalesce(F.sum("_n").over(overall.rowsBetween(*earlier)), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_n").over(by_file.rowsBetween(*earlier)), F.lit(0)).alias("_in_file"),
        F.dense_rank().over(Window.orderBy("_file")).cast("long").alias("_file_no"),
    )
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tagged.schema.fields)
    rows = tagged.mapInArrow(_in_split, f"{kinds}, _in_split long")
    known = F.when(F.col("_before").isNull(), F.raise_error(F.lit("the input changed while it was numbered")))
    return (
        rows.join(offsets, ["_file", "_block"], "left")
        .withColumn("_position", known.otherwise(F.col("_before") + F.col("_in_split")).cast("long"))
        .withColumn("_line", F.col("_in_file") + F.col("_in_split"))
        .drop("_file", "_block", "_in_split", "_before", "_in_file")
    )


def row_limit(df: DataFrame, limit: int = -1) -> DataFrame:
    """The first ``limit - 1`` documents (the header counts as a row); -1 keeps all."""
    return df if limit == -1 else df.where(F.col("doc_id") < limit - 1)


def processed_scan(spark: SparkSession, path: str, sample_rows: int | None = None) -> DataFrame:
    """A stored processed corpus; ``sample_rows`` keeps the first documents only."""
    df = spark.read.parquet(path)
    return df if sample_rows is None else df.where(F.col("doc_id") < sample_rows)


def processed(df: DataFrame, pre: Preprocess, speech: str = SPEECH) -> DataFrame:
    """The corpus with its speech replaced by the cleaned text."""
    return df.withColumn(speech, pre.text(F.col(speech)))


def keep_first_n_columns(df: DataFrame, n: int = LEADING_COLUMNS, speech: str = SPEECH) -> DataFrame:
    """The document id, the first ``n`` columns of the source and the speech."""
    source = [name for name in df.columns if name != "doc_id"]
    leading = [name for name in source[:n] if name != speech]
    return df.select(*[c for c in df.columns if c == "doc_id"], *leading, speech)


def drop_null_speech(df: DataFrame, speech: str = SPEECH) -> DataFrame:
    return df.dropna(subset=[speech])


def fill_null_speech(df: DataFrame, speech: str = SPEECH) -> DataFrame:
    return df.fillna({speech: " "})


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))
