"""Exact dedup by distributed MSD radix partitioning.

Texts are split by their leading bytes, each group again by the bytes that follow, until a
group has one member or its texts have ended. A digit is a run of bytes whose width grows
from round to round, so a text of n bytes takes about log n rounds. Two texts are equal
because all their digits are; no digest decides it.

A round shuffles one digit per text of the groups still open, counted on the map side; a
group of copies of any size is therefore one row per task. The rows of a group meet its
name by a join whose other side has one row per group (AQE can split a hot group there).

Defined cases: null texts count as empty; empty texts are equal to each other; very long
texts take more rounds of wider digits. A null id is never the smallest: where a group has
no id at all, its rows cannot be told apart and all count as kept in the list, while
``drop_exact_copies`` lets one of them stay. Rows that repeat an id with an equal text are
listed each, and one stays. An id with several texts is one document each. An empty table
gives no row; other columns may have any name and pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import forget, temporary, whole_text, written

FIRST_DIGIT = 64
GROWTH = 8
LARGEST_DIGIT = 1 << 20
PREFILTER_BYTES = 32 << 20
# Columns that no table of documents has.
_ID, _SHA, _MARK = "\u2020id", "\u2020sha", "\u2020mark"
MEMBER = ["id", "sha", "keep_id", "group_size"]


def normalise(text: Column) -> Column:
    """Each run of blanks and line ends becomes one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = normalise(whole_text(text))
    return docs.select(
        F.col(doc_id).alias("id"), F.sha2(body, 256).alias("sha"), body.cast("binary").alias("rest")
    )


def _open(active: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows that can belong to a group of several, by a hash of their digit.

    Sixteen bytes a group go to the tasks while they fit; the exact join follows either way,
    and beyond that size it takes all rows.
    """
    mark = F.xxhash64("gid", "digit")
    if groups.count() * 16 > PREFILTER_BYTES:
        return active
    marks = groups.select(mark.alias("_mark")).distinct()
    marked = active.withColumn("_mark", mark)
    return marked.join(F.broadcast(marks), "_mark", "left_semi").drop("_mark")


def duplicate_members(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", first_digit: int = FIRST_DIGIT
) -> DataFrame:
    """(id, sha, keep_id, group_size) of every row whose text another row has too.

    ``sha`` only says which row is meant where ids repeat. Rows that are alone in their group
    leave before any join carries their text; the text that is left to compare is stored once
    a round, and the round before is deleted.
    """
    active = _keyed(docs, doc_id, text).withColumn("gid", F.lit(0).cast("long"))
    width, ended, before = first_digit, [], None
    while True:
        digits = active.withColumn("digit", F.substring("rest", 1, width))
        groups = written(
            digits.groupBy("gid", "digit")
            .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
            .filter("group_size > 1")
            .withColumn("next", F.monotonically_increasing_id()),
            "radix-groups",
        )
        more = not groups.filter(F.length("digit") == width).isEmpty()
        found = _open(digits, groups).join(groups.hint("merge"), ["gid", "digit"])
        over = F.length("digit") < width
        ended.append(written(found.filter(over).select(*MEMBER), "radix-ended"))
        if more:
            rest = F.expr(f"substring(rest, {width + 1})").alias("rest")
            split = found.filter(~over).select("id", "sha", F.col("next").alias("gid"), rest)
            active = written(split, "radix-split")
        forget(groups)
        if before is not None:
            forget(before)
        if not more:
            break
        before, width = active, min(width * GROWTH, LARGEST_DIGIT)
    members = ended[0]
    for part in ended[1:]:
        members = members.unionByName(part)
    return members


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with the one of its equals that stays.

    doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text in UTF-8).
    """
    every = _keyed(docs, doc_id, text).select("id", "sha")
    groups = duplicate_members(docs, doc_id, text).groupBy("sha").agg(
        F.max("group_size").alias("group_size"), F.max("keep_id").alias("keep_id")
    )
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return every.join(groups.hint("merge"), "sha", "left").select(
        F.col("id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are."""
    with temporary(docs.sparkSession):
        members = written(duplicate_members(docs, doc_id, text), "radix-members", keep=True)
    out = members.filter(~F.col("id").eqNullSafe(F.col("keep_id"))).select("id", "sha").distinct()
    same = members.groupBy("id", "sha").count().filter("count > 1").select("id", "sha")
    body = F.sha2(normalise(whole_text(text)), 256)

    def exactly(rows: DataFrame, listed: DataFrame, how: str) -> DataFrame:
        listed = listed.withColumnsRenamed({"id": _ID, "sha": _SHA})
        on = rows[doc_id].eqNullSafe(listed[_ID]) & (body == listed[_SHA])
        return rows.join(listed.hint("merge"), on, how)

    def without(rows: DataFrame, listed: DataFrame) -> DataFrame:
        """Rows that are not listed; those with another hash never meet the exact join."""
        if listed.count() * 16 > PREFILTER_BYTES:
            return exactly(rows, listed, "left_anti")
        marks = listed.select(F.xxhash64("id", "sha").alias(_MARK)).distinct()
        on = F.xxhash64(rows[doc_id], body) == marks[_MARK]
        clear = rows.join(F.broadcast(marks), on, "left_anti")
        return clear.unionByName(exactly(rows.join(F.broadcast(marks), on, "left_semi"), listed, "left_anti"))

    kept = without(docs, out)
    if same.isEmpty():
        return kept
    # Rows that repeat an id and its text, or have none: one of them stays.
    once = exactly(kept, same, "left_semi").withColumn(_SHA, body)
    return without(kept, same).unionByName(once.dropDuplicates([doc_id, _SHA]).drop(_SHA))
