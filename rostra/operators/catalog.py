"""Lookups: entities, years, keywords of an entity and a period, entity profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostra.functions.scores import is_all_periods, period_label, period_year, round2
from rostra.operators.groups import with_year
from rostra.schemas import MEMBER, PARTY, PROFILE_KEYWORDS, SPEECH

KIND_COLUMNS = {"member": MEMBER, "party": PARTY}


def entity_options(corpus: DataFrame, kind: str) -> DataFrame:
    """The members or parties with at least one speech, sorted."""
    key = KIND_COLUMNS[kind]
    rows = corpus.where(F.col(SPEECH).isNotNull() & F.col(key).isNotNull())
    return rows.select(F.col(key).alias("entity")).distinct().orderBy("entity")


def entity_years(corpus: DataFrame, kind: str) -> DataFrame:
    """``(kind, entity, label, years)``: the label ``first-last`` and the years ascending."""
    key = KIND_COLUMNS[kind]
    rows = with_year(corpus.where(F.col(SPEECH).isNotNull())).dropna(subset=[key, "year"])
    return rows.groupBy(F.lit(kind).alias("kind"), F.col(key).alias("entity")).agg(
        period_label(F.min("year"), F.max("year")).alias("label"),
        F.sort_array(F.collect_set("year")).alias("years"),
    )


def period_options(years: DataFrame) -> DataFrame:
    """``(kind, entity, position, label)``: the all-years label first, then each year."""
    labels = F.concat(F.array("label"), F.transform("years", lambda y: y.cast("string")))
    return years.select("kind", "entity", F.posexplode(labels).alias("position", "label"))


def period_grouping(kind: Column, label: Column) -> Column:
    """The keyword grouping that answers a request for a kind of entity and a period."""
    return F.when(is_all_periods(label), kind).otherwise(F.concat(kind, F.lit("_year")))


def keyword_lookup(requests: DataFrame, keywords: DataFrame) -> DataFrame:
    """Keywords for requests ``(kind, entity, label)``, weights rounded to two places."""
    asked = requests.select(
        "kind",
        "entity",
        "label",
        period_grouping(F.col("kind"), F.col("label")).alias("grouping"),
        period_year(F.col("label")).alias("year"),
    )
    same = (
        (F.col("a.grouping") == F.col("k.grouping"))
        & (F.col("a.entity") == F.col("k.entity"))
        & F.col("a.year").eqNullSafe(F.col("k.year"))
    )
    return asked.alias("a").join(keywords.alias("k"), same).select(
        "a.kind", "a.entity", "a.label", "k.rank", "k.term",
        round2(F.col("k.weight")).alias("weight"),
    )


def entity_filter(keywords: DataFrame, kind: str, entity: str) -> DataFrame:
    return keywords.where((F.col("grouping") == kind) & (F.col("entity") == entity))


def entity_year_filter(keywords: DataFrame, kind: str, entity: str, year: int) -> DataFrame:
    return entity_filter(keywords, f"{kind}_year", entity).where(F.col("year") == year)


def entity_profile(keywords: DataFrame, kind: str, top: int = PROFILE_KEYWORDS) -> DataFrame:
    """All-time top keywords and the keywords of each year, for every entity of a kind."""
    all_time = keywords.where((F.col("grouping") == kind) & (F.col("rank") <= top))
    per_year = keywords.where(F.col("grouping") == f"{kind}_year")
    return all_time.unionByName(per_year).select("entity", "year", "rank", "term", "weight")
