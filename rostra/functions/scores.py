"""Scalar expressions: weights, rounding and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostra.schemas import ALL_PERIODS, DATE_FORMATS, PAGE_SIZE, RANK_DECIMALS


def tf_log(tf: Column) -> Column:
    return 1 + F.log(tf)


def idf_search(total: Column, df: Column) -> Column:
    return F.log(1 + total.cast("double") / df)


def idf_smooth(n_docs: Column, df: Column) -> Column:
    return F.log((1 + n_docs).cast("double") / (1 + df)) + 1


def int_truncate(value: Column) -> Column:
    return value.cast("long")


def rank_key(score: Column) -> Column:
    """Scores equal up to the order of summation become exact ties."""
    return F.round(score, RANK_DECIMALS)


def round2(value: Column) -> Column:
    return F.round(value, 2)


def page_count(n_results: Column, page_size: int = PAGE_SIZE) -> Column:
    return F.ceil(n_results / page_size)


def period_label(first: Column, last: Column) -> Column:
    return F.concat_ws(ALL_PERIODS, first.cast("string"), last.cast("string"))


def is_all_periods(label: Column) -> Column:
    """A label such as 1989-2020 means all years, a single year means that year."""
    return F.contains(label, F.lit(ALL_PERIODS))


def period_year(label: Column) -> Column:
    """The year of a one-year label, NULL for all years."""
    return F.when(~is_all_periods(label), label.try_cast("int"))


def parse_year(date: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Year of a date in the first format that reads it; NULL where none does."""
    return F.year(F.coalesce(*[F.try_to_date(F.trim(date), fmt) for fmt in formats]))
