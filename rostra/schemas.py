"""Schemas of the stored tables and the fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that results depend on.
KEYWORDS_PER_GROUP = 20
PROFILE_KEYWORDS = 10
PAGE_SIZE = 10
SCORE_THRESHOLD = 0.2
SIMILAR_PAIRS = 50  # 100 cells of the symmetric matrix
SIMILAR_PAIRS_SHOWN = 5
SVD_COMPONENTS = 100
SVD_KEPT = 60
CLUSTERS = 80
CLUSTERS_DEFAULT = 9
KMEANS_STARTS = 10
KMEANS_ITERATIONS = 300
DIMS_PER_CLUSTER = 2
TERMS_PER_DIM = 2
LEADING_COLUMNS = 10
SAMPLE_ROWS = 100

# Scores closer than this many decimal places count as ties when rows are ranked.
RANK_DECIMALS = 9

# Day first, or year first where that leaves no doubt.
DATE_FORMATS = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-M-d", "yyyy/M/d", "d MMM yyyy", "d MMMM yyyy")

MEMBER, PARTY, DATE, SPEECH = "member_name", "political_party", "sitting_date", "speech"
ALL_PERIODS = "-"


def corpus_schema(n_columns: int = 11) -> T.StructType:
    """A CSV corpus: name, date, other columns with the party among them, speech last."""
    middle = [PARTY] + [f"field_{i}" for i in range(3, n_columns - 1)]
    names = [MEMBER, DATE, *middle, SPEECH]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


TERM_COUNT = T.ArrayType(
    T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
)
VECTOR = T.ArrayType(T.DoubleType())
