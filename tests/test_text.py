from pyspark.sql import functions as F

from rostra.functions import scores, text
from rostra.functions.text import Preprocess, term_counts


def value(spark, raw, expression):
    df = spark.createDataFrame([(raw,)], "c string")
    return df.select(expression(F.col("c")).alias("v")).first()["v"]


def test_case_and_accents(spark):
    assert value(spark, "ΛΟΓΟΣ ΟΔΟΣ", text.case_fold) == "λογοσ οδοσ"
    assert value(spark, "Ένα Été Ångström ΰ", text.strip_accents) == "Ενα Ete Angstrom υ"
    assert value(spark, "éte", text.strip_accents) == "ete"


def test_punctuation_and_tokens(spark):
    assert value(spark, "a-b, c_d! (e)", text.strip_punctuation) == "a b c_d e "
    assert value(spark, "x ab, abc 12 ψω", text.tokenize) == ["ab", "abc", "12", "ψω"]


def test_stopwords_keep_repeats(spark):
    words = lambda c: text.remove_stopwords(F.split(c, " "), ("the",))
    assert value(spark, "the cat the cat", words) == ["cat", "cat"]


def test_stem_takes_the_longest_ending(spark):
    stem = lambda c: text.stem(c)
    for word, expected in [
        ("classes", "class"), ("walking", "walk"), ("bus", "bus"), ("parties", "part"),
        ("λογουσ", "λογ"), ("is", "is"),
    ]:
        assert value(spark, word, stem) == expected


def test_cleaned_text_has_the_same_terms(spark):
    pre = Preprocess()
    raw = "The Cats, and THE dogs' walking: a x 3.5 Ένα λόγος!"
    assert value(spark, raw, lambda c: text.tokenize(pre.text(c))) == value(spark, raw, pre.terms)


def test_term_counts_match_a_group_by(spark):
    df = spark.createDataFrame(
        [(0, "b a b c b a"), (1, ""), (2, "z"), (3, " ".join(str(i % 50) for i in range(5000)))],
        "doc_id long, t string",
    )
    terms = F.filter(F.split("t", " "), lambda w: F.length(w) > 0)
    counted = df.select("doc_id", F.inline(term_counts(terms)))
    grouped = df.select("doc_id", F.explode(terms).alias("term")).groupBy("doc_id", "term").count()
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, grouped.collect()))


def test_sentences(spark):
    parts = value(spark, 'Ένα. Δύο "3.5" τρία.', text.sentence_split)
    assert parts == ["Ένα", " Δύο 3.5 τρία", ""]
    assert value(spark, "a b  c", text.word_count) == 4
    assert value(spark, '""a"b"', text.strip_quotes) == 'a"b'


def test_years_and_labels(spark):
    assert value(spark, "31/12/1999", scores.parse_year) == 1999
    assert value(spark, "12/31/1999", scores.parse_year) is None
    assert value(spark, "1989-1991", scores.period_year) is None
    assert value(spark, "1990", scores.period_year) == 1990
    assert value(spark, "21", lambda c: scores.page_count(c.cast("long"))) == 3


def test_day_first_dates(spark):
    from rostra.functions.scores import parse_year

    dates = ["03/07/1989", "3/7/1989", "03-07-1989", "3.7.1989", "1989-07-03", " 3 Jul 1989", "3 July 1989"]
    df = spark.createDataFrame([(d,) for d in [*dates, "31/31/1989", "", None]], "d string")
    years = [r[0] for r in df.select(parse_year(F.col("d"))).collect()]
    assert years == [1989] * len(dates) + [None] * 3
