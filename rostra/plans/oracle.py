"""The same questions in plain SQL, for checking the Spark results with another engine."""

from __future__ import annotations

from rostra.functions.text import (
    MIN_TERM_LENGTH,
    NON_WORD_PATTERN,
    STOPWORDS,
    TERM_PATTERN,
    WORD_PATTERN,
    accent_map,
    stem_pattern,
    MIN_STEM,
    SUFFIXES,
)
from rostra.plans.views import SITTING_DATE
from rostra.plans.queries import ONE_QUERY
from rostra.schemas import CLUSTERS, CLUSTERS_DEFAULT, SAMPLE_ROWS, SCORE_THRESHOLD

_FROM, _TO = accent_map()
_STOP = ", ".join(f"'{word}'" for word in STOPWORDS)


def _fold(x: str) -> str:
    return f"translate(lower({x}), 'ς', 'σ')"


def _accents(x: str) -> str:
    return f"translate({x}, '{_FROM}', '{_TO}')"


def _without_stopwords(x: str) -> str:
    return f"list_filter({x}, lambda w: w NOT IN ({_STOP}))"


def _stemmed(x: str) -> str:
    pattern = stem_pattern(SUFFIXES, MIN_STEM)
    return f"list_transform({x}, lambda w: regexp_replace(w, '{pattern}', '\\1'))"


def _words(x: str) -> str:
    found = f"regexp_extract_all({_accents(_fold(x))}, '{WORD_PATTERN}')"
    return _stemmed(_without_stopwords(found))


def _terms(x: str) -> str:
    return f"list_filter({_words(x)}, lambda w: length(w) >= {MIN_TERM_LENGTH})"


_SPEECHES = f"""
speeches AS (
  SELECT doc_id, source AS member_name, {SITTING_DATE} AS sitting_date,
         lang AS political_party, text AS speech
  FROM documents)"""

_SPEECHES_WITH_NULLS = f"""
speeches AS (
  SELECT doc_id, nullif(source, 'src0') AS member_name, {SITTING_DATE} AS sitting_date,
         nullif(lang, 'de') AS political_party,
         CASE WHEN source <> 'src1' THEN text END AS speech
  FROM documents)"""

_INDEX = f"""
tokens AS (SELECT doc_id, unnest({_terms("coalesce(speech, ' ')")}) AS term FROM speeches),
postings AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM tokens GROUP BY ALL),
n AS (SELECT count(*)::BIGINT AS n_docs FROM speeches),
df AS (SELECT term, count(*)::BIGINT AS df FROM postings GROUP BY term),
vocab AS (SELECT term, df, ln((1 + n_docs)::DOUBLE / (1 + df)) + 1 AS idf FROM df, n),
norms AS (
  SELECT s.doc_id, coalesce(sqrt(sum(p.tf * p.tf)::DOUBLE), 0.0) AS norm
  FROM speeches s LEFT JOIN postings p USING (doc_id) GROUP BY s.doc_id)"""

_GROUPS = f"""
dated AS (SELECT *, year(strptime(sitting_date, '%d/%m/%Y'))::BIGINT AS year
          FROM speeches WHERE speech IS NOT NULL),
counts AS (
  SELECT d.member_name, d.political_party, d.year, p.term, sum(p.tf)::BIGINT AS tf
  FROM postings p JOIN dated d USING (doc_id) GROUP BY ALL),
grouped AS (
  SELECT 'member' AS grouping, member_name AS entity, NULL::BIGINT AS year, term,
         sum(tf)::BIGINT AS tf
  FROM counts WHERE member_name IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'party', political_party, NULL::BIGINT, term, sum(tf)::BIGINT
  FROM counts WHERE political_party IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'member_year', member_name, year, term, sum(tf)::BIGINT
  FROM counts WHERE member_name IS NOT NULL AND year IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'party_year', political_party, year, term, sum(tf)::BIGINT
  FROM counts WHERE political_party IS NOT NULL AND year IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'year', year::VARCHAR, year, term, sum(tf)::BIGINT
  FROM counts WHERE year IS NOT NULL GROUP BY ALL)"""

_KEYWORDS = """
raw AS (SELECT grouping, entity, year, term, tf * idf AS raw FROM grouped JOIN vocab USING (term)),
lengths AS (SELECT grouping, entity, year, sqrt(sum(raw * raw)) AS norm FROM raw GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY grouping, entity, year
                               ORDER BY raw DESC, term)::BIGINT AS rank
  FROM raw),
keywords AS (
  SELECT r.grouping, r.entity, r.year, r.rank, r.term, r.raw / l.norm AS weight
  FROM ranked r JOIN lengths l ON r.grouping = l.grouping AND r.entity = l.entity
       AND r.year IS NOT DISTINCT FROM l.year
  WHERE r.rank <= 20)"""

_VECTORS = """
member_raw AS (SELECT entity, term, tf * idf AS raw
               FROM grouped JOIN vocab USING (term) WHERE grouping = 'member'),
member_norm AS (SELECT entity, sqrt(sum(raw * raw)) AS norm FROM member_raw GROUP BY entity),
vectors AS (SELECT entity, term, raw / norm AS weight
            FROM member_raw JOIN member_norm USING (entity))"""

_PAIRS = """
pairs AS (
  SELECT a.entity AS entity_a, b.entity AS entity_b, sum(a.weight * b.weight) AS similarity
  FROM vectors a JOIN vectors b ON a.term = b.term AND a.entity < b.entity
  GROUP BY ALL),
best AS (SELECT * FROM pairs ORDER BY round(similarity, 9) DESC, entity_a, entity_b LIMIT 50)"""

_QUERIES = f"""
batch AS (SELECT item_id AS query_id, text FROM benchmark WHERE length(trim(text)) > 0),
split AS (SELECT query_id, {_terms("text")} AS terms FROM batch),
words AS (SELECT query_id, unnest(terms) AS term, (generate_subscripts(terms, 1) - 1)::BIGINT AS pos
          FROM split),
asked AS (SELECT query_id, term, count(*)::BIGINT AS qtf, min(pos)::BIGINT AS first_pos
          FROM words GROUP BY ALL)"""


def _hits(threshold: float = SCORE_THRESHOLD, total: str = "(SELECT count(*) FROM vocab)") -> str:
    return f"""
hits AS (
  SELECT query_id, doc_id,
         sum(qtf * (1 + ln(tf)) * ln(1 + {total}::DOUBLE / df)) / any_value(trunc(norm)) AS score,
         min(first_pos) AS first_pos
  FROM asked JOIN postings USING (term) JOIN vocab USING (term) JOIN norms USING (doc_id)
  GROUP BY ALL
  HAVING sum(qtf * (1 + ln(tf)) * ln(1 + {total}::DOUBLE / df)) / any_value(trunc(norm))
         > {threshold}),
ranked_hits AS (
  SELECT *, row_number() OVER (PARTITION BY query_id
              ORDER BY round(score, 9) DESC, first_pos, doc_id)::BIGINT AS rank,
         count(*) OVER (PARTITION BY query_id)::BIGINT AS n_results
  FROM hits)"""


_YEARS = """
entity_years AS (
  SELECT 'member' AS kind, member_name AS entity, list_sort(list(DISTINCT year)) AS years
  FROM dated WHERE member_name IS NOT NULL AND year IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'party', political_party, list_sort(list(DISTINCT year))
  FROM dated WHERE political_party IS NOT NULL AND year IS NOT NULL GROUP BY ALL),
labelled AS (
  SELECT kind, entity,
         list_concat([years[1]::VARCHAR || '-' || years[-1]::VARCHAR],
                     list_transform(years, lambda y: y::VARCHAR)) AS labels
  FROM entity_years),
options AS (
  SELECT kind, entity, unnest(labels) AS label,
         (generate_subscripts(labels, 1) - 1)::BIGINT AS position
  FROM labelled)"""

_DATED = _GROUPS.split("),\ncounts")[0] + ")"

_VECTOR_TABLE = """
vecs AS (SELECT vec_id AS doc_id, label AS cluster,
                list_transform(embedding, lambda v: v::DOUBLE) AS vec FROM embeddings),
entries AS (SELECT doc_id, cluster, (generate_subscripts(vec, 1) - 1)::BIGINT AS dim,
                   unnest(vec) AS value FROM vecs),
centroids AS (SELECT cluster::BIGINT AS cluster, dim, avg(value) AS value FROM entries GROUP BY ALL),
dims AS (
  SELECT cluster, dim_rank, dim FROM (
    SELECT cluster, dim, row_number() OVER (PARTITION BY cluster
             ORDER BY round(abs(value), 9) DESC, dim)::BIGINT AS dim_rank FROM centroids)
  WHERE dim_rank <= 2),
terms_per_dim AS (
  SELECT dim, term_rank, term FROM (
    SELECT dim, 'v' || doc_id AS term, row_number() OVER (PARTITION BY dim
             ORDER BY value DESC, 'v' || doc_id)::BIGINT AS term_rank FROM entries)
  WHERE term_rank <= 2),
labels AS (SELECT cluster AS query_id, list(value ORDER BY dim) AS vec FROM centroids GROUP BY ALL),
cosines AS (
  SELECT q.query_id, d.doc_id, list_cosine_similarity(q.vec, d.vec) AS score
  FROM labels q, vecs d WHERE list_cosine_similarity(q.vec, d.vec) > 0.2)"""


def _with(*parts_and_select: str) -> str:
    *parts, select = parts_and_select
    return "WITH " + ",".join(parts) + "\n" + select


def _text(expression: str) -> str:
    return _with(_SPEECHES, f"SELECT doc_id, {expression} AS value FROM speeches")


def _joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, ' '), '')"


def _group(name: str) -> str:
    return _with(
        _SPEECHES, _INDEX, _GROUPS,
        f"SELECT entity, year, term, tf FROM grouped WHERE grouping = '{name}'",
    )


def _keyword_rows(where: str = "true", columns: str = "grouping, entity, year, rank, term") -> str:
    return _with(
        _SPEECHES, _INDEX, _GROUPS, _KEYWORDS,
        f"SELECT {columns}, round(weight, 6) AS weight FROM keywords WHERE {where}",
    )


def _search(select: str, **options) -> str:
    return _with(_SPEECHES, _INDEX, _QUERIES, _hits(**options), select)


_LATENT = """
numbered AS (SELECT term, idf, row_number() OVER (ORDER BY term) - 1 AS no FROM vocab),
comps AS (
  SELECT term, idf, list_transform(embedding, lambda v: v::DOUBLE)[1:60] AS comp
  FROM numbered JOIN embeddings ON no % (SELECT count(*) FROM embeddings) = vec_id),
doc_weights AS (
  SELECT doc_id AS id, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY doc_id)) AS w
  FROM postings JOIN vocab USING (term)),
query_weights AS (
  SELECT query_id AS id, term,
         qtf * idf / sqrt(sum((qtf * idf) ** 2) OVER (PARTITION BY query_id)) AS w
  FROM asked JOIN vocab USING (term)),
doc_sums AS (
  SELECT id, dim, sum(w * c) AS value FROM (
    SELECT id, w, unnest(comp) AS c, generate_subscripts(comp, 1) AS dim
    FROM doc_weights JOIN comps USING (term)) GROUP BY ALL),
query_sums AS (
  SELECT id, dim, sum(w * c) AS value FROM (
    SELECT id, w, unnest(comp) AS c, generate_subscripts(comp, 1) AS dim
    FROM query_weights JOIN comps USING (term)) GROUP BY ALL),
doc_vecs AS (SELECT id AS doc_id, list(value ORDER BY dim) AS vec FROM doc_sums GROUP BY id),
folded AS (SELECT id AS query_id, list(value ORDER BY dim) AS vec FROM query_sums GROUP BY id),
latent_hits AS (
  SELECT query_id, doc_id, list_cosine_similarity(q.vec, d.vec) AS score
  FROM folded q, doc_vecs d WHERE list_cosine_similarity(q.vec, d.vec) > 0.2),
latent AS (
  SELECT *, row_number() OVER (PARTITION BY query_id
              ORDER BY round(score, 9) DESC, doc_id)::BIGINT AS rank,
         count(*) OVER (PARTITION BY query_id)::BIGINT AS n_results
  FROM latent_hits)"""


def _latent(select: str) -> str:
    return _with(_SPEECHES, _INDEX, _QUERIES, _LATENT, select)


_CSV_TEXT = "replace(replace(text, chr(13), ' '), chr(10), ' ')"
_RANKED = "SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked_hits"

_PADDED = """
first_terms AS (SELECT term FROM vocab ORDER BY term LIMIT 20),
keys AS (
  SELECT DISTINCT 'member' AS grouping, member_name AS entity, NULL::BIGINT AS year FROM dated
  UNION SELECT 'party', political_party, NULL FROM dated
  UNION SELECT 'member_year', member_name, year FROM dated
  UNION SELECT 'party_year', political_party, year FROM dated
  UNION SELECT 'year', year::VARCHAR, year FROM dated),
own AS (SELECT grouping, entity, year, term, tf * idf AS raw FROM grouped JOIN vocab USING (term)),
lengths AS (SELECT grouping, entity, year, sqrt(sum(raw * raw)) AS norm FROM own GROUP BY ALL),
raw AS (
  SELECT * FROM own
  UNION ALL
  SELECT k.grouping, k.entity, k.year, t.term, 0.0 FROM keys k, first_terms t
  WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.grouping = k.grouping AND o.entity = k.entity
                    AND o.year IS NOT DISTINCT FROM k.year AND o.term = t.term)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY grouping, entity, year
                               ORDER BY raw DESC, term)::BIGINT AS rank FROM raw)"""

_SUMMARY = f"""
sentences AS (
  SELECT doc_id, trunc(len(string_split(speech, ' ')) / 1.5)::BIGINT AS max_words,
         string_split(regexp_replace(regexp_replace(
             replace(replace(speech, '"', ''), '''', ''), '\\.(\\d)', chr(1) || '\\1', 'g'),
             '\\.', chr(2), 'g'), chr(2)) AS parts
  FROM speeches),
pieces AS (
  SELECT doc_id, max_words, (generate_subscripts(parts, 1) - 1)::BIGINT AS pos,
         trim(replace(unnest(parts), chr(1), '.')) AS sentence FROM sentences),
full_pieces AS (SELECT * FROM pieces WHERE length(sentence) > 0),
sentence_terms AS (SELECT doc_id, pos, unnest({_terms("sentence")}) AS term FROM full_pieces),
scores AS (SELECT doc_id, pos, avg(idf) AS score
           FROM sentence_terms JOIN vocab USING (term) GROUP BY ALL),
scored AS (
  SELECT p.*, coalesce(score, 0.0) AS score, len(string_split(sentence, ' ')) AS words
  FROM full_pieces p LEFT JOIN scores USING (doc_id, pos)),
running AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, pos
                             ROWS UNBOUNDED PRECEDING) AS used,
         row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, pos) AS rank
  FROM scored)"""


# Results with a year, shown as text with 'all' for none.
WITH_YEAR = (
    "keyword_sink", "point_lookup", "entity_year_filter", "period_dispatch", "group_term_counts",
    "group_by_member", "group_by_party", "group_by_member_year", "group_by_party_year",
    "group_by_year", "all_groupings", "zero_pad_keywords", "keywords", "entity_profile", "party_profile",
)


def oracle() -> dict[str, str]:
    csv = f"""SELECT source AS member_name, {SITTING_DATE} AS sitting_date,
      lang AS political_party, doc_id::VARCHAR AS field_3, {_CSV_TEXT} AS speech FROM documents"""
    plain = f"regexp_extract_all({_accents(_fold('speech'))}, '{TERM_PATTERN}')"
    processed = f"""SELECT doc_id, member_name, sitting_date, political_party,
      {_joined(_words("speech"))} AS speech FROM speeches"""
    sql = {
        "corpus_scan": csv,
        "corpus_scan_quoted": f"""SELECT doc_id, '"' || source || '"' AS member_name,
          '"' || {SITTING_DATE} || '"' AS sitting_date, '"' || lang || '"' AS political_party,
          '"' || replace({_CSV_TEXT}, '"', '""') || '"' AS speech FROM documents""",
        "assign_doc_id": f"""SELECT doc_id, doc_id::VARCHAR AS field_3, source AS member_name,
          {SITTING_DATE} AS sitting_date FROM documents""",
        "row_limit": _with(_SPEECHES, f"SELECT * FROM speeches WHERE doc_id < {SAMPLE_ROWS}"),
        "row_limit_all": _with(
            _SPEECHES, "SELECT doc_id, member_name, sitting_date, political_party FROM speeches"
        ),
        "processed_sink": _with(_SPEECHES, processed),
        "processed_scan": _with(_SPEECHES, f"SELECT doc_id, speech FROM ({processed})"),
        "inverted_catalog": _with(_SPEECHES, _INDEX, """
          SELECT term, any_value(df) AS df, doc_id // 100 AS block,
                 string_agg(doc_id || ',' || tf, ',' ORDER BY doc_id) AS postings
          FROM postings JOIN vocab USING (term) GROUP BY term, doc_id // 100"""),
        "catalog_lines": _with(_SPEECHES, _INDEX, """
          SELECT term || ',' || any_value(df) || ',' || doc_id // 100 || ',' ||
                 string_agg(doc_id || ',' || tf, ',' ORDER BY doc_id) AS value
          FROM postings JOIN vocab USING (term) GROUP BY term, doc_id // 100"""),
        "index_sinks": _with(_SPEECHES, _INDEX, """
          SELECT 'postings' AS name, count(*)::BIGINT AS n_rows, sum(tf)::DOUBLE AS content
          FROM postings
          UNION ALL SELECT 'term_postings', count(*)::BIGINT, sum(tf)::DOUBLE FROM postings
          UNION ALL SELECT 'vocab', count(*)::BIGINT, round(sum(idf), 3) FROM vocab
          UNION ALL SELECT 'stats', 1::BIGINT,
                           ((SELECT count(*) FROM vocab) + (SELECT n_docs FROM n))::DOUBLE"""),
        "keyword_sink": _keyword_rows(),
        "point_lookup": _keyword_rows("entity = 'src3'"),
        "project_result": _with(_SPEECHES, "SELECT speech, member_name, sitting_date FROM speeches"),
        "keep_first_n_columns": f"""SELECT source AS member_name, {SITTING_DATE} AS sitting_date,
          lang AS political_party, doc_id::VARCHAR AS field_3, n_chars::VARCHAR AS field_4,
          '-' AS field_5, '-' AS field_6, '-' AS field_7, '-' AS field_8, '-' AS field_9,
          {_joined(_words(_CSV_TEXT))} AS speech FROM documents""",
        "drop_null_speech": _with(
            _SPEECHES_WITH_NULLS, "SELECT * FROM speeches WHERE speech IS NOT NULL"
        ),
        "fill_null_speech": _with(
            _SPEECHES_WITH_NULLS, "SELECT * REPLACE (coalesce(speech, ' ') AS speech) FROM speeches"
        ),
        "drop_null_keys": _with(_SPEECHES_WITH_NULLS, """
          SELECT doc_id, member_name, political_party, sitting_date FROM speeches
          WHERE member_name IS NOT NULL AND political_party IS NOT NULL"""),
        "oov_filter": _with(_SPEECHES, _INDEX, _QUERIES, """
          SELECT query_id, term, qtf, first_pos FROM asked SEMI JOIN vocab USING (term)"""),
        "entity_filter": _keyword_rows(
            "grouping = 'party' AND entity = 'fr'", "entity, rank, term"
        ),
        "entity_year_filter": _keyword_rows(
            "grouping = 'party_year' AND entity = 'en' AND year = 1990", "entity, year, rank, term"
        ),
        "period_dispatch": _with(_SPEECHES, _DATED, _YEARS, """
          SELECT kind, entity, label,
                 CASE WHEN contains(label, '-') THEN kind ELSE kind || '_year' END AS grouping,
                 CASE WHEN NOT contains(label, '-') THEN label::BIGINT END AS year
          FROM options"""),
        "empty_query_guard": """
          SELECT item_id AS query_id, text FROM benchmark
          WHERE item_id % 2 <> 0 AND length(trim(text)) > 0""",
        "empty_result": """
          SELECT item_id AS query_id, 0::BIGINT AS n_results, 0::BIGINT AS n_pages
          FROM benchmark""",
        "preprocess_text": _text(_joined(_words("speech"))),
        "strip_punctuation": _text(f"regexp_replace(speech, '{NON_WORD_PATTERN}', ' ', 'g')"),
        "strip_accents": _text(_accents("speech")),
        "case_fold": _text(_fold("speech")),
        "remove_stopwords": _text(_joined(_without_stopwords(plain))),
        "stem": _text(_joined(_stemmed(plain))),
        "word_count": _text("len(string_split(speech, ' '))::BIGINT"),
        "strip_quotes": _text("trim('\"' || speech || '\"\"', '\"')"),
        "trim": _text("trim('  ' || speech || ' ', ' ')"),
        "parse_year": _text("year(strptime(sitting_date, '%d/%m/%Y'))::BIGINT"),
        "tokenize": _with(_SPEECHES, f"""
          split AS (SELECT doc_id, regexp_extract_all(lower(speech), '{TERM_PATTERN}') AS terms
                    FROM speeches)""", """
          SELECT doc_id, (generate_subscripts(terms, 1) - 1)::BIGINT AS pos, unnest(terms) AS term
          FROM split"""),
        "query_split": _with(_QUERIES, "SELECT query_id, pos, term FROM words"),
        "sentence_split": _with(_SPEECHES, _SUMMARY.split(",\npieces")[0], """
          SELECT doc_id, (generate_subscripts(parts, 1) - 1)::BIGINT AS pos,
                 replace(unnest(parts), chr(1), '.') AS sentence FROM sentences"""),
        "tf_log": _with(_SPEECHES, _INDEX, """
          SELECT doc_id, term, round(1 + ln(tf), 6) AS weight FROM postings"""),
        "idf_search": _with(_SPEECHES, _INDEX, """
          SELECT term, round(ln(1 + (SELECT count(*) FROM vocab)::DOUBLE / df), 6) AS idf_terms,
                 round(ln(1 + n_docs::DOUBLE / df), 6) AS idf_docs FROM vocab, n"""),
        "idf_smooth": _with(
            _SPEECHES, _INDEX, "SELECT term, df, round(idf, 6) AS idf FROM vocab"
        ),
        "rounding_and_labels": _with(_SPEECHES, _INDEX, """
          SELECT doc_id, trunc(norm)::BIGINT AS truncated, round(norm, 2) AS rounded,
                 ceil(doc_id / 10.0)::BIGINT AS pages, round(abs(-norm), 6) AS size,
                 '1989-' || (1989 + doc_id % 32) AS label
          FROM norms"""),
        "postings": _with(_SPEECHES, _INDEX, "SELECT doc_id, term, tf FROM postings"),
        "doc_freq": _with(_SPEECHES, _INDEX, "SELECT term, df FROM df"),
        "vocabulary": _with(_SPEECHES, _INDEX, """
          SELECT term, df, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS term_id FROM df"""),
        "corpus_stats": _with(_SPEECHES, _INDEX, """
          SELECT n_docs, (SELECT count(*) FROM vocab)::BIGINT AS n_terms FROM n"""),
        "doc_norms": _with(
            _SPEECHES_WITH_NULLS, _INDEX, "SELECT doc_id, round(norm, 6) AS norm FROM norms"
        ),
        "tfidf_docs": _with(_SPEECHES, _INDEX, """
          raw AS (SELECT doc_id, term, tf * idf AS raw FROM postings JOIN vocab USING (term))""", """
          SELECT doc_id, term,
                 round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight
          FROM raw"""),
        "group_term_counts": _with(_SPEECHES, _INDEX, _GROUPS, """
          SELECT member_name, political_party, year, term, tf FROM counts"""),
        "all_groupings": _with(_SPEECHES_WITH_NULLS, _INDEX, _GROUPS, """
          SELECT grouping, entity, year, term, tf FROM grouped"""),
        "group_vectors": _with(_SPEECHES, _INDEX, _GROUPS, _VECTORS, """
          SELECT entity, term, round(weight, 6) AS weight FROM vectors"""),
        "search_score_sum": _search(
            "SELECT query_id, doc_id, round(score, 6) AS score, first_pos FROM hits", threshold=0.0
        ),
        "entity_options": _with(_SPEECHES_WITH_NULLS, """
          SELECT DISTINCT member_name AS entity, 'member' AS kind FROM speeches
          WHERE speech IS NOT NULL AND member_name IS NOT NULL
          UNION ALL
          SELECT DISTINCT political_party, 'party' FROM speeches
          WHERE speech IS NOT NULL AND political_party IS NOT NULL"""),
        "entity_years": _with(_SPEECHES_WITH_NULLS, _DATED, _YEARS, """
          SELECT kind, entity, position, label FROM options"""),
        "result_count": _search("""
          SELECT query_id, count(*)::BIGINT AS n_results, ceil(count(*) / 10.0)::BIGINT AS n_pages
          FROM hits GROUP BY query_id"""),
        "cluster_centroids": _with(_VECTOR_TABLE, """
          SELECT cluster, dim, round(value, 6) AS value FROM centroids"""),
        "wcss": _with(_VECTOR_TABLE, """
          SELECT count(DISTINCT e.cluster)::BIGINT AS k,
                 round(sum((e.value - c.value) * (e.value - c.value)), 6) AS wcss
          FROM entries e JOIN centroids c ON e.cluster = c.cluster AND e.dim = c.dim"""),
        "wcss_one_cluster": _with(_VECTOR_TABLE, """
          means AS (SELECT dim, avg(value) AS mean FROM entries GROUP BY dim)""", """
          SELECT 1::BIGINT AS k, round(sum((value - mean) * (value - mean)), 6) AS wcss
          FROM entries JOIN means USING (dim)"""),
        "silhouette": _with(_VECTOR_TABLE, """
          sums AS (
            SELECT a.doc_id, a.cluster, b.cluster AS other, count(*) AS size,
                   sum(list_distance(a.vec, b.vec) ** 2) AS total
            FROM vecs a, vecs b GROUP BY ALL)""", """
          per_doc AS (
            SELECT doc_id, max(CASE WHEN other = cluster THEN size END) AS size,
                   max(CASE WHEN other = cluster THEN total / (size - 1) END) AS a,
                   min(CASE WHEN other <> cluster THEN total / size END) AS b
            FROM sums GROUP BY doc_id)""", """
          SELECT round(avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
                 AS silhouette FROM per_doc"""),
        "query_postings_join": _with(_SPEECHES, _INDEX, _QUERIES, """
          SELECT query_id, term, qtf, first_pos, doc_id, tf
          FROM asked JOIN postings USING (term)"""),
        "doc_norm_join": _with(_SPEECHES, _INDEX, """
          SELECT doc_id, term,
                 round(tf / sqrt(sum(tf * tf) OVER (PARTITION BY doc_id)::DOUBLE), 6) AS share
          FROM postings"""),
        "fetch_documents": _search("""
          SELECT doc_id, speech, member_name, sitting_date, query_id, rank
          FROM ranked_hits JOIN speeches USING (doc_id) WHERE rank <= 10"""),
        "vocab_idf_join": _with(_SPEECHES, _INDEX, _QUERIES, """
          SELECT query_id, term, qtf, round(idf, 6) AS idf FROM asked JOIN vocab USING (term)"""),
        "group_pair_join": _with(_SPEECHES, _INDEX, _GROUPS, _VECTORS, _PAIRS, """
          SELECT entity_a, entity_b, round(similarity, 6) AS similarity FROM pairs"""),
        "query_doc_product": _with(_VECTOR_TABLE, """
          SELECT query_id, doc_id, round(score, 6) AS score FROM cosines"""),
        "cluster_component_join": _with(_VECTOR_TABLE, """
          SELECT d.cluster, d.dim, 'v' || e.doc_id AS term, round(e.value, 6) AS weight
          FROM dims d JOIN entries e USING (dim)"""),
        "keyword_lookup": _with(_SPEECHES, _INDEX, _GROUPS, _KEYWORDS, _YEARS, """
          SELECT o.kind, o.entity, o.label, k.rank, k.term, round(k.weight, 2) AS weight
          FROM options o JOIN keywords k ON k.entity = o.entity
           AND k.grouping = CASE WHEN contains(o.label, '-') THEN o.kind ELSE o.kind || '_year' END
           AND k.year IS NOT DISTINCT FROM
               CASE WHEN NOT contains(o.label, '-') THEN o.label::BIGINT END"""),
        "top20_keywords": _keyword_rows("grouping = 'member'", "entity, rank, term"),
        "zero_pad_keywords": _with(_SPEECHES, _INDEX, _GROUPS, _PADDED, """
          SELECT r.grouping, r.entity, r.year, r.rank, r.term,
                 round(CASE WHEN r.raw = 0 THEN 0.0 ELSE r.raw / l.norm END::DOUBLE, 6) AS weight
          FROM ranked r LEFT JOIN lengths l ON r.grouping = l.grouping AND r.entity = l.entity
               AND r.year IS NOT DISTINCT FROM l.year
          WHERE r.rank <= 20"""),
        "rank_search": _search(_RANKED),
        "page": _search(f"{_RANKED} WHERE rank BETWEEN 11 AND 20"),
        "page_by_bounds": _search(f"{_RANKED} WHERE rank <= 10"),
        "slice_bounds": _search(
            "SELECT query_id, count(*)::BIGINT AS n_hits, 0::BIGINT AS n_over FROM hits GROUP BY query_id",
            threshold=0.0,
        ),
        "top_pairs": _with(_SPEECHES, _INDEX, _GROUPS, _VECTORS, _PAIRS, """
          SELECT entity_a, entity_b, round(similarity, 2) AS similarity_rounded FROM best
          ORDER BY round(similarity, 9) DESC, entity_a, entity_b LIMIT 5"""),
        "top_dims": _with(_VECTOR_TABLE, "SELECT cluster, dim_rank, dim FROM dims"),
        "top_terms_per_dim": _with(_VECTOR_TABLE, "SELECT dim, term_rank, term FROM terms_per_dim"),
        "lsa_rank": _with(_VECTOR_TABLE, """
          SELECT query_id, doc_id, rank, round(score, 6) AS score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id
                        ORDER BY round(score, 9) DESC, doc_id)::BIGINT AS rank FROM cosines)"""),
        "party_profile": _keyword_rows(
            "(grouping = 'party' AND rank <= 10) OR grouping = 'party_year'",
            "entity, year, rank, term",
        ),
        "entity_profile": _keyword_rows(
            "(grouping = 'member' AND rank <= 10) OR grouping = 'member_year'",
            "entity, year, rank, term",
        ),
        "score_threshold": _search("""
          SELECT query_id, doc_id, round(score, 6) AS score
          FROM ranked_hits WHERE rank < n_results"""),
        "search": _search(_RANKED),
        "search_one_query": _with(_SPEECHES, _INDEX, _QUERIES.replace(
            "SELECT item_id AS query_id, text FROM benchmark",
            f"SELECT * FROM (SELECT 0::BIGINT AS query_id, '{ONE_QUERY}' AS text)",
        ), _hits(), _RANKED),
        "search_by_documents": _search(_RANKED, total="(SELECT n_docs FROM n)"),
        "search_results": _search("""
          SELECT query_id, rank, doc_id, speech, member_name, sitting_date,
                 round(score, 6) AS score, n_results, ceil(n_results / 10.0)::BIGINT AS n_pages
          FROM ranked_hits JOIN speeches USING (doc_id) WHERE rank <= 10"""),
        "keywords": _keyword_rows(),
        "similar_entities": _with(_SPEECHES, _INDEX, _GROUPS, _VECTORS, _PAIRS, """
          SELECT entity_a, entity_b, round(similarity, 6) AS similarity,
                 round(similarity, 2) AS similarity_rounded FROM best"""),
        "lsa_sink": _latent("""
          SELECT doc_id, (generate_subscripts(vec, 1) - 1)::BIGINT AS dim,
                 round(unnest(vec), 6) AS value FROM doc_vecs"""),
        "cluster_sink": "SELECT vec_id AS doc_id, label::BIGINT AS cluster FROM embeddings",
        "similar_roles": _with("""
          speeches AS (SELECT (conv_id, turn) AS doc_id, role AS member_name,
                              NULL::VARCHAR AS political_party, NULL::VARCHAR AS sitting_date,
                              text AS speech FROM conversations)""",
          _INDEX, _GROUPS, _VECTORS, _PAIRS, """
          SELECT entity_a, entity_b, round(similarity, 6) AS similarity,
                 round(similarity, 2) AS similarity_rounded FROM best"""),
        "summarize": _with(_SPEECHES, _INDEX, _SUMMARY, """
          SELECT s.doc_id, coalesce(trim(string_agg(r.sentence, '. ' ORDER BY r.pos), '"'), '')
                 AS summary
          FROM speeches s LEFT JOIN running r
            ON s.doc_id = r.doc_id AND (r.used <= r.max_words OR r.rank = 1)
          WHERE s.speech IS NOT NULL GROUP BY s.doc_id"""),
        "build_all": _with(_SPEECHES, _INDEX, _GROUPS, _KEYWORDS, _VECTORS, _PAIRS, """
          sizes AS (
            SELECT (SELECT count(*) FROM speeches) AS docs, (SELECT count(*) FROM vocab) AS terms,
                   (SELECT least(count(*), {CLUSTERS}) FROM speeches) AS clusters,
                   (SELECT count(*) FROM postings) AS postings,
                   (SELECT count(*) FROM keywords) AS keywords,
                   (SELECT count(DISTINCT (term, doc_id // 65536)) FROM postings) AS catalog,
                   (SELECT count(*) FROM vectors) AS vectors, (SELECT count(*) FROM best) AS pairs,
                   (SELECT sum(tf)::DOUBLE FROM postings) AS tf,
                   (SELECT sum(idf) FROM vocab) AS idf, (SELECT sum(norm) FROM norms) AS norm,
                   (SELECT sum(weight) FROM keywords) AS keyword,
                   (SELECT sum(weight) FROM vectors) AS vector,
                   (SELECT sum(similarity) FROM best) AS similarity,
                   (SELECT sum(length(text)) FROM ({_PROCESSED_TEXT})) AS letters,
                   (SELECT sum(w) FROM (
                      SELECT tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY doc_id)) AS w
                      FROM postings JOIN vocab USING (term))) AS tfidf)""".replace("{CLUSTERS}", str(CLUSTERS)).replace(
            "{_PROCESSED_TEXT}", f"SELECT {_joined(_words('speech'))} AS text FROM speeches"), """
          SELECT unnest(['postings', 'term_postings', 'tfidf', 'vocab', 'catalog', 'lsa_terms',
                         'processed', 'norms', 'lsa_docs', 'clusters', 'keywords',
                         'member_vectors', 'pairs', 'stats', 'cluster_terms']) AS name,
                 unnest([postings, postings, postings, terms, catalog, terms, docs, docs, docs, docs,
                         keywords, vectors, pairs, 1, clusters * 4])::BIGINT AS n_rows,
                 round(unnest([tf, tf, tfidf, idf, postings, terms, letters, norm, docs, clusters, keyword,
                               vector, similarity, docs + terms, clusters]::DOUBLE[]), 3) AS content
          FROM sizes"""),
        "fold_in_given": _latent("""
          SELECT query_id, (generate_subscripts(vec, 1) - 1)::BIGINT AS dim,
                 round(unnest(vec), 6) AS value FROM folded"""),
        "search_lsa_given": _latent("""
          SELECT query_id, rank, doc_id, round(score, 6) AS score FROM latent"""),
        "search_results_lsa_given": _latent("""
          SELECT query_id, rank, doc_id, speech, member_name, sitting_date,
                 round(score, 6) AS score, n_results, ceil(n_results / 10.0)::BIGINT AS n_pages
          FROM latent JOIN speeches USING (doc_id) WHERE rank BETWEEN 11 AND 20"""),
        "lsa_fit_checks": _with(_SPEECHES, _INDEX, """
          SELECT unnest(['terms', 'docs', 'orthonormal', 'falling', 'products_wrong']) AS name,
                 unnest([(SELECT count(*) FROM vocab), (SELECT count(*) FROM speeches), 1, 1, 0]
                 )::BIGINT AS value"""),
        "kmeans_checks": f"""
          SELECT unnest(['rows', 'clusters', 'cost_falls', 'labels_not_of_the_nearest_mean',
                         'cost_as_good_as_plain']) AS name,
                 unnest([(SELECT count(*) FROM documents), {CLUSTERS_DEFAULT}, 1, 0, 1])::BIGINT AS value""",
        "k_sweep_checks": """
          WITH entries AS (
            SELECT unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS value FROM embeddings
          )
          SELECT unnest(['models', 'cost_of_one', 'cost_falls', 'silhouettes',
                         'last_below_first']) AS name,
                 round(unnest([99, (SELECT sum(spread) FROM (
                   SELECT var_pop(value) * count(*) AS spread FROM entries GROUP BY dim)), 98, 98, 1
                 ]::DOUBLE[]), 6) AS value""",
        "cluster_terms": _with(_VECTOR_TABLE, """
          SELECT cluster, dim_rank, term_rank, dim, term
          FROM dims JOIN terms_per_dim USING (dim)"""),
    }
    sql["pair_sink"] = sql["similar_entities"]
    for name in ("member", "party", "member_year", "party_year", "year"):
        sql[f"group_by_{name}"] = _group(name)
    for name in WITH_YEAR:
        sql[name] = f"""SELECT * EXCLUDE (year), coalesce(year::VARCHAR, 'all') AS period
          FROM ({sql[name]})"""
    return sql
