"""DuckDB SQL of the queries that SQL can express, over the same tables."""

#: Words of each text, every 20-word window that also starts earlier, what it covers.
SUBSTRING_DEDUP = r"""
WITH docs AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), windows AS (
  SELECT r, i, md5(array_to_string(words[i : i + 19], ' ')) AS key
  FROM (SELECT r, words, unnest(range(1, len(words) - 18)) AS i FROM docs WHERE len(words) >= 20)
), again AS (
  SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY key ORDER BY r, i) AS nth FROM windows) WHERE nth > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 20)) AS i FROM again
), kept AS (
  SELECT w.r, count(*) AS n_kept, string_agg(w.word, ' ' ORDER BY w.i) AS text
  FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs) w ANTI JOIN gone USING (r, i)
  GROUP BY w.r
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(len(d.words) - coalesce(k.n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (r)
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: Every item against every document that shares a term, without an index.
LEXICAL_SEARCH = f"""
WITH docs AS (
  SELECT r, doc_id, terms, len(terms) AS n
  FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL) WHERE len(terms) > 0
), whole AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, n_docs
), asked AS (
  SELECT DISTINCT q, item_id, term FROM (
    SELECT q, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM benchmark))
), scored AS (
  SELECT q, item_id, doc_id, r,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN docs USING (r), whole GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

PARTS, ENTRIES = 16, 64


def _nearest(book: str) -> str:
    """Each part's least (distance, entry), as distance * ENTRIES + entry."""
    return f"""
  SELECT p.r, p.part, any_value(p.x) AS x,
         min(list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {ENTRIES} + b.entry) AS best
  FROM pieces p JOIN {book} b USING (part) GROUP BY p.r, p.part"""


def _means(near: str, book: str) -> str:
    """Entries replaced by the floored means of their parts, unused ones kept."""
    return f"""
  SELECT part, entry, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (
    SELECT part, entry, list(CAST(floor(total / many) AS BIGINT) ORDER BY place) AS c FROM (
      SELECT part, best % {ENTRIES} AS entry, place, CAST(sum(v) AS BIGINT) AS total, count(*) AS many
      FROM (SELECT part, best, unnest(x) AS v, unnest(range(len(x))) AS place FROM {near}) GROUP BY ALL) GROUP BY part, entry) m USING (part, entry)"""


VECTOR_CODES = f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), pieces AS MATERIALIZED (
  SELECT r, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS x FROM vectors, (SELECT unnest(range({PARTS})) AS part)
), book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM pieces WHERE r <= {ENTRIES}
), near0 AS MATERIALIZED ({_nearest("book0")}
), book1 AS MATERIALIZED ({_means("near0", "book0")}
), near1 AS MATERIALIZED ({_nearest("book1")}
), book2 AS MATERIALIZED ({_means("near1", "book1")}
), near2 AS MATERIALIZED ({_nearest("book2")}
), codes AS (
  SELECT r, string_agg(lpad(lower(hex(best % {ENTRIES})), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM near2 GROUP BY r
), digest AS (
  SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(c) AS v, unnest(range(len(c))) AS place FROM book2)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN vectors USING (r), digest
"""

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_vector_codes": VECTOR_CODES,
}
