"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_SIZES = r"""
rows AS (
  SELECT doc_id, source,
         CASE WHEN source IS NULL THEN 'n' ELSE 'v' || source END AS grp,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM {docs}
), sizes AS (
  SELECT source, grp, sum(size)::BIGINT AS source_size FROM rows GROUP BY 1, 2
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1) AS w, 3 * source_size AS lim FROM sizes
), walked AS (
  SELECT *,
    coalesce(sum(lim) OVER (ORDER BY lim / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(w) OVER (ORDER BY lim / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
    sum(source_size) OVER () AS total
  FROM weighed
), shared AS (
  SELECT *, (total - used)::DOUBLE / rest::DOUBLE AS share FROM walked
), common AS (
  SELECT *, max(share) OVER () AS level FROM shared
), plan AS (
  SELECT grp, source_size, coalesce(least(lim::DOUBLE, level * w), 0.0) AS target,
         ('0x' || substr(md5('1/' || grp), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM common
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY size, doc_id) AS k FROM rows
), counted AS (
  SELECT doc_id, size, source_size, target,
         (floor(u + r * k) - floor(u + r * (k - 1)))::BIGINT AS copies
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS r FROM ranked JOIN plan USING (grp))
)
"""

MIXING = "WITH " + _SIZES.format(docs="documents") + "SELECT doc_id, size, source_size, target, size * copies AS taken FROM counted"


EXACT = """
WITH rows AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), numbered AS (
  SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS k
  FROM rows
)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM numbered
"""

LEAKS = r"""
WITH items AS (
  SELECT item_id, row_number() OVER (ORDER BY item_id, text) AS k, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), q AS (
  SELECT DISTINCT item_id, k, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT *, least(5, len(w)) AS m, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT k, count(*) AS n_item FROM q GROUP BY 1),
docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents
), d AS (
  SELECT DISTINCT doc_id, r, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM docs, (SELECT DISTINCT m FROM q) WHERE len(w) >= m)
),
shared AS (SELECT doc_id, r, item_id, k, count(*) AS n_shared FROM q JOIN d USING (s, m) GROUP BY ALL)
SELECT doc_id, item_id, n_shared::INT AS n_shared, n_item::INT AS n_item, n_shared / n_item AS containment
FROM shared JOIN sizes USING (k) WHERE n_shared >= 0.8 * n_item
"""


def licenses() -> str:
    """The scan in SQL, by windows of diagonals without merging; the templates are the operator's fixed values."""
    from wordloom.llm.licenses import BASE, PASSAGES

    rows = []
    for n, (phrase, label, exact) in enumerate([(p, x, "true") for p, x in BASE.items()] + [(p, x, "false") for p, x in PASSAGES.items()]):
        w = phrase.split()
        rows += [f"({n}, '{label}', {exact}, {len(w)}, {i}, '{' '.join(w[i : i + 3])}')" for i in range(len(w) - 2)]
    return rf"""
WITH known(template, label, exact, n_words, t_at, gram) AS (VALUES {", ".join(rows)}),
docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), grams AS (
  SELECT r, i - 1 AS pos, array_to_string(w[i:i + 2], ' ') AS gram
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM docs)
), votes AS (
  SELECT r, template, label, exact, n_words, t_at, pos - t_at AS first_at FROM grams JOIN known USING (gram)
), places AS (
  SELECT r, label, exact, first_at, 1.0::DOUBLE AS cover
  FROM votes WHERE exact GROUP BY r, template, label, exact, n_words, first_at HAVING count(DISTINCT t_at) = n_words - 2
  UNION ALL
  SELECT a.r, a.label, a.exact, a.first_at, count(DISTINCT b.t_at) / (a.n_words - 2) AS cover
  FROM (SELECT DISTINCT r, template, label, exact, n_words, first_at FROM votes WHERE NOT exact) a JOIN votes b
  ON a.r = b.r AND a.template = b.template AND b.first_at BETWEEN a.first_at AND a.first_at + greatest(3, a.n_words // 4)
  GROUP BY a.r, a.template, a.label, a.exact, a.n_words, a.first_at HAVING cover >= 0.8
), summed AS (
  SELECT r, count(*) FILTER (exact) AS n_base, min(first_at) FILTER (exact) AS first_word, max(first_at) FILTER (exact) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
  FROM places GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN summed USING (r)
"""


LINKED = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT r, CASE WHEN len(w) >= 4 THEN array_to_string(w[i:i + 3], ' ') ELSE array_to_string(w, ' ') END AS s
  FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
both_have AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM grams a JOIN grams b USING (s) WHERE a.r <> b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM both_have JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), reached(r, other) AS (
  SELECT r, r FROM docs
  UNION
  SELECT reached.r, links.y FROM reached JOIN links ON links.x = reached.other
)
SELECT docs.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM docs JOIN reached USING (r) JOIN docs o ON o.r = reached.other LEFT JOIN sizes ON sizes.r = docs.r GROUP BY docs.r, docs.doc_id
"""

RANKED = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), sizes AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
tfs AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS weight FROM tfs, totals GROUP BY term),
asked AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, text FROM benchmark)))
), scored AS (
  SELECT item, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (r), totals GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, r)::INT AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT, "op4_decontamination": LEAKS, "op7_licenses": licenses(), "op8_mixing": MIXING, "op11_shingle_join": LINKED, "op12_ranked_search": RANKED}
