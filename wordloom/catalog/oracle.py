"""The registered queries as SQL for DuckDB, written independently.

The text rules are stated a second time as regular expressions (RE2), the
scores as plain arithmetic, the boolean logic as set conditions.
"""

from __future__ import annotations

import re

from wordloom.functions import analysis as A
from wordloom.functions import html as H
from wordloom.operators.postings import FIELDS


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _re2(pattern: str) -> str:
    """Java to RE2: possessive quantifiers become greedy ones."""
    return re.sub(r"(?<!\\)([*+?])\+", r"\1", pattern)


TREE_PATH = """coalesce(source, 'none') || '/' || CASE abs(doc_id) % 4 WHEN 0 THEN '' WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '.more/_' END || doc_id || '.txt'"""

# -- text -------------------------------------------------------------------

_LOWER = "lower(replace(replace({0}, 'Σ', 'σ'), 'İ', 'i'))"


def _words(column: str) -> str:
    lower = _LOWER.format(column)
    return (
        f"flatten(list_transform(regexp_extract_all({lower}, {_q(A.token_pattern('re2'))}), "
        "lambda w: CASE WHEN length(w) <= 255 THEN [w] "
        "ELSE regexp_extract_all(w, '(?s).{1,255}') END))"
    )


STOP = "(" + ", ".join(_q(w) for w in A.STOP_WORDS) + ")"

DOCS = """docs AS (
  SELECT doc_id, source || '/' || doc_id || '.txt' AS path, doc_id || '.txt' AS title, text AS content
  FROM documents)"""

PLAIN_TOKENS = f"""lists AS (SELECT doc_id, {_words('text')} AS ws FROM documents),
tokens AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM lists)"""


def _field_tokens(fields) -> str:
    parts = " UNION ALL ".join(
        f"SELECT doc_id, {_q(f)} AS field, {_words(f)} AS ws FROM docs" for f in fields
    )
    return f"""lists AS ({parts}),
tokens AS (SELECT doc_id, field, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM lists)"""


def _rules(rules, condition: str) -> str:
    cases = []
    for suffix, repl in sorted(rules, key=lambda r: -len(r[0])):
        stem = f"left(w, length(w) - {len(suffix)})"
        test = f"regexp_matches({stem}, {_q(condition)})"
        if suffix == "ion":
            test += f" AND regexp_matches({stem}, '[st]$')"
        cases.append(f"WHEN w LIKE '%{suffix}' THEN CASE WHEN {test} THEN {stem} || {_q(repl)} ELSE w END")
    return "CASE " + " ".join(cases) + " ELSE w END"


def _stems() -> str:
    """CTEs from ``vocab(word)`` to ``stems(word, stem)``."""
    m0, m1, m_is_1 = _q(A.M_ABOVE_0), _q(A.M_ABOVE_1), _q(A.M_IS_1)
    vowel, short = _q(A.HAS_VOWEL), _q(A.SHORT_SYLLABLE)
    doubled = _q("(" + "|".join(c * 2 for c in "bcdfghjkmnpqrtvwx") + ")$")
    steps = [
        "CASE WHEN w LIKE 'y%' THEN 'Y' || substr(w, 2) ELSE w END",
        "CASE WHEN regexp_matches(w, '(ss|i)es$') THEN left(w, length(w) - 2) "
        "WHEN regexp_matches(w, '[^s]s$') THEN left(w, length(w) - 1) ELSE w END",
    ]
    out = ["p0 AS (SELECT word, word AS w FROM vocab WHERE length(word) > 2)"]
    for i, expr in enumerate(steps):
        out.append(f"p{i + 1} AS (SELECT word, {expr} AS w FROM p{i})")
    out.append(
        f"""q1 AS (SELECT word, w, CASE
  WHEN w LIKE '%eed' THEN NULL
  WHEN w LIKE '%ed' AND regexp_matches(left(w, length(w) - 2), {vowel}) THEN left(w, length(w) - 2)
  WHEN w LIKE '%ing' AND regexp_matches(left(w, length(w) - 3), {vowel}) THEN left(w, length(w) - 3)
  END AS s FROM p2)"""
    )
    out.append(
        f"""q2 AS (SELECT word, CASE
  WHEN w LIKE '%eed' AND regexp_matches(left(w, length(w) - 3), {m0}) THEN left(w, length(w) - 1)
  WHEN s IS NULL THEN w
  WHEN regexp_matches(s, '(at|bl|iz)$') THEN s || 'e'
  WHEN regexp_matches(s, {doubled}) OR (right(s, 1) = substr(s, length(s) - 1, 1) AND length(s) > 1
       AND NOT regexp_matches(s, '[a-z]$')) THEN left(s, length(s) - 1)
  WHEN regexp_matches(s, {m_is_1}) AND regexp_matches(s, {short}) THEN s || 'e'
  ELSE s END AS w FROM q1)"""
    )
    later = [
        f"CASE WHEN w LIKE '%y' AND regexp_matches(left(w, length(w) - 1), {vowel}) "
        "THEN left(w, length(w) - 1) || 'i' ELSE w END",
        _rules(A.STEP2, A.M_ABOVE_0),
        _rules(A.STEP3, A.M_ABOVE_0),
        _rules([(s, "") for s in A.STEP4], A.M_ABOVE_1),
        f"CASE WHEN w LIKE '%e' AND (regexp_matches(left(w, length(w) - 1), {m1}) "
        f"OR (regexp_matches(left(w, length(w) - 1), {m_is_1}) "
        f"AND NOT regexp_matches(left(w, length(w) - 1), {short}))) THEN left(w, length(w) - 1) ELSE w END",
        f"CASE WHEN w LIKE '%ll' AND regexp_matches(w, {m1}) THEN left(w, length(w) - 1) ELSE w END",
    ]
    for i, expr in enumerate(later):
        out.append(f"q{i + 3} AS (SELECT word, {expr} AS w FROM q{i + 2})")
    out.append(
        f"stems AS (SELECT word, lower(w) AS stem FROM q{len(later) + 2} "
        "UNION ALL SELECT word, word FROM vocab WHERE length(word) <= 2)"
    )
    return ",\n".join(out)


def _index(fields=FIELDS, docs: str = DOCS, more_words: str = "") -> str:
    """CTEs up to postings and statistics.

    ``more_words``: CTEs ending in ``qkept``, whose words are stemmed too.
    """
    union = " UNION SELECT word FROM qkept" if more_words else ""
    return f"""WITH {docs},
{_field_tokens(fields)},
kept AS (SELECT * FROM tokens WHERE word NOT IN {STOP}),
{more_words}
vocab AS (SELECT DISTINCT word FROM kept{union}),
{_stems()},
terms AS (SELECT field, doc_id, pos, stem AS term FROM kept JOIN stems USING (word)),
lengths AS (SELECT field, doc_id, count(*) AS dl FROM terms GROUP BY ALL),
shifts AS (SELECT *, CASE WHEN dl < 40 THEN 0 ELSE length(bin(dl - 24)) - 4 END AS s FROM lengths),
dls AS (SELECT field, doc_id, dl,
  CASE WHEN dl < 40 THEN dl ELSE 24 + (((dl - 24) >> s) << s) END AS dl_q FROM shifts),
post AS (SELECT field, term, doc_id, count(*) AS tf, list(pos ORDER BY pos) AS positions,
  any_value(dl) AS dl, any_value(dl_q) AS dl_q
  FROM terms JOIN dls USING (field, doc_id) GROUP BY field, term, doc_id),
stats AS (SELECT field, count(*) AS n, sum(dl) AS total, sum(dl) / count(*) AS avgdl FROM lengths GROUP BY field),
dict AS (SELECT field, term, count(*) AS df, sum(tf) AS ttf FROM post GROUP BY field, term)"""


OK = "ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl_q / avgdl))"
VS = "(ln((n + 1) / (df + 1)) + 1) * sqrt(tf) / sqrt(dl_q)"


def _clauses(rows) -> str:
    """``clauses(c, term, w)``: analysed terms with their weights."""
    values = ", ".join(f"({c}, {_q(t)}, CAST({w} AS DOUBLE))" for c, t, w in rows)
    return f"clauses(c, term, w) AS (VALUES {values})"


def _scored(formula: str = OK) -> str:
    """``hit(c, doc_id, score)``: one row per matching clause and document."""
    return f"""hit AS (SELECT c, doc_id, sum(w * {formula}) AS score
  FROM clauses JOIN post USING (term) JOIN dict USING (field, term) JOIN stats USING (field)
  GROUP BY c, doc_id)"""


def _top(rows, formula=OK, fields=("content",), k=10) -> str:
    return f"""{_index(fields)}, {_clauses(rows)}, {_scored(formula)},
total AS (SELECT doc_id, round(sum(score), 6) AS score FROM hit GROUP BY doc_id)
SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM total ORDER BY score DESC, doc_id LIMIT {k}"""


def _bool(rows, condition: str, scored: str = "true", fields=FIELDS) -> str:
    """All documents whose clause set meets the condition."""
    return f"""{_index(fields)}, {_clauses(rows)}, {_scored()},
per AS (SELECT doc_id, list(c) AS cs, sum(score) FILTER (WHERE {scored}) AS score FROM hit GROUP BY doc_id)
SELECT doc_id, round(score, 6) AS score FROM per WHERE {condition}"""


def _constant(test: str, boost: float = 1.0, fields=FIELDS) -> str:
    return f"""{_index(fields)}
SELECT doc_id, round(CAST(count(DISTINCT field) * {boost} AS DOUBLE), 6) AS score FROM post WHERE {test} GROUP BY doc_id"""


def _phrase(terms, fields=("content",)) -> str:
    """Exact phrase of (shift, term) pairs by joining positions."""
    joins = " ".join(
        f"JOIN terms t{i} ON t{i}.field = t0.field AND t{i}.doc_id = t0.doc_id "
        f"AND t{i}.pos = t0.pos + {shift} AND t{i}.term = {_q(term)}"
        for i, (shift, term) in enumerate(terms)
        if i
    )
    words = ", ".join(_q(t) for _, t in terms)
    return f"""{_index(fields)},
freq AS (SELECT t0.field, t0.doc_id, count(*) AS tf FROM terms t0 {joins}
  WHERE t0.term = {_q(terms[0][1])} GROUP BY ALL),
pidf AS (SELECT field, sum(ln(1 + (n - df + 0.5) / (df + 0.5))) AS idf
  FROM dict JOIN stats USING (field) WHERE term IN ({words}) GROUP BY field)
SELECT doc_id, round(sum(idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl_q / avgdl))), 6) AS score
FROM freq JOIN dls USING (field, doc_id) JOIN pidf USING (field) JOIN stats USING (field) GROUP BY doc_id"""


def _sloppy(first: str, second: str, slop: int, fields=("content",)) -> str:
    """Two-term sloppy phrase by windows over the shifted positions."""
    return f"""{_index(fields)},
pts AS (SELECT field, doc_id, 0 AS idx, pos AS x FROM terms WHERE term = {_q(first)}
  UNION ALL SELECT field, doc_id, 1, pos - 1 FROM terms WHERE term = {_q(second)}),
places AS (SELECT field, doc_id, x, list_sort(list(idx), 'DESC') AS h FROM pts GROUP BY ALL),
place1 AS (SELECT *, coalesce(len(h) > 1 AND lag(h[1]) OVER w = h[1], false) AS opp,
  coalesce(len(h) > 1 AND lag(h[2]) OVER w = h[1], false) AS same
  FROM places WINDOW w AS (PARTITION BY field, doc_id ORDER BY x)),
place2 AS (SELECT *, sum(CASE WHEN opp THEN 1 ELSE 0 END) OVER (PARTITION BY field, doc_id ORDER BY x) AS opps FROM place1),
place3 AS (SELECT *, max(CASE WHEN NOT opp AND NOT same THEN opps END)
  OVER (PARTITION BY field, doc_id ORDER BY x) AS free FROM place2),
place4 AS (SELECT *, lag(CASE WHEN (opps - coalesce(free, 0)) % 2 = 1 THEN h[2] ELSE h[1] END)
  OVER (PARTITION BY field, doc_id ORDER BY x) AS turn_at FROM place3),
place5 AS (SELECT field, doc_id, x, turn_at, unnest(h) AS idx FROM place4),
walk AS (SELECT *, row_number() OVER (PARTITION BY field, doc_id
  ORDER BY x, CASE WHEN idx = turn_at THEN -1 ELSE idx END) AS r FROM place5),
win AS (SELECT *, lead(idx) OVER w AS next_idx, lead(x) OVER w AS other_x
  FROM walk WINDOW w AS (PARTITION BY field, doc_id ORDER BY r)),
freq AS (SELECT field, doc_id, sum(1.0 / (1 + other_x - x)) AS tf FROM win
  WHERE next_idx <> idx AND other_x - x <= {slop} GROUP BY ALL),
pidf AS (SELECT field, sum(ln(1 + (n - df + 0.5) / (df + 0.5))) AS idf
  FROM dict JOIN stats USING (field) WHERE term IN ({_q(first)}, {_q(second)}) GROUP BY field)
SELECT doc_id, round(sum(idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl_q / avgdl))), 6) AS score
FROM freq JOIN dls USING (field, doc_id) JOIN pidf USING (field) JOIN stats USING (field) GROUP BY doc_id"""


def _fuzzy_batch() -> str:
    """As below, with the words in a table: the first of an item with two edits, the second with one.

    DuckDB counts edits of bytes, so each letter beyond ASCII gets a capital,
    which lower-cased terms do not have, or another sign as its mark.
    """
    marks = "ABCDEFGHIJKLMNOPQRSTUVWXYZ!$%&()*+,-./:;<=>?@[]^{|}~"
    swaps = """len(list_filter(range(1, length(word)), lambda i: len(list_filter(range(1, length(term)), lambda j:
    substr(term, j, 2) = substr(word, i + 1, 1) || substr(word, i, 1)
    AND damerau_levenshtein(left(term, j - 1) || '#' || substr(term, j + 2), left(word, i - 1) || '#' || substr(word, i + 2)) <= 1)) > 0)) > 0"""
    return f"""{_index(['content'])},
asked AS (SELECT item_id AS query_id, c, lower(split_part(text, ' ', c + 1)) AS word, 2 - c AS most FROM benchmark, (VALUES (0), (1)) v(c)),
wanted AS (SELECT DISTINCT word, most FROM asked WHERE word <> ''),
letters AS (SELECT DISTINCT unnest(regexp_extract_all(w, '[^\\x00-\\x7F]')) AS ch FROM (SELECT term AS w FROM dict UNION ALL SELECT word FROM wanted)),
marks AS (SELECT coalesce(string_agg(ch, '' ORDER BY ch), '') AS odd, left('{marks}', count(*)) AS mark FROM letters),
pairs AS (SELECT field, term AS t, df, word AS w, most, translate(term, odd, mark) AS term, translate(word, odd, mark) AS word
  FROM dict JOIN wanted ON abs(length(term) - length(word)) <= 2, marks),
near AS (SELECT field, t AS term, df, w AS word, most, CASE WHEN term = word THEN 0 WHEN damerau_levenshtein(term, word) = 1 THEN 1
  WHEN levenshtein(term, word) = 2 THEN 2 WHEN levenshtein(term, word) <= 4 AND {swaps} THEN 2 END AS d FROM pairs),
close AS (SELECT *, CASE WHEN d = 0 THEN 1.0 ELSE 1.0 - d / least(length(term), length(word)) END AS w FROM near WHERE d <= most),
shared AS (SELECT field, term, word, most, w, max(df) OVER (PARTITION BY field, word, most) AS df FROM close WHERE w > 0)
SELECT query_id, doc_id, round(sum(w * {OK}), 6) AS score
FROM asked JOIN shared USING (word, most) JOIN post USING (field, term) JOIN stats USING (field) GROUP BY query_id, doc_id"""


def _fuzzy(word: str, fields=FIELDS) -> str:
    """Up to two edits, a swap being one edit that leaves its pair alone.

    A swap is fixed by writing one mark for the pair on either side; one more
    edit may then be left between the marked words.
    """
    swaps = " OR ".join(
        f"len(list_filter(range(1, length(term)), lambda j: substr(term, j, 2) = {_q(word[i + 1] + word[i])} "
        f"AND damerau_levenshtein(left(term, j - 1) || '#' || substr(term, j + 2), "
        f"{_q(word[:i] + '#' + word[i + 2 :])}) <= 1)) > 0"
        for i in range(len(word) - 1)
    )
    return f"""{_index(fields)},
near AS (SELECT *, CASE WHEN term = {_q(word)} THEN 0 WHEN damerau_levenshtein(term, {_q(word)}) = 1 THEN 1
  WHEN levenshtein(term, {_q(word)}) = 2 OR {swaps} THEN 2 END AS d
  FROM dict WHERE abs(length(term) - {len(word)}) <= 2),
close AS (SELECT *, CASE WHEN d = 0 THEN 1.0 ELSE 1.0 - d / least(length(term), {len(word)}) END AS w
  FROM near WHERE d IS NOT NULL),
best AS (SELECT * FROM close WHERE w > 0),
shared AS (SELECT field, term, w, max(df) OVER (PARTITION BY field) AS df FROM best)
SELECT doc_id, round(sum(w * {OK}), 6) AS score
FROM shared JOIN post USING (field, term) JOIN stats USING (field) GROUP BY doc_id"""


# -- pages ------------------------------------------------------------------


def _tidy(expr: str) -> str:
    # Named entities of the test pages; an ampersand comes last.
    for name, char in (("lt;", "<"), ("gt;", ">"), ("quot;", '"'), ("copy;", "©"), ("middot;", "·"),
                       ("nbsp;", " "), ("amp;", "&")):
        expr = f"replace({expr}, '&{name}', {_q(char)})"
    expr = f"regexp_replace({expr}, '&amp$', '&')"
    return f"trim(regexp_replace(regexp_replace({expr}, {_q(H.INVISIBLE)}, '', 'g'), {_q(H.SPACE)}, ' ', 'g'))"


def _sub(expr: str, pattern: str, by: str) -> str:
    return f"regexp_replace({expr}, {_q(_re2(pattern))}, {_q(by)}, 'g')"


PAGE_TITLE = _tidy(f"regexp_extract(html, {_q(_re2(H.TITLE))}, 1)")


def _page_body() -> str:
    expr = _sub(_sub("html", H.HIDDEN, " "), H.COMMENT, "")
    expr = _sub(_sub(expr, H.UP_TO_BODY, ""), H.HEAD, " ")
    return _tidy(_sub(_sub(expr, H.BLOCK, " "), H.OTHER_TAG, ""))


PAGE_BODY = _page_body()
NAME = "lower(regexp_extract({0}, '[^/]*$'))"
HTML_NAME = "regexp_matches(" + NAME + ", '[.]html?$')"

PAGE_DOCS = f"""docs AS (
  SELECT page_id AS doc_id, url AS path,
    CASE WHEN {HTML_NAME.format('url')} THEN {PAGE_TITLE} ELSE regexp_extract(url, '[^/]*$') END AS title,
    CASE WHEN {HTML_NAME.format('url')} THEN {PAGE_BODY} ELSE html END AS content
  FROM pages)"""

# -- changes ----------------------------------------------------------------

PREVIOUS = f"""WITH {DOCS},
cur AS (SELECT path, title, md5(content) AS content_md5 FROM docs),
prev AS (
  SELECT source || '/' || doc_id || '.txt' AS path, doc_id || '.txt' AS title,
    CASE WHEN lang = 'fr' THEN md5(text || 'x') ELSE md5(text) END AS content_md5
  FROM documents WHERE lang <> 'es'
  UNION ALL
  SELECT 'ghost/' || source || '/' || doc_id || '.txt', doc_id || '.txt', md5(text)
  FROM documents WHERE lang = 'de'),
states AS (SELECT path, CASE WHEN p.path IS NULL THEN 'NEW' WHEN c.path IS NULL THEN 'REMOVED'
  WHEN p.content_md5 = c.content_md5 THEN 'KNOWN' ELSE 'UPDATE' END AS state
  FROM cur c FULL JOIN prev p USING (path))"""


BATCH_WORDS = f"""qlists AS (SELECT item_id, {_words('text')} AS ws FROM benchmark),
qtokens AS (SELECT item_id, unnest(ws) AS word FROM qlists),
qkept AS (SELECT item_id, word FROM qtokens WHERE word NOT IN {STOP}),"""


def _batch(more_words: str) -> str:
    """The best ten documents for each row of the words' table."""
    return f"""{_index(FIELDS, more_words=more_words)},
qterms AS (SELECT item_id AS query_id, stem AS term, count(*) AS w FROM qkept JOIN stems USING (word) GROUP BY ALL),
total AS (SELECT query_id, doc_id, round(sum(w * {OK}), 6) AS score
  FROM qterms JOIN post USING (term) JOIN dict USING (field, term) JOIN stats USING (field) GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM total QUALIFY rank <= 10"""


def _batch_words(text: str) -> str:
    return BATCH_WORDS.replace(_words("text"), _words(text))


# Clauses by number: 0, 1 and 3 are in a group, 4 is the whole text; 5 stands for the phrase, one place after the other.
BOOL_WORDS = f"""qsplit AS (SELECT item_id, text, string_split(text, ' ') AS w FROM benchmark),
qtexts AS (SELECT item_id, 0 AS c, w[1] AS t FROM qsplit UNION ALL SELECT item_id, 1, w[2] FROM qsplit
  UNION ALL SELECT item_id, 3, w[4] FROM qsplit UNION ALL SELECT item_id, 2, w[5] FROM qsplit
  UNION ALL SELECT item_id, 4, text FROM qsplit
  UNION ALL SELECT item_id, 5, coalesce(w[1], '') || ' ' || coalesce(w[2], '') FROM qsplit),
qlists AS (SELECT item_id, c, {_words("coalesce(t, '')")} AS ws FROM qtexts),
qtokens AS (SELECT item_id, c, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM qlists),
qkept AS (SELECT item_id, c, word, pos FROM qtokens WHERE word NOT IN {STOP}),"""

BATCH_BOOL = f"""{_index(("content",), more_words=BOOL_WORDS)},
qpos AS (SELECT item_id, c, stem AS term, pos - min(pos) OVER (PARTITION BY item_id, c) AS shift,
  count(*) OVER (PARTITION BY item_id, c) AS n_terms FROM qkept JOIN stems USING (word)),
qterms AS (SELECT item_id, c, term, count(*) AS w FROM qpos WHERE c <> 5 OR n_terms = 1 GROUP BY ALL),
starts AS (SELECT item_id, doc_id, field, terms.pos - shift AS at, any_value(n_terms) AS n_terms, count(DISTINCT shift) AS met
  FROM qpos JOIN terms USING (term) WHERE c = 5 AND n_terms > 1 GROUP BY ALL),
freq AS (SELECT item_id, doc_id, field, count(*) AS tf FROM starts WHERE met = n_terms GROUP BY ALL),
pidf AS (SELECT item_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5))) AS idf FROM qpos JOIN dict USING (term) JOIN stats USING (field)
  WHERE c = 5 GROUP BY item_id),
hit AS (SELECT item_id, c, doc_id, sum(w * {OK}) AS score
  FROM qterms JOIN post USING (term) JOIN dict USING (field, term) JOIN stats USING (field) GROUP BY ALL
  UNION ALL
  SELECT item_id, 5, doc_id, idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl_q / avgdl))
  FROM freq JOIN pidf USING (item_id) JOIN dls USING (field, doc_id) JOIN stats USING (field)),
grouped AS (SELECT DISTINCT item_id, true AS inner_there FROM qpos WHERE c IN (0, 1, 3)),
per AS (SELECT item_id, doc_id, list(c) AS cs,
  sum(score * CASE WHEN c IN (0, 1) THEN 2 WHEN c = 4 THEN 0.5 WHEN c = 5 THEN 1 ELSE 0 END) AS score FROM hit GROUP BY ALL)
SELECT item_id AS query_id, doc_id, round(score, 6) AS score FROM per LEFT JOIN grouped USING (item_id)
WHERE NOT list_contains(cs, 2) AND CASE WHEN inner_there
  THEN (list_contains(cs, 0) OR list_contains(cs, 1)) AND NOT list_contains(cs, 3)
  ELSE list_contains(cs, 4) OR list_contains(cs, 5) END"""


def oracle_sql() -> dict[str, str]:
    both = FIELDS
    return {
        # sources
        "scan_tree": f"SELECT {TREE_PATH} AS path, octet_length(encode(coalesce(text, ''))) AS length, md5(coalesce(text, '')) AS content_md5 FROM documents WHERE doc_id % 7 <> 0",
        "sync_stamps": f"""SELECT {TREE_PATH} AS path, CASE doc_id % 11 WHEN 1 THEN 'NEW' WHEN 2 THEN 'UPDATE' ELSE 'REMOVED' END AS state
FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 IN (1, 2, 3)""",
        "scan_ext_filter": f"SELECT page_id, url AS path FROM pages WHERE regexp_matches({NAME.format('url')}, '[.](txt|html?)$')",
        "route_by_type": f"""SELECT page_id, url AS path, CASE WHEN {NAME.format('url')} LIKE '%.html' THEN '.html'
  WHEN {NAME.format('url')} LIKE '%.htm' THEN '.htm' ELSE 'plain' END AS route FROM pages""",
        "plain_docs": f"WITH {DOCS} SELECT doc_id, path, title, content FROM docs",
        "html_text": f"SELECT page_id, {PAGE_TITLE} AS title, {PAGE_BODY} AS content FROM pages",
        "extractor_routes": f"""SELECT url AS path, CASE WHEN {HTML_NAME.format('url')} THEN {PAGE_TITLE}
    ELSE regexp_extract(url, '[^/]*$') END AS title,
  length(CASE WHEN {HTML_NAME.format('url')} THEN {PAGE_BODY} ELSE html END) AS n_chars FROM pages
UNION ALL SELECT source || '/' || doc_id || '.txt', trim(split_part(text, chr(10), 1)), length(text) FROM documents""",
        "content_md5": "SELECT doc_id, md5(text) AS content_md5 FROM documents",
        # changes
        "change_states": f"{PREVIOUS} SELECT path, state FROM states",
        "change_counts": f"{PREVIOUS} SELECT state, count(*) AS n FROM states GROUP BY state",
        "removed_paths": f"{PREVIOUS} SELECT path FROM states WHERE state = 'REMOVED'",
        "upsert_docs": f"{PREVIOUS} SELECT path, title, content_md5 FROM cur",
        "keyword_filter": f"""WITH {DOCS} SELECT doc_id, path FROM docs
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
        "manifest_roundtrip": f"WITH {DOCS} SELECT path, md5(content) AS content_md5 FROM docs",
        "index_roundtrip": f"{_index(both)} SELECT field, term, doc_id, tf, dl, dl_q FROM post",
        "sync_full": f"{_index(both)} SELECT field, term, df, CAST(ttf AS BIGINT) AS ttf FROM dict",
        "stream_ingest": f"WITH {DOCS} SELECT path, title, md5(content) AS content_md5 FROM docs",
        "stream_late": f"""{_index(both, DOCS.replace("FROM documents", "FROM documents WHERE lang IS NOT NULL AND lang <> 'fr'"))}
SELECT field, term, df, CAST(ttf AS BIGINT) AS ttf FROM dict""",
        # analysis
        "tokens": f"WITH {PLAIN_TOKENS} SELECT doc_id, pos, word FROM tokens",
        "tokens_nostop": f"WITH {PLAIN_TOKENS} SELECT doc_id, pos, word FROM tokens WHERE word NOT IN {STOP}",
        "stems": f"""WITH {PLAIN_TOKENS}, vocab AS (SELECT word, count(*) AS n FROM tokens GROUP BY word),
{_stems()} SELECT word, stem, n FROM stems JOIN vocab USING (word)""",
        "normalised_terms": f"WITH {PLAIN_TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word",
        # index
        "postings": f"""{_index(both)} SELECT field, term, doc_id, tf, list_aggregate(positions, 'string_agg', ' ') AS positions
FROM post""",
        "doc_lengths": f"{_index(both)} SELECT field, doc_id, dl FROM lengths",
        "length_quantised": f"{_index(both)} SELECT field, doc_id, dl, dl_q FROM dls",
        "field_stats": f"""{_index(both)} SELECT field, n AS doc_count, CAST(total AS BIGINT) AS sum_dl,
  round(avgdl, 6) AS avgdl FROM stats""",
        "term_dictionary": f"{_index(both)} SELECT field, term, df, CAST(ttf AS BIGINT) AS ttf FROM dict",
        # ranking
        "bm25_topk": _top([(0, "thing", 1), (0, "from", 1), (0, "nation", 1)]),
        "tfidf_topk": _top([(0, "thing", 1), (0, "from", 1), (0, "nation", 1)], VS),
        "bm25_multifield": _top([(0, "thing", 1), (0, "from", 1), (0, "42", 1)], OK, both),
        "batch_topk": _batch(BATCH_WORDS),
        "batch_topk_bounded": _batch(_batch_words("array_to_string(string_split(text, ' ')[1:5], ' ')")),
        "batch_bool": BATCH_BOOL,
        "fuzzy_batch": _fuzzy_batch(),
        "ranked_results": f"""{_index(both, PAGE_DOCS)}, {_clauses([(0, 'tion', 1), (0, 'html', 1), (0, 'from', 1)])}, {_scored()},
total AS (SELECT doc_id, round(sum(score), 6) AS score FROM hit GROUP BY doc_id),
best AS (SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM total ORDER BY score DESC, doc_id LIMIT 20)
SELECT rank, score, regexp_extract(path, '[^/]*$') AS file_name,
  CASE WHEN {HTML_NAME.format('path')} THEN title END AS display_title, path
FROM best JOIN docs USING (doc_id)""",
        "stored_fields": _top([(0, "thing", 1)]).replace("\nSELECT row_number", ", best AS (SELECT row_number")
        + ") SELECT rank, doc_id, path, title FROM best JOIN docs USING (doc_id)",
        "no_hits": f"{_index(both)} SELECT doc_id, CAST(tf AS DOUBLE) AS score FROM post WHERE term = 'zzzznothere'",
        # boolean
        "bool_should": _bool([(0, "thing", 1), (1, "nation", 1)], "true"),
        "bool_must": _bool([(0, "thing", 1), (1, "from", 1), (2, "re", 1)],
                           "list_contains(cs, 0) AND list_contains(cs, 1)"),
        "bool_must_not": _bool([(0, "thing", 1), (1, "from", 1)], "list_contains(cs, 0) AND NOT list_contains(cs, 1)",
                               "c = 0"),
        "bool_nested": f"""{_index(both)},
{_clauses([(0, 'thing', 1), (1, 'from', 2), (2, 're', 2), (3, 'ed', 2), (4, 'er', 1)])}, {_scored()},
per AS (SELECT doc_id, list(c) AS cs FROM hit GROUP BY doc_id),
ok AS (SELECT *, (list_contains(cs, 1) AND list_contains(cs, 2) AND NOT list_contains(cs, 3)) AS inner_ok FROM per)
SELECT doc_id, round(sum(score) FILTER (WHERE c = 0 OR (inner_ok AND c IN (1, 2))), 6) AS score
FROM hit JOIN ok USING (doc_id)
WHERE (list_contains(cs, 0) OR inner_ok) AND NOT list_contains(cs, 4)
GROUP BY doc_id""",
        "repeated_term": _bool([(0, "thing", 2), (0, "from", 1)], "true"),
        "boost": _bool([(0, "thing", 2.5), (1, "from", 0.5)], "true"),
        # phrases
        "phrase": _phrase([(0, "re"), (1, "ed")]),
        "phrase_gap": _phrase([(0, "er"), (2, "re")]),
        "phrase_slop": _sloppy("from", "ed", 3),
        # terms of the dictionary
        "prefix": _constant("starts_with(term, 'tion')"),
        "wildcard": _constant("regexp_matches(term, '^th.n.*ed$')", 1.5),
        "regexp": _constant("regexp_matches(term, '^(th(re|an)+ing?)$')"),
        "term_range": _constant("term >= 'thing' AND term < 'thou'"),
        "constant_score": _constant("starts_with(term, '4')", 3.0),
        "fuzzy": _fuzzy("thingre"),
        "match_all": f"WITH {DOCS} SELECT doc_id, CAST(1.0 AS DOUBLE) AS score FROM docs",
        "exact_path": f"WITH {DOCS} SELECT doc_id, path, title FROM docs WHERE path = (SELECT min(path) FROM docs)",
    }
