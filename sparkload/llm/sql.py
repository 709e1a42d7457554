"""DuckDB SQL that must give the rows of the queries it is named after."""

from __future__ import annotations

from .licenses import BLOCK_LINES, BODIES, FILE_SHARE, LEAST_SIMILARITY, LEAST_WHOLE, MARKERS, TEMPLATES, terms_of
from .neardup import SHINGLE, THRESHOLD
from .spans import ENDS, LEAST_WORDS, LONGEST_PART, RUN, UNSPACED, WINDOW


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TEMPLATE_ROWS = ", ".join(
    f"({k}, {k >= len(TEMPLATES)}, {_text(licence)}, {_text(t)}, {terms_of(text).count(t)})"
    for k, (licence, text) in enumerate((*TEMPLATES, *BODIES))
    for t in sorted(set(terms_of(text)))
)
_MARKED = "(^|[^a-z0-9])(" + "|".join(MARKERS) + ")($|[^a-z0-9])"
_TERMS = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"

LICENCES = f"""
WITH template(k, whole, licence, term, n) AS (VALUES {_TEMPLATE_ROWS}),
docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce(source, '') || '/' || coalesce(lang, '') AS directory,
         {_TERMS.format("coalesce(text, '')")} AS words
  FROM documents),
total AS (SELECT count(*) AS n FROM docs),
df AS (
  SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(words)) AS term FROM docs)
  WHERE term IN (SELECT term FROM template) GROUP BY term),
idf AS (
  SELECT t.term, ln((1 + total.n) / (1 + coalesce(df.df, 0))) AS w
  FROM (SELECT DISTINCT term FROM template) t CROSS JOIN total LEFT JOIN df USING (term)),
template_weight AS (SELECT k, whole, licence, term, t.n * w AS w FROM template t JOIN idf USING (term)),
template_length AS (SELECT k, sqrt(sum(w * w)) AS length FROM template_weight GROUP BY k),
marked AS (
  SELECT row, text, string_split(regexp_replace(text, '([.!?;])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)) AS lines
  FROM docs WHERE regexp_matches(lower(text), {_text(_MARKED)})),
marks AS (SELECT *, list_transform(lines, lambda x: regexp_matches(lower(x), {_text(_MARKED)})) AS m FROM marked),
begins AS (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM marks),
reaches AS (SELECT *, unnest(range({BLOCK_LINES})) AS reach FROM begins),
units AS (
  SELECT row, false AS whole, array_to_string(lines[i:i + reach], ' ') AS text FROM reaches
  WHERE i + reach <= len(lines) AND list_contains(m[i:i + reach], true)
  UNION ALL SELECT row, true, text FROM marked),
numbered AS (SELECT *, row_number() OVER () AS unit FROM units),
counted AS (
  SELECT row, unit, whole, term, count(*) AS n
  FROM (SELECT row, unit, whole, unnest({_TERMS.format("text")}) AS term FROM numbered) GROUP BY row, unit, whole, term),
vector AS (
  SELECT row, unit, whole, term, counted.n, counted.n * w AS w, pow(ln(1 + total.n), 2) AS strange
  FROM counted CROSS JOIN total LEFT JOIN idf USING (term)),
length AS (SELECT unit, sqrt(sum(coalesce(w * w, n * strange))) AS length, sum(n) AS n_words FROM vector GROUP BY unit),
cosine AS (
  SELECT v.row, v.unit, v.whole, t.k, t.licence, l.n_words, round(sum(v.w * t.w) / (l.length * tl.length), 6) AS similarity
  FROM vector v JOIN template_weight t ON t.term = v.term AND t.whole = v.whole JOIN length l USING (unit) JOIN template_length tl USING (k)
  GROUP BY v.row, v.unit, v.whole, t.k, t.licence, l.n_words, l.length, tl.length),
best AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY similarity DESC, k, n_words DESC) AS r
  FROM cosine WHERE similarity >= CASE WHEN whole THEN {LEAST_WHOLE} ELSE {LEAST_SIMILARITY} END),
own AS (
  SELECT d.doc_id, d.directory, b.licence, b.similarity, coalesce(b.whole OR b.n_words / len(d.words) >= {FILE_SHARE}, false) AS is_file
  FROM docs d LEFT JOIN best b ON b.row = d.row AND b.r = 1),
files AS (
  SELECT directory, licence FROM (
    SELECT *, row_number() OVER (PARTITION BY directory ORDER BY similarity DESC, doc_id, licence DESC) AS r FROM own WHERE is_file) WHERE r = 1),
parts AS (SELECT DISTINCT directory, string_split(directory, '/') AS p FROM own),
depths AS (SELECT *, unnest(range(len(p) + 1)) AS depth FROM parts),
above AS (SELECT directory, depth, array_to_string(p[1:depth], '/') AS above FROM depths),
nearest AS (
  SELECT a.directory, a.above, f.licence, row_number() OVER (PARTITION BY a.directory ORDER BY a.depth DESC) AS r
  FROM above a JOIN files f ON f.directory = a.above)
SELECT o.doc_id, coalesce(o.licence, n.licence) AS licence, o.similarity,
       CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN n.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.licence IS NULL THEN n.above END AS directory
FROM own o LEFT JOIN nearest n ON n.directory = o.directory AND n.r = 1
"""

_WORD_LIST = r"list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '[!-/:-@\[-`{-~]', ' ', 'g'), '\s+'), lambda x: x <> '')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, text, {_WORD_LIST} AS w FROM documents WHERE doc_id IS NOT NULL),
prints AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN chr(1) || coalesce(text, '') ELSE array_to_string(w, ' ') END AS print, w FROM docs),
reps AS (SELECT print, min(doc_id) AS rep, any_value(w) AS w FROM prints GROUP BY print),
shingles AS (
  SELECT rep, unnest(CASE WHEN len(w) BETWEEN 1 AND {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END) AS s
  FROM reps WHERE len(w) > 0),
sets AS (SELECT rep, s, count(*) AS n FROM shingles GROUP BY rep, s),
sizes AS (SELECT rep, sum(n) AS size FROM sets GROUP BY rep),
common AS (
  SELECT a.rep AS a, b.rep AS b, sum(least(a.n, b.n)) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.rep < b.rep GROUP BY a.rep, b.rep),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.rep = a JOIN sizes y ON y.rep = b WHERE n >= {THRESHOLD} * (x.size + y.size - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
  SELECT rep, rep FROM reps UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b),
classes AS (SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY a)
SELECT p.doc_id, c.class_id FROM prints p JOIN reps USING (print) JOIN classes c USING (rep)
"""

_ENDS = "".join("\\n" if c == "\n" else c for c in ENDS)
_UNSPACED = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in UNSPACED)
_ALNUM = "\\p{L}\\p{N}"

REPEATS = f"""
WITH sentences AS (
  SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{_ENDS}]*[{_ENDS}]+[ \\t\\r\\n\\f\\v\\x{{3000}}]*|[^{_ENDS}]+') AS parts FROM documents)),
worded AS (
  SELECT doc_id, i, part, regexp_extract_all(regexp_replace(part, '([{_UNSPACED}])', chr(1) || '\\1' || chr(1), 'g'),
    '[^{_ALNUM}]*[{_ALNUM}]+(?:[^{_ALNUM}]+$)?') AS tokens
  FROM sentences),
short AS (
  SELECT doc_id, i, 0 AS piece, part, list_transform(tokens, lambda x: lower(regexp_extract(x, '[{_ALNUM}]+'))) AS words
  FROM worded WHERE len(tokens) <= {LONGEST_PART}),
tokens AS (
  SELECT doc_id, i, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS p, len(tokens) AS n
  FROM worded WHERE len(tokens) > {LONGEST_PART}),
hashed AS (SELECT *, lower(regexp_extract(token, '[{_ALNUM}]+')) AS word FROM tokens),
windows AS (
  SELECT *, min(word || chr(1) || lpad(CAST(100000000 - p AS VARCHAR), 9, '0'))
    OVER (PARTITION BY doc_id, i ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS least FROM hashed),
cuts AS (
  SELECT DISTINCT doc_id, i, 100000000 - CAST(right(least, 9) AS BIGINT) AS p FROM windows WHERE p <= n - {WINDOW - 1}),
pieced AS (
  SELECT h.*, coalesce(count(c.p) OVER (PARTITION BY h.doc_id, h.i ORDER BY h.p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece
  FROM hashed h LEFT JOIN cuts c ON c.doc_id = h.doc_id AND c.i = h.i AND c.p = h.p),
parts AS (
  SELECT doc_id, i, piece, part, words FROM short
  UNION ALL
  SELECT doc_id, i, piece, replace(string_agg(token, '' ORDER BY p), chr(1), ''), list(word ORDER BY p) FROM pieced GROUP BY doc_id, i, piece),
holding AS (
  SELECT doc_id, i, piece, array_to_string(words, ' ') AS s, len(words) AS n, row_number() OVER w AS k, sum(len(words)) OVER w AS total
  FROM parts WHERE len(words) > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY i, piece)),
spans AS (
  SELECT a.doc_id, a.k, min(b.k) AS last
  FROM holding a JOIN holding b ON b.doc_id = a.doc_id AND b.k BETWEEN a.k + {RUN - 1} AND a.k + {max(RUN, LEAST_WORDS) - 1}
  WHERE b.total - a.total + a.n >= {LEAST_WORDS} GROUP BY a.doc_id, a.k),
runs AS (
  SELECT s.doc_id, s.k, s.last, string_agg(h.s, chr(1) ORDER BY h.k) AS run
  FROM spans s JOIN holding h ON h.doc_id = s.doc_id AND h.k BETWEEN s.k AND s.last GROUP BY s.doc_id, s.k, s.last),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS r FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, last + 1)) AS k FROM ranked WHERE r > 1),
lost AS (SELECT h.doc_id, h.i, h.piece FROM holding h JOIN gone USING (doc_id, k)),
kept AS (
  SELECT p.doc_id, string_agg(CASE WHEN l.i IS NULL THEN p.part ELSE '' END, '' ORDER BY p.i, p.piece) AS text, count(l.i) AS n_removed
  FROM parts p LEFT JOIN lost l ON l.doc_id = p.doc_id AND l.i = p.i AND l.piece = p.piece GROUP BY p.doc_id),
had AS (SELECT doc_id, count(*) AS n FROM holding GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.text, '') AS text, CAST(coalesce(h.n, 0) AS BIGINT) AS n_sentences, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN had h USING (doc_id)
"""
