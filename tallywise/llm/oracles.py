"""SQL twins of the corpus queries that SQL can express.

The others are compared with brute force in the tests: SQL has neither XXH64, CRC-32 and the
tokenizer nor the learned models and the tree of a page.
"""

#: Overlaps of a document with a benchmark item; constants stand as in the operator's contract.
DECONTAMINATION = r"""
WITH item AS (
  SELECT min(item_id) AS item_id, tk FROM (
    SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS tk FROM benchmark) GROUP BY tk),
word AS (
  SELECT doc_id, unnest(tk) AS w, generate_subscripts(tk, 1) - 1 AS k FROM (
    SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS tk FROM documents)),
item_word AS (SELECT item_id, len(tk) AS n, unnest(tk) AS w, generate_subscripts(tk, 1) - 1 AS k FROM item),
item_row AS (
  SELECT item_id, n, k, [w, lead(w, 1) OVER v, lead(w, 2) OVER v, lead(w, 3) OVER v, lead(w, 4) OVER v,
                         lead(w, 5) OVER v, lead(w, 6) OVER v, lead(w, 7) OVER v, lead(w, 8) OVER v,
                         lead(w, 9) OVER v] AS s
  FROM item_word WINDOW v AS (PARTITION BY item_id ORDER BY k)),
doc_row AS (
  SELECT doc_id, k, [w, lead(w, 1) OVER v, lead(w, 2) OVER v, lead(w, 3) OVER v, lead(w, 4) OVER v,
                     lead(w, 5) OVER v, lead(w, 6) OVER v, lead(w, 7) OVER v, lead(w, 8) OVER v,
                     lead(w, 9) OVER v] AS s
  FROM word WINDOW v AS (PARTITION BY doc_id ORDER BY k)),
mask(m, p) AS (VALUES (0, [0, 1, 2, 3, 4, 5]), (1, [0, 1, 3, 4, 7, 8]),
                      (2, [0, 2, 3, 5, 8, 9]), (3, [0, 1, 4, 6, 7, 9])),
seed AS (
  SELECT m, s[p[1] + 1] || ' ' || s[p[2] + 1] || ' ' || s[p[3] + 1] || ' ' || s[p[4] + 1] || ' '
            || s[p[5] + 1] || ' ' || s[p[6] + 1] AS key, item_id, n, min(k) AS item_at
  FROM item_row, mask WHERE s[10] IS NOT NULL AND len(list_distinct(s)) >= 4 GROUP BY ALL),
probe AS (
  SELECT doc_id, k, m, s[p[1] + 1] || ' ' || s[p[2] + 1] || ' ' || s[p[3] + 1] || ' ' || s[p[4] + 1] || ' '
                       || s[p[5] + 1] || ' ' || s[p[6] + 1] AS key
  FROM doc_row, mask WHERE s[10] IS NOT NULL),
hit AS (SELECT DISTINCT doc_id, probe.k, item_id, n, item_at FROM probe JOIN seed USING (m, key)),
near AS (SELECT doc_id, item_id, n, k - item_at AS shift, unnest(range(k - 8, k + 18)) AS token FROM hit),
matched AS (
  SELECT DISTINCT near.doc_id, near.item_id, near.n, shift, token FROM near
  JOIN word ON word.doc_id = near.doc_id AND word.k = token
  JOIN item_word i ON i.item_id = near.item_id AND i.k = token - shift AND i.w = word.w),
parted AS (
  SELECT *, CASE WHEN token - lag(token) OVER v <= 3 THEN 0 ELSE 1 END AS new FROM matched
  WINDOW v AS (PARTITION BY doc_id, item_id, n, shift ORDER BY token)),
numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, item_id, n, shift ORDER BY token) AS run FROM parted),
run AS (
  SELECT doc_id, item_id, n, shift, run, max(token) + 1 - min(token) AS length, count(*) AS matched
  FROM numbered GROUP BY ALL)
SELECT doc_id, item_id, count(*) AS n_overlaps, max(length)::BIGINT AS longest, sum(matched)::BIGINT AS matched
FROM run WHERE length >= least(13, n) AND matched >= 0.8 * length GROUP BY doc_id, item_id
"""

LINE_WINDOWS = r"""
WITH line AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM (
    SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
mark AS (SELECT doc_id, k, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS a FROM line),
wide AS (
  SELECT doc_id, k, a, lead(a, 1) OVER v AS b, lead(a, 2) OVER v AS c FROM mark
  WINDOW v AS (PARTITION BY doc_id ORDER BY k)),
place AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS nth
  FROM wide WHERE c IS NOT NULL AND a || b || c <> ''),
gone AS (SELECT DISTINCT doc_id, unnest([k, k + 1, k + 2]) AS k FROM place WHERE nth > 1),
done AS (
  SELECT m.doc_id, count(*) AS n_lines, count(g.k) AS n_removed,
         coalesce(string_agg(m.line, chr(10) ORDER BY m.k) FILTER (g.k IS NULL), '') AS text
  FROM mark m LEFT JOIN gone g ON g.doc_id = m.doc_id AND g.k = m.k GROUP BY m.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, done.text
FROM documents d LEFT JOIN done ON done.doc_id = d.doc_id
"""

UNITS = r"""
WITH line AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM (
    SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \t]', '\1' || chr(10), 'g'), chr(10)) AS ls
    FROM documents WHERE text IS NOT NULL)),
placed AS (
  SELECT doc_id, line, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY k) - length(line) - 1)::BIGINT
         AS start FROM line),
unit AS (
  SELECT doc_id, start, start + length(line) AS "end", regexp_replace(lower(trim(
    line, ' ' || chr(9) || chr(11) || chr(12) || chr(13))), '[ \t\r\x0b\x0c]+', ' ', 'g') AS words FROM placed),
counted AS (SELECT *, length(words) - length(replace(words, ' ', '')) + 1 AS n FROM unit),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS unit FROM counted WHERE n >= 4),
ranked AS (
  SELECT *, first_value(doc_id) OVER v AS first_doc_id, first_value(start) OVER v AS first_start,
         row_number() OVER v AS nth
  FROM numbered WINDOW v AS (PARTITION BY words ORDER BY doc_id, start)),
parted AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM ranked WHERE nth > 1)
SELECT doc_id, min(start) AS start, max("end") AS "end", count(*) AS n_units, sum(n)::BIGINT AS n_words,
       arg_min(first_doc_id, start) AS first_doc_id, arg_min(first_start, start) AS first_start
FROM parted GROUP BY doc_id, run HAVING sum(n) >= 20
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
found AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(found.least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(found.least, vec_id)) AS kept
FROM embeddings LEFT JOIN found ON found.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

COLLOCATIONS = r"""
WITH doc AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
  FROM documents),
piece AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(ps) AS p FROM doc)),
place AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
  FROM piece, (VALUES (1), (2), (3), (4)) AS s(m) WHERE len(w) >= m),
counted AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM place GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30),
cut AS (
  SELECT lang, phrase, f AS a, w, k FROM (SELECT *, unnest(range(1, m)) AS k FROM often WHERE m > 1)),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, 2000000::HUGEINT * a // (x.f + y.f) AS score
  FROM cut c JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrase AS (
  SELECT lang, f, array_to_string(w[i:i + s - 1], ' ') AS phrase FROM (
    SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM often WHERE m > 2))),
covered AS (SELECT lang, phrase, max(f) AS f FROM inner_phrase GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN covered c ON c.lang = b.lang AND c.phrase = b.phrase
  WHERE c.f IS NULL OR 100 * c.f < 80 * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT k.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked k JOIN total t ON t.lang = k.lang
WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": DECONTAMINATION,
    "op6_line_window_dedup": LINE_WINDOWS,
    "op7_unit_dedup": UNITS,
    "op8_multi_index_near_dedup": EMBEDDINGS,
    "op13_suffix_collocations": COLLOCATIONS,
}
