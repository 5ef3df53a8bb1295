"""SQL for the license scan, the lexical search and the spelling variants."""

from __future__ import annotations

from lexiframe.llm import license_scan

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _values(pairs: list[tuple[str, str]], first: int) -> str:
    return ", ".join(f"({first + i}, '{label}', '{text}')" for i, (label, text) in enumerate(pairs))


LICENSE_SCAN = rf"""
WITH own AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), grams AS (
  SELECT r, i - 1 AS d, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM own WHERE len(w) >= 3)
), phrases(t, label, text) AS (VALUES {_values(license_scan.PHRASES, 0)}),
notices(t, label, text) AS (VALUES {_values(license_scan.TEMPLATES, len(license_scan.PHRASES))}),
templates AS (
  SELECT t, label, string_split(text, ' ') AS v, true AS phrase FROM phrases
  UNION ALL SELECT t, label, string_split(text, ' '), false FROM notices
), runs AS (
  SELECT t, label, phrase, len(v) AS n, j - 1 AS p, array_to_string(v[j:j + 2], ' ') AS g
  FROM (SELECT t, label, phrase, v, unnest(range(1, len(v) - 1)) AS j FROM templates)
), votes AS (SELECT r, t, label, phrase, n, d - p AS diag, p FROM grams JOIN runs USING (g)),
base AS (
  SELECT r, label, diag FROM votes WHERE phrase GROUP BY r, t, label, n, diag HAVING count(*) = n - 2
), diagonals AS (SELECT DISTINCT r, t, diag FROM votes WHERE NOT phrase),
marked AS (
  SELECT *, coalesce(diag - lag(diag) OVER (PARTITION BY r, t ORDER BY diag) > {license_scan.DRIFT}, true)::INT AS fresh
  FROM diagonals
), chained AS (SELECT r, t, diag, sum(fresh) OVER (PARTITION BY r, t ORDER BY diag) AS c FROM marked),
wide AS (
  SELECT v.r, v.t, v.label, v.n, v.diag, v.p, c,
         max(v.diag + p + 3) OVER (PARTITION BY v.r, v.t, c) - min(v.diag + p) OVER (PARTITION BY v.r, v.t, c)
           > {license_scan.STRETCH} * n AS alone
  FROM votes v JOIN chained h ON v.r = h.r AND v.t = h.t AND v.diag = h.diag
), covered AS (
  SELECT r, t, label, n, c, own_diag, count(DISTINCT q) / n AS share
  FROM (SELECT r, t, label, n, c, CASE WHEN alone THEN diag END AS own_diag, unnest([p, p + 1, p + 2]) AS q FROM wide)
  GROUP BY r, t, label, n, c, own_diag
), named AS (
  SELECT r, label, 1.0::DOUBLE AS share FROM base
  UNION ALL SELECT r, label, share FROM covered WHERE share >= {license_scan.COVERAGE}
), per_base AS (
  SELECT r, count(*) AS n_base, min(diag)::BIGINT AS first_word, max(diag)::BIGINT AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY r
), per_row AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM named GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM own LEFT JOIN per_base USING (r) LEFT JOIN per_row USING (r)
"""

LEXICAL_SEARCH = rf"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), counted AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS length FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, whole GROUP BY term, documents
), scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * documents) // length))))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (doc_id), whole
  GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

SPELLING = rf"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_FOLD}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
         ELSE [192 | (unicode(x) >> 6), 128 | (unicode(x) & 63)]::BIGINT[] END)) AS b
  FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                   ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), one AS (
  SELECT DISTINCT s.word AS a, s.n AS an, w.word AS b, w.n AS bn FROM shorter s JOIN words w ON s.d = w.word
), pairs AS (
  SELECT a AS word, an AS n, b AS other, bn AS other_n FROM one
  UNION ALL SELECT b, bn, a, an FROM one
  UNION ALL SELECT s.word, s.n, o.word, o.n FROM shorter s JOIN shorter o ON s.d = o.d AND s.i = o.i AND s.word <> o.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS form, max(other_n) AS form_n
  FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
         CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM forms
  UNION ALL
  SELECT c.word, coalesce(f.form, c.root), f.form IS NULL FROM chain c JOIN forms f ON f.word = c.root WHERE NOT c.done
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM chain WHERE done) USING (word)
"""
