"""DuckDB SQL of the operators that SQL can express, written apart from the Spark code."""

from __future__ import annotations

#: op3: words, 10-word windows of both sides joined on their text, words inside hit windows
DECONTAMINATE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size,
              array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS g
       FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS g
       FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE len(w) >= size),
hits AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.size = bw.size),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL)
          GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: op7: base measures by words and lines, then the moment estimate of the beta prior over the sources
QUALITY = r"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
        FROM w, unnest(range(1, len(w) - 6)) AS t(i) WHERE len(w) >= 8),
twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT win.doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, g)) GROUP BY doc_id),
base AS (SELECT w.doc_id, source, CAST(len(w.w) AS BIGINT) AS n_words,
                CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
                CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
                CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
                CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
         FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS f
          FROM failed GROUP BY source),
tot AS (SELECT sum(n) AS big_n, sum(f) / sum(n) AS m, count(*) AS k, sum(n * n) AS nn, sum(f * f / n) AS npp FROM hosts),
rho AS (SELECT m, CASE WHEN m * (1 - m) <= 0 OR big_n - nn / big_n - (k - 1) <= 0 THEN 0
                  ELSE ((npp - big_n * m * m) / (m * (1 - m)) - (k - 1)) / (big_n - nn / big_n - (k - 1)) END AS r FROM tot),
prior AS (SELECT m, CASE WHEN r <= 0 THEN 1e6 ELSE least(1e6, greatest(1e-3, 1 / r - 1)) END AS s FROM rho),
rate AS (SELECT source, (f + s * m) / (n + s) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_rate <= 0.5 AS kept, host_rate
FROM failed JOIN rate ON failed.source IS NOT DISTINCT FROM rate.source
"""

#: op8: distinct shingles, shared counts, links, then the smallest id reachable
JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
      FROM w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common_n
           FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT u, v FROM shared JOIN n AS x ON x.doc_id = u JOIN n AS y ON y.doc_id = v
         WHERE 100 * common_n >= 80 * (x.n + y.n - common_n)),
sym AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, sym.v FROM reach AS r JOIN sym ON r.v = sym.u)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents AS d LEFT JOIN n USING (doc_id) JOIN (SELECT u, min(v) AS component_id FROM reach GROUP BY u) AS m ON m.u = d.doc_id
"""


#: op11: line keys, their documents, lines of repeated keys outside the first document
LINES = r"""
WITH l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
           FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS t(i)),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT doc_id, i, line, first_doc IS NOT NULL AND first_doc <> doc_id AS lost FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


#: op12: every anchor against every row, ranked
NEGATIVES = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e AS a, e AS b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own
       AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


#: op13: all n-grams counted by text, every cut scored in whole numbers, covered phrases dropped, ranked
COLLOCATIONS = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (SELECT lang, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
      FROM w, unnest(range(1, 5)) AS a(n), unnest(range(1, len(w) - n + 2)) AS b(i)),
f AS (SELECT lang, n, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
tot AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, n AS size, string_split(phrase, ' ') AS w FROM f WHERE n > 1),
k AS (SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS lp,
             array_to_string(list_slice(w, k + 1, size), ' ') AS rp FROM c, unnest(range(1, size)) AS t(k)),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r,
             CAST((2000000::HUGEINT * k.a) // (x.f::HUGEINT + y.f::HUGEINT) AS BIGINT) AS score
      FROM k JOIN f AS x ON x.lang = k.lang AND x.phrase = k.lp JOIN f AS y ON y.lang = k.lang AND y.phrase = k.rp),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT DISTINCT c.lang, array_to_string(list_slice(c.w, i, i + m - 1), ' ') AS phrase, c.a
           FROM c, unnest(range(2, size)) AS t(m), unnest(range(1, size - m + 2)) AS u(i)),
kept AS (SELECT * FROM best WHERE NOT EXISTS (SELECT 1 FROM inside AS i WHERE i.lang = best.lang
           AND i.phrase = best.phrase AND 100::HUGEINT * i.a >= 80::HUGEINT * best.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, tot.n, score FROM ranked JOIN tot USING (lang) WHERE rank <= 2000
"""


def queries() -> dict[str, str]:
    return {"op13_collocations": COLLOCATIONS, "op12_hard_negatives": NEGATIVES, "op11_line_dedup": LINES, "op3_decontaminate": DECONTAMINATE, "op7_quality_hosts": QUALITY, "op8_jaccard_join": JACCARD}
