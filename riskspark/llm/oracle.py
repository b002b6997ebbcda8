"""DuckDB SQL that gives the rows of the operators that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15)
              AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][(rank - 1) % 3 + 1] AS DOUBLE) AS weight,
             CAST([0.5, 0.0, -0.5][(rank - 1) % 3 + 1] AS DOUBLE) AS slope,
             CAST(source_size * 2 AS DOUBLE) AS cap,
             CAST(sum(source_size) OVER () AS BIGINT) * CAST(1.5 AS DOUBLE) AS budget FROM s),
l AS (SELECT *, row_number() OVER (ORDER BY cap / weight, rank) AS cap_rank,
             (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, rank
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, slope,
             CASE WHEN cap <= weight * level THEN cap
                  ELSE weight * (SELECT arg_min(level, cap_rank) FROM l WHERE cap > weight * level) END AS target
      FROM l),
p AS (SELECT d.*, source_size, slope, target, CAST(round(target) AS BIGINT) AS goal,
             CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS served
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, greatest(0, least(size, goal - served)) AS first_words,
             greatest(0, least(size, goal - served - source_size)) AS again_words FROM p)
SELECT doc_id, size, source_size, target, CAST(first_words + again_words AS BIGINT) AS taken,
       CASE WHEN first_words > 0 THEN (CAST(served AS DOUBLE) / target * 2.0)
         / ((1.0 - slope) + sqrt((1.0 - slope) * (1.0 - slope) + CAST(served AS DOUBLE) / target * slope * 4.0))
       END AS position,
       CASE WHEN again_words > 0 THEN (CAST(served + source_size AS DOUBLE) / target * 2.0)
         / ((1.0 - slope) + sqrt((1.0 - slope) * (1.0 - slope)
            + CAST(served + source_size AS DOUBLE) / target * slope * 4.0))
       END AS position_again
FROM q"""

QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
ln AS (SELECT r, i, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line,
                               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln GROUP BY r),
w AS (SELECT r, unnest({WORDS}) AS word, generate_subscripts({WORDS}, 1) AS i FROM d),
g AS (SELECT r, i, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
             AS gram, count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS n FROM w),
tw AS (SELECT r, i, (n = 5 AND count(*) OVER (PARTITION BY r, gram, n) > 1) AS twice FROM g),
rep AS (SELECT r, count(*) AS n_repeat_words FROM (
          SELECT r, bool_or(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside
          FROM tw) WHERE inside GROUP BY r),
h AS (SELECT *, len(ws) AS n, CAST('0x' || substr(md5(array_to_string(ws, ' ')), 1, 15) AS BIGINT) AS k,
             CASE WHEN len(ws) > 5 THEN 3 WHEN len(ws) > 3 THEN 2 END AS ends
      FROM (SELECT ln.r, source, md5(text) AS t,
                   regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
                                                'abcdefghijklmnopqrstuvwxyz000000000'), '[^\x20\x09-\x0D]+') AS ws
            FROM ln JOIN d USING (r)) AS normal),
u AS (SELECT DISTINCT source, t, k, CASE WHEN ends > 0 THEN array_to_string(ws[1:ends], ' ') END AS s,
             CASE WHEN ends > 0 THEN array_to_string(ws[len(ws) - ends + 1:len(ws)], ' ') END AS e FROM h),
fr AS (SELECT source, k, s, e, count(*) AS n FROM u GROUP BY source, k, s, e HAVING count(*) > 20),
st AS (SELECT source, s, min(k) AS k FROM fr WHERE s IS NOT NULL GROUP BY source, s),
en AS (SELECT source, e, min(k) AS k FROM fr WHERE e IS NOT NULL GROUP BY source, e),
hosts AS (SELECT source, count(DISTINCT md5(text)) AS texts FROM d GROUP BY source),
often AS (SELECT fr.source, k, texts FROM fr JOIN hosts ON fr.source IS NOT DISTINCT FROM hosts.source
          WHERE n * 100 > texts * 5),
hit AS (SELECT u.source, t, u.k, texts FROM u JOIN often ON u.k = often.k AND u.source IS NOT DISTINCT FROM often.source),
sets AS (SELECT u.source, u.t, list_sort(list(DISTINCT coalesce(fr.k, st.k, en.k, u.k))) AS names
         FROM u SEMI JOIN hit ON u.t = hit.t AND u.source IS NOT DISTINCT FROM hit.source
         LEFT JOIN fr ON u.k = fr.k AND u.source IS NOT DISTINCT FROM fr.source
         LEFT JOIN st ON u.s = st.s AND u.source IS NOT DISTINCT FROM st.source
         LEFT JOIN en ON u.e = en.e AND u.source IS NOT DISTINCT FROM en.source
         GROUP BY u.source, u.t),
f AS (SELECT hit.source, k, texts, count(DISTINCT names) AS n FROM hit JOIN sets ON hit.t = sets.t
      AND hit.source IS NOT DISTINCT FROM sets.source GROUP BY hit.source, k, texts),
hot AS (SELECT source, k FROM f WHERE n > 20 AND n * 100 > texts * 5),
gone AS (SELECT r, sum(n) AS removed_words FROM h JOIN hot ON h.k = hot.k AND h.source IS NOT DISTINCT FROM hot.source
         GROUP BY r),
m AS (SELECT doc_id, CAST(len({WORDS}) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
      FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       (n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words AND n_words - removed_words >= 10
        AND 100 * (n_words - removed_words) >= 50 * n_words) AS kept
FROM m"""

ITEM_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {ITEM_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {ITEM_WORDS} AS ws FROM benchmark),
bi AS (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS m, array_to_string(ws[i:i + 9], ' ') AS w FROM bi),
di AS (SELECT r, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i
       FROM d JOIN (SELECT DISTINCT m FROM iw) AS lengths ON len(ws) >= m),
dw AS (SELECT r, i, m, array_to_string(ws[i:i + m - 1], ' ') AS w FROM di),
hits AS (SELECT r, i, iw.m, item_id FROM dw JOIN iw ON dw.w = iw.w AND dw.m = iw.m),
marked AS (SELECT r, count(DISTINCT p) AS n_hit
           FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM hits) AS places GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items,
                 sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS digest
          FROM hits GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN items USING (r)"""

SPELLING = r"""
WITH RECURSIVE
t AS (SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, y:
                 CASE WHEN x % 2 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END) AS c FROM range(256) AS bytes(b)) AS steps),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
k AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM runs GROUP BY id, run),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
               range(1, CAST(length(x) AS BIGINT), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h FROM k, t),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
             ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
del AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS d
        FROM (SELECT word, n, unnest(range(1, CAST(length(word) AS BIGINT) + 1)) AS p FROM v) AS places),
near AS (SELECT a.word, b.word AS near, b.n FROM del a JOIN del b ON a.d = b.d AND a.p = b.p AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM del a JOIN v b ON a.d = b.word
         UNION SELECT b.word, a.word, a.n FROM del a JOIN v b ON a.d = b.word),
best AS (SELECT word, near, n AS near_n, count(*) OVER (PARTITION BY word) AS n_near,
                row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place FROM near),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
             CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
      FROM v LEFT JOIN (SELECT * FROM best WHERE place = 1) AS b ON v.word = b.word),
steps AS (SELECT word, word AS root, form AS further FROM f
          UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN f ON s.further = f.word)
SELECT f.word, f.form, root, f.n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM f JOIN steps ON f.word = steps.word AND steps.further IS NULL"""
