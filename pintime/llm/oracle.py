"""DuckDB SQL of the queries that SQL can express.

The others need a tokenizer, a trained model or a tree of messages; their tests
hold them against the public libraries or brute force.
"""

from __future__ import annotations

OP3_QUALITY = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, lang, text, length(text) AS chars,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS letters,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    length(text) - length(regexp_replace(text, '\p{Lu}+', '', 'g')) AS capital,
    length(text) - length(regexp_replace(text, '[.,;:?''"()+@=/-]+', '', 'g')) AS stop,
    length(text) - length(regexp_replace(
      text, '[^\p{L}\p{Nd}\x20\x09-\x0D.,;:?''"()+@=/-]+', '', 'g')) AS other
  FROM d),
m2 AS (
  SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars FROM m),
m3 AS (
  SELECT *, chars - word_chars AS space, word_chars - capital - stop - other AS small FROM m2),
windows AS (
  SELECT doc_id, unnest(range(1, n_words - 6)) AS i, words FROM m2 WHERE n_words >= 8),
keyed AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w FROM windows),
twice AS (SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
steps AS (
  SELECT doc_id, least(8, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 8)) AS s
  FROM twice),
repeats AS (SELECT doc_id, sum(s) AS n_repeat_words FROM steps GROUP BY doc_id),
prose AS (
  SELECT * FROM m3 WHERE lang IS NOT NULL AND 100 * n_symbols <= chars
    AND 5 * capital <= capital + small),
class_sums AS (
  SELECT lang, count(*) AS n_docs, sum(len(letters)) AS n_words, sum(capital) AS a,
    sum(stop) AS b, sum(other) AS c, sum(space) AS e, sum(small) AS f, sum(chars) AS t
  FROM prose GROUP BY lang),
refs AS (
  SELECT lang, n_words, a / t AS qa, b / t AS qb, c / t AS qc, e / t AS qe, f / t AS qf
  FROM class_sums
  WHERE t >= 10000 AND n_words > 0),
prose_words AS (SELECT lang, unnest(letters) AS word FROM prose),
word_counts AS (
  SELECT lang, word, count(*) AS n FROM prose_words GROUP BY lang, word),
common AS (
  SELECT w.lang, w.word, w.n / r.n_words AS q
  FROM word_counts w JOIN refs r USING (lang)
  QUALIFY row_number() OVER (PARTITION BY w.lang ORDER BY w.n DESC, w.word) <= 64),
rest AS (SELECT lang, sum(q) AS known, 1 - sum(q) AS q FROM common GROUP BY lang),
shares AS (
  SELECT doc_id, capital / chars AS pa, stop / chars AS pb, other / chars AS pc,
    space / chars AS pe, small / chars AS pf FROM m3 WHERE chars > 0),
parts AS (
  SELECT doc_id, lang, unnest([pa, pb, pc, pe, pf]) AS p, unnest([qa, qb, qc, qe, qf]) AS q
  FROM shares CROSS JOIN refs),
class_by_lang AS (
  SELECT doc_id, lang, sqrt(greatest(0, sum(
    CASE WHEN p > 0 THEN 0.5 * p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN 0.5 * q * log2(2 * q / (p + q)) ELSE 0 END))) AS dist
  FROM parts GROUP BY doc_id, lang),
class_distance AS (SELECT doc_id, min(dist) AS class_distance FROM class_by_lang GROUP BY doc_id),
doc_words AS (SELECT doc_id, len(letters) AS n, unnest(letters) AS word FROM m3),
doc_counts AS (SELECT doc_id, n, word, count(*) / n AS p FROM doc_words GROUP BY doc_id, n, word),
own AS (
  SELECT c.doc_id, k.lang, sum(0.5 * p * log2(2 * p / (p + q)) + 0.5 * q * log2(2 * q / (p + q)))
    AS d, sum(p) AS p, sum(q) AS q
  FROM doc_counts c JOIN common k USING (word) GROUP BY c.doc_id, k.lang),
every AS (
  SELECT m3.doc_id, rest.lang, rest.known, rest.q AS other, coalesce(own.d, 0) AS d,
    greatest(1 - coalesce(own.p, 0), 0) AS p_other, coalesce(own.q, 0) AS q
  FROM m3 CROSS JOIN rest LEFT JOIN own ON own.doc_id = m3.doc_id AND own.lang = rest.lang
  WHERE len(m3.letters) > 0),
word_by_lang AS (
  SELECT doc_id, sqrt(greatest(0, d + 0.5 * (known - q)
    + CASE WHEN p_other > 0 THEN 0.5 * p_other * log2(2 * p_other / (p_other + other)) ELSE 0 END
    + CASE WHEN other > 0 THEN 0.5 * other * log2(2 * other / (p_other + other)) ELSE 0 END))
    AS dist,
    sqrt(0.5 * known + 0.5 * log2(2 / (1 + other))
      + CASE WHEN other > 0 THEN 0.5 * other * log2(2 * other / (1 + other)) ELSE 0 END) AS without
  FROM every),
word_distance AS (
  SELECT doc_id, min(dist) AS word_distance, min(dist / without) AS ratio
  FROM word_by_lang GROUP BY doc_id),
judged AS (
  SELECT m3.doc_id, m3.lang, chars, n_words, word_chars, n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, class_distance, word_distance, ratio
  FROM m3 LEFT JOIN repeats USING (doc_id) LEFT JOIN class_distance USING (doc_id)
    LEFT JOIN word_distance USING (doc_id)),
failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM judged)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed
  AND NOT (chars >= 100 AND coalesce(class_distance, 0) > 0.17
           AND (coalesce(lang IN (SELECT lang FROM refs), false)
                OR (lang IS NULL AND n_words >= 50 AND coalesce(ratio <= 0.75, false))))
  AND NOT (n_words >= 50 AND coalesce(lang IN (SELECT lang FROM refs), false)
           AND coalesce(word_distance, 0) > 0.5) AS kept
FROM failed
"""

OP6_NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
placed AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
  FROM w WHERE len(words) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM placed),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
  SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON sym.a = reach.b),
least_ AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  least(w.doc_id, coalesce(l.b, w.doc_id)) AS component_id,
  w.doc_id <= coalesce(l.b, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_ l USING (doc_id)
"""

OP9_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
    sum(length('### ' || regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g') || ': '
               || regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') || '</turn>' || chr(10)))
      AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM c
"""

OP4_TOPK_SEARCH = r"""
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: coalesce(x, 0) > 0) AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id,
    len(list_filter(list_zip(q.code, e.code), lambda p: p[1] <> p[2])) AS distance
  FROM e q JOIN e ON e.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank,
  neighbor_id, distance::BIGINT AS distance
FROM pairs
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) <= 10
"""

OP11_COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words
  FROM p),
g AS (
  SELECT lang, 1 AS k, unnest(words) AS phrase FROM w
  UNION ALL
  SELECT lang, 2, array_to_string(words[i:i + 1], ' ')
  FROM (SELECT lang, words, unnest(range(1, len(words))) AS i FROM w WHERE len(words) > 1)
  UNION ALL
  SELECT lang, 3, array_to_string(words[i:i + 2], ' ')
  FROM (SELECT lang, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
total AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS t FROM f WHERE k > 1 AND a >= 10),
cuts AS (
  SELECT lang, phrase, a, t, c, array_to_string(t[1:c], ' ') AS head,
    array_to_string(t[c + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM often)),
marked AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r, c,
    (1000000::HUGEINT * cuts.a * cuts.a) // (x.a::HUGEINT * y.a) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head
    JOIN f y ON y.lang = cuts.lang AND y.phrase = tail),
lowest AS (
  SELECT * FROM marked
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_ AS (
  SELECT lang, array_to_string(t[1:2], ' ') AS phrase, a FROM often WHERE k = 3
  UNION ALL SELECT lang, array_to_string(t[2:3], ' '), a FROM often WHERE k = 3),
longer AS (SELECT lang, phrase, max(a) AS b FROM inner_ GROUP BY ALL),
stay AS (
  SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase)
  WHERE coalesce(100 * b < 50 * a, true)),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM stay)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
  n::BIGINT AS n, score::BIGINT AS score
FROM placed JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL = {
    "op11_collocations": OP11_COLLOCATIONS,
    "op4_topk_search": OP4_TOPK_SEARCH,
    "op3_quality": OP3_QUALITY,
    "op6_near_dedup": OP6_NEAR_DEDUP,
    "op9_chat": OP9_CHAT,
}
