"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from meterlake.llm.licenses import scan_sql

OP7 = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
"""

OP4 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3),
                           lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
        AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x
), least AS (
    SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN least ON x = doc_id
"""

OP5 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS ints
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id,
       TRY_CAST(score AS BIGINT) AS score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10
"""

_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# crc32 runs over the UTF-8 bytes of code points below 256, by a table of 256 remainders.
OP11 = f"""
WITH RECURSIVE bits AS (
    SELECT k, 0 AS i, k AS c FROM range(256) AS r(k)
    UNION ALL
    SELECT k, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    FROM bits WHERE i < 8
), crc AS (
    SELECT list(c ORDER BY k) AS t FROM bits WHERE i = 8
), runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
           translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), {_CAPITALS}) AS run
    FROM documents
), counted AS (
    SELECT d, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY d, run
), bytes AS (
    SELECT run, n, flatten(list_transform(string_split(d || ':' || run, ''),
               lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)]
                         ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b
    FROM counted
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_transform(b, lambda x: CAST(x AS BIGINT)),
               lambda h, x: xor(h >> 8, t[CAST(xor(h & 255, x) AS INTEGER) + 1]), CAST(4294967295 AS BIGINT))) AS h
    FROM bytes, crc
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INTEGER))
                           || substring(run, CAST(h % length(run) AS INTEGER) + 2)
                      ELSE run END AS word, n FROM hashed)
    GROUP BY word HAVING length(word) >= 7 AND sum(n) >= 2
), gaps AS (
    SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, a.n, b.word AS form, b.n AS form_n
    FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT g.word, g.n, w.word, w.n FROM gaps g JOIN words w ON g.rest = w.word
    UNION
    SELECT w.word, w.n, g.word, g.n FROM gaps g JOIN words w ON g.rest = w.word
), best AS (
    SELECT word, form, form_n FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY form_n DESC, form) = 1 AND form_n >= 10 * n
), path AS (
    SELECT word, form AS root FROM best
    UNION ALL
    SELECT path.word, best.form FROM path JOIN best ON path.root = best.word
), roots AS (
    SELECT word, root FROM path WHERE root NOT IN (SELECT word FROM best)
), sizes AS (
    SELECT word, count(*) AS n_near FROM near GROUP BY word
)
SELECT words.word, best.form, coalesce(roots.root, words.word) AS root, words.n,
       coalesce(n_near, 0) AS n_near, best.form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN roots USING (word) LEFT JOIN sizes USING (word)
"""

LLM_ORACLE: dict[str, str] = {
    "op5_top_k": OP5,
    "op4_ngram_join": OP4,
    "op7_exact_dedup": OP7,
    "op9_licenses": scan_sql(),
    "op11_spelling": OP11,
}
