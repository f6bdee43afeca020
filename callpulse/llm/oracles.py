"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(column: str, pattern: str) -> str:
    lower = f"translate(coalesce({column}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return f"regexp_extract_all({lower}, '{pattern}')"


_BENCHMARK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SHINGLE_WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {
    "op3_minhash_neardup": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_words("text", _SHINGLE_WORD)} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
        FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 75 * (p.n + q.n - common)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
), least AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op5_benchmark_decontamination": f"""
WITH d AS (
  SELECT doc_id, {_words("text", _BENCHMARK_WORD)} AS w FROM documents
), b AS (
  SELECT item_id, {_words("text", _BENCHMARK_WORD)} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i : i + 9] AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)
), runs AS (
  SELECT doc_id, n, i, w[i : i + n - 1] AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, runs.n AS n, item_id FROM runs JOIN windows ON runs.s = windows.s
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op7_chat_formatting": """
WITH c AS (
  SELECT conv_id,
         list(struct_pack(role := coalesce(role, 'user'), "text" := coalesce("text", ''))
              ORDER BY turn, role, "text") AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), r AS (
  SELECT conv_id, turns,
         list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant') AS replies
  FROM c
), p AS (
  SELECT conv_id, turns, replies[-1] AS last, turns[replies[-1]]."text" AS good,
         CASE WHEN len(replies) > 1 THEN turns[replies[-2]]."text" ELSE '' END AS bad
  FROM r WHERE len(replies) > 0
), q AS (
  SELECT *, CASE WHEN good = bad THEN last ELSE last - 1 END AS prefix FROM p
)
SELECT conv_id, CAST(prefix AS INTEGER) AS prefix_turns,
       sha256(coalesce(list_aggregate(list_transform(turns[1 : prefix],
              lambda t: '<|' || t.role || '|>' || chr(10) || t."text" || '<|end|>' || chr(10)),
              'string_agg', ''), '')) AS prompt_sha256,
       sha256(CASE WHEN good = bad THEN '' ELSE
              '<|assistant|>' || chr(10) || good || '<|end|>' || chr(10) END) AS chosen_sha256,
       CASE WHEN good = bad THEN '' ELSE '14-' || (21 + length(good)) END AS chosen_spans,
       sha256(CASE WHEN good = bad THEN '' ELSE
              '<|assistant|>' || chr(10) || bad || '<|end|>' || chr(10) END) AS rejected_sha256,
       CASE WHEN good = bad THEN '' ELSE '14-' || (21 + length(bad)) END AS rejected_spans
FROM q
""",
    "op10_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank"
  FROM scores
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 10
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * c.e[i])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank"
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
   AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, "rank", negative_id, positive_score, negative_score
FROM ranked WHERE "rank" <= 10
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce("text", ''), '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), named AS (
  SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs
), hashed AS (
  SELECT run, named.n AS n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, length(x) // 2),
      lambda i: CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM named, crc
), words AS (
  SELECT CASE WHEN h % 31 = 0
         THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, sum(n) AS n
  FROM hashed GROUP BY ALL
), v AS (
  SELECT word, CAST(n AS BIGINT) AS n FROM words WHERE length(word) >= 7 AND n >= 2
), cut AS (
  SELECT word, i, word[1 : i - 1] || word[i + 1 :] AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), inserted AS (
  SELECT DISTINCT cut.word AS long, v.word AS short FROM cut JOIN v ON cut.rest = v.word
), near AS (
  SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT long, short FROM inserted
  UNION ALL SELECT short, long FROM inserted
), best AS (
  SELECT x, count(*) AS n_near, max(n) AS n FROM near JOIN v ON v.word = y GROUP BY x
), first AS (
  SELECT x, y FROM (SELECT x, y, row_number() OVER (PARTITION BY x ORDER BY n DESC, encode(y)) AS place
                    FROM near JOIN v ON v.word = y) WHERE place = 1
), forms AS (
  SELECT v.word, CASE WHEN best.n >= 10 * v.n THEN first.y END AS form, v.n,
         coalesce(best.n_near, 0) AS n_near, CASE WHEN best.n >= 10 * v.n THEN best.n END AS form_n
  FROM v LEFT JOIN best ON best.x = v.word LEFT JOIN first ON first.x = v.word
), chain AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL
  SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.next
)
SELECT forms.word, forms.form, chain.at AS root, n, n_near, form_n
FROM forms JOIN chain ON chain.word = forms.word AND chain.next IS NULL
""",
}
