"""DuckDB SQL for the llm queries that SQL can express."""

from __future__ import annotations

from riskframe.llm import audit, pq, quality as Q, resample, sharding

SPACE = "[\\x20\\x09-\\x0D]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


OP2 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{NOT_SPACE}+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END, ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
r AS (SELECT doc_id AS v, doc_id AS u FROM documents UNION SELECT r.v, l.b FROM r JOIN l ON l.a = r.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT v AS doc_id, min(u) AS component_id FROM r GROUP BY v) c USING (doc_id)
"""

OP4 = f"""
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= {pq.COSINE}),
r AS (SELECT vec_id AS v, vec_id AS u FROM embeddings UNION SELECT r.v, l.b FROM r JOIN l ON l.a = r.u),
c AS (SELECT v AS vec_id, min(u) AS component_id FROM r GROUP BY v),
k AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT m.vec_id, coalesce(k.n, 0) AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN c USING (vec_id) LEFT JOIN k USING (vec_id)
"""


def _class(chars: str) -> str:
    quoted = chars.replace("'", "''")
    return f"length(regexp_replace(t, '[^{quoted}]+', '', 'g'))"


def _op9() -> str:
    classes = [f"length(t) - length(array_to_string(w, ''))", *map(_class, Q.CLASSES)]
    words = [f"len(list_filter(w, lambda x: x IN ({_quoted(ws)})))" for ws in Q.BINS]
    return f"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{NOT_SPACE}+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{NOT_SPACE}')) AS lines FROM documents),
g AS (SELECT doc_id, i, w[i:i + 4] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
p AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, sum(least(5, i - j)) AS n FROM (SELECT doc_id, i, lag(i, 1, -5) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM p) GROUP BY doc_id),
b AS (
  SELECT d.doc_id, lang, length(t) AS chars, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {_class(Q.CLASSES[2])} AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         [{', '.join(classes)}] AS c0, [{', '.join(words)}] AS w0
  FROM d LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, list_append(c0, chars - list_sum(c0)) AS cc, list_append(w0, n_words - list_sum(w0)) AS cw FROM b),
h AS (
  SELECT doc_id, lang, 'c' AS kind, unnest(range(1, len(cc) + 1)) AS i, CAST(unnest(cc) AS DOUBLE) AS v, chars >= {Q.MIN_CHARS} AS fit,
         chars >= {Q.MIN_CHARS} AND n_words >= {Q.MIN_WORDS} AS learn FROM m
  UNION ALL
  SELECT doc_id, lang, 'w', unnest(range(1, len(cw) + 1)), CAST(unnest(cw) AS DOUBLE), n_words >= {Q.MIN_WORDS},
         chars >= {Q.MIN_CHARS} AND n_words >= {Q.MIN_WORDS} FROM m),
q0 AS (SELECT lang, kind, i, sum(v) AS v FROM h WHERE learn AND lang IS NOT NULL GROUP BY ALL),
q AS (SELECT lang, kind, i, v / sum(v) OVER (PARTITION BY lang, kind) AS q FROM q0),
pp AS (SELECT doc_id, kind, i, v / sum(v) OVER (PARTITION BY doc_id, kind) AS p FROM h WHERE fit),
js AS (
  SELECT doc_id, q.lang, kind, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS x
  FROM pp JOIN q USING (kind, i) GROUP BY ALL),
rest AS (SELECT lang, q AS r FROM q WHERE kind = 'w' AND i = {len(Q.BINS) + 1}),
lim AS (SELECT lang, CASE WHEN r > 0 AND r <= {1 - Q.MIN_COMMON} THEN
          {Q.WORD_SHARE} * sqrt(greatest((log2(2 / (1 + r)) + r * log2(2 * r / (1 + r)) + (1 - r)) / 2, 0)) END AS lim FROM rest),
pairs AS (SELECT doc_id, lang, max(x) FILTER (kind = 'c') AS c, max(x) FILTER (kind = 'w') AS w FROM js GROUP BY ALL),
far AS (
  SELECT doc_id, min(coalesce(greatest(c / {Q.MAX_CLASS_DISTANCE}, CASE WHEN lim IS NOT NULL THEN w / lim END), 0)) AS far
  FROM pairs JOIN lim USING (lang) JOIN (SELECT doc_id, lang AS own FROM m) USING (doc_id)
  WHERE lim IS NOT NULL OR own = lang GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND coalesce(far <= 1, true) AS kept
FROM m LEFT JOIN far USING (doc_id)
"""


def _bytes(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"


#: The CRC-32 table, from its polynomial.
CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda a, x:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)))"""


def _crc(text: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {_bytes(text)}), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)"


def _hex(text: str, digits: int) -> str:
    return f"CAST('0x' || substr(sha256({text}), 1, {digits}) AS BIGINT)"


OP11 = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
u AS (SELECT *, regexp_extract_all(t, '{NOT_SPACE}+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM w),
lab AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {{
      'A': len(ws) < {audit.MIN_WORDS}, 'B': 100 * len(list_distinct(ws)) < {audit.MIN_DISTINCT_PERCENT} * len(ws),
      'C': 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > {audit.MAX_UPPER_PERCENT} * length(t),
      'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(u.doc_id > first, false)}} AS f
  FROM u LEFT JOIN lab ON lab.doc_id = u.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT '' AS o UNION ALL SELECT o || c FROM orders, letters WHERE NOT contains(o, c)),
steps AS (SELECT o AS filter_order, CAST(k AS INT) AS step, substr(o, k, 1) AS c, substr(o, 1, k - 1) AS before
          FROM orders, range(1, 6) r(k) WHERE length(o) = 5),
masks AS (SELECT part, (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END) || (CASE WHEN f.C THEN 'C' ELSE '' END)
                 || (CASE WHEN f.D THEN 'D' ELSE '' END) || (CASE WHEN f.E THEN 'E' ELSE '' END) AS m,
                 count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY ALL),
x AS (
  SELECT part, filter_order, step, c,
         sum(CASE WHEN NOT regexp_matches(m, '[' || before || c || ']') THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN here THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(m, c) AND NOT here THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN m = c THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN here THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN here THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT *, contains(m, c) AND (before = '' OR NOT regexp_matches(m, '[' || before || '-]')) AS here FROM masks, steps)
  GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM x
"""

OP12 = f"""
WITH {CRC_TABLE},
texts AS (SELECT doc_id AS id, false AS target, row_number() OVER () AS r, coalesce(text, '') AS x FROM documents
          UNION ALL SELECT item_id, true, row_number() OVER (), coalesce(text, '') FROM benchmark),
ws AS (SELECT target, r, unnest(regexp_extract_all(translate(x, '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS w FROM texts),
words AS (SELECT w, {_crc('w')} % {resample.BUCKETS} AS b FROM (SELECT DISTINCT w FROM ws), crc_table),
c AS (SELECT target, r, b FROM ws JOIN words USING (w)),
n AS (SELECT b, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM c GROUP BY b),
total AS (SELECT count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM c),
g AS (SELECT n.b, CAST(floor({resample.SCALE} * ln((n.t + 1)::DOUBLE * (total.s + {resample.BUCKETS}) / ((n.s + 1)::DOUBLE * (total.t + {resample.BUCKETS})))) AS BIGINT) AS gain
      FROM n, total),
k AS (SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM c JOIN g USING (b) WHERE NOT target GROUP BY r),
sc AS (SELECT id AS doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(({_hex(f"'{resample.SEED}:' || coalesce(CAST(id AS VARCHAR), '')", 8)} + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
       FROM texts LEFT JOIN k USING (r) WHERE NOT target),
rk AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {resample.MIN_WORDS} ORDER BY score DESC, doc_id) AS p,
              count(*) FILTER (n_features >= {resample.MIN_WORDS}) OVER () AS long_enough FROM sc)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= {resample.MIN_WORDS} AND p <= {resample.PERCENT} * long_enough // 100 THEN p END AS rank
FROM rk
"""

OP13 = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS stratum, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc("coalesce(text, '')")} AS text_crc32,
             {_hex(f"'{sharding.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')", sharding.HEX_DIGITS)} AS key FROM documents, crc_table),
r AS (SELECT *, (2 * row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id, text_crc32, size) - 1) / (2 * count(*) OVER (PARTITION BY stratum)) AS fraction FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, key, stratum, doc_id, text_crc32, size) - 1 AS p, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p * {sharding.SHARDS} // n AS INTEGER) AS shard,
       p - (p * {sharding.SHARDS} // n * n + {sharding.SHARDS - 1}) // {sharding.SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""

ORACLE = {"op2_ngram_jaccard": OP2, "op4_embedding_pq": OP4, "op9_quality_rules": _op9(),
          "op11_filter_audit": OP11, "op12_importance_resampling": OP12, "op13_sharding": OP13}
