"""DuckDB SQL of the queries that SQL can express on whole tables."""

#: Rows without null or non-finite components; components as whole numbers of 1/scale.
_VECTORS = """
usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scaled AS (
    SELECT vec_id, label, list_transform(v, lambda x: floor({scale} * x)) AS v FROM usable
)
"""

OP12_MIXING = r"""
WITH d AS (
    SELECT doc_id, source, md5(coalesce(text, '')) AS digest, md5(coalesce(doc_id::VARCHAR, '')) AS id_key,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
),
s AS (
    SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
),
-- By the share of weight at which a source is full: what is left for the others once the first ones are.
ranked AS (
    SELECT *, 3 * source_size AS most, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS turn FROM s
),
left_over AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM ranked
),
share AS (
    SELECT arg_min(rest::DOUBLE / weights, turn) FILTER (WHERE most > rest::DOUBLE / weights * weight) AS share FROM left_over
),
t AS (
    SELECT source, source_size, least(most::DOUBLE, coalesce(share, 0) * weight) AS target FROM ranked, share
),
e AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216)::BIGINT ELSE 0 END AS expected,
           ('0x' || substr(md5('mix' || coalesce('=' || source, '')), 1, 6))::BIGINT AS shift
    FROM t
),
p AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, id_key, doc_id, digest) - 1 AS place FROM d
)
SELECT p.doc_id, p.source, p.size, e.source_size, e.target,
       (shift + (place + 1) * expected) // 16777216 - (shift + place * expected) // 16777216 AS copies,
       size * ((shift + (place + 1) * expected) // 16777216 - (shift + place * expected) // 16777216) AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
"""

OP11_BOND = f"""
WITH {_VECTORS.format(scale=256)},
r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM scaled WHERE label IS NOT NULL
),
scores AS (
    SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_dot_product(a.v, x.v)::BIGINT AS score
    FROM r AS a JOIN r AS x ON a.vec_id <> x.vec_id AND len(a.v) = len(x.v)
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, vec_id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)::INTEGER AS positive_rank
    FROM scores WHERE same QUALIFY positive_rank <= 5
)
SELECT p.anchor_id, p.positive_rank, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_rank ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
FROM positives AS p JOIN scores AS n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""

#: Who is reached over links (a, b), which go both ways.
_REACHED = """
reach(a, b) AS (
    SELECT a, b FROM links
    UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a
),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
"""

OP1_MULTI_INDEX = f"""
WITH RECURSIVE {_VECTORS.format(scale=1)},
unit AS (
    SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM usable
    WHERE label IS NOT NULL AND list_dot_product(v, v) > 0
),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM unit AS x JOIN unit AS y
      ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.u) = len(y.u) AND list_dot_product(x.u, y.u) >= 0.98
),
{_REACHED}
SELECT e.vec_id, count(l.b) AS n_links, least(e.vec_id, coalesce(any_value(m.b), e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(any_value(m.b), e.vec_id)) AS kept
FROM embeddings AS e LEFT JOIN links AS l ON l.a = e.vec_id LEFT JOIN least AS m ON m.a = e.vec_id
GROUP BY e.vec_id
"""

#: Pairs come from shared shingles; lower case of A-Z only.
OP2_MINHASH = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS words
    FROM documents
),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, md5_number(array_to_string(words[i:i + 4], ' ')) AS shingle
    FROM w, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS t(i)
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
),
links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
    WHERE 100 * common >= 75 * (x.n + y.n - common)
),
{_REACHED}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.b, d.doc_id)) AS kept
FROM documents AS d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least AS m ON m.a = d.doc_id
"""

#: crc32 of the decimal id, bit by bit.  A run of at least 12 words and two periods has six equal
#: words in a row a period apart, so runs are islands of positions with equal stretches of six.
OP13_PERIODIC_RUNS = r"""
WITH c AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words,
           xor(4294967295, list_reduce(
             list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INTEGER, 1))::BIGINT),
             lambda c, b: list_reduce(range(8)::BIGINT[],
               lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
             4294967295::BIGINT)) AS h
    FROM documents
),
p AS (
    SELECT doc_id, words, len(words) AS n, h, (h // 10) % greatest(len(words), 1) AS a, h // 10 AS g FROM c
),
q AS (
    SELECT *, 1 + (n - a) // (3 + g % 8) AS period FROM p
),
w AS MATERIALIZED (
    SELECT doc_id, i, words[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % period ELSE i END] AS word
    FROM q, unnest(range(n)) AS t(i)
),
six AS MATERIALIZED (
    SELECT doc_id, i, md5_number(concat_ws(' ', word, w1, w2, w3, w4, w5)) AS stretch FROM (
        SELECT doc_id, i, word, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2, lead(word, 3) OVER o AS w3,
               lead(word, 4) OVER o AS w4, lead(word, 5) OVER o AS w5
        FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ) WHERE w5 IS NOT NULL
),
pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS period FROM six AS x JOIN six AS y ON x.doc_id = y.doc_id AND x.stretch = y.stretch AND y.i > x.i
),
islands AS (
    SELECT doc_id, period, i, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM pairs
),
stretches AS (
    SELECT doc_id, period, min(i) AS start, max(i) - min(i) + 6 + period AS length FROM islands GROUP BY doc_id, period, island
),
runs AS MATERIALIZED (
    SELECT doc_id, start, length, min(period) AS period FROM stretches
    WHERE length >= greatest(12, 2 * period) GROUP BY doc_id, start, length
),
best AS (
    SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(start, length, period), (-length, start, period)) AS longest,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
),
kept AS (
    SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS words FROM w
    WHERE NOT EXISTS (SELECT 1 FROM runs AS r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length)
    GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, longest.start AS start, longest.length AS length, longest.period AS period,
       1000 * longest.length // longest.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.words, '')) AS collapsed_sha256
FROM documents AS d LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

#: Base32 of SHA-1: every five bits of the forty hexadecimal digits.  The two record ids of a
#: header have 47 signs each.
OP10_WARC_STORE = r"""
WITH p AS (
    SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
),
d AS (
    SELECT *, strlen(html)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS first,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((('0x' || substr(hex || '0', 1 + (5 * i) // 4, 2))::INTEGER >> (3 - (5 * i) % 4)) % 32)::INTEGER, 1)), '') AS payload_digest
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to,
       strlen('WARC/1.1') + 2 + strlen('WARC-Type: ') + CASE WHEN page_id = first THEN 8 ELSE 7 END + 2
         + strlen('WARC-Record-ID: ') + 47 + 2 + strlen('WARC-Date: 1970-01-01T00:00:00Z') + 2
         + strlen('WARC-Target-URI: ') + strlen(replace(replace(url, chr(13), '%0D'), chr(10), '%0A')) + 2
         + strlen('X-Page-ID: ') + strlen(page_id::VARCHAR) + 2 + strlen('WARC-Payload-Digest: sha1:') + 32 + 2
         + CASE WHEN page_id = first THEN 0 ELSE strlen('WARC-Refers-To: ') + 47 + 2
             + strlen('X-Refers-To-Page-ID: ') + strlen(first::VARCHAR) + 2
             + strlen('WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest') + 2 END
         + strlen('Content-Type: text/html; charset=utf-8') + 2 + strlen('Content-Length: ')
         + CASE WHEN page_id = first THEN strlen(payload_bytes::VARCHAR) + payload_bytes ELSE 1 END + 4 + 4 AS record_bytes
FROM d
"""

OP4_COVER_TREE = f"""
WITH {_VECTORS.format(scale=64)}
SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score,
       row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, x.v) DESC, x.vec_id)::INTEGER AS rank
FROM scaled AS q JOIN scaled AS x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
WHERE q.vec_id % 20 = 0
QUALIFY rank <= 20
"""

ORACLE_SQL: dict[str, str] = {
    "op1_multi_index": OP1_MULTI_INDEX,
    "op2_minhash": OP2_MINHASH,
    "op4_cover_tree": OP4_COVER_TREE,
    "op10_warc_store": OP10_WARC_STORE,
    "op11_bond": OP11_BOND,
    "op12_mixing": OP12_MIXING,
    "op13_periodic_runs": OP13_PERIODIC_RUNS,
}
