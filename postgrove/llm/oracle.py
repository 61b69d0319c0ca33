"""SQL each query must equal, where SQL can express it."""

from __future__ import annotations

# Words of a text, a list; [] for NULL.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP4 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {_WORDS.format(_SMALL)} AS w FROM documents
), shingled AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')))
    END AS s FROM words
), rows AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM shingled
), links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM rows x JOIN rows y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY 1, 2, x.n, y.n
    HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM shingled JOIN least USING (doc_id)
"""

_OP3 = f"""
WITH sizes AS (
    SELECT doc_id, source, CAST(len({_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size, concat('17:', doc_id, ':',
        md5(text), ':', source) AS name, row_number() OVER (PARTITION BY name) AS number FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weighed AS (
    SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
           2 * source_size AS room FROM sources
), stepped AS (
    SELECT *,
        row_number() OVER fill AS step,
        1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(room) OVER before, 0)::DOUBLE AS rest,
        CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS among
    FROM weighed
    WINDOW fill AS (ORDER BY room::DOUBLE / weight, source NULLS LAST),
        before AS (ORDER BY room::DOUBLE / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), opened AS (
    SELECT min(step) AS first_step, arg_min(rest, step) AS rest, arg_min(among, step) AS among
    FROM stepped WHERE room * among > weight * rest
), targets AS (
    SELECT source, source_size,
        CASE WHEN step >= first_step THEN weight * o.rest / o.among ELSE room::DOUBLE END AS target
    FROM stepped, opened o
), rated AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
        ('0x' || substr(md5(name || CASE WHEN number > 1 THEN concat(':', number) ELSE '' END), 1, 13))::BIGINT::DOUBLE / 4503599627370496
            AS draw
    FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
), counted AS (
    SELECT *, CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT) AS copies FROM rated
)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken FROM counted
"""

_OP11 = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_SMALL}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i+k-1])) AS g
    FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k
), counts AS (
    SELECT lang, g, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 100
), cuts AS (
    SELECT c.lang, c.g, c.f, unnest(range(1, len(c.g))) AS k FROM counts c WHERE len(c.g) > 1
), scored AS (
    SELECT x.lang, x.g, x.f AS a, x.k, l.f AS l, r.f AS r, n,
        (1000::HUGEINT * x.f * n) // (l.f::HUGEINT * r.f) AS score
    FROM cuts x JOIN totals ON x.lang = totals.lang
    JOIN counts l ON l.lang = x.lang AND l.g = x.g[1:x.k]
    JOIN counts r ON r.lang = x.lang AND r.g = x.g[x.k+1:len(x.g)]
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), parts AS (
    SELECT c.lang, c.f, list_slice(c.g, i, i + size - 1) AS part
    FROM counts c, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(2, 5)) AS size)
    WHERE size < len(c.g) AND i + size - 1 <= len(c.g)
), held AS (
    SELECT lang, part, max(f) AS f FROM parts GROUP BY lang, part
), kept AS (
    SELECT x.*, array_to_string(x.g, ' ') AS phrase FROM lowest x LEFT JOIN held h ON h.lang = x.lang AND h.part = x.g
    WHERE h.f IS NULL OR 100 * h.f < 100 * x.a
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM kept
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""

# Vectors in whole numbers, without those that are NULL or hold a NULL or non-finite component.
_WHOLE = """
    SELECT vec_id{more}, list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
"""

_OP12 = f"""
WITH vectors AS ({_WHOLE.format(more="", scale=256)}
), ranked AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM ranked
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

_NEAREST = """
near{i} AS (
    SELECT parts.vec_id, parts.label, parts.p, parts.part, e,
        list_sum(list_transform(list_zip(parts.part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
    FROM parts JOIN book{i} ON book{i}.p = parts.p
    QUALIFY row_number() OVER (PARTITION BY parts.vec_id, parts.p ORDER BY distance, e) = 1
)"""

_MOVED = """
sums{i} AS (
    SELECT p, e, place, CAST(sum(part[place]) AS BIGINT) AS total, count(*) AS n
    FROM near{i}, (SELECT unnest(range(1, 1 + (SELECT max(len(part)) FROM parts))) AS place) GROUP BY p, e, place
), book{next} AS (
    SELECT p, e, coalesce(moved, entry) AS entry
    FROM book{i} LEFT JOIN (
        SELECT p, e, list((total - ((total % n) + n) % n) // n ORDER BY place) AS moved FROM sums{i} GROUP BY p, e
    ) USING (p, e)
)"""

_ROUNDS = ",".join(_NEAREST.format(i=i) + "," + _MOVED.format(i=i, next=i + 1) for i in range(6))
_OP13 = f"""
WITH vectors AS ({_WHOLE.format(more=", label", scale=4096)}
), parts AS (
    SELECT vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS part
    FROM vectors, (SELECT unnest(range(8)) AS p)
), book0 AS (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS entry FROM parts
    QUALIFY e < 16
), {_ROUNDS}, {_NEAREST.format(i=6)}, coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(distance) AS BIGINT) AS error
    FROM near6 GROUP BY vec_id, label
), digest AS (
    SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book6
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest
"""

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": _OP3,
    "op4_minhash": _OP4,
    "op11_collocations": _OP11,
    "op12_maxscore": _OP12,
    "op13_vector_codes": _OP13,
}
