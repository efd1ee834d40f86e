"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op4_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
        ), w AS (
            SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), kept AS (
            SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30
        ), sizes AS (
            SELECT lang, count(kept.term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang
        ), c AS (
            SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), g AS (
            SELECT lang, source, coalesce(any_value(s.n), 0) AS n, any_value(v) AS v
            FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) AS s USING (lang, source)
            JOIN sizes USING (lang) GROUP BY lang, source
        ), p AS (
            SELECT lang, source, term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT // (g.n + 5 * g.v) AS BIGINT) AS p
            FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
        ), q AS (
            SELECT lang, term, 1 + CAST(1000000000 * (sum(p.n) + 5)::HUGEINT // (any_value(t.n) + 5 * any_value(t.v)) AS BIGINT) AS q
            FROM p JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM g GROUP BY lang) AS t USING (lang) GROUP BY lang, term
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, CAST(coalesce(any_value(x.value), 0) AS BIGINT) AS value
            FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
            ) AS x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            GROUP BY a.lang, a.source, b.source
        ), terms AS (
            SELECT lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms)
        )
        SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
    "op13_collocations": r"""
        WITH p AS (
            SELECT row_number() OVER () AS id, lang, piece FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)
        ), s AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
        ), spots AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM s
        ), f AS (
            SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
            FROM spots, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL
        ), n AS (
            SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang
        ), often AS (
            SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f FROM f WHERE f >= 100
        ), cuts AS (
            SELECT lang, phrase, w, m, f AS a, unnest(range(1, m)) AS k FROM often WHERE m >= 2
        ), scored AS (
            SELECT c.lang, c.phrase, c.m, c.a, c.k, x.f AS l, y.f AS r, n.n,
                   CAST((1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
            FROM cuts AS c JOIN n USING (lang)
            JOIN often AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
            JOIN often AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inside AS (
            SELECT DISTINCT a.lang, a.phrase FROM lowest AS a JOIN lowest AS b
            ON a.lang = b.lang AND b.m > a.m AND b.a >= a.a AND contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' ')
        )
        SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, a, l, r, n, score
        FROM lowest ANTI JOIN inside USING (lang, phrase)
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
    """,
}
