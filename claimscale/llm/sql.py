"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The codebooks of each round as tables of their own."""
    steps = [
        f"""kept AS MATERIALIZED (
          SELECT vec_id, label,
                 list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS c,
                 row_number() OVER (ORDER BY vec_id) - 1 AS place
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(
            embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cut AS MATERIALIZED (
          SELECT vec_id, place, p, c[p * (len(c) // {parts}) + 1:(p + 1) * (len(c) // {parts})] AS v
          FROM kept, (SELECT unnest(range({parts})) AS p))""",
        f"""book0 AS MATERIALIZED (SELECT p, place AS e, v FROM cut WHERE place < {entries})""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
          SELECT vec_id, p, any_value(x.v) AS v, min(
            (list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v)
             + list_inner_product(b.v, b.v))::BIGINT * {entries} + b.e) AS best
          FROM cut x JOIN book{r} b USING (p) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""sums{r} AS (
          SELECT p, e, i, floor(sum(x) / count(*)) AS x
          FROM (SELECT p, best % {entries} AS e, unnest(v) AS x,
                       generate_subscripts(v, 1) AS i FROM near{r})
          GROUP BY p, e, i)""")
            steps.append(f"""book{r + 1} AS MATERIALIZED (
          SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{r} b
          LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS v FROM sums{r} GROUP BY p, e) m
          USING (p, e))""")
    return f"""
        WITH {", ".join(steps)},
        coded AS (
          SELECT vec_id, string_agg(format('{{:02x}}', best % {entries}), '' ORDER BY p) AS code,
                 sum(best // {entries})::BIGINT AS error
          FROM near{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error,
               (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(
                  list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY p, e))
                FROM book{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)
    """


LLM_ORACLES = {
    "op8_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_vector_codes": _vector_codes(),
    "op13_collocations": r"""
        WITH lowered AS (
          SELECT doc_id, coalesce(lang, 'und') AS lang,
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
          FROM documents),
        pieces AS (
          SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
        lists AS (
          SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
          FROM pieces),
        starts AS (
          SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
        spans AS (SELECT lang, w, i, unnest(range(1, 5)) AS m FROM starts),
        counted AS (
          SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
          FROM spans WHERE i + m - 1 <= len(w) GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
        frequent AS (SELECT lang, m, phrase, f FROM counted WHERE f >= 30),
        cuts AS (
          SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k
          FROM frequent WHERE m >= 2),
        sides AS (
          SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS left_part,
                 array_to_string(w[k + 1:m], ' ') AS right_part FROM cuts),
        scored AS (
          SELECT s.lang, s.phrase, s.a, s.k, x.f AS l, y.f AS r,
                 (2000000::HUGEINT * s.a // (x.f + y.f))::BIGINT AS score
          FROM sides s
          JOIN frequent x ON x.lang = s.lang AND x.phrase = s.left_part
          JOIN frequent y ON y.lang = s.lang AND y.phrase = s.right_part),
        lowest AS (
          SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place
          FROM scored),
        candidates AS (SELECT lang, phrase, a, l, r, score FROM lowest WHERE place = 1),
        inside AS (
          SELECT c.lang, c.f, string_split(c.phrase, ' ') AS w, c.m,
                 unnest(range(1, c.m + 1)) AS i FROM frequent c WHERE c.m >= 3),
        parts AS (
          SELECT lang, f, array_to_string(w[i:i + size - 1], ' ') AS phrase
          FROM (SELECT *, unnest(range(2, m)) AS size FROM inside) WHERE i + size - 1 <= m),
        subsumed AS (
          SELECT DISTINCT c.lang, c.phrase FROM candidates c
          JOIN parts p ON p.lang = c.lang AND p.phrase = c.phrase
          WHERE 100::HUGEINT * p.f >= 80::HUGEINT * c.a),
        kept AS (
          SELECT * FROM candidates c WHERE NOT EXISTS (
            SELECT 1 FROM subsumed s WHERE s.lang = c.lang AND s.phrase = c.phrase)),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
          FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
