"""DuckDB SQL for the queries of this folder that SQL can express.

The others are tested against brute force in ``tests/llm``.
"""

ORACLE: dict[str, str] = {
    "op2_topk_search": """
        WITH whole AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT)
                       AS score
            FROM whole AS q JOIN whole AS c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ),
        ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
