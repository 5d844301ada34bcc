"""DuckDB SQL fragments shared by the oracles (kept as plain SQL text)."""

# Per-label mean vector, the query set of every dense search oracle.
CENTROIDS = """
q AS (
  SELECT label AS qid, list(m ORDER BY pos) AS qv FROM (
    SELECT label, pos, avg(x::DOUBLE) AS m FROM (
      SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS pos
      FROM embeddings
    ) GROUP BY label, pos
  ) GROUP BY label
)"""


def l2(a: str, b: str) -> str:
    return (f"list_sum(list_transform(list_zip({a}, {b}), "
            f"lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))")


def ip(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda x: x[1]::DOUBLE * x[2]::DOUBLE))"


def norm(a: str) -> str:
    return f"sqrt(list_sum(list_transform({a}, lambda x: x::DOUBLE * x::DOUBLE)))"


def cosine(a: str, b: str) -> str:
    return (f"CASE WHEN {norm(a)} * {norm(b)} = 0 THEN 0.0::DOUBLE "
            f"ELSE {ip(a, b)} / ({norm(a)} * {norm(b)}) END")


def hamming_sign(a: str, b: str) -> str:
    return (f"list_sum(list_transform(list_zip({a}, {b}), "
            f"lambda x: CASE WHEN (x[1] > 0) <> (x[2] > 0) THEN 1 ELSE 0 END))::DOUBLE")


def jaccard_sign(a: str, b: str) -> str:
    inter = (f"list_sum(list_transform(list_zip({a}, {b}), "
             f"lambda x: CASE WHEN x[1] > 0 AND x[2] > 0 THEN 1 ELSE 0 END))")
    union = (f"list_sum(list_transform(list_zip({a}, {b}), "
             f"lambda x: CASE WHEN x[1] > 0 OR x[2] > 0 THEN 1 ELSE 0 END))")
    return f"CASE WHEN {union} = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - {inter}::DOUBLE / {union}::DOUBLE END"


def scaled(vec: str, factor: str) -> str:
    return f"list_transform({vec}, lambda x: x::DOUBLE * ({factor}))"


def topk(candidates: str, k: int, order: str, id_col: str, extra: str = "") -> str:
    """Rank a (qid, id, d) candidate relation, keep k per qid."""
    return f"""
SELECT qid, {id_col}, round(d, 6) AS score, rk AS rank{extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d {order}, {id_col}) AS rk FROM ({candidates})
) WHERE rk <= {k}"""


# Token rule shared by every text operator: lower-cased runs of letters and digits.
TOKENS = r"regexp_extract_all(lower({col}), '([\p{{L}}\p{{N}}]+)', 1)"


def tokens(col: str) -> str:
    return TOKENS.format(col=col)
