"""Text Column builders: tokenizer, per-row term counts, text match.

Token rule (fixed): lower-cased maximal runs of Unicode letters or digits,
``[\\p{L}\\p{N}]+``.  Unsegmented CJK runs are one token.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed token pattern: Unicode letters and digits.
TOKEN_PATTERN = r"([\p{L}\p{N}]+)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokenize(text) -> Column:
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 1)


def explode_tokens(tokens) -> Column:
    """One row per token.

    ``explode_outer`` (plus a null filter on the result by the caller) rather
    than ``explode``: for an inner explode Spark infers ``size(x) > 0 AND x IS
    NOT NULL`` and pushes it below the projection, which would run the regex
    tokenizer three times per document instead of once."""
    return F.explode_outer(_c(tokens))


def text_match(text, query: str) -> Column:
    """True when the text holds any token of the query (OR semantics)."""
    q = [t for t in _py_tokens(query)]
    return F.arrays_overlap(tokenize(text), F.array(*[F.lit(t) for t in q]))


def _py_tokens(s: str) -> list[str]:
    import regex
    return regex.findall(r"[\p{L}\p{N}]+", s.lower())
