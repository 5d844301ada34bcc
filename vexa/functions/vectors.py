"""Vector metric Column builders (JVM-side, inside whole-stage codegen).

Conventions (fixed for the whole library):

* ``L2``      squared Euclidean distance, ascending.
* ``IP``      inner product, descending.
* ``COSINE``  dot / (|a| |b|), descending; 0.0 when either norm is 0.
* ``HAMMING`` number of differing bits, ascending.
* ``JACCARD`` 1 - |a and b| / |a or b| over bits, ascending; 0.0 when both
              are empty.

All arithmetic is done in double.  These builders evaluate one pair per row;
the many-queries search path is ``vexa.operators.knn.top_k``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ASCENDING = {"L2": True, "IP": False, "COSINE": False, "HAMMING": True, "JACCARD": True}
DENSE = ("L2", "IP", "COSINE")
BINARY = ("HAMMING", "JACCARD")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _zero() -> Column:
    return F.lit(0.0).cast("double")


def as_double(v) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def l2_sq(a, b) -> Column:
    a, b = _c(a), _c(b)
    d = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(d, _zero(), lambda acc, v: acc + v)


def dot(a, b) -> Column:
    a, b = _c(a), _c(b)
    p = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(p, _zero(), lambda acc, v: acc + v)


def norm(a) -> Column:
    a = _c(a)
    return F.sqrt(F.aggregate(a, _zero(), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    den = norm(a) * norm(b)
    return F.when(den == 0, _zero()).otherwise(dot(a, b) / den)


def normalize(a) -> Column:
    """v / |v|; a zero vector stays zero."""
    a = _c(a)
    n = norm(a)
    return F.when(n == 0, F.transform(a, lambda x: x.cast("double") * 0.0)).otherwise(
        F.transform(a, lambda x: x.cast("double") / n))


def scale(a, factor) -> Column:
    f = _c(factor) if not isinstance(factor, (int, float)) else F.lit(float(factor))
    return F.transform(_c(a), lambda x: x.cast("double") * f)


def head(a, n: int = 5) -> Column:
    return F.slice(_c(a), 1, n)


def sign_bits(v, dim: int) -> Column:
    """Pack ``v[i] > 0`` into ``ceil(dim/64)`` longs, bit i of word w = element 64w+i."""
    v = _c(v)
    words = (dim + 63) // 64

    def word(w):
        # one term per bit, unrolled: the sum of distinct powers stays inside generated code, a lambda per element would not
        bits = [F.when(F.get(v, F.lit(w * 64 + i)) > 0, F.lit((1 << i) if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
                for i in range(min(64, dim - w * 64))]
        while len(bits) > 1:
            bits = [bits[i].bitwiseOR(bits[i + 1]) if i + 1 < len(bits) else bits[i] for i in range(0, len(bits), 2)]
        return bits[0]

    return F.array(*[word(w) for w in range(words)])


def hamming(a, b) -> Column:
    """Differing bits of two packed long arrays."""
    x = F.zip_with(_c(a), _c(b), lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("long"))
    return F.aggregate(x, F.lit(0).cast("long"), lambda acc, v: acc + v)


def jaccard(a, b) -> Column:
    a, b = _c(a), _c(b)
    inter = F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseAND(q)).cast("long")),
                        F.lit(0).cast("long"), lambda acc, v: acc + v)
    union = F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseOR(q)).cast("long")),
                        F.lit(0).cast("long"), lambda acc, v: acc + v)
    return F.when(union == 0, _zero()).otherwise(F.lit(1.0) - inter.cast("double") / union.cast("double"))


def score(metric: str, a, b) -> Column:
    metric = metric.upper()
    return {"L2": l2_sq, "IP": dot, "COSINE": cosine, "HAMMING": hamming, "JACCARD": jaccard}[metric](a, b)


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(x)).cast("double") for x in values])
