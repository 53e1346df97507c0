"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def _total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def norm(a: Column | str) -> Column:
    return F.sqrt(_total(F.transform(_doubles(a), lambda x: x * x)))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 if either vector is zero."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def _divide(a: Column, size: Column) -> Column:
    # The divisor is laid out beside the values, so it is computed once per vector.
    return F.zip_with(a, F.array_repeat(size, F.size(a)), lambda x, s: x / s)


def l2_normalize(a: Column | str, floor: float = 1e-12) -> Column:
    """Divide by the length, which is taken as at least ``floor``."""
    return _divide(_doubles(a), F.greatest(norm(a), F.lit(floor)))


def l2_normalize_plus(a: Column | str, epsilon: float = 1e-12) -> Column:
    """Divide by the length plus ``epsilon``."""
    return _divide(_doubles(a), norm(a) + F.lit(epsilon))


def masked_mean(vectors: Column | str, mask: Column | str) -> Column:
    """Element-wise mean of the vectors whose mask is 1 (token vectors of one text)."""
    vectors, mask = (F.col(c) if isinstance(c, str) else c for c in (vectors, mask))
    masked = F.zip_with(vectors, mask, lambda v, m: F.when(m == 1, v.cast("array<double>")))
    kept = F.array_compact(masked)
    zero = F.array_repeat(F.lit(0.0), F.size(F.element_at(vectors, 1)))
    total = F.aggregate(kept, zero, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y))
    return _divide(total, F.greatest(F.size(kept), F.lit(1)).cast("double"))


def argmax(scores: Column | str) -> Column:
    """Zero-based place of the largest value (the first one on a tie)."""
    scores = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def to_list(vector: Column | str) -> Column:
    """Dense array of an ML vector, for exports."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(vector) if isinstance(vector, str) else vector)
