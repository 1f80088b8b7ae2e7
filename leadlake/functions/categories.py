"""Categorical expressions: bucketing, one-hot, seeded weighted assignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_categories(c: Column | str, keep: Sequence[str], other: str,
                      null_label: str | None = None) -> Column:
    """Listed values pass through, others fold into ``other``.

    With ``null_label`` NULL gets its own level; without, NULL falls into
    ``other`` (``x IN (...)`` is not true for NULL).
    """
    x = _c(c)
    keep_expr = F.when(x.isin(list(keep)), x)
    if null_label is not None:
        keep_expr = F.when(x.isNull(), F.lit(null_label)).when(x.isin(list(keep)), x)
    return keep_expr.otherwise(F.lit(other))


def one_hot(c: Column | str, value: str) -> Column:
    """1 when the column equals ``value`` else 0 (NULL -> 0)."""
    return F.when(_c(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def hash_bucket(key: Column | str, seed: int, buckets: int) -> Column:
    """Deterministic bucket in ``[0, buckets)`` from md5 of ``key:seed``.

    Depends only on the key, so the result is the same under any
    partitioning or task retry (unlike ``rand``)."""
    digest = F.md5(F.concat(_c(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def weighted_category(key: Column | str, weights: Mapping[str, int], seed: int = 42) -> Column:
    """Pick a value with the given integer weights, repeatably per key.

    The md5 bucket of (key, seed) modulo the total weight is mapped through
    the cumulative weights; equal weights give a uniform choice, two weights
    a yes/no with probability w1/(w1+w2).
    """
    items = [(v, int(w)) for v, w in weights.items() if int(w) > 0]
    if not items:
        raise ValueError("weights must contain a positive weight")
    total = sum(w for _, w in items)
    b = hash_bucket(key, seed, total)
    expr = None
    upper = 0
    for value, w in items[:-1]:
        upper += w
        expr = F.when(b < upper, F.lit(value)) if expr is None else expr.when(b < upper, F.lit(value))
    last = F.lit(items[-1][0])
    return last if expr is None else expr.otherwise(last)
