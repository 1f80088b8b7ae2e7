"""Numeric expressions: guarded ratios, clamps, classification scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / nullif(coalesce(den, 0), 0)`` as DOUBLE (NULL instead of a
    division-by-zero error under ANSI)."""
    d = F.nullif(F.coalesce(_c(den), F.lit(0)), F.lit(0))
    return (_c(num) / d).cast("double")


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """``num / den`` when ``den > 0`` else 0.0 (precision / recall guard)."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def clamp(c: Column | str, lo, hi) -> Column:
    """``max(lo, min(hi, x))``; NULL stays NULL (greatest/least skip NULLs)."""
    x = _c(c)
    return F.when(x.isNull(), F.lit(None)).otherwise(
        F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def f1_score(precision: Column | str, recall: Column | str) -> Column:
    p, r = _c(precision), _c(recall)
    return (F.when(p.isNull() | r.isNull() | ((p + r) == 0), F.lit(None).cast("double"))
            .otherwise(2 * p * r / (p + r)))


def accuracy(tp, tn, fp, fn) -> Column:
    tp, tn, fp, fn = _c(tp), _c(tn), _c(fp), _c(fn)
    total = tp + tn + fp + fn
    bad = tp.isNull() | tn.isNull() | fp.isNull() | fn.isNull() | (total == 0)
    return F.when(bad, F.lit(None).cast("double")).otherwise((tp + tn) / total)
