"""A dictionary of category levels: fitted once, stored by version, applied later.

One-hot columns found anew in every relation differ as soon as a level is new or gone, and
a model no longer finds its columns. Here the levels of the training rows are written as a
table; training and scoring both apply that version, so their columns are the same, and a
level that the dictionary lacks is handled by a rule that has to be named.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions.categories import one_hot
from leadlake.functions.text import safe_name
from leadlake.sinks.lake import current_table_version, write_table_version

MAX_LEVELS = 1000
RULES = ("zeros", "column", "error")


def fit_levels(df: DataFrame, cols: Sequence[str], base: str, max_levels: int = MAX_LEVELS) -> str:
    """Write the distinct non-NULL levels of each column as a new version at ``base``; returns its path.

    (column_name, level) pairs by a distinct with partial aggregation: a hot level is a row per task. More than
    ``max_levels`` of a column are an error, and the version before stays."""
    if not cols:
        raise ValueError("there are no columns to fit")
    pairs = reduce(DataFrame.unionByName, [
        df.where(F.col(f"`{c}`").isNotNull()).select(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("level"))
        for c in cols]).distinct()
    many = pairs.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_levels).collect()
    if many:
        raise ValueError(f"more than {max_levels} levels: {sorted((r['column_name'], r['n']) for r in many)}")
    for c, levels in _by_column(pairs, cols).items():
        dummy_names(c, levels)  # an error here, not in the scoring job
    return write_table_version(pairs.coalesce(1), base)


def _by_column(pairs: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    rows = pairs.collect()  # at most max_levels a column
    return {c: sorted(r["level"] for r in rows if r["column_name"] == c) for c in cols}


def load_levels(spark: SparkSession, base: str, cols: Sequence[str], version: str | None = None) -> dict[str, list[str]]:
    """Column -> its levels, ascending, from the current or a given version."""
    version = version or current_table_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"no dictionary at {base}")
    return _by_column(spark.read.schema("column_name string, level string").parquet(version), cols)


def dummy_names(col: str, levels: Sequence[str]) -> list[str]:
    """The dummies' names; two levels that get the same one are an error."""
    names = [safe_name(col, v) for v in levels]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"levels of {col} share the columns {twice}")
    return names


def apply_levels(df: DataFrame, levels: Mapping[str, Sequence[str]], unseen: str = "zeros",
                 keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and a dummy per level of the dictionary, whatever ``df`` holds.

    A NULL has all dummies 0. A level that isn't in the dictionary: ``zeros`` too, ``column`` sets
    ``<col>__unseen``, ``error`` ends the job."""
    if unseen not in RULES:
        raise ValueError(f"unseen must be one of {RULES}")
    out = [F.col(f"`{c}`") for c in (keep if keep is not None else df.columns)]
    for c, known in levels.items():
        text = F.col(f"`{c}`").cast("string")
        new = text.isNotNull() & (~text.isin(list(known)) if known else F.lit(True))
        dummies = [one_hot(text, v).alias(n) for v, n in zip(known, dummy_names(c, known))]
        if unseen == "error":
            failed = F.raise_error(F.concat(F.lit(f"{c} has a level the dictionary lacks: "), text)).cast("int")
            dummies = [F.when(new, failed).otherwise(d).alias(n) for d, n in zip(dummies, dummy_names(c, known))]
        out += dummies
        if unseen == "column":
            out.append(F.when(new, 1).otherwise(0).alias(f"{c}__unseen"))
    return df.select(*out)
