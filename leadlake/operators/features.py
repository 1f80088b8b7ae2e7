"""Feature engineering: mean imputation, text cleaning, bucketing, one-hot,
feature profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.functions.categories import one_hot
from leadlake.functions.literal import literal_rows
from leadlake.functions.text import clean_text, safe_name, safe_name_col


def column_means(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """One row: the mean of each column over the whole set (NULLs ignored).

    A partial + final aggregate: map tasks pre-sum, one tiny row is merged.
    With ``exact`` the sums are accumulated in DECIMAL(38,18), so the mean
    does not depend on how rows were partitioned or in which order partial
    sums were merged (a DOUBLE sum does, in the last bits). A column with a
    value or a sum that this type can't hold (from 1e20 on, infinities) gets
    the mean of a DOUBLE sum instead.
    """
    if exact:
        # Exact DECIMAL sum, rounded to double once, then one division: the
        # correctly rounded mean in practice (AVG over DECIMAL would round the
        # quotient to a fixed scale first). Empty input -> NULL. Whole numbers
        # are summed as such; a NaN makes the mean NaN, as a DOUBLE sum would.
        kinds = dict(df.dtypes)

        def mean(c: str) -> Column:
            x = F.col(c)
            as_double = F.avg(x.cast("double"))
            if kinds[c] in ("double", "float"):
                part = F.nanvl(x, F.lit(None).cast("double")).try_cast("decimal(38,18)")
                exact_mean = F.try_divide(F.try_sum(part).cast("double"), F.count(x))
                fits = F.bool_and(part.isNotNull() | x.isNull()) & F.try_sum(part).isNotNull()
                return (F.when(F.bool_or(F.isnan(x)), F.lit(float("nan"))).when(fits, exact_mean)
                        .otherwise(as_double).alias(c))
            total = F.try_sum(x if kinds[c].startswith("decimal") else x.cast("decimal(38,0)"))
            return F.coalesce(F.try_divide(total.cast("double"), F.count(x)), as_double).alias(c)

        return df.agg(*[mean(c) for c in cols])
    return df.agg(*[F.avg(F.col(c)).alias(c) for c in cols])


def impute_mean(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """``coalesce(x, avg(x) over ())`` for each column, without the
    single-partition window: the means are one aggregate evaluated as a
    scalar subquery evaluated once, and its value is inlined into the
    projection of the big side -- no join, no shuffle of the rows imputed."""
    means = column_means(df, cols, exact)
    # One subquery returning a struct of all means: every reference is the
    # same expression, so it runs once and the others are ReusedSubquery.
    m = means.select(F.struct(*[F.col(c) for c in cols]).alias("m")).scalar()
    bound = df.withColumn("_means", m)
    return bound.withColumns(
        {c: F.coalesce(F.col(c), F.col("_means").getField(c)) for c in cols}).drop("_means")


def clean_text_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``nullif(trim(cast(c as string)), '')`` for each column."""
    return df.withColumns({c: clean_text(c) for c in cols})


def distinct_levels(df: DataFrame, col: str, max_levels: int = 1000) -> list:
    """Sorted distinct non-NULL values of ``col``.

    Computed with a distributed distinct (partial aggregation before the
    shuffle); at most ``max_levels + 1`` values reach the driver, and more
    than ``max_levels`` is an error rather than an unbounded collect.
    """
    rows = (df.where(F.col(col).isNotNull()).select(F.col(col).alias("v")).distinct()
              .orderBy(F.col("v").asc()).limit(max_levels + 1).collect())
    if len(rows) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} distinct values; "
                         "raise max_levels or bucket the column first")
    return [r["v"] for r in rows]


def one_hot_columns(col: str, levels: Sequence, prefix: str,
                    drop_first: bool = False) -> list[Column]:
    """``case when col = level then 1 else 0 end as <safe name>`` per level."""
    levels = list(levels)[1:] if drop_first and levels else list(levels)
    named: dict[str, object] = {}
    for v in levels:
        name = safe_name(prefix, str(v))
        if name in named:
            raise ValueError(f"levels {named[name]!r} and {v!r} of {col} both become column {name!r}")
        named[name] = v
    return [one_hot(col, v).alias(safe_name(prefix, str(v))) for v in levels]


def one_hot_dynamic(df: DataFrame, col: str, prefix: str, drop_first: bool = False,
                    max_levels: int = 1000, keep: Sequence[str] | None = None) -> DataFrame:
    """Append one dummy per distinct level of ``col`` (levels found by a
    bounded distributed distinct, ascending order). ``keep`` selects the
    columns kept before the dummies (all columns by default)."""
    levels = distinct_levels(df, col, max_levels)
    base = [F.col(f"`{c}`") for c in (keep if keep is not None else df.columns)]
    return df.select(*base, *one_hot_columns(col, levels, prefix, drop_first))


def one_hot_long(df: DataFrame, col: str, prefix: str, key: str) -> DataFrame:
    """(key, dummy) rows: the dummy that is 1 for each row, for any number of levels.

    The sparse form of ``one_hot_dynamic``: nothing passes through the driver;
    rows without a level have no dummy."""
    return (df.where(F.col(col).isNotNull())
            .select(F.col(f"`{key}`"), safe_name_col(prefix, F.col(col).cast("string")).alias("dummy")))


def feature_profile(df: DataFrame, cols: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Per feature: min, max, number of distinct non-NULL non-NaN values and a
    constant flag (distinct <= 1). Every feature has a row: one without any
    value has no minimum and 0 distinct values, and is constant.

    Exact (default): unpivot to (feature, value), de-duplicate (feature,
    value) with a partial aggregate, then aggregate per feature.
    Low-cardinality features collapse map-side; no per-column COUNT(DISTINCT)
    expansion. ``approx=True``: one pass with a HyperLogLog++ sketch per
    column (relative error ``rsd``) and no shuffle beyond the one-row
    partials -- for very wide or very large tables. A constant column still
    reports 1 there.
    """
    if approx:
        valid = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")),
                           F.col(f"`{c}`").cast("double")) for c in cols}
        aggs = []
        for i, c in enumerate(cols):
            aggs += [F.min(valid[c]).alias(f"_mn{i}"), F.max(valid[c]).alias(f"_mx{i}"),
                     F.approx_count_distinct(valid[c], rsd).alias(f"_nd{i}")]
        entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_mn{i}").alias("min_value"),
                                     F.col(f"_mx{i}").alias("max_value"),
                                     F.col(f"_nd{i}").alias("n_distinct"))
                            for i, c in enumerate(cols)])
        return (df.agg(*aggs).select(F.inline(entries))
                .withColumn("is_constant", F.col("n_distinct") <= 1))
    long = (df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c)
                        for c in cols])
              .unpivot([], list(cols), "feature", "value"))
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("value", T.DoubleType())])
    every = literal_rows(df.sparkSession, schema, [(c, None) for c in cols])
    per_value = long.unionByName(every).distinct()
    return (per_value.groupBy("feature")
            .agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"),
                 F.count("value").alias("n_distinct"))
            .withColumn("is_constant", F.col("n_distinct") <= 1))
