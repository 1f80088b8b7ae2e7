"""Data-quality checks. Each check reads the relation(s) in full with
distributed aggregates and returns a small report DataFrame; nothing but the
report reaches the driver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from leadlake.functions.literal import literal_rows
from leadlake.functions.timefmt import utc_date

REPORT_COLUMNS = ["model", "test", "column_name", "failing_rows", "passed"]


def _q(name: str):
    return F.col(f"`{name}`")


def _report(agg_row: DataFrame, model: str, test: str, cols: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate with columns ``_f0.._fn`` into report rows."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.col(f"_f{i}").cast("long").alias("failing_rows"))
                        for i, c in enumerate(cols)])
    return (agg_row.select(F.inline(entries))
            .select(F.lit(model).alias("model"), F.lit(test).alias("test"), "column_name",
                    "failing_rows", (F.col("failing_rows") == 0).alias("passed")))


def not_null_report(df: DataFrame, model: str, cols: Sequence[str]) -> DataFrame:
    """Failing rows = NULLs in the column; all columns in one pass."""
    agg = df.agg(*[F.count_if(_q(c).isNull()).alias(f"_f{i}") for i, c in enumerate(cols)])
    return _report(agg, model, "not_null", cols)


def unique_report(df: DataFrame, model: str, cols: Sequence[str]) -> DataFrame:
    """Failing rows = non-NULL values that occur more than once.

    One grouped count per column; the partial aggregate before the shuffle
    folds a hot value to one row per map task."""
    parts = []
    for c in cols:
        dupes = (df.where(_q(c).isNotNull()).groupBy(_q(c).alias("v")).count()
                 .where(F.col("count") > 1))
        parts.append(dupes.agg(F.count("*").alias("_f0")).select(
            F.lit(model).alias("model"), F.lit("unique").alias("test"),
            F.lit(c).alias("column_name"), F.col("_f0").cast("long").alias("failing_rows"),
            (F.col("_f0") == 0).alias("passed")))
    return reduce(DataFrame.unionByName, parts)


def accepted_values_report(df: DataFrame, model: str,
                           spec: Mapping[str, Sequence]) -> DataFrame:
    """Failing rows = distinct non-NULL values outside the accepted list
    (NULL passes, as ``x NOT IN (...)`` is not true for NULL).

    One scan: each row emits only its failing (column, value) pairs (usually
    none), so almost nothing leaves the map side -- unlike one
    COUNT(DISTINCT) per column, which Spark plans as an Expand copying every
    row once per tested column. Columns without failures report 0.
    """
    cols = list(spec)
    pair = T.StructType([T.StructField("column_name", T.StringType()),
                         T.StructField("value", T.StringType())])
    empty = F.array().cast(T.ArrayType(pair))
    failing = [F.when(_q(c).isNotNull() & ~_q(c).isin(list(spec[c])),
                      F.array(F.struct(F.lit(c).alias("column_name"),
                                       _q(c).cast("string").alias("value"))))
               .otherwise(empty) for c in cols]
    bad = (df.select(F.explode(F.concat(*failing)).alias("p")).select("p.*")
           .distinct())
    every = literal_rows(df.sparkSession, pair, [(c, None) for c in cols])
    counts = bad.unionByName(every).groupBy("column_name").agg(
        F.count("value").alias("failing_rows"))
    return counts.select(F.lit(model).alias("model"), F.lit("accepted_values").alias("test"),
                         "column_name", F.col("failing_rows").cast("long"),
                         (F.col("failing_rows") == 0).alias("passed"))


def row_count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, n)`` per relation, stacked with UNION ALL."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def parity_report(source: DataFrame, bronze: DataFrame, scope: str = "per_date",
                  source_date=None, bronze_date: str = "ingestion_date") -> DataFrame:
    """Compare message counts with bronze counts.

    ``per_date``: one row per ingestion date, both sides counted per date
    (so a re-run that grows the topic does not report loss for old dates).
    ``whole_topic``: one row, all messages against all bronze rows.
    Status: ``ok`` (equal), ``warning`` (bronze has more), ``data_loss``
    (bronze has fewer; ``missing_rows`` says how many).
    """
    if scope not in ("per_date", "whole_topic"):
        raise ValueError("scope must be 'per_date' or 'whole_topic'")
    if source_date is None:
        source_date = utc_date("timestamp")
    # Both counts from one union + aggregate: no join of the two sides, and a
    # NULL date is one group.
    both = (source.select(source_date.alias("ingestion_date"), F.lit(1).alias("_s"), F.lit(0).alias("_b"))
            .unionByName(bronze.select(F.col(bronze_date).alias("ingestion_date"),
                                       F.lit(0).alias("_s"), F.lit(1).alias("_b"))))
    counts = [F.sum("_s").alias("source_rows"), F.sum("_b").alias("bronze_rows")]
    if scope == "per_date":
        joined = both.groupBy("ingestion_date").agg(*counts)
    else:
        joined = both.agg(*counts).withColumn("ingestion_date", F.lit(None).cast("date"))
    src = F.coalesce(F.col("source_rows"), F.lit(0))
    brz = F.coalesce(F.col("bronze_rows"), F.lit(0))
    return joined.select(
        "ingestion_date", src.alias("source_rows"), brz.alias("bronze_rows"),
        F.when(src == brz, "ok").when(brz > src, "warning").otherwise("data_loss")
        .alias("status"),
        F.when(brz < src, src - brz).otherwise(F.lit(0)).cast("long").alias("missing_rows"))


def partition_report(table: DataFrame, partition_column: str = "ingestion_date",
                     first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Per partition: number of data files, rows, and whether files exist.

    With ``first`` and ``last`` every expected date has a row, also one that
    has no partition."""
    found = (table.groupBy(partition_column)
             .agg(F.count_distinct(F.col("_metadata.file_path")).alias("n_files"),
                  F.count("*").alias("n_rows")))
    if first is not None and last is not None:
        days = (last - first).days + 1
        expected = table.sparkSession.range(days).select(
            F.date_add(F.lit(first), F.col("id").cast("int")).alias(partition_column))
        found = expected.join(found, partition_column, "full_outer")
    return found.select(partition_column, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_files", "n_rows")],
                        (F.coalesce(F.col("n_files"), F.lit(0)) > 0).alias("partition_exists"))


def schema_matches(df: DataFrame, expected: StructType) -> bool:
    """Names and types equal (nullability ignored)."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    return got == want


def relation_check(df: DataFrame, order_by: Sequence[str], n: int = 5) -> dict:
    """Existence / count / sample of a relation (exit-code style summary).

    The sample is the first ``n`` rows of a total order (a top-k per task,
    merged), so it is repeatable."""
    count = df.count()
    sample = df.orderBy(*[_q(c) for c in order_by]).limit(n).collect()
    return {"exists": True, "count": count, "sample": sample,
            "status": "ok" if count > 0 else "empty"}
