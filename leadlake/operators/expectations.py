"""Expectations of a model, checked together in one aggregate over one scan.

A model's expectations are columns without NULLs, one column of unique values, and
accepted values by column. All are counted in the same aggregate: the uniqueness is its
only distinct count, so Spark first groups by that column (partially, before the
shuffle) and every other count rides along.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.operators.quality import REPORT_COLUMNS

REPORT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in zip(REPORT_COLUMNS, (
    T.StringType(), T.StringType(), T.StringType(), T.LongType(), T.BooleanType()))])


@dataclass(frozen=True)
class Expectations:
    model: str
    not_null: Sequence[str] = ()
    unique: str | None = None
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    at_least_rows: int = 0


def _q(name: str):
    return F.col(f"`{name}`")


def check(df: DataFrame, expected: Expectations) -> DataFrame:
    """A report row per expectation. Failing rows are counted: NULLs, rows whose value another row has already,
    rows with a value outside the list (NULL passes), rows too few."""
    tests = [("not_null", c, F.count_if(_q(c).isNull())) for c in expected.not_null]
    if expected.unique:
        tests.append(("unique", expected.unique, F.count(_q(expected.unique)) - F.count_distinct(_q(expected.unique))))
    tests += [("accepted_values", c, F.count_if(_q(c).isNotNull() & ~_q(c).isin(list(values))))
              for c, values in expected.accepted.items()]
    tests.append(("row_count", "*", F.greatest(F.lit(expected.at_least_rows) - F.count(F.lit(1)), F.lit(0))))
    found = df.agg(*[n.cast("long").alias(f"_f{k}") for k, (_, _, n) in enumerate(tests)])
    rows = F.array(*[F.struct(F.lit(expected.model).alias("model"), F.lit(test).alias("test"), F.lit(c).alias("column_name"),
                              F.col(f"_f{k}").alias("failing_rows"), (F.col(f"_f{k}") == 0).alias("passed"))
                     for k, (test, c, _) in enumerate(tests)])
    return found.select(F.inline(rows))
