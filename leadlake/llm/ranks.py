"""Ranks and running sums over tables of any size, without a window over a whole group.

Rows are dealt into ranges of the order, numbered inside their range, and moved up
by an offset from the small table of (range, group) totals. A hot group spreads
over as many ranges as it fills.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import written


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank",
           running: dict[str, str] | None = None, rows_per_range: int = 200_000, kind: str = "ranks") -> DataFrame:
    """``rows`` plus ``name``, the 0-based place within ``group`` by ``order`` (nulls first).

    ``running`` maps new columns to a column whose sum over the group's earlier rows they
    get. ``rows`` should be a written table: it is counted, then read again. Rows equal in
    all of ``group`` and ``order`` share a range; give the order a last column that keeps
    large ties apart."""
    ranges = max(1, -(-rows.count() // rows_per_range))
    # Written, as the range bounds come from a sample: both readers below must see the same ones.
    dealt = written(rows.repartitionByRange(ranges, *group, *order).withColumn("_range", F.spark_partition_id()), kind)
    sums = {"_before_all": F.count(F.lit(1))} | {f"_sum_{k}": F.sum(c) for k, c in (running or {}).items()}
    totals = dealt.groupBy(*group, "_range").agg(*[v.alias(k) for k, v in sums.items()])
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    if not group:  # a row per range
        earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, "_range", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(k) for k in sums])
    inside = Window.partitionBy(*group, "_range").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumns({name: F.row_number().over(inside) - 1}
                            | {k: F.coalesce(F.sum(c).over(before), F.lit(0)) for k, c in (running or {}).items()})
    out = out.join(offsets, [*group, "_range"])
    return out.withColumns({name: (F.col(name) + F.col("_before_all")).cast("long")}
                           | {k: F.col(k) + F.col(f"_sum_{k}") for k in running or {}}
                           ).drop("_range", *sums)
