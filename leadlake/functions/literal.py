"""Small literal tables built on the JVM (no Python worker involved)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, schema: StructType, rows: Sequence[Sequence]) -> DataFrame:
    """A DataFrame of a few driver-side values (report rows, run parameters).

    Built as ``range(1)`` + ``inline`` of literal structs, so it is a JVM
    plan: ``createDataFrame`` from a Python list would start Python workers
    to deserialize the rows. Meant for a bounded handful of rows only.
    """
    if not rows:
        return spark.range(0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
