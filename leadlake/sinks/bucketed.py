"""A keyed table in hash buckets, with a manifest per version.

Rows lie in the folder of their key's bucket. A version is a manifest: which folder holds
each bucket. An upsert reads and rewrites only the buckets that its batch falls in; the
new manifest names the new folders for these and the old ones for all others. It is
written once the data is, and the pointer (``_log``) moves last: readers see a whole
version or the one before. Single writer per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.functions.literal import literal_rows
from leadlake.sinks.lake import commit_version, current_table_version, new_version_path

_MANIFEST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n_buckets", T.IntegerType()),
                          T.StructField("path", T.StringType())])
BUCKETS = 64


def bucket_of(keys: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(n_buckets)).cast("int")


def manifest(spark: SparkSession, base: str, version: str | None = None) -> tuple[int | None, dict[int, str]]:
    """(number of buckets, bucket -> folder) of the current or a given version: a row per bucket that has rows."""
    version = version or current_table_version(spark, base)
    if version is None:
        return None, {}
    rows = spark.read.schema(_MANIFEST).parquet(f"{version}/manifest").collect()  # at most n_buckets + 1
    return rows[0]["n_buckets"], {r["bucket"]: r["path"] for r in rows if r["path"] is not None}


def _write_manifest(spark: SparkSession, base: str, version: str, n_buckets: int, folders: dict[int, str]) -> str:
    rows = [(b, n_buckets, p) for b, p in sorted(folders.items())] or [(None, n_buckets, None)]
    literal_rows(spark, _MANIFEST, rows).coalesce(1).write.parquet(f"{version}/manifest")
    return commit_version(spark, base, version)


def create(spark: SparkSession, base: str, n_buckets: int = BUCKETS) -> str:
    """An empty table; its current version if there is one already."""
    return current_table_version(spark, base) or _write_manifest(spark, base, new_version_path(base), n_buckets, {})


def read(spark: SparkSession, base: str, schema: T.StructType, version: str | None = None,
         buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version (all buckets or some); an empty typed table where there is none."""
    folders = manifest(spark, base, version)[1]
    paths = [p for b, p in sorted(folders.items()) if buckets is None or b in set(buckets)]
    if not paths:
        return literal_rows(spark, schema, [])
    return spark.read.schema(schema).parquet(*paths)


def check_batch(batch: DataFrame, keys: Sequence[str]) -> None:
    """An error if a key is NULL (a NULL equals nothing, so it would come again with every sync) or repeated."""
    cols = [F.col(f"`{k}`") for k in keys]
    no_key = F.lit(False)
    for c in cols:
        no_key = no_key | c.isNull()
    bad = batch.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(no_key | (F.col("n") > 1)).limit(5).collect()
    if bad:
        raise ValueError(f"the batch has no or repeated {list(keys)}: {[tuple(r)[:-1] for r in bad]}")


def upsert(spark: SparkSession, base: str, batch: DataFrame, keys: Sequence[str], schema: T.StructType,
           n_buckets: int = BUCKETS) -> str:
    """Replace the rows whose key is in the batch and add the new ones; returns the new version.

    ``batch`` is read several times: pass a written table. ``n_buckets`` counts for a new table only."""
    check_batch(batch, keys)
    create(spark, base, n_buckets)
    n, folders = manifest(spark, base)
    new = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    new = new.withColumn("_bucket", bucket_of(keys, n))
    touched = sorted(r["_bucket"] for r in new.select("_bucket").distinct().collect())  # at most n
    if not touched:
        return current_table_version(spark, base)
    old = read(spark, base, schema, buckets=touched).withColumn("_bucket", bucket_of(keys, n))
    kept = old.join(new.select(*[f"`{k}`" for k in keys]), list(keys), "left_anti").select(*new.columns)
    version = new_version_path(base)
    (kept.unionByName(new).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{version}/data"))
    folders |= {b: f"{version}/data/_bucket={b}" for b in touched}
    return _write_manifest(spark, base, version, n, folders)
