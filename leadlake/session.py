"""Session construction and the shared warehouse location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

WAREHOUSE_CONF = "leadlake.warehouse.dir"


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           minimum: int = 200, expansion: float = 1.0) -> int:
    """Initial shuffle partition count for an input of ``input_bytes``.

    AQE can merge small shuffle partitions afterwards but cannot split large
    ones (skew joins aside), so the initial count must be big enough that a
    partition fits an executor's memory: input size x expansion / target size,
    e.g. ~400k for 100 TB at 256 MB."""
    return max(minimum, int(input_bytes * expansion // target_bytes) + 1)


def build_session(
    master: str | None = None,
    app_name: str = "leadlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session configured the way the lakehouse jobs expect.

    UTC session zone (``to_date`` of a timestamp depends on it), ANSI on,
    AQE with partition coalescing and skew-join splitting, dynamic partition
    overwrite for exports, no UI server. ``input_bytes`` (the size of the data
    a job reads) sizes the shuffle partitions when no count is given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Coalesce shuffle output to the advisory size rather than keeping at
        # least default-parallelism partitions (fewer, fuller reduce tasks).
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions is None and input_bytes is not None:
        shuffle_partitions = shuffle_partitions_for(input_bytes)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate() may hand back a running session: apply the runtime confs.
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
                "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(key, conf[key])
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when it is unset *and* the session is local (tests, a laptop) do we
    pick a fresh temporary folder; on a cluster a machine-local folder would be
    invisible to the executors, so we refuse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        current = spark.sparkContext.getCheckpointDir()
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="leadlake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def warehouse_dir(spark: SparkSession) -> str:
    """Root folder for written tables (bronze, exports, reporting).

    ``leadlake.warehouse.dir`` when set, else ``<spark.checkpoint.dir>/leadlake``.
    """
    configured = spark.conf.get(WAREHOUSE_CONF, None)
    if configured:
        return configured.rstrip("/")
    return os.path.join(checkpoint_dir(spark), "leadlake")
