"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.session import checkpoint_dir

#: A word as the contracts define it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Gives the Python workers this package, once per application (a no-op where it came as a zip)."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped and os.path.isdir(_PACKAGE):
        home, name = os.path.split(_PACKAGE)
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", home, name)
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder (``spark.checkpoint.dir``) and read back.

    Cuts the lineage in a way that outlives executors, and gives the planner
    the true size of the table. The folder gets a fresh name on every call."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str | Column = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def id_text(column: str | Column = "doc_id") -> Column:
    """The id as text; null counts as empty."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def seeded_hex(seed: str, column: str | Column = "doc_id") -> Column:
    """128 pseudo-random bits of an id under a seed, as hex: equal on every rerun."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_text(column)))


def hex_long(text: Column, digits: int = 15) -> Column:
    """The first hex digits as a long (15 digits: 60 bits)."""
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("long")


def in_fold(column: str, folds: int, fold: int) -> Column:
    """Whether crc32(id as text) mod ``folds`` is ``fold``."""
    return F.crc32(id_text(column).cast("binary")) % F.lit(folds) == F.lit(fold)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def map_texts(df: DataFrame, make: Callable[[], Callable], fields: dict[str, str], text_col: str = "_text",
              rows_at_once: int = 256, many: bool = False) -> DataFrame:
    """``df`` without its text column, plus ``fields`` computed from the texts.

    ``make()`` runs once per task and returns a function from a list of texts
    (null: None) to a list of tuples, one per text; with ``many``, a list of
    lists of tuples (a row for each). All other columns pass through as Arrow
    arrays, untouched. Texts become Python strings ``rows_at_once`` at a time."""
    ship_code(df.sparkSession)
    kept = [c for c in df.columns if c != text_col]
    names = [*kept, *fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                got = fn(part.column(text_col).to_pylist())
                if many:
                    place = pa.array([i for i, rows in enumerate(got) for _ in rows], pa.int64())
                    got = [row for rows in got for row in rows]
                columns = list(zip(*got)) if got else [()] * len(fields)
                same = [part.column(c).take(place) if many else part.column(c) for c in kept]
                new = [pa.array(x, _ARROW[t]) for x, t in zip(columns, fields.values())]
                yield pa.RecordBatch.from_arrays([*same, *new], names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text_col),
                        *(f"{n} {t}" for n, t in fields.items())])
    return df.mapInArrow(run, schema)


def maybe_among(df: DataFrame, key, wanted: DataFrame, bits: int = 25) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be one of ``wanted``'s (a one-column table): a superset of them.

    Wanted keys are hashed into a bitmap of 2 ** bits bits, 4 MB by default
    whatever the number of keys, which is what gets broadcast; an exact join on
    the rows left is up to the caller. Saves shuffling whole texts for a few."""
    bit = F.pmod(F.xxhash64(F.col(f"`{wanted.columns[0]}`")), F.lit(1 << bits))
    # 512 words of 64 bits a row.
    words = wanted.select(bit.alias("b")).selectExpr(
        "shiftright(b, 15) AS _map_group", "cast(shiftright(b, 6) & 511 AS int) AS w", "shiftleft(1L, cast(b & 63 AS int)) AS v")
    words = words.groupBy("_map_group", "w").agg(F.bit_or("v").alias("v")).groupBy("_map_group").agg(
        F.map_from_entries(F.collect_list(F.struct("w", "v"))).alias("m"))
    maps = words.select("_map_group", F.transform(F.sequence(F.lit(0), F.lit(511)), lambda w: F.coalesce(
        F.try_element_at("m", w), F.lit(0).cast("long"))).alias("_map"))
    there = F.expr("(shiftrightunsigned(get(_map, cast(shiftright(_map_bit, 6) & 511 AS int)), cast(_map_bit & 63 AS int)) & 1) = 1")
    marked = df.withColumn("_map_bit", F.pmod(F.xxhash64(key), F.lit(1 << bits)))
    return (marked.withColumn("_map_group", F.shiftright("_map_bit", 15)).join(F.broadcast(maps), "_map_group")
            .where(there).drop("_map_group", "_map_bit", "_map"))
