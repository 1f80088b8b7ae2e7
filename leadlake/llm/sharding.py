"""Proportional stratified interleaving into shards.

Rows of a source are put in a seeded-shuffled order; the row of rank r among n
gets the fractional rank (2r - 1) / 2n. Sorting all rows by it interleaves the
sources in proportion, and cutting the sequence into equal runs gives every
shard the mixture of the whole. Law ``rows``: counts differ by at most one.

Ranks and positions are found by ranges and offsets (``ranks``), so that neither a hot
source nor the global order nor a large tie ends in one task: rows equal in everything
else are in the order of the table they were written to.

Defined results: a null text has no bytes (size 1); the null source is a source
of its own; a null id shuffles as the empty id; rows equal in all these are
interchangeable; an empty table gives an empty result. Equal texts play no part
in the law ``rows``: they go where their rows' order puts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import hex_long, seeded_hex, whole_text, written
from leadlake.llm.ranks import ranked

SEED = "shard-1"


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: str = SEED, rows_per_range: int = 200_000,
                       id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, source, fraction, position, shard, slot for every row."""
    text = whole_text(text_col)
    source = F.col(source_col).cast("string")
    rows = written(docs.select(
        F.col(id_col).alias("_id"), source.isNull().alias("_none"), F.coalesce(source, F.lit("")).alias("_src"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        hex_long(seeded_hex(seed, id_col)).alias("_key"), F.monotonically_increasing_id().alias("_n")), "shard-rows")
    total = rows.count()
    ties = ["_key", "_id", "text_crc32", "size", "_n"]
    sources = written(rows.groupBy("_none", "_src").agg(F.count(F.lit(1)).alias("_of")), "shard-sources")
    in_source = ranked(rows, ["_none", "_src"], ties, "_rank", rows_per_range=rows_per_range, kind="shard-ranks")
    shares = written(in_source.join(sources, ["_none", "_src"])
                     .withColumn("fraction", (2 * F.col("_rank") + 1) / (2 * F.col("_of"))).drop("_rank", "_of"), "shard-fractions")
    placed = ranked(shares, [], ["fraction", "_none", "_src", *ties], "position", rows_per_range=rows_per_range,
                    kind="shard-positions")
    rows_in_all = max(total, 1)
    return (placed.withColumn("shard", F.expr(f"cast(position * {shards} div {rows_in_all}L as int)"))
            .withColumn("slot", F.expr(f"position - (shard * {rows_in_all}L + {shards - 1}) div {shards}"))
            .select(F.col("_id").alias(id_col), "size", "text_crc32",
                    F.when(~F.col("_none"), F.col("_src")).alias(source_col),
                    "fraction", "position", "shard", "slot"))
