"""Exact deduplication: groups by a 128-bit content hash, bytes compared inside each group.

``groupBy(hash, text)`` puts rows in one group only if both the hash and the
bytes are equal, and sums up within each task before the shuffle, so a group
that holds a third of all rows arrives as one row per task. Afterwards texts no
longer move: documents find their group by (hash, sha256). Two different texts
that agree in both digests would be told apart by the byte comparison and stop
the job rather than merge; a collision of the 128-bit hash alone is resolved.

Defined results: a null text is an empty text; a null id is below every id; rows
that repeat id and text are one document with one decision (``kept`` is equal on
each such row; ``keep_one`` returns just one of them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import whole_text


def content_hash(text: Column) -> Column:
    """128 bits of the content."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
                 hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per distinct text: _hash, _sha, keep_id, group_size."""
    pick = {"smallest": F.min, "largest": F.max}[keep]
    same_bytes = (docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
                  .groupBy(hash_fn(F.col("_text")).alias("_hash"), "_text")
                  .agg(pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    return (same_bytes.groupBy("_hash", F.sha2("_text", 256).alias("_sha"))
            .agg(pick("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
            .select("_hash", "_sha", "keep_id",
                    F.when(F.col("texts") == 1, F.col("n"))
                    .otherwise(F.raise_error(F.lit("different texts share both digests")).cast("long"))
                    .alias("group_size")))


def exact_dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
                hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """A decision for every row: doc_id, keep_id, group_size, kept, text_sha256.

    The join on the digests carries narrow rows; adaptive execution splits the
    partition of a hot group (the group side has one row for it)."""
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), hash_fn(text).alias("_hash"), F.sha2(text, 256).alias("_sha"))
    groups = exact_groups(docs, keep, id_col, text_col, hash_fn)
    return rows.join(groups, ["_hash", "_sha"]).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_sha").alias("text_sha256"))


def keep_one(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
             hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The surviving rows with all their columns: one per distinct text, in one shuffle.

    Of equal texts the row with the smallest (largest) id stays; of rows with
    that same id too, any one (they are the same document)."""
    best = {"smallest": F.min_by, "largest": F.max_by}[keep]
    text = whole_text(text_col)
    # A null id sorts below all ids, as a struct's null field does.
    order = F.struct(F.col(id_col))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.groupBy(hash_fn(text).alias("_hash"), text.alias("_text"))
            .agg(best(row, order).alias("_row"))
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))
