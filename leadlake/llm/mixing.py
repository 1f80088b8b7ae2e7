"""Mixing sources to target weights by whole repeats plus one seeded Bernoulli copy.

Sizes are summed per source, targets follow from the weights and the cap, and
``rate = target / source size``. A document is emitted ``floor(rate)`` times,
plus once more with probability ``rate - floor(rate)``, decided by a hash of
(seed, id, text): reruns and other partitionings give the same mix, and no row waits
for another one, so a hot source needs no window and no single task. Rows without an id,
or with a repeated one, are told apart by their texts.

Defined results: a null or blank text has size 0; the null source is a source of
its own, last in order; a source of size 0 has target 0 and gives nothing; rows
that repeat an id share its draw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import WORD, hex_long, id_text, whole_text, written
from leadlake.llm.ranks import ranked

SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """Per source (rows of ``source``, ``size``): source_size, target.

    Weights repeat over the sources in code point order, null last. Every target
    is ``min(cap x size, level x weight)``; the level is what resharing the excess
    by weight ends in, read off the sources sorted by size per weight. Both orders
    are found by ranges and offsets: there may be as many sources as sites."""
    per_source = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                         .withColumn("_last", F.col("source").isNull()), "mix-sources")
    named = ranked(per_source, [], ["_last", "source"], "place", kind="mix-names")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = written(named.select("source", "source_size", weight.alias("weight"), "place",
                             (F.lit(cap) * F.col("source_size")).alias("limit"))
                .withColumn("filled_at", F.col("limit") / F.col("weight")), "mix-weights")
    s = ranked(s, [], ["filled_at", "place"], "_at", {"limits": "limit", "weights": "weight"}, kind="mix-levels")
    total = per_source.agg(F.sum("source_size")).scalar()
    level = (F.lit(share) * total - F.col("limits")) / (named.select(weight.alias("w")).agg(F.sum("w")).scalar() - F.col("weights"))
    s = written(s.withColumn("level_here", level), "mix-here")
    # The first source, in that order, whose limit the level there does not reach.
    reached = s.where(F.col("level_here") * F.col("weight") <= F.col("limit")).agg(F.min_by("level_here", "_at")).scalar()
    return s.select("source", "source_size",
                    F.least("limit", F.coalesce(reached * F.col("weight"), F.col("limit"))).alias("target"))


def copies(rate: Column, draw: Column) -> Column:
    """floor(rate), plus one where the draw in [0, 1) is below the fraction."""
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _with_copies(rows: DataFrame, targets: DataFrame, id_col: str, seed: str) -> DataFrame:
    # The planner broadcasts `targets` only if its written size is below the
    # session's threshold, and else joins by shuffle with skew splitting.
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    draw = hex_long(F.md5(F.concat(F.lit(f"{seed}:"), id_text(id_col), F.lit(":"), F.col("_hash"))), 13) / F.lit(float(16 ** 13))
    return (rows.join(t, rows["_src"].eqNullSafe(t["_source"])).drop("_source")
            .withColumn("_copies", copies(rate, draw)))


def mix_plan(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
             seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """A decision for every document: doc_id, size, source_size, target, taken, copies."""
    narrow = written(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_src"),
                                 F.md5(whole_text(text_col)).alias("_hash"),
                                 word_count(whole_text(text_col)).alias("size")), "mix-sizes")
    targets = written(source_targets(narrow.select(F.col("_src").alias("source"), "size"), weights, share, cap),
                      "mix-targets")
    return _with_copies(narrow, targets, "_id", seed).select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        (F.col("_copies") * F.col("size")).alias("taken"), F.col("_copies").alias("copies"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
        seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents: every row as often as its copies say, columns unchanged."""
    targets = written(source_targets(
        docs.select(F.col(source_col).alias("source"), word_count(whole_text(text_col)).alias("size")),
        weights, share, cap), "mix-targets")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), F.md5(whole_text(text_col)).alias("_hash"))
    out = _with_copies(rows, targets, "_id", seed).where("_copies > 0")
    out = out.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
