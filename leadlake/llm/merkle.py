"""A Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf digest. The leaves of a source, in order of their ids, are cut
into aligned chunks of ``fanout ** local_levels``; each chunk hashes its own subtree.
From then on a chunk is a lane that holds the digest of the node above it and the
siblings met so far. In round r, aligned groups of up to ``fanout`` lanes swap their
nodes: lane p meets those that differ from p in digit r only, so every lane of a group
learns all siblings and hashes the parent itself, as all lanes below that parent do.
After the rounds within the sources and those over the sources (whose lanes all take
part), each lane has the root and the whole upper proof of its leaves; nothing is
passed down again. Where the last node of a run has fewer lanes than its siblings,
its lanes send their digest to several columns, so nobody waits for a missing lane.

A round is one shuffle of narrow rows, a row or (at ragged ends) a few per lane;
groups have at most ``fanout`` rows. Leaves are ranked by ranges and offsets, so a
source with a third of all rows is spread like any other rows.

Defined results: a null field is ``-``; a null id comes first in its source and is
never tampered with; the null source is a source of its own, first; rows that repeat
an id are leaves of their own, by digest; an empty table gives an empty result;
further columns of the input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import id_text, written
from leadlake.llm.ranks import ranked

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "struct<before:string,after:string>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in front, or ``-``: fields can't run into each other."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return digest(F.concat(*[field(f) for f in fields]))


def leaves(docs: DataFrame, fields: list[str], text_col: str, id_col: str, source_col: str, every: int) -> DataFrame:
    """_id, _has (a source), _src, leaf, tampered (the leaf after tampering, null where there is none)."""
    text = F.col(text_col)
    changed = [F.translate(text, _UPPER, _LOWER) if c == text_col else F.col(f"`{c}`") for c in fields]
    tampered = F.when(F.col(id_col).isNotNull() & (F.crc32(id_text(id_col).cast("binary")) % every == 0),
                      leaf_digest(changed))
    source = F.col(source_col).cast("string")
    return docs.select(F.col(id_col).alias("_id"), source.isNotNull().alias("_has"),
                       F.coalesce(source, F.lit("")).alias("_src"),
                       leaf_digest([F.col(f"`{c}`") for c in fields]).alias("leaf"), tampered.alias("tampered"))


def _parents(level: Column, fanout: int) -> Column:
    return F.transform(F.sequence(F.lit(0), ((F.size(level) - 1) / fanout).cast("int")),
                       lambda i: digest(F.array_join(F.slice(level, i * fanout + 1, F.lit(fanout)), "")))


def _siblings(level: Column, place: Column, fanout: int) -> Column:
    """What stands before and after ``place`` (from 0) in its run of ``fanout``."""
    digit = place % fanout
    return F.struct(F.array_join(F.slice(level, place - digit + 1, digit), "").alias("before"),
                    F.array_join(F.slice(level, place + 2, F.lit(fanout - 1) - digit), "").alias("after"))


def chunk_trees(placed: DataFrame, sources: DataFrame, fanout: int, local_levels: int) -> DataFrame:
    """s, c, lanes, lane0, height, rows, l0 .. l<local_levels>: each chunk's leaves and own levels; written.

    Of a source with one chunk the tree ends where one node is left, ``height`` levels up."""
    chunk = fanout ** local_levels
    chunks = (placed.groupBy("_has", "_src", F.expr(f"rank div {chunk}L").alias("c"))
              .agg(F.sort_array(F.collect_list(F.struct("rank", "_id", "leaf", "tampered"))).alias("rows"))  # <= chunk
              .join(sources, ["_has", "_src"])
              .withColumn("height", sum((F.col("n") > fanout ** k).cast("int") for k in range(local_levels)))
              .withColumn("l0", F.col("rows.leaf")))
    for k in range(local_levels):
        below = F.col(f"l{k}")
        chunks = chunks.withColumn(f"l{k + 1}", F.when(F.col("height") > k, _parents(below, fanout)).otherwise(below))
    return written(chunks.drop("_has", "_src", "n"), "merkle-chunks")


def exchange(lanes: DataFrame, group: list[str], digit: Column, column: Column, width: Column,
             widest: Column) -> DataFrame:
    """One round: ``lanes`` with the parent as ``node`` and the siblings added to ``proof``.

    ``group`` names the parent; a lane is ``column`` of the ``width`` lanes below its node, and the
    parent's widest child has ``widest``. A group is one column of a parent: a lane of each child."""
    kept = lanes.columns
    lane = F.struct(*[F.col(c) for c in kept])
    sent = (lanes.withColumns({"_digit": digit, "_own": column.cast("long"), "_width": width, "_widest": widest})
            .withColumn("_col", F.explode(F.sequence(F.col("_own"), F.col("_widest") - 1, F.col("_width"))))
            .select(*group, "_col", F.struct(
                F.col("_digit").alias("digit"), F.col("node"),
                F.when(F.col("_col") == F.col("_own"), lane).alias("lane")).alias("m")))
    met = sent.groupBy(*group, "_col").agg(F.sort_array(F.collect_list("m")).alias("m"))  # at most fanout, by digit
    back = (met.withColumn("_parent", digest(F.array_join(F.col("m.node"), "")))
            .select("_parent", F.col("m.node").alias("_nodes"), F.posexplode("m").alias("_at", "m"))
            .where(F.col("m.lane").isNotNull())
            .select(F.col("m.lane").alias("lane"), "_parent", F.struct(
                F.array_join(F.slice("_nodes", F.lit(1), F.col("_at")), "").alias("before"),
                F.array_join(F.slice("_nodes", F.col("_at") + 2, F.size("_nodes")), "").alias("after")).alias("_step")))
    new = {"node": F.col("_parent"), "proof": F.concat(F.col("lane.proof"), F.array("_step"))}
    return back.select(*[new.get(c, F.col(f"lane.{c}")).alias(c) for c in kept])


def butterfly(lanes: DataFrame, sources: DataFrame, fanout: int) -> DataFrame:
    """s, c, subroot, root and proof (levels above the chunk, upwards) of every lane; written.

    ``lanes``: s, c, lanes, lane0, node, proof; ``sources``: a row per source with s, lanes, lane0."""
    sizes = sources.agg(F.max("lanes").alias("lanes"), F.count(F.lit(1)).alias("sources")).first()
    span = 1
    while span < (sizes["lanes"] or 0):  # rounds within the sources
        left = F.col("lanes") - F.col("_parent_at") * (span * fanout)
        busy = lanes.where(F.col("lanes") > span).withColumn("_parent_at", F.expr(f"c div {span * fanout}L"))
        at = F.expr(f"c div {span}L")
        busy = exchange(busy, ["s", "_parent_at"], at % fanout, F.col("c") % span,
                        F.least(F.lit(span), F.col("lanes") - at * span), F.least(F.lit(span), left))
        lanes = written(busy.drop("_parent_at").unionByName(lanes.where(F.col("lanes") <= span)), "merkle-lanes")
        span *= fanout
    lanes = lanes.withColumn("subroot", F.col("node"))
    span = 1
    while span < sizes["sources"]:  # rounds over the sources
        at, parent = F.expr(f"s div {span}L"), F.expr(f"s div {span * fanout}L")
        nodes = sources.groupBy(at.alias("_at"), parent.alias("_parent_at")).agg(
            F.min("lane0").alias("_start"), F.sum("lanes").alias("_lanes"))
        widest = nodes.groupBy("_parent_at").agg(F.max("_lanes").alias("_most"))
        info = nodes.join(widest, "_parent_at")
        busy = lanes.withColumn("_at", at).join(info, "_at")
        lanes = written(exchange(busy, ["_parent_at"], F.col("_at") % fanout, F.col("lane0") + F.col("c") - F.col("_start"),
                                 F.col("_lanes"), F.col("_most")).select(*lanes.columns), "merkle-lanes")
        span *= fanout
    return lanes.select("s", "c", "subroot", F.col("node").alias("root"), "proof")


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    fanout: int = 16, local_levels: int = 3, tamper_every: int = 5, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, leaf, subroot, root, steps, folded_root, verified for every row.

    ``steps`` is the inclusion proof: per level, upwards, the digests before and after the node.
    Rows whose crc32(id) is divisible by ``tamper_every`` are verified after lower-casing their text."""
    made = written(leaves(docs, list(fields), text_col, id_col, source_col, tamper_every), "merkle-leaves")
    placed = ranked(made, ["_has", "_src"], ["_id", "leaf"], "rank", kind="merkle-ranks")
    chunk = fanout ** local_levels
    counts = written(made.groupBy("_has", "_src").agg(F.count(F.lit(1)).alias("n"))
                     .withColumn("lanes", F.ceil(F.col("n") / chunk).cast("long")), "merkle-counts")
    sources = written(ranked(counts, [], ["_has", "_src"], "s", {"lane0": "lanes"}, kind="merkle-source-ranks"),
                      "merkle-sources")
    chunks = chunk_trees(placed, sources, fanout, local_levels)
    lanes = chunks.select("s", "c", "lanes", "lane0", F.get(F.col(f"l{local_levels}"), F.lit(0)).alias("node"),
                          F.array().cast(f"array<{_STEP}>").alias("proof"))
    # Run by run, so that a leaf drags only its 15 siblings and the run's steps along.
    place = F.sequence(F.lit(0), ((F.size("l0") - 1) / fanout).cast("int"))

    def run(j: Column) -> Column:
        above, at = [], j
        for k in range(1, local_levels):
            above.append(F.when(F.col("height") > k, _siblings(F.col(f"l{k}"), at, fanout)))
            at = (at / fanout).cast("int")
        return F.struct(F.slice("rows", j * fanout + 1, F.lit(fanout)).alias("rows"),
                        F.array_compact(F.array(*above)).cast(f"array<{_STEP}>").alias("above"))

    runs = (chunks.join(butterfly(lanes, sources, fanout), ["s", "c"])
            .select("subroot", "root", "proof", "height", F.explode(F.transform(place, run)).alias("run"))
            .select("subroot", "root", "height", F.col("run.rows").alias("rows"),
                    F.concat("run.above", "proof").alias("above"), F.col("run.rows.leaf").alias("level")))
    out = runs.select("subroot", "root", "height", "above", "level", F.posexplode("rows").alias("at", "row"))
    steps = F.concat(F.when(F.col("height") > 0, F.array(_siblings(F.col("level"), F.col("at"), fanout)))
                     .otherwise(F.array()).cast(f"array<{_STEP}>"), "above")
    out = out.select(F.col("row._id").alias(id_col), F.col("row.leaf").alias("leaf"), "subroot", "root",
                     steps.alias("steps"), F.coalesce("row.tampered", "row.leaf").alias("_start"))
    folded = F.aggregate("steps", F.col("_start"), lambda h, s: digest(F.concat(s["before"], h, s["after"])))
    return out.select(id_col, "leaf", "subroot", "root", "steps", folded.alias("folded_root"),
                      (folded == F.col("root")).alias("verified"))


def proof_digest(steps: Column) -> Column:
    """The digest of all siblings of a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""))
