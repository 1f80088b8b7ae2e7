"""The prefix trie of conversations by burst tries.

A turn's id is a 128-bit hash of role and text; a conversation is its sequence of turn
ids, and equal sequences are one suffix with a count. All suffixes start under the
root, a trie head. A head's suffixes are dealt into containers by their next turn id.
A container of more than ``container`` suffixes bursts: its prefix becomes a trie head
of its own and its suffixes, a turn shorter, are dealt into containers below. A round
looks ``levels`` turns ahead, so that a long shared beginning takes few rounds; only
suffixes of oversized containers take part. What is left are small containers: Spark
sorts their suffixes, and a sweep with a stack turns each into its nodes. Heads get
their totals from the containers and heads below them.

Nothing large meets in one task: counts are partial aggregates, a container has at most
``container`` suffixes (a hot turn or beginning only bursts deeper), copies are one row
before the first round, and the ids of conversations that end at a node are joined to
text in blocks of up to 4096 ids, which a task streams through the digest one after
another. A conversation's turns (ids, not texts) are one row.

Defined results: rows without a conv_id belong to no conversation; a null turn comes
first; rows of one turn number are ordered by the hash of role and text, and repeated
rows are turns of their own; a null role or text is empty; an empty table has no node;
further columns of the input play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import WORD, ship_code, whole_text, written

_NO_ENDS = hashlib.sha256(b"").hexdigest()
_BLOCK_BITS = 12
ROOT = ""


def turn_id(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def conversations_of(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id and t, the turns in order as (id, words)."""
    text = whole_text(text_col)
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), turn_id(whole_text(role_col), text).alias("id"),
                 F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("t"))
    in_order = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(in_order, lambda x: F.struct(x["id"], x["words"])).alias("t"))


def rebuilt(convs: DataFrame, family: int = 20, most_shared: int = 3) -> DataFrame:
    """Every conversation with its first h turns replaced by those of its family's first one (h by a hash)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most_shared + 1)).cast("int")
    lead = convs.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("_base"), F.slice("t", F.lit(1), F.lit(most_shared)).alias("_lead"))
    with_lead = convs.withColumn("_base", F.col("conv_id") - F.col("conv_id") % family).join(lead, "_base", "left")
    none = F.slice("t", F.lit(1), F.lit(0))
    return with_lead.select("conv_id", F.concat(F.slice(F.coalesce("_lead", none), F.lit(1), h),
                                                F.slice("t", h + 1, F.size("t"))).alias("t"))


def ends_digests(convs: DataFrame) -> DataFrame:
    """key and ends: the digest of the ids, ascending and joined by commas, of the conversations with that key."""
    blocks = (convs.groupBy("key", F.shiftright("conv_id", _BLOCK_BITS).alias("block"))  # at most 4096 ids
              .agg(F.sort_array(F.collect_set("conv_id")).alias("ids"))
              .select("key", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            yield _batch(out, _ENDS)
        if key is not None:
            yield _batch([(key, state.hexdigest())], _ENDS)

    return blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInArrow(
        run, "key string, ends string")


_ENDS = pa.schema([("key", pa.string()), ("ends", pa.string())])
_NODES = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                    ("ends_sha256", pa.string()), ("path", pa.list_(pa.string()))])
_NODE_COLUMNS = _NODES.names[:-1]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def sequences(convs: DataFrame) -> DataFrame:
    """key, n, low, t, ends: every distinct sequence with its conversations' number, smallest id and digest; written."""
    keyed = written(convs.withColumn("key", F.md5(F.array_join("t.id", ""))), "trie-rebuilt")
    merged = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.first("t").alias("t"))
    return written(merged.join(ends_digests(keyed.select("key", "conv_id")), "key"), "trie-sequences")


def _ahead(levels: int) -> Column:
    """The next prefixes of a suffix, from the one a turn longer on: level, prefix, parent, depth, words, ends, path."""
    steps, prefix, path = [], F.col("head"), F.col("path")
    for j in range(1, levels + 1):
        at = F.col("depth") + (j - 1)
        parent, turn = prefix, F.get("t", at)
        prefix = F.md5(F.concat(parent, turn["id"]))
        path = F.concat(path, F.array(prefix))
        step = F.struct(F.lit(j).alias("level"), prefix.alias("prefix"), parent.alias("parent"),
                        (at + 1).cast("long").alias("depth"), turn["words"].alias("words"),
                        F.when(F.size("t") == at + 1, F.col("ends")).alias("ends"), path.alias("path"))
        steps.append(F.when(F.size("t") > at, step))
    return F.array_compact(F.array(*steps))


def burst(seqs: DataFrame, container: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """(heads, contained): the trie heads, and every remaining suffix with its container ``cid``.

    heads: prefix, parent, depth, words, path, n_convs, low, ends; the root is one (if there is a conversation)."""
    total = seqs.agg(F.sum("n").alias("n_convs"), F.min("low").alias("low"),
                     F.max(F.when(F.size("t") == 0, F.col("ends"))).alias("ends")).where("n_convs > 0")
    heads = [total.select(F.lit(ROOT).alias("prefix"), F.lit(None).cast("string").alias("parent"),
                          F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"),
                          F.array(F.lit(ROOT)).alias("path"), "n_convs", "low", "ends")]
    state = ["key", "n", "low", "ends", "t", "head", "depth", "parent_low", "path"]
    active = (seqs.where(F.size("t") > 0)
              .withColumns({"head": F.lit(ROOT), "depth": F.lit(0), "path": F.array(F.lit(ROOT)),
                            "parent_low": seqs.agg(F.min("low")).scalar()}).select(*state))
    contained = []
    while True:
        ahead = active.select("key", "n", "low", F.explode(_ahead(levels)).alias("s"))
        found = (ahead.groupBy(F.col("s.prefix").alias("prefix"))
                 .agg(F.count(F.lit(1)).alias("suffixes"), *[F.first(f"s.{c}").alias(c) for c in ("parent", "depth", "words", "path")],
                      F.sum("n").alias("n_convs"), F.min("low").alias("low"), F.max("s.ends").alias("ends"))
                 .where(F.col("suffixes") > container).drop("suffixes"))
        found = written(found, "trie-heads")
        heads.append(found)
        deepest = (ahead.select("key", F.col("s.level").alias("level"), F.col("s.prefix").alias("prefix"))
                   .join(found.select("prefix", F.col("low").alias("head_low"), F.col("path").alias("head_path")), "prefix")
                   .groupBy("key").agg(F.max(F.struct("level", "prefix", "head_low", "head_path")).alias("top")))
        moved = written(
            active.join(deepest, "key", "left").select(
                "key", "n", "low", "ends", "t", F.coalesce("top.prefix", "head").alias("head"),
                (F.col("depth") + F.coalesce("top.level", F.lit(0))).alias("depth"),
                F.coalesce("top.head_low", "parent_low").alias("parent_low"), F.coalesce("top.head_path", "path").alias("path"),
                F.coalesce(F.col("top.level") == levels, F.lit(False)).alias("again"))
            .where(F.size("t") > F.col("depth")), "trie-suffixes")  # the others end at their head
        contained.append(moved.where("not again").select(*state))
        active = moved.where("again").select(*state)
        if active.isEmpty():
            break
    rest = contained[0]
    for part in contained[1:]:
        rest = rest.unionByName(part)
    rest = rest.withColumn("cid", F.md5(F.concat("head", F.get("t", F.col("depth"))["id"])))
    every = heads[0]
    for part in heads[1:]:
        every = every.unionByName(part)
    return written(every, "trie-all-heads"), rest


class Sweep:
    """The nodes of containers whose suffixes come sorted."""

    def __init__(self):
        self.stack, self.ids, self.out = [], [], []
        self.cid = self.path = self.parent_low = None

    def _close(self) -> None:
        """Takes the deepest open node off the stack; its children learn their parent's id now."""
        depth, low, n, words, children, leaves, saved, ends, waiting = self.stack.pop()
        self.ids.pop()
        node = (low, depth, n, children, leaves or 1, saved + (n - 1) * words, ends or _NO_ENDS)
        for child in waiting:
            self.out.append((*child[:2], low, *child[2:], None))
        if self.stack:
            up = self.stack[-1]
            up[1], up[2], up[4] = min(up[1], low), up[2] + n, up[4] + 1
            up[5], up[6] = up[5] + node[4], up[6] + node[5]
            up[8].append(node)
        else:
            self.out.append((*node[:2], self.parent_low, *node[2:], self.path))

    def close(self, down_to: int = 0) -> None:
        while len(self.stack) > down_to:
            self._close()

    def add(self, cid, depth, parent_low, path, low, n, ends, ids, words) -> None:
        if cid != self.cid:
            self.close()
            self.cid, self.path, self.parent_low = cid, path, parent_low
        same = 0
        for x, y in zip(self.ids, ids):
            if x != y:
                break
            same += 1
        self.close(same)
        for k in range(same, len(ids)):
            self.stack.append([depth + k + 1, low, 0, words[k], 0, 0, 0, None, []])
            self.ids.append(ids[k])
        last = self.stack[-1]
        last[1], last[2], last[7] = min(last[1], low), last[2] + n, ends

    def take(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def swept(contained: DataFrame) -> DataFrame:
    """The nodes of all containers; ``path`` (the heads above) stands on each container's top node only; written."""
    ship_code(contained.sparkSession)
    suffix = F.slice("t", F.col("depth") + 1, F.size("t"))
    rows = contained.withColumn("_s", suffix).select(
        "cid", "depth", "parent_low", "path", "low", "n", "ends", F.col("_s.id").alias("ids"), F.col("_s.words").alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    sweep.add(*row)
                yield _batch(sweep.take(), _NODES)
        sweep.close()
        yield _batch(sweep.take(), _NODES)

    schema = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in _NODE_COLUMNS) + ", path array<string>"
    return written(rows.repartition("cid").sortWithinPartitions("cid", "ids").mapInArrow(run, schema), "trie-nodes")


def head_nodes(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of the trie heads: their totals are those of the containers and heads below."""
    own = (F.col("n_convs") - 1) * F.col("words")
    below = tops.select(F.posexplode("path").alias("at", "prefix"), (F.size("path") - 1).alias("last"), "n_leaves", "saved_tokens")
    below = below.select("prefix", "n_leaves", "saved_tokens", (F.col("at") == F.col("last")).cast("long").alias("child"))
    among = heads.select(F.posexplode("path").alias("at", "prefix"), (F.size("path") - 2).alias("last"),
                         F.lit(0).cast("long").alias("n_leaves"), own.alias("saved_tokens"))
    among = among.select("prefix", "n_leaves", "saved_tokens", (F.col("at") == F.col("last")).cast("long").alias("child"))
    sums = below.unionByName(among).groupBy("prefix").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.sum("child").alias("n_children"))
    parents = heads.select(F.col("prefix").alias("parent"), F.col("low").alias("parent_conv_id"))
    return heads.join(sums, "prefix").join(parents, "parent", "left").select(
        F.col("low").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).alias("n_leaves"), "saved_tokens",
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"))


def prefix_trie(convs: DataFrame, container: int = 2048, levels: int = 4) -> DataFrame:
    """The nodes of the trie over ``convs`` (conv_id, t): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    heads, contained = burst(sequences(convs), container, levels)
    nodes = swept(contained)
    tops = nodes.where(F.col("path").isNotNull())
    return nodes.select(*_NODE_COLUMNS).unionByName(head_nodes(heads, tops))


def conversation_trie(turns: DataFrame, family: int = 20, most_shared: int = 3, conv_col: str = "conv_id",
                      turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **options) -> DataFrame:
    """The trie of all conversations after rebuilding each from its family's first turns and its own."""
    convs = written(conversations_of(turns, conv_col, turn_col, role_col, text_col), "trie-conversations")
    return prefix_trie(rebuilt(convs, family, most_shared), **options)
