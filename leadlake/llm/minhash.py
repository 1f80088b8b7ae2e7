"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct shingle set is a node with a signature of ``coords`` minima.
Signature coordinates are posted as (coordinate, value) tokens. Two sets of a
similarity of at least the threshold agree in about that share of coordinates;
pairs that agree in ``matches`` or more are candidates. To agree in so many, a pair
must share one of the first ``coords - matches + 1`` tokens of both in any common
order, so only such prefixes are merged (rarest tokens first); the long, frequent
lists are skipped, and the rest of the count is read off the two signatures.
Candidates are confirmed on their full shingle sets.

Large groups don't become pairs. Equal sets are one node. In a token's list every
node is first paired with a few pivots of the list only; confirmed links are
joined into components. Two nodes in one component need no further link, so what
is left are lists with nodes of several components. In lists of up to
``large_list`` nodes, those outside the most frequent component are paired with
nodes of other components. Longer lists take the exact way for sets: nodes meet if
prefixes of their full sets, rare shingles first, share a shingle at a place where
the threshold still can be reached. No list is cut or left out.

``matches`` is half of ``coords`` by default: a pair of similarity 0.8 misses 20 of
40 with a probability of about 5e-6 (P(X <= 19) of 40 draws at 0.8).

Defined results: texts without words (null ones too) have no shingle and are
linked with nothing; with fewer words than a shingle, the whole sequence is the
one shingle; a component's id is its smallest document id; a null id is never it
unless all are null; rows that repeat an id are rows of their own that may link.
Shingles are compared by 64-bit hashes, sets by 128-bit ones.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import id_text, map_texts, maybe_among, whole_text, written
from leadlake.llm.components import connected_components

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Shingle sets and signatures of texts; word hashes are kept up to a bound."""

    def __init__(self, words: int, coords: int, seed: int = 1, cache_words: int = 300_000):
        rng = np.random.default_rng(seed)
        self.words, self.most, self.cache = words, cache_words, {}
        self.times = rng.integers(1, 2 ** 63, coords, dtype=np.uint64) | np.uint64(1)
        self.plus = rng.integers(0, 2 ** 63, coords, dtype=np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the text's shingles."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z; splits at 9-13 and 32
        if not words:
            return np.zeros(0, np.uint64)
        cache = self.cache
        if len(cache) > self.most:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(words))
        out = h[:len(h) - size + 1].copy()
        for k in range(1, size):
            out *= _ODD
            out ^= out >> np.uint64(31)
            out += h[k:len(h) - size + 1 + k]
        out *= _ODD
        out ^= out >> np.uint64(32)
        return np.unique(out)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.times), 2 ** 32 - 1, np.uint64)
        for at in range(0, len(shingles), 32_768):
            part = shingles[at:at + 32_768]
            least = np.minimum(least, ((part * self.times[:, None] + self.plus[:, None]) >> np.uint64(32)).min(axis=1))
        return least.astype(np.uint32).view(np.int32)


def row_key(id_col: str, text_col: str):
    """128 bits of a row's id and text."""
    return F.unhex(F.md5(F.concat(id_text(id_col), F.lit(":"), whole_text(text_col))))


def signatures(docs: DataFrame, words: int, coords: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (of the row), n_shingles, set_hash, signature for every row; written."""

    def maker():
        s = Shingler(words, coords)

        def one(text):
            shingles = s.shingles(text)
            if not len(shingles):
                return 0, None, None
            return len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()), s.signature(shingles)

        return lambda texts: [one(t) for t in texts]

    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"),
                       F.col(text_col).alias("_text"))
    return written(map_texts(rows, maker, {"n_shingles": "long", "set_hash": "binary", "signature": "array<int>"}),
                   "minhash-signatures")


def prefix_postings(nodes: DataFrame, coords: int, matches: int) -> DataFrame:
    """(token, node, weight): each node's rarest ``coords - matches + 1`` tokens, without those of one node only.

    ``weight`` is high for the centre of a group: the summed frequency of all the node's tokens."""
    tokens = nodes.select("node", F.posexplode("signature").alias("c", "value")).select(
        "node", F.expr("shiftleft(cast(c as bigint), 32) | (cast(value as bigint) & 4294967295)").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = (tokens.join(often, "token").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("t")))  # at most coords of them
    room = coords - matches + 1 - (coords - F.size("t"))
    weight = F.aggregate("t", F.lit(0).cast("long"), lambda n, x: n + x["often"])
    return (shared.where(room > 0)
            .select("node", weight.alias("weight"), F.explode(F.slice("t", F.lit(1), room)).alias("t"))
            .select("node", "weight", F.col("t.token").alias("token")))


def pivot_pairs(postings: DataFrame, pivots: int) -> DataFrame:
    """(a, b): every node with the pivots of each of its lists.

    A list's pivots are its heaviest node and the first one by a hash; lists take turns among ``pivots`` hashes."""
    by_hash = F.xxhash64("node", F.pmod("token", F.lit(pivots)))
    chosen = postings.groupBy("token").agg(
        F.min(F.struct((-F.col("weight")).alias("w"), "node")).alias("heavy"),
        F.min(F.struct(by_hash.alias("h"), "node")).alias("first"))
    chosen = chosen.select("token", F.explode(F.array_distinct(F.array("heavy.node", "first.node"))).alias("pivot"))
    return (postings.join(chosen, "token").where("node <> pivot")
            .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())


def mixed_lists(postings: DataFrame, components: DataFrame) -> DataFrame:
    """(token, node, component, home, size) of the lists that hold nodes of more than one component.

    ``home`` is the list's most frequent component, ``size`` its number of nodes; written."""
    placed = (postings.join(components, "node", "left")
              .select("token", "node", F.coalesce("component", "node").alias("component")))
    mixed = (placed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("token").agg(F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("parts"),
                                   F.sum("n").alias("size"))
             .where("parts > 1").select("token", F.col("most.component").alias("home"), "size"))
    return written(placed.join(mixed, "token"), "minhash-mixed")


def cross_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): in every list, nodes outside its home component with nodes of other components."""
    outside = lists.where("component <> home").select("token", F.col("node").alias("x"), F.col("component").alias("cx"))
    return (outside.join(lists, "token").where("component <> cx")
            .select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct())


def agreeing(pairs: DataFrame, nodes: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough and whose set sizes allow a link; with na, nb, ka, kb."""
    side = nodes.select("node", "n_shingles", "signature", "key")
    agreed = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return (pairs.join(side.toDF("a", "na", "sa", "ka"), "a").join(side.toDF("b", "nb", "sb", "kb"), "b")
            .where(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb"))
            .where(agreed >= matches).select("a", "b", "na", "nb", "ka", "kb"))


def full_sets(keys: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(key, s): the full shingle sets of the rows with these keys (column key); written."""
    def maker():
        s = Shingler(words, 1)
        return lambda texts: [(s.shingles(t).view(np.int64),) for t in texts]

    texts = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("_text"))
    texts = maybe_among(texts, F.col("key"), keys).groupBy("key").agg(F.first("_text").alias("_text"))
    return written(map_texts(texts, maker, {"s": "array<long>"}), "minhash-sets")


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): the pairs whose full sets are similar enough."""
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sets.toDF("ka", "sa"), "ka").join(sets.toDF("kb", "sb"), "kb")
            .where(F.lit(100) * both >= F.lit(percent) * (F.col("na") + F.col("nb") - both))
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def set_prefix_pairs(lists: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb, ka, kb): in large mixed lists, pairs that may be similar by a prefix of their full sets.

    Nodes outside a list's home component meet nodes of other components. Sets of sizes na and nb with a similarity of ``percent`` share at least
    ``need = ceil(percent (na + nb) / (100 + percent))`` shingles, hence one of the
    first na - need + 1 (nb - need + 1) in any common order. With rare shingles
    first, a set that is not similar to its group's centre has only its own
    shingles there, and so meets just those that share them."""
    members = (lists.groupBy("node", "component").agg(F.max(F.col("component") != F.col("home")).alias("out"))
               .join(nodes.select("node", "n_shingles", "key"), "node"))
    each = members.join(sets, "key").select("node", F.explode("s").alias("g"))
    often = each.groupBy("g").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = each.join(often, "g").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("often", "g"))).alias("t"))
    own = F.col("n_shingles") - F.size("t")
    longest = F.col("n_shingles") - F.ceil(F.lit(percent) * F.col("n_shingles") / 100) + 1
    prefix = written(
        shared.join(members, "node").withColumn("own", own).withColumn("room", (longest - own).cast("int"))
        .where("room > 0").select("node", "component", "out", "n_shingles", "key", "own",
                                  F.posexplode(F.slice("t", F.lit(1), F.col("room"))).alias("p", "t"))
        .select("node", "component", "out", "n_shingles", "key", F.col("t.g").alias("g"),
                (F.col("own") + F.col("p") + 1).alias("place")), "minhash-prefixes")
    a = prefix.where("out").toDF("a", "ca", "oa", "na", "ka", "g", "pa")
    b = prefix.toDF("b", "cb", "ob", "nb", "kb", "g", "pb")
    need = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / (100 + percent))
    return (a.join(b, "g").where("ca <> cb and (a < b or not ob)")
            .where(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb"))
            .where((F.col("pa") <= F.col("na") - need + 1) & (F.col("pb") <= F.col("nb") - need + 1))
            .select("a", "b", "na", "nb", "ka", "kb").distinct())


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("ka").alias("key")).union(pairs.select("kb")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, coords: int = 40, matches: int = 20,
                    pivots: int = 4, large_list: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept, component_key for every row.

    ``component_key`` is the key of one row of the component: of those with its smallest id the smallest."""
    rows = signatures(docs, words, coords, id_col, text_col)
    nodes = written(rows.where("n_shingles > 0").groupBy("set_hash", "n_shingles", "signature")
                    .agg(F.min("doc_id").alias("low"),
                         F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("key"))
                    .withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    postings = written(prefix_postings(nodes, coords, matches), "minhash-postings")
    source = (docs, words, id_col, text_col)
    tried = written(pivot_pairs(postings, pivots), "minhash-pivot-pairs")
    pairs = written(agreeing(tried, nodes, matches, percent), "minhash-pairs")
    links = written(similar(pairs, full_sets(_keys(pairs), *source), percent), "minhash-links")
    lists = mixed_lists(postings, written(connected_components(links), "minhash-components"))
    small, large = lists.where(F.col("size") <= large_list), lists.where(F.col("size") > large_list)
    pairs = written(agreeing(cross_pairs(small).join(tried, ["a", "b"], "left_anti"), nodes, matches, percent),
                    "minhash-pairs")
    in_large = large.select("node").distinct().join(nodes, "node").select("key")
    sets = full_sets(_keys(pairs).union(in_large).distinct(), *source)
    pairs = pairs.union(set_prefix_pairs(large, nodes, sets, percent))
    links = links.union(similar(pairs, sets, percent))
    components = written(connected_components(links), "minhash-components")
    # Every node with the smallest document id of its component, and the key of a row that has it.
    placed = nodes.join(components, "node", "left").select(
        "set_hash", "low", "key", F.coalesce("component", "node").alias("component"))
    low = placed.groupBy("component").agg(
        F.min("low").alias("component_low"),
        F.min(F.struct(F.col("low").isNull(), "low", "key"))["key"].alias("component_key"))
    found = placed.join(low, "component").select("set_hash", "component_low", "component_key")
    linked = rows.where("n_shingles > 0").join(found, "set_hash").withColumnRenamed("component_low", "component_id")
    alone = rows.where("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "component_key": F.col("key")})
    return linked.unionByName(alone).select(
        F.col("doc_id").alias(id_col), "key", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "component_key")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that stay, with all their columns: one of each component, also where near copies share an id
    or have none (a repeated row stays once)."""
    kept = (near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where("key = component_key")
            .select(F.col("key").alias("_key")).distinct())
    rows = docs.select(row_key(id_col, text_col).alias("_key"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    once = Window.partitionBy("_key").orderBy("_key")
    rows = rows.join(kept, "_key").withColumn("_n", F.row_number().over(once)).where("_n = 1")
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
