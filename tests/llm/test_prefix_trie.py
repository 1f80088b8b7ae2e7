"""Conversation prefix trie: brute force with containers of all sizes, odd rows, SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from leadlake.llm.prefix_trie import conversation_trie
from leadlake.llm.queries import ORACLES, QUERIES

COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def turn_hash(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows, family=20, most_shared=3):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, turn_hash(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(set), defaultdict(set)
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % (most_shared + 1)
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        turns = tuple(own.get(base, [])[:h] + t[h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
        ends[turns].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own_saved = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        totals[node] = (sum(totals[c][0] for c in children[node]) or 1, own_saved + sum(totals[c][1] for c in children[node]))
    return sorted(((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), *totals[node],
                    hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
                   for node, m in members.items()), key=repr)


def found(df, **options):
    return sorted((tuple(r) for r in conversation_trie(df, **options).select(*COLS).collect()), key=repr)


@pytest.mark.parametrize("container, levels, seed", [(1, 1, 1), (2, 3, 2), (7, 2, 3), (2048, 4, 4)])
def test_against_brute_force(spark, container, levels, seed):
    """Few distinct turns (deep sharing, many copies), null and repeated turns, roles and texts, negative ids, no id."""
    rng = random.Random(seed)
    texts = ["", None, "hello there  you", "a\tb", "é x", "hello"]
    rows = []
    for c in [None, *range(-25, 90)]:
        for k in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([None, k, k, 1]), rng.choice(["user", "bot", None]), rng.choice(texts[:3] if c and c % 2 else texts)))
    assert found(spark.createDataFrame(rows, SCHEMA), container=container, levels=levels) == brute(rows)


def test_long_shared_beginning_and_thousands_of_copies(spark):
    """A container that bursts again and again, a group of copies over several blocks of ids, a long conversation."""
    deep = [(c, k, "u", "same text" if k < 30 else f"{c} {k}") for c in range(0, 200, 20) for k in range(32)]
    copies = [(c, k, "bot", f"copy {k}") for c in range(20_000, 29_000) for k in range(2)]
    long = [(-40, k, "u", f"{k % 7}") for k in range(3000)]
    rows = deep + copies + long
    assert found(spark.createDataFrame(rows, SCHEMA), container=3, levels=4) == brute(rows)


def test_empty_table_turnless_conversations_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    # Conversations without a family head lose as many turns as their hash says; some are left with none.
    rows = [(c, 0, "u", "only turn") for c in range(1, 20)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and got != []
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("t", "key", "n", "low", "path", "head")])
    assert found(clash) == got


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_dir}/conversations.parquet')")
    rel = con.sql(ORACLES["op12_conversation_trie"])
    got = QUERIES["op12_conversation_trie"](spark, sf_dir)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted((tuple(r) for r in got.select(*rel.columns).collect()), key=repr) == sorted(rel.fetchall(), key=repr)
