"""Merkle manifest: brute force over the whole tree, ragged groups, odd rows, tampering."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from leadlake.llm.merkle import merkle_manifest, proof_digest
from leadlake.llm.queries import ORACLES, QUERIES

COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def steps_of(levels, at, fanout):
    for level in levels[:-1]:
        first = at // fanout * fanout
        yield "".join(level[first:at]), "".join(level[at + 1:first + fanout])
        at //= fanout


def brute(rows, fanout, every=5):
    """The contract, one tree at a time. Rows: doc_id, source, lang, n_chars, text."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in sources}
    trees = {s: tree_of([leaf_of(r) for r in of[s]], fanout) for s in sources}
    top = tree_of([trees[s][-1][0] for s in sources], fanout)
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(of[s]):
            steps = [*steps_of(trees[s], i, fanout), *steps_of(top, k, fanout)]
            text = r[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            spoilt = r[0] is not None and zlib.crc32(str(r[0]).encode()) % every == 0
            node = leaf_of((*r[:4], text)) if spoilt else leaf_of(r)
            for before, after in steps:
                node = sha(before + node + after)
            out.append((r[0], leaf_of(r), trees[s][-1][0], top[-1][0], sha("".join(b + a for b, a in steps)), node,
                        node == top[-1][0]))
    return sorted(out, key=repr)


def found(df, **options):
    got = merkle_manifest(df, **options).withColumn("proof_sha256", proof_digest(F.col("steps")))
    return sorted((tuple(r) for r in got.select(*COLS).collect()), key=repr)


@pytest.mark.parametrize("fanout, local, n", [(2, 1, 45), (3, 2, 120), (16, 3, 60)])
def test_whole_tree_against_brute_force(docs_of, fanout, local, n):
    """Null and repeated ids, equal rows, null fields, a source with most rows, lone leaves, ragged runs at every level."""
    rng = random.Random(n)
    rows = [(rng.choice([None, *range(40)]), rng.choice(["hot"] * 9 + ["a", "b", None, "", "é", "Z", "z1", "z2"]), rng.choice([None, "en"]),
             rng.choice([None, 3]), rng.choice([None, "", "Ab c", "É A", "x" * 50_000])) for _ in range(n)]
    df = docs_of([(r[0], r[4], r[2], r[1], r[3]) for r in rows])
    assert found(df, fanout=fanout, local_levels=local) == brute(rows, fanout)


def test_one_row_no_row_and_clashing_columns(docs_of):
    one = docs_of([(3, "Ab", "en", "s", 2)])
    assert found(one) == brute([(3, "s", "en", 2, "Ab")], 16)
    assert found(docs_of([])) == []
    odd = docs_of([(i, f"T{i}", "en", f"s{i % 2}", 2) for i in range(8)])
    clash = odd.select("*", *[F.lit(1).alias(c) for c in ("leaf", "root", "rank", "_range", "s", "c", "node", "_src")])
    assert found(clash) == found(odd)


def test_only_tampering_breaks_a_proof(docs_of):
    """A tampered row fails only where lower-casing changes its text; all others verify."""
    got = merkle_manifest(docs_of([(i, "ABC" if i % 2 else "abc", None, "s") for i in range(200)])).collect()
    spoilt = {r.doc_id for r in got if not r.verified}
    assert spoilt == {i for i in range(200) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0} and spoilt


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    rel = con.sql(ORACLES["op13_merkle_manifest"])
    got = QUERIES["op13_merkle_manifest"](spark, sf_dir)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted((tuple(r) for r in got.select(*rel.columns).collect()), key=repr) == sorted(rel.fetchall(), key=repr)
