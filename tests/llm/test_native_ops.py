"""Exact dedup, sharding and mixing: oracles, brute force, odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from leadlake.llm.common import written
from leadlake.llm.exact_dedup import exact_dedup, keep_one
from leadlake.llm.mixing import mix, mix_plan
from leadlake.llm.queries import ORACLES, QUERIES
from leadlake.llm.ranks import ranked
from leadlake.llm.sharding import interleaved_shards

ODD = [(1, "a b", "en", "s1"), (2, "a b", "en", "s2"), (3, "", None, None), (4, None, "fr", None),
       (5, "A b", "en", "s1"), (None, "a b", None, "s1"), (7, "x " * 50_000, "de", "s1"), (7, "x " * 50_000, "de", "s1"),
       (8, "é\x85 z", "fr", "s3"), (9, "  \t", "fr", "zero")]


def rows_of(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op8_topk_search", "op9_mixing"])
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    assert rows_of(df, cols) == sorted((tuple(r) for r in rel.select(*cols).fetchall()), key=repr)


def test_exact_dedup_odd_rows(docs_of):
    got = {(r.doc_id, r.text_sha256[:4]): r for r in exact_dedup(docs_of(ODD), keep="largest").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()[:4]
    assert (got[1, sha("a b")].keep_id, got[1, sha("a b")].group_size, got[1, sha("a b")].kept) == (2, 3, False)
    assert got[2, sha("a b")].kept and not got[None, sha("a b")].kept
    assert got[3, sha("")].keep_id == 4 and got[4, sha("")].kept
    assert got[5, sha("A b")].group_size == 1
    assert got[7, sha("x " * 50_000)].group_size == 2
    assert exact_dedup(docs_of(ODD)).count() == len(ODD)


def test_exact_dedup_hash_collisions_keep_texts_apart(docs_of):
    docs = docs_of([(i, f"t{i % 10}") for i in range(100)])
    weak = lambda t: F.unhex(F.substring(F.md5(t), 1, 1))  # noqa: E731  16 values: collisions are certain
    got = exact_dedup(docs, hash_fn=weak).collect()
    assert all(r.group_size == 10 and r.keep_id == r.doc_id % 10 for r in got) and len(got) == 100
    assert sorted(r.doc_id for r in keep_one(docs, hash_fn=weak).collect()) == list(range(10))


def test_keep_one_returns_whole_rows_once(docs_of):
    docs = docs_of(ODD).withColumn("_hash", F.lit("clash")).withColumn("keep_id", F.lit(1))
    kept = keep_one(docs, keep="largest")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 7, 8, 9]


def test_empty_tables(docs_of):
    for op in (exact_dedup, keep_one, interleaved_shards, mix_plan, mix):
        assert op(docs_of([])).collect() == []


@pytest.mark.parametrize("rows_per_range", [9, 200_000])
def test_shards_brute_force(docs_of, rows_per_range):
    docs = docs_of([*ODD, *((i, f"t{i}", None, f"s{i % 4 if i % 3 else 0}") for i in range(20, 300))])
    docs = docs.withColumn("fraction", F.lit("clash")).withColumn("_src", F.lit("clash"))
    got = interleaved_shards(docs, shards=16, rows_per_range=rows_per_range).collect()
    by_source = defaultdict(list)
    for r in docs.collect():
        key = int(hashlib.md5(f"shard-1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:15], 16)
        by_source[r.source].append((key, r.doc_id, r.text or ""))
    want = []
    for s, rows in by_source.items():
        rows.sort(key=lambda x: (x[0], x[1] or 0))
        want += [((2 * k + 1) / (2 * len(rows)), s is None, s or "", key, i, t) for k, (key, i, t) in enumerate(rows)]
    want.sort(key=lambda x: (*x[:4], x[4] or 0))
    n = len(want)
    assert sorted((r.position, r.doc_id, r.text_crc32, r.size) for r in got) == [
        (p, w[4], zlib.crc32(w[5].encode()), len(w[5].encode()) + 1) for p, w in enumerate(want)]
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert all(r.shard == r.position * 16 // n for r in got)


def test_every_shard_has_the_mixture(docs_of):
    got = interleaved_shards(docs_of([(i, "t", None, "hot" if i % 3 else f"s{i % 2}") for i in range(1600)])).collect()
    total, by = Counter(r.source for r in got), Counter((r.shard, r.source) for r in got)
    # Rounding moves a cut by at most half a row per source, seen by each source in its share.
    assert all(abs(by[s, x] - total[x] / 16) <= 1 + len(total) * total[x] / 1600 for s in range(16) for x in total)


def test_mix_targets_by_iteration(docs_of):
    rows = [*ODD, *((i, "w " * (i % 17), None, f"s{i % 5}") for i in range(20, 400))]
    got = mix_plan(docs_of(rows)).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, capped = 1.5 * sum(size.values()), set()
    while True:  # targets stop at twice the size, the excess is reshared by weight
        free = [s for s in order if s not in capped]
        left = total - sum(2 * size[s] for s in capped)
        target = {s: 2 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = [s for s in free if target[s] > 2 * size[s]]
        if not over:
            break
        capped |= set(over)
    source = {r[0]: r[3] for r in rows}
    for r in got:
        assert math.isclose(r.target, target[source[r.doc_id]], rel_tol=1e-12)
        assert r.taken <= 2 * r.size and r.taken in (r.copies * r.size,)
    assert rows_of(mix_plan(docs_of(rows)), ["doc_id", "taken", "target"]) == \
        rows_of(mix_plan(docs_of(rows[::-1])), ["doc_id", "taken", "target"])


def test_mix_emits_what_the_plan_says(docs_of):
    docs = docs_of([(i, "w " * (i % 7), None, f"s{i % 3}") for i in range(300)])
    plan = {r.doc_id: r.copies for r in mix_plan(docs).collect()}
    mixed = mix(docs.withColumn("_row", F.lit(0)))
    assert mixed.columns == [*docs.columns, "_row"]
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in plan.items() if v})


@pytest.mark.parametrize("doc_id", [None, 7])
def test_mixing_draws_apart_where_ids_are_null_or_repeated(docs_of, doc_id):
    """Texts of one id don't share a draw: the taken words come near the target."""
    rows = [(doc_id, f"some five words here {i}", None, source) for source, n in (("a", 400), ("b", 400)) for i in range(n)]
    got = mix_plan(docs_of(rows), weights=(1, 2), share=1.0).groupBy("target").agg(F.sum("taken").alias("t"), F.first("source_size").alias("s"))
    found = got.collect()
    assert len(found) == 2 and all(abs(r.t - r.target) < 0.1 * r.target for r in found)


def test_targets_of_many_sources(docs_of):
    """As many sources as rows, some empty: targets as by filling them one after another."""
    rows = [(i, "w " * (i % 7), None, f"site{i:03d}" if i else None) for i in range(150)]
    got = {r.doc_id: (r.source_size, r.target) for r in mix_plan(docs_of(rows)).collect()}
    names = sorted((r[3] for r in rows), key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    size = {r[3]: r[0] % 7 for r in rows}
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2 * size[s], mid * weight[s]) for s in names) < 1.5 * sum(size.values()) else (low, mid)
    for r in rows:
        assert got[r[0]][0] == size[r[3]] and abs(got[r[0]][1] - min(2 * size[r[3]], high * weight[r[3]])) < 1e-6


def test_ranked_over_many_ranges(spark):
    """Ranks and running sums equal the sorted list's, with ties, nulls and a group that holds most rows."""
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", "z"]), rng.choice([None, 1, 1, 2, 5]), i, rng.randint(0, 9)) for i in range(200)]
    df = written(spark.createDataFrame(rows, "g string, x int, n long, w long").repartition(5), "ranked-test")
    got = {r.n: (r.place, r.before) for r in ranked(df, ["g"], ["x", "n"], "place", {"before": "w"}, rows_per_range=13).collect()}
    whole = {r.n: (r.place, r.before) for r in ranked(df, [], ["g", "x", "n"], "place", {"before": "w"}, rows_per_range=13).collect()}
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    place, before = Counter(), Counter()
    for k, (g, _, n, w) in enumerate(order):
        assert got[n] == (place[g], before[g]) and whole[n] == (k, sum(r[3] for r in order[:k]))
        place[g] += 1
        before[g] += w
    assert len(got) == len(whole) == 200
    assert ranked(df.limit(0), ["g"], ["x"], "place", {"before": "w"}).collect() == []
