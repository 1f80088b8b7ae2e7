"""Line dedup, near-duplicates and components against brute force; large groups; odd inputs."""

import random

import pytest
from pyspark.sql import functions as F

from leadlake.llm import line_dedup as ld
from leadlake.llm import minhash
from leadlake.llm.common import maybe_among, table
from leadlake.llm.components import connected_components
from leadlake.llm.queries import ORACLES, QUERIES


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def within(a, b, most):
    """Whether the distance is at most ``most``: only cells near the diagonal count."""
    while a and b and a[-1] == b[-1]:
        n = 64 if a[-64:] == b[-64:] else 1
        a, b = a[:-n], b[:-n]
    far = most + 1
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            same = row.get(j - 1, far) + (b[j - 1] != x) if j else far
            new[j] = min(same, row.get(j, far) + 1, new.get(j - 1, far) + 1) if i or j else 0
        if not new or min(new.values()) > most:
            return False
        row = new
    return row.get(len(b), far) <= most


def edited(rng, s, times, letters="abé"):
    out = list(s)
    for _ in range(times):
        at, what = rng.randint(0, len(out)), rng.randint(0, 2)
        if what == 0:
            out.insert(at, rng.choice(letters))
        elif what == 1 and out:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("name", ["op1_line_dedup", "op5_minhash_near_dedup"])
def test_query_matches_sql(spark, sf_dir, duck, name):
    df, rel = QUERIES[name](spark, sf_dir), duck.sql(ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(map(tuple, rel.select(*cols).fetchall()))


def test_components(spark):
    rng = random.Random(4)
    for links in ([], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)],
                  [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)]):
        df = spark.createDataFrame(links, "u long, v long")
        real = [(a, b) for a, b in links if a != b]
        u = Union({x for e in real for x in e})
        for a, b in real:
            u.join(a, b)
        assert dict(map(tuple, connected_components(df).collect())) == {x: u.find(x) for x in u.up}


def test_maybe_among_keeps_all_wanted(spark):
    df = spark.range(20_000).withColumn("_map", F.lit(1))
    wanted = spark.range(0, 20_000, 7).withColumnRenamed("id", "w")
    got = {r.id for r in maybe_among(df.drop("_map"), F.col("id"), wanted).collect()}
    assert got >= set(range(0, 20_000, 7)) and len(got) < 3500
    assert maybe_among(df.drop("_map"), F.col("id"), wanted.limit(0)).count() == 0


# lines

def test_banded_distance(spark):
    rng = random.Random(2)
    for edits in (1, 2, 4):
        rows = [(a, edited(rng, a, rng.randint(0, edits + 2))) for a in
                ("".join(rng.choice("abé") for _ in range(rng.randint(2 * edits + 2, 30))) for _ in range(500))]
        rows = [(a, b) for a, b in rows if abs(len(a) - len(b)) <= edits]
        got = (spark.createDataFrame(rows, "a string, b string")
               .select("a", "b", ld._characters(F.col("a")).alias("x"), ld._characters(F.col("b")).alias("y"))
               .select("a", "b", ld.banded_distance(F.col("x"), F.col("y"), edits).alias("d")).collect())
        assert all(min(r.d, edits + 1) == min(distance(r.a, r.b), edits + 1) for r in got)


def allowed(x, y, bands):
    """The edits two lines may differ by, from the shorter one's length."""
    return max((e for least, e in bands if min(len(x), len(y)) >= least), default=0)


def brute_lines(docs, bands):
    """{(place, class, class_lines, n_links, kept)} of (doc_id, text) rows."""
    where = {}
    for doc_id, text in docs:
        for n, x in enumerate((text or "").split("\n")):
            where.setdefault(x, []).append((doc_id, n))
    low = lambda p: (p[0] is not None, p)  # noqa: E731  a null id comes first
    first = {x: min(v, key=low) for x, v in where.items()}
    u, links = Union(first), {x: set() for x in first}
    names = sorted(first)
    for i, x in enumerate(names):
        for y in names[i + 1:]:
            if abs(len(x) - len(y)) <= allowed(x, y, bands) and within(x, y, allowed(x, y, bands)):
                links[x].add(y)
                links[y].add(x)
                u.join(x, y)
    groups = {}
    for x in first:
        groups.setdefault(u.find(x), []).append(x)
    out = set()
    for members in groups.values():
        kept = min(members, key=lambda x: low(first[x]))
        for x in members:
            out |= {(p, first[kept], len(members), len(links[kept]), p == first[kept]) for p in where[x]}
    return out, sum(map(len, links.values()))


def found_lines(docs, **options):
    rows = ld.line_dedup(docs, **options).collect()
    return {((r.doc_id, r.line_no), (r.class_doc_id, r.class_line_no), r.class_lines, r.n_links, r.kept) for r in rows}, len(rows)


@pytest.mark.parametrize("bands, shortest, longest", [(((24, 1),), 20, 40), (((24, 2),), 20, 40), (((24, 3),), 20, 40),
                                                      (((12, 2), (6, 1)), 3, 16)])
def test_line_links_brute_force(docs_of, bands, shortest, longest):
    """Also lines around the bands' borders, letters of one to four bytes, clashing columns."""
    rng, lines = random.Random(len(bands) + bands[0][1]), []
    for _ in range(40):
        base = "".join(rng.choice("abé \U0001f600" if shortest > 5 else "abcdé ") for _ in range(rng.randint(shortest, longest)))
        lines += [base, *(edited(rng, base, rng.randint(0, bands[0][1] + 2)) for _ in range(5))]
    rows = [(i, "\n".join(lines[i::20])) for i in range(20)] + [(90, None), (91, ""), (92, "\n\n"), (93, lines[0])]
    docs = docs_of(rows).withColumn("line", F.lit("clash")).withColumn("hash", F.lit("clash")).withColumn("k", F.lit(1))
    want, links = brute_lines(rows, bands)
    assert found_lines(docs, bands=bands) == (want, len(want)) and links > 40


def test_lines_with_null_ids_repeats_and_a_very_long_line(docs_of):
    long = "word " * 20_000 + "end of it"
    text = "a line that is long enough\n\nanother line of the text"
    rows = [(None, text), (None, text), (5, text.replace("line", "lime")), (5, text), (7, ""), (8, long), (9, long.replace("it", "at")),
            (8, long), (10, "Subscribe to our mail"), (11, "Subscribe to our mails"), (12, "abcdef"), (13, "abcdeg"), (14, "abcde"), (15, "abcdf")]
    got, _ = found_lines(docs_of(rows))
    assert got == brute_lines(rows, ld.BANDS)[0]


def variants(rng, words, n, edits_each):
    for _ in range(n):
        out = list(words)
        for _ in range(edits_each):
            out[rng.randrange(len(out))] = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
        yield " ".join(out)


def test_large_groups_of_variants_are_not_paired_with_each_other(spark, docs_of):
    """Hundreds of variants of one line, most unlinked, and a group that is linked throughout: the links are
    found, few pairs are verified."""
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    lines = list(variants(rng, base, 300, 3)) + [f"Page {i:03d} of the whole collection of pages" for i in range(150)]
    lines += [edited(rng, lines[i], 2, "abc") for i in range(40)]
    rows = [(i, x) for i, x in enumerate(lines)]
    got, _ = found_lines(docs_of(rows))
    assert got == brute_lines(rows, ld.BANDS)[0]
    nodes, entries = ld.meeting_lines(docs_of(rows), ld.BANDS)
    links = ld.verified(ld.pivot_pairs(entries), nodes, ld.BANDS)
    pairs = ld.cross_pairs(entries, nodes, connected_components(links), ld.BANDS).count()
    assert ld.pivot_pairs(entries).count() <= entries.count() and pairs < 10 * len(lines)


def test_within_is_the_distance():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        b = edited(rng, a, rng.randint(0, 4), "ab")
        for most in (1, 2):
            assert within(a, b, most) == (distance(a, b) <= most)


def test_word_parity_changes_by_three_bits_an_edit(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("ab  é") for _ in range(rng.randint(6, 40)))
        rows.append((a, edited(rng, a, 1, "ab ")))
    df = spark.createDataFrame(rows, "a string, b string")
    worst = df.select(F.max(F.bit_count(ld.word_parity(F.col("a")).bitwiseXOR(ld.word_parity(F.col("b")))))).first()[0]
    assert 0 < worst <= 3


def test_characters_parity_changes_by_two_bits_a_place(spark):
    rng = random.Random(16)
    rows = [(a, edited(rng, a, 1, "ab ")) for a in ("".join(rng.choice("ab  é\U0001f600") for _ in range(rng.randint(6, 40))) for _ in range(400))]
    df = spark.createDataFrame(rows, "a string, b string")
    for size in (1, 2):
        apart = F.bit_count(ld.char_parity(F.col("a"), size).bitwiseXOR(ld.char_parity(F.col("b"), size)))
        assert 0 < df.select(F.max(apart)).first()[0] <= 2 * size


def test_a_line_makes_few_keys(spark):
    """One try per shift and class of lengths, not one per length a match may have."""
    rows = [("x" * n, n) for n in range(100, 400)]
    keys = ld.keyed(spark.createDataFrame(rows, "line string, n0 int"), ld.BANDS)
    assert keys.count() <= 6 * len(rows) and keys.where("posted").count() == 3 * len(rows)


def test_variants_with_an_inserted_part_are_told_apart(docs_of):
    """Copies of a line with four letters inserted share most of their segments; few pairs of them are verified."""
    rng = random.Random(18)
    base = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvw") for _ in range(rng.randint(2, 9))) for _ in range(55))
    lines = []
    for _ in range(150):
        at = rng.randrange(len(base))
        lines.append(base[:at] + "".join(rng.choice("abcdefghijklmnopqrstuvw") for _ in range(4)) + base[at:])
    nodes, entries = ld.meeting_lines(docs_of(list(enumerate(lines))), ld.BANDS)
    links = ld.verified(ld.pivot_pairs(entries), nodes, ld.BANDS)
    pairs = ld.cross_pairs(entries, nodes, connected_components(links), ld.BANDS).count()
    assert pairs < 4 * len(lines)


def test_drop_repeated_lines(docs_of):
    docs = docs_of([(2, "a line that comes more than once\nown line of the second"),
                    (1, "a line that comes more than onze\nx\nx"), (3, "x"), (4, None)])
    got = {r.doc_id: r.text for r in ld.drop_repeated_lines(docs).collect()}
    assert got == {1: "a line that comes more than onze\nx", 2: "own line of the second", 4: ""}
    assert ld.line_dedup(docs_of([])).collect() == []


# near-duplicates

def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows, k, percent=80):
    sets = [shingle_set(t, k) for _, t in rows]
    u = Union(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                u.join(i, j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(u.find(i), []).append(d)
    low = {g: min((d for d in v if d is not None), default=None) for g, v in groups.items()}
    return [(d, len(sets[i]), low[u.find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def near_rows(seed, groups=12, copies=25, most_changed=0.12):
    rng, rows = random.Random(seed), []
    words = [f"w{i}" for i in range(400)]
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 30, 120]))]
        for _ in range(copies):
            t = [rng.choice(words) if rng.random() < rng.random() * most_changed else w for w in base]
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\n", "\t "]).join(t).upper() if rng.random() < 0.1 else " ".join(t)))
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_brute_force(docs_of, k):
    rows = [*near_rows(k), (5000, None), (5001, ""), (5002, " \t"), (5003, "single"), (5004, "single"), (5005, "SINGLE\n"),
            (None, "single"), (5006, "a b"), (5007, "a b"), (5007, "a b"), (5008, "a\x85b"), (5009, "w " * 60_000)]
    docs = docs_of(rows).withColumn("key", F.lit("clash")).withColumn("component_id", F.lit("clash"))
    got = minhash.near_duplicates(docs, words=k).collect()
    want = brute_components(rows, k)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_large_near_group_makes_few_pairs(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 10_000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        t = list(base)
        for at in rng.sample(range(150), rng.randint(0, 9)):
            t[at] = f"x{rng.randint(0, 10_000)}"
        rows.append((i, " ".join(t)))
    pairs = []
    write = minhash.written
    monkeypatch.setattr(minhash, "written", lambda df, name: [out := write(df, name),
                        pairs.append(out.count()) if "pairs" in name else None][0])
    got = minhash.near_duplicates(docs_of(rows), words=2).collect()
    want = {d: c for d, _, c in brute_components(rows, 2)}
    assert {r.doc_id: r.component_id for r in got} == want
    assert max(pairs) < 400 * 399 / 2 / 5  # not the group's pairs


def test_keep_representatives(docs_of):
    rows = [(3, "one two three four five six"), (2, "one two three four five six"), (1, "other words stand in this text"),
            (1, "other words stand in this text"), (7, None), (8, "")]
    docs = docs_of(rows).withColumn("_row", F.lit("clash"))
    kept = minhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 7, 8]
    assert minhash.keep_representatives(docs_of([])).collect() == []


def test_one_representative_of_copies_that_share_an_id(docs_of):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join([*words[:-1], end]) for end in ("x", "y", "z")]
    other = [" ".join([f"v{i}" for i in range(59)] + [end]) for end in ("x", "y")]
    rows = [(1, near[0]), (1, near[1]), (None, near[2]), (None, other[0]), (None, other[1]),
            (1, "a text that is like none of them"), (4, ""), (4, "")]
    kept = sorted((r.doc_id, r.text) for r in minhash.keep_representatives(docs_of(rows)).na.fill({"doc_id": -1}).collect())
    assert [k[0] for k in kept] == [-1, 1, 1, 4]
    assert kept[0][1] in other and ("a text that is like none of them" in {t for _, t in kept[1:3]})
    assert len({t for _, t in kept} & set(near[:2])) == 1


def test_recall_of_the_candidate_rule_near_the_threshold():
    """Pairs of sets of a similarity of 0.80 to 0.85, by the hash family in use: half of the signature agrees."""
    shingler, rng = minhash.Shingler(2, 40), random.Random(12)
    missed = n = 0
    for _ in range(4000):
        size = rng.randint(40, 300)
        both = -(-80 * 2 * size // 180) + rng.randint(0, max(1, size // 40))  # similar from 0.80 on
        own = size - both
        pool = [rng.getrandbits(64) for _ in range(both + 2 * own)]
        x, y = (shingler.signature(minhash.np.unique(minhash.np.array(s, minhash.np.uint64)))
                for s in (pool[:size], pool[:both] + pool[size:]))
        similarity = both / (2 * size - both)
        if 0.80 <= similarity <= 0.85:
            n += 1
            missed += int((x == y).sum()) < 20
    assert n > 3000 and missed <= 2
