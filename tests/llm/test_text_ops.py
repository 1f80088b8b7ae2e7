"""Language ID, packing, quality, search and licences: brute force, held-out accuracy, odd inputs."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlake.llm import langid, license_scan, packing, quality, topk_search
from leadlake.llm.common import table

ODD = [(50_001, None), (50_002, ""), (50_003, " \t\n"), (50_004, "12 34 %%"), (None, "the and of that"),
       (50_006, "a" * 300_000), (50_007, "the " * 50_000), (50_007, "the " * 50_000), (50_008, "\x00İ  \U0001f600 é")]


def auc(scores, labels):
    pairs = sorted(zip(scores, labels))
    rank, n1 = 0.0, sum(labels)
    for _, same in itertools.groupby(enumerate(pairs, 1), key=lambda x: x[1][0]):
        same = list(same)
        rank += sum(i for i, _ in same) / len(same) * sum(p[1] for _, p in same)
    return (rank - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


# language ID

def all_segmentations(word, pieces):
    if not word:
        yield []
    for end in range(1, len(word) + 1):
        if word[:end] in pieces:
            for rest in all_segmentations(word[end:], pieces):
                yield [word[:end], *rest]


def test_forward_sums_all_segmentations():
    rng = random.Random(3)
    pieces = {p: (rng.random() / 20, rng.random() / 20) for p in
              {"▁", "▁a", "▁ab", "a", "b", "c", "ab", "bc", "abc", "ca", "cab"}}
    model = langid.Model(["x", "y"], pieces)
    for word in ("a", "abc", "cabab", "abcabcab"):
        logs = model.log_probabilities(word)
        ways = list(all_segmentations("▁" + word, pieces))
        for k in (0, 1):
            total = sum(math.prod(pieces[p][k] for p in w) for w in ways)
            assert math.isclose(logs[k], math.log(total), rel_tol=1e-9)
            want = {}
            for w in ways:
                share = math.prod(pieces[p][k] for p in w) / total
                for p in w:
                    want[p] = want.get(p, 0) + share
            got = model.expected_pieces(word, k)
            assert all(math.isclose(got.get(p, 0), want.get(p, 0), abs_tol=1e-9) for p in pieces)
    long = model.log_probabilities("ab" * 5000)  # no underflow
    assert all(math.isfinite(x) and x < -1000 for x in long)
    assert model.log_probabilities("zz")[0] < math.log(1e-12)
    words = ["a", "abc", "zz", "cab" * 10, "q", "cabab"]
    assert np.allclose(langid.Scorer(model).scores(words), [model.log_probabilities(w) for w in words], rtol=1e-12)


def test_language_id_held_out(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = {r.doc_id: r for r in langid.language_id(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert set(got) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [r for r in got.values() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_language_id_odd_rows(docs_of):
    train = [(100 + i, t, lang) for i, (t, lang) in enumerate([("the and of that", "en"), ("les des une que", "fr")] * 12)]
    docs = docs_of([*ODD, *train]).withColumn("lang_pred_", F.lit(1))
    got = langid.language_id(docs).collect()
    assert len(got) == len(ODD) + len(train)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in range(50_001, 50_005))
    assert by[50_007].lang_pred == "en" and by[None].lang_pred == "en" and by[50_006].lang_pred in ("en", "fr")
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {50_007, None, 100}
    assert not {*range(50_001, 50_005)} & {r.doc_id for r in kept.collect()}
    assert langid.language_id(docs_of([])).collect() == []
    assert [r.lang_pred for r in langid.language_id(docs_of([(1, "abc")])).collect()] == ["und"]  # nothing to learn from


def test_language_sample_of_a_very_large_language(spark):
    # The share of rows, 5 in about 7.5 million, is below a millionth.
    docs = spark.range(10_000_000).select(F.col("id").alias("doc_id"), F.lit("word").alias("text"), F.lit("en").alias("lang"))
    sampled = langid.training_words(docs, 5, "doc_id", "text", "lang").collect()
    assert [(r.lang, r.word, r.n) for r in sampled] == [("en", "word", 5)]


@pytest.mark.parametrize("doc_id", [None, 1, 7])
def test_language_id_learns_where_ids_are_null_or_repeated(docs_of, doc_id):
    rows = [(doc_id, f"the and of that {i}" if i % 2 else f"les des une que {i}", "en" if i % 2 else "fr") for i in range(3000)]
    docs = docs_of(rows)
    held_out = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2  # by the contract's fold: then nothing may be learnt, but the filter still works
    assert {r.lang_pred for r in langid.language_id(docs).collect()} == ({"und"} if held_out else {"en", "fr"})
    assert langid.keep_identified(docs).count() == 3000
    # Equal rows are taken as often as they are needed, and no other language is learnt from less.
    same = docs_of([(doc_id, "the and of", "en")] * 500 + [(doc_id, "les des", "fr")] * 3)
    sample = {(r.lang, r.word): r.n for r in langid.training_words(same, 200, "doc_id", "text", "lang", from_all=held_out).collect()}
    assert sample == {**{("en", w): 200 for w in ("the", "and", "of")}, **{("fr", w): 3 for w in ("les", "des")}}


def test_language_id_of_many_languages(docs_of):
    """Sixty languages of one word each; too many are an error, not left out."""
    letters = "abcdefghijklmnopqrst"
    rows = [(4 * i + k, f"{letters[i // 20]}{letters[i % 20] * 3} " * 5, f"l{i:02d}") for i in range(60) for k in range(3)]
    got = {r.doc_id: r.lang_pred for r in langid.language_id(docs_of(rows)).collect()}
    assert sum(got[d] == lang for d, _, lang in rows) >= 0.9 * len(rows)
    with pytest.raises(ValueError, match="more than 59"):
        langid.training_words(docs_of(rows), 200, "doc_id", "text", "lang", most_langs=59)


def test_scorer_sizes_its_memory_by_languages():
    few, many = (langid.Scorer(langid.Model([f"l{i}" for i in range(n)], {"▁a": (0.1,) * n})) for n in (4, 256))
    for s in (few, many):
        n = len(s.model.langs)
        assert 8 * n * s.most <= 64 << 20 and 8 * n * s.at_once * (s.short + 2) <= 32 << 20 and 8 * n * s.step <= 32 << 20
    assert np.allclose(many.predict(["a " * 300_000])[0][1], 1 / 256)


def test_expected_pieces_of_long_runs():
    pieces = {"▁": (0.01,), "▁a": (0.002,), "a": (0.03,), "b": (0.004,), "ab": (0.001,), "ba": (1e-6,)}
    model = langid.Model(["x"], pieces)
    for word in ("ab" * 40, "ab" * 3000, "zq" * 500 + "ab" * 500 + "z" * 300):
        got = model.expected_pieces(word, 0)
        letters = sum(len(p) * e for p, e in got.items())
        assert math.isclose(letters, len(word) + 1, rel_tol=1e-9)  # every segmentation covers each letter once
    one, many = (model.expected_pieces("ab" * n, 0)["ab"] for n in (30, 3000))
    assert math.isclose(many, 100 * one, rel_tol=0.05)


def test_language_fit_covers_long_runs_and_all_languages(docs_of):
    docs = docs_of([(1, "ab" * 50 + " cd", "x"), (3, "ab" * 50, "x"), (4, "ab", "y")])
    sampled = {(r.lang, r.word): r.n for r in langid.training_words(docs, 200, "doc_id", "text", "lang").collect()}
    assert sampled[("x", "ab" * 50)] >= 1
    with pytest.raises(ValueError):
        langid.training_words(docs, 200, "doc_id", "text", "lang", most_langs=1)


# packing

def test_ids_equal_the_tokenizers(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(packing.TOKENIZER, "rb") as f:
        mine = packing.Encoder(f.read(), cache_words=500)
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    theirs.encode_special_tokens = True
    rng = random.Random(1)
    odd = ["".join(rng.choice([" ", "  ", "\n", "\t", "a", "it's", "é", "9", "!!", " ", "\x1c", "\x85"])
                   for _ in range(30)) for _ in range(400)]
    texts = [r.text for r in table(spark, sf_dir, "documents").collect()] + odd + ["<|endoftext|> x", "\x00\ud7ff\U0010ffff"]
    for t in texts:
        assert np.frombuffer(mine.ids(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids


def test_added_tokens_are_found_in_texts(docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # the contract's plain call
    with open(packing.TOKENIZER, "rb") as f:
        mine = packing.Encoder(f.read(), added=packing.added_tokens())
    rng, end = random.Random(8), "<|endoftext|>"
    texts = ["x" + end, end, end * 3, f"a {end} b", f"a  {end}  b \n", f" {end}", "<|endoftext|", "<|EndOfText|>", f"<|{end}|>"]
    texts += ["".join(rng.choice([end, " ", "  ", "\n", "a", "it's", "é", "9", "<|", "|>", "\u3000"]) for _ in range(20)) for _ in range(400)]
    for t in texts:
        assert np.frombuffer(mine.ids(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pieces(docs_of(list(enumerate(texts)))).collect()}
    for k, t in enumerate(texts):
        ids = [*theirs.encode(t, add_special_tokens=False).ids, packing.END_ID]
        assert got[k] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_cut():
    ids = np.arange(2500, dtype="<u4").tobytes()
    assert [x[:3] for x in packing.cut(ids, 1024)] == [(0, 0, 452), (1, 452, 1024), (2, 1476, 1024)]
    assert [x[:3] for x in packing.cut(ids[:4096], 1024)] == [(0, 0, 1024)]
    assert [x[:3] for x in packing.cut(ids[:8192], 1024)] == [(0, 0, 1024), (1, 1024, 1024)]
    assert [x[:3] for x in packing.cut(ids[:4], 1024)] == [(0, 0, 1)]


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacities", [(1024.0, 1024.0, 1024.0 ** 2), (1024.0, 3.0, 300_000.0)])
def test_best_fit_keeps_every_constraint(rule, capacities):
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.integers(1, 500, 3000))[::-1]
    where, offset = packing.best_fit(lengths, capacities, (1.0, 0.001, 0.001), rule)
    for b in range(where.max() + 1):
        own = np.flatnonzero(where == b)
        assert lengths[own].sum() <= capacities[0] and len(own) <= capacities[1]
        assert np.square(lengths[own].astype(float)).sum() <= capacities[2]
        ends = sorted((o, o + n) for o, n in zip(offset[own], lengths[own]))
        assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    if capacities[1] > 1000:
        assert where.max() + 1 <= -(-lengths.sum() // 1024) + 2


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacities", [(1024.0, 1024.0, 1024.0 ** 2), (1024.0, 4.0, 200_000.0)])
def test_best_fit_takes_the_best_bin_of_all(rule, capacities):
    """Replayed piece by piece over all bins: no other one that fits scores better, a new one is opened only if none fits."""
    rng, weights = np.random.default_rng(3), (1.0, 0.3, 0.2)
    lengths = np.sort(np.r_[rng.integers(1, 600, 250), rng.integers(1, 40, 150)])[::-1]
    where, _ = packing.best_fit(lengths, capacities, weights, rule)
    left = []
    for t, b in zip(map(float, lengths), where):
        need, scores = (t, 1.0, t * t), {}
        for k, free in enumerate(left):
            if all(f >= n for f, n in zip(free, need)):
                parts = zip(weights, free, need, capacities)
                if rule == "norm":
                    scores[k] = sum(w * ((f - n) / c) ** 2 for w, f, n, c in parts)
                else:
                    scores[k] = -sum(w * (n / c) * (f / c) for w, f, n, c in parts)
        if b == len(left):
            assert not scores
            left.append(list(capacities))
        else:
            assert math.isclose(scores[b], min(scores.values()), rel_tol=1e-9, abs_tol=1e-12)
        left[b] = [f - n for f, n in zip(left[b], need)]


def test_packing_whole_table(spark, sf_dir, docs_of):
    docs = table(spark, sf_dir, "documents").unionByName(docs_of(ODD)).withColumn("length", F.lit("clash"))
    got = packing.best_fit_packing(docs).collect()
    by_sequence, per_doc = {}, {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        per_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for places in by_sequence.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 1024
    assert len(by_sequence) <= 1.01 * sum(r.length for r in got) / 1024 + 2
    assert per_doc[50_001] == [(0, 0, 1)] and per_doc[50_002] == [(0, 0, 1)]
    assert len(per_doc) == docs.select("doc_id").distinct().count()
    assert len(set(per_doc[50_007])) * 2 == len(per_doc[50_007])  # the repeated row is packed twice
    assert packing.best_fit_packing(docs_of([])).collect() == []
    many = packing.best_fit_packing(docs_of([(i, "w " * (i % 9)) for i in range(500)]), group_rows=100)
    assert many.count() == 500


# quality

def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(64) < 0.2) for _ in range(120)]
    labels = [int(3 in x or 5 in x) for x in rows]
    model = quality.train(rows, labels, bits=6, rounds=500)
    ratio = np.sqrt(model.squares)
    x = np.zeros((len(rows), 65))
    for i, r in enumerate(rows):
        norm = np.sqrt(model.squares[r].sum()) or 1.0
        x[i, r], x[i, 64] = 1.0 / norm, 1.0
    y = np.array(labels) * 2.0 - 1
    upper = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    margin = x @ np.append(model.weights, model.bias)
    sign_w = np.append(np.divide(model.weights, ratio, out=np.zeros(64), where=ratio > 0), model.bias)
    primal = 0.5 * sign_w @ sign_w + (upper * np.maximum(0, 1 - y * margin)).sum()
    scaled = x.copy()
    scaled[:, :64] *= ratio
    best = min(primal_descent(scaled, y, upper, lr) for lr in (0.001, 0.003))
    assert primal <= best * 1.02 + 1e-6


def primal_descent(x, y, upper, rate, rounds=6000):
    w, best = np.zeros(x.shape[1]), math.inf
    for k in range(rounds):
        m = x @ w
        best = min(best, 0.5 * w @ w + (upper * np.maximum(0, 1 - y * m)).sum())
        w -= rate / (1 + k / 500) * (w - ((upper * y * (y * m < 1))[:, None] * x).sum(axis=0))
    return best


def test_quality_held_out(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    got = quality.quality_classifier(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    assert len(got) == table(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert auc([r.score for r in held], [labels[r.doc_id] for r in held]) > 0.95


def test_quality_fit_takes_one_row_of_an_id_and_only_ids_with_documents(spark, docs_of):
    """A labelled id repeated very often reaches the driver once; missing and too long documents don't use up the sample."""
    rows = [(i, f"good text {i} indeed" if i % 2 else f"buy now {i} !!!") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1000)], "doc_id long, quality int")
    seen = []

    def train(x, y, bits, **options):
        seen.append((len(x), len(y)))
        return original(x, y, bits, **options)

    original, quality.train = quality.train, train
    try:
        for docs in (docs_of(rows), docs_of(rows + rows * 50 + [(i, "long " * 30_000) for i in range(40, 80)])):
            quality.fit(docs, labels, sample_rows=15)
    finally:
        quality.train = original
    assert seen == [(15, 15)] * 2


def test_quality_odd_rows(spark, docs_of):
    docs = docs_of([*ODD, *((100 + i, "good words here" if i % 2 else "BAD!! BAD!! STUFF!!") for i in range(60))])
    labels = spark.createDataFrame([(100 + i, i % 2, 0) for i in range(60)] + [(101, 0, 0), (50_001, None, None), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_classifier(docs, labels).collect()}
    assert got[101].predicted == 1 and got[100].predicted == 0 and 0 <= got[50_001].score <= 1
    none = quality.quality_classifier(docs, labels.limit(0)).collect()
    assert len(none) == docs.count() and all(r.score == 0.5 and r.predicted == 1 for r in none)
    assert quality.quality_classifier(docs_of([]), labels).collect() == []


# search

def brute_force(ids, vectors, queries, k):
    whole = [[math.floor(1024 * float(x)) for x in v] for v in vectors]
    width = max(map(len, whole), default=0)
    whole = [v + [0] * (width - len(v)) for v in whole]
    out = []
    for q in queries:
        mine = whole[ids.index(q)]
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in zip(ids, whole) if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(7, 2, 3), (16_384, 1024, 128)])
def test_search_equals_brute_force(spark, sizes):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 5, 1) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [0.5, -0.25, 0.0, 1.0, 2.0, -1.0]) for i in range(40)]  # many ties
    odd = [(400, None), (401, [1.0, None]), (402, [float("nan")]), (403, [float("inf"), 1.0]), (None, [1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    shard, chunk, block = sizes
    got = topk_search.top_k_search(df, F.col("vec_id") % 10 == 0, 10, 1024, shard, chunk, block)
    queries = [i for i, _ in rows if i % 10 == 0]
    assert sorted(map(tuple, got.collect())) == brute_force([i for i, _ in rows], [v for _, v in rows], queries, 10)


def test_search_edge_cases(spark):
    schema = "vec_id long, embedding array<double>"
    assert topk_search.top_k_search(spark.createDataFrame([], schema), F.col("vec_id") % 10 == 0).collect() == []
    few = spark.createDataFrame([(0, [1e200, -1.0]), (1, [1e200, 2.0]), (2, [1.0]), (0, [1.0, 1.0])], schema)
    got = topk_search.top_k_search(few, F.col("vec_id") == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert got[0].score == 2 ** 63 - 1


def test_search_prunes_blocks():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (20, 16))
    rows = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 20, (4000, 16)))
    *_, scored = topk_search.best_of_blocks(np.arange(40), rows[:40], np.arange(4000), rows, 10, 64)
    assert scored < 0.4 * 40 * (4000 / 64)


# licences

def base_by_regex(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = [(i, label) for phrase, label in license_scan.BASE_PHRASES.items()
             for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found)


def test_license_base_against_words(spark, sf_dir, docs_of):
    more = [(9000 + i, t) for i, t in enumerate([
        "MIT-License, mit license MIT\nLICENSE apache license", "cc by cc by cc", "CC0 xcc by", "cc\x85by",
        "gnu general public licence", "é mit license", "GNU General Public License, version 3", "mit licenses"])]
    docs = table(spark, sf_dir, "documents").unionByName(docs_of([*ODD, *more]))
    got = license_scan.license_scan(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        n, places = base_by_regex(texts[r.doc_id])
        starts = [p for p, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and 0 <= r.score <= 1


def test_license_rules_and_suppression():
    scan = license_scan.Scanner()
    assert len(scan.rules) >= 250
    label = lambda t: [d[2].label for d in scan.detect(t.lower())]
    assert label("Licensed under the Apache License, Version 2.0.") == ["apache-2.0"]
    assert label("SPDX-License-Identifier: GPL-2.0-or-later") == ["gpl-2.0"]
    assert label("released under the GNU Lesser General Public License v2.1") == ["lgpl-2.1"]
    assert label("Licensed under CC BY-NC 4.0.") == ["cc-by-nc"]
    assert label("Permission is hereby granted, free of charge, to any person obtaining a copy") == ["mit"]
    assert label("see https://opensource.org/licenses/BSD-2-Clause") == ["bsd-2-clause"]
    assert sorted(set(label("MIT License. Also the zlib license."))) == ["mit", "zlib"]
    assert label("mit dem Bus") == [] and label("") == []


def test_license_gate_misses_nothing(spark, sf_dir):
    scan = license_scan.Scanner()
    texts = [r.text.lower() for r in table(spark, sf_dir, "documents").collect()]
    texts += [f"licensed under the {x}" for x in (
        "gnu gpl", "cc0 1.0", "cc-by", "cc by-sa", "cc by nd", "creative commons zero", "general public license",
        "3-clause bsd license", "creative commons attribution-noncommercial-sharealike")]
    for t in map(license_scan.flat, texts):
        ungated = {r.label for r in scan.rules if r.pattern.search(t)}
        active = {k for _, ks in scan.gate.iter(t) for k in ks}
        assert ungated == {scan.rules[k].label for k in active if scan.rules[k].pattern.search(t)}


def wordings(pattern, rng, space):
    """A random text of the regex: each alternative, optional part and white space by chance."""
    from re import _parser

    def one(items):
        return "".join(node(op, arg) for op, arg in items)

    def node(op, arg):
        op = str(op)
        if op == "LITERAL":
            return chr(arg)
        if op == "BRANCH":
            return one(rng.choice(arg[1]))
        if op == "SUBPATTERN":
            return one(arg[-1])
        if op in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, body = arg
            return "".join(one(body) for _ in range(rng.randint(least, min(int(most), least + 2))))
        if op == "IN":
            kind, value = rng.choice(arg)
            if str(kind) == "RANGE":
                return chr(rng.randint(*value))
            return chr(value) if str(kind) == "LITERAL" else {"CATEGORY_SPACE": space(), "CATEGORY_DIGIT": "7"}.get(str(value), "w")
        if op == "AT" or op.startswith("ASSERT"):
            return ""
        assert op in ("ANY", "CATEGORY"), op
        return "x"

    return one(_parser.parse(pattern))


def test_license_gate_opens_for_every_wording_of_every_rule():
    scan, rng, seen = license_scan.Scanner(), random.Random(4), set()
    for k, r in enumerate(scan.rules):
        for _ in range(60):
            t = f"see {wordings(r.pattern.pattern, rng, lambda: rng.choice([' ', chr(10), chr(9), chr(0xa0), chr(0x85)]))} ."
            t = license_scan.flat(t)
            if r.pattern.search(t):  # look-arounds may forbid a wording
                seen.add(k)
                assert k in scan.active(t), (r.label, t)
    assert seen == set(range(len(scan.rules)))


def test_license_alternative_and_wrapped_wordings():
    label = lambda t: license_scan.Scanner().scan(t)[5].split(",")
    assert label("Creative Commons Attribution 4.0") == ["cc-by-4.0"] and label("under CC-BY 3.0") == ["cc-by", "cc-by-3.0"]
    assert label("Confidential and proprietary") == ["proprietary"]
    assert label("under the GNU General\n * Public License".replace(" *", "")) == ["gpl"]
    assert "gpl-2.0" in label("GNU General\nPublic License version 2") and "ofl-1.1" in label("SIL Open\n\tFont License")
    assert label("Neither the names of the authors may be used to endorse or promote") == ["bsd-3-clause"]
    assert label("huggingface.co/spaces/a/license") == ["openrail"]
    assert "cc-by-nc-sa" in label("attribution-noncommercial-sharealike")
    assert label("opendatacommons.org/licenses/by") == ["odc-by"]


#: Headers and clauses as they stand in files, and the labels of their own rules.
REAL = [
    ("This file is in the public domain.", {"public-domain"}), ("It was placed in the public domain by its author.", {"public-domain"}),
    ("released into the public domain", {"public-domain"}), ("dedicated to the public domain", {"public-domain"}),
    ("/* Neither the name of the University nor the names of its\n * contributors may be used to endorse or promote products\n */", {"bsd-3-clause"}),
    ("# University of Illinois/NCSA\n# Open Source License\n", {"ncsa"}),
    ("// SPDX-License-Identifier: MIT OR Apache-2.0", {"mit", "apache-2.0"}),
    ("SPDX-License-Identifier: (MIT OR GPL-2.0-only)", {"mit", "gpl-2.0"}),
    ("SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR LGPL-2.1-or-later", {"mit", "bsd-3-clause", "lgpl-2.1"}),
    ("SPDX-License-Identifier: GPL-2.0+", {"gpl-2.0"}), ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", {"gpl-2.0"}),
    ("Licensed under GPLv3", {"gpl-3.0"}), ("LGPLv2.1 applies", {"lgpl-2.1"}), ("under the GNU GPL v2.", {"gpl-2.0"}), ("AGPLv3", {"agpl-3.0"}),
    ("GNU Library General Public License version 2", {"lgpl-2.0"}), ("GNU Lesser General Public License, version 3", {"lgpl-3.0"}),
    ("dnl\n;; This program is free software; you can redistribute it\n;; and/or modify it under the terms of the GNU General\n"
     ";; Public License as published by the Free Software\n;; Foundation; version 2", {"gpl"}),
    (" * Licensed under the Apache License,\n * Version 2.0 (the \"License\");\n * you may not use this file except in\n"
     " * compliance with the License.\n", {"apache-2.0"}),
    ("Permission is hereby granted, free of\n-- charge, to any person\n-- obtaining a copy of this software", {"mit"}),
    ("The public domain tax is a proposal", set()), ("gplv is no licence", set()), ("spdx-license-identifier: none", set()),
]


@pytest.mark.parametrize("text, labels", REAL)
def test_license_headers_as_they_stand(text, labels):
    assert {d[2].label for d in license_scan.Scanner().detect(text.lower())} == labels


def test_license_suppression_against_brute_force(spark, sf_dir):
    """Priority, length, start; a detection inside a kept one goes. All rules, no gate, no index of intervals."""
    scan, rng = license_scan.Scanner(), random.Random(9)
    texts = [r.text.lower() for r in table(spark, sf_dir, "documents").collect()][:80]
    texts += [" ".join(rng.sample([t for t, _ in REAL], 6)).lower() for _ in range(60)]
    for t in texts:
        line = license_scan.flat(t)
        every = []
        for r in scan.rules:
            for m in r.pattern.finditer(line):
                every.append((*(m.span("at") if "at" in r.pattern.groupindex else m.span()), r))
        kept = []
        for d in sorted(every, key=lambda d: (-d[2].priority, -(d[1] - d[0]), d[0], d[2].label)):
            if all(not (k[0] <= d[0] and d[1] <= k[1]) for k in kept):
                kept.append(d)
        assert [(a, b, r.label) for a, b, r in scan.detect(t)] == [(a, b, r.label) for a, b, r in kept]
