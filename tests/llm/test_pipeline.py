"""The corpus pipeline: every stage on its own input against a brute-force version."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from leadlake.llm import packing
from leadlake.llm.common import table, written
from test_joins import brute_components

HEAD = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    """The input and every stage's output, as lists of rows."""
    docs = table(spark, sf_dir, "documents").withColumn("_row", F.lit("clash"))
    odd = spark.createDataFrame(
        [(90_001, None, None, None, None, "x"), (90_002, "", "en", "src1", 0, "x"), (90_003, "12 34", "en", None, 5, "x"),
         (90_004, "the and of that with", "en", None, 20, "x"), (90_005, "the and of that with", "en", "src1", 20, "x"),
         (90_005, "the and of that with", "en", "src1", 20, "x"), (None, "the and of that with all", "en", "src2", 24, "x")],
        docs.schema)
    docs, out = docs.unionByName(odd), []
    out.append((docs.columns, docs.collect()))
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        out.append((docs.columns, docs.collect()))
    return out


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "mixing", "best_fit_packing"]


def test_columns_stay(outputs):
    for columns, _ in outputs[:-1]:
        assert columns == [*HEAD, "_row"]


def test_language_id_drops_only_what_has_no_language(outputs):
    before, after = outputs[0][1], outputs[1][1]
    has_letters = [r for r in before if re.search(r"[^\W\d_]", r.text or "")]
    assert Counter(after) == Counter(has_letters)


def test_exact_dedup_keeps_one_row_per_text(outputs):
    before, after = outputs[1][1], outputs[2][1]
    best = {}
    for r in before:
        if r.text not in best or (best[r.text].doc_id or -1) < (r.doc_id or -1):
            best[r.text] = r
    assert Counter((r.doc_id, r.text) for r in after) == Counter((r.doc_id, r.text) for r in best.values())


def test_near_dedup_keeps_one_of_each_component(outputs):
    before, after = outputs[2][1], outputs[3][1]
    found = brute_components([(r.doc_id, r.text) for r in before], 5)
    assert sorted((r.doc_id for r in after), key=repr) == sorted((d for d, _, c in found if d == c), key=repr)


def test_mixing_copies(outputs):
    before, after = outputs[3][1], outputs[4][1]
    size = {id(r): len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before}
    per_source = Counter()
    for r in before:
        per_source[r.source] += size[id(r)]
    order = sorted(per_source, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    low, high = 0.0, 1e9  # the level, by bisection
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2 * per_source[s], mid * weight[s]) for s in order) < 1.5 * sum(per_source.values()) else (low, mid)
    want = Counter()
    for r in before:
        rate = min(2 * per_source[r.source], high * weight[r.source]) / per_source[r.source]
        key = f"mix-1:{'' if r.doc_id is None else r.doc_id}:{hashlib.md5((r.text or '').encode()).hexdigest()}"
        draw = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16 ** 13
        whole = math.floor(rate + 1e-9)
        want[r] = whole + (draw < rate - whole)
    assert Counter(after) == Counter({k: v for k, v in want.items() if v})


def test_packing_places_every_piece(outputs):
    before, after = outputs[4][1], outputs[5][1]
    with open(packing.TOKENIZER, "rb") as f:
        encoder = packing.Encoder(f.read())
    want = Counter()
    for r in before:
        for piece in packing.cut(encoder.ids(r.text) + b"\x02\0\0\0", 1024):
            want[(r.doc_id, *piece)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after) == want
    sequences = {}
    for r in after:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_run_equals_the_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, pipeline.run(spark, sf_dir).select(key).collect())) == Counter(map(tuple, docs.select(key).collect()))


def test_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.collect() == []


@pytest.mark.parametrize("doc_id", [None, 7])
def test_a_corpus_with_one_id_comes_through(spark, sf_dir, doc_id):
    """All rows share an id or have none: texts tell them apart in every stage."""
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.lit(doc_id).cast("long"))
    counts = [docs.count()]
    for name, stage in pipeline.STAGES[:4]:
        docs = written(stage(spark, docs, sf_dir), name)
        counts.append(docs.count())
    assert counts[1] > 0.9 * counts[0] and counts[2] == docs_distinct(spark, sf_dir) and counts[3] > 0.5 * counts[2]
    assert counts[4] > counts[3] and docs.select("text").distinct().count() > 0.5 * counts[3]


def docs_distinct(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select("text").distinct()
    return texts.where(F.regexp_like("text", F.lit("\\p{L}"))).count()
