"""WARC archives: round trips, record format, determinism, rolling, repeated commits, odd rows, SQL."""

import hashlib
import io
import os
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from leadlake.llm import warc
from leadlake.llm.queries import ORACLES, QUERIES
from leadlake.llm.warc_archive import archived_pages, read_archive, write_archive

COLS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
SCHEMA = "page_id long, url string, html string"
BIG, OTHER = "<p>" + "x" * 1000, "é" * 600


def pages_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows, revisit_from=1000):
    """The contract; of rows equal in id and payload one is the response."""
    out, done = [], set()
    best = {}
    for page, _, html in rows:
        key = -1 if page is None else page
        best[html or ""] = max(best.get(html or "", -1), key)
    for page, _, html in rows:
        data = (html or "").encode()
        to, first = best[html or ""], len(data) < revisit_from
        if not first and (-1 if page is None else page) == to and html not in done:
            done.add(html)
            first = True
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if first else "revisit",
                    None if first or to < 0 else to))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


ROWS = ([(i, f"http://a/{i}", BIG) for i in range(0, 40, 3)] + [(i, None, OTHER) for i in (1, 2)]
        + [(None, "http://n/1", BIG), (None, "http://n/2", "<p>" + "y" * 2000), (None, "http://n/3", "<p>" + "y" * 2000)]
        + [(50, "http://a b/é\r\nX: 1", "a"), (51, "", None), (52, None, ""), (53, "u", "a"), (54, "u", "long " * 60_000)]
        + [(60, "same", BIG + "z")] * 4 + [(61, "same", "small")] * 3 + [(62, "u1", OTHER + "!"), (62, "u2", OTHER + "!")])


@pytest.mark.parametrize("shard_bytes, most_shards", [(32 << 20, 8192), (3000, 8192), (3000, 3), (1, 64)])
def test_round_trip_of_odd_rows(spark, shard_bytes, most_shards):
    rows = list(ROWS)
    random.Random(1).shuffle(rows)
    got = archived_pages(pages_of(spark, rows), shard_bytes=shard_bytes, most_shards=most_shards, roll_bytes=2000)
    assert found(got) == brute(rows)


def test_payloads_come_back_and_files_are_valid(spark):
    base, manifest = write_archive(pages_of(spark, ROWS), shard_bytes=5000, roll_bytes=1500)
    got = read_archive(spark, base).where("record_type = 'response'").collect()
    payloads = Counter((r.page_id, bytes(r.payload).decode()) for r in got)
    assert all(hashlib.sha1(bytes(r.payload)).hexdigest() == r.payload_digest for r in got)
    assert payloads[61, "small"] == 3 and payloads[60, BIG + "z"] == 1 and payloads[54, "long " * 60_000] == 1
    files = manifest.collect()
    root = base.removeprefix("file://")
    assert len(files) > 2 and not os.path.exists(f"{root}/_temporary")
    ids = Counter()
    for f in files:
        with open(f"{root}/{f['name']}", "rb") as file:
            data = file.read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (f["bytes"], f["sha256"])
        records = [warc.parse(m)[0] for m in warc.members(io.BytesIO(data), chunk=77)]
        assert records[0]["warc-type"] == "warcinfo" and len(records) == f["records"] + 1
        ids.update(r["warc-record-id"] for r in records[1:])
        assert all("\n" not in r["warc-target-uri"] for r in records[1:])
    assert max(ids.values()) == 1 and sum(ids.values()) == len(ROWS)
    # A revisit names the record of its response.
    by_id = {(r.page_id, r.url): r for r in got}
    revisit = warc.page_record(3, "http://a/3", "c", 0, BIG.encode(), "d", (39, "http://a/39"))
    assert warc.parse(next(warc.members(io.BytesIO(revisit))))[0]["warc-refers-to"] == warc.record_id(39, "http://a/39", "c", 0)
    assert (39, "http://a/39") in by_id


def test_equal_input_gives_equal_files_however_it_is_dealt(spark):
    pages = pages_of(spark, [(i, f"http://a/{i}", f"{i} " * (i % 700)) for i in range(400)] + ROWS)
    hashes = [{(r["name"], r["sha256"]) for r in write_archive(df, shard_bytes=20_000, roll_bytes=4000)[1].collect()}
              for df in (pages.repartition(1), pages.repartition(7, "html"))]
    assert hashes[0] == hashes[1] and len(hashes[0]) > 5


def test_spoilt_and_uncommitted_archives_are_errors(spark):
    base, manifest = write_archive(pages_of(spark, ROWS[:5]))
    path = f"{base.removeprefix('file://')}/{manifest.first()['name']}"
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[:-9])
    with pytest.raises(Exception, match="ends inside a record|unpack|incomplete|invalid"):
        read_archive(spark, base).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_archive(spark, base + "-none").collect()


def test_empty_table_and_clashing_columns(spark):
    assert found(archived_pages(pages_of(spark, []))) == []
    clash = pages_of(spark, ROWS).select("*", *[F.lit(1).alias(c) for c in ("_id", "_shard", "copies", "payload", "weight", "_n")])
    assert found(archived_pages(clash)) == brute(ROWS)


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_dir}/pages.parquet')")
    rel = con.sql(ORACLES["op11_warc_archive"])
    got = QUERIES["op11_warc_archive"](spark, sf_dir)
    assert sorted(got.columns) == sorted(rel.columns)
    assert found(got) == sorted((tuple(r) for r in rel.select(*COLS).fetchall()), key=repr)
