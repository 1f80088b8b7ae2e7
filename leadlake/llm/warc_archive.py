"""A deterministic sharded writer of WARC archives, and their reader, as Spark jobs.

Records stand in the order of (page id, hash of the address, hash of the payload). Sums
of their sizes in that order, found by ranges and offsets, cut them into shards; so the
shards depend on the rows alone, not on how Spark dealt them. At most ``most_shards``
bounds go to every task, which finds a record's shard by binary search. Texts move
once, to their shard, where they are sorted behind the small row that says how their
record is to be written. A task writes a shard as a sequence of gzip files, a member
per record with newly made headers and digests, and starts a new file once
``roll_bytes`` are reached; equal input gives equal files, byte by byte.

Files get temporary names with the attempt's number. The rows naming them are committed
by Spark for one attempt of each task only; a second job renames just those files, which
may be repeated, and the table it writes is the manifest: an archive without one isn't
complete. Readers open the manifest's files only. Files lie under the shared folder.

Of records with equal payloads of ``revisit_from`` bytes or more, that of the largest
page id is the response, all others are revisits of it.

Defined results: a null html is an empty payload; a null page id is below all others and
stays null; of rows equal in id and payload the one with the largest address, or of
equal rows any one, is the response; an address that can't stand in a header line is
escaped, a null one replaced by the page id; an empty table gives an archive without
files; further columns of the input play no part. Equal rows share a shard, where they
are streamed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm import warc
from leadlake.llm.common import ship_code, whole_text, written
from leadlake.llm.ranks import ranked
from leadlake.session import checkpoint_dir

_HEADERS = 700  # about the bytes of a record besides its payload
_FILES = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("shard", pa.int64()), ("records", pa.int64()),
                    ("bytes", pa.int64()), ("sha256", pa.string())])
_FILES_DDL = "name string, temporary string, shard long, records long, bytes long, sha256 string"
_PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
_PAGES_DDL = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "payload binary")
_KEY = ["_id", "_place", "_content"]


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    html = whole_text(html_col)
    return pages.select(F.col(id_col).cast("long").alias("_id"), F.md5(whole_text(url_col)).alias("_place"),
                        F.sha2(html.cast("binary"), 256).alias("_content"), F.col(url_col).cast("string").alias("_url"),
                        F.octet_length(html).cast("long").alias("_size"), html.alias("_html"))


def record_plan(narrow: DataFrame, revisit_from: int) -> DataFrame:
    """Per distinct key: copies, responses (how many of the copies are responses), to (what the others revisit), weight."""
    per_key = narrow.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("copies"), F.max("_size").alias("_size"), F.max("_url").alias("_url"))
    repeated = (narrow.where(F.col("_size") >= revisit_from).groupBy("_content")
                .agg(F.max(F.struct("_id", "_place", "_url")).alias("to"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    first = F.struct("_id", "_place") == F.struct("to._id", "to._place")
    responses = F.when(F.col("to").isNull(), F.col("copies")).when(first, F.lit(1)).otherwise(F.lit(0)).cast("long")
    plan = per_key.join(repeated.drop("_n"), "_content", "left").withColumn("responses", responses)
    weight = F.col("copies") * _HEADERS + F.col("responses") * F.col("_size")
    return plan.select(*_KEY, "copies", "responses", F.struct("to._id", "to._url").alias("to"), weight.alias("weight"))


def shard_of(key: Column, bounds: Column, most_shards: int) -> Column:
    """The number of the last bound that is not above the key, by binary search."""
    steps = [1 << k for k in reversed(range(max(1, (most_shards - 1).bit_length())))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(bounds, at + step) <= key, F.lit(False)), at + step).otherwise(at))


class _Writer:
    """The files of one task; a file is opened for its first record and closed when it is full or its shard ends."""

    def __init__(self, base: str, roll_bytes: int, date: str):
        self.fs, self.root = pafs.FileSystem.from_uri(base)
        self.roll, self.date, self.attempt = roll_bytes, date, f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
        self.shard, self.number, self.file, self.done = None, 0, None, []

    def add(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.number = shard, 0
        if self.file is None:
            self.name = f"part-{shard:05d}-{self.number:05d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}-{self.name}"
            self.file, self.sha, self.bytes, self.records = self.fs.open_output_stream(
                f"{self.root}/{self.temporary}", compression=None), hashlib.sha256(), 0, 0
            self._put(warc.info_record(self.name, self.date))
        self._put(record)
        self.records += 1
        if self.bytes >= self.roll:
            self.close()

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.name, self.temporary, self.shard, self.records, self.bytes, self.sha.hexdigest()))
            self.file, self.number = None, self.number + 1


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def write_archive(pages: DataFrame, base: str | None = None, shard_bytes: int = 32 << 20, roll_bytes: int = 32 << 20,
                  most_shards: int = 8192, revisit_from: int = 1000, date: str = "2024-01-01T00:00:00Z",
                  id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[str, DataFrame]:
    """Writes the archive to a new folder ``base``; returns it and the manifest (a row per file).

    A shard has about ``shard_bytes`` of records, or more if there would be over ``most_shards`` of them."""
    spark = pages.sparkSession
    ship_code(spark)
    base = base or f"{checkpoint_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
    rows = _keyed(pages, id_col, url_col, html_col)
    plan = written(record_plan(written(rows.drop("_html"), "warc-pages"), revisit_from), "warc-plan")
    total = plan.agg(F.sum("weight")).first()[0] or 0
    size = max(shard_bytes, -(-total // most_shards))
    placed = ranked(plan, [], _KEY, "_at", {"_before": "weight"}, kind="warc-order")
    starts = placed.groupBy(F.expr(f"_before div {size}L").alias("n")).agg(F.min(F.struct(*_KEY)).alias("first"))
    starts = written(starts, "warc-shards")  # at most most_shards + 1 rows of fixed size
    bounds = starts.agg(F.sort_array(F.collect_list("first"))).scalar()

    def sharded(df: DataFrame) -> DataFrame:
        out = df.withColumn("_bounds", bounds).withColumn("_key", F.struct(*_KEY))
        return out.withColumn("_shard", shard_of(F.col("_key"), F.col("_bounds"), most_shards + 1)).drop("_bounds", "_key")

    notes = sharded(plan).select("_shard", *_KEY, F.lit(0).alias("_kind"), "copies", "responses", F.col("to._id").alias("_to"),
                                 F.col("to._url").alias("_to_url"), F.lit(None).cast("string").alias("_url"),
                                 F.lit(None).cast("string").alias("_html"))
    texts = sharded(rows).select("_shard", *_KEY, F.lit(1).alias("_kind"), *[
        F.lit(None).cast(t).alias(c) for c, t in (("copies", "long"), ("responses", "long"), ("_to", "long"), ("_to_url", "string"))],
        "_url", "_html")
    both = (notes.unionByName(texts).repartition(max(1, starts.count()), "_shard")
            .sortWithinPartitions("_shard", *_KEY, "_kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, copy, copies = None, None, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for (shard, page, place, content, kind, n, responses, to, to_url, url, html) in zip(
                        *(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    out = out or _Writer(base, roll_bytes, date)
                    if kind == 0:
                        if copy != copies:
                            raise ValueError("the pages changed while they were archived")
                        key, copy, copies, as_responses, refers = (page, place, content), 0, n, responses, (to, to_url)
                        continue
                    if key != (page, place, content):
                        raise ValueError("the pages changed while they were archived")
                    out.add(shard, warc.page_record(page, url, content, copy, html.encode("utf-8", "surrogatepass"), date,
                                                    None if copy < as_responses else refers))
                    copy += 1
        if copy != copies:
            raise ValueError("the pages changed while they were archived")
        if out is not None:
            out.close()
            yield _batch(out.done, _FILES)

    files = written(both.mapInArrow(run, _FILES_DDL), "warc-files")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(base)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist()):
                # A repeated attempt finds the file renamed already.
                if store.get_file_info(f"{root}/{temporary}").type == pafs.FileType.File:
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
                elif store.get_file_info(f"{root}/{name}").type != pafs.FileType.File:
                    raise FileNotFoundError(f"{root}/{temporary}")
            yield batch

    named = files.repartition("name").mapInArrow(commit, _FILES_DDL).drop("temporary")
    named.write.parquet(f"{base}/manifest")
    store, root = pafs.FileSystem.from_uri(base)
    if store.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
        store.delete_dir(f"{root}/_temporary")  # what lost attempts left
    return base, spark.read.schema(named.schema).parquet(f"{base}/manifest")


def read_archive(spark: SparkSession, base: str) -> DataFrame:
    """A row per page record of the manifest's files: page_id, url, payload_bytes, payload_digest (of the full payload),
    record_type, refers_to, payload (null for revisits). Lengths and digests are checked."""
    ship_code(spark)
    files = spark.read.schema("name string, shard long, records long, bytes long, sha256 string").parquet(f"{base}/manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(base)
        for batch in batches:
            for name, want in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist()):
                rows, size, n = [], 0, 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in warc.members(stream):
                        headers, block = warc.parse(record)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        rows.append(warc.page_of(headers, block))
                        size, n = size + len(block), n + 1
                        if size > 4 << 20:
                            yield _batch(rows, _PAGES)
                            rows, size = [], 0
                if n != want:
                    raise ValueError(f"{name} has {n} records, not {want}")
                yield _batch(rows, _PAGES)

    return files.select("name", "records").repartition("name").mapInArrow(run, _PAGES_DDL)


def archived_pages(pages: DataFrame, **options) -> DataFrame:
    """The pages as their archive gives them back, without payloads."""
    base, _ = write_archive(pages, **options)
    return read_archive(pages.sparkSession, base).drop("payload")
