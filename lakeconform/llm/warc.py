"""Operator 8: pages as WARC archives, written in deterministic shards and read back.

Records are put in order of page id (null ids first, then the row's position). The compressed
size of every record is summed along that order over the whole table, and a new file begins
whenever the sum passes a multiple of the roll size. So the files and what is in them depend on
the pages alone, not on the cluster. Record ids, digests and lengths are made anew from the
content. Of records with equal payloads of at least 100 bytes one is a response, the others are
revisits without the payload.

The archives are written by Spark into a temporary folder beside the root, one file per task, and
get their names there, and a manifest with size and digest of every file; then the folder is
renamed to the root. So a run that ended early leaves no root and does not stand in the way of
the next one; a root that holds anything is not written to. Readers follow the manifest only.

Null html is an empty payload. Control characters in URLs are escaped. Pages without rows give
a manifest without files. Rows that repeat a page id are records of their own. A record is held
whole by a task; a file is read by one task and is about as large as the roll size, compressed.
Extra columns are unused. The table must be stored, as it is read by row position.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeconform.llm.common import narrow, numbered, placed, scratch_path, slices, stored
from lakeconform.operators.joins import enrich

ROLL_BYTES = 8_000_000
LEAST_REVISIT = 100
# Renames under way at once; a file store answers many at a time.
RENAMES = 16
DATE = "2024-02-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def escaped(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    name = hashlib.sha256(f"{page_id}\n{url}\n{digest}".encode()).hexdigest()[:32]
    return f"<urn:uuid:{uuid.UUID(name)}>"


def record(page: dict, date: str) -> str:
    """A whole record without its end, from a page's fields."""
    payload = page["html"] or ""
    raw = payload.encode()
    digest = hashlib.sha256(raw).hexdigest()
    revisit = page["first_digest"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}{END}"
    block = http if revisit else http + payload
    block_raw = block.encode()
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page['page_id'], page['url'], digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block_raw).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if page["page_id"] is not None:
        fields.append(f"X-Page-ID: {page['page_id']}")
    if page["url"] is not None:
        fields.append(f"WARC-Target-URI: {escaped(page['url'])}")
    if revisit:
        fields.append(f"WARC-Profile: {PROFILE}")
        fields.append(f"WARC-Refers-To: {record_id(page['first_id'], page['first_url'], digest)}")
        fields.append(f"X-Refers-To-Page-ID: {page['first_id']}")
    fields.append(f"Content-Length: {len(block_raw)}")
    return "\r\n".join(fields) + END + block


def positioned(pages: DataFrame) -> DataFrame:
    return placed(pages.select("page_id", "url", "html"))


def revisits(pages: DataFrame) -> DataFrame:
    """Rows that repeat the payload of an earlier page, with that page's id and URL."""
    payload = F.coalesce("html", F.lit(""))
    known = pages.filter(F.octet_length(payload) >= LEAST_REVISIT).select(
        "_row",
        F.sha2(payload, 256).alias("digest"),
        F.struct(F.col("page_id").isNull().alias("none"), "page_id", "_row", "url").alias("page"),
    )
    first = known.groupBy("digest").agg(F.min("page").alias("first"))
    joined = enrich(known.select("_row", "digest"), first, ["digest"])
    return joined.filter("_row <> first._row").select(
        "_row",
        F.col("digest").alias("first_digest"),
        F.col("first.page_id").alias("first_id"),
        F.col("first.url").alias("first_url"),
    )


def _records(date: str, sizes_only: bool, bounds: list[tuple]):
    """Turn pages into records; with ``bounds`` into their file's number and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("html")):
                part = batch.slice(a, b - a)
                texts = [record(p, date) for p in part.to_pylist()]
                ids, rows = part.column("page_id"), part.column("_row")
                if sizes_only:
                    made = pa.array([len(zlib.compress(t.encode())) for t in texts], pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, rows, made], names=["page_id", "_row", "size"])
                    continue
                keys = zip(ids.to_pylist(), rows.to_pylist(), strict=True)
                files = [bisect_right(bounds, _key(i, r)) - 1 for i, r in keys]
                yield pa.RecordBatch.from_arrays(
                    [ids, rows, pa.array(files, pa.int32()), pa.array(texts, pa.string())],
                    names=["page_id", "_row", "file", "record"],
                )

    return run


def _key(page_id: int | None, row: int) -> tuple:
    return (page_id is not None, page_id or 0, row)


def file_bounds(sizes: DataFrame, roll_bytes: int) -> list[tuple]:
    """The first record's place of every file, from running sums of compressed sizes.

    Sums run inside each range of the order; one total per range and one row per file reach
    the driver.
    """
    rows, _ = numbered(sizes, ["page_id", "_row"], ["page_id", "_row", "size"], "warc-order")
    rows = stored(
        rows.withColumn("run", F.expr("sum(size) OVER (PARTITION BY _part ORDER BY _local)")), "warc-sums"
    )
    totals = rows.groupBy("_part").agg(F.max("run").alias("size")).collect()
    before, total = {}, 0
    for part, size in sorted((r[0], r[1]) for r in totals):
        before[part] = total
        total += size
    if not before:
        return []
    spark = rows.sparkSession
    offsets = spark.createDataFrame(sorted(before.items()), "_part int, before bigint")
    file = F.expr(f"CAST((before + run - size) div {roll_bytes} AS INT)").alias("file")
    firsts = (
        rows.join(offsets, "_part")
        .select(file, F.struct(F.col("page_id").isNotNull().alias("has"), F.coalesce("page_id", F.lit(0)).alias("id"), "_row").alias("first"))
        .groupBy("file")
        .agg(F.min("first").alias("first"))
        .select("first.*")
        .collect()
    )
    return sorted(tuple(r) for r in firsts)


def write_archives(pages: DataFrame, root: str, roll_bytes: int = ROLL_BYTES, date: str = DATE) -> str:
    """Write all pages under ``root`` and return the path of the manifest."""
    spark = pages.sparkSession
    jvm, run = spark._jvm, uuid.uuid4().hex
    path = jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    root = root.rstrip("/")
    temporary = f"{root}-writing-{run}"
    if store.exists(path(root)) and not (len(store.listStatus(path(root))) == 0 and store.delete(path(root), False)):
        raise FileExistsError(f"{root} holds something already")
    rows = positioned(pages)
    repeats = stored(revisits(rows), "warc-revisits")
    full = rows.join(narrow(repeats), "_row", "left")
    sizes = full.mapInArrow(_records(date, True, []), "page_id bigint, _row bigint, size bigint")
    # Written once: the range exchange reads its input twice, to find the ranges and to deal the rows.
    bounds = file_bounds(stored(sizes, "warc-sizes"), roll_bytes)
    if bounds:
        shaped = full.mapInArrow(
            _records(date, False, bounds), "page_id bigint, _row bigint, file int, record string"
        )
        (
            shaped.repartitionById(len(bounds), "file")
            .sortWithinPartitions("file", "page_id", "_row")
            .select("file", "record")
            .write.partitionBy("file")
            .option("lineSep", END)
            .option("compression", "gzip")
            .text(f"{temporary}/files")
        )
        _name_archives(store, path, f"{temporary}/files", temporary)
        store.delete(path(f"{temporary}/files"), True)
        found = spark.read.format("binaryFile").load(f"{temporary}/pages-*.warc.gz")
        listed = found.select(
            F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.sha2("content", 256).alias("sha256")
        )
    else:
        listed = spark.createDataFrame([], "name string, length bigint, sha256 string")
    listed.write.parquet(f"{temporary}/manifest")
    if store.exists(path(root)) or not store.rename(path(temporary), path(root)):
        raise OSError(f"could not name {root}; what was written is in {temporary}")
    return f"{root}/manifest"


def _name_archives(store, path, written: str, folder: str) -> None:
    """Give every written shard its name in ``folder``; one listing, renames side by side."""
    files, found = store.listFiles(path(written), True), []
    while files.hasNext():
        at = files.next().getPath()
        if at.getName().startswith("part-"):
            found.append((int(at.getParent().getName().removeprefix("file=")), at))

    def rename(shard: tuple) -> None:
        number, at = shard
        if not store.rename(at, path(f"{folder}/pages-{number:06d}.warc.gz")):
            raise OSError(f"could not name archive {number} in {folder}")

    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(rename, found))


FIELDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, intact boolean"


def parsed(raw: bytes) -> Iterator[tuple]:
    """The records of an uncompressed archive; payload figures of a response are made anew."""
    at = 0
    while at < len(raw):
        head_end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:head_end].decode().split("\r\n")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start = head_end + 4
        block = raw[start : start + int(head["Content-Length"])]
        at = start + len(block) + len(END)
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        intact = hashlib.sha256(block).hexdigest() == head["WARC-Block-Digest"].removeprefix("sha256:")
        if head["WARC-Type"] == "response":
            found = hashlib.sha256(payload).hexdigest()
            intact = intact and found == digest and len(payload) == length
            digest, length = found, len(payload)
        page, other = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID", "None")
        yield (
            int(page) if page is not None else None,
            head.get("WARC-Target-URI"),
            length,
            digest,
            head["WARC-Type"],
            int(other) if other != "None" else None,
            intact,
        )


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    """One row per record of the files that the manifest names; their digests are checked."""
    manifest = spark.read.parquet(f"{root}/manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in FIELDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
        for batch in batches:
            for content in batch.column("content"):
                raw = zlib.decompress(content.as_buffer(), wbits=31)
                rows = list(zip(*parsed(raw), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names
                )

    files = spark.read.format("binaryFile").load(f"{root}/pages-*.warc.gz")
    name = F.element_at(F.split("path", "/"), -1)
    listed = files.join(
        manifest.withColumnRenamed("length", "listed"),
        (name == F.col("name")) & (F.col("length") == F.col("listed")) & (F.sha2("content", 256) == F.col("sha256")),
        "left_semi",
    )
    if listed.count() != manifest.count():
        raise OSError(f"archives under {root} are missing or differ from the manifest")
    return listed.select("content").mapInArrow(run, FIELDS)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and give back what these hold."""
    root = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, root)
    return read_archives(pages.sparkSession, root).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )
