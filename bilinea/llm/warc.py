"""WARC archives, index first.

Writing: each task writes one archive of gzip members, a record each, and returns one index row per record: file,
offset, length, URL, digest. Reading: records are selected in the index; their byte ranges are sorted by file and
offset, neighbouring ranges are joined into one read, and the records are cut out of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bilinea.functions.storage import new_path
from bilinea.llm.common import store

INDEX = "file string, offset long, length long, record_id string, record_type string, url string, payload_digest string, page_id {id}, refers_to {id}, refers_to_id string, payload_bytes long"
#: All records carry one fixed date, so that reruns write equal archives.
DATE = "2000-01-01T00:00:00Z"
#: Ranges with at most so many bytes between them are one read, of at most so many bytes unless one record is longer.
GAP, MOST_AT_ONCE = 64 << 10, 8 << 20
#: An index block: records that start within so many bytes of a file are read by one task, and a task reads about so many.
BLOCK = 8 << 20


def base32(hexdigest: str) -> str:
    return base64.b32encode(bytes.fromhex(hexdigest)).decode()


def record_id(page: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest}')}>"


def header_value(text: str | None) -> str:
    """Without the line breaks that would end a header."""
    return " ".join((text or "").split())


def record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, refers_url: str | None) -> tuple[str, bytes]:
    """The record's id and bytes. A revisit has no payload: it names the digest and the record that has it."""
    own = record_id(str(page_id), digest)
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {own}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {header_value(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(str(refers_to), digest)}", f"WARC-Refers-To-Target-URI: {header_value(refers_url)}", f"WARC-Refers-To-Date: {DATE}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return own, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member with no time in its header."""
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def decide(pages: DataFrame, id_col: str, url_col: str, text_col: str, min_revisit_bytes: int) -> DataFrame:
    """pages with sha1 and, for each revisit, the page that is the response: of equal payloads the largest id.

    Only digests and ids are grouped; payloads move once, to their group's decision, in a join whose hot groups Spark
    can split.
    """
    payload = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("html"), F.sha1(payload).alias("sha1"))
    large = F.octet_length("html") >= min_revisit_bytes
    keys = store(given.where(large).select("page_id", "url", "sha1"), "warc-keys")
    best = F.max(F.struct("page_id", "url")).alias("best")
    groups = keys.groupBy("sha1").agg(best, F.count(F.lit(1)).alias("n")).where("n > 1").select("sha1", F.col("best.page_id").alias("first_id"), F.col("best.url").alias("first_url"))
    joined = given.join(store(groups, "warc-groups"), "sha1", "left")
    other = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & large
    return joined.select("page_id", "url", "html", "sha1", F.when(other, F.col("first_id")).alias("refers_to"), F.when(other, F.col("first_url")).alias("refers_url"))


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """Writes one record per page and returns the index, stored, one row per record.

    Payloads are the pages' text in UTF-8, a null text the empty payload. Of equal payloads of at least
    min_revisit_bytes the page with the largest id is a response and the others revisit it; a null id is smaller than
    any, and rows that repeat the largest id are all responses. A retried task writes a new file; the index names the
    file of the attempt that counted. Archives go to the shared folder through pyarrow's file systems.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    decided = decide(pages, id_col, url_col, text_col, min_revisit_bytes)
    schema = INDEX.format(id=decided.schema["page_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        system.create_dir(path, recursive=True)
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        with system.open_output_stream(f"{path}/{name}", compression=None) as out:
            at = 0
            for batch in batches:
                rows = []
                for page_id, url, html, sha1, refers_to, refers_url in zip(*(c.to_pylist() for c in batch.columns)):
                    payload, digest = html.encode(), base32(sha1)
                    own, data = record(page_id, url, payload, digest, refers_to, refers_url)
                    packed = member(data)
                    out.write(packed)
                    revisit = refers_to is not None
                    rows.append((name, at, len(packed), own, "revisit" if revisit else "response", url, digest, page_id, refers_to, record_id(str(refers_to), digest) if revisit else None, None if revisit else len(payload)))
                    at += len(packed)
                yield columns(rows, schema_of)

    schema_of = spark.createDataFrame([], schema).schema
    index = decided.mapInArrow(run, schema)
    return store(index.withColumn("folder", F.lit(folder)), "warc-index")


def columns(rows: list[tuple], schema) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(target)], schema=target)


def ranges(offsets: list[int], lengths: list[int]) -> Iterator[tuple[int, int, list[int]]]:
    """Sorted ranges joined into reads: start, end and the ranges' numbers."""
    start = end = None
    held: list[int] = []
    for i, (offset, length) in enumerate(zip(offsets, lengths)):
        if held and (offset - end > GAP or offset + length - start > MOST_AT_ONCE):
            yield start, end, held
            held = []
        if not held:
            start = end = offset
        held.append(i)
        end = max(end, offset + length)
    if held:
        yield start, end, held


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers and payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def read(selected: DataFrame, with_text: bool = True) -> DataFrame:
    """The selected index rows' records: page_id, url, record_type, record_id, payload_digest, refers_to_id, refers_to,
    payload_bytes and html, both null for revisits. A payload that does not have its record's digest is an error."""
    keys = ["folder", "file", F.floor(F.col("offset") / BLOCK).alias("block")]
    wanted = selected.select("folder", "file", "offset", "length", "page_id", "refers_to", keys[2])
    # index rows are small, so Spark would merge their partitions: the number goes by the bytes that are to be read
    blocks, total = selected.agg(F.count_distinct("folder", "file", keys[2]), F.sum("length")).first()
    tasks = max(1, min(blocks, max(selected.sparkSession.sparkContext.defaultParallelism, -(-(total or 0) // BLOCK))))
    wanted = wanted.repartition(tasks, "folder", "file", "block").sortWithinPartitions("folder", "file", "offset").drop("block")
    id_type = selected.schema["page_id"].dataType.simpleString()
    schema = f"page_id {id_type}, url string, record_type string, record_id string, payload_digest string, refers_to_id string, refers_to {id_type}, payload_bytes long, html string"
    schema_of = selected.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for batch in batches:
            folder, file, offsets, lengths, ids, refers = (c.to_pylist() for c in batch.columns)
            runs: list[tuple[int, int]] = []
            for i in range(len(file)):
                if runs and (folder[i], file[i]) == (folder[runs[-1][0]], file[runs[-1][0]]):
                    runs[-1] = (runs[-1][0], i + 1)
                else:
                    runs.append((i, i + 1))
            for a, b in runs:
                if (folder[a], file[a]) != name:
                    if handle:
                        handle.close()
                    name = (folder[a], file[a])
                    system, path = fs.FileSystem.from_uri(folder[a] if "://" in folder[a] or folder[a].startswith("file:") else f"file://{folder[a]}")
                    handle = system.open_input_file(f"{path}/{file[a]}")
                for start, end, held in ranges(offsets[a:b], lengths[a:b]):
                    chunk = handle.read_at(end - start, start)
                    rows = []
                    for i in (a + h for h in held):
                        at = offsets[i] - start
                        headers, payload = parse(zlib.decompress(chunk[at : at + lengths[i]], 31))
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = headers["WARC-Type"] == "revisit"
                        if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{name}, {offsets[i]}: the payload does not have its digest")
                        rows.append((ids[i], headers["WARC-Target-URI"], headers["WARC-Type"], headers["WARC-Record-ID"], digest, headers.get("WARC-Refers-To"), refers[i], None if revisit else len(payload), payload.decode() if with_text and not revisit else None))
                    yield columns(rows, schema_of)
        if handle:
            handle.close()

    return wanted.mapInArrow(run, schema)


def resolve(records: DataFrame) -> DataFrame:
    """Revisits get payload_bytes of the response that they refer to; store records first, they are read twice."""
    responses = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("of")).agg(F.max("payload_bytes").alias("of_bytes"))
    used = records.where("record_type = 'revisit'").select(F.col("refers_to_id").alias("of")).distinct()
    found = store(responses.join(used, "of", "left_semi"), "warc-responses")
    return records.join(found, F.col("refers_to_id") == F.col("of"), "left").withColumn("payload_bytes", F.coalesce("payload_bytes", "of_bytes")).drop("of", "of_bytes")
