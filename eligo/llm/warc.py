"""WARC archives: index first, then coalesced byte-range reads.

Writing: tasks stream their rows into archive files in the shared folder, one gzip member per record, and return one
index row per record: archive, offset, length, url and payload digest. The index is checkpointed, so each archive that
it names was written by a task that succeeded; files of failed attempts are in no index row. Reading: the selected
index rows are sorted by archive and offset, neighbouring ranges are joined into one read, and each record is cut out,
unpacked and checked against its digest.

Equal payloads are stored once: the least page_id of a payload is its ``response``, the others are ``revisit`` records
that name it. Copies are found by digest counts that are combined before the shuffle; pages travel once, by page_id.

Defined results: a null html is the empty payload; payloads under ``min_bytes`` are always responses; rows that
repeat one page_id and payload are all of the least id's type; a null page_id is always a response; a null url is kept
as null in the index and as the record's own URI in the archive; an empty table writes nothing and gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import checkpointed, file_system, fresh_dir, table, text_of

INDEX = "page_id long, url string, archive string, offset long, length long, digest string, record_type string, refers_to long"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_uri(page_id) -> str:
    return f"urn:x-page:{'none' if page_id is None else page_id}"


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit holds the HTTP header alone, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_uri(page_id)}>",
        f"WARC-Target-URI: {record_uri(page_id) if url is None else quote(url, safe='!#$%&()*+,/:;=?@[]~' + chr(39))}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_uri(refers_to)}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of an unpacked record: its header by name, and the payload and its declared length."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    out = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(out["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return out | {"payload": payload, "payload_bytes": declared}


def write(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = 256 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under ``folder``; the index, checkpointed."""
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), text_of(pages, "html").alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    named = rows.filter((F.octet_length("html") >= min_bytes) & F.col("page_id").isNotNull()).select("page_id", "sha")
    firsts = named.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("sha", "first")
    again = named.join(firsts, "sha").filter("page_id <> first").select("page_id", "sha", F.col("first").alias("refers_to")).distinct()
    rows = rows.join(again, ["page_id", "sha"], "left").select("page_id", "url", "html", "refers_to")

    def run(batches):
        fs, at = file_system(folder)
        fs.create_dir(at, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                made = []
                for k in range(0, batch.num_rows, 128):
                    for r in batch.slice(k, 128).to_pylist():
                        if out is None or offset >= archive_bytes:
                            if out is not None:
                                out.close()
                            name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                            out = fs.open_output_stream(f"{at}/{name}", compression=None)
                        payload = r["html"].encode()
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                        packed = pack.compress(record(r["page_id"], r["url"], payload, digest, r["refers_to"], date)) + pack.flush()
                        out.write(packed)
                        made.append((r["page_id"], r["url"], name, offset, len(packed), digest, "response" if r["refers_to"] is None else "revisit", r["refers_to"]))
                        offset += len(packed)
                types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                names = [x.split()[0] for x in INDEX.split(", ")]
                columns = list(zip(*made)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        finally:
            if out is not None:
                out.close()

    return checkpointed(rows.mapInArrow(run, INDEX))


def ranges(spans: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int, list[int]]]:
    """(start, stop, members) of joined reads over sorted (offset, length) spans."""
    out: list[tuple[int, int, list[int]]] = []
    for i, (offset, length) in enumerate(spans):
        if out and offset - out[-1][1] <= gap and offset + length - out[-1][0] <= most:
            start, stop, members = out[-1]
            members.append(i)
            out[-1] = (start, max(stop, offset + length), members)
        else:
            out.append((offset, offset + length, [i]))
    return out


def read(index: DataFrame, folder: str, payloads: bool = False, gap: int = 64 << 10, most: int = 4 << 20, task_bytes: int = 32 << 20) -> DataFrame:
    """The records that ``index`` (a written or checkpointed table) selects, parsed; with their ``payload`` if wanted.
    A record whose payload does not have its digest fails the task.

    A task reads neighbouring records of about ``task_bytes``; the number of tasks follows the selected bytes, not the
    index's own size, and a long archive is read by several."""
    rows = index.select("page_id", "url", "archive", "offset", "length")
    tasks = -(-(rows.agg(F.sum("length")).first()[0] or 0) // task_bytes)
    tasks = max(tasks, index.sparkSession.sparkContext.defaultParallelism)
    rows = rows.repartition(tasks, "archive", F.floor(F.col("offset") / task_bytes)).sortWithinPartitions("archive", "offset")

    def run(batches):
        fs, at = file_system(folder)
        for batch in batches:
            got, found = batch.to_pylist(), []
            i = 0
            while i < len(got):
                j = i
                while j < len(got) and got[j]["archive"] == got[i]["archive"]:
                    j += 1
                part = got[i:j]
                with fs.open_input_file(f"{at}/{part[0]['archive']}") as f:
                    for start, stop, members in ranges([(r["offset"], r["length"]) for r in part], gap, most):
                        data = f.read_at(stop - start, start)
                        for m in members:
                            r = part[m]
                            cut = data[r["offset"] - start : r["offset"] - start + r["length"]]
                            x = parse(zlib.decompress(cut, 31))
                            digest = x["WARC-Payload-Digest"].removeprefix("sha1:")
                            if x["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(x["payload"]).digest()).decode() != digest:
                                raise ValueError(f"damaged record at {r['offset']} of {r['archive']}")
                            to = x.get("WARC-Refers-To")
                            number = lambda uri: None if uri.endswith(":none>") else int(uri.rstrip(">").rpartition(":")[2])
                            row = (number(x["WARC-Record-ID"]), r["url"], x["payload_bytes"], digest, x["WARC-Type"], number(to) if to else None)
                            found.append((*row, x["payload"].decode()) if payloads else row)
                i = j
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *([pa.string()] * payloads)]
            names = [x.split()[0] for x in READ.split(", ")] + ["payload"] * payloads
            columns = list(zip(*found)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return rows.mapInArrow(run, READ + ", payload string" * payloads)


def op3_warc(spark, sf_dir) -> DataFrame:
    folder = fresh_dir(spark, "warc")
    index = write(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return read(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
