"""Registry records over HTTP, as a Spark data source: a reader over a table of ids, and a writer with commit and abort.

Reading: the ids are a Parquet table, a partition per file of it. Each id is one request; a busy or failing server is
asked again a few times, and while one id waits, a task asks for others. What is not answered with 200 is a row with its
status and an error, never the end of the job. Without a network, a handler of http.server may answer inside the tasks.
Writing: each task writes its records, one to a line, to a hidden file of its own; only the job's commit gives these files
their names, and an abort removes them, so a lost task or a failed job leaves nothing that readers see."""

from __future__ import annotations

import http.client
import io
import json
import pkgutil
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections import deque
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from eligo.sources.shared import file_system, fresh_dir

FORMAT = "registry_records"
SCHEMA = "id string, status int, attempts int, body string, error string"
#: Answers of a server that may do better if asked again (fixed values).
BUSY = (408, 429, 500, 502, 503, 504)


class Exchange:
    """What http.client and http.server use of a socket, for one request that ``handler`` answers in this process."""

    def __init__(self, handler=None, received: bytes = b""):
        self.handler, self.received, self.sent = handler, received, bytearray()

    def sendall(self, data) -> None:
        self.sent += data

    def makefile(self, *_) -> io.BytesIO:
        if self.handler:
            far = Exchange(received=bytes(self.sent))
            self.handler(far, ("", 0), None)
            self.received = bytes(far.sent)
        return io.BytesIO(self.received)

    def close(self) -> None:
        pass


def opener(handler):
    """``urlopen`` with requests answered by a handler class of http.server: HTTP on both sides, but no connection."""

    class Connection(http.client.HTTPConnection):
        def connect(self):
            self.sock = Exchange(handler)

    class Answered(urllib.request.HTTPHandler):
        def http_open(self, request):
            return self.do_open(Connection, request)

    return urllib.request.build_opener(urllib.request.ProxyHandler({}), Answered).open


def fetch(url: str, attempts: int = 3, seconds: float = 30.0, wait: float = 0.5, ask=urllib.request.urlopen) -> tuple[int | None, int, str | None, str | None]:
    """(status, attempts made, body, error) of a GET request. Waits double from one attempt to the next."""
    status, error = None, None
    for k in range(1, attempts + 1):
        try:
            with ask(url, timeout=seconds) as answer:
                status, body = answer.status, answer.read().decode("utf-8")
            if status == 200:
                json.loads(body)
                return status, k, body, None
            return status, k, None, f"status {status}"
        except urllib.error.HTTPError as e:
            status, error = e.code, f"status {e.code}"
            e.close()
            if e.code not in BUSY:
                return status, k, None, error
        except (OSError, TimeoutError) as e:
            status, error = None, f"no answer: {getattr(e, 'reason', e)}"
        except ValueError:
            return status, k, None, "the answer is no JSON"
        if k < attempts:
            time.sleep(wait * 2 ** (k - 1))
    return status, attempts, None, error


@dataclass
class IdsFile(InputPartition):
    path: str


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[IdsFile]:
        from pyarrow import fs

        files, at = file_system(self.options["ids"])
        found = files.get_file_info(fs.FileSelector(at, recursive=True))
        return [IdsFile(f.path) for f in found if f.is_file and f.base_name.endswith(".parquet")]

    def read(self, partition: IdsFile):
        import pyarrow.parquet as pq

        files, _ = file_system(self.options["ids"])
        attempts, seconds, wait = int(self.options.get("attempts", 3)), float(self.options.get("seconds", 30)), float(self.options.get("wait", 0.5))
        handler, at_once = self.options.get("handler"), int(self.options.get("at_once", 4))
        ask = opener(pkgutil.resolve_name(handler)) if handler else urllib.request.urlopen

        def record(id_: str | None) -> tuple:
            if id_ is None:
                return None, None, 0, None, "no id"
            return id_, *fetch(self.options["url"].replace("{id}", urllib.parse.quote(id_, safe="")), attempts, seconds, wait, ask)

        with files.open_input_file(partition.path) as f, ThreadPoolExecutor(at_once) as pool:
            asked: deque = deque()
            for batch in pq.ParquetFile(f).iter_batches(batch_size=1_000, columns=["id"]):
                for id_ in batch.column(0).to_pylist():
                    asked.append(pool.submit(record, id_))
                    if len(asked) == 8 * at_once:
                        yield asked.popleft().result()
            while asked:
                yield asked.popleft().result()


@dataclass
class Written(WriterCommitMessage):
    hidden: str
    shown: str
    rows: int


class RecordWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.at = options["path"]
        if overwrite:
            raise ValueError("records are only appended")

    def write(self, rows) -> Written:
        from pyspark import TaskContext

        files, at = file_system(self.at)
        files.create_dir(at, recursive=True)
        name = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        hidden, n = f"{at}/.{name}", 0
        try:
            with files.open_output_stream(hidden) as out:
                for row in rows:
                    if row["body"] is not None:
                        out.write((json.dumps(json.loads(row["body"]), ensure_ascii=False) + "\n").encode())
                        n += 1
        except BaseException:
            files.delete_file(hidden)
            raise
        return Written(hidden, f"{at}/{name}.jsonl", n)

    def commit(self, messages: list[Written | None]) -> None:
        files, at = file_system(self.at)
        for m in messages:
            if m is not None and m.rows:
                files.move(m.hidden, m.shown)
            elif m is not None:
                files.delete_file(m.hidden)
        with files.open_output_stream(f"{at}/_SUCCESS") as out:
            out.write(b"")

    def abort(self, messages: list[Written | None]) -> None:
        files, _ = file_system(self.at)
        for m in messages:
            if m is not None:
                files.delete_file(m.hidden)


class RecordSource(DataSource):
    """Options: ``ids`` (a Parquet table with an ``id`` column), ``url`` (with {id}), ``attempts``, ``seconds``, ``wait``,
    ``at_once`` (requests of a task that are under way together), ``handler`` ("module:class" of a handler of http.server
    that answers in the tasks, in place of the network); for writing ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RecordReader:
        return RecordReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(dict(self.options), overwrite)


def fetched(ids: DataFrame, url: str, tasks: int = 4, most: int = 20_000, **options) -> DataFrame:
    """id, status, attempts, body, error: the record of each distinct id (a column ``id``), asked for by ``tasks`` tasks, or
    by more if a task had more than ``most`` ids."""
    spark = ids.sparkSession
    spark.dataSource.register(RecordSource)
    at = fresh_dir(spark, "ids")
    ids.select(ids["id"].cast("string").alias("id")).distinct().repartition(tasks).write.option("maxRecordsPerFile", most).parquet(at)
    return spark.read.format(FORMAT).options(ids=at, url=url, **{k: str(v) for k, v in options.items()}).load()


def save(records: DataFrame, path: str) -> None:
    """Bodies of fetched records, one to a line, in files below ``path``; rows without a body are left out."""
    records.sparkSession.dataSource.register(RecordSource)
    records.write.format(FORMAT).mode("append").option("path", path).save()
