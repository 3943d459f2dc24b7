"""Model calls as a replayable stage.

A call is a prompt row keyed by the digest of model, system and user text. Known answers come from a cache table and
from the store of earlier answers; only what both lack is asked, once per prompt. A client runs in a process of its own
beside each task, so a call past its deadline is ended, not waited for.

The store is a folder. A task writes the answers of a few prompts at a time to a hidden file and then gives it its name:
a file that has a name is committed, and all of these are the store. A task that is run again reads what its partition
has committed before and asks only the rest. An answer stays as it was first given; a call without one (late, failed) is
noted with its error and asked again by the next run, and never hides an answer. Without a client a stage only replays."""

from __future__ import annotations

import multiprocessing
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.sources.shared import checkpointed, file_system

Client = Callable[[str, str], str]
STORED = "prompt_sha string, response string, error string, at long"
VECTORS = "text_sha string, vector array<double>"
#: Prompts whose answers are committed together.
COMMIT_PROMPTS = 16


def prompt_key(model: str, system: Column, user: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", F.lit(model), system, user), 256)


class Caller:
    """A client in a process of its own, with a deadline for each call. A call that misses it ends with its process; the
    next call gets a new one."""

    def __init__(self, client: Client, seconds: float):
        self.client, self.seconds, self.child, self.pipe = client, seconds, None, None

    def _serve(self, pipe) -> None:
        # the task's own connections stay the task's: if it dies, nothing here keeps them open
        os.closerange(3, pipe.fileno())
        os.closerange(pipe.fileno() + 1, os.sysconf("SC_OPEN_MAX"))
        while True:
            try:
                asked = pipe.recv()
            except EOFError:
                return
            try:
                pipe.send((self.client(*asked), None))
            except Exception as e:  # an answer like any other: the caller notes it
                pipe.send((None, f"failed: {e}"))

    def __call__(self, system: str, user: str) -> tuple[str | None, str | None]:
        """(response, error): one of them is null."""
        if self.child is None:
            context = multiprocessing.get_context("fork")
            self.pipe, other = context.Pipe()
            self.child = context.Process(target=self._serve, args=(other,), daemon=True)
            self.child.start()
            other.close()
        try:
            self.pipe.send((system, user))
            if self.pipe.poll(self.seconds):
                return self.pipe.recv()
            error = "late"
        except (EOFError, OSError):
            error = "failed: the client's process ended"
        self.cancel()
        return None, error

    def cancel(self) -> None:
        """Ends the process and whatever it is doing."""
        if self.child is not None:
            self.child.kill()
            self.child.join()
            self.pipe.close()
            self.child = self.pipe = None


@dataclass(frozen=True)
class Store:
    """Answers that clients have given, in a folder that driver and executors share."""

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        """Every committed row: prompt_sha, response, error, at."""
        from pyarrow import fs

        files, at = file_system(self.path)
        runs = files.get_file_info(fs.FileSelector(at, allow_not_found=True))
        if not any(r.type == fs.FileType.Directory for r in runs):
            return spark.createDataFrame([], STORED)
        return spark.read.schema(STORED).option("recursiveFileLookup", True).option("pathGlobFilter", "answers-*.parquet").parquet(self.path)

    def answers(self, spark: SparkSession) -> DataFrame:
        """prompt_sha, response: the first answer to each prompt; prompts without one are left out."""
        return self.read(spark).filter("response is not null").groupBy("prompt_sha").agg(F.min_by("response", F.struct("at", "response")).alias("response"))

    def compacted(self, spark: SparkSession) -> None:
        """Replaces the files of all runs by one table of the first answers. Not while a run is asking."""
        from pyarrow import fs

        files, at = file_system(self.path)
        old = [r.path for r in files.get_file_info(fs.FileSelector(at, allow_not_found=True)) if r.type == fs.FileType.Directory]
        if not old:
            return
        run = uuid.uuid4().hex
        first = self.read(spark).filter("response is not null").groupBy("prompt_sha").agg(F.min_by(F.struct("response", "error", "at"), F.struct("at", "response")).alias("x"))
        first.select("prompt_sha", "x.*").write.parquet(f"{self.path}/.{run}")
        found = files.get_file_info(fs.FileSelector(f"{at}/.{run}"))
        files.create_dir(f"{at}/run-{run}")
        for k, f in enumerate(x for x in found if x.base_name.endswith(".parquet")):
            files.move(f.path, f"{at}/run-{run}/answers-{k}.parquet")
        for path in old:
            files.delete_dir(path)
        files.delete_dir(f"{at}/.{run}")

    def fill(self, prompts: DataFrame, client: Client, tasks: int = 4, seconds: float = 60.0) -> None:
        """Asks each of ``prompts`` (prompt_sha, system, user; distinct), in at most ``tasks`` tasks at a time."""
        path, run = self.path, uuid.uuid4().hex

        def ask(frames):
            import pandas as pd
            import pyarrow as pa
            import pyarrow.parquet as pq
            from pyarrow import fs
            from pyspark import TaskContext

            context = TaskContext.get()
            files, at = file_system(path)
            own = f"{at}/run-{run}/{context.partitionId()}"
            done: set[str] = set()
            if context.attemptNumber():
                before = [f.path for f in files.get_file_info(fs.FileSelector(own, allow_not_found=True)) if f.base_name.startswith("answers-")]
                done = {sha for f in before for sha in pq.read_table(f, filesystem=files, columns=["prompt_sha"]).column(0).to_pylist()}
            files.create_dir(own, recursive=True)
            call, kinds = Caller(client, seconds), pa.schema([("prompt_sha", pa.string()), ("response", pa.string()), ("error", pa.string()), ("at", pa.int64())])
            try:
                for frame in frames:
                    left = [r for r in frame.itertuples(index=False) if r.prompt_sha not in done]
                    for k in range(0, len(left), COMMIT_PROMPTS):
                        rows = []
                        for r in left[k : k + COMMIT_PROMPTS]:
                            response, error = call(r.system, r.user)
                            rows.append({"prompt_sha": r.prompt_sha, "response": response, "error": error, "at": time.time_ns()})
                        name = f"{context.attemptNumber()}-{uuid.uuid4().hex}.parquet"
                        pq.write_table(pa.Table.from_pylist(rows, kinds), f"{own}/.{name}", filesystem=files)
                        files.move(f"{own}/.{name}", f"{own}/answers-{name}")
                    yield pd.DataFrame({"asked": [len(left)]})
            finally:
                call.cancel()

        # written first: if a task is run again, its prompts must be the same ones
        fixed = checkpointed(prompts.select("prompt_sha", "system", "user").repartition(tasks, "prompt_sha"))
        fixed.mapInPandas(ask, "asked long").agg(F.sum("asked")).collect()


def answered(rows: DataFrame, cache: DataFrame, model: str, system: Column, user: Column, client: Client | None = None, store: str | None = None, seconds: float = 60.0) -> DataFrame:
    """``rows`` with response, null for prompts that neither the cache, the store nor the client answers, and call_error,
    why the last call about such a prompt gave none. The cache's answers come before the store's; ``cache`` has each
    prompt once."""
    keyed = rows.withColumns({"prompt_sha": prompt_key(model, system, user), "system_": system, "user_": user})
    known = cache.select("prompt_sha", "response")
    if store is not None:
        spark, held = rows.sparkSession, Store(store)
        fresh = lambda: known.unionByName(held.answers(spark).join(known.select("prompt_sha"), "prompt_sha", "left_anti"))
        if client is not None:
            misses = keyed.select("prompt_sha", F.col("system_").alias("system"), F.col("user_").alias("user")).join(fresh(), "prompt_sha", "left_anti")
            held.fill(misses.dropDuplicates(["prompt_sha"]), client, seconds=seconds)
        failed = held.read(spark).filter("response is null").groupBy("prompt_sha").agg(F.max_by("error", "at").alias("call_error"))
        keyed, known = keyed.join(failed.hint("merge"), "prompt_sha", "left"), fresh()
    elif client is not None:
        raise ValueError("a client needs a folder for its answers")
    # a workflow's cache has as many rows as its prompts, and a size guessed from files makes it look small: never broadcast
    out = keyed.drop("system_", "user_").join(known.hint("merge"), "prompt_sha", "left")
    error = F.when(F.col("response").isNull(), F.col("call_error")) if store is not None else F.lit(None).cast("string")
    return out.withColumn("call_error", error)


def embedded(rows: DataFrame, cache: DataFrame, text: Column, client: Callable[[list[str]], list[list[float]]] | None = None, store: str | None = None) -> DataFrame:
    """``rows`` with vector: the embedding of ``text`` from ``cache`` (text_sha, vector) or the Parquet table ``store`` of
    earlier ones; null where there is none.

    With a client the texts that both lack are embedded a batch at a time, each distinct text once, and appended to the
    store, which is read back; a failed run appends nothing."""
    keyed = rows.withColumns({"text_sha": F.sha2(text.cast("binary"), 256), "text_": text})
    known = cache.select("text_sha", "vector").dropDuplicates(["text_sha"])
    if store is not None:
        from pyarrow import fs

        files, at = file_system(store)
        there = files.get_file_info(at).type == fs.FileType.Directory
        read = lambda: rows.sparkSession.read.schema(VECTORS).parquet(store).join(known.select("text_sha"), "text_sha", "left_anti").dropDuplicates(["text_sha"])
        if client is not None:

            def run(frames):
                for f in frames:
                    yield f[["text_sha"]].assign(vector=client(f["text_"].tolist()))

            misses = keyed.filter("text_sha is not null").join(known.unionByName(read()) if there else known, "text_sha", "left_anti")
            misses.select("text_sha", "text_").dropDuplicates(["text_sha"]).mapInPandas(run, VECTORS).write.mode("append").parquet(store)
            there = True
        known = known.unionByName(read()) if there else known
    elif client is not None:
        raise ValueError("a client needs a table for its vectors")
    return keyed.drop("text_").join(known, "text_sha", "left").drop("text_sha")


@dataclass(frozen=True)
class Asker:
    """Where a workflow's answers come from: a cache of known ones, and a client with a store for new ones if there is
    one. The cache's prompts are made unique once, and written, so that a chain of stages only joins it."""

    cache: DataFrame
    model: str = "m"
    client: Client | None = None
    store: str | None = None
    seconds: float = 60.0
    unique: bool = False

    def prepared(self) -> Asker:
        """The same with a cache that has each prompt once."""
        if self.unique:
            return self
        # unique rows stay as they are
        once = self.cache.groupBy("prompt_sha").agg(F.max("response").alias("response"))
        return replace(self, cache=checkpointed(once), unique=True)

    def key(self, stage: str, user: Column) -> Column:
        return prompt_key(self.model, F.lit(stage), user)

    def ask(self, rows: DataFrame, stage: str, user: Column, errors: bool = False) -> DataFrame:
        """``rows`` with response to the stage's prompt about ``user``, null where nobody answers; with ``errors`` also
        call_error."""
        cache = self.cache if self.unique else self.cache.groupBy("prompt_sha").agg(F.max("response").alias("response"))
        return answered(rows, cache, self.model, F.lit(stage), user, self.client, self.store, self.seconds).drop("prompt_sha", *([] if errors else ["call_error"]))
