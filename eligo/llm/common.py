"""Small helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import gc
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.sources.shared import checkpointed, fresh_dir, shared_dir  # noqa: F401

#: ASCII white space; a word is a maximal run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: later reads take only the columns they need, from
    as many tasks as the bytes are worth. Its lineage ends there."""
    at = fresh_dir(df.sparkSession, what)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def file_system(uri: str):
    """(file system, path) of a shared folder's URI, for tasks that write files of their own there."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text"):
    """The text column with null as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is; ELIGO_TOKENIZERS overrides the installed folder."""
    at = os.environ.get("ELIGO_TOKENIZERS")
    if at:
        return os.path.join(at, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def blocks(lengths: np.ndarray, most: int = 2_000_000):
    """Ranges of rows that hold about ``most`` units of length each."""
    at, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        held += n or 0
        if held >= most:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(lengths):
        yield at, len(lengths)


@contextlib.contextmanager
def collector_off():
    """Python's cycle collector rests meanwhile: it is slow over large memories of many small objects without cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_TURN: list[dict] = []


def take_turns(memory: dict) -> None:
    """``memory`` is what this worker remembers from now on; what another operator has left in the same worker goes."""
    if _TURN and _TURN[0] is not memory:
        _TURN[0].clear()
    _TURN[:] = [memory]


class Remembered(dict):
    """What a worker remembers of words: about ``most`` bytes of them, no word of over ``longest`` characters."""

    #: Bytes that Python's own objects add to each word and its value.
    OBJECTS = 180

    def __init__(self, most: int = 160 << 20, longest: int = 256):
        super().__init__()
        self.most, self.longest, self.held = most, longest, 0

    def all(self, words: set[str], learn):
        """A lookup that knows every one of ``words``; ``learn`` gives the values of a list of new ones."""
        new = [w for w in words if w not in self]
        found = dict(zip(new, learn(new))) if new else {}
        short = {w: v for w, v in found.items() if len(w) <= self.longest}
        size = sum(len(w) + len(v) for w, v in short.items()) + self.OBJECTS * len(short)
        if self.held + size > self.most:
            found = {w: self[w] for w in words if w in self} | found
            self.clear()
            self.held = 0
        if size <= self.most:
            self.update(short)
            self.held += size
            if len(short) == len(found) == len(new):
                return self.__getitem__
        return lambda w: found[w] if w in found else self[w]


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
