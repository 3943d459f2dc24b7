"""A log of review edits: overrides, notes and checks, with versions, snapshots and compaction.

Each append is one version: a folder that is written under a hidden name and then gets its own, so readers see a whole
version or none, and of two writers who want the same number one takes the next. A snapshot holds the last edit of each
key and field up to a version; readers take the newest one and the versions after it, and older files may go."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.sources.shared import file_system

#: What may be edited (fixed values): an override of the code, the notes, the check mark.
FIELDS = ("OverrideCode", "Notes", "Checked")


@dataclass(frozen=True)
class EditLog:
    """Edits of rows with ``keys``, in a folder that driver and executors share. An edit: keys, field (of FIELDS), value
    (text; null allowed), deleted, seq (its order within its version)."""

    path: str
    keys: tuple[str, ...]

    def _numbers(self, kind: str) -> list[int]:
        from pyarrow import fs

        files, at = file_system(self.path)
        found = files.get_file_info(fs.FileSelector(at, allow_not_found=True))
        return sorted(int(f.base_name.partition("-")[2]) for f in found if f.base_name.startswith(f"{kind}-"))

    def _put(self, rows: DataFrame, kind: str, number: int | None) -> int:
        """``rows`` as a folder of that kind: of that number, or of the next free one."""
        files, at = file_system(self.path)
        hidden = f".{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{hidden}")
        while True:
            n = number if number is not None else max([0, *self._numbers("version"), *self._numbers("snapshot")]) + 1
            try:
                files.move(f"{at}/{hidden}", f"{at}/{kind}-{n}")  # fails if someone else has written that number
                return n
            except OSError:
                if n not in self._numbers(kind):
                    raise
                if number is not None:  # the same snapshot is there already
                    files.delete_dir(f"{at}/{hidden}")
                    return n

    def append(self, edits: DataFrame) -> int:
        """Adds ``edits`` as the next version, whose number it returns."""
        return self._put(edits.select(*self.keys, "field", F.col("value").cast("string").alias("value"), F.coalesce("deleted", F.lit(False)).alias("deleted"), F.col("seq").cast("long").alias("seq")), "version", None)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """keys, field, value, deleted, seq, version: the newest snapshot and every later edit; null if there are none."""
        shots = self._numbers("snapshot")
        parts = [spark.read.parquet(f"{self.path}/snapshot-{shots[-1]}")] if shots else []
        parts += [spark.read.parquet(f"{self.path}/version-{n}").withColumn("version", F.lit(n).cast("long")) for n in self._numbers("version") if not shots or n > shots[-1]]
        out = parts[0] if parts else None
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def compact(self, spark: SparkSession, drop: bool = True) -> None:
        """A snapshot of the last edit of each key and field; with ``drop`` the files that it stands for go."""
        edits, versions = self.read(spark), self._numbers("version")
        if edits is None or not versions:
            return
        last = edits.groupBy(*self.keys, "field").agg(F.max_by(F.struct("value", "deleted", "seq", "version"), F.struct("version", "seq")).alias("x"))
        n = self._put(last.select(*self.keys, "field", "x.*"), "snapshot", versions[-1])
        if drop:
            files, at = file_system(self.path)
            for kind, numbers in (("version", versions), ("snapshot", [s for s in self._numbers("snapshot") if s < n])):
                for v in numbers:
                    files.delete_dir(f"{at}/{kind}-{v}")

    def applied(self, base: DataFrame) -> DataFrame:
        """``base`` (keys, LlmCode, Notes, Checked, ...) under the last edit of each key and field, in one aggregation:
        OverrideCode, Override, Code, Notes, Checked. A deleted or empty override gives the base's code back; a deleted
        note or check gives the base's."""
        edits = self.read(base.sparkSession)
        if edits is None:
            empty = ", ".join(f"`{k}` {base.schema[k].dataType.simpleString()}" for k in self.keys)
            edits = base.sparkSession.createDataFrame([], f"{empty}, field string, value string, deleted boolean, seq long, version long")
        edit = F.struct("version", "seq", "deleted", "value")
        last = edits.groupBy(*self.keys).agg(*(F.max(F.when(F.col("field") == f, edit)).alias(f"last_{f}") for f in FIELDS))
        out = base.drop("OverrideCode", "Override", "Code").join(last, list(self.keys), "left")
        stands = lambda f: F.when(~F.col(f"last_{f}.deleted"), F.col(f"last_{f}.value"))
        given = lambda f: F.coalesce(~F.col(f"last_{f}.deleted"), F.lit(False))
        out = out.withColumn("OverrideCode", F.nullif(stands("OverrideCode"), F.lit("")))
        out = out.withColumns({
            "Override": F.col("OverrideCode").isNotNull(),
            "Code": F.coalesce("OverrideCode", "LlmCode"),
            "Notes": F.when(given("Notes"), F.col("last_Notes.value")).otherwise(F.col("Notes")),
            "Checked": F.when(given("Checked"), F.lower("last_Checked.value") == "true").otherwise(F.col("Checked")),
        })
        return out.drop(*(f"last_{f}" for f in FIELDS))
