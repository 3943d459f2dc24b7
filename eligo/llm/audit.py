"""What each filter of a chain removes, in every order of the filters: an incremental stream with retractions.

Five filters judge a text: A, few words; B, repeated words; C, capitals; D, symbols; E, an exact copy of a text with a
smaller doc_id. A to D hold for a text whenever it is read; E may change its mind, as a smaller id may come later. So
all files are processed as micro-batches of an available-now stream, and:

1. rows become narrow (digest, id, part, labels, failures A to D) before anything moves;
2. within a batch of rows in a task, rows whose text has a smaller id there fail E for certain and are counted at once;
   per text only those with the least id go on, so a large group of copies shrinks where it is read;
3. keyed state holds for each text the least id so far and what its rows count as. Later rows with larger ids fail E;
   rows with a smaller one take the place, and the old ones are retracted: one less without E, one more with it;
4. each micro-batch writes its changes of the counters (part, labels, failures); a batch that is run again writes over
   its own folder, so lost tasks and restarts count nothing twice. The sum of all changes is the audit's basis.

State is keyed by the first bits of the text's digest: a group of texts shares a row of the state store, its texts lie
there as one small Arrow table. The number of groups grows with the number of rows, so a state row stays small.

For each part the 32 counts by failed filters give, for every set of filters, how many documents pass all of them; each
order and step is a difference of two such counts.

Defined results: a null text is empty; a null part is the empty string; a row with a null doc_id never fails E and
makes no other row fail it; repeated rows with one doc_id and text do not fail E by each other; documents without
labels are neither good nor toxic, and of several labels of a document any 1 counts; a very long text is held by one
task; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import contextlib
import zlib
from itertools import permutations
from math import factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eligo.llm.common import SPACE, fresh_dir, table, text_of, written

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
SETS = range(1 << len(FILTERS))
#: Labelled documents up to which their labels are broadcast (about 20 bytes each); more are joined.
BROADCAST_LABELS = 1_000_000
#: Rows to a group of texts in the state store, about.
GROUP_ROWS = 1_000
CHANGES = "part string, good boolean, toxic boolean, mask int, n long"
ROWS = pa.schema([("digest", pa.binary()), ("id", pa.int64()), ("part", pa.string()), ("good", pa.bool_()), ("toxic", pa.bool_()), ("mask", pa.int32()), ("n", pa.int64())])
KINDS = ["part", "good", "toxic", "mask"]


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")

    def bits(w):
        few = F.size(w) < 50
        dull = 100 * F.size(F.array_distinct(w)) < 65 * F.size(w)
        loud = 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text)
        odd = text.rlike(r"[#$%&*|]")
        return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate((few, dull, loud, odd))), F.lit(0))

    # the list of words is made once for both filters
    return F.element_at(F.transform(F.array(words), bits), 1)


def marks(labels: DataFrame) -> DataFrame:
    """key, good, toxic: labelled documents that are good or toxic; broadcast if there are few."""
    found = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    found = written(found.filter("good or toxic"), "marks")
    return F.broadcast(found) if found.count() <= BROADCAST_LABELS else found


def narrow(docs: DataFrame, marked: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """digest, id, part, good, toxic, mask of each row. Rows without a key meet no label and are dealt out."""
    body = text_of(docs, text)
    rows = docs.select(F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"), docs[key].cast("long").alias("id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), failures(body).alias("mask"), F.col("_metadata.row_index").alias("row"))
    deal = F.when(F.col("id").isNull(), F.col("row"))
    rows = rows.withColumns({"key": F.coalesce("id", deal), "spare": F.col("id").isNull()})
    out = rows.join(marked.withColumn("spare", F.lit(False)), ["key", "spare"], "left")
    return out.select("digest", "id", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "mask")


def settled(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(rows with the least id of their text, counts of the others, which fail E). Rows: digest, id, KINDS, n; equal
    ones become one."""
    least = rows.groupby("digest")["id"].transform("min")
    first = rows["id"] == least
    own = rows[first].groupby(["digest", "id", *KINDS], as_index=False)["n"].sum()
    rest = rows[~first]
    return own, counted(rest.assign(mask=rest["mask"] | COPY))


def counted(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.groupby(KINDS, as_index=False)["n"].sum()


def combined(rows: DataFrame, groups: int) -> DataFrame:
    """Rows for the state, each with its group of texts: at most one per text, id and kind from a batch of rows; and
    counts that need no state (digest null)."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            f = batch.to_pandas()
            f["n"] = 1
            keyed = f[f["id"].notna()].astype({"id": "int64"})
            own, sure = settled(keyed)
            sure = counted(pd.concat([sure, f[f["id"].isna()][[*KINDS, "n"]]]))
            own["group"] = [int.from_bytes(d[:8]) % groups for d in own["digest"]]
            sure["group"] = [zlib.crc32(f"{m} {p}".encode()) % groups for p, m in zip(sure["part"], sure["mask"])]
            for x in (own, sure.assign(digest=None, id=0)):
                yield pa.RecordBatch.from_pandas(x[["group", *ROWS.names]], schema=pa.schema([("group", pa.int64()), *ROWS]), preserve_index=False)

    return rows.mapInArrow(run, "group long, digest binary, id long, part string, good boolean, toxic boolean, mask int, n long")


def updated(key, frames, state: GroupState):
    """The counters' changes that new rows of a group of texts make."""
    new = pd.concat(list(frames))
    sure = new[new["digest"].isna()]
    new = new[new["digest"].notna()][ROWS.names]
    out = [sure[[*KINDS, "n"]]]
    if len(new):
        held = pa.ipc.open_stream(state.get[0]).read_all().to_pandas() if state.exists else new.iloc[:0]
        new["digest"] = new["digest"].map(bytes)
        now, _ = settled(pd.concat([held, new]))
        # a text counts as its rows do now, no more as they did: old holders of the least id are retracted
        was = held.assign(n=-held["n"])
        lost = pd.concat([held, new]).merge(now[["digest", "id"]].drop_duplicates().rename(columns={"id": "least"}), on="digest")
        lost = lost[lost["id"] != lost["least"]]
        out += [was[[*KINDS, "n"]], now[[*KINDS, "n"]], lost.assign(mask=lost["mask"] | COPY)[[*KINDS, "n"]]]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, ROWS) as writer:
            writer.write_table(pa.Table.from_pandas(now[ROWS.names], ROWS, preserve_index=False))
        state.update((sink.getvalue().to_pybytes(),))
    changes = counted(pd.concat(out))
    yield changes[changes["n"] != 0]


#: Rows to a partition of the state from which it is kept on disk; below, it takes tens of MB of memory at most.
DISK_ROWS = 1_000_000
#: State in RocksDB, on the executors' disks; a commit writes what has changed, not the store.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextlib.contextmanager
def on_disk(spark: SparkSession, rows: int):
    """Streams that start meanwhile keep their state as :data:`ON_DISK` says, if it may become large; else as the session
    says. The results are the same."""
    large = rows > DISK_ROWS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = {name: spark.conf.get(name, None) for name in ON_DISK} if large else {}
    for name in before:
        spark.conf.set(name, ON_DISK[name])
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = 4, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, good, toxic, mask, n: how many rows of the Parquet table at ``path`` fail exactly the filters of ``mask``.

    The table's files are processed in about ``batches`` micro-batches; state and progress are in the shared folder."""
    docs = spark.read.parquet(path)
    files, rows = docs.inputFiles(), docs.count()
    if not rows:
        return spark.createDataFrame([], CHANGES)
    path = path.rstrip("/")
    if files[0].endswith(path.rpartition("/")[2]):  # a stream takes a single file only as a pattern
        path = f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", -(-len(files) // batches)).parquet(path)
    at, done = fresh_dir(spark, "audit"), []
    changes = combined(narrow(stream, marks(labels), key, text, part), -(-rows // GROUP_ROWS)).groupBy("group")
    changes = changes.applyInPandasWithState(updated, CHANGES, "texts binary", "update", GroupStateTimeout.NoTimeout)

    def put(batch: DataFrame, number: int) -> None:
        batch.groupBy(*KINDS).agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{at}/changes/{number}")
        done.append(number)

    with on_disk(spark, rows):
        query = changes.writeStream.foreachBatch(put).option("checkpointLocation", f"{at}/progress").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    found = spark.read.schema(CHANGES).parquet(*(f"{at}/changes/{k}" for k in sorted(set(done))))
    return found.groupBy(*KINDS).agg(F.sum("n").alias("n")).filter("n <> 0")


def audited(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley."""
    passing = lambda flag: F.array(*(F.sum(F.when(flag & (F.col("mask").bitwiseAND(s) == 0), F.col("n")).otherwise(0)) for s in SETS))
    by_part = counts.groupBy("part").agg(passing(F.lit(True)).alias("all"), passing(F.col("good")).alias("good"), passing(F.col("toxic")).alias("toxic"))
    step = lambda before, bit: F.struct(F.lit(before).alias("before"), F.lit(bit).alias("bit"))
    removed = lambda column, before, bit: F.col(column)[before] - F.col(column)[before.bitwiseOR(bit)]
    every = SETS[-1]

    def share(bit):
        """How many a filter removes over all orders: each set before it occurs in so many of them."""
        orders = lambda s: factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())
        return sum((orders(s) * removed("all", F.lit(s), F.lit(bit)) for s in SETS if not s & bit), F.lit(0))

    by_part = by_part.withColumn("shares", F.array(*(share(1 << k) for k in range(len(FILTERS)))))
    orders = []
    for order in permutations(range(len(FILTERS))):
        before, steps = 0, []
        for k in order:
            steps.append(step(before, 1 << k))
            before |= 1 << k
        orders.append(F.struct(F.lit("".join(FILTERS[k] for k in order)).alias("filter_order"), F.array(*steps).alias("steps")))
    rows = by_part.select("*", F.explode(F.array(*orders)).alias("o")).select("*", "o.filter_order", F.posexplode("o.steps").alias("at", "s"))
    before, bit = F.col("s.before"), F.col("s.bit")
    out = removed("all", before, bit)
    return rows.select(
        "part",
        "filter_order",
        (F.col("at") + 1).cast("int").alias("step"),
        F.col("all")[before.bitwiseOR(bit)].alias("kept"),
        out.alias("removed"),
        (F.col("all")[0] - F.col("all")[bit] - out).alias("redundant"),
        (F.col("all")[F.lit(every).bitwiseXOR(bit)] - F.col("all")[every]).alias("unique_fails"),
        removed("good", before, bit).alias("good_lost"),
        removed("toxic", before, bit).alias("toxic_lost"),
        F.col("shares")[F.round(F.log2(bit)).cast("int")].alias("shapley"),
    )


def op13_filter_audit(spark, sf_dir) -> DataFrame:
    return audited(counters(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels")))


#: The same rows in SQL.
ORACLE = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
flags AS (
    SELECT cut.part, coalesce(l.good, FALSE) AS good, coalesce(l.toxic, FALSE) AS toxic,
           [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
            regexp_matches(text, '[#$%&*|]'), coalesce(cut.doc_id > min(cut.doc_id) OVER (PARTITION BY text), FALSE)] AS fails
    FROM cut LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) AS l ON l.doc_id = cut.doc_id),
counts AS (SELECT part, good, toxic, fails, count(*) AS n FROM flags GROUP BY ALL),
letters(k, f) AS (VALUES (1, 'A'), (2, 'B'), (3, 'C'), (4, 'D'), (5, 'E')),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.k, b.k, c.k, d.k, e.k] AS ks
    FROM letters a JOIN letters b ON b.k <> a.k JOIN letters c ON c.k NOT IN (a.k, b.k) JOIN letters d ON d.k NOT IN (a.k, b.k, c.k)
    JOIN letters e ON e.k NOT IN (a.k, b.k, c.k, d.k)),
steps AS (SELECT filter_order, CAST(i AS INTEGER) AS step, ks[i] AS k, ks[1:i - 1] AS earlier FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS i FROM orders)),
judged AS (
    SELECT part, filter_order, step, k, good, toxic, n, fails[k] AS failed, list_bool_or(list_transform(earlier, lambda j: fails[j])) AS gone,
           len(list_filter(fails, lambda x: x)) = 1 AS once
    FROM counts CROSS JOIN steps),
summed AS (
    SELECT part, filter_order, step, k,
           CAST(sum(CASE WHEN NOT failed AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
           CAST(sum(CASE WHEN failed AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN failed AND once THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
           CAST(sum(CASE WHEN failed AND NOT gone AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN failed AND NOT gone AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM (SELECT * REPLACE (coalesce(gone, FALSE) AS gone) FROM judged) GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM summed
"""
