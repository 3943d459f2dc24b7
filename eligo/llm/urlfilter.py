"""URL filter by a sorted digest array.

The list of entries (host, path prefix, verdict) is a table of any length. Tasks write it as array files, each for a
range of keys: 64-bit xxhash keys of the entries' strings in ascending order, their verdicts, and the strings
themselves. Spark ships the files to every executor once, whose workers memory-map them and share their pages; the
driver sees no entry, only the files' names. A batch of urls becomes a batch of probes (each suffix of the host with
each prefix length of the path that the list has, and the page itself), probed by vectorised binary search; a hit counts
only if the stored string equals the probe, so digest collisions cannot decide a url.

An entry stands for a host with its subdomains and every path that begins with its own, or, if it is ``whole``, for one
page: its host and path alone. The probes of a url grow with the number of path lengths that the former have in the list,
which is small for rules and hosts; however many pages a list names, they cost one probe.

The list's size is checked against ``most_bytes`` before it is shipped. A longer list is joined by its entry strings
instead (:func:`judge_by_join`), with the same result, and no part of it leaves the executors.

Defined results: a null url and one without ``://`` have an empty host and path and fit no entry; repeated rows are
judged alike; of several entries that fit, rules come before the block list and the longest wins, of equally long ones
that with the longer path, then a whole page's; an empty table gives no rows; extra columns are kept, but ``host``, ``path``, ``rule`` and
``verdict`` are the results.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eligo.llm.common import file_system, fresh_dir, table, written

#: The rules of the query (fixed values): host, path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Labels of junk hosts, under whatever domain they stand (fixed values).
JUNK = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = "struct<rule: string, verdict: string>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def entry_rows(spark: SparkSession, rules=RULES) -> DataFrame:
    """Rules as entries: host, path, origin (rule or list), verdict, whole."""
    return spark.createDataFrame([(h, p, "rule", v, False) for h, p, v in rules], "host string, path string, origin string, verdict string, whole boolean")


def junk_entries(pages: DataFrame, url: str = "url", labels=JUNK) -> DataFrame:
    """A block list from crawled pages, by rule: each host that has one of ``labels`` before its last dot, from that
    label on and so with its subdomains, under any domain."""
    host, _ = host_and_path(F.col(url))
    inner = F.regexp_extract(host, r"(?:^|\.)((?:" + "|".join(labels) + r")\..*)$", 1)
    found = pages.select(inner.alias("host")).filter("host <> ''").distinct()
    return found.select("host", F.lit("").alias("path"), F.lit("list").alias("origin"), F.lit("block").alias("verdict"), F.lit(False).alias("whole"))


def link_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """A block list of single pages: those whose html holds more links (``<a ``) than paragraphs (``<p>``), which lead
    elsewhere and say little. A page that was crawled more than once counts if any of its copies does."""
    host, path = host_and_path(F.col(url))
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    found = pages.filter(F.regexp_count(body, F.lit("<a ")) > F.regexp_count(body, F.lit("<p>"))).select(host.alias("host"), path.alias("path")).filter("host <> ''").distinct()
    return found.select("host", "path", F.lit("list").alias("origin"), F.lit("block").alias("verdict"), F.lit(True).alias("whole"))


def entry_string(host: str, path: str, whole: bool) -> bytes:
    """What is stored and probed for: pages and prefixes never share a string."""
    return f"{'=' if whole else '^'}{host}\n{path}".encode()


def digest_files(entries: DataFrame, most_bytes: int = 256 << 20, part_bytes: int = 32 << 20) -> list[str] | None:
    """The names under which executors find the array of ``entries``; None if it would be larger than ``most_bytes``."""
    spark = entries.sparkSession
    code = F.when(F.col("origin") == "rule", 0).otherwise(2) + F.when(F.col("verdict") == "allow", 0).otherwise(1)
    entries = written(entries.groupBy("host", "path", "whole").agg(F.min(code).alias("code")), "entries")
    sized = entries.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 25).alias("b")).first()["b"] or 0
    if sized > most_bytes:
        return None
    folder, parts = fresh_dir(spark, "urls"), max(1, -(-sized // part_bytes))

    @arrow_udf("long")
    def digest(hosts: pa.Array, paths: pa.Array, wholes: pa.Array) -> pa.Array:
        keys = [xxhash.xxh64_intdigest(entry_string(*e)) for e in zip(hosts.to_pylist(), paths.to_pylist(), wholes.to_pylist())]
        return pa.array(np.asarray(keys, np.uint64).view(np.int64) ^ np.int64(-(1 << 63)))  # orders as the unsigned key

    keyed = entries.select("host", "path", "code", "whole", digest("host", "path", "whole").alias("key"))
    keyed = keyed.repartition(1) if parts == 1 else keyed.repartitionByRange(parts, "key")

    def run(batches):
        blob, codes, lengths = [], [], set()
        for batch in batches:
            for h, p, c, w in zip(*(batch.column(k).to_pylist() for k in range(4))):
                blob.append(entry_string(h, p, w))
                codes.append(c)
                if not w:
                    lengths.add(len(p))
        if blob:
            keys = np.fromiter(map(xxhash.xxh64_intdigest, blob), "<u8", len(blob))
            ends = np.cumsum([0, *map(len, blob)]).astype("<u8")
            fs, at = file_system(folder)
            fs.create_dir(at, recursive=True)
            name = f"urls-{uuid.uuid4().hex}.bin"
            with fs.open_output_stream(f"{at}/{name}", compression=None) as f:
                for x in (np.asarray([len(blob), len(lengths)], "<u8"), keys, ends, np.asarray(codes, "<u8"), np.asarray(sorted(lengths), "<u8")):
                    f.write(x.tobytes())
                f.write(b"".join(blob))
            yield pa.RecordBatch.from_pydict({"name": [name]})

    # at most one row of a name a part; files of failed attempts are named by none
    names = [r["name"] for r in keyed.sortWithinPartitions("key", "host", "path").mapInArrow(run, "name string").collect()]
    for name in names:
        spark.sparkContext.addFile(f"{folder}/{name}")
    return names


class DigestArray:
    """Memory-mapped digest files."""

    def __init__(self, paths: tuple[str, ...]):
        self.parts, lengths = [], set()
        for path in paths:
            raw = np.memmap(path, np.uint8, "r")
            n, m = (int(x) for x in raw[:16].view("<u8"))
            cut = lambda start, count: raw[start : start + 8 * count].view("<u8")
            lengths.update(cut(24 + 24 * n, m).tolist())
            self.parts.append((cut(16, n), cut(16 + 8 * n, n + 1), cut(24 + 16 * n, n), raw[24 + 24 * n + 8 * m :]))
        self.lengths = sorted(lengths)

    def find(self, probes: list[bytes]) -> list[int]:
        """The code of each probe's entry, -1 where there is none."""
        out = np.full(len(probes), -1)
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        for keys, ends, codes, blob in self.parts:
            at = np.searchsorted(keys, wanted)
            for i in np.flatnonzero((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == wanted)):
                k = int(at[i])
                while k < len(keys) and keys[k] == wanted[i]:
                    if blob[int(ends[k]) : int(ends[k + 1])].tobytes() == probes[i]:
                        out[i] = codes[k]
                        break
                    k += 1
        return out.tolist()


@lru_cache(maxsize=4)
def digest_array(paths: tuple[str, ...]) -> DigestArray:
    return DigestArray(paths)


def suffixes(host: str) -> list[str]:
    labels = host.split(".")
    return [".".join(labels[k:]) for k in range(len(labels))] if host else []


RESULTS = ("host", "path", "rule", "verdict")


def judge(rows: DataFrame, url: str = "url", entries: DataFrame | None = None, most_bytes: int = 256 << 20) -> DataFrame:
    """``rows`` with host, path, rule (as host and path, null if none fits) and verdict.

    ``entries``: host, path, origin, verdict; by default the rules alone."""
    entries = entry_rows(rows.sparkSession) if entries is None else entries
    names = digest_files(entries, most_bytes)
    host, path = host_and_path(F.col(url))
    parts = rows.select(F.struct(*(rows[c] for c in rows.columns)).alias("page"), host.alias("host"), path.alias("path"))
    found = judge_by_join(parts, entries) if names is None else judge_by_array(parts, names)
    return found.select(*(F.col("page").getField(c).alias(c) for c in rows.columns if c not in RESULTS), *RESULTS)


def judge_by_array(rows: DataFrame, names: list[str]) -> DataFrame:
    """page, host, path with rule and verdict from the shipped array."""

    @arrow_udf(FOUND)
    def run(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        array = digest_array(tuple(map(SparkFiles.get, names)))
        owner, parts = [], []
        for i, (h, p) in enumerate(zip(hosts.to_pylist(), paths.to_pylist())):
            parts.append((h, p, True))
            owner.append(i)
            for s in suffixes(h):
                for n in array.lengths:
                    if n <= len(p):
                        owner.append(i)
                        parts.append((s, p[:n], False))
        probes = [entry_string(*x) for x in parts]
        best: dict[int, tuple] = {}
        for i, code, (s, p, w) in zip(owner, array.find(probes), parts):
            if code >= 0:
                rank = (code < 2, len(s) + len(p), len(p), w, code % 2 == 0, s + p)
                best[i] = max(best.get(i, rank), rank)
        got = [best.get(i) for i in range(len(hosts))]
        rule = pa.array([g[5] if g and g[0] else None for g in got], pa.string())
        verdict = pa.array(["allow" if not g or g[4] else "block" for g in got], pa.string())
        return pa.StructArray.from_arrays([rule, verdict], ["rule", "verdict"])

    return rows.withColumn("found", run("host", "path")).select("page", "host", "path", "found.rule", "found.verdict")


def judge_by_join(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """The same verdicts where the list is too long to ship: probes are joined with the entries by their strings.

    A url's probes differ, so no key gathers many rows but by an entry that many urls fit; adaptive execution splits
    that one."""
    lengths = entries.filter("not whole").select(F.length("path").alias("n")).distinct()
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    urls = rows.select("host", "path").distinct().filter("host <> ''")
    cut = urls.select("host", "path", F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n")).join(lengths, "n", "left_semi")
    pairs = cut.select("host", "path", F.explode(tails).alias("tail"), F.substring("path", F.lit(1), F.col("n")).alias("head"), F.lit(False).alias("whole"))
    pairs = pairs.unionAll(urls.select("host", "path", "host", "path", F.lit(True)))
    named = entries.select(F.col("host").alias("tail"), F.col("path").alias("head"), "origin", "verdict", "whole")
    rank = F.struct((F.col("origin") == "rule").alias("rule"), (F.length("tail") + F.length("head")).alias("n"), F.length("head").alias("p"), "whole", (F.col("verdict") == "allow").alias("allow"), F.concat("tail", "head").alias("entry"))
    best = written(pairs.join(named, ["tail", "head", "whole"]).groupBy("host", "path").agg(F.max(rank).alias("best")), "verdicts")
    out = rows.join(best, ["host", "path"], "left")
    rule = F.when(F.col("best.rule"), F.col("best.entry"))
    verdict = F.when(F.coalesce("best.allow", F.lit(True)), "allow").otherwise("block")
    return out.select("page", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def op6_url_filter(spark, sf_dir) -> DataFrame:
    """The verdicts of ``pages`` by the fixed rules and the lists that :func:`junk_entries` and :func:`link_pages` take
    from ``pages`` itself."""
    pages = table(spark, sf_dir, "pages")
    entries = entry_rows(spark).unionByName(junk_entries(pages)).unionByName(link_pages(pages))
    return judge(pages.select("page_id", "url"), entries=entries).select("page_id", "host", "path", "rule", "verdict")
