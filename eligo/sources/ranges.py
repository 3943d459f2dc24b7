"""Delimited files whose quoted cells hold line ends, read in byte ranges by many tasks.

Whether a line end parts two records depends on how many quotes come before it in the file, so a plain reader takes a
file in one task. Here Spark reads the lines of every range, in two passes:

1. each range returns whether its quotes are odd in number, and how many records would begin in it for either state of
   the quotes at its start; running sums over the few rows of a file's ranges give each range its state and the number of
   its first record;
2. each range numbers its lines' records. A record that is one line is parsed where it was read; only the lines of longer
   records are brought together, by file and number, wherever the borders of ranges cut them."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eligo.operators.catalogue import BROADCAST_ROWS


def _lines(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, lineSep="\n")
    return files.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _quotes(batch: pa.RecordBatch) -> list[int]:
    return pc.count_substring(batch.column("value"), '"').to_pylist()


def _surveyed(lines: DataFrame) -> DataFrame:
    """file, block, odd (0 or 1), even_starts, odd_starts of every range."""

    def run(batches):
        found: dict[tuple, list[int]] = {}
        for batch in batches:
            for file, block, n in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), _quotes(batch)):
                row = found.setdefault((file, block), [0, 0, 0])
                row[1 + row[0]] += 1  # a record begins here if the range began outside, or inside, of quotes
                row[0] ^= n & 1
        columns = list(zip(*((*k, *v) for k, v in found.items()))) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "block", "odd", "even_starts", "odd_starts"])

    return lines.mapInArrow(run, "file string, block long, odd long, even_starts long, odd_starts long")


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, number (from 0, in the file's order) and text of each record of the files at ``path``."""
    return _first_file(spark, path)[0]


def _first_file(spark: SparkSession, path: str) -> tuple[DataFrame, str | None]:
    """(:func:`records`, the first file that has a line). One survey counts the ranges and finds the file."""
    lines, before = _lines(spark, path), Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    surveyed = _surveyed(lines)
    size = surveyed.agg(F.count("*").alias("ranges"), F.min("file").alias("file")).first()
    ranges = surveyed.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    starts = F.when(F.col("inside") == 1, F.col("odd_starts")).otherwise(F.col("even_starts"))
    ranges = ranges.withColumn("first", F.coalesce(F.sum(starts).over(before), F.lit(0))).select("file", "block", "inside", "first")

    def run(batches):
        at, inside, number, place = None, 0, 0, 0
        for batch in batches:
            numbers, places, whole = [], [], []
            for file, block, state, first, n in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "inside", "first")), _quotes(batch)):
                if at != (file, block):
                    if first is None:
                        raise ValueError(f"the range of {file} at {block} was not surveyed: ranges or files have changed")
                    at, inside, number, place = (file, block), state, first - 1, 0
                number += not inside
                whole.append(not inside and not n & 1)
                inside ^= n & 1
                numbers.append(number)
                places.append(place)
                place += 1
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(numbers, pa.int64()), pa.array(places, pa.int64()), pa.array(whole, pa.bool_()), batch.column("value")], names=["file", "block", "number", "place", "whole", "value"])

    # the join must keep the lines of a range together and in order, as a broadcast does; beyond its bound they are sorted
    few = size["ranges"] <= BROADCAST_ROWS
    met = lines.withColumn("order_", F.monotonically_increasing_id()).join(F.broadcast(ranges) if few else ranges, ["file", "block"], "left")
    if not few:
        met = met.repartition("file", "block").sortWithinPartitions("file", "block", "order_")
    numbered = met.select("value", "file", "block", "inside", "first").mapInArrow(run, "file string, block long, number long, place long, whole boolean, value string")
    alone = numbered.filter("whole").select("file", "number", F.col("value").alias("text"))
    parts = numbered.filter("not whole").groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("lines"))
    return alone.unionByName(parts.select("file", "number", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("text"))), size["file"]


def _header(lines: DataFrame, found: DataFrame, file: str) -> str:
    """The first record of a file. Mostly it is the file's first line, and one task finds it."""
    line = lines.filter((F.col("file") == file) & (F.col("block") == 0)).select("value").first()[0]
    return line if line.count('"') % 2 == 0 else found.filter((F.col("file") == file) & (F.col("number") == 0)).first()["text"]


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", null: str = "NULL") -> DataFrame:
    """The files' rows as text columns, named by the first file's header; each file's first record is its header."""
    found, file = _first_file(spark, path)
    if file is None:
        return spark.createDataFrame([], "value string").select()
    options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": null, "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    head = _header(_lines(spark, path), found, file)
    width = head.count(sep) + 1
    split = lambda names: ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    named = spark.createDataFrame([(head.removesuffix("\r"),)], "text string").select(F.from_csv("text", split(f"c{k}" for k in range(width)), options).alias("h")).first()["h"]
    names = [n for n in named if n is not None]
    rows = found.filter("number > 0 and text <> ''").select(F.from_csv(F.regexp_replace("text", "\r$", ""), split(f"c{k}" for k in range(len(names))), options).alias("r"))
    return rows.select(*(F.col(f"r.c{k}").alias(n) for k, n in enumerate(names)))
