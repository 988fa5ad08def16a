"""A FASTQ source for Spark: a file is read in byte ranges, each starting at a record that the range finds itself."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "start long, name string, seq string, qual string"


class Range(InputPartition):
    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


def records(path: str, begin: int, end: int) -> Iterator[tuple[int, str, str, str]]:
    """(byte offset, name, seq, qual) of records that start in [begin, end).

    A record starts at a line with ``@`` whose second next begins with ``+`` and whose sequence and qualities are of one
    length; a quality line may begin with ``@`` too, but then what follows doesn't fit.
    """
    with open(path, "rb") as f:
        f.seek(begin)
        if begin:
            f.seek(begin - 1)
            f.readline()
        while (at := f.tell()) < end:
            head = f.readline()
            if not head:
                return
            if not head.startswith(b"@"):
                continue
            after = f.tell()
            s, plus, q = (f.readline().rstrip(b"\r\n") for _ in range(3))
            if not plus.startswith(b"+") or len(s) != len(q):
                f.seek(after)
                continue
            yield at, head[1:].split()[0].decode() if head[1:].split() else "", s.decode(), q.decode()


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"].removeprefix("file://"), int(options.get("bytes", 64 << 20))

    def partitions(self) -> list[Range]:
        n = os.path.getsize(self.path)
        return [Range(self.path, a, min(n, a + self.size)) for a in range(0, n, self.size)] or [Range(self.path, 0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        yield from records(partition.path, partition.begin, partition.end)


class Fastq(DataSource):
    """``spark.read.format("fastq").option("bytes", n).load(path)`` of a file that all executors see; plain text."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def read_fastq(spark: SparkSession, path: str, bytes_each: int = 64 << 20) -> DataFrame:
    """(start, name, seq, qual), U as T."""
    spark.dataSource.register(Fastq)
    return spark.read.format("fastq").option("bytes", bytes_each).load(path).withColumn("seq", F.translate("seq", "Uu", "Tt"))


def pair(first: DataFrame, second: DataFrame) -> DataFrame:
    """(name, seq1, qual1, seq2, qual2): mates of two files by their names, without the mate's number."""
    from ..functions.seq import read_pair_name

    a, b = (x.select(read_pair_name(F.col("name")).alias("name"), F.col("seq").alias(f"seq{i}"), F.col("qual").alias(f"qual{i}")) for i, x in ((1, first), (2, second)))
    return a.join(b, "name")


def deinterleave(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First and second mates of one file in which they alternate, by their order in it."""
    from pyspark.sql import Window

    # offsets are exact and unique, so a running number needs one sort; ranges keep it from being one task's
    numbered = reads.withColumn("_part", F.floor(F.col("start") / (64 << 20)))
    before = numbered.groupBy("_part").count().withColumn("_b", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    n = numbered.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy("start")) - 1).join(F.broadcast(before), "_part")
    odd = (F.col("_n") + F.col("_b")) % 2
    return n.where(odd == 0).select(*reads.columns), n.where(odd == 1).select(*reads.columns)
