"""Aggregates kept as mergeable states, one set for each source file.

A state is (file, keys, counts and sums). Files that the folder of states knows,
by path, size and modification time, are not read again: a new extract costs
itself alone, and a total is the sum of the states. A file that changed replaces
its states. States are Parquet, a folder for each update.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.paths import path_of

_FILE = "file string, size long, modified timestamp, batch string, made timestamp"


class Partials:
    """States of one aggregate in ``folder`` (shared storage).

    ``rows(files)`` reads some files as rows with the columns ``keys`` and
    ``sums``, and ``_file``, the ``_metadata.file_path`` that each row is from."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], sums: Sequence[str], rows: Callable[[list[str]], DataFrame]):
        self.spark, self.folder, self.keys, self.sums, self.rows = spark, folder.rstrip("/"), list(keys), list(sums), rows

    def _read(self, what: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{what}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there = hadoop.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(hadoop)
        return self.spark.read.schema(schema).parquet(path) if there else self.spark.createDataFrame([], schema)

    def _known(self) -> DataFrame:
        """The last entry of each file."""
        entries = self._read("files", _FILE)
        last = entries.groupBy("file").agg(F.max(F.struct("made", "batch", "size", "modified")).alias("e"))
        return last.select("file", "e.batch", "e.size", "e.modified")

    def update(self, paths: Sequence[str]) -> list[str]:
        """Reads the files under ``paths`` that are new or have changed, and
        writes their states; returns their names. Both writes are whole or
        not there; the files' entries come last and make the states count."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
        listed = listed.filter("length > 0").select(*[F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_size", "size"), ("file_modification_time", "modified"))])
        fresh = listed.join(self._known().select("file", "size", "modified"), ["file", "size", "modified"], "left_anti")
        found = sorted((r.file, r.size, r.modified) for r in fresh.collect())
        if not found:
            return []
        files = [f for f, _, _ in found]
        batch = uuid.uuid4().hex
        sums = [F.sum(c).alias(c) for c in self.sums]
        states = self.rows([path_of(f) for f in files]).groupBy(F.col("_file").alias("file"), *self.keys).agg(*sums)
        states.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{self.folder}/states")
        entries = self.spark.createDataFrame([(*f, batch) for f in found], "file string, size long, modified timestamp, batch string")
        entries.withColumn("made", F.current_timestamp()).write.mode("append").parquet(f"{self.folder}/files")
        return files

    def totals(self) -> DataFrame:
        """(keys, sums) over all files: the states of each file's last update."""
        states = self.spark.read.parquet(f"{self.folder}/states")
        return states.join(self._known().select("file", "batch"), ["file", "batch"]).groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums])
