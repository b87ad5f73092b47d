"""Headers found on the executors, lines that don't fit, states of files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from blotter.functions.paths import path_of
from blotter.operators import Partials
from blotter.sources import by_header, headers, malformed_lines, read_crimes
from tests.conftest import rows


def _name(path: str) -> str:
    return os.path.basename(path_of(path))


def test_headers_of_files_in_odd_places(spark, tmp_path):
    folder = tmp_path / "a b%20é {x}"
    folder.mkdir()
    (folder / "x 1+2.csv").write_text("DR_NO,LAT,LON\n1,34.0,-118.0\n")
    (folder / "y[1].csv").write_text("﻿DR_NO,LON,LAT\n2,-117.5,33.5\n")
    (folder / "only.csv").write_text("DR_NO,LAT,LON")
    (folder / "empty.csv").write_text("")
    pattern = str(tmp_path) + "/a*"
    assert sorted(by_header(spark, [pattern])) == [("DR_NO", "LAT", "LON"), ("DR_NO", "LON", "LAT")]
    assert rows(read_crimes(spark, pattern, dedupe=None), "DR_NO", "LAT", "LON") == [("1", 34.0, -118.0), ("2", 33.5, -117.5)]


def test_a_header_of_any_length(spark, tmp_path):
    names = [f"column {i} " + "x" * 40 for i in range(3000)]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n" + ",".join("1" * 3000) + "\n")
    (header,) = by_header(spark, [str(tmp_path)])
    assert len(",".join(header)) > 100_000 and list(header) == names


def test_only_beginnings_of_files_count(spark, tmp_path):
    """A file in several parts, and many files in one task, give one header each."""
    (tmp_path / "large.csv").write_text("DR_NO,LAT\n" + "".join(f"{i},{i}\n" for i in range(30_000)))
    for k in range(60):
        (tmp_path / f"s{k}.csv").write_text(f"DR_NO,LAT\n{k},1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("20k", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = headers(spark, [str(tmp_path)]).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert len(found) == 61 and {r.line for r in found} == {"DR_NO,LAT"}
        assert len({_name(r.file) for r in found}) == 61


def test_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text('DR_NO,Premis Desc,LAT\n1,"a, ""b""",34.0\n2,x\n3,x,1.0,2.0\n\n4,"open,5\n5,,\n')
    (tmp_path / "b.csv").write_text("LAT,DR_NO\n1.0,6\n1.0\n")
    got = {(_name(r.file), r.line, r.reason) for r in malformed_lines(spark, str(tmp_path)).collect()}
    assert got == {
        ("a.csv", "2,x", "few cells"), ("a.csv", "3,x,1.0,2.0", "many cells"), ("a.csv", '4,"open,5', "open quote"), ("b.csv", "1.0", "few cells"),
    }


@pytest.fixture
def states(spark, tmp_path):
    read = []

    def counted(files):
        read.append(sorted(map(os.path.basename, files)))
        lines = spark.read.text(files).select(F.col("value").alias("k"), F.col("_metadata.file_path").alias("_file"))
        return lines.withColumns({"n": F.lit(1).cast("long"), "s": F.length("k").cast("long")})

    return Partials(spark, str(tmp_path / "states"), ["k"], ["n", "s"], counted), read


def test_a_new_file_costs_itself_alone(spark, tmp_path, states):
    partials, read = states
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.txt").write_text("a\nbb\na\n")
    assert len(partials.update([str(folder)])) == 1
    assert partials.update([str(folder)]) == []
    (folder / "two.txt").write_text("bb\nccc\n")
    (folder / "empty.txt").write_text("")
    partials.update([str(folder)])
    assert read == [["one.txt"], ["two.txt"]]
    assert rows(partials.totals(), "k", "n", "s") == [("a", 2, 2), ("bb", 2, 4), ("ccc", 1, 3)]


def test_a_file_that_changed_replaces_its_states(spark, tmp_path, states):
    partials, read = states
    path = tmp_path / "one.txt"
    path.write_text("a\nb\n")
    partials.update([str(path)])
    path.write_text("a\nd\nd\n")
    partials.update([str(path)])
    assert read == [["one.txt"], ["one.txt"]]
    assert rows(partials.totals(), "k", "n") == [("a", 1), ("d", 2)]
