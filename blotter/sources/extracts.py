"""Readers for the incident extracts and their lookup tables.

Crime extracts are brought to the declared names and types, with null for a
value that does not parse; lookups keep their text, which the reports type. No
reader infers a schema: inference costs a full extra pass over every file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, FractionalType, StringType, StructField, StructType

from blotter.functions.paths import path_of
from blotter.functions.typed import as_date, as_double, as_int, ref
from blotter.operators.key_filter import key_filter, row_hash, with_verdict
from blotter.sources.schemas import CRIME_TYPES, TABLE_SCHEMAS, canonical, crime_text_schema

#: Column that a reader puts a line in whose cells don't fit the header.
_BAD = "_malformed_line"


def _as_list(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_csv_text(spark: SparkSession, path: str | Iterable[str], fmt: str = "csv", **options) -> DataFrame:
    """Extracts with headers renamed to canonical names: CSV columns as text,
    those of a typed format (``fmt="parquet"``) with their types, so that its
    filters and columns still reach the scan.

    CSV files, folders and globs may have headers of their own: files with the
    same header are one scan, and each scan checks its files against it. A line
    with too few cells has nulls for the rest, one with too many loses them;
    ``malformed_lines`` has these lines.
    """
    if fmt != "csv":
        df = spark.read.format(fmt).options(**options).load(_as_list(path))
        return df.select([ref(c).alias(canonical(c)) for c in df.columns])
    scans = [_scan(spark, files, header, options) for header, files in by_header(spark, _as_list(path), options.get("sep", ",")).items()]
    return union_extracts([df.select([ref(c).alias(canonical(c)) for c in df.columns]) for df in scans])


def _scan(spark: SparkSession, files: list[str], header: Sequence[str], options: dict, bad: bool = False) -> DataFrame:
    """The files of one header as text columns; ``bad`` adds the lines that don't fit."""
    schema = StructType([StructField(c, StringType()) for c in (*header, *[_BAD] * bad)])
    # enforceSchema off: a file whose header is not the one declared fails.
    # Standard CSV escapes a quote inside a quoted field by doubling it.
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    reader = reader.option("mode", "PERMISSIVE").option("escape", '"').options(**options)
    return (reader.option("columnNameOfCorruptRecord", _BAD) if bad else reader).csv(files)


def malformed_lines(spark: SparkSession, path: str | Iterable[str], **options) -> DataFrame:
    """The quarantine of CSV extracts: (file, line, reason) of the lines that
    have ``few cells`` or ``many cells`` for their header, or an ``open quote``.

    The header of a file is found on the executors, as for ``read_crimes``. Blank
    lines are none. A line is read as a whole; quoted cells hold no line feed.
    """
    sep = options.get("sep", ",")
    found = []
    for header, files in by_header(spark, _as_list(path), sep).items():
        rows = _scan(spark, files, header, options, bad=True).select("_metadata.file_path", ref(_BAD).alias("line"), *map(ref, header))
        # all columns are asked for: of cells that no one reads, the parser doesn't miss any
        lines = rows.filter(F.col("line").isNotNull() & (F.length(F.concat_ws("", *map(ref, header))) >= 0))
        plain = F.regexp_replace("line", '"[^"]*"', "")
        cells = F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) + 1
        reason = F.when(plain.contains('"'), "open quote").when(cells < len(header), "few cells").otherwise("many cells")
        found.append(lines.select(F.col("file_path").alias("file"), "line", reason.alias("reason")))
    return union_extracts(found)


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, line): the first line of each file under ``paths`` that has one,
    found by the executors. A task hands on the first lines of the files that
    begin in it; it stops at the first rows of a part of one large file."""
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(whole)
    lines = spark.read.text(list(paths)).select(
        "value", *[F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "length"))]
    )

    def run(batches):
        import pyarrow.compute as pc

        last = None
        for batch in batches:
            files = batch.column("file")
            code = files.dictionary_encode()
            starts = batch.column("start").to_pylist()
            for k, name in enumerate(code.dictionary.to_pylist()):
                at = pc.index(code.indices, k).as_py()
                if name != last and starts[at] == 0:
                    yield batch.slice(at, 1).select(["file", "value"])
            if batch.num_rows:
                last = files[-1].as_py()
                if batch.column("length")[-1].as_py() >= most:  # no other file in this task
                    return

    return lines.mapInArrow(run, "file string, line string")


def by_header(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """The files of each header. The driver gets each distinct header line once,
    with its files."""
    found = headers(spark, paths).groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files"))
    out: dict[tuple[str, ...], list[str]] = {}
    for line, files in sorted(found.collect()):
        cells = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), [])
        if cells:
            out.setdefault(tuple(cells), []).extend(map(path_of, files))
    return out


_TYPING = {"date": as_date, "int": as_int, "double": as_double}


def typed_crimes(df: DataFrame) -> DataFrame:
    """The declared columns of an extract in their types. Text that does not
    parse becomes null; columns that have a type already keep it."""

    def typed(name: str) -> Column:
        if name not in CRIME_TYPES or not isinstance(df.schema[name].dataType, StringType):
            return ref(name)
        return _TYPING[CRIME_TYPES[name]](df, name).alias(name)

    return df.select([typed(c) for c in df.columns])


def union_extracts(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by canonical name; a column missing from one file is null there.

    Matching by name rather than position keeps a reordered or re-spelled
    header from silently shifting values into the wrong column.
    """
    if not frames:
        raise ValueError("no extracts given")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def deduplicate(df: DataFrame, dedupe: str | Sequence[str] | None) -> DataFrame:
    """Apply one of the de-duplication modes of the loaders.

    - ``"rows"``: whole-row DISTINCT, before any projection, so two incidents
      that only agree on the projected columns are both kept. Planned as a
      partial + final hash aggregate: exact duplicates collapse map-side, so a
      heavily repeated row does not load one reducer.
    - a list of key columns: keep one row per key, the smallest one (by the
      other columns in their order), so that runs agree.
    - ``"hashed"``: the rows of ``"rows"``, found by hash first (see ``distinct_by_hash``).
    - ``None``: keep every row (UNION ALL).
    """
    if dedupe is None:
        return df
    if dedupe == "hashed":
        return distinct_by_hash(df)
    if dedupe == "rows":
        return df.distinct()
    rest = [c for c in df.columns if c not in dedupe]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*[ref(c) for c in dedupe]).agg(F.min(F.struct(*[ref(c) for c in rest])).alias("_kept"))
    return kept.select([ref(c) if c in dedupe else F.col("_kept")[c].alias(c) for c in df.columns])


def distinct_by_hash(df: DataFrame) -> DataFrame:
    """Whole-row DISTINCT that shuffles hashes, and whole only the rows that may
    repeat. The hashes that occur twice make a filter of bounded size
    (``operators.key_filter``); rows that it does not hold are distinct and stay
    where they are. A row it holds by chance is among the others and is kept, so
    the answer is that of ``distinct``. The source is read three times: for wide
    rows of which few repeat and that are cheap to read."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if any("double" in k.simpleString() or "float" in k.simpleString() for k in kinds.values() if not isinstance(k, FractionalType)):
        return df.distinct()  # equal numbers inside arrays and the like may differ in their bits
    # 0.0 and -0.0 are one value
    hashed = row_hash([ref(c) + F.lit(0.0).cast(k) if isinstance(k, (FloatType, DoubleType)) else ref(c) for c, k in kinds.items()])
    twice = df.select(hashed.alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    judged = with_verdict(df, hashed, key_filter(twice), "_again")
    alone = judged.filter(~F.col("_again")).drop("_again")
    return alone.unionByName(judged.filter("_again").drop("_again").distinct())


def read_crimes(
    spark: SparkSession,
    paths: str | Iterable[str],
    dedupe: str | Sequence[str] | None = "rows",
    fmt: str = "csv",
    positional: bool = False,
    typed: bool = True,
) -> DataFrame:
    """Read crime extracts (files, folders, globs) as one table.

    Columns are matched by header, so spelling drift or another order between
    files cannot misalign them. ``positional=True`` instead applies the
    declared 28-column layout to every file, for files whose header is
    unreliable. Values get their declared types before rows are compared, so
    ``0600`` and ``600`` do not make two rows of one; ``typed=False`` keeps the
    text, to find values that do not parse.
    """
    if positional:
        df = (
            spark.read.schema(crime_text_schema())
            .option("header", True)
            .option("enforceSchema", True)
            .option("escape", '"')
            .csv(_as_list(paths))
        )
    else:
        df = read_csv_text(spark, paths, fmt)
    return deduplicate(typed_crimes(df) if typed else df, dedupe)


def read_lookup(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A lookup extract (stations, geocode, income) under canonical names."""
    return read_csv_text(spark, path, fmt)


def parse_lines(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """CSV lines (column ``value``, without header) as text columns in the given
    order, by header cells of any spelling; quotes and doubled quotes as in files."""
    fields = ", ".join(f"`c{i}` string" for i in range(len(columns)))
    row = F.from_csv("value", fields, {"mode": "PERMISSIVE", "escape": '"'})
    parsed = lines.select(row.alias("r"))
    return parsed.select([F.col(f"r.c{i}").alias(canonical(c)) for i, c in enumerate(columns)])


def read_text_fields(spark: SparkSession, paths: str | Iterable[str], sep: str = ",") -> DataFrame:
    """Lines of text files: the raw line (``value``) and its naive split on
    ``sep`` (``fields``, an array).

    This is the quote-unaware form: a quoted separator inside a field shifts
    the positions of the fields after it. Use ``read_crimes`` for real CSV.
    """
    lines = spark.read.text(_as_list(paths))
    return lines.select("value", F.split(F.col("value"), sep, -1).alias("fields"))


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """A parquet table ``<base_dir>/<name>.parquet``, with its declared schema
    when one is known (no footer read to infer it)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
