"""The reports over a directory that keeps receiving extract files.

A streaming source must declare its schema up front, so extracts are read
positionally with the declared all-text layout. The report functions of
``blotter.plans.reports`` are applied unchanged: Structured Streaming keeps
their aggregation state between micro-batches, and complete output mode
re-emits the whole (small) report after each batch.

Reports that aggregate and sort (Q2, Q4) run as streams. The top-months
report (Q1) ranks with a window over non-time groups and the income report
(Q3) uses a global limit; Structured Streaming supports neither, so those run
as batch jobs over the files received so far.

State and progress live in ``<spark.checkpoint.dir>/streams/<name>`` unless a
location is given, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from blotter.session import checkpoint_root
from blotter.sources.schemas import crime_text_schema


_BATCH_FORMATS = ("parquet", "orc", "json", "csv")


def read_crime_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of the CSV extracts arriving in ``directory``."""
    reader = spark.readStream.schema(crime_text_schema()).option("header", True).option("enforceSchema", True)
    reader = reader.option("escape", '"')  # standard CSV: a doubled quote inside quotes
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.csv(directory)


def start_report(
    report: DataFrame,
    name: str,
    sink: str = "memory",
    checkpoint_location: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    **sink_options,
) -> StreamingQuery:
    """Start a streaming report in complete mode.

    ``sink="memory"`` makes the result queryable as the table ``name`` in
    this session (for tests and notebooks). ``sink="parquet"`` (or another
    batch format) rewrites the whole report at ``sink_options["path"]`` after
    every micro-batch, since file sinks cannot take complete output; the
    overwrite is idempotent, so a replayed batch gives the same table. Any
    other streaming sink format is used directly with ``sink_options``.
    """
    spark = report.sparkSession
    # The stable root, not the per-session subfolder: a restarted application
    # must find the same offsets and state to resume.
    location = checkpoint_location or f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"
    writer = report.writeStream.outputMode("complete").option("checkpointLocation", location)
    if sink == "memory":
        writer = writer.format("memory").queryName(name)
    elif sink in _BATCH_FORMATS:
        options = dict(sink_options)
        path = options.pop("path")

        def rewrite(batch: DataFrame, _batch_id: int) -> None:
            batch.write.mode("overwrite").format(sink).options(**options).save(path)

        writer = writer.foreachBatch(rewrite).queryName(name)
    else:
        writer = writer.format(sink).options(**sink_options)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
