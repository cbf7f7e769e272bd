"""Extraction and cleaning of postings on a stream of pages.

Extraction (E-operators) and cleaning (C1-C3, C8) are stateless row
expressions, so the same operators run unchanged on a streaming DataFrame:
each micro-batch of new page files becomes posting rows.  No state store is
involved; the checkpoint only records which files were processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean, extract
from ..operators.partitioning import compute_once

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("html", T.StringType(), True),
])


def read_pages_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Pages arriving as files in ``source_dir`` (schema fixed, no inference)."""
    reader = spark.readStream.schema(PAGES_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def postings_stream(pages: DataFrame, cleaned: bool = True, **params) -> DataFrame:
    """Posting rows (optionally cleaned) for every page of the stream; each page is read once."""
    out = extract.extract_postings(pages, **params)
    return clean.clean_postings(compute_once(out)) if cleaned else out


def _start(rows: DataFrame, out_dir: str, checkpoint: str, fmt: str,
           available_now: bool) -> StreamingQuery:
    writer = (rows.writeStream.format(fmt).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(out_dir)


def default_checkpoint(out_dir: str) -> str:
    """The checkpoint that belongs to an output folder: readers skip its name."""
    return f"{out_dir.rstrip('/')}/_checkpoint"


def start_postings_stream(spark: SparkSession, source_dir: str, out_dir: str,
                          checkpoint: str | None = None, available_now: bool = True,
                          fmt: str = "parquet", source_fmt: str = "parquet",
                          max_files_per_trigger: int | None = None, **params) -> StreamingQuery:
    """Write postings of newly arriving pages to ``out_dir`` (cleaned unless ``cleaned=False``).

    The checkpoint stands in the output folder unless given, so a query that
    is started again on the same folder goes on where it stopped: files that
    came meanwhile are read, files already read are not (exactly-once sink).
    """
    pages = read_pages_stream(spark, source_dir, source_fmt, max_files_per_trigger)
    return _start(postings_stream(pages, **params), out_dir,
                  checkpoint or default_checkpoint(out_dir), fmt, available_now)


def start_rejects_stream(spark: SparkSession, source_dir: str, out_dir: str,
                         checkpoint: str | None = None, available_now: bool = True,
                         fmt: str = "parquet", source_fmt: str = "parquet",
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Write the pages that give no posting row to ``out_dir``, with the reason."""
    pages = read_pages_stream(spark, source_dir, source_fmt, max_files_per_trigger)
    return _start(extract.rejected_pages(pages), out_dir,
                  checkpoint or default_checkpoint(out_dir), fmt, available_now)
