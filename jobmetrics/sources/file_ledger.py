"""Which files of an event table were seen, and of which days they hold events.

A table of files that does not say what arrived when is listed, which reads none of it. Files that are not in the ledger
are new, files of the ledger that are not listed are gone. New files are read once, for the days of their events;
the days of gone ones are known. So the days to compute anew are complete, late events included, and only the
files that hold events of these days have to be read for it.

A file is known by its name, as Spark gives every file it writes a new one.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmetrics.functions.time_uuid import uuid_to_ts
from jobmetrics.sources.tables import Table

LEDGER = "file STRING, days ARRAY<DATE>, newest TIMESTAMP"


def _name(path: Column) -> Column:
    """Listing and reading spell local paths differently."""
    return F.regexp_replace(path, "^file:/+", "/")


def listed(events: DataFrame) -> DataFrame:
    """The files that the table has now; no file is opened."""
    spark = events.sparkSession
    return spark.createDataFrame([(f,) for f in events.inputFiles()], "file STRING").select(_name(F.col("file")).alias("file"))


def described(events: DataFrame) -> DataFrame:
    """Days and newest time of the events in each file."""
    at = uuid_to_ts(F.col("create_time"))
    rows = events.select(_name(F.col("_metadata.file_path")).alias("file"), at.alias("at"))
    return rows.groupBy("file").agg(F.collect_set(F.to_date("at")).alias("days"), F.max("at").alias("newest"))


def compared(events: DataFrame, ledger: DataFrame) -> tuple[list[str], DataFrame]:
    """New files, and the rows of the ledger that stand for files which are gone."""
    now = listed(events)
    new = [r["file"] for r in now.join(ledger, "file", "left_anti").collect()]
    return sorted(new), ledger.join(now, "file", "left_anti")


def read_files(spark: SparkSession, table: Table, events: DataFrame, files: Collection[str]) -> DataFrame:
    """Only some files of the table, with the columns that the whole of it has."""
    if not files:
        return spark.createDataFrame([], events.schema)
    options = {k: v for k, v in table.options.items() if k != "path"}
    reader = spark.read.format(table.format).options(**options).schema(events.schema)
    return reader.option("basePath", table.options["path"]).load(list(files))


def files_with(ledger: DataFrame, days: Collection[date]) -> list[str]:
    """Files of the ledger that hold events of these days."""
    wanted = F.array(*[F.lit(d) for d in days]).cast("array<date>")
    return sorted(r["file"] for r in ledger.filter(F.arrays_overlap("days", wanted)).collect())
