"""CSV export of the event table: a header and the eight message columns.

Values are read as text and turned into numbers by the same rule as messages. A header that
differs from the declared columns is an error; a row that does not fit is set aside with its
whole text. Line breaks within quotes need ``multi_line``, which reads a file in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmetrics.functions.values import not_a_number, text_to_double
from jobmetrics.schemas import MESSAGE_FIELDS, MESSAGE_NUMBERS

REJECT = "_rejected"


def _read(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    layout = ", ".join(f"{name} STRING" for name in [*MESSAGE_FIELDS, REJECT])
    return (
        spark.read.schema(layout)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", REJECT)
        .csv(path)
    )


def _fits() -> Column:
    # The reader notices a missing or surplus value only in columns it has to parse, so the
    # condition mentions all of them, whatever the caller selects.
    all_parsed = F.length(F.concat_ws("", *MESSAGE_FIELDS)) >= 0
    bad_number = reduce(lambda a, b: a | b, [not_a_number(F.col(n)) for n in MESSAGE_NUMBERS])
    return F.col(REJECT).isNull() & all_parsed & ~bad_number


def csv_load(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The rows that fit, typed."""
    rows = _read(spark, path, multi_line).filter(_fits())
    typed = {name: text_to_double(F.col(name)) for name in MESSAGE_NUMBERS}
    return rows.withColumns(typed).select(*MESSAGE_FIELDS)


def csv_rejects(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The rows that do not, as text: ``raw`` is the record, also with values too many.

    Of a record that has the right number of values but not the right kind, it is put together
    from its values.
    """
    rows = _read(spark, path, multi_line).filter(~_fits())
    values = F.to_csv(F.struct(*MESSAGE_FIELDS))
    return rows.select(*MESSAGE_FIELDS, F.coalesce(F.col(REJECT), values).alias("raw"))
