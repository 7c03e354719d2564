"""Typed tables of one record type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave.functions import csvtext
from dropweave.functions.registry import RecordType
from dropweave.operators.filters import with_type


def read_typed(spark: SparkSession, path: str, record_type: RecordType, header: bool = False) -> DataFrame:
    """A file set of one record type under its declared schema, plus ``_corrupt_record``."""
    return (spark.read.schema(csvtext.with_corrupt(record_type.schema)).options(**csvtext.READ_OPTIONS)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", csvtext.CORRUPT)
            .option("header", header).option("enforceSchema", "true").csv(path))


def parse_type(lines: DataFrame, record_type: RecordType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed fields of the lines of one type, plus ``_corrupt_record`` and the ``keep`` columns.

    The struct is unfolded by a generator, which filters are not pushed through: as a plain
    projection a filter on a parsed field would parse every line a second time.
    """
    parsed = csvtext.parse_line(F.col("value"), record_type)
    return with_type(lines, record_type.id).select(*keep, F.inline(F.array(parsed)))


def good_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col(csvtext.CORRUPT).isNull()).drop(csvtext.CORRUPT)


def bad_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col(csvtext.CORRUPT).isNotNull())
