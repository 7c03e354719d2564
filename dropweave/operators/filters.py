"""Which lines to keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropweave.functions import csvtext
from dropweave.functions.registry import CONTROL_IDS, LOCATION_IDS


def _record_type(lines: DataFrame):
    return F.col("record_type") if "record_type" in lines.columns else csvtext.record_type_of(F.col("value"))


def _narrow(lines: DataFrame, ids) -> DataFrame:
    """On a landed table, let the scan open only the directories of these data types."""
    if "family" not in lines.columns:
        return lines
    return lines.filter(F.col("family").isin([*ids, "other"]))


def with_type(lines: DataFrame, record_id: str) -> DataFrame:
    return _narrow(lines, [record_id]).filter(_record_type(lines) == record_id)


def keep_types(lines: DataFrame, ids=LOCATION_IDS) -> DataFrame:
    return _narrow(lines, ids).filter(_record_type(lines).isin(list(ids)))


def drop_control(lines: DataFrame, ids=CONTROL_IDS) -> DataFrame:
    """Leave out control lines by their type; fine when a file has none."""
    return lines.filter(~_record_type(lines).isin(list(ids)))


def why_left_out(record_type: Column, known: Sequence[str], wanted: Sequence[str]) -> Column:
    """Why a job on the types ``wanted`` leaves a line out; null if it does not."""
    return (F.when(record_type.isin(list(wanted)), F.lit(None))
            .when(record_type.isin(list(CONTROL_IDS)), F.lit("control"))
            .when(record_type.isin(list(known)), F.lit("not_requested")).otherwise(F.lit("unknown_type")))


def left_out(lines: DataFrame, known: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """The lines ``keep_types`` drops, with the reason.  ``known`` are the declared types."""
    rows = lines.withColumn("record_type", _record_type(lines))
    reason = why_left_out(F.col("record_type"), known, wanted)
    return rows.withColumn("reason", reason).filter("reason IS NOT NULL").select(
        "reason", "source_file", "line_no", "record_type", "value")


def positional_trim(numbered: DataFrame, first: int = 1, last: int = 2) -> DataFrame:
    """Leave out the first and the last lines of each source, whatever they hold.

    Needs ``number_lines(..., with_total=True)``.
    """
    if "n_lines" not in numbered.columns:
        raise ValueError("a trim by position needs numbered lines with their total, not assembled records")
    return numbered.filter((F.col("line_no") >= first) & (F.col("line_no") < F.col("n_lines") - last))
