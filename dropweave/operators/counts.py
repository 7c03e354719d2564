"""Counting record types and keeping the manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropweave.functions import csvtext
from dropweave.functions.registry import CONTROL_IDS


def count_records(lines: DataFrame) -> DataFrame:
    """``(source_file, record_type, n)``; counted inside each task before the shuffle."""
    record_type = (F.col("record_type") if "record_type" in lines.columns
                   else csvtext.record_type_of(F.col("value")))
    return lines.groupBy("source_file", record_type.alias("record_type")).agg(F.count("*").alias("n"))


def manifest(counts: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Long-form manifest ``(source_file, record_type, n)``.

    With a file list, a file without a single line gets one row of no type and n = 0, so it
    is known to be done.
    """
    if files is None:
        return counts
    empty = files.select("source_file").distinct().join(counts, "source_file", "left_anti")
    return counts.unionByName(empty.select(
        "source_file", F.lit(None).cast("string").alias("record_type"), F.lit(0).cast("bigint").alias("n")))


def manifest_entries(manifest_rows: DataFrame) -> DataFrame:
    """One row per file: ``counts MAP<STRING, BIGINT>``, types in order.

    Rows are already one per file and type, so an array here is never longer than the number
    of two-character prefixes.
    """
    pairs = F.collect_list(F.when(F.col("record_type").isNotNull(), F.struct("record_type", "n")))
    return manifest_rows.groupBy("source_file").agg(F.map_from_entries(F.sort_array(pairs)).alias("counts"))


def manifest_text(entries: DataFrame) -> DataFrame:
    """Counts as text, ``type:n`` pairs joined by commas."""
    pairs = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return entries.select("source_file", F.array_join(pairs, ",").alias("counts"))


def manifest_json(entries: DataFrame) -> DataFrame:
    """One JSON object per file: ``{"name": ..., "counts": {type: n}}``."""
    return entries.select(F.to_json(F.struct(F.col("source_file").alias("name"), "counts")).alias("value"))


def pending_files(files: DataFrame, manifest_rows: DataFrame) -> DataFrame:
    """Listed files the manifest does not have yet."""
    return files.select("source_file").distinct().join(
        manifest_rows.select("source_file").distinct(), "source_file", "left_anti")


def refresh_manifest(old: DataFrame, new: DataFrame, files: DataFrame) -> DataFrame:
    """Old rows of files still listed, plus the rows of files counted now."""
    listed = files.select("source_file").distinct()
    return old.join(listed, "source_file", "left_semi").unionByName(new)


def data_types_per_file(manifest_rows: DataFrame) -> DataFrame:
    """``(source_file, n_types, mixed)`` over data types; mixed means more than one."""
    data = manifest_rows.filter(~F.col("record_type").isin(list(CONTROL_IDS)))
    n_types = F.count("*")  # the manifest has one row per file and type
    return data.groupBy("source_file").agg(n_types.alias("n_types"), (n_types > 1).alias("mixed"))


def files_for_type(manifest_rows: DataFrame, record_id: str) -> DataFrame:
    """Files worth opening for a type: ``(source_file, n)``."""
    return manifest_rows.filter((F.col("record_type") == record_id) & (F.col("n") > 0)).select("source_file", "n")


def files_for_types(manifest_rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Names of the files that hold a line of any of these types: ``(source_file)``."""
    return manifest_rows.filter(F.col("record_type").isin(list(ids)) & (F.col("n") > 0)).select("source_file").distinct()
