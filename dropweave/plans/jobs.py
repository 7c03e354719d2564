"""The steps from a folder of drops to grouped files.  Each one reads, writes and returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave import sinks, versions
from dropweave.functions.csvtext import CORRUPT
from dropweave.functions.registry import (
    LOCATION_IDS, UPRN_CHILDREN, UPRN_CHUNK, UPRN_PARENT, USRN_CHILDREN, USRN_CHUNK, USRN_PARENT, Registry)
from dropweave.operators import counts, filters, grouping, ordering
from dropweave.session import input_bytes, size_shuffles, stage
from dropweave.sources.archives import list_members, member_files, read_zip
from dropweave.sources.lines import TEXT_FILES, land, list_files, number_lines, read_landed, read_lines
from dropweave.sources.records import assemble_records
from dropweave.sources.typed import bad_rows, good_rows, parse_type

MANIFEST = "source_file STRING, record_type STRING, n BIGINT"


def list_drop(spark: SparkSession, path: str, source: str = "file", glob: str = TEXT_FILES) -> DataFrame:
    """``(source_file, part)`` of all text files and of all members of zip files."""
    return list_files(spark, path, source, glob).unionByName(member_files(list_members(spark, path)))


def scan_drop(spark: SparkSession, path: str, source: str = "file", glob: str = TEXT_FILES,
              keep_cr: bool = False, only: DataFrame | None = None) -> DataFrame:
    """Lines of plain, gzip and zip files together.  ``only`` (``source_file``) names the drops to read; no other is opened."""
    return read_lines(spark, path, source, glob, keep_cr, only).unionByName(read_zip(spark, path, keep_cr, only))


def prepare(spark: SparkSession, path: str, registry: Registry, landed: str | None = None,
            scan_mode: str = "line", source: str = "file", glob: str = TEXT_FILES,
            compact: bool = True, manifest: str | None = None, types: Sequence[str] | None = None) -> DataFrame:
    """Land a drop and number its lines: the input of all later steps.

    ``scan_mode`` is ``line`` (every line is a record) or ``record`` (line ends inside
    quotes do not count).  ``compact`` evens out the landed files; without it every split writes one per type.
    With ``manifest`` (what ``count_all`` keeps) and ``types``, only files that hold a line of these types are opened; line numbers are
    those of the whole files.
    """
    if scan_mode not in ("line", "record"):
        raise ValueError(f"scan_mode must be 'line' or 'record', not {scan_mode!r}")
    if (manifest is None) != (types is None):
        raise ValueError("manifest and types go together")
    only = None if manifest is None else counts.files_for_types(read_manifest(spark, manifest), types)
    size_shuffles(spark, input_bytes(spark, path))
    lines = scan_drop(spark, path, source, glob, scan_mode == "record", only)
    if scan_mode == "record":
        return land(assemble_records(lines), registry, landed, compact)
    return number_lines(land(lines, registry, landed, compact), with_total=True)


def reopen(spark: SparkSession, landed: str, scan_mode: str = "line") -> DataFrame:
    """Lines of a table ``prepare`` landed earlier."""
    size_shuffles(spark, input_bytes(spark, landed))
    table = read_landed(spark, landed, records=scan_mode == "record")
    return table if scan_mode == "record" else number_lines(table, with_total=True)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete manifest under a path: ``(source_file, record_type, n)``, empty if there is none yet."""
    current = versions.newest(spark, path)
    return spark.read.schema(MANIFEST).parquet(current) if current else spark.createDataFrame([], MANIFEST)


def count_all(spark: SparkSession, path: str, manifest_path: str, source: str = "file",
              glob: str = TEXT_FILES) -> DataFrame:
    """Bring the manifest up to date; only files it does not have yet are read.

    The new manifest is a folder of its own, which counts from the moment it is whole: a job that fails leaves the old one in force.
    """
    files = stage(list_drop(spark, path, source, glob), "files")
    old = read_manifest(spark, manifest_path)
    pending = stage(files.join(counts.pending_files(files, old), "source_file", "left_semi"), "pending")
    # In a first count every file is pending, and nothing needs to be told apart.
    only = None if pending.count() == files.count() else pending
    new = counts.manifest(counts.count_records(scan_drop(spark, path, source, glob, only=only)), pending)
    versions.write(counts.refresh_manifest(old, new, files), manifest_path)
    return read_manifest(spark, manifest_path)


def _data_lines(lines: DataFrame, ids: tuple[str, ...], trim: str) -> DataFrame:
    """Lines of the wanted types; ``trim`` says how control lines are told apart."""
    if trim == "position":
        lines = filters.positional_trim(lines)
    elif trim != "type":
        raise ValueError(f"trim must be 'type' or 'position', not {trim!r}")
    return filters.keep_types(lines, ids)


def _write_left_out(lines: DataFrame, registry: Registry, ids: tuple[str, ...], rejects: str | None, mode: str) -> None:
    if rejects:
        filters.left_out(lines, registry.ids, ids).write.mode(mode).partitionBy("reason").parquet(rejects)


def split_all(lines: DataFrame, out: str, registry: Registry, ids: tuple[str, ...] = LOCATION_IDS,
              include_headers: bool = False, trim: str = "type", mode: str = "errorifexists",
              rejects: str | None = None) -> None:
    """Lines by file and type.  Lines of other types go to ``rejects`` with a reason, if it is given."""
    _write_left_out(lines, registry, ids, rejects, mode)
    sinks.write_split(_data_lines(lines, ids, trim), out, registry, include_headers, mode)


def merge_all(lines: DataFrame, out: str, registry: Registry, ids: tuple[str, ...] = LOCATION_IDS,
              prefix: str = "Records_", include_headers: bool = False, trim: str = "type",
              mode: str = "errorifexists", rejects: str | None = None) -> None:
    """Lines of all files by type.  Lines of other types go to ``rejects`` with a reason, if it is given."""
    _write_left_out(lines, registry, ids, rejects, mode)
    sinks.write_merged(_data_lines(lines, ids, trim), out, registry, prefix, include_headers, mode)


def sort_records(lines: DataFrame, out: str, registry: Registry, ids: tuple[str, ...], field: str = "UPRN",
                 prefix: str = "Records_", header: bool = False, rejects: str | None = None,
                 mode: str = "errorifexists") -> None:
    """One folder of sorted CSV files per type.

    Every line of a type is in its output: fields that do not fit are empty there.  With ``rejects``, lines that
    do not fit go there instead, as they are.  All types share one sort and one write; with a header, or a field that is not of one
    type everywhere, each type has its own.
    """
    types = [registry[i] for i in ids]
    names = {t.id: f"{prefix}{t.name}" for t in types}
    if not header and len({t.schema[field].dataType for t in types if field in t.field_names}) == 1:
        sinks.write_sorted(ordering.sort_together(lines, types, field), out, names, rejects, mode)
        return
    for record_id, typed in ordering.sort_types(lines, types, field).items():
        sinks.write_table(good_rows(typed) if rejects else typed.drop(CORRUPT), f"{out}/{names[record_id]}", header, mode)
        if rejects:
            bad = bad_rows(parse_type(lines, registry[record_id]))
            bad.select(CORRUPT).write.mode(mode).text(f"{rejects}/{names[record_id]}")


def _group(lines, out, registry, parent, children, size, limit_per_key, rejects, mode) -> None:
    sinks.write_chunks(grouping.group_in_chunks(lines, parent, children, size, limit_per_key), out, mode)
    if rejects:
        grouping.rejects(lines, registry, parent, children).write.mode(mode).partitionBy("reason").parquet(rejects)


def group_uprn(lines: DataFrame, out: str, registry: Registry, size: int = UPRN_CHUNK,
               rejects: str | None = None, mode: str = "errorifexists") -> None:
    """Properties, each followed by its related records."""
    _group(lines, out, registry, UPRN_PARENT, UPRN_CHILDREN, size, None, rejects, mode)


def group_usrn(lines: DataFrame, out: str, registry: Registry, size: int = USRN_CHUNK,
               limit_per_key: int | None = None, rejects: str | None = None,
               mode: str = "errorifexists") -> None:
    """Streets, each followed by its descriptors, or the first ``limit_per_key`` of them."""
    _group(lines, out, registry, USRN_PARENT, USRN_CHILDREN, size, limit_per_key, rejects, mode)
