"""Writing results.  Nothing is overwritten unless ``mode`` says so."""

from __future__ import annotations

import uuid
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave.functions import csvtext
from dropweave.functions.registry import Registry

_HEADER_LINE_NO = -1
ZONES = "_index/zones"


def _write_ordered(rows: DataFrame, path: str, directory: str, order: list[str], mode: str) -> None:
    """One directory per value of ``directory``; part files in name order are in ``order``.

    The whole order is in the range partitioning, so a directory that holds most of the
    rows is written by many tasks.
    """
    by = [directory, *order]
    (rows.repartitionByRange(*by).sortWithinPartitions(*by).select(directory, "value")
     .write.mode(mode).partitionBy(directory).text(path))


def _header_lines(pairs: DataFrame, registry: Registry) -> DataFrame:
    """A header line in front of each ``(source_file, record_type)`` in ``pairs``."""
    headers = F.create_map(*chain.from_iterable(
        (F.lit(t.id), F.lit(csvtext.header_line(t))) for t in registry))
    return pairs.select("source_file", "record_type", F.lit(_HEADER_LINE_NO).cast("bigint").alias("line_no"),
                        headers[F.col("record_type")].alias("value"))


def write_split(lines: DataFrame, path: str, registry: Registry, include_headers: bool = False,
                mode: str = "errorifexists") -> None:
    """Lines by file and type: ``split_file=<name>_r<type>.csv/``."""
    rows = lines.select("source_file", "record_type", "line_no", "value")
    if include_headers:
        rows = rows.unionByName(_header_lines(rows.select("source_file", "record_type").distinct(), registry))
    named = rows.withColumn("split_file", csvtext.split_name(F.col("source_file"), F.col("record_type")))
    _write_ordered(named, path, "split_file", ["line_no"], mode)


def write_merged(lines: DataFrame, path: str, registry: Registry, prefix: str = "Records_",
                 include_headers: bool = False, mode: str = "errorifexists") -> None:
    """Lines of all files by type, in one pass: ``merged_file=<prefix><name>.csv/``."""
    rows = lines.select("source_file", "record_type", "line_no", "value")
    if include_headers:
        types = rows.select("record_type").distinct().withColumn("source_file", F.lit(""))
        rows = rows.unionByName(_header_lines(types, registry))
    names = F.create_map(*chain.from_iterable(
        (F.lit(t.id), F.lit(csvtext.merged_name(t, prefix))) for t in registry))
    named = rows.withColumn("merged_file", names[F.col("record_type")]).filter("merged_file IS NOT NULL")
    _write_ordered(named, path, "merged_file", ["source_file", "line_no"], mode)


def write_table(typed: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    """A typed table as CSV; NULL and the empty string are both written as nothing."""
    typed.write.mode(mode).options(**csvtext.WRITE_OPTIONS).option("header", header).csv(path)


def _hadoop_path(spark: SparkSession, path: str) -> tuple:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _put_folders(spark: SparkSession, made: str, column: str, wanted: dict[str, str]) -> None:
    """Move the folders ``<column>=<name>`` of a written tree to where they are wanted; a folder nothing was written to is made empty."""
    for name, target in wanted.items():
        (store, place), (_, source) = _hadoop_path(spark, target), _hadoop_path(spark, f"{made}/{column}={name}")
        store.delete(place, True)
        store.mkdirs(place.getParent())
        if not (store.rename(source, place) if store.exists(source) else store.mkdirs(place)):
            raise OSError(f"{source} could not be moved to {target}")


def write_sorted(rows: DataFrame, out: str, names: dict[str, str], rejects: str | None = None, mode: str = "errorifexists") -> None:
    """What ``sort_together`` gives as CSV, one folder for each type (``names`` of record types); part files in name order are sorted.

    With ``rejects``, lines that do not fit go to folders of the same names there, as they are.  One write makes all of it, beside the
    output, and its folders are then moved.
    """
    spark, made = rows.sparkSession, f"{out.rstrip('/')}/_sorting-{uuid.uuid4().hex}"
    wanted = {f"good-{name}": f"{out}/{name}" for name in names.values()}
    if rejects:
        wanted |= {f"bad-{name}": f"{rejects}/{name}" for name in names.values()}
    for name, target in list(wanted.items()):
        store, place = _hadoop_path(spark, target)
        if mode != "overwrite" and store.exists(place):
            if mode != "ignore":
                raise FileExistsError(target)
            del wanted[name]
    kind = F.when(F.col("corrupt") & F.lit(bool(rejects)), F.lit("bad-")).otherwise(F.lit("good-"))
    of_type = F.create_map(*chain.from_iterable((F.lit(i), F.lit(n)) for i, n in names.items()))[F.col("record_type")]
    text = F.when(kind == "bad-", F.col("value")).otherwise(F.col("text"))
    try:
        rows.select(F.concat(kind, of_type).alias("folder"), text.alias("value")).write.partitionBy("folder").text(made)
        _put_folders(spark, made, "folder", wanted)
    finally:
        store, left = _hadoop_path(spark, made)
        store.delete(left, True)


def write_chunks(grouped: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Groups by chunk: ``part_file=part-NNNN.csv/``, each parent followed by its children."""
    named = grouped.withColumn("part_file", csvtext.part_name(F.col("chunk")))
    _write_ordered(named, path, "part_file", ["key", "type_rank", "source_file", "line_no"], mode)


def write_colocated(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows with a ``bucket`` (see ``colocate``) as Parquet, one directory per bucket, and their zones beside them.

    ``_index/zones`` has the smallest and largest key and the rows of every file, so lookups in a later session need nothing but
    the path.  It reads the keys alone, and lies where scans of the table pass over it.
    """
    rows.write.mode(mode).partitionBy("bucket").parquet(path)
    table = rows.sparkSession.read.parquet(path)
    zones = table.select("bucket", F.col("_metadata.file_name").alias("file"), "key").groupBy("bucket", "file").agg(
        F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.count(F.lit(1)).alias("rows"))
    zones.write.mode(mode).parquet(f"{path}/{ZONES}")
