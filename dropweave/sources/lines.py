"""Lines of drop files with their place in the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dropweave.functions import csvtext
from dropweave.functions.registry import CONTROL_IDS, Registry
from dropweave.session import broadcast_if_small, stage, staging_path
from dropweave.sources.listing import walk

LINE_SCHEMA = "source_file STRING, part STRING, block BIGINT, pos BIGINT, value STRING"
RECORD_SCHEMA = "source_file STRING, line_no BIGINT, value STRING"
_LANDED = ", record_type STRING, key BIGINT, family STRING"
TEXT_FILES = "*.{csv,gz}"
PRUNED_FILES = 10_000  # names in a filter


def decoded(path: Column) -> Column:
    """Spark shows file names with blanks and the like as %20; a plus stays a plus."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), plain).otherwise(path)


def _folder_name(path: Column, plain: bool = False) -> Column:
    """Name of the enclosing directory, without the ``column=`` Spark puts in front.  A ``plain`` path is not encoded."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    value = F.substring_index(folder, "=", -1)
    return value if plain else decoded(value)


def root_path(spark: SparkSession, path: str) -> str:
    """The path of a drop folder without scheme, host and trailing slash, as file names under it begin."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(found).toUri().getPath().rstrip("/")


def relative_name(part: Column, root: str, plain: bool = False) -> Column:
    """What identifies a drop file: its path under the root.  A root that is the file itself, or holds wildcards,
    leaves the bare name, or the whole path.  A ``plain`` path is not encoded."""
    path = F.regexp_replace(part if plain else decoded(part), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")
    return (F.when(path == root, F.substring_index(path, "/", -1))
            .when(path.startswith(f"{root}/"), F.substr(path, F.lit(len(root) + 2))).otherwise(path))


def without_cr(text: Column) -> Column:
    return F.when(text.endswith("\r"), F.left(text, F.length(text) - 1)).otherwise(text)


def read_lines(spark: SparkSession, path: str, source: str = "file",
               glob: str = TEXT_FILES, keep_cr: bool = False, only: DataFrame | None = None) -> DataFrame:
    """Scan plain and gzip text: one row per line, with file lineage.

    ``(part, block, pos)`` is the line's place: physical file, start of the file split, and
    a number that rises within the split.  It costs no shuffle.

    ``source`` says what a drop is: one ``file``, known by its path under ``path``, so files of
    equal names in different folders are different drops; a ``directory`` of part files, or the name
    of a partition column (``<column>=<drop>/part-...``, as Spark writes it).  The last is
    the cheaper one of the two kinds of directory, being no work per line.

    ``only`` names the source files to read.  A name is made of nothing but what the file index knows, so up to ``PRUNED_FILES`` names are a
    filter that reaches it: other files are never opened.  A longer list is a semi-join, broadcast if it is small.
    """
    reader = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob)
    if source in ("file", "directory"):
        raw = reader.option("recursiveFileLookup", "true").text(path)
        name = (relative_name(F.col("_metadata.file_path"), root_path(spark, path)) if source == "file"
                else _folder_name(F.col("_metadata.file_path")))
    else:
        raw = reader.schema(f"value STRING, `{source}` STRING").text(path)
        name = F.col(source)
    value = F.col("value") if keep_cr else without_cr(F.col("value"))
    wanted = None if only is None else stage(only.select("source_file").distinct(), "wanted-files")
    few = wanted is not None and wanted.count() <= PRUNED_FILES
    if few:
        raw = raw.filter(name.isin([row.source_file for row in wanted.collect()]))
    lines = raw.select(
        name.alias("source_file"),
        F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        value.alias("value"))
    return lines if wanted is None or few else lines.join(broadcast_if_small(wanted), "source_file", "left_semi")


def list_files(spark: SparkSession, path: str, source: str = "file", glob: str = TEXT_FILES) -> DataFrame:
    """``(source_file, part)`` of every text file, also those with no bytes in them, which no scan shows."""
    if source == "file":
        name = relative_name(F.col("path"), root_path(spark, path), plain=True)
    else:  # Spark encodes the value of a partition column once more
        name = _folder_name(F.col("path"), plain=source == "directory")
    return walk(spark, path, glob).select(name.alias("source_file"), F.col("path").alias("part"))


def land(lines: DataFrame, registry: Registry, path: str | None = None, compact: bool = False) -> DataFrame:
    """Write lines once as Parquet, one directory per known data type, and read them back.

    Every line is kept: control types and unknown ones go to the family ``other``.  The key
    is taken out here so that later reads can skip row groups by it.  No shuffle unless
    ``compact`` asks for evenly sized files, which also splits a type that holds most rows.
    """
    record_type = csvtext.record_type_of(F.col("value"))
    data_ids = [i for i in registry.ids if i not in CONTROL_IDS]
    keyed_ids = [t.id for t in registry if t.key_field]
    path = path or staging_path(lines.sparkSession, "landed")
    rows = lines.select(
        *lines.columns,
        record_type.alias("record_type"),
        F.when(record_type.isin(keyed_ids), csvtext.to_key(csvtext.field_at(F.col("value"), 3))).alias("key"),
        F.when(record_type.isin(data_ids), record_type).otherwise(F.lit("other")).alias("family"))
    if compact:
        rows = rows.hint("rebalance", "family")
    rows.write.partitionBy("family").parquet(path)
    return lines.sparkSession.read.schema(rows.schema).parquet(path)


def read_landed(spark: SparkSession, path: str, records: bool = False) -> DataFrame:
    """A table ``land`` wrote, from lines or from assembled records."""
    return spark.read.schema((RECORD_SCHEMA if records else LINE_SCHEMA) + _LANDED).parquet(path)


def number_lines(landed: DataFrame, with_total: bool = False) -> DataFrame:
    """Replace the place columns by ``line_no``, counted from 0 in each source.

    Works on file splits, not on whole files: count each split, add up the splits of a
    source in order, add the sum to the place within the split.  Only the table of splits
    goes through a window, so one huge file is spread over as many tasks as any other data.
    Needs a landed table, because a second raw scan might be cut differently.
    """
    splits = landed.groupBy("source_file", "part", "block").agg(
        F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    # Part numbers outgrow their zero padding, so shorter names come first.
    in_order = Window.partitionBy("source_file").orderBy(F.length("part"), "part", "block")
    before = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(Window.partitionBy("source_file"))
    offsets = broadcast_if_small(stage(
        splits.select("source_file", "part", "block",
                      (F.coalesce(before, F.lit(0)) - F.col("first_pos")).alias("shift"),
                      total.alias("n_lines")),
        "splits"))
    rest = [c for c in landed.columns if c not in ("source_file", "part", "block", "pos")]
    return landed.drop("source_file").join(offsets, ["part", "block"]).select(
        "source_file", (F.col("pos") + F.col("shift")).alias("line_no"),
        *(["n_lines"] if with_total else []), *rest)
