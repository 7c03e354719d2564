"""Parents followed by their related records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dropweave.functions import csvtext
from dropweave.functions.registry import Registry
from dropweave.operators.filters import why_left_out
from dropweave.operators.keyjoin import join_by_key
from dropweave.operators.ordering import key_offsets, place_in_group, with_bucket
from dropweave.session import BROADCAST_ROWS, stage
from dropweave.sinks import ZONES

ZONE_FILES = 1000
GROUP_ORDER = ("key", "type_rank", "source_file", "line_no")
_COLUMNS = ("key", "type_rank", "source_file", "line_no", "record_type", "value")


def _ranked(lines: DataFrame, ids: tuple[str, ...], first_rank: int = 0) -> DataFrame:
    """Keyed lines of several types in one scan, ranked by their place in ``ids``.

    Lines stay raw text, so types of different width share one table.
    """
    of_type = F.col("record_type")
    if "family" in lines.columns:
        lines = lines.filter(F.col("family").isin(list(ids)))
    rank = F.when(of_type == ids[0], F.lit(first_rank))
    for place, record_id in enumerate(ids[1:], first_rank + 1):
        rank = rank.when(of_type == record_id, F.lit(place))
    return (lines.filter(of_type.isin(list(ids)) & F.col("key").isNotNull())
            .withColumn("type_rank", rank).select(*_COLUMNS))


def envelope(lines: DataFrame, parent: str, children: tuple[str, ...],
             limit_per_key: int | None = None) -> DataFrame:
    """Parent lines (rank 0) and child lines (ranks 1, 2, ...) in one table.

    With a limit, only the first lines per child type and key.  Spark applies a rank filter
    map-side as well, so a frequent key shrinks before the shuffle; for limits it does not do
    that for, rows are placed without a window.
    """
    if limit_per_key is None:
        return _ranked(lines, (parent, *children))
    limited = _ranked(lines, children, 1)
    group, order = ["type_rank", "key"], ["source_file", "line_no"]
    if limit_per_key <= int(lines.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        limited = limited.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    else:
        limited = place_in_group(limited, group, order, "_n").withColumn("_n", F.col("_n") + 1)
    return _ranked(lines, (parent,)).unionByName(limited.filter(F.col("_n") <= limit_per_key).drop("_n"))


def parent_keys(lines: DataFrame, parent: str) -> DataFrame:
    """The distinct parent keys, staged.

    Deduplicated map-side first, so a frequent key arrives as one row.  Being a table of
    their own, they are broadcast only if their files are small; otherwise ``join_by_key`` deals
    the rows of frequent keys over several tasks.
    """
    return stage(_ranked(lines, (parent,)).select("key").distinct(), "keys")


def group_by_key(lines: DataFrame, parent: str, children: tuple[str, ...],
                 limit_per_key: int | None = None) -> DataFrame:
    """Every parent line and every child line whose key has a parent, each exactly once.

    A semi-join against the distinct parent keys, so rows never multiply.  To be read in
    ``GROUP_ORDER``.
    """
    rows = envelope(lines, parent, children, limit_per_key)
    return join_by_key(rows, parent_keys(lines, parent), "left_semi")


def group_in_chunks(lines: DataFrame, parent: str, children: tuple[str, ...], parents_per_chunk: int,
                    limit_per_key: int | None = None) -> DataFrame:
    """``group_by_key`` with the output chunk of each row.

    A chunk closes after ``parents_per_chunk`` parents, never inside a group.
    """
    offsets = key_offsets(_ranked(lines, (parent,)))
    return with_bucket(envelope(lines, parent, children, limit_per_key), offsets, parents_per_chunk)


def orphans(lines: DataFrame, parent: str, children: tuple[str, ...]) -> DataFrame:
    """Child lines with a key no parent has."""
    return join_by_key(_ranked(lines, children, 1), parent_keys(lines, parent), "left_anti")


def rejects(lines: DataFrame, registry: Registry, parent: str, children: tuple[str, ...]) -> DataFrame:
    """Lines that do not take part in the groups or in typed output, one row per reason.

    Control lines, types the registry does not declare, declared types that are not asked for, keys that
    are no numbers and children without a parent are in no group; corrupt lines are, but have no typed row.  One pass:
    each line is parsed once, by its own type, and joined with the parent keys once.
    """
    ids = (parent, *children)
    of_type, no_key = F.col("record_type"), F.col("key").isNull()
    corrupt = F.lit(False)
    for record_id in ids:
        # Not expanded into columns: a declared field may be called like one of ours.
        parsed = csvtext.parse_line(F.col("value"), registry[record_id])
        corrupt = F.when(of_type == record_id, parsed[csvtext.CORRUPT].isNotNull()).otherwise(corrupt)
    reasons = F.array_compact(F.array(
        why_left_out(of_type, registry.ids, ids),
        F.when(of_type.isin(list(ids)) & no_key, F.lit("bad_key")),
        F.when(of_type.isin(list(children)) & ~no_key & F.col("has_parent").isNull(), F.lit("orphan")),
        F.when(of_type.isin(list(ids)) & ~no_key & corrupt, F.lit("corrupt"))))
    keys = stage(_ranked(lines, (parent,)).select("key").distinct().withColumn("has_parent", F.lit(True)), "keys")
    return join_by_key(lines, keys, "left").select(
        F.explode(reasons).alias("reason"), "source_file", "line_no", "record_type", "value")


def _nested(rows: DataFrame, children: tuple[str, ...]) -> DataFrame:
    line = F.struct("source_file", "line_no", "value")
    arrays = [F.array_sort(F.collect_list(F.when(F.col("type_rank") == rank, line))).alias(name)
              for rank, name in enumerate(("parents", *(f"type_{c}" for c in children)))]
    return rows.groupBy("key", "segment").agg(*arrays)


def nest_by_key(lines: DataFrame, parent: str, children: tuple[str, ...], max_rows: int) -> DataFrame:
    """Groups as rows: ``(key, segment, parents, <one array per child type>)``.

    One row per key and segment.  A segment holds ``max_rows`` lines of the group in group order, the last
    one the rest, so no array grows with the data and none of its lines is lost.  Array elements are
    ``(source_file, line_no, value)`` in line order.

    Large keys are taken out before the shuffle that joins and nests the others, and are
    shuffled by segment instead of by key.
    """
    rows = envelope(lines, parent, children)
    keys = parent_keys(lines, parent)
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
    large = stage(sizes.filter(F.col("n") > max_rows).select("key").join(keys, "key", "left_semi"), "large")
    n_large = large.count()
    segment = F.expr(f"_place div {int(max_rows)}")
    if n_large > BROADCAST_ROWS:
        placed = place_in_group(rows.join(keys, "key", "left_semi"), ["key"], list(GROUP_ORDER[1:]), "_place")
        return _nested(placed.withColumn("segment", segment).repartition("key", "segment"), children)
    first = F.lit(0).cast("bigint")
    if not n_large:
        return _nested(rows.join(keys, "key", "left_semi").withColumn("segment", first), children)
    others = rows.join(F.broadcast(large), "key", "left_anti").join(keys, "key", "left_semi")
    placed = place_in_group(
        rows.join(F.broadcast(large), "key", "left_semi"), ["key"], list(GROUP_ORDER[1:]), "_place")
    return _nested(others.withColumn("segment", first), children).unionByName(
        _nested(placed.withColumn("segment", segment).repartition("key", "segment"), children))


def lookup(rows: DataFrame, key: int) -> DataFrame:
    """Rows of one key; the comparison reaches the Parquet scan."""
    return rows.filter(F.col("key") == key)


def lookup_colocated(rows: DataFrame, offsets: DataFrame, rows_per_bucket: int, key: int) -> DataFrame:
    """Rows of one key of a table written by ``colocate``: opens the directory of its bucket only, sorted by key inside.

    ``offsets`` are the ``key_offsets`` the buckets were made from.
    """
    found = lookup(offsets, key).select(F.expr(f"first_index div {int(rows_per_bucket)}").alias("bucket")).first()
    return lookup(rows.filter(F.col("bucket") == (found.bucket if found else -1)), key)


def lookup_stored(spark: SparkSession, path: str, key: int) -> DataFrame:
    """Rows of one key of a table that ``write_colocated`` left under a path, found by its stored zones.

    Opens the files of one bucket whose keys span the key (all files of the bucket if there are more than ``ZONE_FILES``).
    """
    zones = spark.read.parquet(f"{path}/{ZONES}").filter(F.lit(key).between(F.col("first_key"), F.col("last_key")))
    found = zones.select("bucket", "file").limit(ZONE_FILES + 1).collect()
    rows = spark.read.parquet(path)
    rows = rows.filter(F.col("bucket").isin(sorted({r.bucket for r in found})))  # none: no file is opened
    if found and len(found) <= ZONE_FILES:
        rows = rows.filter(F.col("_metadata.file_name").isin([r.file for r in found]))
    return lookup(rows, key)


def lookup_many(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is in ``keys``; broadcast only if the distinct keys turn out small."""
    wanted = stage(keys.select("key").filter(F.col("key").isNotNull()).distinct(), "keys")
    return join_by_key(rows, wanted, "left_semi")
