"""Sorting, exact row numbers over sorted data, and keeping equal keys together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropweave.functions import csvtext
from dropweave.functions.registry import RecordType
from dropweave.operators.filters import keep_types, with_type
from dropweave.operators.keyjoin import join_by_key
from dropweave.session import stage
from dropweave.sources.typed import parse_type

LINE_ORDER = ("source_file", "line_no")


def global_sort(lines: DataFrame, record_type: RecordType, field: str = "UPRN", as_text: bool = False,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows of one type in the order of a field, NULL first, ties in line order.

    Ties are part of the sort key, so the range partitioning can cut through a key that
    holds very many rows.  When the field is the record key, lines are sorted on the landed
    key and parsed afterwards, so that the sampling pass does not parse them too.
    """
    if field not in record_type.field_names:
        raise ValueError(f"record type {record_type.id} has no field {field!r}")
    def order(column: str) -> list[Column]:
        by = F.col(column).cast("string") if as_text else F.col(column)
        return [by.asc_nulls_first(), *LINE_ORDER]
    if field == record_type.key_field and "key" in lines.columns:
        return parse_type(with_type(lines, record_type.id).sort(*order("key")), record_type, keep)
    kept = tuple(dict.fromkeys((*keep, *LINE_ORDER)))
    parsed = parse_type(lines, record_type, kept).sort(*order(field))
    return parsed.drop(*[c for c in kept if c not in keep])


def sort_types(lines: DataFrame, record_types: list[RecordType], field: str = "UPRN",
               keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """``global_sort`` for several types by the same field; all are checked before any runs."""
    missing = [t.id for t in record_types if field not in t.field_names]
    if missing:
        raise ValueError(f"field {field!r} is missing in record type(s) {', '.join(missing)}")
    return {t.id: global_sort(lines, t, field, keep=keep) for t in record_types}


def _shown(record_type: RecordType, field: str) -> Callable[[Column], Column]:
    """From a parsed line to the field it is sorted by, its text, and whether it fits."""
    def columns(parsed: Column) -> Column:
        text = F.to_csv(F.struct(*(parsed[n].alias(n) for n in record_type.field_names)), csvtext.WRITE_OPTIONS)
        return F.struct(parsed[field].alias("order"), text.alias("text"), parsed[csvtext.CORRUPT].isNotNull().alias("corrupt"))
    return columns


def sort_together(lines: DataFrame, record_types: list[RecordType], field: str = "UPRN") -> DataFrame:
    """Lines of several types in one range partitioning: by type in the given order, then a field (NULL first), then line order.

    ``(record_type, value, text, corrupt)``: the line as it is, its typed fields as CSV, and whether it does not fit.  Every line is
    parsed once, by its own type.  One sample and one shuffle serve all types, and a type or key with most rows is cut over
    partitions.  If the field is the key of all types, lines are sorted by the landed key and parsed afterwards.
    """
    missing = [t.id for t in record_types if field not in t.field_names]
    if missing:
        raise ValueError(f"field {field!r} is missing in record type(s) {', '.join(missing)}")
    kinds = {t.schema[field].dataType.simpleString() for t in record_types}
    if len(kinds) > 1:
        raise ValueError(f"field {field!r} has different types: {', '.join(sorted(kinds))}")
    of_type, rank, told = F.col("record_type"), F.lit(None).cast("int"), None
    for place, kind in enumerate(record_types):
        rank = F.when(of_type == kind.id, F.lit(place)).otherwise(rank)
        # Bound by a lambda, so that the line is parsed once for all its columns.
        parsed = F.get(F.transform(F.array(csvtext.parse_line(F.col("value"), kind)), _shown(kind, field)), 0)
        told = F.when(of_type == kind.id, parsed) if told is None else told.when(of_type == kind.id, parsed)
    rows = keep_types(lines, [t.id for t in record_types]).withColumn("_rank", rank)
    by_key = "key" in lines.columns and all(t.key_field == field for t in record_types)
    if not by_key:
        rows = rows.select("*", F.inline(F.array(told)))
    order = ["_rank", F.col("key" if by_key else "order").asc_nulls_first(), *LINE_ORDER]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    if by_key:
        rows = rows.select("record_type", "value", F.inline(F.array(told)))
    return rows.select("record_type", "value", "text", "corrupt")


def _sorted_slots(rows: DataFrame, order: list) -> DataFrame:
    """Rows in range-partitioned order, staged with their slot: partition number and place in it."""
    return stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()), "sorted")


def _slot_part() -> Column:
    return F.shiftright("_slot", 33)


def _shift_by_part(slots: DataFrame, weight: Column) -> DataFrame:
    """What all earlier partitions add up to: one row per partition of the sort."""
    sums = slots.groupBy(_slot_part().alias("_part")).agg(F.sum(weight).alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # As long as the number of partitions, so a single window and a broadcast are safe.
    return sums.select("_part", F.coalesce(before, F.lit(0)).alias("_shift"))


def global_index(rows: DataFrame, *order: str, name: str = "row_index") -> DataFrame:
    """Add the exact 0-based position of each row in the whole order.

    ``order`` has to be unique per row.  No window ever holds more than the list of sort
    partitions.
    """
    slots = _sorted_slots(rows, list(order))
    shift = _shift_by_part(slots, F.lit(1))
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (slots.withColumn("_part", _slot_part()).join(F.broadcast(shift), "_part")
            .withColumn(name, in_part + F.col("_shift")).drop("_slot", "_part", "_shift"))


def place_in_group(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add each row's 0-based place among the rows with the same ``keys``.

    For groups of any size: the place is the row's index in the whole order minus the first
    index of its group, so no window and no task has to hold a group.
    """
    indexed = global_index(rows, *keys, *order, name="_index")
    starts = stage(indexed.groupBy(*keys).agg(F.min("_index").alias("_start")), "starts")
    return (indexed.join(starts, keys).withColumn(name, F.col("_index") - F.col("_start"))
            .drop("_index", "_start"))


def key_offsets(rows: DataFrame, key: str = "key") -> DataFrame:
    """``(key, n, first_index)``: rows per key, and rows before the key in key order.

    Counting comes first and is done map-side, so a key that holds a third of the rows is
    one row from then on.  The result is a staged table with one row per key.
    """
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    slots = _sorted_slots(counts, [key])
    shift = _shift_by_part(slots, F.col("n"))
    earlier = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return stage(
        slots.withColumn("_part", _slot_part()).join(F.broadcast(shift), "_part")
        .select(key, "n", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + F.col("_shift")).alias("first_index")),
        "offsets")


def with_bucket(rows: DataFrame, offsets: DataFrame, size: int, key: str = "key",
                name: str = "chunk") -> DataFrame:
    """Rows of the keys in ``offsets``, with the bucket their key belongs to.

    A bucket takes the keys whose first index falls in it, so a key is never cut.
    """
    if size < 1:
        raise ValueError("bucket size must be at least 1")
    buckets = offsets.select(key, F.expr(f"first_index div {int(size)}").alias(name))
    return join_by_key(rows, buckets, key=key)


def colocate(rows: DataFrame, rows_per_bucket: int, key: str = "key", offsets: DataFrame | None = None) -> DataFrame:
    """Rows in key order with a ``bucket``; all rows of a key are in one bucket.

    Written with ``partitionBy("bucket")`` this gives one directory per key range.  A very
    frequent key makes its bucket large but not its tasks: they are cut on the line order.
    Rows without a key are left out.  ``offsets`` are the rows' ``key_offsets``, if they are known.
    """
    bucketed = with_bucket(rows, offsets or key_offsets(rows, key), rows_per_bucket, key, "bucket")
    order = ["bucket", key, *LINE_ORDER]
    return bucketed.repartitionByRange(*order).sortWithinPartitions(*order)
