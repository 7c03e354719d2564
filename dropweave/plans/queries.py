"""Every operator as a query over the given tables, encoded as a drop."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave import sinks
from dropweave.functions import csvtext
from dropweave.functions.registry import LOCATION_IDS
from dropweave.operators import counts, filters, grouping, ordering
from dropweave.plans import jobs, sample
from dropweave.plans.sample import PART_FILES, SAMPLE, landed_lines, raw_lines, sample_lines, table
from dropweave.session import staging_path
from dropweave.sources.archives import read_zip
from dropweave.sources.lines import land, list_files, number_lines, read_lines
from dropweave.sources.records import assemble_records
from dropweave.sources.typed import good_rows, parse_type, read_typed

LOOKUP_KEY = 7
PARENTS_PER_CHUNK = 500
STREETS_PER_CHUNK = 5
ROWS_PER_BUCKET = 10_000
ROWS_PER_SEGMENT = 4
UPRN = ("21", ("24", "28"))
USRN = ("11", ("15",))
# Streets have keys 0-24, so most orders and events have no parent here.
GAPPED = ("11", ("24", "28"))

Query = Callable[[SparkSession, str], DataFrame]


def _serial():
    return csvtext.to_key(csvtext.field_at(F.col("value"), 2)).alias("serial")


def _manifest(spark, sf_dir):
    files = list_files(spark, sample.drop_dir(spark, sf_dir), "source_file", PART_FILES)
    return counts.manifest(counts.count_records(landed_lines(spark, sf_dir)), files)


def _read_back(spark, path, source="directory") -> DataFrame:
    """Lines of a written directory tree in part-file order, numbered per directory."""
    return number_lines(land(read_lines(spark, path, source, PART_FILES), SAMPLE))


# --- sources -------------------------------------------------------------------------

def raw_scan(spark, sf_dir):
    lines = raw_lines(spark, sf_dir)
    return lines.groupBy("source_file").agg(
        F.count("*").alias("n_lines"), F.sum((F.col("value") == "").cast("bigint")).alias("n_blank"))


def line_numbers(spark, sf_dir):
    return sample_lines(spark, sf_dir).select("source_file", "line_no", "record_type", "key")


def gz_scan(spark, sf_dir):
    return counts.count_records(raw_lines(spark, sf_dir, "gzip"))


def zip_scan(spark, sf_dir):
    """Every part file is an archive of its own; their members are named after the drop."""
    lines = read_zip(spark, sample.zip_dir(spark, sf_dir))
    return counts.count_records(lines.withColumn("source_file", csvtext.base_name(F.col("source_file"))))


def file_list(spark, sf_dir):
    return list_files(spark, sample.drop_dir(spark, sf_dir), "source_file", PART_FILES).select("source_file").distinct()


def registry(spark, sf_dir):
    """How many lines of each declared type fit the declaration."""
    lines = landed_lines(spark, sf_dir)
    checked = [
        parse_type(lines, t).agg(
            F.count("*").alias("n_lines"), F.count(csvtext.CORRUPT).alias("n_bad")).select(
            F.lit(t.id).alias("record_type"), F.lit(t.name).alias("name"),
            F.lit(len(t.fields)).alias("n_fields"), "n_lines", "n_bad")
        for t in SAMPLE]
    return reduce(DataFrame.unionByName, checked)


def typed_scan(spark, sf_dir):
    path = staging_path(spark, "merged")
    sinks.write_merged(filters.with_type(sample_lines(spark, sf_dir), "28"), path, SAMPLE)
    return good_rows(read_typed(spark, f"{path}/merged_file=Records_DeliveryPointAddress.csv", SAMPLE["28"]))


def record_scan(spark, sf_dir):
    path = sample.document_dir(spark, sf_dir)
    records = assemble_records(read_lines(spark, path, "source_file", PART_FILES, keep_cr=True))
    parsed = good_rows(parse_type(records, SAMPLE["31"]))
    return parsed.select(F.col("UPRN").alias("doc_id"), F.md5("NOTE").alias("text_md5"),
                         F.length("NOTE").alias("n_chars"), F.col("LANGUAGE").alias("lang"))


def open_quotes(spark, sf_dir):
    """Records per file and type when every file ends in a quote nobody closes."""
    path = sample.open_quote_dir(spark, sf_dir)
    records = assemble_records(read_lines(spark, path, "source_file", PART_FILES, keep_cr=True))
    return counts.count_records(records)


def same_names(spark, sf_dir):
    """The stored manifest of a drop whose files and archive members are all called x.csv, brought up to date twice."""
    root, path = sample.same_names_dir(spark, sf_dir), staging_path(spark, "manifest")
    jobs.count_all(spark, root, path)
    return jobs.count_all(spark, root, path)


def _sorted_rank(spark, typed: DataFrame) -> DataFrame:
    """Write a sorted table, scan it in part-file order, and give each row its line number."""
    path = staging_path(spark, "sorted")
    sinks.write_table(typed, path)
    return _read_back(spark, path).select(F.col("line_no").alias("rank"), "record_type", "key", _serial())


def sorted_scan(spark, sf_dir):
    return _sorted_rank(spark, good_rows(ordering.global_sort(sample_lines(spark, sf_dir), SAMPLE["28"])))


# --- manifest --------------------------------------------------------------------------

def count_records(spark, sf_dir):
    return counts.count_records(raw_lines(spark, sf_dir))


def manifest(spark, sf_dir):
    return counts.manifest_text(counts.manifest_entries(_manifest(spark, sf_dir)))


def mixed_files(spark, sf_dir):
    return counts.data_types_per_file(_manifest(spark, sf_dir))


def files_for_type(spark, sf_dir):
    return counts.files_for_type(_manifest(spark, sf_dir), "11")


def _old_manifest(spark, sf_dir):
    """What an earlier run knew: the files up to drop_3."""
    return _manifest(spark, sf_dir).filter(F.col("source_file") < "drop_4.csv")


def pending_files(spark, sf_dir):
    files = list_files(spark, sample.drop_dir(spark, sf_dir), "source_file", PART_FILES)
    return counts.pending_files(files, _old_manifest(spark, sf_dir))


def manifest_refresh(spark, sf_dir):
    files = list_files(spark, sample.drop_dir(spark, sf_dir), "source_file", PART_FILES)
    old = _old_manifest(spark, sf_dir)
    pending = counts.pending_files(files, old)
    new = counts.count_records(raw_lines(spark, sf_dir)).join(pending, "source_file", "left_semi")
    return counts.manifest_text(counts.manifest_entries(counts.refresh_manifest(old, new, files)))


# --- filters, projections and scalar functions ----------------------------------------

def type_filter(spark, sf_dir):
    kept = filters.keep_types(landed_lines(spark, sf_dir))
    return kept.groupBy("record_type").agg(F.count("*").alias("n"))


def drop_control(spark, sf_dir):
    return filters.drop_control(landed_lines(spark, sf_dir)).groupBy("source_file").agg(F.count("*").alias("n"))


def positional_trim(spark, sf_dir):
    kept = filters.positional_trim(sample_lines(spark, sf_dir))
    return kept.groupBy("source_file").agg(
        F.count("*").alias("n"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))


def key_extract(spark, sf_dir):
    lines = filters.keep_types(raw_lines(spark, sf_dir), LOCATION_IDS)
    return lines.select(
        csvtext.record_type_of(F.col("value")).alias("record_type"),
        csvtext.to_key(csvtext.field_at(F.col("value"), 3)).alias("key"), _serial())


def key_cast(spark, sf_dir):
    key = F.col("o_custkey").cast("string")
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(""))
            .when(F.col("o_orderstatus") == "F", F.concat(key, F.lit(".0")))
            .when(F.col("o_orderstatus") == "P", F.concat(F.lit(" "), key, F.lit(" "))).otherwise(key))
    return table(spark, sf_dir, "orders").select("o_orderkey", csvtext.to_key(text).alias("key"))


def csv_parse(spark, sf_dir):
    return good_rows(parse_type(landed_lines(spark, sf_dir), SAMPLE["28"])).select(
        F.col("UPRN").alias("user_id"), F.col("PRO_ORDER").alias("event_id"), F.col("EVENT").alias("event_type"),
        F.col("VALUE").alias("value"), F.col("PROPS").alias("props"), F.col("ENTRY_DATE").alias("day"))


def csv_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", csvtext.format_line("event_id", "user_id", "event_type", "props").alias("line"))


# --- split, merge and sinks --------------------------------------------------------------

def split(spark, sf_dir):
    path = staging_path(spark, "split")
    sinks.write_split(filters.keep_types(sample_lines(spark, sf_dir)), path, SAMPLE)
    lines = read_lines(spark, path, "split_file", PART_FILES)
    return lines.groupBy(F.col("source_file").alias("split_file")).agg(
        F.count("*").alias("n"), F.sum(csvtext.to_key(csvtext.field_at(F.col("value"), 3))).alias("key_sum"))


def merge_type(spark, sf_dir):
    merged = filters.with_type(landed_lines(spark, sf_dir), "24")
    return good_rows(parse_type(merged, SAMPLE["24"])).select(
        F.col("UPRN").alias("o_custkey"), F.col("PRO_ORDER").alias("o_orderkey"),
        F.col("STATUS").alias("o_orderstatus"), F.col("PRIORITY").alias("o_orderpriority"),
        F.col("TOTAL").alias("o_totalprice"), F.col("ENTRY_DATE").alias("o_orderdate"))


def merge_all(spark, sf_dir):
    path = staging_path(spark, "merged")
    sinks.write_merged(filters.keep_types(sample_lines(spark, sf_dir)), path, SAMPLE)
    lines = read_lines(spark, path, "merged_file", PART_FILES)
    return lines.groupBy(F.col("source_file").alias("merged_file")).agg(
        F.count("*").alias("n"), F.sum(csvtext.to_key(csvtext.field_at(F.col("value"), 3))).alias("key_sum"))


def header_sink(spark, sf_dir):
    path = staging_path(spark, "header")
    sinks.write_table(good_rows(parse_type(landed_lines(spark, sf_dir), SAMPLE["15"])), path, header=True)
    return good_rows(read_typed(spark, path, SAMPLE["15"], header=True)).select(
        F.col("USRN").alias("s_nationkey"), F.col("PRO_ORDER").alias("s_suppkey"),
        F.col("NAME").alias("s_name"), F.col("BALANCE").alias("s_acctbal"))


def null_sink(spark, sf_dir):
    path = staging_path(spark, "nulls")
    typed = good_rows(parse_type(landed_lines(spark, sf_dir), SAMPLE["24"]))
    sinks.write_table(
        typed.withColumn("STATUS", F.when(F.col("STATUS") == "P", F.lit("")).otherwise(F.col("STATUS")))
        .withColumn("PRIORITY", F.nullif("PRIORITY", F.lit("1-URGENT"))), path)
    return good_rows(read_typed(spark, path, SAMPLE["24"])).select(
        F.col("PRO_ORDER").alias("o_orderkey"), F.col("STATUS").alias("o_orderstatus"),
        F.col("PRIORITY").alias("o_orderpriority"))


# --- sorting ------------------------------------------------------------------------------

def sort_uprn(spark, sf_dir):
    return _sorted_rank(spark, good_rows(ordering.global_sort(sample_lines(spark, sf_dir), SAMPLE["24"])))


def sort_usrn(spark, sf_dir):
    return _sorted_rank(spark, good_rows(ordering.global_sort(sample_lines(spark, sf_dir), SAMPLE["15"], "USRN")))


def sort_multi(spark, sf_dir):
    """Three types sorted and written as one job; the rank is the place in the type's folder."""
    path = staging_path(spark, "sorted")
    jobs.sort_records(sample_lines(spark, sf_dir), path, SAMPLE, ("21", "24", "28"))
    return _read_back(spark, path).select(F.col("line_no").alias("rank"), "record_type", "key", _serial())


def colocated(spark, sf_dir):
    path = staging_path(spark, "buckets")
    rows = filters.keep_types(sample_lines(spark, sf_dir), ("24", "28"))
    sinks.write_colocated(ordering.colocate(rows, ROWS_PER_BUCKET), path)
    return spark.read.parquet(path).groupBy("key", F.col("bucket").cast("bigint").alias("bucket")).agg(
        F.count("*").alias("n"))


def global_index(spark, sf_dir):
    rows = filters.keep_types(sample_lines(spark, sf_dir), ("24", "28"))
    return ordering.global_index(rows, "key", "source_file", "line_no").select(
        "row_index", "key", "record_type", _serial())


# --- grouping -----------------------------------------------------------------------------

def _group_columns(grouped):
    return grouped.select("key", "type_rank", "source_file", "line_no", "record_type", _serial())


def group_uprn(spark, sf_dir):
    return _group_columns(grouping.group_by_key(sample_lines(spark, sf_dir), *UPRN))


def group_usrn(spark, sf_dir):
    return _group_columns(grouping.group_by_key(sample_lines(spark, sf_dir), *USRN))


def group_usrn_first(spark, sf_dir):
    return _group_columns(grouping.group_by_key(sample_lines(spark, sf_dir), *USRN, limit_per_key=1))


def group_gapped(spark, sf_dir):
    return _group_columns(grouping.group_by_key(sample_lines(spark, sf_dir), *GAPPED))


def _chunks(spark, sf_dir, parent, children, size):
    path = staging_path(spark, "chunks")
    sinks.write_chunks(grouping.group_in_chunks(sample_lines(spark, sf_dir), parent, children, size), path)
    return _read_back(spark, path, "part_file").select(
        F.col("source_file").alias("part_file"), "line_no", "record_type", "key", _serial())


def group_uprn_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir, *UPRN, PARENTS_PER_CHUNK)


def group_usrn_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir, *USRN, STREETS_PER_CHUNK)


def part_names(spark, sf_dir):
    grouped = grouping.group_in_chunks(sample_lines(spark, sf_dir), *UPRN, PARENTS_PER_CHUNK)
    return grouped.groupBy(csvtext.part_name(F.col("chunk")).alias("part_file")).agg(
        F.sum((F.col("type_rank") == 0).cast("bigint")).alias("n_parents"), F.count("*").alias("n_lines"))


def group_uprn_nested(spark, sf_dir):
    nested = grouping.nest_by_key(sample_lines(spark, sf_dir), *UPRN, max_rows=10_000)
    serials = F.transform("type_24", lambda line: csvtext.field_at(line["value"], 2))
    return nested.select(
        "key", "segment", F.size("parents").alias("n_parents"), F.size("type_24").alias("n_24"),
        F.size("type_28").alias("n_28"), F.array_join(serials, ",").alias("serials_24"))


def lookup_key(spark, sf_dir):
    lines = filters.keep_types(landed_lines(spark, sf_dir), ("21", "24", "28"))
    return grouping.lookup(lines, LOOKUP_KEY).select("record_type", "key", _serial())


def lookup_colocated(spark, sf_dir):
    rows = filters.keep_types(sample_lines(spark, sf_dir), ("24", "28"))
    path, offsets = staging_path(spark, "buckets"), ordering.key_offsets(rows)
    sinks.write_colocated(ordering.colocate(rows, ROWS_PER_BUCKET, offsets=offsets), path)
    return grouping.lookup_colocated(spark.read.parquet(path), offsets, ROWS_PER_BUCKET, LOOKUP_KEY).select(
        "record_type", "key", _serial())


def lookup_stored(spark, sf_dir):
    """A key of a co-located table, by nothing but its path."""
    rows = filters.keep_types(sample_lines(spark, sf_dir), ("24", "28"))
    path = staging_path(spark, "buckets")
    sinks.write_colocated(ordering.colocate(rows, ROWS_PER_BUCKET), path)
    return grouping.lookup_stored(spark, path, LOOKUP_KEY).select("record_type", "key", _serial())


def zones(spark, sf_dir):
    """The stored index of a co-located table, per bucket."""
    rows = filters.keep_types(sample_lines(spark, sf_dir), ("24", "28"))
    path = staging_path(spark, "buckets")
    sinks.write_colocated(ordering.colocate(rows, ROWS_PER_BUCKET), path)
    return spark.read.parquet(f"{path}/{sinks.ZONES}").groupBy(F.col("bucket").cast("bigint").alias("bucket")).agg(
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"), F.sum("rows").alias("n"))


def land_by_manifest(spark, sf_dir):
    """Lines of the files whose manifest has streets, landed and numbered; no other file is opened."""
    root, path = sample.drop_dir(spark, sf_dir), staging_path(spark, "manifest")
    jobs.count_all(spark, root, path, "source_file", PART_FILES)
    lines = jobs.prepare(spark, root, SAMPLE, source="source_file", glob=PART_FILES, manifest=path, types=("15",))
    return lines.select("source_file", "line_no", "record_type", "key")


def split_lines(spark, sf_dir):
    """Every line of a written split, in part-file order."""
    path = staging_path(spark, "split")
    sinks.write_split(filters.keep_types(sample_lines(spark, sf_dir)), path, SAMPLE)
    return _read_back(spark, path, "split_file").select(F.col("source_file").alias("split_file"), "line_no", "record_type", "key", _serial())


def merged_lines(spark, sf_dir):
    """Every line of written merges, in part-file order, with its header line in front."""
    path = staging_path(spark, "merged")
    sinks.write_merged(filters.keep_types(sample_lines(spark, sf_dir), ("15", "24")), path, SAMPLE, include_headers=True)
    lines = _read_back(spark, path, "merged_file")
    return lines.select(F.col("source_file").alias("merged_file"), "line_no", "key", _serial(),
                        F.when(F.col("line_no") == 0, F.col("value")).alias("header"))


def lookup_batch(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("key"))
    orders = filters.with_type(landed_lines(spark, sf_dir), "24")
    return grouping.lookup_many(orders, keys).select("key", _serial())


def orphans(spark, sf_dir):
    return grouping.orphans(sample_lines(spark, sf_dir), *GAPPED).select(
        "key", "record_type", "source_file", "line_no", _serial())


def rejects(spark, sf_dir):
    rejected = grouping.rejects(sample_lines(spark, sf_dir), SAMPLE, *GAPPED)
    return rejected.groupBy("reason", "record_type").agg(F.count("*").alias("n"))


def rejects_odd(spark, sf_dir):
    """Reasons of lines with bad keys, undeclared types and fields that do not fit."""
    lines = jobs.prepare(spark, sample.odd_dir(spark, sf_dir), SAMPLE, source="source_file", glob=PART_FILES)
    rejected = grouping.rejects(lines, SAMPLE, "21", ("24",))
    return rejected.groupBy("reason", "record_type").agg(F.count("*").alias("n"))


def file_names(spark, sf_dir):
    """The drops of a folder tree with their bare names, with and without suffix."""
    bare = csvtext.base_name(F.col("source_file"))
    return jobs.list_drop(spark, sample.same_names_dir(spark, sf_dir)).select(
        "source_file", bare.alias("base"), csvtext.drop_suffix(bare, ".csv").alias("stem"))


def accounted(spark, sf_dir):
    """Every line of the drop: in a group, or left out for one reason."""
    lines = sample_lines(spark, sf_dir)
    grouped = grouping.group_by_key(lines, *GAPPED).select(F.lit("grouped").alias("reason"))
    left = grouping.rejects(lines, SAMPLE, *GAPPED).filter("reason <> 'corrupt'").select("reason")
    return grouped.union(left).groupBy("reason").agg(F.count("*").alias("n"))


def group_uprn_segments(spark, sf_dir):
    """Groups cut into segments of a few lines."""
    nested = grouping.nest_by_key(sample_lines(spark, sf_dir), *UPRN, max_rows=ROWS_PER_SEGMENT)
    return nested.select("key", "segment", F.size("parents").alias("n_parents"), F.size("type_24").alias("n_24"),
                         F.size("type_28").alias("n_28"))


ALL: dict[str, Query] = {
    f"q_{query.__name__}": query for query in (
        raw_scan, line_numbers, gz_scan, zip_scan, file_list, registry, typed_scan, record_scan, sorted_scan,
        count_records, manifest, mixed_files, files_for_type, pending_files, manifest_refresh,
        type_filter, drop_control, positional_trim, key_extract, key_cast, csv_parse, csv_format,
        split, merge_type, merge_all, header_sink, null_sink,
        sort_uprn, sort_usrn, sort_multi, colocated, global_index,
        group_uprn, group_usrn, group_usrn_first, group_gapped, group_uprn_chunks, group_usrn_chunks, part_names,
        group_uprn_nested, lookup_key, lookup_colocated, lookup_batch, orphans, rejects,
        open_quotes, same_names, accounted, group_uprn_segments,
        lookup_stored, zones, land_by_manifest, split_lines, merged_lines, rejects_odd, file_names)
}
