"""The given tables written as a drop, so that queries start from text as in production."""

from __future__ import annotations

import sys
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave.functions.csvtext import format_line
from dropweave.functions.registry import RecordType, Registry
from dropweave.session import input_bytes, size_shuffles, staging_path
from dropweave.sources.archives import open_uri
from dropweave.sources.lines import land, number_lines, read_lines

SOURCES = 8
PART_FILES = "part-*"
cloudpickle.register_pickle_by_value(sys.modules[__name__])
TEXT_PER_TABLE_BYTE = 4

SAMPLE = Registry([
    RecordType.from_layout("10", "Header", "RECORD_IDENTIFIER int, FILE_NAME string, VOLUME int, ENTRY_DATE date"),
    RecordType.from_layout("11", "Street", "RECORD_IDENTIFIER int, CHANGE_TYPE string, PRO_ORDER long, "
                           "USRN long, NAME string, REGION int", "USRN"),
    RecordType.from_layout("15", "StreetDescriptor", "RECORD_IDENTIFIER int, CHANGE_TYPE string, PRO_ORDER long, "
                           "USRN long, NAME string, BALANCE number", "USRN"),
    RecordType.from_layout("21", "BPLU", "RECORD_IDENTIFIER int, CHANGE_TYPE string, PRO_ORDER long, "
                           "UPRN long, NAME string, SEGMENT string, BALANCE number", "UPRN"),
    RecordType.from_layout("24", "LPI", "RECORD_IDENTIFIER int, CHANGE_TYPE string, PRO_ORDER long, "
                           "UPRN long, STATUS string, PRIORITY string, TOTAL number, ENTRY_DATE date"),
    RecordType.from_layout("28", "DeliveryPointAddress", "RECORD_IDENTIFIER int, CHANGE_TYPE string, "
                           "PRO_ORDER long, UPRN long, EVENT string, VALUE number, PROPS string, ENTRY_DATE date"),
    RecordType.from_layout("29", "Metadata", "RECORD_IDENTIFIER int, SCOPE string, TERMS string, OWNER string"),
    RecordType.from_layout("31", "Organisation", "RECORD_IDENTIFIER int, CHANGE_TYPE string, PRO_ORDER long, "
                           "UPRN long, NOTE string, LANGUAGE string"),
    RecordType.from_layout("99", "Trailer", "RECORD_IDENTIFIER int, NEXT_VOLUME int, RECORD_COUNT int"),
])

_made: dict[tuple, object] = {}


def once(spark: SparkSession, name: str, sf_dir: str, make: Callable[[], object]):
    """Make an input once per application and data folder."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _source_file(key: Column) -> Column:
    return F.concat(F.lit("drop_"), (key % SOURCES).cast("string"), F.lit(".csv"))


def _data(df: DataFrame, record_id: str, key: str, serial: str, *fields: Column | str) -> DataFrame:
    key_col, serial_col = F.col(key).cast("bigint"), F.col(serial).cast("bigint")
    line = format_line(F.lit(int(record_id)), F.lit("I"), serial_col, key_col, *fields)
    return df.select(_source_file(key_col).alias("source_file"), F.lit(1).alias("section"),
                     F.lit(record_id).alias("type"), key_col.alias("k"), serial_col.alias("s"), line.alias("value"))


def _control(spark: SparkSession, section: int, record_id: str, *fields: Column) -> DataFrame:
    none = F.lit(None).cast("bigint")
    return spark.range(SOURCES).select(
        _source_file(F.col("id")).alias("source_file"), F.lit(section).alias("section"),
        F.lit(record_id).alias("type"), none.alias("k"), none.alias("s"),
        format_line(F.lit(int(record_id)), *fields).alias("value"))


def drop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def day(column: str) -> Column:
        return F.col(column).cast("date")
    return reduce(DataFrame.unionByName, [
        _control(spark, 0, "10", F.lit("sample"), F.col("id"), F.lit("2024-01-01")),
        _data(table(spark, sf_dir, "customer"), "21", "c_custkey", "c_custkey", "c_name", "c_mktsegment", "c_acctbal"),
        _data(table(spark, sf_dir, "orders"), "24", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority",
              "o_totalprice", day("o_orderdate")),
        _data(table(spark, sf_dir, "events"), "28", "user_id", "event_id", "event_type", "value", "props", day("ts")),
        _data(table(spark, sf_dir, "nation"), "11", "n_nationkey", "n_nationkey", "n_name", "n_regionkey"),
        _data(table(spark, sf_dir, "supplier"), "15", "s_nationkey", "s_suppkey", "s_name", "s_acctbal"),
        _control(spark, 2, "29", F.lit("scope"), F.lit("terms, as given"), F.lit("owner")),
        _control(spark, 3, "99", F.lit(0), F.lit(0)),
    ])


def drop_dir(spark: SparkSession, sf_dir: str, codec: str = "none") -> str:
    """The drop as text: one directory per source, its part files in line order."""
    def make():
        # Text is a few times the size of the compressed tables.
        size_shuffles(spark, TEXT_PER_TABLE_BYTE * input_bytes(spark, sf_dir, "*.parquet"))
        path = staging_path(spark, "drop")
        order = ["source_file", "section", "type", "k", "s"]
        (drop_rows(spark, sf_dir).repartitionByRange(*order).sortWithinPartitions(*order)
         .select("source_file", "value").write.option("compression", codec).partitionBy("source_file").text(path))
        return path
    return once(spark, f"drop-{codec}", sf_dir, make)


def raw_lines(spark: SparkSession, sf_dir: str, codec: str = "none") -> DataFrame:
    return read_lines(spark, drop_dir(spark, sf_dir, codec), "source_file", PART_FILES)


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, "landed", sf_dir, lambda: land(raw_lines(spark, sf_dir), SAMPLE))


def sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed and numbered lines of the drop."""
    return once(spark, "numbered", sf_dir, lambda: number_lines(landed_lines(spark, sf_dir), with_total=True))


def zip_dir(spark: SparkSession, sf_dir: str) -> str:
    """The text drop with every part file in an archive of its own."""
    def make():
        from pyarrow import fs
        target = staging_path(spark, "zips")
        uri = "file://" + target if target.startswith("/") else target.replace("s3a://", "s3://", 1)
        parts = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", PART_FILES).load(drop_dir(spark, sf_dir)).select("path"))
        store, folder = fs.FileSystem.from_uri(uri)
        store.create_dir(folder)

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out, root = fs.FileSystem.from_uri(uri)
            for batch in batches:
                for path in batch["path"]:
                    source, part = path.split("/")[-2].split("=")[-1], path.split("/")[-1]
                    with out.open_output_stream(f"{root}/{source}.{part}.zip") as raw, \
                            zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as zipped, \
                            open_uri(path) as text, zipped.open(source, "w", force_zip64=True) as member:
                        while block := text.read(1 << 20):
                            member.write(block)
                yield pd.DataFrame({"n": [len(batch)]})

        parts.mapInPandas(pack, "n BIGINT").write.format("noop").mode("overwrite").save()
        return target
    return once(spark, "zips", sf_dir, make)


def same_names_dir(spark: SparkSession, sf_dir: str) -> str:
    """Customers in a folder per nation, each with a text and an archive of the same name and a note beside the data."""
    def make():
        from pyarrow import fs
        target = staging_path(spark, "same-names")
        uri = "file://" + target if target.startswith("/") else target.replace("s3a://", "s3://", 1)
        rows = _data(table(spark, sf_dir, "customer"), "21", "c_custkey", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
        rows = rows.select((F.col("k") % 25).alias("folder"), (F.col("k") % 3 == 0).alias("zipped"), "k", "value")

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            store, root = fs.FileSystem.from_uri(uri)
            held, out, archive = None, None, None

            def end():
                for stream in (out, archive):
                    if stream:
                        stream.close()

            for batch in batches:
                for folder, zipped, value in zip(batch["folder"], batch["zipped"], batch["value"]):
                    if (folder, zipped) != held:
                        end()
                        held, archive = (folder, zipped), None
                        store.create_dir(f"{root}/{folder}")
                        out = store.open_output_stream(f"{root}/{folder}/x.{'zip' if zipped else 'csv'}")
                        if zipped:
                            raw, archive = out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                            archive.writestr("readme.txt", "24 hours\n32 bits\n")
                            out = archive.open("x.csv", "w", force_zip64=True)
                    out.write(value.encode() + b"\n")
                yield pd.DataFrame({"n": [len(batch)]})
            end()
            if archive:
                raw.close()

        # One task writes a file from its first line to its last; the folders are as many as nations.
        (rows.repartition("folder", "zipped").sortWithinPartitions("folder", "zipped", "k").mapInPandas(pack, "n BIGINT")
         .write.format("noop").mode("overwrite").save())
        return target
    return once(spark, "same-names", sf_dir, make)


def odd_dir(spark: SparkSession, sf_dir: str) -> str:
    """Customers, and orders some of which have a key that is no number, a type nobody declared, or a serial that does not fit."""
    def make():
        path = staging_path(spark, "odd")
        key, serial = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
        line = format_line(
            F.when(F.col("o_orderstatus") == "P", 77).otherwise(24), F.lit("I"), F.when(F.col("o_orderpriority") == "1-URGENT", "x").otherwise(serial),
            F.when(F.col("o_orderstatus") == "F", "bad").otherwise(key), "o_orderstatus", "o_orderpriority", "o_totalprice", F.col("o_orderdate").cast("date"))
        orders = table(spark, sf_dir, "orders").select(_source_file(F.col("o_custkey").cast("bigint")).alias("source_file"), line.alias("value"))
        customers = _data(table(spark, sf_dir, "customer"), "21", "c_custkey", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
        orders.union(customers.select("source_file", "value")).write.partitionBy("source_file").text(path)
        return path
    return once(spark, "odd", sf_dir, make)


def open_quote_dir(spark: SparkSession, sf_dir: str) -> str:
    """Documents as in ``document_dir``, each file ended by a quote nobody closes and a line per event below it."""
    def make():
        path = staging_path(spark, "open-quotes")
        docs = _data(table(spark, sf_dir, "documents"), "31", "doc_id", "doc_id", "text", "lang")
        opening = _control(spark, 2, "31").withColumn("value", F.lit('31,"I",1,1,"never closed'))
        below = _data(table(spark, sf_dir, "events").withColumn("plain", F.lit("no quote")), "28", "user_id", "event_id", "plain").withColumn(
            "section", F.lit(3))
        order = ["source_file", "section", "k", "s"]
        (docs.unionByName(opening).unionByName(below).repartition("source_file").sortWithinPartitions(*order)
         .select("source_file", "value").write.partitionBy("source_file").text(path))
        return path
    return once(spark, "open-quotes", sf_dir, make)


def document_dir(spark: SparkSession, sf_dir: str) -> str:
    """Documents as type-31 records; their texts hold line ends, commas and quotes."""
    def make():
        path = staging_path(spark, "documents")
        _data(table(spark, sf_dir, "documents"), "31", "doc_id", "doc_id", "text", "lang") \
            .select("source_file", "value").write.partitionBy("source_file").text(path)
        return path
    return once(spark, "documents", sf_dir, make)
