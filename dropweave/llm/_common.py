"""What several operators share: tables, byte-bounded batches and the split of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 4 * 1024 * 1024
ROWS_PER_TASK = 200_000  # of a few numbers each


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str | Column) -> Column:
    """crc32 of an id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit("")))


def dealt(df: DataFrame, rows: int, *columns: str, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` dealt by columns over as many tasks as its counted rows need; grouping, distinct and equal joins by them need no other shuffle."""
    return df.repartition(max(1, ceil(rows / per_task)), *columns)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)).astype(np.int64)
        begin, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size + 64
        yield batch.slice(begin)
