"""Joining rows with a table that has one row per key, when one key may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropweave.session import broadcast_if_small, file_bytes, stage

HOT_ROWS = 1_000_000
LINE = ("source_file", "line_no")


def frequent_keys(rows: DataFrame, key: str = "key", hot_rows: int | None = None) -> DataFrame:
    """``(key, _salts)`` of the keys with more than ``hot_rows`` rows, staged: a salt for each ``hot_rows``.

    Counted map-side, reading the key alone; at most one row for each ``hot_rows`` rows of the input.
    """
    most = hot_rows or HOT_ROWS
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    return stage(counts.select(key, F.ceil(F.col("_n") / most).cast("int").alias("_salts")), "frequent")


def join_by_key(rows: DataFrame, per_key: DataFrame, how: str = "inner", key: str = "key", hot_rows: int | None = None) -> DataFrame:
    """``rows.join(per_key, key, how)`` for a staged ``per_key`` with unique keys; ``how`` keeps rows of the left side only.

    A table that Catalyst will broadcast is joined as it is.  Beyond that, the rows of a frequent key are dealt over salts by the hash of
    their line, and the key's row of ``per_key`` is repeated for each salt, so no task gets much more than ``hot_rows`` rows of one key,
    however few map outputs hold them.  Rows without a key are dealt likewise.
    """
    limit = int(rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    if file_bytes(per_key) <= limit:
        return rows.join(per_key, key, how)
    hot = frequent_keys(rows, key, hot_rows)
    if hot.isEmpty():
        return rows.join(per_key, key, how)
    # Null-safe, because rows without a key may be frequent too.
    salts = broadcast_if_small(hot.withColumnRenamed(key, "_hot"))
    line = F.xxhash64(*(LINE if set(LINE) <= set(rows.columns) else rows.columns))
    one = F.lit(1)
    dealt = rows.join(salts, rows[key].eqNullSafe(F.col("_hot")), "left").withColumn(
        "_salt", F.pmod(line, F.coalesce("_salts", one).cast("bigint")).cast("int")).drop("_hot", "_salts")
    repeated = per_key.join(salts, per_key[key] == F.col("_hot"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", one) - 1))).drop("_hot", "_salts")
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")
