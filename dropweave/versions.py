"""Tables that are replaced as a whole: a folder per version, and a mark that names a complete one.

``<path>/v-0000000007/`` holds the rows of version 7 and the empty file ``<path>/_complete-0000000007`` says that they are all there.  The mark
is made last, so a job that fails at any point leaves the version before it in force.  The version in force and the one before
it are kept, for readers that have begun; older ones are deleted.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_FOLDER, _MARK = re.compile(r"^v-(\d{10})$"), re.compile(r"^_complete-(\d{10})$")
KEPT = 2


def _store(spark: SparkSession, path: str) -> tuple:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    store, folder = _store(spark, path)
    return [status.getPath().getName() for status in store.listStatus(folder)] if store.exists(folder) else []


def _numbers(names: list[str], pattern: re.Pattern) -> list[int]:
    return sorted(int(m[1]) for m in map(pattern.match, names) if m)


def newest(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete version; a folder of plain Parquet files counts as one; None if there is nothing."""
    names = _names(spark, path)
    complete = _numbers(names, _MARK)
    if complete:
        return f"{path}/v-{complete[-1]:010d}"
    return path if any(n.endswith(".parquet") for n in names) else None


def write(rows: DataFrame, path: str) -> str:
    """Write a new version and make it the one in force; ``rows`` may read the present one.  Returns its folder."""
    spark = rows.sparkSession
    names = _names(spark, path)
    number = max([0, *_numbers(names, _FOLDER), *_numbers(names, _MARK)]) + 1
    folder = f"{path}/v-{number:010d}"
    rows.write.parquet(folder)
    store, root = _store(spark, path)

    def child(name: str):
        return spark._jvm.org.apache.hadoop.fs.Path(root, name)

    store.create(child(f"_complete-{number:010d}"), False).close()
    names = _names(spark, path)
    complete = _numbers(names, _MARK)
    for old in complete[:-KEPT]:
        store.delete(child(f"_complete-{old:010d}"), False)  # the mark first: no mark without its rows
    for old in _numbers(names, _FOLDER):
        if old < complete[-KEPT:][0]:
            store.delete(child(f"v-{old:010d}"), True)
    return folder
