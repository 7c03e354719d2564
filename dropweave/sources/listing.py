"""Listing folders in tasks: one row per file, also for files without bytes, which a scan does not show."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave.session import MAX_PARTITIONS, stage

FOUND = "path STRING, is_folder BOOLEAN, size BIGINT"
_WILDCARDS = re.compile(r"[*?\[\]{}]")

# Functions sent to tasks carry their code along, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def list_folder(folder: str) -> Iterable[tuple[str, bool, int]]:
    """``(path, is folder, size)`` of what lies in a folder, in any store pyarrow knows; ``folder`` is ``scheme://host/path``."""
    from pyarrow import fs
    scheme, _, rest = folder.partition("://")
    host, slash, path = rest.partition("/")
    if scheme == "file":
        store, base = fs.LocalFileSystem(), ""
    else:
        store, base = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{host}/")
    selector = fs.FileSelector(f"{base.rstrip('/')}{slash}{path}")
    for info in store.get_file_info(selector):
        yield f"{folder.rstrip('/')}/{info.base_name}", info.type == fs.FileType.Directory, info.size or 0


def _hidden(name: str) -> bool:
    """What Spark's scans pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _roots(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """The path itself, or what its wildcards match, as in ``FOUND``."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = given.getFileSystem(spark._jsc.hadoopConfiguration())
    found = list(store.globStatus(given) or []) if _WILDCARDS.search(path) else [store.getFileStatus(given)]
    out = []
    for status in found:
        uri = store.makeQualified(status.getPath()).toUri()
        out.append((f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}", status.isDirectory(), status.getLen()))
    return out


def glob_pattern(glob: str) -> str:
    """A file name pattern with ``*``, ``?`` and ``{a,b}`` as a regular expression."""
    out = ""
    for char in glob:
        out += {"*": ".*", "?": ".", "{": "(?:", "}": ")", ",": "|"}.get(char, re.escape(char))
    return f"^{out}$"


def walk(spark: SparkSession, path: str, glob: str = "*", lister: Callable[[str], Iterable[tuple[str, bool, int]]] = list_folder) -> DataFrame:
    """``(path, size)`` of all files below a folder whose name matches ``glob``, without hidden ones.

    A round for each level of folders: every task lists some folders and writes what it finds, so the driver sees nothing but the number
    of folders of the next level.
    """
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["path"]:
                rows = [row for row in lister(folder) if not _hidden(row[0].rsplit("/", 1)[1])]
                yield pd.DataFrame(rows, columns=["path", "is_folder", "size"])

    level = spark.createDataFrame(_roots(spark, path), FOUND)
    found, folders = level.filter("NOT is_folder"), level.filter("is_folder").count()
    while folders:
        below = stage(level.filter("is_folder").select("path").repartition(min(folders, MAX_PARTITIONS)).mapInPandas(listed, FOUND), "listing")
        found, level = found.union(below.filter("NOT is_folder")), below
        folders = below.filter("is_folder").count()
    name = F.element_at(F.split("path", "/"), -1)
    return found.filter(name.rlike(glob_pattern(glob))).select("path", "size")
