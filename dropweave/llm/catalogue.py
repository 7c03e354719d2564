"""What the driver's contract takes from this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from dropweave.llm import oracles, queries as own


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own.ALL | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ALL)
