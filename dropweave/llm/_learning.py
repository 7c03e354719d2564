"""Helpers for models trained in numpy: the bounded sample of labelled rows, Adam, and scoring in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropweave.llm._common import id_crc, text_chunks


HASHES = 1 << 40
SLICE_BYTES = 1 << 20


def share(wanted: int, there: int) -> int:
    """Hash values below this hold about ``wanted`` of ``there`` rows."""
    return HASHES if there <= wanted else HASHES * wanted // there


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int,
                    sample_bytes: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels for training: of either class the ``per_class`` rows with the smallest hash of their id that are
    labelled, not held out and of at most ``sample_bytes`` of text, so what reaches the driver is bounded.

    Rows are chosen by numbers alone; only the texts of the chosen ones are moved.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(HASHES))
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("_label"))
    sizes = {r._label: r["count"] for r in known.groupBy("_label").count().collect() if r._label in (0, 1)}  # a row per class
    # A share of the hash values that holds about twice the wanted rows goes first, so the sort sees no more than these.
    wanted = [known.filter((F.col("_label") == y) & (place < share(8 * per_class, sizes.get(y, 0)))).orderBy(place, "doc_id").limit(
        4 * per_class) for y in (1, 0)]
    rows = docs.filter(F.col("text").isNotNull() & (F.octet_length("text") <= sample_bytes)).select(
        "doc_id", F.xxhash64("text").alias("_hash"), "text")
    fitting = rows.drop("text").join(F.broadcast(wanted[0].union(wanted[1])), "doc_id").distinct()  # at most 8 * per_class pairs of numbers
    picked = [fitting.filter(F.col("_label") == y).orderBy(place, "doc_id", "_hash").limit(per_class) for y in (1, 0)]
    chosen = F.broadcast(picked[0].union(picked[1]))
    found = rows.join(chosen, ["doc_id", "_hash"]).dropDuplicates(["doc_id", "_hash"]).orderBy(F.desc("_label"), place, "doc_id", "_hash").select(
        "text", "_label").toArrow()
    return found.column(0).to_pylist(), np.asarray(found.column(1)).astype(np.float64)


def slices(texts: list[str], limit: int = SLICE_BYTES) -> Iterator[slice]:
    """Runs of texts of about ``limit`` characters; what is worked out for a character takes a hundred times its size."""
    begin, held = 0, 0
    for place, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield slice(begin, place)
            begin, held = place, 0
        held += len(text)
    if texts:
        yield slice(begin, len(texts))


class Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float) -> None:
        self.weights, self.rate, self.step = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def apply(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.01 * (g * g - self.square[k])
            mean, square = self.mean[k] / (1 - 0.9**self.step), self.square[k] / (1 - 0.99**self.step)
            self.weights[k] -= self.rate * mean / (np.sqrt(square) + 1e-7)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def scored(docs: DataFrame, model, score: Callable, text: str, keep: list[str], output: str = "score") -> DataFrame:
    """Columns ``keep`` and ``output`` of every row; ``score(model, texts)`` gets texts of a few MB, null as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text).alias("_text_of_score"), *keep)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField(output, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "_text_of_score"):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score(sent.value, texts), pa.float64())], schema.names)

    return rows.mapInArrow(run, schema)


def judged(docs: DataFrame, scores: DataFrame, divisor: int, kept: int, threshold: float) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``."""
    return scores.select("doc_id", (id_crc("doc_id") % divisor == kept).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
