"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared in lower case with every run of white space as one blank.  An item may differ by a budget of k edits, one
for each ``CHARS_PER_EDIT`` characters.  It is split into k + 1 pieces: whatever k edits do, one piece stays whole, so every
match contains a piece in its place.  All pieces of a block of items are looked for in one pass over the whole text
(Aho-Corasick); around each hit the item is compared by Myers' bit-parallel distance with any substring of the window that
a match could take up.  Hits of the same item whose windows overlap are verified once, so a text that repeats a piece
a thousand times costs a pass over that stretch.

Items are sent to the tasks in blocks of at most ``ITEMS`` items and ``ITEM_BYTES`` bytes; a longer list means more passes
over the documents.  Documents are never shuffled.

An item whose text is null or blank is left out; one without an id is searched like any other.  A text that is null or empty matches nothing.  Items of equal text match alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropweave.llm._common import text_chunks

CHARS_PER_EDIT = 20
ITEMS = 20_000
ITEM_BYTES = 16 * 1024 * 1024
MATCHES = "doc_id long, copy long, item_id long, distance int, start long, end long"


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(item: str, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    return len(item) // chars_per_edit


def pieces(item: str, count: int) -> list[tuple[int, str]]:
    """Offset and text of ``count`` nearly equal pieces."""
    cuts = [len(item) * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Myers:
    """Distance of a pattern to the substrings of a text, a column of the table at a time in one integer."""

    def __init__(self, pattern: str) -> None:
        self.size = len(pattern)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i
        self.full, self.top = (1 << self.size) - 1, 1 << self.size - 1

    def best_end(self, text: str) -> tuple[int, int]:
        """Smallest distance to a substring of ``text``, and the first end where it is reached."""
        plus, minus, score, best, at = self.full, 0, self.size, self.size, 0
        masks, full, top = self.masks, self.full, self.top
        for place, c in enumerate(text, 1):
            eq = masks.get(c, 0)
            vertical = eq | minus
            horizontal = (((eq & plus) + plus) ^ plus) | eq
            up = minus | ~(horizontal | plus) & full
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up, down = up << 1 & full, down << 1 & full
            plus = down | ~(vertical | up) & full
            minus = up & vertical
            if score < best:
                best, at = score, place
        return best, at


class Items:
    """A block of items, their automaton and patterns; built once per task."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int) -> None:
        self.items = [(i, normal(t), budget(normal(t), chars_per_edit)) for i, t in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, k) in enumerate(self.items):
            for offset, piece in pieces(text, k + 1):
                places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        self.automaton.make_automaton()
        self.patterns: dict[int, tuple[Myers, Myers]] = {}

    def _pattern(self, number: int) -> tuple[Myers, Myers]:
        if number not in self.patterns:
            text = self.items[number][1]
            self.patterns[number] = Myers(text), Myers(text[::-1])
        return self.patterns[number]

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)`` of each item's best match in a text, the first of equals."""
        windows: dict[int, list[list[int]]] = {}
        for last, (size, found) in self.automaton.iter(text):
            for number, offset in found:
                _, item, k = self.items[number]
                start = last + 1 - size - offset
                low, high = max(0, start - k), min(len(text), start + len(item) + k)
                held = windows.setdefault(number, [])
                if held and low <= held[-1][1]:
                    held[-1][0], held[-1][1] = min(low, held[-1][0]), max(high, held[-1][1])
                else:
                    held.append([low, high])
        for number, held in windows.items():
            item_id, item, k = self.items[number]
            best = None
            for low, high in held:
                at = text.find(item, low, high)
                if at >= 0:
                    distance, end = 0, at + len(item)
                else:
                    distance, end = self._pattern(number)[0].best_end(text[low:high])
                    end += low
                if distance <= k and (best is None or distance < best[0]):
                    best = distance, end
                if not distance:
                    break
            if best:
                distance, end = best
                back = text[max(0, end - len(item) - k):end][::-1]
                yield item_id, distance, end - (self._pattern(number)[1].best_end(back)[1] if distance else len(item)), end


def blocks(items: DataFrame, item_id: str, text: str, most: int = ITEMS, most_bytes: int = ITEM_BYTES) -> int:
    """How many blocks keep each within both bounds on average."""
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")).first()
    return max(1, -(-size.n // most), -(-size.bytes // most_bytes))


def _found(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", chars_per_edit: int = CHARS_PER_EDIT, most: int = ITEMS) -> DataFrame:
    """``matches`` with ``copy``, which tells texts with one id apart."""
    spark = docs.sparkSession
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).filter("text IS NOT NULL")
    count = blocks(items, "item_id", "text", most)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text")).filter(
        "text IS NOT NULL")
    if count > 1:  # twice as many hash blocks as an even split needs, so that none is over the bound
        items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * count)))

    def found_by(block: list[tuple[int, str]]) -> DataFrame:
        sent = spark.sparkContext.broadcast([(i, t) for i, t in block if normal(t)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in text_chunks(batches, "text"):
                held = held or Items(sent.value, chars_per_edit)
                rows = [(doc, copy, *m) for doc, copy, t in zip(*(batch.column(n).to_pylist() for n in range(3)))
                        for m in (held.matches(normal(t)) if held.items else ())]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int32() if n == 3 else pa.int64()) for n, c in enumerate(zip(*rows))],
                        ["doc_id", "copy", "item_id", "distance", "start", "end"])

        return source.mapInArrow(run, MATCHES)

    if count == 1:
        return found_by([(r.item_id, r.text) for r in items.collect()])
    parts = ([(r.item_id, r.text) for r in items.filter(F.col("block") == n).collect()] for n in range(2 * count))
    return reduce(DataFrame.union, (found_by(part) for part in parts))


def matches(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``(doc_id, item_id, distance, start, end)``: each item found in each row of ``docs``, at its best place.

    Places count characters of the compared text.  Repeated rows give repeated matches.
    """
    return _found(docs, items, id_column, text, **settings).drop("copy")


def clean(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` in which no item is found, null texts included.  Only rows of equal id and text share their fate."""
    hit = _found(docs, items, id_column, text, **settings).select(F.col("doc_id").alias("_hit"), F.col("copy").alias("_copy")).distinct()
    return docs.join(hit, docs[id_column].cast("long").eqNullSafe(hit["_hit"]) & (F.xxhash64(docs[text]) == hit["_copy"]), "left_anti")
