"""How far the sources of a language differ in the terms they use.

Terms are runs of ASCII letters (lower-cased) and bytes beyond ASCII.  One ``bytes.translate`` lowers letters and blanks every separator,
``bytes.split`` gives the terms, and a ``Counter`` per document their frequencies; a task adds these up by
``(lang, source, term)`` as sparse rows before any shuffle, with the number of documents that hold the term.

A language keeps the terms of at least ``MIN_DOCS`` of its documents.  A group is a (lang, source) that occurs, with or without
terms.  The share of a kept term in a group, or in a language, is p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), N being the counts of
kept terms there and V the kept terms of the language.  All of it is integer arithmetic.

* ``pair``: the sum of the distances of p between a group and each other source of its language.
* ``term``: the ``TOP`` kept terms of a group that exceed their share in the language most.

Sums over pairs are taken in tiles: sources and terms of a language are dealt to blocks, and a task holds two blocks of
sources by one of terms as small dense tables.  A term that no source of a tile has gives every pair the distance of the two shares of
nothing, which is added at the end by its number.  The list of groups is the only thing joined by language alone, because the result has a
row for every two sources.

Null text, lang and source count as empty.  Texts without terms, empty texts and empty tables give groups with no terms, or no rows.
Repeated rows count as documents of their own.  Ties rank by the bytes of the item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropweave.llm._common import text_chunks
from dropweave.session import broadcast_if_small, stage

MIN_DOCS, TOP = 30, 50
SCALE, SMOOTH = 1_000_000_000, 5
HELD_TERMS = 200_000  # sparse rows a task holds before it passes them on
SOURCES, ENTRIES, COLUMNS = 128, 500_000, 1024  # of a block, of a tile, of a dense table

#: Letters stay or are lowered, bytes beyond ASCII stay, everything else becomes a blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents with the term; one row per group and term."""
    def text_of(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def rows() -> pa.RecordBatch:
            keys, n, found = [], [], []
            for (lang_, source_), (total, in_docs) in held.items():
                keys += [(lang_, source_, t) for t in total]
                n += total.values()
                found += map(in_docs.__getitem__, total)
            names = [pa.array([k[i] for k in keys], pa.binary()).cast(pa.string()) for i in range(3)]
            return pa.RecordBatch.from_arrays([*names, pa.array(n, pa.int64()), pa.array(found, pa.int64())], ["lang", "source", "term", "n", "docs"])

        for batch in text_chunks(batches, "text"):
            columns = (batch.column(i).cast(pa.binary()).to_pylist() for i in range(3))
            for group in zip(*columns):
                total, in_docs = held.setdefault(group[:2], (Counter(), Counter()))
                own = Counter(terms(group[2]))
                size -= len(total)
                total.update(own)
                in_docs.update(own.keys())
                size += len(total)
            if size > HELD_TERMS:
                yield rows()
                held, size = {}, 0
        yield rows()

    sparse = docs.select(text_of(lang).alias("lang"), text_of(source).alias("source"), text_of(text).alias("text")).mapInArrow(count, COUNTS)
    return sparse.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count, exactly: the product may need more than 64 bits, the quotient does not."""
    above = (count + SMOOTH).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + F.lit(SMOOTH) * kept).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def pair_sums(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, a, b, sum, terms, gap)`` of any two sources of a language: distances summed over the terms that a source of their
    tiles has, the number of these terms, and the distance of the two shares of nothing.

    ``entries`` is ``(lang, source, term, p)`` and ``groups`` has a row for each lang and source with ``p0``, the share of nothing.
    """
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("_groups")).join(
        entries.groupBy("lang").agg(F.count(F.lit(1)).alias("_entries")), "lang", "left").select(
        "lang", F.ceil(F.col("_groups") / SOURCES).cast("int").alias("_sources"), F.coalesce("_entries", F.lit(0)).alias("_entries"))
    sizes = broadcast_if_small(stage(sizes.withColumn("_terms", F.greatest(
        F.lit(1), F.ceil(F.col("_entries") * F.col("_sources") / ENTRIES).cast("int"))), "tile-sizes"))
    own = F.pmod(F.xxhash64("source"), F.col("_sources").cast("long")).cast("int")
    block = F.pmod(F.xxhash64("term"), F.col("_terms").cast("long")).cast("int")
    held = entries.select("lang", "source", "term", "p").join(sizes, "lang").withColumn("block", block)
    # Every tile knows all its sources, also those without a term of its block.
    known = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p")).join(sizes, "lang").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("_terms") - 1)))
    tiles = held.unionByName(known).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("_sources") - 1))).select(
        "lang", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "source", "term", "p")

    def tile(rows: pd.DataFrame) -> pd.DataFrame:
        source, names = pd.factorize(rows["source"])
        column, distinct = pd.factorize(rows["term"])  # -1 where there is none
        p, listed = rows["p"].to_numpy(), column < 0
        base, own = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        base[source[listed]], own[source[listed]] = p[listed], rows["own"].to_numpy()[listed]
        total = np.zeros((len(names), len(names)), np.int64)
        order = np.argsort(column, kind="stable")
        ordered = column[order]
        for begin in range(0, len(distinct), COLUMNS):
            end = min(begin + COLUMNS, len(distinct))
            part = order[np.searchsorted(ordered, begin):np.searchsorted(ordered, end)]
            dense = np.repeat(base[:, None], end - begin, axis=1)
            dense[source[part], column[part] - begin] = p[part]
            for a in range(len(names)):
                total[a] += np.abs(dense - dense[a]).sum(1)
        apart = ~np.eye(len(names), dtype=bool)
        if rows["i"].iloc[0] != rows["j"].iloc[0]:
            apart &= own[:, None] != own
        a, b = np.nonzero(apart)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "a": names[a], "b": names[b], "sum": total[a, b],
                             "terms": len(distinct), "gap": np.abs(base[a] - base[b])})

    found = tiles.groupBy("lang", "block", "i", "j").applyInPandas(tile, "lang string, a string, b string, sum long, terms long, gap long")
    return found.groupBy("lang", "a", "b").agg(F.sum("sum").alias("sum"), F.sum("terms").alias("terms"), F.min("gap").alias("gap"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``; see the head of this module."""
    counts = stage(term_counts(docs, text, lang, source), "source-terms")
    kept = stage(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(
        F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    held = stage(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source")))).distinct()
    zero = F.lit(0).cast("bigint")
    groups = names.join(held.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")))
    # With nothing kept there is nothing to share out; p0 is then never used.
    p0 = F.when(F.col("kept") > 0, share(zero, F.col("total"), F.greatest("kept", F.lit(1)))).otherwise(zero)
    groups = stage(groups.withColumn("p0", p0), "groups")
    entries = stage(held.join(broadcast_if_small(groups), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")), "shares")

    pairs = pair_sums(entries, groups).join(broadcast_if_small(stage(langs.select("lang", "kept"), "kept-sizes")), "lang", "left").select(
        "lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"),
        (F.col("sum") + (F.coalesce("kept", zero) - F.col("terms")) * F.col("gap")).alias("value"))
    own = entries.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = own.withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(best)
