"""Documents that share most of their word shingles: a grouped prefix join, and the components of its links.

A document's set is its distinct shingles of ``size`` words (the whole sequence if it has fewer), as 64-bit hashes.  Two documents
link when 100 * intersection >= percent * union.

1. A fixed-size table of counts of hash buckets, added up over all shingles of all documents, orders shingles from
   rare to frequent (then by hash).  Any fixed order gives right results; this one keeps frequent ones out of prefixes.
2. Documents with equal sets (size and 128 bits of set digest) are one class.  Linked documents share a shingle among the first
   n - ceil(n * percent / 100) + 1 of either, the prefix.  Documents with equal prefixes and sizes form one group, which stands for
   them all in the join.
3. Prefix shingles of a single group are dropped after a count.  The first group pairs join every group of a shingle to one pivot,
   so a shingle with n groups gives n pairs, not n * n.  Pairs whose sizes cannot link are dropped; the rest are
   expanded to members and verified on whole texts.
4. Components of these links leave only shingles whose groups lie in several components; of their pairs across components those
   that share as many prefix shingles as linked documents must are expanded and verified: all pairs of lists of up to ``LIST`` groups, and in
   rounds the likeliest pairs of each component for longer ones (``Tiles``).  Pairs inside a component can change no component and need no
   test, and the rounds end when no pair across components is untested, so no link between components is lost.

Verification sends a hub document and its partners to a task in portions of ``PORTION`` pairs, and holds one hub at a time.
Texts are fetched by id: the ids are broadcast up to ``BROADCAST_IDS`` after they were counted, and joined beyond.

Null and empty texts, and texts without words, have size 0, link with nothing and are their own component.  Rows with a null id
have a null component and link with nothing.  Rows that share an id are nodes of their own, one for each text; two texts that have
the same smallest id share their links.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropweave.llm._common import dealt, text_chunks
from dropweave.llm._components import components
from dropweave.llm._words import NOT_BLANK, mixed, words
from dropweave.session import stage

SIZE, PERCENT = 5, 80
BUCKETS, SLICES = 1 << 22, 64
MERGED = 256
LIST, TILE, COLUMNS = 64, 256, 4096
MOST, GROWTH = 4, 16  # pairs of a component that a tile returns in the first round, and how many times more in each later one
PORTION = 256
BROADCAST_IDS = 2_000_000
SETS = "doc_id long, n long, d1 long, d2 long, g long, prefix array<long>"


def shingles(texts: list[bytes], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within a text, and their number per text."""
    found = words([t.lower() for t in texts], NOT_BLANK)  # bytes.lower changes A-Z only
    counts, h = found.counts, found.hashes
    first = np.cumsum(counts) - counts
    place = np.arange(len(h)) - np.repeat(first, counts)
    left = np.repeat(counts, counts) - place
    # A shingle starts at every word with enough words after it, and at the first word of a shorter text.
    starts = np.flatnonzero((left >= size) | (place == 0))
    length = np.minimum(left[starts], size)
    total = mixed(length.astype(np.uint64))
    for step in range(size):
        live = length > step
        total[live] = mixed(total[live] * np.uint64(0x9E3779B97F4A7C15) + h[starts[live] + step])
    text = found.text[starts]
    order = np.lexsort((total, text))
    total, text = total[order], text[order]
    keep = np.ones(len(total), bool)
    keep[1:] = (total[1:] != total[:-1]) | (text[1:] != text[:-1])
    return total[keep], np.bincount(text[keep], minlength=len(texts))


def _coded(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t.encode("utf-8", "replace") if t else b"" for t in batch.column(column).to_pylist()]


def bucket_counts(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """How many shingles of all documents fall in each bucket: 16 MB whatever the input.  Counts stop at 2**32 - 1."""
    width = BUCKETS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, salt = np.zeros(BUCKETS, np.int64), 0
        for batch in text_chunks(batches, text):
            hashes, _ = shingles(_coded(batch, text), size)
            total += np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
            salt = int(total.sum()) % 65_521
        yield _slices(total.reshape(SLICES, width), salt)

    def packed_counts(row: np.ndarray) -> bytes:
        return zlib.compress(np.minimum(row, 2**32 - 1).astype(np.uint32).tobytes(), 1)

    def _slices(rows: np.ndarray, salt: int) -> pa.RecordBatch:
        packed = [packed_counts(row) for row in rows]
        return pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()),
                                           "salt": pa.array([salt] * SLICES, pa.int32()), "counts": pa.array(packed, pa.binary())})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.int64) for c in group["counts"])
        return group.iloc[:1].assign(counts=[packed_counts(total)])

    schema = "slice int, salt int, counts binary"
    partial = docs.select(text).mapInArrow(count, schema)
    # Two rounds: first a few hundred tables at most in a group, then one row per slice and first-round group.
    partial = partial.withColumn("salt", F.pmod("salt", F.lit(MERGED)))
    merged = partial.groupBy("slice", "salt").applyInPandas(add, schema).groupBy("slice").applyInPandas(add, schema)
    out = np.zeros((SLICES, width), np.uint32)
    for row in merged.collect():  # SLICES rows of a fixed size
        out[row.slice] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return out.reshape(-1)


def sets(docs: DataFrame, id_column: str, text: str, size: int, percent: int) -> DataFrame:
    """Size, digest, group and prefix of every document, staged."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sent = spark.sparkContext.broadcast(bucket_counts(source, "text", size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            coded = _coded(batch, "text")
            hashes, counts = shingles(coded, size)
            doc = np.repeat(np.arange(len(counts)), counts)
            begin = np.cumsum(counts) - counts
            prefix_size = np.where(counts > 0, counts - (counts * percent + 99) // 100 + 1, 0)
            order = np.lexsort((hashes, sent.value[(hashes % np.uint64(BUCKETS)).astype(np.int64)], doc))
            place = np.arange(len(hashes)) - np.repeat(begin, counts)
            prefix = hashes[order][place < np.repeat(prefix_size, counts)]
            ends = np.concatenate([[0], np.cumsum(prefix_size)])
            full = counts > 0
            digest = np.zeros((3, len(counts)), np.uint64)
            if full.any():
                digest[0, full] = np.add.reduceat(mixed(hashes ^ np.uint64(0xA5A5)), begin[full])
                digest[1, full] = np.add.reduceat(mixed(hashes ^ np.uint64(0x5A5A5A)), begin[full])
                digest[2, full] = mixed(np.add.reduceat(mixed(prefix ^ np.uint64(0xC3C3)), ends[:-1][full])
                                        + mixed(counts[full].astype(np.uint64)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()), *(pa.array(d.view(np.int64)) for d in digest),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(prefix.view(np.int64)))],
                ["doc_id", "n", "d1", "d2", "g", "prefix"])

    return stage(source.mapInArrow(run, SETS), "shingle-sets")


def _sizes_fit(percent: int, a: str = "n_a", b: str = "n_b") -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verify(pairs: DataFrame, docs: DataFrame, id_column: str, text: str, size: int, percent: int) -> DataFrame:
    """The pairs of ``(a, b)`` (ids) whose documents link, as ``(a, b)``."""
    spark = pairs.sparkSession
    pairs = stage(pairs.select("a", "b"), "pairs")
    count = pairs.count()
    pairs = stage(dealt(pairs, count, "a", "b").distinct(), "distinct-pairs")
    ids = stage(dealt(pairs.select(F.explode(F.array("a", "b")).alias("id")), 2 * count, "id").distinct(), "pair-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Grouped by id and not staged: both joins below take the rows as they lie.
    texts = texts.join(ids, "id", "left_semi").groupBy("id").agg(F.collect_set("text").alias("texts"))
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PORTION).cast("int").alias("portions"))
    hubs = sizes.join(texts.withColumnRenamed("id", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"), F.lit(None).cast("long").alias("b"), "texts").select(
        "a", "portion", "b", F.explode("texts").alias("text"))
    partners = pairs.join(sizes, "a").join(texts.withColumnRenamed("id", "b"), "b").select(
        "a", F.pmod(F.xxhash64("b"), F.col("portions").cast("long")).cast("int").alias("portion"), "b", F.explode("texts").alias("text"))
    # Portions are small against a partition; the hub comes first in its portion.
    sent = hubs.union(partners).repartition("a", "portion").sortWithinPartitions("a", "portion", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hubs = None, []  # sets of the hub: more than one if several texts have its id
        for batch in text_chunks(batches, "text"):
            hashes, counts = shingles(_coded(batch, "text"), size)
            ends = np.cumsum(counts)
            out = ([], [])
            for a, portion, b, end, n in zip(*(batch.column(i).to_pylist() for i in range(3)), ends.tolist(), counts.tolist()):
                own = hashes[end - n:end]
                if b is None:
                    hubs = [*hubs, own] if key == (a, portion) else [own]
                    key = a, portion
                    continue
                assert key == (a, portion)
                for hub in hubs:
                    at = np.minimum(np.searchsorted(hub, own), len(hub) - 1) if len(hub) else own[:0].astype(np.int64)
                    both = int((hub[at] == own).sum()) if len(hub) else 0
                    if both and 100 * both >= percent * (len(hub) + n - both):
                        out[0].append(a)
                        out[1].append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["a", "b"])

    return sent.mapInArrow(run, "a long, b long")


def linked(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` and the set's digest for every row of ``docs``."""
    found = sets(docs, id_column, text, size, percent)
    nodes = found.filter("n > 0 AND doc_id IS NOT NULL")
    # A class is known by its smallest id.
    classes = stage(nodes.groupBy("n", "d1", "d2", "g").agg(F.min("doc_id").alias("rep")), "classes")
    groups = stage(classes.groupBy("g").agg(F.min("n").alias("n"), F.min("rep").alias("leader"), F.count(F.lit(1)).alias("members")), "groups")
    postings = nodes.select("g", F.explode("prefix").alias("token"))
    shared = stage(postings.groupBy("token").agg(F.min("g").alias("pivot"), F.max("g").alias("_last")).filter("pivot <> _last")
                   .select("token", "pivot"), "shared-shingles")
    held = stage(postings.join(shared, "token").distinct(), "shared-postings")

    def sized(pairs: DataFrame) -> DataFrame:
        a, b = (groups.select(F.col("g").alias(f"g_{s}"), F.col("n").alias(f"n_{s}"), F.col("leader").alias(f"leader_{s}")) for s in "ab")
        return pairs.join(a, "g_a").join(b, "g_b").filter(_sizes_fit(percent))

    # Pairs that share few shingles of one pivot are left to the last step, which counts all they share.
    stars = sized(held.filter("g <> pivot").groupBy(F.col("pivot").alias("g_a"), F.col("g").alias("g_b")).agg(
        F.count(F.lit(1)).alias("shared"))).filter(F.col("shared") * 2 >= least_shared(
            percent, F.col("n_a"), F.col("n_b"), F.greatest, lambda x: F.ceil(x)))
    member = classes.select(F.col("g").alias("g_m"), F.col("rep").alias("m"))
    several = classes.join(groups.filter("members > 1").select("g", "leader"), "g").filter("rep <> leader")
    # The pivot's leader with every member of the other group, the other leader with the pivot's members, leader with own members.
    first = stars.join(member, stars["g_b"] == member["g_m"]).select(F.col("leader_a").alias("a"), F.col("m").alias("b")).union(
        stars.join(several.select(F.col("g").alias("g_m"), F.col("rep").alias("m")), F.col("g_a") == F.col("g_m")).select("leader_b", "m")).union(
        several.select("leader", "rep"))
    links = stage(verify(first, docs_of(docs, id_column, text), "id", "text", size, percent), "first-links")
    known = stage(components(links), "first-components")

    # What is left is between components.  Rounds test some of it, until no pair of groups across components is untested.
    inside = stage(classes.join(groups.filter("members > 1").select("g"), "g").select("g", "rep"), "several-members")
    n_classes = classes.count()
    tested, round_, tiles = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), 0, None
    while True:
        placed = stage(classes.join(known.withColumnRenamed("node", "rep"), "rep", "left").select(
            "g", "n", "rep", F.coalesce("component", "rep").alias("component")), "placed-members")
        spans = stage(dealt(placed, n_classes, "g").groupBy("g").agg(F.min("n").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")), "spans")
        if round_ == 0:
            apart = (held.select("token", "g").join(spans, "g").groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high"))
                     .filter("low <> high").select("token"))
            open_ = stage(held.select("token", "g").join(apart, "token").join(spans, "g"), "open-postings")
            marked = by_length(open_)
            tiles = Tiles.of(marked)
            across = pairs_of_short_lists(marked, percent).union(tiles.candidates(spans, percent, round_))
        else:
            across = tiles.candidates(spans, percent, round_)
        across = stage(across, "pairs-across")
        across = dealt(across, across.count(), "g_a", "g_b").distinct()
        if round_ and across.isEmpty():  # then no tile holds a pair back
            break
        one, two = (placed.select(F.col("g").alias(f"g_{s}"), F.col("rep").alias(s), F.col("component").alias(f"c_{s}")) for s in "ab")
        rest = across.join(one, "g_a").join(two, "g_b").filter("c_a <> c_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        if round_ == 0:
            of_group = placed.join(inside, ["g", "rep"]).select("g", F.col("rep").alias("a"), F.col("component").alias("c_a"))
            rest = rest.union(of_group.join(of_group.select("g", F.col("a").alias("b"), F.col("c_a").alias("c_b")), "g").filter(
                "a < b AND c_a <> c_b").select("a", "b"))
        rest = stage(rest.join(tested, ["a", "b"], "left_anti"), "untested-pairs")
        more = stage(verify(rest, docs_of(docs, id_column, text), "id", "text", size, percent), "more-links")
        if not more.isEmpty():
            known = stage(components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "components")
        if tiles.ended:
            break
        tested = stage(tested.union(rest), "tested-pairs")
        round_ += 1
    final = known
    reps = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    return found.select("doc_id", "n", "d1", "d2").join(reps, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"), "d1", "d2")


def least_shared(percent: int, n_a, n_b, at_least, ceil):
    """The fewest prefix shingles that linked documents share.

    They share at least percent / (100 + percent) of both sizes.  Of two prefixes take the one that ends first in the order:
    beyond its end its document has ceil(n * percent / 100) - 1 shingles left, and all that is shared before lies in both prefixes.
    """
    return ceil((n_a + n_b) * percent / (100 + percent)) - ceil(at_least(n_a, n_b) * percent / 100) + 1


def by_length(postings: DataFrame) -> DataFrame:
    """``postings`` ``(token, g, n, low, high)`` with ``pivot``, the smallest group of the token's list, if more than ``LIST`` groups are in it; staged."""
    long_lists = stage(postings.groupBy("token").agg(F.min("g").alias("pivot"), F.count(F.lit(1)).alias("held")).filter(
        F.col("held") > LIST).select("token", "pivot"), "long-lists")
    return stage(postings.join(long_lists, "token", "left"), "marked-postings")


def pairs_of_short_lists(marked: DataFrame, percent: int) -> DataFrame:
    """``(g_a, g_b)`` of groups with members in different components that share a short list, and may share enough to link."""
    in_long = marked.groupBy("g").agg(F.count("pivot").alias("long"))
    short = marked.filter("pivot IS NULL").join(in_long, "g")
    left, right = (short.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("g", "n", "low", "high", "long"))) for s in "ab")
    apart = (F.col("low_a") != F.col("low_b")) | (F.col("low_a") != F.col("high_a")) | (F.col("low_b") != F.col("high_b"))
    counted = left.join(right, "token").filter((F.col("g_a") < F.col("g_b")) & _sizes_fit(percent) & apart).groupBy("g_a", "g_b").agg(
        F.count(F.lit(1)).alias("shared"), F.min("n_a").alias("n_a"), F.min("n_b").alias("n_b"), F.min(F.least("long_a", "long_b")).alias("long"))
    return counted.filter(F.col("shared") + F.col("long") >= least_shared(
        percent, F.col("n_a"), F.col("n_b"), F.greatest, lambda x: F.ceil(x))).select("g_a", "g_b")


class Tiles:
    """The groups of long lists: gathered by the pivot of the list, cut into blocks of about ``TILE``; each pair of blocks is a tile.

    A tile counts what its groups share, and returns for each component in it the likeliest pairs with other components
    that it has not returned before: ``MOST`` in the first round, which has tiles of one block only, and ``GROWTH`` times as many in each later one.
    So n near copies in components of their own give a few times n pairs, not n * n; those that link leave fewer components for the next round,
    and the ever larger number of pairs ends what does not link.  ``ended`` says that no tile has held a pair back.
    """

    def __init__(self, rows: DataFrame, contents: DataFrame) -> None:
        self.rows, self.contents, self.size, self.ended = rows, contents, rows.count(), False
        self.returned = stage(rows.select("pivot", "i", "j", F.col("g").alias("g_a"), F.col("g").alias("g_b")).limit(0), "returned")

    @classmethod
    def of(cls, marked: DataFrame) -> Tiles:
        places = marked.filter("pivot IS NOT NULL").select("pivot", "g").distinct()
        blocks = places.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
        contents = marked.groupBy("g").agg(F.collect_list("token").alias("tokens"))  # a document's prefix at most
        own = F.pmod(F.xxhash64("g"), F.col("blocks").cast("long")).cast("int")
        rows = (places.join(blocks, "pivot").withColumn("own", own)
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "g"))
        return cls(stage(rows, "tiles"), stage(contents, "tile-contents"))

    def candidates(self, spans: DataFrame, percent: int, round_: int) -> DataFrame:
        """``(g_a, g_b)``; ``spans`` are the smallest and largest component of each group now."""
        most = MOST * GROWTH ** round_
        rows = self.rows.filter("i = j") if round_ == 0 else self.rows
        key = ["pivot", "i", "j"]
        rows = rows.join(spans, "g")
        open_ = dealt(rows, self.size, *key).groupBy(*key).agg(F.min("low").alias("_low"), F.max("high").alias("_high")).filter("_low <> _high").select(*key)
        rows = rows.join(stage(open_, "open-tiles"), key).join(self.contents, "g")

        def count(tile: pd.DataFrame, returned: pd.DataFrame) -> pd.DataFrame:
            if tile.empty:
                return pd.DataFrame({c: np.zeros(0, np.int64) for c in (*key, "g_a", "g_b", "kept_back")})
            tile = tile.sort_values("g", ignore_index=True)
            flat = np.concatenate(tile["tokens"].to_numpy())
            row = np.repeat(np.arange(len(tile)), tile["tokens"].map(len))
            column = np.unique(flat, return_inverse=True)[1]
            shared = np.zeros((len(tile), len(tile)), np.float32)
            for first in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
                part = (column >= first) & (column < first + COLUMNS)
                held = np.zeros((len(tile), COLUMNS), np.float32)
                held[row[part], column[part] - first] = 1
                shared += held @ held.T
            g, n, low, high, block = (tile[c].to_numpy() for c in ("g", "n", "low", "high", "own"))
            big, small = np.maximum(n[:, None], n), np.minimum(n[:, None], n)
            needed = (-(-(big + small) * percent // (100 + percent)) - -(-big * percent // 100) + 1)
            ok = (shared >= np.maximum(needed, 1)) & (small * 100 >= big * percent)
            ok &= (low[:, None] != low) | (low != high)[:, None] | (low != high)
            if tile["i"].iloc[0] != tile["j"].iloc[0]:
                ok &= block[:, None] != block
            ok[np.searchsorted(g, returned["g_a"].to_numpy()), np.searchsorted(g, returned["g_b"].to_numpy())] = False
            a, b = np.nonzero(np.triu(ok, 1))
            # Each pair twice: as one of the component of either side.
            component, pair = np.concatenate([low[a], low[b]]), np.tile(np.arange(len(a)), 2)
            order = np.lexsort((pair, -shared[a, b][pair], component))
            place = np.arange(len(order)) - np.searchsorted(component[order], component[order], "left")
            chosen = np.unique(pair[order[place < most]])
            return pd.DataFrame({**{c: np.full(len(chosen), tile[c].iloc[0]) for c in key}, "g_a": g[a[chosen]], "g_b": g[b[chosen]],
                                 "kept_back": np.full(len(chosen), len(chosen) < len(a))})

        # A tile is a few MB, so a task has few of them.
        tiles, returned = (dealt(t, self.size, *key, per_task=8 * TILE) for t in (rows, self.returned))
        found = stage(tiles.groupBy(*key).cogroup(returned.groupBy(*key)).applyInPandas(
            count, "pivot long, i int, j int, g_a long, g_b long, kept_back boolean"), "tile-pairs")
        all_tiles = round_ > 0 or self.rows.filter("i <> j").isEmpty()
        self.ended = all_tiles and found.filter("kept_back").isEmpty()
        found = found.drop("kept_back")
        self.returned = stage(self.returned.union(found), "returned")
        return found.select("g_a", "g_b")


def docs_of(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))


def representatives(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, and of texts that share it that with the smallest hash.

    Rows are told apart by id and text, so texts that share an id have links and fates of their own.  Of rows with equal ids and
    texts that with the smallest hash of all columns stays.  Rows with a null id, and texts without words, all stay.
    """
    own = F.col(id_column).cast("long")
    node = F.when(own.isNotNull(), F.xxhash64(own, text))
    found = linked(docs.select(node.alias("_node"), F.col(text).alias("text")), "_node", "text", **settings)
    # One row for each id and text, with the number of rows that have them.
    parts = stage(found.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id", "component_id").agg(
        F.count(F.lit(1)).alias("rows")), "members")
    ids = docs.select(own.alias("_id"), node.alias("_node")).filter("_id IS NOT NULL").distinct()
    members = stage(parts.join(ids, parts["doc_id"] == ids["_node"]).select("_id", "_node", "component_id", "rows"), "member-ids")
    best = members.groupBy("component_id").agg(F.min(F.struct("_id", "_node")).alias("best"))
    gone = members.join(best, "component_id").filter(F.struct("_id", "_node") != F.col("best")).select("_id", "_node")
    kept = docs.join(gone, (own == gone["_id"]) & (node == gone["_node"]), "left_anti")
    again = stage(members.filter("rows > 1").select("_id", "_node"), "repeated-members")
    if again.isEmpty():
        return kept
    repeated = (own == again["_id"]) & (node == again["_node"])
    whole = F.xxhash64(*(c for c, kind in docs.dtypes if "map<" not in kind))
    one = kept.join(again, repeated, "left_semi").groupBy(own.alias("_id"), node.alias("_node")).agg(
        F.min_by(F.struct(*docs.columns), whole).alias("_row")).select("_row.*")
    return kept.join(again, repeated, "left_anti").union(one)
