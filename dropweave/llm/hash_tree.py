"""Sharding by a weighted hash tree: regions hold racks, racks hold shards.

A row goes down the tree.  At each node every child draws -ln(u) / weight, where u in (0, 1) is a hash of the row's id
and the child's name, and the smallest draw wins.  A child is chosen in proportion to its weight, and a draw depends
on nothing but the row, the child and its weight.  So if weights change in one subtree, rows move only into or
out of it.  ``grown`` adds shards as regions of their own: all other draws stay what they were, and the only rows
that move go to the new shards.

Everything is built-in functions on a projection, staged once.  Rows are numbered by their place in the order of (shard, hash of the id, id, size, checksum, row): a
range partitioning that can cut through a shard, and through an id that a third of the rows share.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropweave.operators.ordering import place_in_group
from dropweave.session import stage

HEX_DIGITS = 12


@dataclass(frozen=True)
class Tree:
    """``regions[r][k]`` lists ``(shard, weight)`` of rack k in region r; a rack or region weighs what it holds."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def regular(cls, regions: int, racks: int, shards: int) -> Tree:
        """Regions of equal racks of equal shards, numbered in order."""
        number = iter(range(regions * racks * shards))
        return cls(tuple(tuple(tuple((next(number), 1.0) for _ in range(shards)) for _ in range(racks))
                         for _ in range(regions)))

    @property
    def shards(self) -> list[int]:
        return [shard for region in self.regions for rack in region for shard, _ in rack]

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a rack and region of its own."""
        return Tree((*self.regions, (((max(self.shards, default=-1) + 1, weight),),)))


def _rack_weight(rack: tuple[tuple[int, float], ...]) -> float:
    return sum(weight for _, weight in rack)


def hashed(text: Column) -> Column:
    """The first hex digits of md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint")


def _descend(key: Column, level: str, children: list[tuple[str, float, Column]]) -> Column:
    """What belongs to the child with the smallest draw, the first of equals.  Children: name, weight, result."""
    drawn = []
    for place, (name, weight, result) in enumerate(children):
        if weight > 0:
            u = (hashed(F.concat_ws("/", key, F.lit(level), F.lit(name))) + F.lit(0.5)) / F.lit(float(16 ** HEX_DIGITS))
            drawn.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("draw"), F.lit(place).alias("place"),
                                  result.alias("result")))
    return F.array_min(F.array(*drawn))["result"]


def place(key: Column, tree: Tree) -> Column:
    """The shard of a row with this key (text, not null)."""
    def in_rack(r: int, k: int) -> Column:
        rack = tree.regions[r][k]
        return _descend(key, "shard", [(str(shard), weight, F.lit(shard)) for shard, weight in rack])

    def in_region(r: int, chosen: Column) -> Column:
        out = F.lit(None).cast("int")
        for k in range(len(tree.regions[r]) - 1, -1, -1):
            out = F.when(chosen == k, in_rack(r, k)).otherwise(out)
        return out

    region = _descend(key, "region", [(str(r), sum(map(_rack_weight, racks)), F.lit(r))
                                      for r, racks in enumerate(tree.regions)])
    out = F.lit(None).cast("int")
    for r in range(len(tree.regions) - 1, -1, -1):
        racks = tree.regions[r]
        rack = _descend(key, "rack", [(f"{r}.{k}", _rack_weight(rack), F.lit(k)) for k, rack in enumerate(racks)])
        out = F.when(region == r, in_region(r, rack) if len(racks) > 1 else in_rack(r, 0)).otherwise(out)
    return out


def shard(docs: DataFrame, tree: Tree, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard)`` of every row.

    ``size``: UTF-8 bytes of the text (null: none) plus 16.  ``text_crc32`` of a null text is 0, as of an empty one.
    The law is ``key``: id and tree decide, nothing else.  A null id is hashed as the word ``null``; repeated rows get the same shard
    and slots of their own.  ``slot`` counts the rows of a shard from 0 by the hash of their id, then id, size and checksum.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    key = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    rows = stage(docs.select(
        F.col(id_column), (F.octet_length(content) + 16).cast("bigint").alias("size"), F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"), place(key, tree).alias("shard"), place(key, tree.grown()).alias("grown_shard"),
        hashed(key).alias("_hash"), F.monotonically_increasing_id().alias("_row")), "sharded")
    numbered = place_in_group(rows, ["shard"], ["_hash", id_column, "size", "text_crc32", "_row"], "slot")
    return numbered.select(id_column, "size", "text_crc32", "law", "shard", F.col("slot").cast("bigint").alias("slot"), "grown_shard")
