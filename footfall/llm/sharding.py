"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws a number from
the row's key and the child's name; the weight of the child scales it, and the best draw
wins. A child whose weight does not change keeps its draws, so a change of weights
moves rows only into (or out of) the subtrees it touches. A shard that is added as a
region of its own takes rows only into itself.

The key is doc_id; null is a key like any other, and equal ids share a shard. Slots number
the rows of a shard from 0 without gaps, in order of the key's hash; rows that are equal
in id and text may change places. An empty table gives an empty result.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from footfall.llm.session import carries_columns

SHARDS = 40
RACKS_PER_REGION, SHARDS_PER_RACK = 4, 5
#: Hash ranges within a shard that are numbered on their own; 16 ** SLOT_DIGITS of them.
SLOT_DIGITS = 3
SEPARATE = 16  # bytes that each row adds to its text


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree(shards: int = SHARDS, grown: int = 0) -> list[Leaf]:
    """Regions of 4 racks of 5 shards, and `grown` more shards, each a region of its own."""
    per_region = RACKS_PER_REGION * SHARDS_PER_RACK
    leaves = [Leaf(f"r{i // per_region}", f"k{i // SHARDS_PER_RACK}", i) for i in range(shards)]
    return leaves + [Leaf(f"g{i}", f"g{i}", i) for i in range(shards, shards + grown)]


def _children(nodes: list[tuple[str, float, int]]) -> str:
    """SQL: an array of (name, weight, goto)."""
    return "array(" + ", ".join(f"named_struct('name', '{n}', 'weight', {float(w)}D, 'goto', {g})" for n, w, g in nodes) + ")"


def _best(key: str, children: str) -> str:
    """SQL: `goto` of the child with the least draw, an exponential variable of rate weight."""
    bits = f"cast(conv(left(md5(concat({key}, '/', x.name)), 13), 16, 10) as bigint)"
    draw = f"-ln(({bits} + 0.5D) / 4503599627370496D) / x.weight"
    return f"array_min(transform({children}, x -> struct({draw} as draw, x.goto as goto))).goto"


def assign_shards(docs: DataFrame, leaves: list[Leaf], column: str = "shard") -> DataFrame:
    """`docs` with the shard of each row in `column`, which replaces one of that name."""
    regions: dict[str, dict[str, list[Leaf]]] = {}
    for leaf in leaves:
        if leaf.weight > 0:
            regions.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)
    of_region, of_rack, top = [], [], []
    for region, racks in regions.items():
        below = []
        for rack, own in racks.items():
            name = f"{region}/{rack}"
            below.append((name, sum(x.weight for x in own), len(of_rack) + 1))
            of_rack.append(_children([(f"{name}/{x.shard}", x.weight, x.shard) for x in own]))
        top.append((region, sum(w for _, w, _ in below), len(of_region) + 1))
        of_region.append(_children(below))
    placed = docs.withColumn("_key", F.expr("coalesce(cast(doc_id as string), 'null')"))
    placed = placed.withColumn("_region", F.expr(_best("_key", _children(top))))
    placed = placed.withColumn("_rack", F.expr(_best("_key", f"element_at(array({', '.join(of_region)}), _region)")))
    shard = F.expr(_best("_key", f"element_at(array({', '.join(of_rack)}), _rack)"))
    return placed.withColumn(column, shard).drop("_key", "_region", "_rack")


def number_slots(rows: DataFrame, shard: str, order: list[str], slot: str = "slot") -> DataFrame:
    """`rows` with a gapless number from 0 within each shard, in the given order.

    The first column of `order` is a hexadecimal hash. Its first digits cut a shard into
    ranges; the ranges are counted, and rows are numbered within theirs.
    """
    part = F.left(order[0], F.lit(SLOT_DIGITS))
    cut = rows.withColumn("_part", part)
    sizes = cut.groupBy(shard, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy(shard, "_part").orderBy(*order))
    numbered = cut.join(starts, [shard, "_part"]).withColumn(slot, F.col("_start") + nth - 1)
    return numbered.drop("_part", "_start")


KEY_HASH = "md5(coalesce(cast(doc_id as string), 'null'))"


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of `docs`.

    size is the text's UTF-8 bytes plus 16; null has no bytes and no crc.
    """
    rows = docs.selectExpr(
        "doc_id",
        f"cast(coalesce(octet_length(text), 0) + {SEPARATE} as bigint) as size",
        "crc32(encode(text, 'UTF-8')) as text_crc32",
        f"{KEY_HASH} as _hash",
    )
    placed = assign_shards(assign_shards(rows, tree(shards)), tree(shards, 1), "grown_shard")
    numbered = number_slots(placed, "shard", ["_hash", "doc_id", "text_crc32", "size"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("bigint"), "grown_shard"
    )


@carries_columns
def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """`docs` with shard and slot, rows of a shard together; columns of these names are replaced."""
    rows = docs.drop("shard", "slot").withColumn("_hash", F.expr(KEY_HASH)).withColumn("_text", F.md5("text"))
    placed = assign_shards(rows, tree(shards))
    numbered = number_slots(placed, "shard", ["_hash", "doc_id", "_text"])
    return numbered.drop("_hash", "_text").withColumn("slot", F.col("slot").cast("bigint"))
