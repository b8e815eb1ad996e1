"""Hierarchical weighted hash tree: region, rack and shard are drawn one after the other.

At each level every child draws -ln(u) / weight, with u from a hash of the key and the child's path, and the
smallest draw wins. A child whose weight does not change keeps its draw, so rows only move into subtrees that
grew, or out of those that shrank. A new shard in a region of its own takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedhouse.llm.common import documents, settle

# region -> rack -> {shard: weight}
Tree = dict[str, dict[str, dict[int, float]]]

EIGHT: Tree = {
    "r0": {"a": {0: 1.0, 1: 1.0}, "b": {2: 1.0, 3: 1.0}},
    "r1": {"a": {4: 1.0, 5: 1.0}, "b": {6: 1.0, 7: 1.0}},
}
NINE: Tree = {**EIGHT, "r2": {"a": {8: 1.0}}}

# Rows of one shard that are numbered in one sort.
ROWS_PER_SORT = 250_000


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (int) that `key` draws. Equal keys, nulls too, draw the same shard."""
    racks = {r: {k: sum(shards.values()) for k, shards in inner.items()} for r, inner in tree.items()}
    regions = {r: sum(inner.values()) for r, inner in racks.items()}
    if not all(w > 0 for inner in tree.values() for shards in inner.values() for w in shards.values()):
        raise ValueError("weights must be above zero")

    def inside(region: str) -> Column:
        picked = {rack: _draw(key, f"{region}/{rack}", shards) for rack, shards in tree[region].items()}
        return _descend(_draw(key, region, racks[region]), picked)

    return _descend(_draw(key, "", regions), {r: inside(r) for r in tree}).cast("int")


def _descend(chosen: Column, results: dict[str, Column]) -> Column:
    if len(results) == 1:
        return next(iter(results.values()))
    return F.coalesce(*[F.when(chosen == name, result) for name, result in results.items()])


def _draw(key: Column, path: str, children: dict) -> Column:
    """The child with the smallest draw; ties, one in 2^53, go to the smaller name."""
    draws = []
    for name, weight in children.items():
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{path}/{name}")), 11)
        u = (bits.cast("double") + 0.5) * F.lit(2.0 ** -53)
        draws.append(F.struct((-F.log(u) / weight).alias("d"), F.lit(name).alias("name")))
    return draws[0]["name"] if len(draws) == 1 else F.array_min(F.array(*draws))["name"]


def with_slots(placed: DataFrame, order: list[str], rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """Add `slot`: 0, 1, 2 ... in each shard, without sorting a whole shard in one task.

    Rows of a shard are cut by a hash into buckets that are numbered on their own and set behind one another.
    `placed` is read more than once: pass a written table.
    """
    total = placed.count()
    buckets = max(1, -(-total // rows_per_sort))
    cut = placed.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)))
    sizes = cut.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = Window.partitionBy("shard", "_bucket").orderBy(*order)
    numbered = cut.withColumn("_rank", F.row_number().over(own))
    # One row per shard and bucket: shards * rows / rows_per_sort.
    return numbered.join(starts, ["shard", "_bucket"]).select(
        *placed.columns, (F.col("_start") + F.col("_rank") - 1).cast("bigint").alias("slot"))


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per document; equal ids share a shard.

    Null text has size 1 and the checksum of empty text. Only doc_id and text are used of the columns.
    """
    text = F.col("text").cast("binary")
    placed = settle(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree).alias("shard"),
        shard_of(F.col("doc_id"), grown).alias("grown_shard"),
    ), "placed")
    return with_slots(placed, ["doc_id", "text_crc32", "size"])


def op1_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), EIGHT, NINE)
