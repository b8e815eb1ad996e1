"""Hash tree: checksums, slots, confined movement, weights."""

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from conftest_helpers import multiset, texts_of
from feedhouse.llm import sharding


def placed(spark, n, tree):
    return dict(spark.range(n).select("id", sharding.shard_of(F.col("id"), tree)).collect())


def test_rows_of_awkward_documents(awkward):
    rows = sharding.shard_documents(awkward, sharding.EIGHT, sharding.NINE).collect()
    found = multiset((r.doc_id, r["size"], r.text_crc32) for r in rows)
    assert found == multiset((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts_of(awkward))
    shards, by_id = defaultdict(list), defaultdict(set)
    for r in rows:
        shards[r.shard].append(r.slot)
        by_id[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert all(len(s) == 1 for s in by_id.values())


def test_slots_over_many_buckets(awkward):
    frame = awkward.select("doc_id", F.lit(0).alias("shard"))
    slots = [r.slot for r in sharding.with_slots(frame, ["doc_id"], rows_per_sort=7).collect()]
    assert sorted(slots) == list(range(frame.count()))


def test_a_new_shard_takes_rows_only_into_itself(spark):
    before, after = placed(spark, 20_000, sharding.EIGHT), placed(spark, 20_000, sharding.NINE)
    moved = [k for k in before if before[k] != after[k]]
    assert {after[k] for k in moved} == {8}
    assert abs(len(moved) / 20_000 - 1 / 9) < 0.01


def test_movement_stays_in_the_changed_subtree(spark):
    heavier = {**sharding.EIGHT, "r1": {**sharding.EIGHT["r1"], "b": {6: 1.0, 7: 3.0}}}
    before, after = placed(spark, 20_000, sharding.EIGHT), placed(spark, 20_000, heavier)
    moves = Counter((before[k], after[k]) for k in before if before[k] != after[k])
    # Into the region that grew, from others; inside it only into the rack that grew, and there into the shard.
    assert all(b >= 4 if a < 4 else (a < 6 <= b or (a, b) == (6, 7)) for a, b in moves)
    assert sum(n for (_, b), n in moves.items() if b == 7) > sum(moves.values()) / 2


def test_shares_follow_weights(spark):
    tree = {"x": {"a": {0: 1.0}, "b": {1: 2.0}}, "y": {"a": {2: 5.0}}}
    counts = Counter(placed(spark, 40_000, tree).values())
    assert all(abs(counts[s] / 40_000 - w / 8) < 0.01 for s, w in ((0, 1), (1, 2), (2, 5)))


def test_empty_table(nothing):
    assert sharding.shard_documents(nothing, sharding.EIGHT, sharding.NINE).collect() == []
