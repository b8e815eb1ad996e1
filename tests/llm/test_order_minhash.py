"""Near duplicates against alignment of all pairs that share a shingle."""

import random
from collections import defaultdict

import numpy as np

from conftest_helpers import multiset, texts_of
from conftest import prose
from feedhouse.llm import order_minhash as omh
from feedhouse.llm.common import marked


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def is_near(a, b):
    m = longest_common(a, b)
    return m / (len(a) + len(b) - m) >= 0.8 - 1e-12


def test_alignment_equals_full_table():
    draw = random.Random(3)
    for _ in range(400):
        a = [draw.randint(0, 30) for _ in range(draw.randint(1, 60))]
        b = list(a)
        for _ in range(draw.randint(0, 8)):
            k = draw.randrange(len(b) + 1)
            if draw.random() < 0.5 and k < len(b):
                b.pop(k)
            else:
                b.insert(k, draw.randint(0, 30))
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        if b:
            assert omh.aligned(x, y, len(a) + len(b)) == longest_common(a, b)
            assert omh.similar(x, y, 0.8) == is_near(a, b)


def test_sketch_minds_order_and_repetition():
    settings = omh.Settings()
    h = lambda text: omh.shingles(omh.words_of(text.encode()), 5)
    text = prose(random.Random(1), 200)
    words = text.split()
    swapped = " ".join(words[100:] + words[:100])
    same = lambda a, b: int((omh.sketch(h(a), settings) == omh.sketch(h(b), settings)).sum())
    assert same(text, text) == settings.tables
    assert 4 < same(text, swapped) < 20
    assert len(set(omh.labelled(h("a b c d e " * 20)).tolist())) == 96


def classes(rows, distinct_links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in distinct_links:
        parent[find(a)] = find(b)
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[find(text)].append(doc_id)
    return multiset(sorted(g, key=str) for g in groups.values())


def near_corpus():
    draw = random.Random(5)
    rows = []
    for i in range(40):
        words = prose(draw, draw.randint(20, 150)).split()
        for k in range(draw.choice([1, 1, 2, 6])):
            own = list(words)
            for _ in range(int(len(own) * draw.choice([0, 0.02, 0.05, 0.07]))):
                own[draw.randrange(len(own))] = "new" + str(draw.random())[2:6]
            rows.append((1000 * i + k, " ".join(own)))
    # A passage that many otherwise different texts share.
    passage = prose(draw, 60)
    rows += [(90_000 + i, passage + " " + prose(draw, 60)) for i in range(30)]
    return rows


def test_classes_equal_brute_force(spark, tmp_path):
    rows = near_corpus()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    found = omh.near_duplicates(spark.read.parquet(str(tmp_path / "d"))).collect()
    groups = defaultdict(list)
    for r in found:
        groups[r.class_id].append(r.doc_id)
    texts = sorted({t for _, t in rows})
    links = [(a, b) for i, a in enumerate(texts) for b in texts[i + 1 :]
             if 0.7 < len(a.split()) / len(b.split()) < 1.4 and is_near(a.split(), b.split())]
    assert len(links) > 20
    assert multiset(sorted(g, key=str) for g in groups.values()) == classes(rows, links)
    assert all(sum(r.kept for r in found if r.class_id == c) == 1 for c in groups)


def test_large_buckets_are_compared_in_full(spark, tmp_path):
    """Variants that are near their original only, in buckets of several crowds."""
    draw = random.Random(12)
    words = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(words))]
    for i in range(1, 500):
        own = list(words)
        for k in draw.sample(range(100), 8):
            own[k] = f"v{i}x{k}"
        rows.append((i, " ".join(own)))
    draw.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    settings = omh.Settings(crowd=20)
    found = omh.near_duplicates(spark.read.parquet(str(tmp_path / "d")), settings).collect()
    hashes = {i: omh.words_of(t.encode()) for i, t in rows}
    keys = {i: set(omh.sketch(omh.shingles(h, 5), settings).tolist()) for i, h in hashes.items()}
    near = {i for i in hashes if keys[0] & keys[i] and omh.similar(hashes[0], hashes[i], 0.8)}
    assert len(near) > 490 and max(sum(k in own for own in keys.values()) for k in keys[0]) > 100
    own_class = {r.class_id for r in found if r.doc_id == 0}
    assert near <= {r.doc_id for r in found if r.class_id in own_class}


def test_buckets_of_one_class_are_dealt_once(spark):
    """Ten tables hold the same class of 60 and 20 others: ten times the buckets are no more rows."""
    rows = [(key, i, 0 if i < 60 else i) for key in range(10) for i in range(80)] + [(99, 500, 500), (99, 501, 501)]
    frame = lambda x: spark.createDataFrame(x, "key long, id long, part long")
    dealt = omh.dealt_crowds(frame(rows), 20).collect()
    once = omh.dealt_crowds(frame(rows[:80] + rows[-2:]), 20).collect()
    assert multiset((r.low, r.high, r.id) for r in dealt) == multiset((r.low, r.high, r.id) for r in once)
    tasks = defaultdict(set)
    for r in dealt:
        tasks[r.key, r.low, r.high].add(r.id)
    assert all(any({i, j} <= own for own in tasks.values()) for i in range(60, 80) for j in range(80) if i != j)


def test_turns_do_not_grow_with_false_buckets(spark, tmp_path, monkeypatch):
    """Texts that share a passage and are not alike: further turns link next to nothing, so few are made."""
    draw = random.Random(3)
    passage = prose(draw, 90)
    rows = [(i, passage + " " + prose(draw, 60)) for i in range(300)]
    rows += [(1000 + i, text + " end") for i, text in rows[::10]]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "d"))
    turns = []
    pairs = omh.star_pairs
    monkeypatch.setattr(omh, "star_pairs", lambda members, turn, least: turns.append(turn) or pairs(members, turn, least))
    found = omh.near_duplicates(spark.read.parquet(str(tmp_path / "d")), omh.Settings(crowd=10)).collect()
    class_of = {r.doc_id: r.class_id for r in found}
    assert all(class_of[i] == class_of[1000 + i] for i in range(0, 300, 10)) and len(set(class_of.values())) == 300
    assert len(turns) <= 3


def test_wanted_texts_are_told_without_moving_any(spark, tmp_path):
    rows = [(f << 40 | i, f"text {i}") for f in range(3) for i in (0, 1, 7, 8, 32767, 32768, 32769, 70_000)]
    spark.createDataFrame(rows, "rid long, text string").write.parquet(str(tmp_path / "t"))
    ids = [r for r, _ in rows[::3]] + [5, 1 << 41]
    texts = spark.read.parquet(str(tmp_path / "t"))
    told = marked(texts, spark.createDataFrame([(i,) for i in ids * 2], "a long"))
    assert {r.rid for r in told.where("_marked").collect()} == set(ids) & {r for r, _ in rows}
    assert sorted(r.rid for r in told.collect()) == sorted(r for r, _ in rows)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not told.where("_marked is null").count()


def test_awkward_documents(awkward):
    rows = omh.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_text = defaultdict(set)
    kept = defaultdict(int)
    text_of = dict(texts_of(awkward.where("doc_id is not null and doc_id <> 2")))
    for r in rows:
        if r.doc_id in text_of:
            by_text[text_of[r.doc_id]].add(r.class_id)
        kept[r.class_id] += r.kept
    assert all(len(c) == 1 for c in by_text.values())
    stage = omh.keep_first(awkward)
    assert stage.columns == awkward.columns and stage.count() == sum(r.kept for r in rows)


def test_components(spark):
    links = [(i, i + 1) for i in range(10, 30)] + [(50, 7), (7, 60), (100, 101), (5, 5)]
    for chunk in (200_000, 6):
        found = dict(omh.components(spark.createDataFrame(links, "a long, b long"), chunk).collect())
        assert found == {**{i: 10 for i in range(10, 31)}, 50: 7, 7: 7, 60: 7, 100: 100, 101: 100}


def test_empty_table(nothing):
    assert omh.near_duplicates(nothing).collect() == []
    assert omh.keep_first(nothing).collect() == []
