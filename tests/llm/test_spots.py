"""Spot fingerprints: every document beside the next, and classes against all pairs."""

import hashlib
import random
from collections import defaultdict

import numpy as np

from conftest import prose
from conftest_helpers import multiset
from feedhouse.llm import spots
from feedhouse.llm.repeats import with_rid

SETTINGS = spots.Settings()


def plain_spots(text):
    """Chains as tuples of words, without hashes."""
    cores = [w.lower().strip(spots.EDGES) or w for w in text.split()]
    content = [i for i, w in enumerate(cores) if w not in SETTINGS.anchors]
    if not content:
        return {tuple(cores)} if cores else set()
    out = set()
    for at in [-1, *(i for i, w in enumerate(cores) if w in SETTINGS.anchors)]:
        chain = [i for i in content if i > at][:2]
        if len(chain) == 2 or at < 0:
            chain += [content[-1]] * (2 - len(chain))
            out.add((cores[at] if at >= 0 else None, *(cores[i] for i in chain)))
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_awkward_documents(awkward):
    rows = spots.fingerprints(awkward).collect()
    texts = [(r.doc_id, r.text or "") for r in awkward.select("doc_id", "text").collect()]
    assert multiset((r.doc_id, r.n_chars) for r in rows) == multiset((i, len(t)) for i, t in texts)
    by_text = {}
    single = {i for i, _ in texts if i is not None and sum(i == j for j, _ in texts) == 1}
    order = sorted((i for i, _ in texts if i is not None), reverse=True)
    found = {r.doc_id: r for r in rows}
    text_of = dict(texts)
    for r in rows:
        if r.doc_id in single:
            assert by_text.setdefault(text_of[r.doc_id], r.fingerprint) == r.fingerprint
    checked = 0
    for i, following in zip(order, order[1:]):
        if i in single and following in single:
            text, later = text_of[i], text_of[following]
            size = len(text) // 3
            edited = text[: len(text) - size] + later[:size]
            r = found[i]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert abs(r.near_edited - jaccard(plain_spots(text), plain_spots(edited))) < 1e-9
            assert abs(r.near_next - jaccard(plain_spots(text), plain_spots(later))) < 1e-9
            checked += 1
    assert checked > 30


def test_around_the_end_and_over_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spots, "MAX_BLOCKS", 4096)
    draw = random.Random(6)
    rows = [(i * 7 % 3001, prose(draw, 12)) for i in range(3001)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "d"))
    found = {r.doc_id: r for r in spots.fingerprints(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert len(found) == 3001
    text_of = dict(rows)
    for i, r in found.items():
        text, later = text_of[i], text_of[(i - 1) % 3001]
        size = len(text) // 3
        assert r.edited_sha256 == hashlib.sha256((text[: len(text) - size] + later[:size]).encode()).hexdigest()


def test_single_document_is_its_own_next(spark):
    row = spots.fingerprints(spark.createDataFrame([(1, "abcdef ghi")], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdef abc").hexdigest() and row.near_next == 1.0


def test_pruned_jaccard():
    draw = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(draw.integers(0, 900, draw.integers(1, 800))).astype(np.uint32)
        b = np.unique(np.r_[a[draw.random(len(a)) < 0.9], draw.integers(0, 900, 30)]).astype(np.uint32)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert spots.pruned_jaccard(a, b) == true
        assert spots.pruned_jaccard(a, b, 0.8) == (true if true >= 0.8 else 0.0) or true < 0.8


def test_classes_equal_all_pairs(spark, tmp_path):
    draw = random.Random(7)
    rows = []
    for i in range(25):
        words = prose(draw, draw.randint(40, 200)).split()
        for k in range(draw.choice([1, 2, 4])):
            own = list(words)
            for _ in range(k):
                own[draw.randrange(len(own))] = "changed"
            rows.append((100 * i + k, " ".join(own)))
    rows += [(9000, ""), (9001, ""), (9002, "the of and")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = with_rid(spark.read.parquet(str(tmp_path / "d")))
    ids = dict(docs.select("rid", "doc_id").collect())
    groups = defaultdict(list)
    for rid, class_rid in spots.spot_classes(docs).collect():
        groups[class_rid].append(ids[rid])
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: plain_spots(t) for i, t in rows}
    for i in sets:
        for j in sets:
            if i < j and jaccard(sets[i], sets[j]) >= 0.8:
                parent[find(j)] = find(i)
    expected = defaultdict(list)
    for i in sets:
        expected[find(i)].append(i)
    assert multiset(map(sorted, groups.values())) == multiset(map(sorted, expected.values()))


def test_empty_table(nothing):
    assert spots.fingerprints(nothing).collect() == []


def test_texts_without_anchors_are_covered():
    """Lists that begin alike are told apart, and copies with a changed start or middle stay alike."""
    draw = random.Random(3)
    items = lambda n: [f"item{draw.randrange(10**6)}" for _ in range(n)]
    found = lambda words, by=" | ": spots.spots(by.join(words), SETTINGS)
    for by in (" | ", " "):
        one, other = items(60), items(60)
        assert spots.pruned_jaccard(found(one, by), found(one[:2] + other, by)) < 0.1
        for changed in (0, 1, 30):
            copy = one[:changed] + ["changed"] + one[changed + 1 :]
            assert spots.pruned_jaccard(found(one, by), found(copy, by)) > 0.75
        for k in range(2, 57):
            assert spots.pruned_jaccard(found(one, by), found(one[:k] + other[:4] + one[k + 4 :], by)) < 1
    text = prose(draw, 200)
    assert len(found([text])) == len(plain_spots(text))
