"""Long repeats against all windows in a dictionary."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest_helpers import multiset, texts_of
from feedhouse.llm import repeats


def report(rows, length=400):
    seen = Counter(t[s : s + length] for _, t in rows for s in range(len(t) - length + 1))
    out = []
    for doc_id, text in rows:
        spans = []
        for s in range(len(text) - length + 1):
            if seen[text[s : s + length]] > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1] = spans[-1][0], s + length
                else:
                    spans.append((s, s + length))
        kept = repeats.kept_bytes(text, spans)
        out.append((doc_id, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return multiset(out)


@pytest.mark.parametrize("settings", [repeats.Settings(), repeats.Settings(bucket_limit=2, bands=3)])
def test_awkward_documents(awkward, settings):
    expected = report([(i, t.encode()) for i, t in texts_of(awkward)])
    assert multiset(repeats.repeat_report(awkward, settings).collect()) == expected


def test_shared_passages_in_many_documents(spark, tmp_path):
    draw = random.Random(8)
    letters = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    shared, common = letters(900), letters(450)
    rows = [(i, letters(draw.randint(0, 300)) + shared[draw.randint(0, 450):] + letters(draw.randint(0, 300))) for i in range(60)]
    rows += [(100 + i, letters(50) + common + letters(50) + common[: 390 + i]) for i in range(20)]
    rows += [(200, "z" * 1200), (201, "ab" * 700), (202, letters(399))]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    expected = report([(i, t.encode()) for i, t in rows])
    for limit in (512, 7):
        assert multiset(repeats.repeat_report(docs, repeats.Settings(bucket_limit=limit)).collect()) == expected


def test_long_texts_are_cut_with_an_overlap(spark, monkeypatch):
    draw = random.Random(9)
    base = "".join(draw.choices("abcdefghijkl ", k=5000))
    text = base + "".join(draw.choices("abcdefghijkl ", k=3000)) + base[1000:3000]
    docs = spark.createDataFrame([(1, text), (2, base[200:2200])], "doc_id long, text string")
    expected = report([(1, text.encode()), (2, base[200:2200].encode())])
    assert multiset(repeats.repeat_report(docs).collect()) == expected


def test_cut_anchors_cover_the_same_windows():
    draw = np.random.default_rng(1)
    text = draw.integers(97, 103, 5000, dtype=np.uint8)
    at, _, low, high = repeats.anchors(text, np.array([2000, 2300, 5000]), 400)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high)])
    inside = [s for s in range(4601) if s + 400 <= 2000 or 2300 <= s]
    assert sorted(covered.tolist()) == inside
    assert ((at >= low) | (at <= high)).all()


def test_maximal_repeats_have_all_occurrences():
    before = [b"dcba", b"dcbx", b"dcba", b"zzzz"]
    after = [b"efgh1", b"efgh2", b"efgh3", b"efgh4"]
    found = {(tuple(sorted(g)), a, b) for g, a, b in repeats.maximal_repeats(before, after, 6)}
    assert found == {((0, 2), 4, 4), ((0, 1, 2), 3, 4)}


def test_intervals():
    assert sorted(repeats.intervals([2, 3, 1, 3], 1)) == [(0, 2, 2), (0, 4, 1), (1, 2, 3), (3, 4, 3)]


def test_stage_keeps_rows_and_columns(awkward):
    out = repeats.remove_repeats(awkward)
    assert out.columns == awkward.columns and out.dtypes == awkward.dtypes
    before, after = awkward.collect(), out.collect()
    assert len(before) == len(after)
    long_copy = next(r for r in after if r.doc_id == 49)
    assert long_copy.text == "" and long_copy.n_chars == 0
    assert multiset(r for r in before if r.text is None) == multiset(r for r in after if r.text is None)


def test_empty_table(nothing):
    assert repeats.repeat_report(nothing).collect() == []
    assert repeats.remove_repeats(nothing).collect() == []


def test_row_numbers_do_not_follow_the_splits(spark, tmp_path):
    rows = [(i, f"text {i} " * 50) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frame.write.option("parquet.block.size", 20_000).parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    numbered = repeats.with_rid(docs.select("doc_id"))
    seen, parts = [], set()
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            again = numbered.select("*")
            parts.add(again.rdd.getNumPartitions())
            seen.append(dict(again.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(parts) == 2 and seen[0] == seen[1] and len(set(seen[0].values())) == 3000
    twice = repeats.with_rid(docs.crossJoin(spark.range(2)))
    assert twice.select("rid").distinct().count() == 6000


def test_texts_without_spans_do_not_move(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(50)]
    spark.createDataFrame(rows, "rid long, text string").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(7, ["a"]), (9, ["b"])], "rid long, spans array<string>").write.parquet(str(tmp_path / "s"))
    both = repeats._beside(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s")))
    found = {r.rid: (r.text, r.spans) for r in both.collect()}
    assert found == {i: (t, {7: ["a"], 9: ["b"]}.get(i)) for i, t in rows} and both.count() == 50
