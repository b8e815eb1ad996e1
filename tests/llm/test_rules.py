"""Quality rules against plain Python, and how cutoffs follow their group."""

import re
from collections import Counter

from conftest_helpers import multiset, texts_of
from feedhouse.llm import rules

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def measured(text):
    words = [w for w in SPACE.split(text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_counts_equal_plain_python(awkward):
    out = rules.adaptive_rules(awkward)
    found = multiset((r.doc_id, *[r[c] for c in rules.BASE], r.base_failed) for r in out.collect())
    expected = []
    for doc_id, text in texts_of(awkward):
        m = measured(text)
        expected.append((doc_id, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert found == multiset(expected)


def test_broadcast_and_shuffle_agree(awkward):
    table = rules.settle(rules.with_measures(awkward.select("doc_id", "lang", "source", "text")).drop("text"), "m")
    one = rules.judge(table).select("doc_id", "n_words", "kept").collect()
    two = rules.judge(table, broadcast_groups=0).select("doc_id", "n_words", "kept").collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(one, key=key) == sorted(two, key=key)


def test_stage_keeps_columns_and_rejects_junk(awkward):
    kept = rules.keep_good(awkward)
    assert kept.columns == awkward.columns and kept.dtypes == awkward.dtypes
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {40, 41, 42, 43, 49, 50}
    assert set(range(10)) <= ids


def test_cutoffs_follow_the_group(spark):
    plain = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"word{i} |" for i in range(60))
    rows = [(i, plain, "en", "a") for i in range(150)] + [(1000, noisy, "en", "a")]
    rows += [(2000 + i, noisy, "en", "b") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in rules.adaptive_rules(docs).where("kept").collect()}
    assert kept == {*range(150), *range(2000, 2150)}


def test_small_groups_take_coarser_sketches(spark):
    plain = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"word{i} |" for i in range(60))
    rows = [(i, plain, "en", "a") for i in range(150)] + [(1000, noisy, "en", "lone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert not rules.adaptive_rules(docs).where("doc_id = 1000").first().kept


def test_sketches_merge(awkward):
    table = rules.with_measures(awkward)
    whole = rules.sketch(table, ["lang"])
    parts = rules.merge(rules.sketch(table, ["lang", "source"]), ["lang"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_empty_table(nothing):
    assert rules.adaptive_rules(nothing).collect() == []
    assert rules.keep_good(nothing).collect() == []
