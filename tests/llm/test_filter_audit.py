"""The filter audit against plain Python, and its prepass."""

import re
from itertools import permutations

import numpy as np
from conftest_helpers import multiset
from feedhouse.llm import filter_audit as fa

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def fails(text, doc_id, firsts):
    words = [w for w in SPACE.split(text) if w]
    return {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
        "E": doc_id is not None and firsts.get(text, doc_id) < doc_id,
    }


def brute(rows, labels):
    """Each order applied to each part, filter by filter."""
    firsts = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            firsts[text or ""] = min(doc_id, firsts.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = {}
    for doc_id, text, lang in rows:
        parts.setdefault(lang or "", []).append((doc_id, fails(text or "", doc_id, firsts)))
    out = []
    for part, docs in parts.items():
        rows_of, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                total[f] += len(removed)
                rows_of.append(("".join(order), step, f, (
                    len(left), len(removed), sum(d[1][f] for d in gone),
                    sum(d[1][f] and sum(d[1].values()) == 1 for d in docs),
                    sum(d[0] in good for d in removed), sum(d[0] in toxic for d in removed))))
                gone = gone + removed
        out += [(part, order, step, *counts, total[f]) for order, step, f, counts in rows_of]
    return out


def test_audit_equals_plain_python(awkward, labels):
    out = fa.filter_audit(awkward, labels)
    rows = [(r.doc_id, r.text, r.lang) for r in awkward.select("doc_id", "text", "lang").collect()]
    expected = brute(rows, [tuple(r) for r in labels.collect()])
    assert multiset(out.collect()) == multiset(expected)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]


def test_hashes_by_shuffle_give_the_same_masks(awkward):
    one, two = fa.with_masks(awkward), fa.with_masks(awkward, broadcast_hashes=0)
    assert multiset(one.collect()) == multiset(two.collect())


def test_copies_are_told_by_the_whole_text(spark):
    long = "word " * 5000
    rows = [(9, long), (3, long + "a"), (4, long + "b"), (1, None), (2, ""), (None, long), (9, long), (11, long), (5, None)]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, lang string")
    masked = {(r.doc_id, bool(r["mask"] & fa.COPY_BIT)) for r in fa.with_masks(docs).collect()}
    assert masked == {(9, False), (3, False), (4, False), (1, False), (2, True), (None, False), (11, True), (5, True)}


def test_prepass_keeps_every_repeat_and_clears_most_others(spark):
    n = 60_000
    rows = spark.range(n).selectExpr("case when id % 3 = 0 then 7 when id % 10 = 1 then xxhash64(id - 1) else xxhash64(id) end as h")
    hashes = np.array([r.h for r in rows.collect()])
    values, counts = np.unique(hashes, return_counts=True)
    found = [r.h for r in fa.possible_repeats(rows.repartition(7), n).collect()]
    assert len(found) == len(set(found)) and set(values[counts > 1].tolist()) <= set(found) <= set(values.tolist())
    assert len(found) < (counts > 1).sum() + 0.02 * n


def test_one_hash_never_counts_twice_by_its_own_probes():
    cells, sums = fa.saturated(np.array([[5, 6], [5, 7], [5, 5], [8, 6]], dtype=np.uint32), np.array([1, 1]))
    assert dict(zip(cells.tolist(), sums.tolist())) == {5: 2, 6: 1, 7: 1, 8: 1}
    cells, sums = fa.saturated(np.array([[5], [5]], dtype=np.uint32), np.array([1]))
    assert (cells.tolist(), sums.tolist()) == ([5], [1])


def test_no_documents(nothing, labels):
    assert fa.filter_audit(nothing, labels).count() == 0


def test_no_labels(awkward, labels):
    out = fa.filter_audit(awkward, labels.where("false"))
    assert out.where("good_lost <> 0 or toxic_lost <> 0").count() == 0 and out.count() == 600 * 3
