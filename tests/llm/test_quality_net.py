"""Classifier: vectors against plain counting, accuracy on held-out rows, defined results without labels."""

import os

import numpy as np

from conftest_helpers import multiset
from feedhouse.llm import quality_net as net

SMALL = net.Settings(buckets=1 << 10, dim=16, epochs=10)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_context_sums_equal_plain_counting(awkward):
    settings = net.Settings(buckets=64, dim=8, nonzero=2)
    index = net.index_vectors(settings)
    codes = net.Codes(settings.buckets)
    expected = np.zeros((settings.buckets, settings.dim), np.int64)
    for (text,) in awkward.select("text").collect():
        own = [codes[w] >> 6 for w in (text or "").split()]
        for i, bucket in enumerate(own):
            for j in range(max(0, i - 2), min(len(own), i + 3)):
                if j != i:
                    expected[bucket] += index[own[j]]
    assert (net.context_sums(awkward, settings) == expected).all()


def test_held_out_accuracy(spark):
    rows = net.op5_random_indexing_net(spark, SF_DIR).join(
        spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) >= 10 and {r.quality for r in held} == {0, 1}
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_documents(awkward, labels):
    out = net.score_documents(awkward, labels, "score_", SMALL)
    assert out.columns == [*awkward.columns, "score_"]
    rows = out.collect()
    assert multiset(r[:-1] for r in rows) == multiset(awkward.collect())
    assert all(0 <= r[-1] <= 1 for r in rows)
    empty = {r[-1] for r in rows if not (r.text or "").split()}
    assert len(empty) == 1
    again = net.score_documents(awkward, labels, "score_", SMALL).collect()
    assert multiset(rows) == multiset(again)


def test_stage_keeps_columns(awkward, labels):
    kept = net.keep_good(awkward, labels, SMALL)
    assert kept.columns == awkward.columns and kept.dtypes == awkward.dtypes


def test_without_labels_of_both_kinds(awkward, labels, nothing):
    assert {r[0] for r in net.score_documents(awkward, labels.limit(0), "s", SMALL).select("s").collect()} == {0.5}
    ones = labels.where("quality = 1")
    assert {r[0] for r in net.score_documents(awkward, ones, "s", SMALL).select("s").collect()} == {1.0}
    assert net.score_documents(nothing, labels, "s", SMALL).collect() == []


def test_sample_is_bounded_and_never_held_out(awkward, labels):
    from feedhouse.llm.common import fold_of
    from pyspark.sql import functions as F

    sample = net.labelled_sample(awkward, labels, net.Settings(max_labelled=10))
    assert sample.where(fold_of(F.col("doc_id"), net.FOLDS) == 0).count() == 0
    assert sample.count() < 25


def test_temperature_lowers_the_loss():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 4))
    y = (x[:, 0] + draw.normal(size=4000) > 0).astype(float)
    model = net.fit_network(x[:300], y[:300], net.Settings(epochs=60))
    loss = lambda: -np.mean(np.log(np.where(y[300:] == 1, model.scores(x[300:]), 1 - model.scores(x[300:]))))
    before = loss()
    net.calibrate(model, x[300:], y[300:])
    assert loss() <= before and model.temperature > 1
