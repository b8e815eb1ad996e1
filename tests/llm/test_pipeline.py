"""The pipeline: its stages' columns and order, planted cases, and the registered queries."""

import os
import random

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from feedhouse.llm import common, order_minhash, rules
from feedhouse.session import folder_names, scratch_root
from pyspark.sql import functions as F

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_operator_is_registered():
    names = registered.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "quality classifier", "near duplicates", "long repeats", "best-fit packing"]


@pytest.fixture(scope="module")
def passed(spark, tmp_path_factory):
    """The documents before and after each stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_keep_the_columns_of_documents(passed):
    assert all(f.dtypes == passed[0].dtypes for f in passed[:-1])


def test_junk_goes_and_clean_documents_stay(spark, passed):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    start, end = (f.join(labels, "doc_id").select("doc_id", "quality").distinct() for f in (passed[0], passed[2]))
    assert end.where("quality = 0").count() == 0
    long_enough = passed[0].where("size(split(text, ' ')) > 40").select("doc_id")
    clean = start.where("quality = 1").join(long_enough, "doc_id")
    assert clean.join(end, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_no_text_is_there_twice(passed):
    third = passed[3]
    assert third.count() == third.select("text").distinct().count() == third.select("doc_id").distinct().count()
    assert passed[4].count() == third.count()


def test_everything_kept_is_packed(passed):
    packed = passed[-1]
    assert packed.select("doc_id").distinct().count() == passed[-2].count()
    tops = packed.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in tops) <= 4096


def test_short_passages_of_over_fifty_words_go(spark, tmp_path):
    """Runs of 51 to 60 short words that two documents share go, runs of 50 stay."""
    draw = random.Random(21)
    word = lambda: "".join(draw.choices("abcdefghijé", k=draw.randint(1, 4)))
    rows, shared = [], {}
    for n in (50, 51, 55, 60):
        shared[n] = [word() for _ in range(n)]
        for k in (0, 1):
            own = [[f"own{n}x{k}x{j}" for j in range(a, a + 30)] for a in (0, 30)]
            blank = "\n " if k else " "
            rows.append((n * 10 + k, " ".join(own[0]) + blank + blank.join(shared[n]) + " " + " ".join(own[1])))
    assert all(len(" ".join(w).encode()) < 300 for w in shared.values())
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    out = corpus_pipeline.long_repeats(spark, spark.read.parquet(str(tmp_path / "d")), "")
    before = dict(rows)
    for doc_id, text in out.collect():
        n = doc_id // 10
        kept = before[doc_id].split()
        assert text.split() == (kept if n == 50 else kept[:30] + kept[-30:])


def test_stages_take_columns_of_any_name(spark, awkward, tmp_path):
    extra = ["_file", "_row", "_number", "_rid", "_metadata", "_q_words", "_q_hits", "_q_lang", "_own_1", "cut", "a.b`c"]
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    awkward.select(*plain, *[F.lit(n).alias(n) for n in extra]).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for stage in (rules.keep_good, order_minhash.keep_first):
        kept = stage(docs)
        assert kept.dtypes == docs.dtypes
        rows = kept.collect()
        assert all(tuple(r[5:]) == tuple(extra) for r in rows)
        expected = stage(awkward.select(*plain)).collect()
        assert sorted(repr(tuple(r[:5])) for r in rows) == sorted(repr(tuple(r)) for r in expected)


def scratch_tables(spark):
    """Labels of the settled tables that are there."""
    names = folder_names(spark, f"{scratch_root(spark)}/feedhouse-{spark.sparkContext.applicationId}")
    return {n: n.rsplit("-", 1)[0] for n in names}


def test_stages_leave_no_working_tables(spark, awkward):
    """What a stage wrote on the way to a table goes when that is written, and its result is whole."""
    before = set(scratch_tables(spark))
    kept, cut = order_minhash.keep_first(awkward), corpus_pipeline.long_repeats(spark, awkward, "")
    left = {label for name, label in scratch_tables(spark).items() if name not in before}
    assert left <= {"copies", "spans", "runs", "code"}
    assert 0 < kept.count() < awkward.count() and cut.count() == awkward.count()


def test_settled_tables(spark):
    frame = spark.range(100).withColumn("k", F.col("id") % 7)
    outer = []

    def total():
        outer.append(common.settle(frame.groupBy("k").count(), "inner"))
        outer.append(common.settle_alone(lambda: common.settle(outer[0], "deep").where("k < 5"), "nested"))
        return outer[1].select(F.sum("count").alias("n"))

    before = set(scratch_tables(spark))
    one = common.settle_alone(total, "one")
    two = common.settle(one, "two")
    now = lambda: {label for name, label in scratch_tables(spark).items() if name not in before}
    assert one.first().n == two.first().n == sum(1 for i in range(100) if i % 7 < 5) and now() == {"one", "two"}
    common.drop(two)
    assert now() == {"one"} and spark.conf.get(common.FREE_SHUFFLES) == "false"
